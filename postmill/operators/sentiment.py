"""Sentiment of a message: mean score of the tokens that a lexicon knows.

The score is a column expression on the body: no token row, no join and no
shuffle, so it can be computed inside any scan of the messages.  A lexicon
above the inline bound is joined instead, with the same result.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.functions import text
from postmill.operators import terms

# The lexicon goes into the plan as literals up to these sizes.
INLINE_WORDS = 20_000
INLINE_SCORES = 64
INLINE_LENGTH = 64

# A joined lexicon of up to so many characters is broadcast.
BROADCAST_CHARS = 32 << 20

# Bits of a filter's bucket, as Spark's bitmap functions have them; bits for each entry of
# the filter; and buckets of 4 KB at most, which are broadcast.
BUCKET_BITS = 32_768
BITS_PER_ENTRY = 16
MOST_BUCKETS = 8192

# Beyond that, parts that one word is split into, at least; see _salts.
SALTS = 32


def matchable(lexicon: DataFrame) -> DataFrame:
    """Lexicon entries that can equal a token, one row per word.

    Tokens are lower-case ASCII word characters, so phrases, hyphenated and
    accented entries never match and are left out; so are scores that are null or
    not finite, which would make the score of every message that holds the word so.
    """
    score = F.col("score").cast("double")
    finite = F.abs(score) < float("inf")  # NaN is above all numbers
    return (
        lexicon.filter(F.col("word").rlike(r"\A[a-z0-9_]+\z") & finite)
        .groupBy("word")
        .agg(F.max(score).alias("score"))
    )


def _inline_lexicon(lexicon: DataFrame) -> dict[float, list[str]] | None:
    """Words by score, or None if the lexicon is above an inline bound.

    At most ``INLINE_WORDS`` + 1 words of ``INLINE_LENGTH`` + 1 characters reach the driver.
    """
    entry = F.substring("word", 1, INLINE_LENGTH + 1).alias("word")
    rows = matchable(lexicon).select(entry, "score").limit(INLINE_WORDS + 1).collect()
    by_score: dict[float, list[str]] = {}
    for row in sorted(rows):
        by_score.setdefault(row["score"], []).append(row["word"])
    too_long = any(len(row["word"]) > INLINE_LENGTH for row in rows)
    if too_long or len(rows) > INLINE_WORDS or len(by_score) > INLINE_SCORES:
        return None
    return by_score


def _mean_score(total: Column, matches: Column) -> Column:
    return F.when(matches > 0, total / matches).otherwise(F.lit(0.0)).cast("float")


def score_messages(
    messages: DataFrame,
    lexicon: DataFrame,
    keys: list[str],
    body: str = "body",
    output: str = "sentiment",
) -> DataFrame:
    """Add the float column ``output``.

    Repeated tokens count each time.  A body without a known word scores 0.0; a
    null body has no score.  Every row is scored by its own body, whether ``keys``
    are unique or not.  The lexicon is read when the plan is built.
    """
    by_score = _inline_lexicon(lexicon)
    if by_score is None:
        return score_messages_by_join(messages, lexicon, keys, body, output)
    if not by_score:
        return messages.withColumn(output, F.when(F.col(body).isNotNull(), F.lit(0.0).cast("float")))
    words = text.sql_literals(sorted(word for group in by_score.values() for word in group))
    branches = " ".join(
        f"when word in ({text.sql_literals(group)}) then {score!r}D" for score, group in by_score.items()
    )
    tokens, hits = "__tokens", "__hits"
    scored = (
        messages.withColumn(tokens, text.sentiment_tokens(F.col(body)))
        .withColumn(hits, F.expr(f"filter({tokens}, word -> word in ({words}))"))
        .withColumn(
            output,
            _mean_score(
                F.expr(f"aggregate({hits}, 0D, (total, word) -> total + case {branches} end)"),
                F.size(hits),
            ),
        )
    )
    return scored.withColumn(output, F.when(F.col(body).isNotNull(), F.col(output))).drop(tokens, hits)


def score_messages_by_join(
    messages: DataFrame,
    lexicon: DataFrame,
    keys: list[str],
    body: str = "body",
    output: str = "sentiment",
    broadcast_chars: int = BROADCAST_CHARS,
) -> DataFrame:
    """The same scores for a lexicon of any size, up to the rounding of sums.

    Tokens are counted inside each message first, and only those that the lexicon
    knows are shuffled.  A message is known by its keys and two hashes of its body,
    so rows that share keys do not mix, and equal rows have the same mean.  The body
    itself is in no exchange unless the caller keeps it.

    A lexicon whose size has been checked is broadcast.  A larger one meets the
    words in a merge join, each word split into parts, as one word may be in every
    message.  Words that no entry can equal are dropped before by a bit filter of the
    lexicon, which is broadcast: its size is bounded, whatever the lexicon's is.
    Spark's own estimate must not decide for a broadcast there, because
    that of exploded words is too low for long texts.
    """
    known = [*keys, "__b1", "__b2"]
    hashes = {"__b1": F.xxhash64(body), "__b2": F.xxhash64(body, F.lit(1))}
    counts = terms.run_lengths(
        messages.withColumns(hashes).select(*known, F.sort_array(text.sentiment_tokens(F.col(body))).alias("words")),
        known,
    )
    entries = matchable(lexicon)
    size, n = entries.agg(F.sum(F.length("word") + 16), F.count(F.lit(1))).first()
    if (size or 0) <= broadcast_chars:
        hits = counts.join(F.broadcast(entries), "word")
    else:
        salts = _salts(messages)
        salted = possible_words(counts, entries, n).withColumn("salt", F.pmod(F.xxhash64(*known), F.lit(salts)).cast("int"))
        spread = entries.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        hits = salted.join(spread.hint("merge"), ["word", "salt"])
    totals = hits.groupBy(*known).agg(
        F.sum(F.col("score") * F.col("tf")).alias("__total"), F.sum("tf").alias("__matches")
    )
    totals = totals.select(*[F.col(c).alias(f"__of_{c}") for c in known], "__total", "__matches")
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in known])
    rows = messages.withColumns({**hashes, "__any": F.col(body).isNotNull()})
    mean = _mean_score(F.col("__total"), F.coalesce(F.col("__matches"), F.lit(0)))
    kept = [c for c in messages.columns if c != output]
    return rows.join(totals, same, "left").select(*kept, F.when(F.col("__any"), mean).alias(output))


def _bit(word: Column, buckets: int) -> Column:
    """The bit of a word in a filter of so many buckets."""
    return F.pmod(F.xxhash64(word, F.lit("filter")), F.lit(buckets * BUCKET_BITS))


def word_filter(entries: DataFrame, buckets: int) -> DataFrame:
    """``bucket`` and ``bits``: the bit of each word of ``entries`` is set."""
    bit = entries.select(_bit(F.col("word"), buckets).alias("bit"))
    return bit.groupBy(F.floor(F.col("bit") / BUCKET_BITS).cast("int").alias("bucket")).agg(
        F.bitmap_construct_agg(F.col("bit") % BUCKET_BITS).alias("bits")
    )


def possible_words(counts: DataFrame, entries: DataFrame, n: int) -> DataFrame:
    """Rows of ``counts`` without those whose ``word`` is surely none of the ``n`` entries.

    No row of an entry is lost; of the others about one in ``BITS_PER_ENTRY`` stays, more
    of them if the lexicon is so large that the filter's bound holds it below that.
    """
    buckets = min(MOST_BUCKETS, max(1, -(-n * BITS_PER_ENTRY // BUCKET_BITS)))
    columns = counts.columns
    bit = counts.withColumn("__bit", _bit(F.col("word"), buckets))
    keyed = bit.withColumn("bucket", F.floor(F.col("__bit") / BUCKET_BITS).cast("int"))
    met = keyed.join(F.broadcast(word_filter(entries, buckets)), "bucket")
    place = (F.col("__bit") % BUCKET_BITS).cast("int")
    byte = F.conv(F.hex(F.substring("bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return met.where(F.getbit(byte, place % 8) == 1).select(*columns)


def _salts(messages: DataFrame) -> int:
    """Parts of a word: they follow the number of shuffle partitions, which follows the data."""
    return max(SALTS, int(messages.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4)


def sentiment_cells(scored: DataFrame, keys: list[str], scored_at: Column | None = None) -> DataFrame:
    """Scores as cells (keys, ``ts``, ``value``) to be stored beside the messages.

    The version is the time of scoring in epoch milliseconds, so a re-run adds a
    newer version; pass ``scored_at`` to fix it.
    """
    at = scored_at if scored_at is not None else F.unix_millis(F.current_timestamp())
    keyed = scored.filter(F.col("sentiment").isNotNull())
    return keyed.select(
        *[F.col(k).alias("message_ts" if k == "ts" else k) for k in keys],
        at.cast("bigint").alias("ts"),
        F.col("sentiment").alias("value"),
    )
