"""Words of messages: term counts, document frequency, keywords.

The (message, word, tf) triples are a sparse matrix, one row per non-zero.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from postmill.functions import text

SHORTEST_WORD = 3
TOP_WORDS = 10

# A word's length counts characters beyond U+FFFF twice, as the original's strings do.
WIDE = r"[\x{10000}-\x{10FFFF}]"

# At most this many frequent words are joined by broadcast; see split_by_share.
FREQUENT_WORDS = 100_000
LONGEST_KEY = 64
# A stop table of up to so many characters is broadcast.
BROADCAST_CHARS = 32 << 20


def default_stop_words() -> list[str]:
    """Spark's own English list.  Pass another list, or a DataFrame, to match other results."""
    return list(StopWordsRemover.loadDefaultStopWords("english"))


def message_words(
    messages: DataFrame, keys: list[str], body: str = "body", stop_words: list[str] | None = None
) -> DataFrame:
    """Keys and the array ``words``: lower-case, at least three characters, no stop words.

    The stop words go into the plan as a hash set.
    """
    # Two characters have three units only if one of them has four bytes, so five bytes at least.
    units = f"octet_length(word) >= 5 and length(word) + regexp_count(word, r'{WIDE}')"
    keep = f"(length(word) >= {SHORTEST_WORD} or {units} >= {SHORTEST_WORD})"
    if stop_words:
        keep += f" and word not in ({text.sql_literals(sorted(set(stop_words)))})"
    tokens = messages.select(*keys, text.keyword_tokens(F.col(body)).alias("tokens"))
    return tokens.select(*keys, F.expr(f"filter(tokens, word -> {keep})").alias("words"))


def _run_starts(messages: DataFrame, keys: list[str]) -> DataFrame:
    """Sorted array ``words`` and ``starts``, the places where a word differs from the one before."""
    return messages.select(
        *keys,
        "words",
        F.filter(
            F.transform(
                "words",
                lambda word, at: F.when((at == 0) | (word != F.get("words", at - 1)), at),
            ),
            lambda at: at.isNotNull(),
        ).alias("starts"),
    )


def _run(at: Column, number: Column) -> Column:
    """(word, tf) of the run that starts at a place."""
    end = F.coalesce(F.get("starts", number + 1), F.size("words"))
    # The word is never null; saying so lets the branches of a plan share a shuffle.
    word = F.coalesce(F.get("words", at), F.lit(""))
    return F.struct(word.alias("word"), (end - at).cast("bigint").alias("tf"))


def run_lengths(messages: DataFrame, keys: list[str]) -> DataFrame:
    """Sorted array ``words`` to one row per distinct word: keys, ``word``, ``tf``.

    Counts inside the row: all words of a message are there already, so no
    shuffle and no hash table of (message, word) pairs is needed.  The runs are made in
    the generator: as a column of their own they would be tested for emptiness below
    all projections, with the words made anew for each of them.
    """
    return _run_starts(messages, keys).select(*keys, F.inline(F.transform("starts", _run)))


def _without(rows: DataFrame, stop_words: DataFrame) -> DataFrame:
    """Rows whose word is not in a table of any size.

    A table whose size has been checked is broadcast.  With a larger one, frequent
    words are looked up in it once each, and their rows are kept or dropped where
    they are; only rows of the other words are shuffled by word.
    """
    stop = stop_words.select(stop_words[stop_words.columns[0]].alias("word")).where("word is not null").distinct()
    columns = rows.columns
    size = stop.agg(F.sum(F.length("word") + 16)).first()[0] or 0
    if size <= BROADCAST_CHARS:
        return rows.join(F.broadcast(stop), "word", "left_anti").select(*columns)
    frequent, _ = split_by_share(rows.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "n", FREQUENT_WORDS)
    frequent = frequent.where(F.length("word") <= LONGEST_KEY).select("word")
    stopped = frequent.join(stop, "word", "left_semi")
    near = rows.join(F.broadcast(frequent), "word", "left_semi").join(F.broadcast(stopped), "word", "left_anti")
    far = rows.join(F.broadcast(frequent), "word", "left_anti").join(stop.hint("merge"), "word", "left_anti")
    return near.select(*columns).unionByName(far.select(*columns))


def _stop_list(stop_words: list[str] | DataFrame | None) -> list[str]:
    if isinstance(stop_words, DataFrame):
        return []
    return default_stop_words() if stop_words is None else stop_words


def term_counts(
    messages: DataFrame,
    keys: list[str],
    body: str = "body",
    stop_words: list[str] | DataFrame | None = None,
) -> DataFrame:
    """Occurrences of each word in each message: keys, ``word``, ``tf``.

    ``keys`` must be unique in ``messages``.  ``stop_words`` is a list (Spark's
    English one by default) or a DataFrame of any size, whose first column is
    removed by an anti-join.
    """
    words = message_words(messages, keys, body, _stop_list(stop_words))
    counts = run_lengths(words.withColumn("words", F.sort_array("words")), keys)
    return _without(counts, stop_words) if isinstance(stop_words, DataFrame) else counts


def message_runs(
    messages: DataFrame, keys: list[str], body: str = "body", stop_words: list[str] | None = None
) -> DataFrame:
    """:func:`term_counts` with one row per message: keys and the array ``runs`` of (word, tf).

    Stored, the runs serve frequencies and scores without another look at the texts.
    """
    words = message_words(messages, keys, body, _stop_list(stop_words)).withColumn("words", F.sort_array("words"))
    return _run_starts(words, keys).select(*keys, F.transform("starts", _run).alias("runs"))


def counts_of_runs(runs: DataFrame, keys: list[str]) -> DataFrame:
    """Keys, ``word``, ``tf``, one row for each run; a stored word is declared as never null again."""
    return _inlined(runs, keys, F.col("runs"))


def _inlined(rows: DataFrame, keys: list[str], runs: Column) -> DataFrame:
    # In the generator, what the runs are cut by is made once a row, not once a run.
    return rows.select(*keys, F.inline(runs)).select(*keys, F.coalesce("word", F.lit("")).alias("word"), "tf")


def reachable_runs(runs: DataFrame, keys: list[str], frequency: DataFrame, n: int) -> DataFrame:
    """:func:`counts_of_runs` without the words that can't be among a message's ``n`` best.

    A word scores tf * idf, and every idf lies between those of the most and of the least
    frequent word.  The n-th highest tf of a message times the lowest idf is a floor that
    n of its words reach; a word whose tf times the highest idf stays below is left out,
    inside the row, before anything is joined, shuffled or ranked.  Ties stay.
    """
    total, most, least = F.sum("df"), F.max("df"), F.min("df")
    # Rounded outward, so that no word is lost to the last digit.
    bound = frequency.agg((F.try_divide(F.log2(total / most), F.log2(total / least)) * (1 - 1e-9)).alias("bound")).scalar()
    tfs = F.sort_array(F.transform("runs", lambda run: run["tf"]), asc=False)
    floor = F.coalesce(F.get(tfs, F.lit(n - 1)) * bound, F.lit(0.0))
    floored = runs.select(*keys, "runs", floor.alias("floor"))
    return _inlined(floored, keys, F.filter("runs", lambda run: run["tf"] >= F.col("floor")))


def reachable_counts(
    messages: DataFrame,
    keys: list[str],
    frequency: DataFrame,
    n: int,
    body: str = "body",
    stop_words: list[str] | None = None,
) -> DataFrame:
    """:func:`reachable_runs` of messages."""
    return reachable_runs(message_runs(messages, keys, body, stop_words), keys, frequency, n)


def _frequency(words: DataFrame) -> DataFrame:
    # Declared as never null, as in run_lengths.
    word = F.coalesce("word", F.lit("")).alias("word")
    return words.select(word).groupBy("word").agg(F.count(F.lit(1)).cast("double").alias("df"))


def document_frequency(counts: DataFrame) -> DataFrame:
    """Number of messages that hold each word: ``word``, ``df``, from term counts."""
    return _frequency(counts)


def message_frequency(
    messages: DataFrame, body: str = "body", stop_words: list[str] | DataFrame | None = None
) -> DataFrame:
    """The same from the messages themselves, without counting inside each message."""
    words = message_words(messages, [], body, _stop_list(stop_words))
    word = F.explode(F.array_distinct("words")).alias("word")
    frequency = _frequency(words.select(word))
    return _without(frequency, stop_words) if isinstance(stop_words, DataFrame) else frequency


def inverse_document_frequency(frequency: DataFrame) -> DataFrame:
    """``word``, ``idf`` = log2(T / df), where T is the sum of df over all words.

    T is the number of distinct (message, word) pairs, not of messages: the
    frequency vector is normalised by its own sum.
    """
    total = frequency.agg(F.sum("df")).scalar()
    return frequency.select("word", F.log2(total / F.col("df")).alias("idf"))


def row_l1_normalise(
    matrix: DataFrame, row: str, value: str = "value", limit: int = FREQUENT_WORDS
) -> DataFrame:
    """Divide each value by the sum of the absolute values in its row.

    A sparse matrix holds no zero: zero and null values are left out.
    The sums are small partial aggregates, and a row that holds a large share
    of the matrix meets its sum by broadcast, not in one task.
    """
    matrix = matrix.filter(F.col(value) != 0)
    sums = matrix.groupBy(row).agg(
        F.sum(F.abs(value)).alias("__sum"), F.count(F.lit(1)).alias("__share")
    )
    joined = join_by_share(matrix, sums, row, "__share", limit)
    return joined.select(*[F.col(c) if c != value else (F.col(c) / F.col("__sum")).alias(c) for c in matrix.columns])


def _short_key(frame: DataFrame, key: str, prefix: str) -> list[Column]:
    """The key in a form of bounded length: the value itself, or a digest of a long text.

    The first column tells digests from texts.
    """
    if not isinstance(frame.schema[key].dataType, StringType):
        return [F.lit(False).alias(f"{prefix}long"), F.col(key).alias(f"{prefix}key")]
    long = F.coalesce(F.length(key) > LONGEST_KEY, F.lit(False))
    short = F.when(long, F.sha2(key, 256)).otherwise(F.col(key))
    return [long.alias(f"{prefix}long"), short.alias(f"{prefix}key")]


def _same(left: DataFrame, right: DataFrame, pairs: dict[str, str]) -> Column:
    """Equality in which null equals null; the plain one where there can be no null."""

    def equal(a: str, b: str) -> Column:
        never_null = not (left.schema[a].nullable or right.schema[b].nullable)
        return F.col(a) == F.col(b) if never_null else F.col(a).eqNullSafe(F.col(b))

    return reduce(lambda a, b: a & b, [equal(a, b) for a, b in pairs.items()])


def split_by_share(per_key: DataFrame, share: str, limit: int) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``share`` is at least 1/``limit`` of the total, and the others.

    The shares of the first part sum to no more than the total, so it has at
    most ``limit`` rows, whatever the data.
    """
    total = per_key.agg(F.sum(share)).scalar()
    is_large = F.col(share) * limit >= total
    return per_key.filter(is_large), per_key.filter(~is_large)


def join_by_share(
    facts: DataFrame, per_key: DataFrame, key: str, share: str, limit: int = FREQUENT_WORDS
) -> DataFrame:
    """Inner join of ``facts`` with one row per key, safe against hot keys.

    ``share`` counts the rows of each key in ``facts``.  Keys with a large share
    are joined by broadcast: at most ``limit`` short keys.  Only the others are
    shuffled, and none of those holds more than 1/``limit`` of the rows.  All
    columns of ``per_key`` but the key are added to ``facts``; they should be
    numbers, as the broadcast is bounded by their width.

    Keys are equal as in ``groupBy``, whichever way they are joined: null equals
    null, and 0.0 equals -0.0.

    The shuffled part asks for a merge join: Spark's size estimate of exploded
    words follows the number of texts, not their length, and must not decide
    for a broadcast.
    """
    added = [c for c in per_key.columns if c != key]
    large, small = split_by_share(per_key, share, limit)
    columns, short = facts.columns, {"__long": "__near_long", "__key": "__near_key"}
    keyed = facts.select("*", *_short_key(facts, key, "__"))
    large = F.broadcast(large.select(*_short_key(large, key, "__near_"), *added))
    near = keyed.join(large, _same(keyed, large, short)).select(*columns, *added)
    names = large.select(*short.values())
    far = keyed.join(names, _same(keyed, names, short), "left_anti").select(*columns)
    others = small.select(F.col(key).alias("__far_key"), *added).hint("merge")
    met = far.join(others, _same(far, others, {key: "__far_key"})).select(*columns, *added)
    return near.unionByName(met)


def word_scores(
    counts: DataFrame, frequency: DataFrame, keys: list[str], frequent: int = FREQUENT_WORDS
) -> DataFrame:
    """TF-IDF: keys, ``word``, ``score`` = tf * log2(T / df).  Zero scores are left out."""
    total = frequency.agg(F.sum("df")).scalar()
    joined = join_by_share(counts, frequency, "word", "df", frequent)
    score = F.col("tf") * F.log2(total / F.col("df"))
    return joined.select(*keys, "word", score.alias("score")).filter(F.col("score") != 0)


def top_words(scores: DataFrame, keys: list[str], n: int = TOP_WORDS) -> DataFrame:
    """The ``n`` highest scores of each message; ties go to the first word."""
    best = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("word"))
    return scores.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n).drop("rank")


def entity_id(sender: Column, ts: Column) -> Column:
    """Message key as text: ``EntityId(sender,ts)``."""
    return F.format_string("EntityId(%s,%d)", sender, ts)
