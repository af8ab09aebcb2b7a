"""Posting lists of words, so that further questions on the same bodies need no tokenising.

Messages are numbered in the order of their domain.  A word's postings lie in blocks of
``BLOCK`` message numbers: a block holds the first number, the gaps between the following
ones and how often the word stands in each message.  No block has more than ``BLOCK``
entries, so a word of every message is many blocks, in many tasks.

Blocks are the unit of work throughout: the scores of a block's messages are one bounded
array, and a word's share of a total is summed inside its block's row.  An index that keeps
the sentiment has that sum for each block, made while the block is gathered, so that a
total of a domain adds up blocks; only the two at its ends are opened.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.functions import text
from postmill.operators import terms

BLOCK = 256
#: Blocks of scores (of at most ``BLOCK`` doubles with a mark each) that are broadcast, at most.
BROADCAST_BLOCKS = 4096
#: A posting while it is gathered: its place in the block and, below, its count.
PLACE = 1 << 32


def write_index(emails: DataFrame, path: str, kept: tuple[str, ...] = ()) -> None:
    """Store the index of a table of messages: ``messages`` and ``postings``.

    ``messages`` has ``from``, ``ts``, ``from_domain``, ``number``, the columns ``kept`` and
    the sorted words of the first sentence, lower-case; numbers of one domain follow each
    other.  They are fixed by storing them: the postings are made from the stored table.
    The shuffle carries the bodies, which are smaller than arrays of their words.
    """
    spark = emails.sparkSession
    rows = emails.select("from", "ts", text.domain_of(F.col("from")).alias("from_domain"), *kept, "body")
    placed = rows.repartitionByRange("from_domain", "from", "ts").sortWithinPartitions("from_domain", "from", "ts")
    words = F.transform(text.first_sentence_words(F.col("body")), lambda w: F.lower(w))
    numbered = placed.withColumns({"words": F.sort_array(words), "number": F.monotonically_increasing_id()})
    numbered.drop("body").write.parquet(f"{path}/messages")
    stored = spark.read.parquet(f"{path}/messages").where(F.col("words").isNotNull())
    of = ["sentiment"] if "sentiment" in kept else []
    counts = terms.run_lengths(stored.select("number", *of, "words"), ["number", *of])
    blocks(counts).write.parquet(f"{path}/postings")


def _block() -> Column:
    return F.floor(F.col("number") / BLOCK).alias("block")


def blocks(counts: DataFrame) -> DataFrame:
    """(``number``, ``word``, ``tf``) rows to ``word``, ``block``, ``first``, ``gaps``, ``tfs``.

    Where the rows have a ``sentiment``, also ``n``, the block's entries, and ``total``, the sum of
    sentiment * tf.  A posting is one number until its block is complete, so that the shuffle is small.
    """
    entry = (F.col("number") % BLOCK) * PLACE + F.col("tf")
    sums, names = [], []
    if "sentiment" in counts.columns:
        names = ["n", "total"]
        sums = [F.count(F.lit(1)).alias("n"), F.sum(F.col("sentiment").cast("double") * F.col("tf")).alias("total")]
    sorted_ = counts.groupBy("word", _block()).agg(F.sort_array(F.collect_list(entry)).alias("entries"), *sums)
    places = F.transform("entries", lambda e: F.floor(e / PLACE).cast("int"))
    tfs = F.transform("entries", lambda e: (e % PLACE).cast("int"))
    placed = sorted_.select("word", "block", places.alias("places"), tfs.alias("tfs"), *names)
    gap = F.transform(
        F.slice("places", F.lit(2), F.size("places")), lambda place, i: place - F.get("places", i)
    )
    first = F.col("block") * BLOCK + F.get("places", F.lit(0))
    gapped = placed.select("word", "block", first.alias("first"), gap.alias("gaps"), "tfs", *names)
    return gapped.sortWithinPartitions("block", "word")


def _numbers() -> Column:
    return F.aggregate(
        "gaps", F.array("first"), lambda so_far, gap: F.concat(so_far, F.array(F.element_at(so_far, -1) + gap))
    )


def entries(postings: DataFrame) -> DataFrame:
    """Blocks back to ``word``, ``number``, ``tf``."""
    both = F.arrays_zip(_numbers().alias("number"), F.col("tfs").alias("tf"))
    return postings.select("word", F.inline(both))


def block_scores(messages: DataFrame) -> DataFrame:
    """``block``, ``low`` and ``scores`` from ``number``, ``hit`` and ``sentiment`` of one domain's messages.

    Numbers of a domain follow each other inside a block, so ``scores`` has a place for each
    from ``low`` on; a message without ``hit`` is to count for nothing.
    """
    entry = F.struct("number", "hit", F.col("sentiment").cast("double").alias("sentiment"))
    placed = messages.groupBy(_block()).agg(F.sort_array(F.collect_list(entry)).alias("scores"))
    return placed.select("block", F.get("scores", F.lit(0))["number"].alias("low"), "scores")


def word_totals(spark: SparkSession, path: str, scored: DataFrame | None, domain: str) -> DataFrame:
    """``reports.words_by_sentiment`` of one domain from the stored index; no body is read.

    ``scored`` has ``from``, ``ts`` (unique) and ``sentiment``; None takes the ``sentiment``
    that the index has kept, and its sums of whole blocks.  Only blocks in which the domain has messages are read on, and
    a word's occurrences in a block are weighed inside its row, against the block's scores:
    no posting becomes a row, and what is shuffled are sums.
    """
    stored = spark.read.parquet(f"{path}/messages").where(F.col("from_domain") == domain)
    blocks_ = spark.read.parquet(f"{path}/postings")
    summed = []
    if scored is None:
        # A domain's numbers follow each other: all blocks between its ends hold its messages alone.
        low, high = stored.agg(F.min("number"), F.max("number")).first()
        begin, end = (0, 0) if low is None else (-(-low // BLOCK), (high + 1) // BLOCK)
        inner = (F.col("block") >= begin) & (F.col("block") < end)
        summed = [blocks_.where(inner).select("word", "n", "total")]
        blocks_, stored = blocks_.where(~inner), stored.where(~((F.col("number") >= begin * BLOCK) & (F.col("number") < end * BLOCK)))
        values = stored.select("number", F.lit(True).alias("hit"), "sentiment")
    else:
        score = scored.select(F.col("from").alias("__from"), F.col("ts").alias("__ts"), "sentiment", F.lit(True).alias("hit"))
        same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in ("from", "ts")])
        values = stored.select("from", "ts", "number").join(score, same, "left").select("number", "hit", "sentiment")
    touched = stored.select(_block()).distinct().count()
    scores = block_scores(values)
    # Spark's own estimate must not decide: it knows nothing of the lengths of the arrays.
    scores = F.broadcast(scores) if touched <= BROADCAST_BLOCKS else scores.hint("merge")
    met = blocks_.join(scores, "block")
    weighed = F.zip_with(
        _numbers(), "tfs",
        lambda number, tf: F.struct(F.get("scores", (number - F.col("low")).cast("int")).alias("of"), tf.alias("tf")),
    )
    hits = met.select("word", F.filter(weighed, lambda w: w["of"]["hit"]).alias("hits"))
    values_of = F.filter("hits", lambda w: w["of"]["sentiment"].isNotNull())
    total = F.aggregate(values_of, F.lit(0.0), lambda so_far, w: so_far + w["of"]["sentiment"] * w["tf"])
    # Words without a hit go after the sums: a filter on the hits would be pushed below them and weigh twice.
    opened = hits.select("word", F.size("hits").alias("n"), F.when(F.size(values_of) > 0, total).alias("total"))
    sums = reduce(DataFrame.unionByName, summed, opened)
    totals = sums.groupBy("word").agg(F.sum("n").alias("n"), F.sum("total").alias("totalsentiment"))
    return totals.where(F.col("n") > 0).select("word", "totalsentiment").orderBy("totalsentiment", "word")
