"""Divergence of sources: smoothed term shares of each (lang, source) group, compared.

A group's share of a term depends on nothing but how often the term stands there: its
count level.  For a block of terms, each group has one indicator column for each of its
levels, one-hot in every row.  The columns' product with their transpose is an exact
table of how many terms have level x in one group and level y in another; pricing a
table (its cells times the difference of the two levels' shares) gives the distance of
two groups over the block.  Blocks are summed.

Terms are counted in each task first; of the counts, those of a language's kept terms are
dealt into shards of a bounded number of terms, each of which meets the language's groups
once.  No list of terms or documents reaches the driver.
"""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postmill.llm.common import ship_package, written

#: Terms are runs of the letters A to Z, lower-cased, and of everything beyond ASCII (all bytes
#: of such a character are above 127); every other byte parts them, as a space does.
_TERM_BYTES = bytes(b if 97 <= b < 123 or b > 127 else b + 32 if 65 <= b < 91 else 32 for b in range(256))
LEAST_DOCUMENTS = 30
SMOOTHING = 5
SCALE = 1_000_000_000
TOP_TERMS = 50
#: Terms of a shard, about; and terms whose levels are made columns together.
SHARD_TERMS = 2048
BLOCK_TERMS = 128
#: Indicator columns that are multiplied at a time; a product has the square of it, at most.
TILE_COLUMNS = 2048
#: Different (lang, source, term) that a task holds before it gives out its counts, about 200
#: bytes each; and how many it gives out at a time.
HELD = 800_000
GIVEN = 50_000
#: A count and the documents of a term are held in one number: documents above these bits.
_BITS = 40


def _text(docs: DataFrame, column: str) -> Column:
    return F.coalesce(docs[f"`{column}`"].cast("string"), F.lit(""))


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang``, ``source``, ``term``, ``n`` occurrences and ``df`` documents that hold it.

    Null texts, languages and sources are empty.  Tasks add up what they have met
    before the shuffle, and give it out when they hold ``HELD`` different rows.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(
        _text(docs, lang).alias("lang"), _text(docs, source).alias("source"), _text(docs, text).cast("binary").alias("text")
    )
    names = ["lang", "source", "term", "n", "df"]

    def given(held: dict[tuple[str, str], dict[bytes, int]]) -> Iterator[pa.RecordBatch]:
        for (lang, source), terms in held.items():
            for at in range(0, len(terms), GIVEN):
                part = list(itertools.islice(terms.items(), at, at + GIVEN))
                both = np.fromiter((x for _, x in part), np.int64, len(part))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.repeat(lang, len(part)),
                        pa.repeat(source, len(part)),
                        pa.array([term for term, _ in part], pa.binary()).cast(pa.string()),
                        pa.array(both & ((1 << _BITS) - 1)),
                        pa.array(both >> _BITS),
                    ],
                    names=names,
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], dict[bytes, int]] = {}
        size, one = 0, 1 << _BITS
        for batch in batches:
            groups = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for group, text in zip(groups, batch.column(2), strict=True):
                terms = held.setdefault(group, {})
                before, get = len(terms), terms.get
                for term, n in Counter(text.as_py().translate(_TERM_BYTES).split()).items():
                    terms[term] = get(term, 0) + n + one
                size += len(terms) - before
                if size >= HELD:
                    yield from given(held)
                    held, size = {}, 0
        yield from given(held)

    counted = rows.mapInArrow(run, "lang string, source string, term string, n long, df long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def kept_terms(counts: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """``lang``, ``term``, ``total`` of the terms that ``least`` documents of the language hold,
    and ``groups``, the count in each source that has any: one entry a source at most."""
    by_term = counts.groupBy("lang", "term").agg(
        F.sum("df").alias("df"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("groups")
    )
    return by_term.where(F.col("df") >= least).select("lang", "term", "total", "groups")


def group_table(docs: DataFrame, kept: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang``, ``source`` of every group that occurs, its ``n`` over kept terms, and of the
    language ``v`` kept terms and ``total`` occurrences."""
    found = docs.select(_text(docs, lang).alias("lang"), _text(docs, source).alias("source")).distinct()
    sums = kept.select("lang", F.inline("groups")).groupBy("lang", "source").agg(F.sum("n").alias("n"))
    whole = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("total"))
    joined = found.join(sums, ["lang", "source"], "left").join(whole, "lang", "left")
    return joined.select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "v", "total")])


def price(count: Column, total: Column, v: Column) -> Column:
    """1 + floor(SCALE * (count + 5) / (total + 5 v)), in whole numbers of any size."""
    wide = "decimal(38,0)"
    above = F.lit(SCALE).cast("decimal(10,0)") * (count + SMOOTHING).cast("decimal(20,0)")
    below = (total + SMOOTHING * v).cast(wide)
    return F.call_function("div", above.cast(wide), below).cast("long") + 1


def prices(count: np.ndarray, total: int, v: int) -> np.ndarray:
    """The same in numpy: a long division in three steps of a thousand, so that nothing
    runs over while ``total`` is below 2**53."""
    below = total + SMOOTHING * v
    whole, rest = np.divmod(count + SMOOTHING, below)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, below)
        whole = whole * 1000 + digit
    return whole + 1


def block_distances(levels: np.ndarray, totals: list[int], v: int) -> np.ndarray:
    """Sum of |p - q| over a block of terms for each pair of groups.

    ``levels`` has a row for each term and a column for each group: the counts.  Each
    column becomes one indicator column for each level in it.  The products of tiles
    of these columns hold whole numbers below 2**24, which 32-bit floats keep exactly.
    """
    n_groups = levels.shape[1]
    columns, shares, begins = [], [], [0]
    for g in range(n_groups):
        found, which = np.unique(levels[:, g], return_inverse=True)
        columns.append(np.equal.outer(which, np.arange(len(found))).astype(np.float32))
        shares.append(prices(found, totals[g], v))
        begins.append(begins[-1] + len(found))
    out = np.zeros((n_groups, n_groups), np.int64)
    # Groups are put into tiles of about TILE_COLUMNS columns; one group's are never parted.
    tiles, first = [], 0
    for g in range(n_groups):
        if g + 1 == n_groups or begins[g + 2] - begins[first] > TILE_COLUMNS:
            tiles.append((first, g + 1))
            first = g + 1
    for x, (a, b) in enumerate(tiles):
        left = np.concatenate(columns[a:b], axis=1)
        p = np.concatenate(shares[a:b])
        for c, d in tiles[x:]:
            joint = left.T @ np.concatenate(columns[c:d], axis=1)
            priced = joint.astype(np.int64) * np.abs(p[:, None] - np.concatenate(shares[c:d])[None, :])
            rows = np.add.reduceat(priced, np.array(begins[a:b]) - begins[a], axis=0)
            out[a:b, c:d] = np.add.reduceat(rows, np.array(begins[c:d]) - begins[c], axis=1)
    return np.maximum(out, out.T)  # tiles below the diagonal were left out


def _shard_pairs(terms: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
    """Distances of all pairs of a language's groups over one shard of its terms."""
    names = ["lang", "source", "item", "value"]
    if not len(terms) or not len(groups):
        return pd.DataFrame({c: pd.Series([], dtype="int64" if c == "value" else "object") for c in names})
    groups = groups.sort_values("source")
    sources = groups["source"].tolist()
    place = {s: k for k, s in enumerate(sources)}
    totals, v = groups["n"].tolist(), int(groups["v"].iloc[0])
    out = np.zeros((len(sources), len(sources)), np.int64)
    for at in range(0, len(terms), BLOCK_TERMS):
        block = terms["groups"].iloc[at : at + BLOCK_TERMS].tolist()
        levels = np.zeros((len(block), len(sources)), np.int64)
        for row, cells in enumerate(block):
            for cell in cells:
                levels[row, place[cell["source"]]] = cell["n"]
        out += block_distances(levels, totals, v)
    x, y = np.nonzero(~np.eye(len(sources), dtype=bool))
    named = np.array(sources, dtype=object)
    made = {"lang": groups["lang"].iloc[0], "source": named[x], "item": named[y], "value": out[x, y]}
    return pd.DataFrame(made, columns=names)


def pair_distances(kept: DataFrame, groups: DataFrame, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """``lang``, ``source``, ``item`` (each other source of the language) and ``value``.

    A language has as many shards as its kept terms need; to each of them its groups
    are sent once.  The shards' sums are added up.  Groups of a language without kept
    terms are at distance 0.
    """
    ship_package(kept.sparkSession)
    shards = F.ceil(F.col("v") / shard_terms)
    per_lang = groups.where("v > 0").select("lang", shards.alias("shards")).distinct()
    dealt = kept.join(per_lang, "lang").select(
        "lang", F.pmod(F.xxhash64("term"), F.col("shards")).alias("shard"), "groups"
    )
    offered = groups.where("v > 0").select(
        "lang", "source", "n", "v", F.explode(F.sequence(F.lit(0).cast("long"), shards - 1)).alias("shard")
    )
    sums = (
        dealt.groupBy("lang", "shard")
        .cogroup(offered.groupBy("lang", "shard"))
        .applyInPandas(_shard_pairs, "lang string, source string, item string, value long")
        .groupBy("lang", "source", "item")
        .agg(F.sum("value").alias("value"))
    )
    pairs = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang")
    pairs = pairs.where("source != item").join(sums, ["lang", "source", "item"], "left")
    return pairs.select("lang", "source", "item", F.coalesce("value", F.lit(0)).alias("value"))


def term_excesses(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``item`` (a term that the source has) and ``value``, by how much its
    share there is above that in the whole language; others are left out."""
    cells = kept.select("lang", F.col("term").alias("item"), "total", F.inline("groups"))
    by_group = groups.select("lang", "source", F.col("n").alias("__n"), F.col("v"), F.col("total").alias("__total"))
    # One row a group; Spark decides by size, and splits a join of a large group if need be.
    joined = cells.join(by_group, ["lang", "source"])
    value = price(F.col("n"), F.col("__n"), F.col("v")) - price(F.col("total"), F.col("__total"), F.col("v"))
    return joined.where("n > 0").select("lang", "source", "item", value.alias("value")).where("value > 0")


def audit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least: int = LEAST_DOCUMENTS,
    top_terms: int = TOP_TERMS,
) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``.

    Part ``pair`` has each other source of the language by distance, all ranks; part
    ``term`` the terms whose share in the source is most above that in the language,
    to rank ``top_terms``.  Ties go to the first item in UTF-8 order.

    A language keeps the terms that ``least`` of its documents hold.  Null texts,
    languages and sources are empty ones; groups without terms count like any other.
    Repeated rows count each time.  An empty table gives no rows, and further columns
    of any name are not read.
    """
    kept = written(kept_terms(term_counts(docs, text, lang, source), least))
    groups = written(group_table(docs, kept, lang, source))
    order = [F.col("value").desc(), F.col("item")]
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order))
    pairs = pair_distances(kept, groups).withColumn("rank", rank)
    terms = term_excesses(kept, groups).withColumn("rank", rank).where(F.col("rank") <= top_terms)
    parts = [frame.withColumn("part", F.lit(part)) for frame, part in ((pairs, "pair"), (terms, "term"))]
    return parts[0].unionByName(parts[1]).select("lang", "source", "part", "item", "value", "rank")
