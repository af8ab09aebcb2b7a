"""Quality classifier: boosted trees over statistics of the whole text.

The statistics are computed where the documents lie, in one pass; the model is fitted
on a bounded sample of the labelled rows and travels to the tasks as a few arrays.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postmill.llm import trees, words
from postmill.llm.common import append_columns, text_bytes

#: Labelled rows that the model is fitted on, at most: the first by hash of their id.
SAMPLE_ROWS = 20_000
THRESHOLD = 0.7
#: Bytes of text whose statistics are computed together.
PART_BYTES = 4 << 20

_CLASSES = ["a-z", "A-Z", "0-9", " ", "\n", "\t\r\v\f", ",", ".", "!", "?", "|", "'\"", "#$%&*", ":;-()", "other", "lead", "rest"]
SYMBOL_FIRST = _CLASSES.index("!")


def _class_table() -> np.ndarray:
    table = np.full(256, _CLASSES.index("other"), np.uint8)
    table[0x80:0xC0] = _CLASSES.index("rest")
    table[0xC0:] = _CLASSES.index("lead")
    for i, text in enumerate(_CLASSES[:14]):
        ends = text.encode()
        members = range(ends[0], ends[2] + 1) if len(text) == 3 and text[1] == "-" else ends
        table[list(members)] = i
    return table


_TABLE = _class_table()


def statistics(column: pa.Array) -> np.ndarray:
    """One row of numbers for each text; a null or empty text has zeros."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    sizes = np.asarray(pc.binary_length(column)).astype(np.int64)
    number = (np.cumsum(sizes) - 1) // PART_BYTES
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(number)) + 1, [len(sizes)]]).tolist()
    parts = [_statistics(column.slice(a, b - a)) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b > a]
    return np.concatenate(parts) if parts else np.zeros((0, width()))


def width() -> int:
    return _statistics(pa.array(["a"], pa.large_string())).shape[1]


def _statistics(column: pa.Array) -> np.ndarray:
    data, offsets = text_bytes(column)
    n, k = len(column), len(_CLASSES)
    sizes = np.diff(offsets)
    kind = _TABLE[data]
    text_of = np.repeat(np.arange(n), sizes)
    counts = np.bincount(text_of * k + kind, minlength=n * k).reshape(n, k).astype(float)
    characters = sizes - counts[:, _CLASSES.index("rest")]
    shares = counts / np.maximum(characters, 1)[:, None]

    space = (kind >= 3) & (kind <= 5)
    begins, ends, runs = words.word_spans((~space).astype(np.uint8), offsets)
    run_text = np.repeat(np.arange(n), runs)
    length = ends - begins
    some = np.maximum(runs, 1)
    last, first = kind[ends - 1] if len(ends) else kind[:0], kind[begins] if len(begins) else kind[:0]

    def per_text(values: np.ndarray) -> np.ndarray:
        return np.bincount(run_text, values, n)

    marked = (last >= SYMBOL_FIRST) & (last <= _CLASSES.index("other"))
    mean = per_text(length) / some
    spread = np.sqrt(np.maximum(per_text(length**2.0) / some - mean**2, 0))
    followed = np.zeros(len(begins), bool)
    if len(begins) > 1:
        followed[1:] = marked[1:] & marked[:-1] & (run_text[1:] == run_text[:-1])

    folded = words.fold(data)
    w_begins, w_ends, w_counts = words.word_spans(folded, offsets)
    numbers = words.word_numbers(folded, w_begins, w_ends)
    w_text = np.repeat(np.arange(n), w_counts)
    by = np.lexsort((numbers, w_text))
    fresh = np.ones(len(by), bool)
    if len(by) > 1:
        fresh[1:] = (numbers[by][1:] != numbers[by][:-1]) | (w_text[by][1:] != w_text[by][:-1])
    distinct = np.bincount(w_text[by], fresh, n)

    lines = [value.split("\n") for value in column.to_pylist()]
    line_counts = np.array([len(x) for x in lines], float)
    repeated = np.array([1 - len(set(x)) / len(x) for x in lines])
    top = np.array([max(map(len, x)) for x in lines], float)
    columns = [
        np.log1p(characters), np.log1p(runs), mean, spread,
        per_text(marked) / some, per_text(followed) / some,
        per_text(first == 1) / some, per_text((length == 1)) / some, per_text(length > 20) / some,
        distinct / np.maximum(w_counts, 1), np.log1p(line_counts), characters / line_counts, repeated,
        top / np.maximum(characters, 1),
    ]
    return np.concatenate([shares, np.stack(columns, 1)], axis=1)


def held_out(doc_id: Column) -> Column:
    """Rows that the model never learns from: crc32 of the id's text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit_model(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
    sample_rows: int = SAMPLE_ROWS, **options,
) -> trees.Forest:
    """Fits the forest on at most ``sample_rows`` labelled rows that are not held out.

    The sample is the rows of least hash; it is bounded, so it may be broadcast, and
    only its statistics reach the driver.  Rows with a null id or label are left out.
    Documents that share a labelled id count once, by the least of their texts, so
    copies do not make the sample larger; a null text is as empty.  Without any
    labelled document the model has no trees and one score for all.
    """
    chosen = (
        labels.select(F.col(doc_id).alias("__id"), F.col(label).cast("int").alias("__label"))
        .where("__id is not null and __label is not null")
        .where(~held_out(F.col("__id")))
        .orderBy(F.xxhash64("__id"), "__id", "__label")
        .limit(sample_rows)
    )
    # Of an id's documents one text passes, chosen in each task before the shuffle.
    rows = docs.select(F.col(f"`{doc_id}`").alias("__id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"))
    rows = rows.join(F.broadcast(chosen), "__id").groupBy("__id", "__label").agg(F.min("__text").alias("__text"))
    made = append_columns(
        rows,
        lambda batch: [pa.array(list(statistics(batch.column("__text"))), pa.list_(pa.float64()))],
        [T.StructField("x", T.ArrayType(T.DoubleType()))],
    )
    found = made.select("__id", "__label", "x").orderBy("__id", "__label").toArrow()
    if not found.num_rows:
        return trees.fit(np.zeros((0, width())), np.zeros(0))
    x = np.asarray(found.column("x").combine_chunks().flatten()).reshape(found.num_rows, -1)
    y = (np.asarray(found.column("__label")) == 1).astype(float)
    return trees.fit(x, y, **options)


def with_score(docs: DataFrame, model: trees.Forest, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` and the probability of label 1 for each whole text.

    The new column replaces one of its name; other columns may have any name.  Null and
    empty texts are scored as texts without any character; equal texts, repeated rows
    included, have equal scores.  An empty table gives no rows.
    """
    forest = docs.sparkSession.sparkContext.broadcast(model)
    return append_columns(
        docs,
        lambda batch: [pa.array(forest.value.score(statistics(batch.column(text))), pa.float64())],
        [T.StructField(score, T.DoubleType())],
    )


def accepted(docs: DataFrame, model: trees.Forest, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score reaches the threshold, with their own columns."""
    columns = [f"`{c}`" for c in docs.columns]
    probe = docs.select(F.struct(*columns).alias("row"), F.col(f"`{text}`").alias("probed_text"))
    return with_score(probe, model, "probed_text").where(F.col("score") >= threshold).select("row.*")
