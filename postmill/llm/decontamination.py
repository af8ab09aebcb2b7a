"""Benchmark decontamination with suffix arrays over the training words.

Each task packs its documents into shards of bounded size and sorts the suffixes
of the shard's words.  Every suffix of every benchmark item is then looked up in
the shard by binary search, one word at a time, which yields the longest verbatim
match and all places of it.  Matches never cross documents, and a document's words
lie in one task, so nothing is shuffled.

The benchmark is the query set.  It reaches the tasks in blocks of bounded bytes;
a block is a broadcast of its own, and a task holds one at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postmill.llm import words
from postmill.llm.common import append_columns, ranges, text_bytes
from postmill.llm.suffixes import narrow, suffix_array

WINDOW = 10
#: Words in a shard: about 60 MB of arrays while it is sorted.
SHARD_WORDS = 1 << 20
#: Bytes of benchmark text in a broadcast block.
BLOCK_BYTES = 8 << 20

FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("hits", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType())]))),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("longest_match", T.LongType()),
]
_HITS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))


@dataclass
class QueryBlock:
    """The suffixes of some benchmark items; equal windows are kept once."""

    symbols: np.ndarray  # words of all items, one after the other
    starts: np.ndarray  # of each different window, a place in ``symbols``
    lengths: np.ndarray  # of the window
    left: np.ndarray  # words from the window's start to the end of its item, the most over its copies
    owner_from: np.ndarray  # owners of window i: owners[owner_from[i]:owner_from[i + 1]]
    owners: np.ndarray
    names: list[str | None]


def query_block(names: list[str | None], texts: pa.Array, window: int) -> QueryBlock:
    data, offsets = text_bytes(texts)
    folded = words.fold(data)
    begins, ends, counts = words.word_spans(folded, offsets)
    symbols = words.word_numbers(folded, begins, ends)
    first = np.cumsum(counts) - counts
    n_windows = np.where(counts >= window, counts - window + 1, np.minimum(counts, 1))
    starts = ranges(first, n_windows)
    item = np.repeat(np.arange(len(counts)), n_windows)
    lengths = np.minimum(counts[item], window)
    left = first[item] + counts[item] - starts
    # Windows of one class are neighbours among the sorted suffixes.
    order = suffix_array(symbols, 1, window)
    place = np.empty(len(symbols), np.int64)
    place[order] = np.arange(len(symbols))
    by = np.lexsort((place[starts], lengths))
    starts, item, lengths, left = starts[by], item[by], lengths[by], left[by]
    new = np.ones(len(starts), bool)
    if len(starts) > 1:
        same = lengths[1:] == lengths[:-1]
        for k in range(window):
            within = same & (k < lengths[1:])
            a = symbols[np.minimum(starts[1:] + k, len(symbols) - 1)]
            b = symbols[np.minimum(starts[:-1] + k, len(symbols) - 1)]
            same &= ~within | (a == b)
        new[1:] = ~same
    group = np.cumsum(new) - 1
    pairs = np.unique(np.stack([group, item], 1), axis=0) if len(group) else np.zeros((0, 2), np.int64)
    heads = np.flatnonzero(new)
    longest = np.maximum.reduceat(left, heads) if len(heads) else left
    # The representative is the copy with the most words after it.
    best = np.lexsort((-left, group))
    best = best[np.searchsorted(group[best], np.arange(len(heads)))] if len(heads) else best
    return QueryBlock(
        symbols, starts[best], lengths[best], longest,
        np.searchsorted(pairs[:, 0], np.arange(len(heads) + 1)), pairs[:, 1], names,
    )


def find_matches(symbols: np.ndarray, block: QueryBlock) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All places of the block's windows in a shard: place, window; and for each window
    that occurs, its number and the length of its longest verbatim match in the shard."""
    none = np.zeros(0, np.int64)
    if not len(symbols) or not len(block.starts):
        return none, none, none, none
    order = suffix_array(symbols, 1, int(block.left.max()))
    alive = np.arange(len(block.starts))
    low = np.zeros(len(alive), np.int64)
    high = np.full(len(alive), len(symbols), np.int64)
    found_low, found_high = np.zeros_like(low), np.zeros_like(high)
    longest = np.zeros_like(low)
    depth = 0
    while len(alive):
        alive = alive[block.left[alive] > depth]
        low[alive], high[alive] = narrow(
            symbols, order, low[alive], high[alive], depth, block.symbols[block.starts[alive] + depth]
        )
        alive = alive[low[alive] < high[alive]]
        depth += 1
        longest[alive] = depth
        whole = alive[block.lengths[alive] == depth]
        found_low[whole], found_high[whole] = low[whole], high[whole]
    counts = found_high - found_low
    windows = np.flatnonzero(counts)
    places = order[ranges(found_low[windows], counts[windows])]
    return places, np.repeat(windows, counts[windows]), windows, longest[windows]


def _shards(counts: np.ndarray, overlap: int):
    """Cuts texts of ``counts`` words into shards: lists of (text, first word, words).

    A text of more words than a shard is cut into pieces that overlap by a window
    less one word, so that each window lies whole in a piece.
    """
    shard, size = [], 0
    for text, count in enumerate(counts):
        begin = 0
        while True:
            length = min(count - begin, SHARD_WORDS)
            if size and size + length > SHARD_WORDS:
                yield shard
                shard, size = [], 0
            if length > 0:
                shard.append((text, begin, length))
                size += length + 1
            if begin + length >= count:
                break
            begin += length - overlap
    if shard:
        yield shard


def scan(column: pa.Array, blocks: list, window: int) -> list[pa.Array]:
    data, offsets = text_bytes(column)
    folded = words.fold(data)
    begins, ends, counts = words.word_spans(folded, offsets)
    numbers = words.word_numbers(folded, begins, ends)
    first = np.cumsum(counts) - counts
    hit = np.zeros(len(numbers) + 1, np.int32)
    longest = np.zeros(len(counts), np.int64)
    items: dict[int, set[str]] = {}
    for shard in _shards(counts, window - 1):
        text = np.array([t for t, _, _ in shard])
        length = np.array([n for _, _, n in shard])
        source = first[text] + np.array([b for _, b, _ in shard])
        begin = np.cumsum(length + 1) - (length + 1)
        symbols = np.zeros(int((length + 1).sum()), np.uint64)  # 0 stands between documents
        symbols[ranges(begin, length)] = numbers[ranges(source, length)]
        for broadcast in blocks:
            block: QueryBlock = broadcast.value
            places, window_of, occurring, match = find_matches(symbols, block)
            if len(places):
                piece = np.searchsorted(begin, places, side="right") - 1
                at = source[piece] + places - begin[piece]
                np.add.at(hit, at, 1)
                np.add.at(hit, at + block.lengths[window_of], -1)
                _note_items(items, text[piece], window_of, block)
                reach = np.zeros(len(block.starts), np.int64)
                reach[occurring] = match
                full = _full_length(symbols, places, window_of, reach, block)
                np.maximum.at(longest, text[piece], full)
            if len(blocks) > 1:
                vars(broadcast).pop("_value", None)  # it is read from its file again
    covered = np.cumsum(hit[:-1]) > 0
    inside = np.diff(np.concatenate([[0], covered.astype(np.int8), [0]]))
    inside_at = np.union1d(np.flatnonzero(inside > 0), first[(counts > 0)][covered[first[counts > 0]]])
    owner = np.searchsorted(first + counts, inside_at, side="right")
    stops = np.flatnonzero(inside < 0)
    end = np.minimum(stops[np.searchsorted(stops, inside_at, side="right")] if len(inside_at) else inside_at,
                     (first + counts)[owner])
    rows = np.searchsorted(owner, np.arange(len(counts) + 1))
    hits = pa.ListArray.from_arrays(
        pa.array(rows, pa.int32()),
        pa.StructArray.from_arrays(
            [pa.array(inside_at - first[owner], pa.int64()), pa.array(end - inside_at, pa.int64())],
            fields=list(_HITS.value_type),
        ),
    )
    names = pa.array([sorted(items.get(i, ())) for i in range(len(counts))], pa.list_(pa.string()))
    return [pa.array(counts, pa.int64()), hits, names, pa.array(longest, pa.int64())]


def _note_items(items: dict[int, set[str]], text: np.ndarray, window_of: np.ndarray, block: QueryBlock) -> None:
    pairs = np.unique(np.stack([text, window_of], 1), axis=0)
    owners = block.owner_from[pairs[:, 1] + 1] - block.owner_from[pairs[:, 1]]
    owned = block.owners[ranges(block.owner_from[pairs[:, 1]], owners)]
    for t, i in np.unique(np.stack([np.repeat(pairs[:, 0], owners), owned], 1), axis=0):
        if block.names[i] is not None:
            items.setdefault(int(t), set()).add(block.names[i])


def _full_length(symbols, places, window_of, reach, block) -> np.ndarray:
    """Words that go on matching at each place, up to the longest match of its window."""
    length = block.lengths[window_of].copy()
    moving = np.flatnonzero(length < reach[window_of])
    while len(moving):
        at = places[moving] + length[moving]
        ours = block.symbols[block.starts[window_of[moving]] + length[moving]]
        same = (at < len(symbols)) & (symbols[np.minimum(at, len(symbols) - 1)] == ours)
        moving = moving[same]
        length[moving] += 1
        moving = moving[length[moving] < reach[window_of[moving]]]
    return length


def benchmark_blocks(benchmark: DataFrame, window: int, item: str, text: str, block_bytes: int) -> list:
    """One broadcast for each ``block_bytes`` of benchmark text; items are dealt by hash."""
    spark = benchmark.sparkSession
    rows = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text"))
    rows = rows.where("text is not null").distinct()
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-total // block_bytes))
    out = []
    for number in range(n_blocks):
        part = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)) == number).toArrow()
        texts = part.column("text").combine_chunks() if part.num_rows else pa.array([], pa.string())
        out.append(spark.sparkContext.broadcast(query_block(part.column("item").to_pylist(), texts, window)))
    return out


def with_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` and what of them occurs in the benchmark.

    New columns (each replaces one of the same name): ``n_words``; ``hits``, the
    maximal runs of words covered by a matching window, as (start, length);
    ``items``, the ids of the items concerned, sorted as strings;
    ``longest_match``, the words of the longest verbatim match.

    A window is ``window`` consecutive words of an item; an item of fewer words is
    one window.  A null or empty text has no words and no hits; so has any text if
    the benchmark is empty.  Items with a null text take no part; those without an id
    count for the hits and have no name among ``items``.  Repeated rows each get their
    own, equal, result.
    """
    blocks = benchmark_blocks(benchmark, window, item, item_text, block_bytes)
    return append_columns(docs, lambda batch: scan(batch.column(text), blocks, window), FIELDS)


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents of ``docs`` in which no window of the benchmark occurs."""
    columns = [f"`{c}`" for c in docs.columns]
    text = options.get("text", "text")
    # Under a name of its own, so that no column of the documents is replaced.
    probe = docs.select(F.struct(*columns).alias("row"), F.col(f"`{text}`").alias("probed_text"))
    found = with_matches(probe, benchmark, **(options | {"text": "probed_text"}))
    return found.where(F.size("hits") == 0).select("row.*")
