"""Removal of repeated passages of ``length`` bytes or more, with suffix arrays.

All windows of ``length`` bytes are compared, without listing them all:

1.  Each window has an anchor, the least hash of its ``anchor``-byte substrings.
    Consecutive windows with one anchor form a run.  Equal windows have equal anchors,
    wherever they stand, so a run whose anchor occurs once repeats nothing.  The others
    are counted by anchor and by content; a run whose whole content occurs twice is
    repeated as a whole.
2.  What is left are runs that share an anchor but not the content.  One copy of each
    different content goes to the shard of its anchor.  A shard sorts all suffixes of
    its bytes (Larsson-Sadakane), computes common prefixes (Kasai) and finds windows
    that occur twice.
3.  An anchor with many different contents is dealt over several shards.  Windows at
    about the same distance from the anchor form a block, and all of a block have its
    core in common; blocks whose core is found in one shard alone are done.  Of the
    others the windows' fingerprints are sorted by range, and each shard's are looked
    up among the rest by binary search.

Exact copies are thus settled by hashes, and a shard holds a bounded number of runs
however common a passage is.  Contents are compared by 64-bit hashes within one 64-bit
anchor; suffixes are compared byte by byte.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postmill.llm.common import append_columns, ranges, ship_package, text_bytes, written
from postmill.llm.suffixes import byte_keys, common_prefixes, suffix_array

LENGTH = 400
ANCHOR = 100
#: Contents of runs that are broadcast at most, 16 bytes each.
COMMON = 100_000
#: Bytes whose runs are found together; a longer text is cut, with overlap.
CHUNK = 1 << 20
#: Bytes that a shard sorts together, and different contents of one anchor in a shard.
SHARD_BYTES = 1 << 20
GROUP = 1024

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
KEY = ["k1", "k2"]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    return x


@functools.lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return _mixed((np.arange(1, 257, dtype=np.uint64)) * np.uint64(_BASE))


@functools.lru_cache(maxsize=4)
def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Hashes:
    """Hashes of all substrings of a byte array: polynomials modulo 2**64, mixed."""

    def __init__(self, data: np.ndarray):
        size = 1 << max(10, len(data).bit_length())
        self.inverse = _powers(_INVERSE, size)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_byte_values()[data] * _powers(_BASE, size)[: len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, lengths) -> np.ndarray:
        return _mixed((self.sums[starts + lengths] - self.sums[starts]) * self.inverse[starts])

    def each(self, length: int) -> np.ndarray:
        count = len(self.sums) - length
        return _mixed((self.sums[length:] - self.sums[:count]) * self.inverse[:count])


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values, by running minima of blocks."""
    count = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:count], ahead[width - 1 : width - 1 + count])


def window_runs(data: np.ndarray, offsets: np.ndarray, length: int, anchor: int):
    """Runs of windows with one anchor: first window, windows, anchor, content hash.

    Of equal anchors in a window the leftmost counts, so a run ends where its anchor
    leaves the window, even if an equal one follows; it has as many windows as a window
    has anchors, at most.
    """
    sizes = np.diff(offsets)
    long = np.flatnonzero(sizes >= length)
    none = np.zeros(0, np.int64)
    if not len(long):
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    hashes = Hashes(data)
    values = hashes.each(anchor)
    least = _sliding_least(values, length - anchor + 1)
    windows = ranges(offsets[:-1][long], sizes[long] - length + 1)
    fresh = np.ones(len(windows), bool)
    before = windows[:-1]
    fresh[1:] = (windows[1:] != before + 1) | (least[windows[1:]] != least[before]) | (values[before] == least[before])
    heads = np.flatnonzero(fresh)
    first = windows[heads]
    counts = np.diff(np.append(heads, len(windows)))
    return first, counts, least[first], hashes.of(first, counts + (length - 1))


def _chunks(offsets: np.ndarray, length: int) -> Iterator[list[tuple[int, int, int]]]:
    """Groups of (text, begin, end) of about ``CHUNK`` bytes; pieces of a text overlap by a
    window less one byte, so that each window lies in one piece."""
    group, size = [], 0
    for text in range(len(offsets) - 1):
        begin, end = int(offsets[text]), int(offsets[text + 1])
        while end - begin >= length:
            stop = min(end, begin + CHUNK)
            stop = end if end - stop < length else stop
            group.append((text, begin, stop))
            size += stop - begin
            if size >= CHUNK:
                yield group
                group, size = [], 0
            if stop == end:
                break
            begin = stop - length + 1
    if group:
        yield group


def _runs_of_batch(batch: pa.RecordBatch, length: int, anchor: int) -> Iterator[pa.RecordBatch]:
    data, offsets = text_bytes(batch.column("text"))
    keys = [np.asarray(batch.column(k)) for k in KEY]
    for group in _chunks(offsets, length):
        text, begin, end = (np.array(x) for x in zip(*group, strict=True))
        cuts = np.concatenate([[0], np.cumsum(end - begin)])
        first, counts, least, content = window_runs(data[ranges(begin, end - begin)], cuts, length, anchor)
        piece = np.searchsorted(cuts, first, side="right") - 1
        start = first - cuts[piece] + begin[piece] - offsets[text[piece]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(k[text[piece]]) for k in keys]
            + [pa.array(start), pa.array(counts), pa.array(least.view(np.int64)), pa.array(content.view(np.int64))],
            names=[*KEY, "start", "n", "h", "g"],
        )


def _cut(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the runs listed in ``runs``; of repeated rows that follow each other, once."""
    last = None
    for batch in batches:
        one, two = (np.asarray(batch.column(k)) for k in KEY)
        fresh = np.ones(len(one), bool)
        fresh[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        if len(one):
            fresh[0] = last != (one[0], two[0])
            last = one[-1], two[-1]
        yield from _cut_batch(batch.filter(pa.array(fresh)), length)


def _cut_batch(batch: pa.RecordBatch, length: int) -> Iterator[pa.RecordBatch]:
    data, offsets = text_bytes(batch.column("text"))
    runs = batch.column("runs")
    run = runs.flatten()
    row = np.repeat(np.arange(batch.num_rows), np.asarray(runs.value_lengths()))
    start, count = np.asarray(run.field("start")), np.asarray(run.field("n"))
    sizes = count + length - 1
    step = max(1, (8 << 20) // max(1, int(sizes.max(initial=1))))
    for a in range(0, len(run), step):
        part = slice(a, a + step)
        joined = data[ranges((offsets[row] + start)[part], sizes[part])].tobytes()
        at = np.concatenate([[0], np.cumsum(sizes[part])])
        content = [joined[x:y] for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                *[batch.column(k).take(pa.array(row[part])) for k in KEY],
                *[run.field(name).slice(a, step) for name in ("start", "h", "part", "parts", "copies")],
                pa.array(content, pa.binary()),
            ],
            names=[*KEY, "start", "h", "part", "parts", "copies", "content"],
        )


_CONTENT = "k1 long, k2 long, start long, h long, part int, parts int, copies long, content binary"
_FOUND = "k1 long, k2 long, start long, n long, h long, part int, block long, f1 long, f2 long"
_MARKS = "k1 long, k2 long, start long, h long, part int, f1 long, f2 long"


def _block_width(length: int) -> int:
    return max(1, length // 12)


def _two_hashes(hashes: Hashes, starts: np.ndarray, length: int) -> tuple[pa.Array, pa.Array]:
    """128 bits for each substring: of the whole, and of two parts that cover it."""
    one = hashes.of(starts, length)
    two = hashes.of(starts, length // 2) + hashes.of(starts + length // 3, length - length // 3)
    return pa.array(one.view(np.int64)), pa.array(two.view(np.int64))


def _anchor_places(hashes: Hashes, starts: np.ndarray, ends: np.ndarray, h: np.ndarray, anchor: int) -> np.ndarray:
    """Where the anchor of each run stands: the first place of its hash."""
    values = hashes.each(anchor)
    wanted = np.repeat(h.view(np.uint64), ends - starts)[: len(values)]
    places = np.flatnonzero(values == wanted)
    return places[np.searchsorted(places, starts)]


def _shard(rows: pa.Table, length: int, anchor: int) -> pa.Table:
    """Repeated windows among some runs, as rows of ``_FOUND``.

    Rows with ``n`` are repeated windows, by runs; of runs that are repeated anyway
    none are given.  Rows with ``block`` are the blocks of runs under a divided anchor,
    with the hashes of their cores.
    """
    rows = _unrepeated(rows)
    column = rows.column("content").combine_chunks().cast(pa.large_binary())
    buffers = column.buffers()
    cuts = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8)[cuts[0] : cuts[-1]]
    cuts = cuts - cuts[0]
    starts, ends = cuts[:-1], cuts[1:]
    order = suffix_array(byte_keys(data), 8, len(data) + 8)  # Kasai's rule needs the whole order
    shared = common_prefixes(data, order, starts, ends, length)
    group = np.cumsum(shared < length) - 1  # the first place shares nothing
    run = np.repeat(np.arange(len(starts)), ends - starts)
    whole = np.repeat(ends, ends - starts) - np.arange(len(data)) >= length  # a window starts here
    of_place = np.empty(len(data), np.int64)
    of_place[order] = group
    size = np.bincount(of_place[whole], minlength=len(data))
    repeated = whole & (size[of_place] > 1)
    once = np.asarray(rows.column("copies")) == 1
    take = lambda name, index: rows.column(name).combine_chunks().take(pa.array(index))

    new = repeated & once[run]
    begins = new.copy()
    begins[1:] &= ~(new[:-1] & (run[1:] == run[:-1]))
    head = np.flatnonzero(begins)
    counts = np.diff(np.append(np.searchsorted(np.flatnonzero(new), head), int(new.sum())))
    at = np.asarray(rows.column("start"))[run[head]] + head - starts[run[head]]
    none = pa.nulls(len(head), pa.int64())
    parts = [take("part", run[head])]
    out = [[take("k1", run[head]), take("k2", run[head]), pa.array(at), pa.array(counts), take("h", run[head]),
            *parts, none, none, none]]

    divided = np.flatnonzero(np.asarray(rows.column("parts")) > 1)
    if len(divided):
        hashes, width = Hashes(data), _block_width(length)
        place = _anchor_places(hashes, starts, ends, np.asarray(rows.column("h")), anchor)[divided]
        farthest = place - starts[divided]
        nearest = farthest - (ends - starts)[divided] + length
        first = nearest // width
        counts = farthest // width - first + 1
        owner, block = np.repeat(divided, counts), ranges(first, counts)
        core = np.repeat(place, counts) - block * width
        out.append([take("k1", owner), take("k2", owner), take("start", owner), pa.nulls(len(owner), pa.int64()),
                    take("h", owner), take("part", owner), pa.array(block),
                    *_two_hashes(hashes, core, length - width + 1)])
    names = ["k1", "k2", "start", "n", "h", "part", "block", "f1", "f2"]
    return pa.concat_tables([pa.Table.from_arrays(columns, names=names) for columns in out])


def _mark(batch: pa.RecordBatch, length: int, anchor: int) -> pa.RecordBatch:
    """The windows of the listed blocks of runs, each with its place and two hashes."""
    data, cuts = text_bytes(batch.column("content"))
    starts, ends, width = cuts[:-1], cuts[1:], _block_width(length)
    hashes = Hashes(data)
    place = _anchor_places(hashes, starts, ends, np.asarray(batch.column("h")), anchor)
    listed = batch.column("blocks")
    row = np.repeat(np.arange(batch.num_rows), np.asarray(listed.value_lengths()))
    block = np.asarray(listed.flatten())
    # The windows of a block that lie in the run.
    low = np.maximum(place[row] - block * width - width + 1, starts[row])
    high = np.minimum(place[row] - block * width, ends[row] - length)
    window = ranges(low, high - low + 1)
    owner = np.repeat(row, high - low + 1)
    at = np.asarray(batch.column("start"))[owner] + window - starts[owner]
    one, two = _two_hashes(hashes, window, length)
    # Rows of one shard lie together here: of its equal windows one is enough.
    h, part = np.asarray(batch.column("h"))[owner], np.asarray(batch.column("part"))[owner]
    columns = [h, part, np.asarray(one), np.asarray(two)]
    by = np.lexsort(columns)
    fresh = np.ones(len(by), bool)
    fresh[1:] = np.any([c[by][1:] != c[by][:-1] for c in columns], axis=0)
    kept = pa.array(by[fresh])
    rows = pa.array(owner).take(kept)
    return pa.RecordBatch.from_arrays(
        [batch.column("k1").take(rows), batch.column("k2").take(rows), pa.array(at).take(kept),
         pa.array(h).take(kept), pa.array(part).take(kept), one.take(kept), two.take(kept)],
        names=["k1", "k2", "start", "h", "part", "f1", "f2"],
    )


def _marks(batches: Iterator[pa.RecordBatch], length: int, anchor: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, GROUP):
            yield _mark(batch.slice(begin, GROUP), length, anchor)


def _unrepeated(rows: pa.Table) -> pa.Table:
    """Without rows of the place of the row before."""
    places = [np.asarray(rows.column(c)) for c in (*KEY, "start", "h")]
    fresh = np.ones(rows.num_rows, bool)
    fresh[1:] = np.any([p[1:] != p[:-1] for p in places], axis=0)
    return rows.filter(pa.array(fresh))


def _shards(batches: Iterator[pa.RecordBatch], length: int, anchor: int) -> Iterator[pa.RecordBatch]:
    """Sorts whole groups (anchor and part) of the ordered rows together, up to ``SHARD_BYTES``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.column("content").nbytes for b in held) < SHARD_BYTES:
            continue
        table = pa.Table.from_batches(held)
        groups = _group_numbers(table)
        sizes = np.cumsum(np.asarray(pc.binary_length(table.column("content"))))
        begin = 0
        last = np.searchsorted(groups, groups[-1])  # the last group may go on in the next batch
        while begin < last:
            limit = np.searchsorted(sizes, (sizes[begin - 1] if begin else 0) + SHARD_BYTES)
            end = int(min(last, max(np.searchsorted(groups, groups[min(limit, len(groups) - 1)]),
                                    np.searchsorted(groups, groups[begin], side="right"))))
            yield from _shard(table.slice(begin, end - begin), length, anchor).to_batches()
            begin = end
        held = table.slice(begin).combine_chunks().to_batches()
    if held and sum(b.num_rows for b in held):
        yield from _shard(pa.Table.from_batches(held), length, anchor).to_batches()


def _group_numbers(table: pa.Table) -> np.ndarray:
    h, part = np.asarray(table.column("h")), np.asarray(table.column("part"))
    return np.concatenate([[0], np.cumsum((h[1:] != h[:-1]) | (part[1:] != part[:-1]))])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows that also stand in another shard of their anchor; rows come ordered by ``f1``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        table = pa.Table.from_batches(held)
        f1 = np.asarray(table.column("f1"))
        whole = int(np.searchsorted(f1, f1[-1])) if len(f1) else 0
        if whole:
            yield from _merged(table.slice(0, whole))
            held = table.slice(whole).combine_chunks().to_batches()
    if held and sum(b.num_rows for b in held):
        yield from _merged(pa.Table.from_batches(held))


def _merged(table: pa.Table) -> Iterator[pa.RecordBatch]:
    f1, f2, h = (np.asarray(table.column(c)) for c in ("f1", "f2", "h"))
    shard = np.asarray(table.column("part"))
    found = np.zeros(len(f1), bool)
    for own in np.unique(shard):
        mine = np.flatnonzero(shard == own)
        low, high = np.searchsorted(f1, f1[mine], side="left"), np.searchsorted(f1, f1[mine], side="right")
        for step in range(int((high - low).max(initial=0))):
            other = np.minimum(low + step, high - 1)
            found[mine] |= (other != mine) & (f2[other] == f2[mine]) & (h[other] == h[mine])
    new = table.filter(pa.array(found))
    ones = pa.array(np.ones(new.num_rows, np.int64))
    yield from pa.Table.from_arrays(
        [new.column("k1"), new.column("k2"), new.column("start"), ones], names=["k1", "k2", "start", "n"]
    ).to_batches()


def repeated_windows(texts: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, group: int = GROUP) -> DataFrame:
    """Runs (``k1``, ``k2``, ``start``, ``n``) of repeated windows of keyed texts.

    ``texts`` has the two-part key of a row, equal for repeated rows alone, and ``text``.
    """
    ship_package(texts.sparkSession)
    runs = written(
        texts.where(F.octet_length("text") >= length).mapInArrow(
            lambda batches: (out for batch in batches for out in _runs_of_batch(batch, length, anchor)),
            "k1 long, k2 long, start long, n long, h long, g long",
        )
    )
    # Each side of a join is a stored table, so that Spark can split a common anchor's rows.
    anchors = written(
        runs.groupBy("h")
        .agg(F.count("*").alias("c"), (F.min("g") != F.max("g")).alias("differ"))
        .where("c > 1")
        .select("h", "differ")
    )
    shared = written(runs.join(anchors, "h"))
    contents = written(
        shared.where("differ").groupBy("h", "g").agg(
            F.count("*").alias("copies"), F.min(F.struct(*KEY, "start", "n")).alias("at")
        )
    )
    # A content that many runs share is met by broadcast: shares of the runs sum to one, so at
    # most COMMON contents have one part in so many.  None of the others is hot in its shuffle.
    total = contents.agg(F.sum("copies")).first()[0] or 0
    copied, often = contents.where("copies > 1"), F.col("copies") * COMMON >= total
    common = F.broadcast(copied.where(often).select("h", "g"))
    differing = shared.where("differ")
    rare = differing.join(common, ["h", "g"], "left_anti").join(
        copied.where(~often).select("h", "g").hint("merge"), ["h", "g"], "left_semi"
    )
    settled = shared.where("not differ").select(*KEY, "start", "n").union(
        differing.join(common, ["h", "g"], "left_semi").select(*KEY, "start", "n")
    ).union(rare.select(*KEY, "start", "n"))
    crowded = written(
        contents.groupBy("h")
        .agg(F.ceil(F.count("*") / F.lit(group)).cast("int").alias("parts"))
        .where("parts > 1")
    )
    placed = contents.join(crowded, "h", "left").select(
        "at.*",
        "h",
        "copies",
        F.coalesce("parts", F.lit(1)).alias("parts"),
        F.coalesce(F.pmod(F.xxhash64("g"), F.col("parts")).cast("int"), F.lit(0)).alias("part"),
    )
    wanted = written(
        placed.groupBy(*KEY).agg(
            F.collect_list(F.struct("start", "n", "h", "part", "parts", "copies")).alias("runs")
        )
    )
    cut = written(texts.join(wanted, KEY).mapInArrow(lambda batches: _cut(batches, length), _CONTENT))
    found = written(
        cut.repartition("h", "part")
        .sortWithinPartitions("h", "part", *KEY, "start")
        .mapInArrow(lambda batches: _shards(batches, length, anchor), _FOUND)
    )
    # Cores that stand in several shards of their anchor, and the runs that hold them.
    core = ["h", "block", "f1", "f2"]
    blocks = found.where("block is not null")
    common = written(
        blocks.groupBy(*core).agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a < b").select(*core)
    )
    held = written(
        blocks.join(common, core).groupBy(*KEY, "start", "h").agg(F.collect_set("block").alias("blocks"))
    )
    marks = (
        cut.where("parts > 1")
        .join(held, [*KEY, "start", "h"])
        .select(*KEY, "start", "h", "part", "blocks", "content")
        .repartition("h", "part")
        .sortWithinPartitions("h", "part")
        .mapInArrow(lambda batches: _marks(batches, length, anchor), _MARKS)
    )
    # One window of each content in each shard: if there are more, the shard has found them.
    single = marks.groupBy("h", "part", "f1", "f2").agg(F.min(F.struct(*KEY, "start")).alias("at"))
    merged = (
        single.select("at.*", "h", "part", "f1", "f2")
        .repartitionByRange("f1")
        .sortWithinPartitions("f1")
        .mapInArrow(_merge, "k1 long, k2 long, start long, n long")
    )
    return settled.union(found.where("n is not null").select(*KEY, "start", "n")).union(merged)


FIELDS = [
    T.StructField("n_bytes", T.LongType()),
    T.StructField("removed", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType())]))),
    T.StructField("kept", T.BinaryType()),
]
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))


def _remove(batch: pa.RecordBatch, length: int) -> list[pa.Array]:
    data, offsets = text_bytes(batch.column("text"))
    runs = batch.column("runs")
    spans, kept = [], []
    for i in range(batch.num_rows):
        own = data[offsets[i] : offsets[i + 1]]
        if not runs[i].is_valid:
            spans.append([])
            kept.append(own.tobytes())
            continue
        values = runs[i].values
        start, count = np.asarray(values.field("start")), np.asarray(values.field("n"))
        depth = np.zeros(len(own) + 1, np.int64)
        np.add.at(depth, start, 1)
        np.add.at(depth, start + count + length - 1, -1)
        gone = np.cumsum(depth[:-1]) > 0
        edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
        spans.append([{"start": int(a), "length": int(b - a)} for a, b in zip(edge[::2], edge[1::2], strict=True)])
        kept.append(own[~gone].tobytes())
    return [pa.array(np.diff(offsets), pa.int64()), pa.array(spans, _SPANS), pa.array(kept, pa.binary())]


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, anchor: int = ANCHOR,
    group: int = GROUP,
) -> DataFrame:
    """``docs`` and ``n_bytes``, ``removed`` (maximal runs of bytes) and ``kept`` (the other bytes).

    A byte goes if a string of ``length`` bytes that covers it also starts anywhere
    else, in the same text or another; strings overlap, never cross texts, and are
    judged on the input.  A null text is empty and keeps nothing.  Repeated rows repeat
    each other.  New columns replace those of their names.
    """
    if not 0 < anchor <= length:
        raise ValueError("the anchor must be a part of the window")
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    key = [F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")), value]
    others = [c for c in docs.columns if c != text]
    keyed = docs.select(
        F.xxhash64(*key).alias("k1"),
        F.xxhash64(*key[::-1], F.lit(1)).alias("k2"),
        value.alias("text"),
        F.col(f"`{text}`").isNull().alias("absent"),
        F.struct(*[F.col(f"`{c}`") for c in others], F.lit(0).alias("__")).alias("row"),
    )
    runs = repeated_windows(keyed.select(*KEY, "text"), length, anchor, group)
    by_row = written(runs.groupBy(*KEY).agg(F.collect_set(F.struct("start", "n")).alias("runs")))
    joined = keyed.join(by_row, KEY, "left").select("row", "text", "absent", "runs")
    found = append_columns(joined, lambda batch: _remove(batch, length), FIELDS)
    new = {field.name for field in FIELDS}
    columns = [
        F.when(~F.col("absent"), F.col("text")).alias(c) if c == text else F.col(f"row.`{c}`")
        for c in docs.columns
        if c.lower() not in new
    ]
    return found.select(*columns, *sorted(new, key=[f.name for f in FIELDS].index))
