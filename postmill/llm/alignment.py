"""Alignment of two tokenizers' tokens over the same bytes, by merge paths.

Both tokenizers cut a text into tokens, so a text has two rising lists of byte offsets
where tokens end.  Their merge is divided at equally spaced diagonals: a binary search
on each says how many ends of either list lie before it.  The pieces between diagonals
are merged independently, with equal work whatever the texts are; each gives out the
overlaps of A and B tokens in it.  Overlaps up to a common end are one group; the groups
that a piece begins or leaves open are stitched to those of its neighbours.

Links (the two tokens that end at a common end) are counted for each pair of ids over
the whole corpus.  The counts meet the documents' pairs in a broadcast of at most
``BROADCAST_PAIRS`` rows: all pairs where they are that few, else those of the largest
shares; the others, none of which can be frequent, are shuffled.
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

from postmill.llm import packing
from postmill.llm.common import append_columns, arrow_batches, ranges, written

#: Ends of both lists that one piece merges.
PIECE = 1 << 16
#: Characters of text that are aligned together; a longer text stands alone.
BATCH_CHARS = 1 << 20
#: Words whose tokens a worker remembers before it begins anew.
CACHE_WORDS = 100_000
#: Rows that a worker is handed together: whole texts lie in buffers on both sides of its pipe.
BATCH_ROWS = 500
#: Pairs of ids that are broadcast at most, 16 bytes each and their hash table.
BROADCAST_PAIRS = 1_000_000

MARK = "▁"

FIELDS = [
    T.StructField("n_a", T.LongType()),
    T.StructField("n_b", T.LongType()),
    T.StructField("groups", T.StringType()),
    T.StructField("n_groups", T.LongType()),
    T.StructField(
        "links",
        T.ArrayType(T.StructType([T.StructField(c, T.IntegerType(), False) for c in ("a", "b", "n")]), False),
    ),
]


def diagonals(a: np.ndarray, b: np.ndarray, size: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """How many ends of ``a`` and of ``b`` lie before each diagonal of the merge.

    The diagonals are ``size`` steps apart; all are searched at the same time.  Of two
    equal ends that of ``a`` goes first.
    """
    total = len(a) + len(b)
    steps = np.append(np.arange(0, total, size), total)
    low, high = np.maximum(0, steps - len(b)), np.minimum(steps, len(a))
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low, steps - low
        middle = (low[open_] + high[open_]) // 2
        first = a[middle] <= b[steps[open_] - 1 - middle]
        low[open_[first]] = middle[first] + 1
        high[open_[~first]] = middle[~first]


def overlaps(a: np.ndarray, b: np.ndarray, i0: int, i1: int, j0: int, j1: int) -> tuple[np.ndarray, ...]:
    """Overlapping tokens of one piece in their order: ``i``, ``j``, and whether both end there.

    Each end closes the bytes since the end before it, which lie in one A token and one
    B token.  An end of ``b`` that equals one of ``a`` closes none: that of ``a`` has done so.
    """
    mine, yours = a[i0:i1], b[j0:j1]
    below = np.searchsorted(yours, mine)
    j = j0 + below
    both = b[j] == mine  # both lists end at the same byte, so there is a B end at or after it
    above = np.searchsorted(mine, yours)
    i = i0 + above
    equal = (a[np.minimum(i, len(a) - 1)] == yours) | ((i > 0) & (a[i - 1] == yours))
    alone = np.flatnonzero(~equal)
    before = np.concatenate([[0], np.cumsum(~equal)])
    n = len(mine) + len(alone)
    out_i, out_j, out_both = np.empty(n, np.int64), np.empty(n, np.int64), np.zeros(n, bool)
    at = np.arange(len(mine)) + before[below]
    out_i[at], out_j[at], out_both[at] = np.arange(i0, i1), j, both
    at = before[alone] + above[alone]
    out_i[at], out_j[at] = i[alone], j0 + alone
    return out_i, out_j, out_both


def merged(a: np.ndarray, b: np.ndarray, size: int = PIECE) -> tuple[np.ndarray, ...]:
    """The overlaps of all pieces, and the number of each one's group."""
    i_cut, j_cut = diagonals(a, b, size)
    pieces = [
        overlaps(a, b, *cut)
        for cut in zip(i_cut[:-1].tolist(), i_cut[1:].tolist(), j_cut[:-1].tolist(), j_cut[1:].tolist(), strict=True)
    ]
    if not pieces:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    # A group that is open at the end of a piece goes on in the next: its number is the
    # count of groups closed in earlier pieces and, in the piece, before the overlap.
    closed, group = 0, []
    for _, _, both in pieces:
        ended = np.cumsum(both)
        group.append(closed + ended - both)
        closed += int(ended[-1]) if len(ended) else 0
    i, j, _ = (np.concatenate(x) for x in zip(*pieces, strict=True))
    return i, j, np.concatenate(group)


class _Plain(packing.Encoder):
    """Special tokens' strings are ordinary text."""

    def __init__(self, path: str):
        super().__init__(path)
        self.tokenizer.encode_special_tokens = True


@functools.lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> Aligner:
    """One for each worker process, which keeps the words it has met."""
    return Aligner(a_path, b_path)


class Aligner:
    """Tokens of both kinds of columns of whole texts, and their groups.

    Neither tokenizer merges across a single space between two characters that are not
    white space (the pieces of the second have marks at their begin only, which is
    checked), so regular texts are taken word by word, and words are remembered.
    Other texts go to both tokenizers whole.
    """

    def __init__(self, a_path: str, b_path: str):
        from sentencepiece import SentencePieceProcessor

        self.a = _Plain(a_path)
        self.b = SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.b_widths = np.array([len(x) for x in self.b_bytes])
        self.by_words = not any(MARK in p.lstrip(MARK) for p in pieces)
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        names = {chr(b): b for b in plain}
        names |= {chr(0x100 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
        a_names = [self.a.tokenizer.id_to_token(i) or "" for i in range(self.a.tokenizer.get_vocab_size())]
        self.a_bytes = [bytes(names[c] for c in name if c in names) for name in a_names]
        self.a_widths = np.array([len(x) for x in self.a_bytes])
        self.digits = _digits(max(len(self.a_bytes), len(self.b_bytes)))
        #: Word to the A ids, the B ids and whether both spell it.
        self.known: dict[str, tuple[bytes, bytes, bool]] = {}

    def _spelled(self, text: str, a_ids: list[int], b_ids: list[int]) -> bool:
        wanted = (" " + text).encode()
        return b"".join(map(self.a_bytes.__getitem__, a_ids)) == wanted == b"".join(map(self.b_bytes.__getitem__, b_ids))

    def _pair(self, text: str, a: bytes, b_ids: list[int]) -> tuple[bytes, bytes, bool]:
        good = self._spelled(text, np.frombuffer(a, "<u4").tolist(), b_ids)
        return a, np.array(b_ids, "<u4").tobytes(), good

    def learn(self, words: list[str]) -> None:
        """Both tokenizers' ids of words that each stand after one space."""
        self.a.learn(words)
        for word, b_ids in zip(words, self.b.encode(words, num_threads=1), strict=True):
            self.known[word] = self._pair(word, self.a.known.pop(word), b_ids)

    def tokens(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A ids and B ids of all texts, and the n + 1 places in each where those of a text begin.

        Texts that are null, empty or not spelled by both kinds of tokens have none.
        """
        column = pc.fill_null(column.cast(pa.large_string()), "")
        odd = np.asarray(pc.match_substring_regex(column, self.a.odd)) | (not self.by_words)
        n = len(column)
        if len(self.known) > CACHE_WORDS:
            self.known = {}
        parted = pc.split_pattern(column.filter(pa.array(~odd)), " ")
        offsets = np.asarray(parted.offsets)
        coded = parted.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        self.learn([word for word in words if word not in self.known])
        entries = [self.known[word] for word in words]
        # Whole odd texts are further entries, each used once.
        for row in np.flatnonzero(odd).tolist():
            text = column[row].as_py()
            if text:
                a = np.array(self.a.tokenizer.encode(" " + text, add_special_tokens=False).ids, "<u4").tobytes()
                entries.append(self._pair(text, a, self.b.encode(text, num_threads=1)))
            else:
                entries.append((b"", b"", True))
        good = np.array([e[2] for e in entries], bool)
        index = np.asarray(coded.indices).astype(np.int64)
        per_text = np.ones(n, np.int64)
        per_text[~odd] = np.diff(offsets)
        begins = np.concatenate([[0], np.cumsum(per_text)])
        used = np.empty(begins[-1], np.int64)
        used[ranges(begins[:-1][~odd], per_text[~odd])] = index
        used[begins[:-1][odd]] = np.arange(len(words), len(entries))
        spelled = np.add.reduceat(~good[used], begins[:-1]) == 0 if n else np.zeros(0, bool)
        keep = np.repeat(spelled, per_text)
        out = []
        for kind in (0, 1):
            blobs = [e[kind] for e in entries]
            flat = np.frombuffer(b"".join(blobs), "<u4")
            counts = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4
            starts = np.cumsum(counts) - counts
            lengths = np.where(keep, counts[used], 0)
            ids = flat[ranges(starts[used], lengths)]
            out += [ids, np.concatenate([[0], np.cumsum(lengths)])[begins]]
        return out[0], out[2], out[1], out[3]

    def align(self, column: pa.Array) -> list[pa.Array]:
        """The columns ``FIELDS`` of a column of texts."""
        a_ids, b_ids, a_from, b_from = self.tokens(column)
        n = len(column)
        # All texts are one merge: the end of each text is an end of both lists.
        a_ends, b_ends = np.cumsum(self.a_widths[a_ids]), np.cumsum(self.b_widths[b_ids])
        i, j, group = merged(a_ends, b_ends)
        last = np.flatnonzero(np.append(np.diff(group), 1)) if len(group) else np.zeros(0, np.int64)
        a_last, b_last = i[last], j[last]  # the tokens that end a group: its link
        group_from = np.searchsorted(a_last, a_from)  # groups that end before each text
        n_groups = np.diff(group_from)
        texts = self._texts(a_ids, b_ids, a_last, b_last, group_from)
        document = np.repeat(np.arange(n), n_groups)
        links = _counted(document, a_ids[a_last].astype(np.int64), b_ids[b_last].astype(np.int64), n)
        return [pa.array(np.diff(a_from)), pa.array(np.diff(b_from)), texts, pa.array(n_groups), links]

    def _texts(self, a_ids, b_ids, a_last, b_last, group_from) -> pa.Array:
        """``a1,a2|b1;a3|b2,b3`` of each text: ids as digits, written into one buffer."""
        n_groups = len(a_last)
        if not n_groups:
            return pa.array([""] * (len(group_from) - 1), pa.string())
        # A group's A ids stand after the B ids of all groups before it, and so on.
        a_counts, b_counts = np.diff(a_last, prepend=-1), np.diff(b_last, prepend=-1)
        b_before = b_last + 1 - b_counts
        place_a = np.arange(len(a_ids)) + np.repeat(b_before, a_counts)
        place_b = np.arange(len(b_ids)) + np.repeat(a_last + 1, b_counts)
        total = len(a_ids) + len(b_ids)
        ids = np.empty(total, np.int64)
        ids[place_a], ids[place_b] = a_ids, b_ids
        marks = np.full(total, ord(","), np.uint8)
        marks[place_a[a_last]] = ord("|")
        ends = place_b[b_last]
        marks[ends] = ord(";")
        table, widths = self.digits
        cells = np.concatenate([table[ids], marks[:, None]], axis=1)
        shown = np.concatenate(
            [np.arange(table.shape[1])[None, :] < widths[ids][:, None], np.ones((total, 1), bool)], axis=1
        )
        data = cells[shown]
        reached = np.concatenate([[0], np.cumsum(widths[ids] + 1)])
        # A text's bytes end before the mark of its last group, which is left out.
        group_end = np.concatenate([[0], reached[ends + 1]])
        begin, end = group_end[group_from[:-1]], group_end[group_from[1:]]
        lengths = np.maximum(end - begin - 1, 0)
        kept = np.ones(len(data), bool)
        kept[end[end > begin] - 1] = False
        buffer = data[kept].tobytes()
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        return pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(buffer)).cast(pa.string())


def _digits(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of the numbers below ``size``, left-aligned, and how many each has."""
    width = len(str(max(size - 1, 0)))
    numbers = np.arange(size).astype(f"S{width}")
    return numbers.view(np.uint8).reshape(size, width), np.char.str_len(numbers)


def _counted(document: np.ndarray, a: np.ndarray, b: np.ndarray, n: int) -> pa.Array:
    """Distinct pairs of each text and how often each stands in it, as a list array."""
    order = np.lexsort((b, a, document)) if (n << 34) >> 62 else np.argsort((document << 34) | (a << 17) | b, kind="stable")
    d, a, b = document[order], a[order], b[order]
    new = np.ones(len(d), bool)
    new[1:] = (np.diff(d) != 0) | (np.diff(a) != 0) | (np.diff(b) != 0)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(d)))
    offsets = np.concatenate([[0], np.cumsum(np.bincount(d[first], minlength=n))]).astype(np.int32)
    cells = [pa.array(x.astype(np.int32)) for x in (a[first], b[first], count)]
    fields = [pa.field(c, pa.int32(), False) for c in ("a", "b", "n")]
    values = pa.StructArray.from_arrays(cells, fields=fields)
    return pa.ListArray.from_arrays(pa.array(offsets), values).cast(pa.list_(pa.field("element", values.type, False)))


def _parts(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Cuts a batch into parts of about ``BATCH_CHARS`` characters; a longer text is a part."""
    sizes = np.asarray(pc.fill_null(pc.utf8_length(batch.column(batch.schema.get_field_index(text))), 0))
    number = (np.cumsum(sizes, dtype=np.int64) - 1) // BATCH_CHARS
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(number)) + 1, [len(sizes)]]).tolist()
    return (batch.slice(x, y - x) for x, y in zip(cuts[:-1], cuts[1:], strict=True) if y > x)


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """``docs`` and the groups of both tokenizers' tokens; no shuffle.

    New columns, each in the place of one of its name (whatever the case): ``n_a`` and
    ``n_b``, the tokens of both kinds; ``groups``, the ids of all groups as
    ``a1,a2|b1;a3|b2,b3``; ``n_groups``; ``links``, the distinct pairs (a, b) of ids
    whose tokens end together and their number ``n``.

    A is a byte-level BPE file read as ``space + text``, B a piece model that adds the
    space itself.  Texts that are null, empty, or not spelled back by the tokens of
    both, have no tokens, no groups and no links.  An empty table gives no rows,
    repeated rows have equal results; whole texts are aligned, however long.  Memory is
    in proportion to the longest text.  Both vocabularies hold fewer than 2**17 ids.
    """

    def made(batch: pa.RecordBatch) -> list[pa.Array]:
        return aligner(a_path, b_path).align(batch.column(batch.schema.get_field_index(text)))

    return append_columns(docs, made, FIELDS, lambda batch: _parts(batch, text))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``a``, ``b``, ``n`` (the pair's links in the whole corpus) and ``best``: no pair of the
    same ``b`` has more.  ``aligned`` has the column ``links``."""
    links = aligned.select(F.inline("links"))
    counts = written(links.groupBy("a", "b").agg(F.sum("n").alias("n")))
    # One row for each B id: no more than its vocabulary has.
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(F.broadcast(most), "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def with_link_counts(aligned: DataFrame, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """``aligned`` and ``n_links``, ``n_best`` and ``count_sum`` in the place of ``links``.

    ``count_sum`` is the sum of the corpus-wide counts over a document's links, and
    ``n_best`` the number of links whose count is the highest of their B id.  A new
    column replaces one of its name.  Rows without links have zeros; rows need no key.
    """
    new = {"links", "n_links", "n_best", "count_sum", "__row"}
    kept = [f"`{c}`" for c in aligned.columns if c.lower() not in new]
    with arrow_batches(aligned.sparkSession, BATCH_ROWS):
        stored = written(aligned.select(*kept, "links", F.monotonically_increasing_id().alias("__row")))
    counts = written(pair_counts(stored))
    n_pairs, total = counts.agg(F.count("*"), F.sum("n")).first()
    key = F.shiftleft(F.col("a").cast("long"), 32) + F.col("b")
    counted = counts.select(key.alias("key"), F.col("n").alias("count"), "best")
    links = stored.select("__row", F.inline("links")).select("__row", key.alias("key"), "n")
    if n_pairs <= broadcast_pairs:
        met = links.join(F.broadcast(counted), "key")
    else:
        # Shares sum to one, so at most ``broadcast_pairs`` pairs have one part in so many.
        frequent = F.col("count") * broadcast_pairs >= total
        near = links.join(F.broadcast(counted.where(frequent)), "key")
        far = links.join(F.broadcast(counted.where(frequent).select("key")), "key", "left_anti")
        met = near.unionByName(far.join(counted.where(~frequent).hint("merge"), "key"))
    per_row = met.groupBy("__row").agg(
        F.sum("n").alias("__links"),
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("__best"),
        F.sum(F.col("n") * F.col("count")).alias("__sum"),
    )

    def number(source: str, name: str):
        return F.coalesce(source, F.lit(0)).cast("long").alias(name)

    joined = stored.drop("links").join(per_row, "__row", "left")
    return joined.select(*kept, number("__links", "n_links"), number("__best", "n_best"), number("__sum", "count_sum"))
