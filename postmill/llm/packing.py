"""Packing by power-of-two decomposition.

A document's token ids, ended by a separator, are cut into pieces whose lengths are
powers of two: as many of the longest as fit, then the binary digits of the rest.
Each piece is a sequence of its own, so no sequence crosses documents and none needs
padding; batches are made of one bucket, that is, of sequences of one length.

Cutting is local to a document: there is no shuffle, and a recomputed task makes the
same pieces again.
"""

from __future__ import annotations

import functools
import itertools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from postmill.llm.common import ranges, ship_package

MAX_LENGTH = 1024
SEPARATOR = 0
#: Words that a worker remembers before it begins anew; about 100 MB.
CACHE_WORDS = 600_000
#: Characters of new words that are tokenised at a time.
JOINED_CHARS = 1 << 17
#: Characters of text that are tokenised, and given out, together.
BATCH_CHARS = 4 << 20

PIECE_FIELDS = [
    T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("ids", T.BinaryType()),
    T.StructField("doc_tokens", T.LongType()),
    T.StructField("bucket", T.IntegerType()),
    T.StructField("sequence_id", T.LongType()),
    T.StructField("offset", T.LongType()),
]


#: Two characters of white space together, or one at an edge, by the widest notion of it.
_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200d}\x{2028}\x{2029}\x{202f}\x{205f}\x{2060}\x{3000}\x{feff}]"
_RUNS = f"{_SPACE}{_SPACE}|^{_SPACE}|{_SPACE}$|^$"


#: How byte-level BPE parts a text before merging (fixed by the published vocabulary).
_PARTS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _ranked(path: str):
    """The same merges by a faster library, or None unless the file allows it.

    It merges by the number of the token that a merge makes, which is the same where
    these numbers rise from merge to merge.  Used for joined new words only.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, parting = spec["model"], spec.get("pre_tokenizer") or {}
    made = [model["vocab"].get("".join(m.split(" ") if isinstance(m, str) else m), -1) for m in model.get("merges", [])]
    regular = (
        spec.get("normalizer") is None
        and parting.get("type") == "ByteLevel"
        and not parting.get("add_prefix_space")
        and parting.get("use_regex", True)
        and all(a < b for a, b in itertools.pairwise(made))
    )
    if not regular:
        return None
    # A byte is named by itself where it is printable, by the next free character else.
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    names = {chr(b): b for b in plain}
    names |= {chr(0x100 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
    special = {token["content"] for token in spec.get("added_tokens", [])}
    ranks = {bytes(names[c] for c in word): i for word, i in model["vocab"].items() if word not in special}
    return tiktoken.Encoding("words", pat_str=_PARTS, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One for each worker process, which keeps the words it has met."""
    return Encoder(path)


class Encoder:
    """Token ids of columns of whole texts.

    Byte-level BPE cuts a text before each single space between two characters that
    are not white space, and never merges across a cut.  Texts without longer runs
    of white space are therefore taken word by word: the different words of a column
    are tokenised once, joined to long texts, and remembered.  Other texts, and those
    that hold a special token, go to the tokenizer one by one.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = "|".join([_RUNS, *map(re.escape, special)])
        size = self.tokenizer.get_vocab_size()
        #: Bytes that each token stands for: one character of its name is one byte.
        self.widths = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(size)])
        self.known: dict[str, bytes] = {}
        self.joined = _ranked(path) or (lambda text: self.tokenizer.encode(text, add_special_tokens=False).ids)

    def ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, words: list[str]) -> None:
        """Tokenises words, each after a space; many at a time, cut by their bytes."""
        batch, size = [], 0
        for i, word in enumerate(words):
            batch.append(word)
            size += len(word) + 1
            if size >= JOINED_CHARS or i == len(words) - 1:
                ids = np.array(self.joined(" " + " ".join(batch)), "<u4")
                reached = np.cumsum(self.widths[ids])
                wanted = np.cumsum([len(w.encode()) + 1 for w in batch])
                cuts = np.searchsorted(reached, wanted) + 1
                if not np.array_equal(reached[cuts - 1], wanted):
                    raise ValueError("the tokenizer does not cut texts at single spaces")
                stream, at = ids.tobytes(), 0
                for w, cut in zip(batch, cuts.tolist(), strict=True):
                    self.known[w] = stream[4 * at : 4 * cut]
                    at = cut
                batch, size = [], 0

    def streams(self, column: pa.Array) -> list[bytes]:
        """The ids of each text, as little-endian 32-bit numbers; null is an empty text."""
        column = pc.fill_null(column.cast(pa.large_string()), "")
        odd = pc.match_substring_regex(column, self.odd)
        plain = column.filter(pc.invert(odd))
        regular = iter(self._by_words(plain)) if len(plain) else iter(())
        return [self.ids(column[i].as_py()) if bad else next(regular) for i, bad in enumerate(odd.to_pylist())]

    def _by_words(self, column: pa.Array) -> list[bytes]:
        parted = pc.split_pattern(column, " ")
        offsets = np.asarray(parted.offsets)
        coded = parted.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.known) > CACHE_WORDS:
            self.known = {}
        # A text's first word stands after no space; as a word, it may cost a look too many.
        self.learn([word for word in words if word not in self.known])
        blobs = [self.known[word] for word in words]
        flat = np.frombuffer(b"".join(blobs), "<u4")
        counts = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4
        begins = np.cumsum(counts) - counts
        index = np.asarray(coded.indices)
        first = index[offsets[:-1] - offsets[0]]
        heads = [self.ids(words[i]) for i in first.tolist()]
        keep = np.ones(len(index), bool)
        keep[offsets[:-1] - offsets[0]] = False
        used = np.where(keep, counts[index], 0)
        ids = flat[ranges(begins[index], used)].tobytes()
        ends = np.concatenate([[0], np.cumsum(used)])[offsets - offsets[0]] * 4
        return [head + ids[a:b] for head, a, b in zip(heads, ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def piece_lengths(total: int, longest: int) -> list[int]:
    """The longest pieces first, then the binary digits of the rest, greatest first."""
    whole, rest = divmod(total, longest)
    digits = [1 << bit for bit in range(longest.bit_length() - 1, -1, -1) if rest >> bit & 1]
    return [longest] * whole + digits


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    text: str = "text",
    max_length: int = MAX_LENGTH,
    separator: int = SEPARATOR,
) -> DataFrame:
    """One row per piece: the other columns of the document and ``PIECE_FIELDS``.

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit numbers;
    ``bucket`` is the binary logarithm of its length; ``sequence_id`` differs for all
    pieces, and ``offset`` is 0, as a sequence is one piece.  A column of ``docs``
    with such a name is replaced; the text column is left out.

    A null or empty text is the separator alone.  Texts of any length are cut, never
    shortened.  An empty table gives no rows; repeated rows are packed each.
    """
    if max_length < 1 or max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")
    ship_package(docs.sparkSession)
    names = {field.name.lower() for field in PIECE_FIELDS} | {text.lower()}
    kept = [field for field in docs.schema.fields if field.name.lower() not in names]
    schema = T.StructType(kept + PIECE_FIELDS)
    source = docs.select(*[f"`{field.name}`" for field in kept], docs[f"`{text}`"].alias(text))
    end = np.array([separator], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path)
        next_id = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in _parts(batch):
                made = _pieces(part, encode.streams(part.column(part.num_columns - 1)), end, max_length, next_id)
                yield pa.RecordBatch.from_arrays(made, names=schema.names)
                next_id += len(made[-1])

    return source.mapInArrow(run, schema)


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Cuts a batch into parts of about ``BATCH_CHARS`` characters; a longer text is a part."""
    sizes = np.asarray(pc.fill_null(pc.utf8_length(batch.column(batch.num_columns - 1)), 0))
    number = (np.cumsum(sizes, dtype=np.int64) - 1) // BATCH_CHARS
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(number)) + 1, [len(sizes)]])
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if b > a:
            yield batch.slice(a, b - a)


def _pieces(batch, streams: list[bytes], end: bytes, max_length: int, next_id: int) -> list[pa.Array]:
    rows, starts, lengths, ids, totals = [], [], [], [], []
    for row, stream in enumerate(streams):
        stream += end
        total, start = len(stream) // 4, 0
        for length in piece_lengths(total, max_length):
            rows.append(row)
            starts.append(start)
            lengths.append(length)
            ids.append(stream[4 * start : 4 * (start + length)])
            totals.append(total)
            start += length
    of_document = batch.select(range(batch.num_columns - 1)).take(pa.array(rows, pa.int32()))
    return [
        *of_document.columns,
        pa.array(starts, pa.int64()),
        pa.array(lengths, pa.int64()),
        pa.array(ids, pa.binary()),
        pa.array(totals, pa.int64()),
        pa.array([length.bit_length() - 1 for length in lengths], pa.int32()),
        pa.array(np.arange(next_id, next_id + len(rows), dtype=np.int64)),
        pa.array(np.zeros(len(rows), np.int64)),
    ]


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Stores the pieces by bucket: a reader of one folder gets sequences of one length."""
    pieces.write.partitionBy("bucket").mode("overwrite").parquet(path)
