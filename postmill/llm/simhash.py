"""Near duplicates by SimHash, found with deletion variants of segments.

A fingerprint has 64 bits, one for the majority of the shingles' hashes.  For links at
``bits`` or fewer differing bits it is cut into ``bits // 2 + 1`` segments, so that of
two linked fingerprints one segment differs in one bit at most.  Each segment is filed
once for each of its bits, with that bit left out: segments that differ in one bit at
most share a variant.  An equality of variants yields candidates, which are verified.

Copies are combined first: links are sought between different fingerprints.  Variants
that many of them share do not make all pairs: their members are linked through the
values one bit away from them, which two fingerprints share if and only if they differ
in two bits or fewer.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postmill.llm import graph
from postmill.llm.common import ASCII_LOWER, ASCII_UPPER, append_columns, written

SHINGLE = 3
BITS = 2
SEED = 42
WIDTH = 64
#: Fingerprints that share a variant and are still compared pair by pair.
PAIRED = 32
#: Shared variants of more than two fingerprints that are broadcast: about 20 MB.
BROADCAST_KEYS = 500_000
#: Shingles that are counted together.
CHUNK = 1 << 17

_LOWER = bytes.maketrans(ASCII_UPPER.encode(), ASCII_LOWER.encode())


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as an unsigned number; 0 for a text without words.

    Words are what stands between ASCII white space, with A-Z lower-cased.  Repeated
    shingles count each time; a text of fewer words is one shingle.
    """
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    size = min(shingle, len(words))
    count = len(words) - size + 1
    total = np.zeros(WIDTH, np.int64)
    for at in range(0, count, CHUNK):
        until = min(at + CHUNK, count)
        shingles = map(b" ".join, zip(*[words[at + k : until + k] for k in range(size)], strict=True))
        hashes = np.array(list(map(xxhash.xxh64_intdigest, shingles, itertools.repeat(SEED))), np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(0, dtype=np.int64)
    majority = (2 * total > count).astype(np.uint8)
    return int(np.packbits(majority, bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, text: str = "text", name: str = "simhash", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` and the fingerprint of each whole text, as a signed 64-bit number.

    The new column replaces one of its name.  Null and empty texts have 0.
    """

    def made(batch: pa.RecordBatch) -> list[pa.Array]:
        values = [fingerprint(value.as_py(), shingle) for value in batch.column(text)]
        return [pa.array(np.array(values, np.uint64).view(np.int64), pa.int64())]

    return append_columns(docs, made, [T.StructField(name, T.LongType())])


def hex_digits(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def variant_masks(bits: int) -> list[int]:
    """What remains of a fingerprint in each variant: a segment without one bit."""
    count = bits // 2 + 1
    cuts = [i * WIDTH // count for i in range(count + 1)]
    out = []
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        segment = (1 << high) - (1 << low)
        out += [_signed(segment & ~(1 << bit)) for bit in range(low, high)]
    return out


def links(prints: DataFrame, bits: int = BITS, paired: int = PAIRED) -> DataFrame:
    """Edges ``a``, ``b`` that join all values of ``x`` at ``bits`` or fewer differing bits.

    ``prints`` has each value once.  Linked values are in one component of the edges,
    and others are not; pairs of them are not all listed.
    """
    if not 0 <= bits <= 2:
        raise ValueError("links are exact for up to 2 differing bits")
    masks = F.array(*[F.lit(mask).cast("long") for mask in variant_masks(bits)])
    variants = prints.select(
        "x", F.posexplode(F.transform(masks, lambda mask: F.col("x").bitwiseAND(mask))).alias("variant", "rest")
    )
    shared = (
        variants.groupBy("variant", "rest")
        .agg(F.count("*").alias("n"), F.min("x").alias("a"), F.max("x").alias("b"))
        .where("n > 1")
    )
    shared = written(shared)

    def near(a: str, b: str) -> Column:
        return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= bits

    twos = shared.where("n = 2").select("a", "b").where(near("a", "b"))
    # The variants of more than two fingerprints meet their members again; those keys
    # are few beside the variants, and are broadcast where they have been counted to be.
    keys = shared.where("n > 2").select("variant", "rest", "n")
    keys = F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys
    members = written(variants.join(keys, ["variant", "rest"]))
    some = members.where(f"n <= {paired}").drop("n")
    pairs = (
        some.withColumnRenamed("x", "a")
        .join(some.withColumnRenamed("x", "b"), ["variant", "rest"])
        .where(F.col("a") < F.col("b"))
        .select("a", "b")
        .where(near("a", "b"))
    )
    crowded = members.where(f"n > {paired}").select("x").distinct()
    return twos.union(pairs).union(_through_middles(crowded, bits)).distinct()


def _through_middles(prints: DataFrame, bits: int) -> DataFrame:
    """Edges from each value to the least one that shares a middle with it.

    Middles lie within half the bits of a value: for two bits the value itself and
    those one bit away; for one bit the value without one of its bits.
    """
    flips = [0] + [_signed(1 << bit) for bit in range(WIDTH)]
    masks = F.array(*[F.lit(mask).cast("long") for mask in flips])
    if bits == 2:
        middle = F.transform(masks, lambda mask: F.struct(F.lit(0).alias("w"), F.col("x").bitwiseXOR(mask).alias("m")))
    elif bits == 1:
        middle = F.transform(masks, lambda mask: F.struct(mask.alias("w"), F.col("x").bitwiseOR(mask).alias("m")))
    else:
        return prints.select(F.col("x").alias("a"), F.col("x").alias("b")).limit(0)
    near = written(prints.select("x", F.inline(middle)))
    least = near.groupBy("w", "m").agg(F.min("x").alias("b"), F.count("*").alias("n")).where("n > 1")
    joined = near.join(least.select("w", "m", "b"), ["w", "m"])
    return joined.where("x != b").select(F.col("x").alias("a"), "b")


def near_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, bits: int = BITS
) -> DataFrame:
    """``doc_id``, ``simhash``, ``component_id`` and ``first_key`` of every document.

    ``component_id`` is the smallest id that a chain of links reaches, itself included;
    texts without words share the fingerprint 0 and are linked like any other.  A null
    id counts as no id: it is never the smallest unless there is no other.  Repeated
    rows stay; an empty table has no groups.  ``first_key`` is the :func:`row_key` of
    one document of the group, which has the smallest id.
    """
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    prints = written(
        with_fingerprint(source, "text", "simhash", shingle).select(
            "doc_id", "simhash", row_key(F.col("doc_id"), F.col("text")).alias("key")
        )
    )
    # Ids go first in the order of the struct, null ids last.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "key")).alias("first")
    distinct = written(prints.groupBy(F.col("simhash").alias("x")).agg(first))
    reached = graph.components(links(distinct.select("x"), bits)).withColumnRenamed("node", "x")
    classes = written(
        distinct.join(reached, "x", "left").select("x", "first", F.coalesce("component", "x").alias("class"))
    )
    least = written(classes.groupBy("class").agg(F.min("first").alias("first")))
    found = written(
        classes.select("x", "class")
        .join(least, "class")
        .select(F.col("x").alias("simhash"), F.col("first.doc_id").alias("component_id"), F.col("first.key").alias("first_key"))
    )
    return prints.join(found, "simhash").select("doc_id", "simhash", "component_id", "first_key")


def row_key(doc_id: Column, text: Column) -> Column:
    """A 64-bit key of a document, by its id and text."""
    return F.xxhash64(F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(text, F.lit("")))


def one_of_each(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, bits: int = BITS
) -> DataFrame:
    """The document of the smallest id of each group, with its own columns.

    Of repeated rows one stays.  Should two documents share a key, both stay.
    """
    kept = written(near_groups(docs, doc_id, text, shingle, bits).select(F.col("first_key").alias("__key")).distinct())
    columns = [f"`{c}`" for c in docs.columns]
    keyed = docs.select(*columns, row_key(F.col(f"`{doc_id}`"), F.col(f"`{text}`")).alias("__key"))
    # Repeated rows alone share a key, but for chance: those are told apart by the id.
    return keyed.join(kept, "__key", "left_semi").dropDuplicates(["__key", doc_id]).select(*columns)
