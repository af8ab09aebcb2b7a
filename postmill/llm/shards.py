"""Sharding by virtual slots.

Records are hashed into a fixed number of virtual slots.  The bytes of each slot are
summed, and a small versioned map says which shard holds a slot.  Rebalancing edits the
map, so that only the records of moved slots move.

The map has one entry a slot, a few thousand however many records there are; it is the
only thing that reaches the driver, and goes back into the plan as a literal.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

SLOTS = 4096
#: A slot's records are ranked in this many parts, so that no part grows hot by itself.
RANK_PARTS = 16


def record_size(text: Column) -> Column:
    """UTF-8 bytes of the text (none for null) and one more."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def record_hash(doc_id: Column, text: Column) -> Column:
    """Hash of a record's id, or of its text where that is null."""
    return F.xxhash64(F.coalesce(doc_id.cast("string"), text, F.lit("")))


def slot_of(doc_id: Column, text: Column, slots: int = SLOTS, spread: Sequence[int] = ()) -> Column:
    """The virtual slot of a record, by its hash; records of the hashes in ``spread`` are dealt
    over all slots by where they stand in the table."""
    own = record_hash(doc_id, text)
    slot = F.pmod(own, F.lit(slots))
    if spread:
        one_by_one = F.pmod(F.xxhash64(own, F.monotonically_increasing_id()), F.lit(slots))
        slot = F.when(own.isin(list(spread)), one_by_one).otherwise(slot)
    return slot.cast("int")


def slot_sizes(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", slots: int = SLOTS, spread: Sequence[int] = ()
) -> DataFrame:
    """Bytes and records of each slot that has any."""
    slot = slot_of(docs[f"`{doc_id}`"], docs[f"`{text}`"], slots, spread)
    return (
        docs.select(slot.alias("virtual_slot"), record_size(docs[f"`{text}`"]).alias("size"))
        .groupBy("virtual_slot")
        .agg(F.sum("size").alias("bytes"), F.count("*").alias("records"))
    )


def hot_hashes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", slots: int = SLOTS) -> list[int]:
    """Hashes of several records that hold twice a slot's fair share of the bytes: no shard could
    take such a slot and keep the law.

    Only slots of so many bytes can hold one, and there are at most half as many such
    hashes as slots.  A single record is never parted.
    """
    sizes = collect_sizes(docs, doc_id=doc_id, text=text, slots=slots)
    bound = 2 * sum(sizes.values()) / slots
    heavy = sorted(slot for slot, size in sizes.items() if size > bound)
    if not heavy:
        return []
    own = record_hash(docs[f"`{doc_id}`"], docs[f"`{text}`"])
    rows = docs.select(own.alias("hash"), record_size(docs[f"`{text}`"]).alias("size"))
    held = rows.where(F.pmod("hash", F.lit(slots)).isin(heavy)).groupBy("hash")
    found = held.agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).where(F.col("n") > 1)
    return sorted(row["hash"] for row in found.where(F.col("bytes") > bound).collect())


def balance(sizes: dict[int, int], shards: int, slots: int = SLOTS) -> list[int]:
    """A first map: the slots, largest first, each to the shard that has the fewest bytes."""
    heap = [(0, shard) for shard in range(shards)]
    out = [0] * slots
    for slot in sorted(range(slots), key=lambda s: (-sizes.get(s, 0), s)):
        held, shard = heapq.heappop(heap)
        out[slot] = shard
        heapq.heappush(heap, (held + sizes.get(slot, 0), shard))
    return out


def rebalance(mapping: Sequence[int], sizes: dict[int, int], shards: int, slack: float = 0.02) -> list[int]:
    """The map for another number of shards, or for slots that have grown, with few moves.

    Slots of removed shards go to the shard with the fewest bytes.  Then slots move
    from shards above the mean to shards below it, by ``slack`` of the mean at least.
    If there are new shards, slots move to these alone.
    """
    out = list(mapping)
    held = [0] * shards
    by_size = sorted(range(len(out)), key=lambda s: (-sizes.get(s, 0), s))
    for slot in by_size:
        if out[slot] < shards:
            held[out[slot]] += sizes.get(slot, 0)
    for slot in by_size:
        if out[slot] >= shards:
            out[slot] = min(range(shards), key=lambda s: (held[s], s))
            held[out[slot]] += sizes.get(slot, 0)
    mean = sum(held) / shards
    targets = range(max(mapping, default=-1) + 1, shards) or range(shards)
    for slot in by_size:
        size, source = sizes.get(slot, 0), out[slot]
        target = min(targets, key=lambda s: (held[s], s))
        if (
            size
            and held[source] > mean * (1 + slack)
            and held[target] < mean * (1 - slack)
            and held[target] + size <= mean * (1 + slack)
        ):
            out[slot] = target
            held[source] -= size
            held[target] += size
    return out


def save_map(spark: SparkSession, mapping: Sequence[int], version: int, path: str) -> None:
    """Stores one version of the map; earlier versions stay as they are."""
    map_frame(spark, mapping).write.mode("errorifexists").parquet(f"{path}/version={version:06d}")


def load_map(spark: SparkSession, path: str, version: int) -> list[int]:
    rows = spark.read.parquet(f"{path}/version={version:06d}").orderBy("virtual_slot").collect()
    return [row["shard"] for row in rows]


def map_frame(spark: SparkSession, mapping: Sequence[int]) -> DataFrame:
    literal = _literal(mapping)
    return spark.range(1).select(F.posexplode(literal).alias("virtual_slot", "shard"))


def _literal(values: Sequence[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast(T.ArrayType(T.LongType()))


def collect_sizes(docs: DataFrame, **names) -> dict[int, int]:
    """Bytes by slot: as many entries as there are slots, at most."""
    return {row["virtual_slot"]: row["bytes"] for row in slot_sizes(docs, **names).collect()}


def assign(
    docs: DataFrame, mapping: Sequence[int], version: int = 0, doc_id: str = "doc_id", text: str = "text",
    spread: Sequence[int] = (),
) -> DataFrame:
    """``docs`` and ``size``, ``shard``, ``virtual_slot``, ``map_version``; no shuffle.

    The new columns replace columns of their names, whatever the case.  A null text has
    the size 1; a record without an id is placed by its text, one without either in the
    slot of the empty text.  Repeated rows are placed together, unless their hash is in
    ``spread`` (:func:`hot_hashes`); store the result then before it is used twice.  An
    empty table gives no rows.
    """
    new = {"size", "shard", "virtual_slot", "map_version"}
    kept = [f"`{c}`" for c in docs.columns if c.lower() not in new]
    slot = slot_of(docs[f"`{doc_id}`"], docs[f"`{text}`"], len(mapping), spread)
    slotted = docs.select(*kept, record_size(docs[f"`{text}`"]).alias("size"), slot.alias("virtual_slot"))
    return slotted.select(
        *kept,
        "size",
        F.get(_literal(mapping), F.col("virtual_slot")).cast("int").alias("shard"),
        "virtual_slot",
        F.lit(version).alias("map_version"),
    )


def with_positions(assigned: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``assigned`` and ``position``, the place of a record in its shard, without gaps from 0.

    The records of a shard stand by virtual slot, part of the slot, and id.  Only the
    parts are ranked by a window; how many records stand before a part is summed up
    from one count a part.  Records of one id, repeated rows included, and those without
    an id are ranked in any order.  ``position`` replaces a column of its name; other
    columns may have any name.  An empty table gives no rows.
    """
    part = F.pmod(F.xxhash64(f"`{doc_id}`", "size"), F.lit(RANK_PARTS)).cast("int")
    columns = [c for c in assigned.columns if c.lower() != "position"]
    keyed = assigned.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), "shard", "virtual_slot", part.alias("part"),
        F.col(f"`{doc_id}`").alias("id"),
    )
    counts = keyed.groupBy("shard", "virtual_slot", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("virtual_slot", "part").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select("virtual_slot", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("virtual_slot", "part").orderBy("id")
    ranked = keyed.withColumn("rank", F.row_number().over(within) - 1)
    # One row a part: slots x parts of them at most, about 1 MB.
    placed = ranked.join(F.broadcast(begins), ["virtual_slot", "part"])
    position = (F.col("before") + F.col("rank")).cast("long")
    return placed.select(*[F.col("row").getField(c).alias(c) for c in columns], position.alias("position"))
