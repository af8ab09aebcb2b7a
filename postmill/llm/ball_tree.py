"""Exact top-k by inner product: ball trees per shard, searched by branch and bound.

Vectors are dealt into shards by a row number, so equal ones spread.  Each shard's tree
is built once and stored in flat arrays: centre, radius and range of rows of each node.
For a query q, no vector in a ball scores above <q, centre> + |q| * radius.

Queries are taken in blocks of a bounded size, which are broadcast; a task walks through
the stored trees it reads.  In a tree each query first dives to its most promising leaf,
then branches from the root: a child whose bound is below the query's k-th score is
dropped with all that is under it, and the leaves left are taken in order of their bounds.
The k-th score is shared: a task carries it from tree to tree, and rounds of shards, each
larger than the one before, start from what the earlier rounds have found.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postmill.llm.common import ship_package, written

#: Vectors in a shard at most (8192 have 4 MB at 64 components), and queries in a block.
SHARD_ROWS = 8192
BLOCK_ROWS = 16_384
LEAF_ROWS = 64
#: Vectors of the first round of shards, about; each round has so many times those before.
FLOOR_ROWS = 8192
GROWTH = 8
#: Queries that are taken through a tree together.
TOGETHER = 1024


@dataclass
class BallTree:
    """Nodes in level order; a leaf has no children (-1).  Rows of a node are neighbours."""

    centre: np.ndarray
    radius: np.ndarray
    left: np.ndarray
    right: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    rows: np.ndarray  # the shard's vectors in the order of the leaves
    ids: np.ndarray


def build(vectors: np.ndarray, ids: np.ndarray, leaf_rows: int = LEAF_ROWS) -> BallTree:
    """Halves the rows between two far ones, level by level."""
    order = np.lexsort((ids,))
    nodes: list[list] = []
    todo = [(0, len(order), -1, 0)]
    for begin, end, parent, side in todo:
        at = len(nodes)
        part = vectors[order[begin:end]]
        centre = part.mean(0)
        distance = np.sqrt(((part - centre) ** 2).sum(1))
        nodes.append([centre, distance.max(), -1, -1, begin, end])
        if parent >= 0:
            nodes[parent][2 + side] = at
        if end - begin > leaf_rows and distance.max() > 0:
            one = part[distance.argmax()]
            two = part[((part - one) ** 2).sum(1).argmax()]
            half = (end - begin) // 2
            by = np.argsort(part @ (two - one), kind="stable")
            order[begin:end] = order[begin:end][by]
            todo += [(begin, begin + half, at, 0), (begin + half, end, at, 1)]
    columns = [np.array([n[i] for n in nodes]) for i in range(6)]
    return BallTree(*columns, vectors[order], ids[order])


def better(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: greatest score, then least id."""
    return np.lexsort((ids, -scores))[:k]


class Best:
    """The k best answers so far of some queries: greatest scores, then least ids."""

    def __init__(self, queries: np.ndarray, ids: np.ndarray, floors: np.ndarray, k: int):
        self.queries, self.ids, self.k = queries, ids, k
        self.norms = np.sqrt((queries**2).sum(1))
        #: What an answer must reach: the k-th score, or a floor that k others reach elsewhere.
        self.kth = floors.astype(float).copy()
        self.at, self.found, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)

    def add(self, at: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Answers (query, row id, score); rows of a query's own id are none."""
        good = (scores >= self.kth[at]) & (ids != self.ids[at])
        if not good.any():
            return
        at = np.concatenate([self.at, at[good]])
        ids = np.concatenate([self.found, ids[good]])
        scores = np.concatenate([self.scores, scores[good]])
        order = np.lexsort((ids, -scores, at))
        at, ids, scores = at[order], ids[order], scores[order]
        rank = np.arange(len(at)) - np.searchsorted(at, at)
        kept = rank < self.k
        self.at, self.found, self.scores = at[kept], ids[kept], scores[kept]
        full = rank == self.k - 1
        self.kth[at[full]] = np.maximum(self.kth[at[full]], scores[full])


def _bounds(tree: BallTree, best: Best, at: np.ndarray, node: np.ndarray) -> np.ndarray:
    """No row of a node scores above this for a query."""
    norms = best.norms[at]
    bound = (best.queries[at] * tree.centre[node]).sum(1) + norms * tree.radius[node]
    # Scores are whole numbers; the slack covers the rounding of the bounds.
    return bound + 1e-9 * (np.abs(bound) + norms * np.abs(tree.centre).max(initial=0) + 1)


def _score(tree: BallTree, best: Best, at: np.ndarray, leaf: np.ndarray) -> None:
    """Scores all rows of a leaf for each of the queries that have come to it."""
    order = np.argsort(leaf, kind="stable")
    cuts = np.flatnonzero(np.diff(leaf[order])) + 1
    made = []
    for part in np.split(order, cuts):
        if len(part):
            rows = slice(tree.begin[leaf[part[0]]], tree.end[leaf[part[0]]])
            scores = best.queries[at[part]] @ tree.rows[rows].T
            q, r = np.nonzero(scores >= best.kth[at[part], None])
            made.append((at[part][q], tree.ids[rows][r], scores[q, r]))
    if made:
        best.add(*(np.concatenate(x) for x in zip(*made, strict=True)))


def search(tree: BallTree, best: Best, some: np.ndarray) -> int:
    """Brings the answers of a tree into ``best``, for ``some`` of its queries; returns how many
    nodes were looked at, over all of them."""
    looked = len(some)
    # The dive: to the child of the greater bound, down to a leaf.
    node = np.zeros(len(some), np.int64)
    while True:
        inner = np.flatnonzero(tree.left[node] >= 0)
        if not len(inner):
            break
        left, right = tree.left[node[inner]], tree.right[node[inner]]
        goes_left = _bounds(tree, best, some[inner], left) >= _bounds(tree, best, some[inner], right)
        node[inner] = np.where(goes_left, left, right)
        looked += 2 * len(inner)
    dived = node
    _score(tree, best, some, dived)
    # The branches: what a query's k-th score rules out is not opened.
    query, node = np.arange(len(some)), np.zeros(len(some), np.int64)
    bound = _bounds(tree, best, some, node)
    leaves = []
    while len(query):
        alive = bound >= best.kth[some[query]]
        query, node, bound = query[alive], node[alive], bound[alive]
        leaf = tree.left[node] < 0
        leaves.append((query[leaf], node[leaf], bound[leaf]))
        query, node, bound = query[~leaf], node[~leaf], bound[~leaf]
        children = np.concatenate([tree.left[node], tree.right[node]])
        query, above = np.concatenate([query, query]), np.concatenate([bound, bound])
        looked += len(query)
        # A parent bounds its children, too.
        bound = np.minimum(above, _bounds(tree, best, some[query], children))
        node = children
    query, node, bound = (np.concatenate(x) for x in zip(*leaves, strict=True))
    fresh = node != dived[query]
    query, node, bound = query[fresh], node[fresh], bound[fresh]
    order = np.lexsort((-bound, query))
    query, node, bound = query[order], node[order], bound[order]
    turn = np.arange(len(query)) - np.searchsorted(query, query)
    for step in range(int(turn.max(initial=-1)) + 1):
        now = np.flatnonzero(turn == step)
        now = now[bound[now] >= best.kth[some[query[now]]]]
        if not len(now):
            break  # leaves further down have no greater bounds
        _score(tree, best, some[query[now]], node[now])
    return looked


def whole_numbers(vector: Column, factor: int = 256) -> Column:
    """Each component as floor(factor * x); null for a vector that is null or holds a
    component that is null or not finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    scaled = F.transform(vector, lambda x: F.floor(F.lit(float(factor)) * x.cast("double")).cast("double"))
    return F.when(F.coalesce(fine, F.lit(False)), scaled)


def top_k(vectors: DataFrame, is_query: Column, k: int, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` of each query's k best vectors.

    Vectors are rows of whole numbers (as doubles); queries are the rows that
    ``is_query`` marks, and a query's own row is no answer.  Ties go to the smaller id;
    with fewer candidates than k, all are given.  Null vectors and ids take no part;
    vectors of different lengths are compared within their length.  Repeated rows of
    one id count each, but never for that id's own query.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.select(
        F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{embedding}`").alias("v"), is_query.alias("asks")
    ).where("id is not null and v is not null")
    rows = written(rows.withColumns({"width": F.size("v"), "row": F.monotonically_increasing_id()}))
    total = rows.count()
    # Dealt by hash, a shard of four fifths on average stays below the bound.
    n_shards = max(1, -(-5 * total // (4 * SHARD_ROWS)))
    trees = written(stored_trees(rows, n_shards))
    asking = rows.where("asks and width > 0").select("id", "v", "width").dropDuplicates(["id", "v"])
    n_blocks = max(1, -(-5 * asking.count() // (4 * BLOCK_ROWS)))
    blocks = written(asking.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(n_blocks)).cast("int")))

    found = spark.createDataFrame([], FOUND)
    begin, end = 0, max(1, FLOOR_ROWS // SHARD_ROWS)
    while begin < n_shards:
        part = trees.where((F.col("shard") >= begin) & (F.col("shard") < end))
        # The k-th score of each query in all rounds before; a floor that k answers reach.
        floors = found.groupBy("query_id").agg(F.min("score").alias("floor"), F.count("*").alias("n")).where(F.col("n") == k)
        started = blocks.join(floors.select(F.col("query_id").alias("id"), "floor"), "id", "left")
        for block in range(n_blocks):
            asked = started.where(F.col("block") == block).select("id", "v", "width", "floor")
            found = found.unionByName(_searched(part, asked, k))
        found = written(_best(found, k))
        begin, end = end, min(n_shards, end * (GROWTH + 1))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order))
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", F.col("score").cast("long"))


FOUND = "query_id long, vec_id long, score double"
_TREE = (
    "shard int, width int, centre binary, radius binary, left binary, right binary, begin binary, end binary, "
    "rows binary, ids binary"
)
_KINDS = {"centre": float, "radius": float, "rows": float}


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("rank")


def stored_trees(rows: DataFrame, n_shards: int) -> DataFrame:
    """One row a shard (and length of vectors): its tree as flat arrays of bytes."""

    def made(key: tuple, shard: pd.DataFrame) -> pd.DataFrame:
        tree = build(np.stack(shard["v"].to_numpy()).astype(float), shard["id"].to_numpy(np.int64))
        arrays = {
            name: np.ascontiguousarray(value, _KINDS.get(name, np.int64)).tobytes() for name, value in vars(tree).items()
        }
        return pd.DataFrame([{"shard": key[0], "width": key[1], **arrays}])

    dealt = rows.where("width > 0").select(
        "id", "v", "width", F.pmod(F.xxhash64("row"), F.lit(n_shards)).cast("int").alias("shard")
    )
    return dealt.groupBy("shard", "width").applyInPandas(made, _TREE)


def _tree(row: dict) -> BallTree:
    arrays = {c: np.frombuffer(row[c], _KINDS.get(c, np.int64)) for c in BallTree.__dataclass_fields__}
    for name in ("centre", "rows"):
        arrays[name] = arrays[name].reshape(-1, row["width"])
    return BallTree(**arrays)


def _searched(trees: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Answers of one block of queries, which is broadcast, in some stored trees; each task gives
    its k best."""
    table = asked.toArrow()  # BLOCK_ROWS at most
    block = {name: table.column(name).combine_chunks() for name in table.column_names}
    held = trees.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, Best] = {}
        for width in set(held.value["width"].to_pylist()):
            own = held.value["width"].to_numpy() == width
            vectors = np.array(held.value["v"].filter(pa.array(own)).to_pylist(), float).reshape(-1, width)
            floors = held.value["floor"].fill_null(float("-inf")).to_numpy()[own]
            best[width] = Best(vectors, held.value["id"].to_numpy()[own], floors, k)
        for batch in batches:
            for row in batch.to_pylist():
                own = best.get(row["width"])
                if own is not None:
                    tree = _tree(row)
                    for at in range(0, len(own.ids), TOGETHER):
                        search(tree, own, np.arange(at, min(at + TOGETHER, len(own.ids))))
        for own in best.values():
            columns = (own.ids[own.at], own.found, own.scores)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "vec_id", "score"])

    return trees.mapInArrow(run, FOUND)
