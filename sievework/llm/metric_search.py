"""Exact top-k search: M-trees searched best-first, with stored triangle-inequality bounds.

Vectors become integers, floor(256 * x). With m the largest squared length of all of them, a vector x gets
the further coordinate sqrt(m - x.x) and a query the coordinate 0; then the squared distance of a query and
a vector is q.q + m - 2 q.x, so the nearest vectors are those of the highest inner product, and distances
obey the triangle inequality.

The vectors are dealt to shards by their nearest pivot, and a cell with many vectors (copies of one vector
included) to several shards. A shard holds one M-tree: nodes are pages with a routing vector, a covering
radius and the distance to the parent's routing vector; a leaf keeps its vectors' distances to its own.
A query starts with the k-th best score among the pivots as its bound, and in a shard takes the pages in the
order of their least possible distance, until that is beyond the k-th best found; a shard that lies beyond
the bound ends with its root. Inner products are exact integers; bounds carry a slack for rounding, so the answer is
exact. Ties go to the smaller id.

Vectors that are NULL or empty, or hold a NULL or a component that is not finite, take no part. A query sees vectors of its own
dimension only, and no row of its own id; an id asks once, with the first of its vectors by order, if it has several. An empty table
gives no row. NULL ids take no part, as an answer could not name them.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.session import stage

SCALE = 256
LEAF, FANOUT = 128, 16
#: vectors of a shard, and pivots, which are also the bounded sample that a query's first bound comes from
SHARD, LEAST_SHARD, SHARDS = 8192, 256, 64
PIVOTS = 256
#: queries that one task answers at once
BLOCK = 4096
SLACK = 1e-6


def quantised(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """vec_id, v (integers) and norm (v.v) of the vectors that take part."""
    wide = F.col(vector).cast("array<double>")
    finite = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(wide, lambda x: F.floor(x * SCALE).cast("long"))
    return (
        rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
        .filter(F.col("vec_id").isNotNull() & (F.size("vector") > 0) & F.forall(F.col("vector"), lambda x: x.isNotNull()))
        .withColumnRenamed("vector", vector)
        .filter(finite)
        .select("vec_id", whole.alias("v"))
        .withColumn("norm", F.aggregate("v", F.lit(0).cast("long"), lambda s, x: s + x * x))
    )


def lifted(vectors: np.ndarray, norms: np.ndarray, most: float) -> np.ndarray:
    return np.hstack([vectors, np.sqrt(np.maximum(0.0, most - norms))[:, None]])


class Tree:
    """An M-tree over lifted vectors, built from above."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF, fanout: int = FANOUT):
        self.points, self.leaf, self.fanout = points, leaf, fanout
        self.root = self._node(np.arange(len(points)), points[0])

    def _node(self, own: np.ndarray, parent: np.ndarray):
        points = self.points[own]
        router = points[np.linalg.norm(points - points.mean(0), axis=1).argmin()]
        apart = np.linalg.norm(points - router, axis=1)
        node = {"router": router, "radius": apart.max(), "to_parent": float(np.linalg.norm(router - parent))}
        if len(own) <= self.leaf:
            return node | {"own": own, "to_router": apart}
        seeds = [int(apart.argmax())]
        near = np.linalg.norm(points - points[seeds[0]], axis=1)
        while len(seeds) < min(self.fanout, -(-len(own) // self.leaf) + 1) and near.max() > 0:
            seeds.append(int(near.argmax()))
            near = np.minimum(near, np.linalg.norm(points - points[seeds[-1]], axis=1))
        squares = (points * points).sum(1)[:, None] - 2 * points @ points[seeds].T + (points[seeds] ** 2).sum(1)
        part = squares.argmin(1)
        groups = [own[part == k] for k in range(len(seeds)) if (part == k).any()]
        if len(groups) < 2:  # copies of one vector: pages by their order
            groups = np.array_split(own, min(self.fanout, -(-len(own) // self.leaf)))
        children = [self._node(g, router) for g in groups]
        return node | {
            "children": children,
            "routers": np.stack([c["router"] for c in children]),
            "radii": np.array([c["radius"] for c in children]),
            "to_parents": np.array([c["to_parent"] for c in children]),
        }


def best_first(tree: Tree, vectors: np.ndarray, ids: np.ndarray, base: float, query: np.ndarray, own_id: int, k: int, floor: int):
    """Up to k (score, id) of a shard, best first, among those that score at least ``floor``.

    base is q.q + m, so a distance d means the score (base - d * d) / 2.
    """
    found: list[tuple[int, int]] = []  # the worst first: (score, -id)

    def reach() -> float:
        """Distance at which a vector scores the bound; farther ones cannot enter."""
        bound = max(floor, found[0][0]) if len(found) == k else floor
        return np.sqrt(max(0.0, base - 2.0 * bound)) * (1 + SLACK) + SLACK

    at = np.append(query, 0.0)
    root = tree.root
    apart = float(np.linalg.norm(at - root["router"]))
    heap = [(max(0.0, apart - root["radius"]), 0, root, apart)]
    pushed = 0
    while heap:
        least, _, node, apart = heapq.heappop(heap)
        limit = reach()
        if least > limit:
            break
        if "own" in node:
            inside = np.abs(apart - node["to_router"]) <= limit  # others are too far, by the stored distance
            own = node["own"][inside]
            scores = vectors[own] @ query
            bound = max(floor, found[0][0]) if len(found) == k else floor
            keep = (scores >= bound) & (ids[own] != own_id)
            scores, names = scores[keep].astype(np.int64), ids[own][keep]
            best = np.lexsort((names, -scores))[:k]
            for score, name in zip(scores[best].tolist(), names[best].tolist(), strict=True):
                entry = (score, -name)
                if len(found) < k:
                    heapq.heappush(found, entry)
                elif entry > found[0]:
                    heapq.heapreplace(found, entry)
            continue
        # by the stored distance to the parent first: no distance is computed for these
        open_ = np.nonzero(np.abs(apart - node["to_parents"]) - node["radii"] <= limit)[0]
        gaps = np.linalg.norm(node["routers"][open_] - at, axis=1)
        for child, gap in zip(open_.tolist(), gaps.tolist(), strict=True):
            lower = max(0.0, gap - node["radii"][child])
            if lower <= limit:
                pushed += 1
                heapq.heappush(heap, (lower, pushed, node["children"][child], gap))
    return sorted(((s, -i) for s, i in found), key=lambda x: (-x[0], x[1]))


def top_k(rows: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for the rows that ``is_query`` (a condition on vec_id) names, against all."""
    spark = rows.sparkSession
    vectors = stage(quantised(rows, vec_id, vector), "vectors")
    about = vectors.agg(F.count("*").alias("n"), F.max("norm").alias("most")).first()
    n, most = about["n"], float(about["most"] or 0)
    schema = "query_id long, rank int, vec_id long, score long"
    if not n:
        return spark.createDataFrame([], schema)
    draw = F.pmod(F.xxhash64("vec_id", F.lit(17)), F.lit(1 << 30))
    share = min(1 << 30, -(-(PIVOTS * 2 << 30) // n))
    # a bounded sample: it only decides where vectors go and where searches start
    sample = vectors.filter(draw < share).dropDuplicates(["v"]).limit(PIVOTS).collect() or vectors.limit(1).collect()
    sample.sort(key=lambda r: (len(r["v"]), r["vec_id"]))
    by_size: dict[int, list] = {}
    for r in sample:
        by_size.setdefault(len(r["v"]), []).append(r)
    pivots = {d: lifted(np.array([r["v"] for r in of], float), np.array([r["norm"] for r in of], float), most) for d, of in by_size.items()}
    firsts = {d: i for i, d in enumerate(pivots)}
    wanted = max(-(-n // SHARD), min(SHARDS, -(-n // LEAST_SHARD)))
    capacity = -(-n // wanted)

    def cell(batches):
        """The nearest pivot of each vector, as one number over all dimensions."""
        for part in batches:
            out = np.zeros(part.num_rows, np.int64)
            sizes = np.array([len(v) for v in part.column(1).to_pylist()])
            norms = part.column(2).to_numpy().astype(float)
            lists = part.column(1).to_pylist()
            for d in np.unique(sizes):
                here = np.nonzero(sizes == d)[0]
                points = lifted(np.array([lists[i] for i in here], float), norms[here], most)
                if d in pivots:
                    p = pivots[d]
                    near = (-2 * points @ p.T + (p * p).sum(1)).argmin(1)
                else:
                    near = np.zeros(len(here), np.int64)
                out[here] = (int(d) << 20) + near
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out)], names=["vec_id", "v", "norm", "cell"])

    celled = stage(vectors.mapInArrow(cell, "vec_id long, v array<bigint>, norm long, cell long"), "cells")
    # one row per cell, PIVOTS for each dimension at most
    cells = {r["cell"]: r["n"] for r in celled.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    parts, sizes, shard, load = {}, {}, -1, capacity
    for c, count in sorted(cells.items()):  # a large cell gets several shards, small ones share one
        many = -(-count // capacity)
        if many > 1:
            parts[c], shard, load = (shard + 1, many), shard + many, capacity
        else:
            if load + count > capacity or sizes[shard] != c >> 20:
                shard, load = shard + 1, 0
            parts[c], load = (shard, 1), load + count
        sizes |= {s: c >> 20 for s in range(parts[c][0], parts[c][0] + many)}
    first = F.create_map(*[F.lit(x) for c, (a, _) in parts.items() for x in (c, a)])[F.col("cell")]
    many = F.create_map(*[F.lit(x) for c, (_, m) in parts.items() for x in (c, m)])[F.col("cell")]
    salt = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), many)
    sharded = celled.select("vec_id", "v", (first + salt).cast("long").alias("shard"))
    queries = vectors.filter(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    blocks = max(1, -(-queries.count() // BLOCK))
    shards_of = {d: [s for s in sizes if sizes[s] == d] for d in set(sizes.values())}
    shards = F.create_map(*[x for d, own in shards_of.items() for x in (F.lit(d), F.array(*[F.lit(s).cast("long") for s in own]))])

    # queries go to every shard of their dimension, in blocks; a shard's vectors go to every block
    asks = queries.select(
        "vec_id", "v", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block"),
        F.explode(shards[F.size("v")]).alias("shard"),
    )
    holds = sharded.select("vec_id", "v", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), "shard")
    out = "query long, vec_id long, score long"

    def matrix(column) -> np.ndarray:
        flat = column.combine_chunks()
        return flat.values.to_numpy().reshape(len(flat), -1).astype(float)

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        rows_ = []
        if left.num_rows and right.num_rows:
            mine, ids = matrix(left["v"]), left["vec_id"].to_numpy()
            tree = Tree(lifted(mine, (mine * mine).sum(1), most))
            d = mine.shape[1]
            asked, names = matrix(right["v"]), right["vec_id"].to_numpy()
            known = by_size.get(d, [])
            start = np.array([r["v"] for r in known], float).reshape(-1, d)
            known_ids = np.array([r["vec_id"] for r in known], np.int64)
            for q, own in zip(asked, names.tolist(), strict=True):
                scores = (start @ q)[known_ids != own]
                floor = int(np.partition(scores, -k)[-k]) if len(scores) >= k else -(1 << 62)
                for score, name in best_first(tree, mine, ids, float(q @ q) + most, q, own, k, floor):
                    rows_.append((own, name, score))
        columns = zip(*rows_, strict=True) if rows_ else [[]] * 3
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query", "vec_id", "score"])

    hits = holds.groupBy("shard", "block").cogroup(asks.groupBy("shard", "block")).applyInArrow(search, out)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return (
        hits.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select(F.col("query").alias("query_id"), F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
