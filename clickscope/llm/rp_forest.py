"""Approximate nearest neighbours by inner product: a forest of random-projection trees.

Vectors get one more component, sqrt(M^2 - |x|^2) with M the largest norm, and queries a zero, which turns
the largest inner product into the smallest angle. A tree splits its vectors by the plane between two
random members until it has about `leaves` leaves. The planes are fitted on a bounded sample
(`sample` rows, chosen by a hash of the id); every row is then routed to one leaf per tree.

A query walks all trees with one shared priority queue ordered by the margin to the planes passed, and
takes leaves until their rows make up `probe` of the index (a share, so recall does not change with size).
Leaves and queries meet in a join by leaf; large leaves are split into parts of at most PART rows, so a hot
leaf is shared by many tasks. Inside a part inner products are exact (double precision on the original
vectors), and only the k best per query leave it. Equal vectors fall into one leaf; of each distinct vector
only the k + 1 smallest ids can be among anyone's k nearest, the others are dropped before the index.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickscope.llm.common import settle

PART = 4096


@dataclass(frozen=True)
class ForestParams:
    trees: int = 10
    leaves: int = 64  # per tree, about
    probe: float = 1.0  # rows of the leaves taken over rows indexed, counting a row once per tree
    sample: int = 50_000
    seed: int = 5


class Tree:
    """Planes and children of one tree; a negative child -1 - i is leaf i."""

    def __init__(self, x: np.ndarray, leaf: int, rng: np.random.Generator):
        self.normals, self.offsets, self.children, self.leaves = [], [], [], 0
        self.root = self._grow(x, leaf, rng, 0)
        self.normals = np.array(self.normals).reshape(-1, x.shape[1])
        self.offsets = np.array(self.offsets, np.float64)

    def _grow(self, x, leaf, rng, depth):
        side = None
        if len(x) > leaf and depth < 60:
            for _ in range(5):
                a, b = x[rng.choice(len(x), 2, replace=False)]
                normal = a - b
                if normal.any():
                    normal = normal / np.linalg.norm(normal)
                    offset = float(np.median(x @ normal))
                    side = x @ normal > offset
                    if 0 < side.sum() < len(x):
                        break
                side = None
        if side is None:
            self.leaves += 1
            return -self.leaves
        at = len(self.normals)
        self.normals.append(normal)
        self.offsets.append(offset)
        self.children.append(None)
        self.children[at] = (self._grow(x[~side], leaf, rng, depth + 1), self._grow(x[side], leaf, rng, depth + 1))
        return at

    def route(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row."""
        out, stack = np.zeros(len(x), np.int64), [(self.root, np.arange(len(x)))]
        while stack:
            node, rows = stack.pop()
            if node < 0:
                out[rows] = -1 - node
            elif len(rows):
                side = x[rows] @ self.normals[node] > self.offsets[node]
                stack += [(self.children[node][0], rows[~side]), (self.children[node][1], rows[side])]
        return out


def probe_leaves(forest: list[Tree], sizes: list[np.ndarray], query: np.ndarray, wanted: float, least: int = 0) -> list[tuple[int, int]]:
    """Leaves (tree, leaf) in the order of the shared queue until they hold `wanted` rows, `least` of them in one
    tree (whose leaves share no row), or all there are."""
    margins = [t.normals @ query - t.offsets for t in forest]
    queue = [(-np.inf, i, t.root) for i, t in enumerate(forest)]
    heapq.heapify(queue)
    out, got, own = [], 0, [0] * len(forest)
    while queue and (got < wanted or max(own) < least):
        worst, i, node = heapq.heappop(queue)
        if node < 0:
            if sizes[i][-1 - node]:
                out.append((i, -1 - node))
                got += int(sizes[i][-1 - node])
                own[i] += int(sizes[i][-1 - node])
            continue
        m = float(margins[i][node])
        low, high = forest[i].children[node]
        heapq.heappush(queue, (max(worst, m), i, low))
        heapq.heappush(queue, (max(worst, -m), i, high))
    return out


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, v (doubles), h: one row per id with a vector that takes part.

    Null ids and vectors that are null, zero, of another than the commonest dimension, or that hold null or
    non-finite components are left out. Of different vectors under one id the smallest stays.
    """
    v = F.col(embedding).cast("array<double>")
    rows = (vectors.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"))
            .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
            .where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
            .where(F.exists("v", lambda x: x != 0)))
    common = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").first()
    dim = common["n"] if common else 0
    return (rows.where(F.size("v") == dim).groupBy("vec_id").agg(F.min("v").alias("v"))
            .withColumn("h", F.xxhash64("v")))


def _matrix(column: pa.Array) -> np.ndarray:
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(n, -1) if n else np.empty((0, 0))


def _lift(x: np.ndarray, norm2: float) -> np.ndarray:
    return np.hstack([x, np.sqrt(np.maximum(norm2 - (x * x).sum(axis=1), 0))[:, None]])


def _best(pairs, k: int):
    """(query ids, vector ids, scores): the k best of every query inside one part of a leaf."""
    left, right = pairs
    if not len(left) or not len(right):
        return pd.DataFrame({"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0)})
    x, ids = np.stack(left["v"].to_numpy()), left["vec_id"].to_numpy()
    out_q, out_v, out_s = [], [], []
    for at in range(0, len(right), 1024):
        q, names = np.stack(right["v"].to_numpy()[at:at + 1024]), right["query_id"].to_numpy()[at:at + 1024]
        rough = q @ x.T
        rough[names[:, None] == ids[None, :]] = -np.inf
        m = min(k, len(ids))
        # all that may tie with the k-th, scored again in one fixed order of addition
        edge = np.partition(rough, -m, axis=1)[:, -m] - 1e-9 * (1 + np.abs(rough).max(where=np.isfinite(rough), initial=0))
        for i in range(len(q)):
            some = np.flatnonzero((rough[i] >= edge[i]) & np.isfinite(rough[i]))
            score = (x[some] * q[i]).sum(axis=1)
            best = np.lexsort((ids[some], -score))[:k]
            out_q.append(np.full(len(best), names[i]))
            out_v.append(ids[some][best])
            out_s.append(score[best])
    return pd.DataFrame({"query_id": np.concatenate(out_q), "vec_id": np.concatenate(out_v), "score": np.concatenate(out_s)})


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, params: ForestParams = ForestParams()) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest inner products found for every query, ties to the smaller
    vec_id. vectors: vec_id, embedding. queries: the same columns; a query never finds its own id. A query finds all
    candidates where there are fewer than k."""
    spark = vectors.sparkSession
    base = settle(usable(vectors), "ann-vectors")
    # of equal vectors, k + 1 smallest ids can be among the k nearest of any query
    same = Window.partitionBy("h", "v").orderBy("vec_id")
    index = settle(base.withColumn("r", F.row_number().over(same)).where(F.col("r") <= k + 1).drop("r"), "ann-index")
    asked = settle(usable(queries).select(F.col("vec_id").alias("query_id"), "v"), "ann-queries")
    stats = index.agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("m")).first()
    n, norm2 = stats["n"], stats["m"] or 0.0
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # a bounded sample: the smallest hashes of the ids
    sample = np.array([r["v"] for r in index.orderBy(F.xxhash64(F.lit(params.seed), "vec_id"), "vec_id")
                       .select("v").limit(params.sample).collect()])
    lifted = _lift(sample, norm2)
    rng = np.random.default_rng(params.seed)
    forest = [Tree(lifted, max(1, -(-len(lifted) // params.leaves)), rng) for _ in range(params.trees)]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("v"))
            if not len(x):
                continue
            x = _lift(x, norm2)
            for t, tree in enumerate(forest):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), t, np.int32)), pa.array(tree.route(x)), *batch.columns],
                    names=["tree", "leaf", *batch.schema.names])

    routed = index.select("vec_id", "v").mapInArrow(route, "tree int, leaf long, vec_id long, v array<double>")
    counts = routed.groupBy("tree", "leaf").agg(F.count("*").alias("n")).collect()  # trees * leaves rows
    sizes = [np.zeros(t.leaves, np.int64) for t in forest]
    for r in counts:
        sizes[r["tree"]][r["leaf"]] = r["n"]

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, x in enumerate(_matrix(batch.column("v"))):
                found = probe_leaves(forest, sizes, np.append(x, 0.0), params.probe * n, k + 1)
                one = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t for t, _ in found], pa.int32()), pa.array([l for _, l in found], pa.int64()),
                     *[c.take(pa.array(np.zeros(len(found), np.int64))) for c in one.columns]],
                    names=["tree", "leaf", *batch.schema.names])

    probed = settle(asked.mapInArrow(probe, "tree int, leaf long, query_id long, v array<double>"), "ann-probes")
    load = probed.groupBy("tree", "leaf").agg(F.count("*").alias("q"))
    parts = spark.createDataFrame([(r["tree"], r["leaf"], -(-r["n"] // PART)) for r in counts], "tree int, leaf long, parts long")
    plan = F.broadcast(settle(load.join(parts, ["tree", "leaf"]).withColumn(
        "q_parts", F.expr(f"(q + {PART} - 1) div {PART}")).drop("q"), "ann-plan"))  # at most trees * leaves rows
    left = (routed.join(plan, ["tree", "leaf"])
            .withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")))
            .withColumn("q_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("q_parts") - 1))))
    right = (probed.join(plan, ["tree", "leaf"])
             .withColumn("q_part", F.pmod(F.xxhash64("query_id"), F.col("q_parts")))
             .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))))
    keys = ["tree", "leaf", "part", "q_part"]
    found = (left.select(*keys, "vec_id", "v").groupBy(*keys)
             .cogroup(right.select(*keys, "query_id", "v").groupBy(*keys))
             .applyInPandas(lambda a, b: _best((a, b), k), "query_id long, vec_id long, score double"))
    merged = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (merged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
