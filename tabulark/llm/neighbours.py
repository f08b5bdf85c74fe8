"""Approximate nearest neighbours by stable projections in a kd-tree.

Vectors are projected to a few dimensions with seeded Gaussian (2-stable)
directions: the squared projected distance of two vectors, over their squared
distance, follows a chi-square law with that many degrees of freedom.  A
kd-tree over the projections, its cuts fitted on a bounded sample, deals all
vectors to leaves.  A query first searches its own leaf, then every other leaf
whose box the stopping test cannot rule out.  In a leaf it takes points in the
order of projected distance and verifies them on the original vectors, until
the next projected distance is so large that, with probability
``confidence``, no vector nearer than the k-th found can project that far.

A leaf is cut into blocks of about ``BLOCK`` points and the queries that visit
it into lots of about ``BLOCK``, so a leaf full of one vector's copies, or one
that all queries visit, is many small tasks.  Every vector is indexed; only
the tree's cuts come from the sample (about ``SAMPLE`` rows with the least hash).

Defined results: vectors that are null, all zero, hold null or non-finite
components, or have another than the most common length take no part, nor do
rows with a null id.  Rows equal in id and vector count once; rows with the
query's id are never its candidates.  Equal distances are ordered by id; with
fewer candidates than k all are returned; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import bounded_batches, hashed_sample, stored, tidied

DIMS = 8  # projected; even, for the closed form of the chi-square law
BLOCK = 512
SAMPLE = 65_536
LEAVES = 4_096  # at most; beyond, leaves have more blocks
VERIFY = 64  # points verified at once


def chi_square_quantile(probability: float, degrees: int) -> float:
    """Quantile of the chi-square law with an even number of degrees."""
    def law(x: float) -> float:
        term, total = 1.0, 1.0
        for j in range(1, degrees // 2):
            term *= x / 2 / j
            total += term
        return 1 - math.exp(-x / 2) * total

    lo, hi = 0.0, 1.0
    while law(hi) < probability:
        hi *= 2
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if law(mid) < probability else (lo, mid)
    return hi


class Tree:
    """A complete kd-tree of ``depth`` levels; a point goes left where its
    coordinate is at most the cut."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth = depth
        self.axis = np.zeros(2 ** depth, dtype=np.int64)
        self.cut = np.zeros(2 ** depth)
        parts = {1: sample}
        for node in range(1, 2 ** depth):
            points = parts.pop(node)
            if len(points):
                spread = points.max(axis=0) - points.min(axis=0)
                self.axis[node] = int(spread.argmax())
                self.cut[node] = np.median(points[:, self.axis[node]])
            left = points[:, self.axis[node]] <= self.cut[node]
            parts[2 * node], parts[2 * node + 1] = points[left], points[~left]

    def leaf(self, points: np.ndarray) -> np.ndarray:
        node = np.ones(len(points), dtype=np.int64)
        rows = np.arange(len(points))
        for _ in range(self.depth):
            node = 2 * node + (points[rows, self.axis[node]] > self.cut[node])
        return node - 2 ** self.depth


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a binary column of little-endian doubles."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<f8").reshape(-1, width)


def usable(vectors: DataFrame, key: str, vector: str) -> tuple[DataFrame, int]:
    """(key, vec of the rows that take part, their length)."""
    rows = vectors.select(F.col(key).cast("long").alias("key"),
                          F.col(vector).cast("array<double>").alias("vec")).filter(
        F.col("key").isNotNull() & F.col("vec").isNotNull()
        & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vec", lambda x: x != 0))
    lengths = rows.groupBy(F.size("vec").alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    best = lengths.agg(F.max(F.struct("rows", "n")).alias("b")).collect()[0]["b"]
    width = best["n"] if best else 0
    return rows.filter(F.size("vec") == width).distinct(), width


def projected(rows: DataFrame, width: int, seed: int) -> DataFrame:
    """key, v (the vector) and p (its projection), as binary doubles."""
    directions = np.random.default_rng(seed).standard_normal((width, DIMS))

    def run(batches):
        for batch in batches:
            v = np.asarray(batch.column(1).flatten(), dtype="<f8").reshape(-1, width)
            p = v @ directions
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x.tobytes() for x in v], pa.binary()),
                 pa.array([x.tobytes() for x in p], pa.binary())], ["key", "v", "p"])

    return rows.mapInArrow(tidied(run), "key long, v binary, p binary")


def _searched(k: int, width: int, ratio: float):
    """Search one block for one lot of queries: the cogroup function."""

    def run(queries: pa.Table, points: pa.Table) -> pa.Table:
        out_q, out_v, out_d = [], [], []
        if queries.num_rows and points.num_rows:
            ids = points["key"].to_numpy()
            v, p = _matrix(points["v"], width), _matrix(points["p"], DIMS)
            qv, qp = _matrix(queries["v"], width), _matrix(queries["p"], DIMS)
            for i, (own, bound) in enumerate(zip(queries["key"].to_pylist(), queries["bound"].to_pylist())):
                others = np.flatnonzero(ids != own)
                far = ((p[others] - qp[i]) ** 2).sum(axis=1)
                near = np.argsort(far, kind="stable")  # the next projected neighbours
                best_d, best_v = np.zeros(0), np.zeros(0, dtype=np.int64)
                reach = math.inf if bound is None else bound  # square of the k-th distance so far
                at = 0
                while at < len(near) and far[near[at]] <= reach * ratio:
                    some = others[near[at:at + VERIFY]]
                    at += VERIFY
                    d = ((v[some] - qv[i]) ** 2).sum(axis=1)
                    best_d, best_v = np.append(best_d, d), np.append(best_v, ids[some])
                    order = np.lexsort((best_v, best_d))[:k]
                    best_d, best_v = best_d[order], best_v[order]
                    if len(best_d) == k:
                        reach = min(reach, best_d[-1])
                out_q += [own] * len(best_d)
                out_v += best_v.tolist()
                out_d += best_d.tolist()
        return pa.table({"query": pa.array(out_q, pa.int64()), "found": pa.array(out_v, pa.int64()),
                         "square": pa.array(out_d, pa.float64())})

    return run


def _visit(asked: DataFrame, points: DataFrame, blocks: DataFrame, k: int, width: int,
           ratio: float) -> DataFrame:
    """Nearest points of each (query, leaf) of ``asked``: query, found, square."""
    lots = asked.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("lots"))
    left = (asked.join(lots, "leaf").join(blocks.select("leaf", "blocks"), "leaf")
            .withColumn("lot", F.pmod(F.xxhash64("key"), F.col("lots")).cast("int"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("leaf", "block", "lot", "key", "v", "p", "bound"))
    right = (points.join(lots, "leaf")
             .withColumn("lot", F.explode(F.sequence(F.lit(0), F.col("lots") - 1)))
             .select("leaf", "block", "lot", "key", "v", "p"))
    left, right = left.toDF(*left.columns), right.toDF(*right.columns)
    keys = ["leaf", "block", "lot"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        _searched(k, width, ratio), "query long, found long, square double")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k nearest of each query, with their rank."""
    order = Window.partitionBy("query").orderBy("square", "found")
    single = found.groupBy("query", "found").agg(F.min("square").alias("square"))
    return single.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest(vectors: DataFrame, queries, key: str = "vec_id", vector: str = "embedding", k: int = 10,
            confidence: float = 0.99, seed: int = 11) -> DataFrame:
    """query_id, rank, vec_id and score (Euclidean distance) of the ``k`` nearest
    vectors found for each row that ``queries`` (a condition on ``key``) picks."""
    spark = vectors.sparkSession
    rows, width = usable(bounded_batches(vectors), key, vector)
    if not width:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    ratio = chi_square_quantile(confidence, DIMS)
    flat = stored(projected(rows, width, seed), "near-points")
    n = flat.count()
    sample = hashed_sample(flat, SAMPLE, "key").select("p").toArrow()
    depth = max(0, math.ceil(math.log2(max(1, min(n / BLOCK, LEAVES, sample.num_rows / 8)))))
    tree = Tree(_matrix(sample["p"], DIMS), depth)

    def place(batches):
        for batch in batches:
            p = _matrix(batch.column(2), DIMS)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(tree.leaf(p)), pa.array(p.tolist(), pa.list_(pa.float64()))],
                ["key", "v", "p", "leaf", "coords"])

    dealt = stored(flat.mapInArrow(tidied(place), "key long, v binary, p binary, leaf long, coords array<double>"),
                   "near-leaves")
    box = [f(F.element_at("coords", j + 1)) for f in (F.min, F.max) for j in range(DIMS)]
    leaves = dealt.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"),
                                       F.array(*box).alias("box"))
    leaves = stored(leaves, "near-boxes")
    points = (dealt.drop("coords").join(leaves.select("leaf", "blocks"), "leaf")
              .withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")).drop("blocks"))
    asked = dealt.filter(queries(F.col("key"))).drop("coords")
    home = _visit(asked.withColumn("bound", F.lit(None).cast("double")), points, leaves, k, width, ratio)
    home = stored(_best(home, k), "near-home")
    # The k-th distance at home bounds how far the projection of a nearer one can be.
    bound = (home.groupBy("query").agg(F.max("square").alias("last"), F.count(F.lit(1)).alias("n"))
             .select(F.col("query").alias("key"), F.when(F.col("n") >= k, F.col("last")).alias("bound")))
    listed = leaves.select("leaf", "box").toArrow()  # LEAVES rows at most
    names = listed["leaf"].to_numpy()
    boxes = np.array(listed["box"].to_pylist()).reshape(-1, 2, DIMS)

    def leaves_to_visit(batches):
        for batch in batches:
            p = _matrix(batch.column(2), DIMS)
            out = [], []
            for i, (own, reach) in enumerate(zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())):
                gap = np.maximum(0, np.maximum(boxes[:, 0] - p[i], p[i] - boxes[:, 1]))
                near = (gap ** 2).sum(axis=1) <= (math.inf if reach is None else reach * ratio)
                others = names[near & (names != own)]
                out[0].append(np.full(len(others), i))
                out[1].append(others)
            pick = pa.array(np.concatenate(out[0]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pick), batch.column(1).take(pick), batch.column(2).take(pick),
                 pa.array(np.concatenate(out[1])), batch.column(4).take(pick)],
                ["key", "v", "p", "leaf", "bound"])

    away = (asked.select("key", "v", "p", "leaf").join(bound, "key", "left")
            .select("key", "v", "p", "leaf", "bound")
            .mapInArrow(tidied(leaves_to_visit), "key long, v binary, p binary, leaf long, bound double"))
    away = stored(away, "near-visits")
    found = _visit(away, points, leaves, k, width, ratio)
    both = home.select("query", "found", "square").unionByName(found)
    return _best(both, k).select(F.col("query").alias("query_id"), F.col("rank").cast("int").alias("rank"),
                                 F.col("found").alias("vec_id"), F.sqrt("square").alias("score"))
