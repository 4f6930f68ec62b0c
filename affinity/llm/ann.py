"""Approximate nearest neighbours by stable projections and kd-trees.

Unit vectors are projected on ``DIMENSIONS`` Gaussian directions: the squared
projected distance of two points divided by their squared distance follows a
chi-square law. A kd-tree over the projections has two storeys. The
upper splits, found on a bounded sample (``SPLIT_SAMPLE``), deal all points to leaves;
each task builds the lower storey of its leaves down to buckets of 32. A
query takes buckets in order of their projected distance and verifies all points
in them on the original vectors, until chance says that it may stop: with d the k-th
distance so far and r the next bucket's projected distance, it stops when
P(chi-square <= r^2 / d^2) >= ``CONFIDENCE``. So a true neighbour is
missed with probability 1 - CONFIDENCE at most. A query searches its own leaf first, then
the others by projected distance in rounds of 1, 2, 4, ... leaves; after each round its k-th
distance so far decides by the same test whether it goes on.

Equal vectors form one point that carries its smallest ids, as many as an answer can
use, so a hot vector is one point however often it occurs.

Defined results: NULL, empty and zero vectors, vectors holding NULL, NaN or infinite
components, of another length than most, or with a NULL vec_id take no part; queries without other points have
no rows; ties go to the smaller vec_id; of rows repeating a vec_id the smallest vector (by its
components in order) counts, once; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, stored

DIMENSIONS = 8  # even: the chi-square law then has a closed form
CONFIDENCE = 0.98
SPLIT_SAMPLE = 8192
LEAF_POINTS = 8192
BUCKET = 32
STEP = 16  # buckets verified between two tests
SEED = 2


def chi_square(x: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """P(chi-square <= x) for an even number of dimensions."""
    half = np.minimum(np.asarray(x, float) / 2, 700)
    term, total = np.ones_like(half), np.ones_like(half)
    for i in range(1, dimensions // 2):
        term = term * half / i
        total = total + term
    return 1 - np.exp(-half) * total


def directions(width: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((width, DIMENSIONS))


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # no overflow in the squares
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


# --- the tree ----------------------------------------------------------------

def splits(points: np.ndarray, depth: int) -> list[tuple[int, float]]:
    """Median splits of the widest dimension, breadth first: 2^depth leaves."""
    parts, out = [points], []
    for _ in range(depth):
        below = []
        for p in parts:
            dim = int(np.argmax(p.max(axis=0) - p.min(axis=0))) if len(p) else 0
            at = float(np.median(p[:, dim])) if len(p) else 0.0
            out.append((dim, at))
            below += [p[p[:, dim] <= at], p[p[:, dim] > at]]
        parts = below
    return out


def leaf_of(points: np.ndarray, tree: list[tuple[int, float]], depth: int) -> np.ndarray:
    node = np.zeros(len(points), np.int64)
    if depth:
        dims, cuts = (np.array(x) for x in zip(*tree, strict=True))
        for _ in range(depth):
            right = points[np.arange(len(points)), dims[node]] > cuts[node]
            node = 2 * node + 1 + right
    return node - ((1 << depth) - 1)


def boxes(tree: list[tuple[int, float]], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper corners of the leaves."""
    low, high = [np.full(DIMENSIONS, -np.inf)], [np.full(DIMENSIONS, np.inf)]
    for node in range((1 << depth) - 1):
        dim, at = tree[node]
        l, h = low[node], high[node]
        left, right = h.copy(), l.copy()
        left[dim], right[dim] = at, at
        low += [l, right]
        high += [left, h]
    first = (1 << depth) - 1
    return np.array(low[first:]), np.array(high[first:])


def box_distance(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of a point to boxes (0 inside)."""
    gap = np.maximum(np.maximum(low - q, q - high), 0)
    return (gap * gap).sum(axis=1)


class Leaf:
    """Lower storey: points ordered by recursive median splits, buckets of 32 with their boxes."""

    def __init__(self, projected: np.ndarray, vectors: np.ndarray, ids: list[list[int]]):
        order, at = [], [np.arange(len(projected))]
        while at:
            part = at.pop()
            if len(part) <= BUCKET:
                order.append(part)
                continue
            p = projected[part]
            dim = int(np.argmax(p.max(axis=0) - p.min(axis=0)))
            mid = len(part) // 2
            ranked = part[np.argpartition(p[:, dim], mid)]
            at += [ranked[mid:], ranked[:mid]]
        self.buckets = order
        self.low = np.array([projected[b].min(axis=0) for b in order])
        self.high = np.array([projected[b].max(axis=0) for b in order])
        self.vectors, self.ids = vectors, ids

    def nearest(self, q: np.ndarray, v: np.ndarray, own: int, k: int, bound: float) -> list[tuple[float, int]]:
        """Up to k (squared distance, id) by increasing distance; ``bound``: a k-th squared distance known already."""
        reach = box_distance(q, self.low, self.high)
        turn = np.argsort(reach, kind="stable")
        best: list[tuple[float, int]] = []
        for i in range(0, len(turn), STEP):
            if bound < np.inf and (bound <= 0 and reach[turn[i]] > 0 or bound > 0 and chi_square(reach[turn[i]] / bound) >= CONFIDENCE):
                break
            rows = np.concatenate([self.buckets[b] for b in turn[i:i + STEP]])
            away = np.maximum(2 - 2 * (self.vectors[rows] @ v), 0)
            for j in np.flatnonzero(away <= bound + 1e-9).tolist():
                best += [(float(away[j]), x) for x in self.ids[rows[j]] if x != own]
            best = sorted(best)[:k]
            if len(best) == k:
                bound = min(bound, best[-1][0])
        return best


# --- Spark jobs --------------------------------------------------------------

def usable(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v): rows that take part, components as doubles."""
    v = F.col(vector_col).cast("array<double>")
    rows = table.select(F.col(id_col).cast("bigint").alias("vec_id"), v.alias("v")).filter("vec_id IS NOT NULL AND v IS NOT NULL")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.coalesce(fine, F.lit(False)) & F.exists("v", lambda x: x != 0))


def _one_each(rows: DataFrame) -> DataFrame:
    """(vec_id, v) with every vec_id once."""
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def _points(rows: DataFrame, k: int, salts: int = 64) -> DataFrame:
    """(ids, v): distinct vectors with their k + 1 smallest ids; hot vectors are cut per salt first."""
    point = F.xxhash64("v")
    cut = rows
    for part in ([point, F.col("v"), F.pmod(F.col("vec_id"), F.lit(salts))], [point, F.col("v")]):
        w = Window.partitionBy(*part).orderBy("vec_id")
        cut = cut.withColumn("n", F.row_number().over(w)).filter(F.col("n") <= k + 1).drop("n")
    return cut.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def nearest(table: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest by cosine for every row of ``queries``
    (vec_id, v as ``usable`` gives them) among the rows of ``table`` other than itself."""
    spark = table.sparkSession
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    ship(spark)
    rows = usable(table, id_col, vector_col)
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if common is None:
        return spark.createDataFrame([], schema)
    width = common["n"]
    rows = stored(_one_each(rows.filter(F.size("v") == width)), "ann-rows")
    points = stored(_points(rows, k), "points")
    asked = stored(_one_each(queries.filter(F.size("v") == width)), "ann-queries")
    n = points.count()
    depth = max(0, math.ceil(math.log2(n / LEAF_POINTS)))
    sample = points.orderBy(F.xxhash64("v")).limit(SPLIT_SAMPLE).select("v").toArrow()
    plane = directions(width)
    tree = splits(unit(_matrix(sample.column("v").combine_chunks())) @ plane, depth)
    low, high = boxes(tree, depth)

    def placed(rows: DataFrame, ident: str) -> DataFrame:
        kind = rows.schema[ident].dataType.simpleString()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                p = unit(_matrix(batch.column(1))) @ plane if batch.num_rows else np.zeros((0, DIMENSIONS))
                yield pa.RecordBatch.from_arrays([pa.array(leaf_of(p, tree, depth)), batch.column(0), batch.column(1)],
                                                 names=["leaf", ident, "v"])

        return rows.select(ident, "v").mapInArrow(run, f"leaf bigint, {ident} {kind}, v array<double>")

    def search(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asked) and len(held):
            vectors = unit(np.stack(held["v"].to_numpy()))
            leaf = Leaf(vectors @ plane, vectors, [list(x) for x in held["ids"]])
            v = unit(np.stack(asked["v"].to_numpy()))
            for own, q, u, bound in zip(asked["vec_id"].tolist(), v @ plane, v, asked["bound"].tolist(), strict=True):
                out += [(own, x, d) for d, x in leaf.nearest(q, u, own, k, bound)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "away"])

    index = stored(placed(points, "ids"), "ann-index")
    home = stored(placed(asked, "vec_id"), "ann-home")
    unbounded = home.withColumn("bound", F.lit(float("inf")))
    found_schema = "query_id bigint, vec_id bigint, away double"

    def searched(asked: DataFrame) -> DataFrame:
        return asked.groupBy("leaf").cogroup(index.groupBy("leaf")).applyInPandas(search, found_schema)

    best = Window.partitionBy("query_id").orderBy("away", "vec_id")

    def nearer(found: DataFrame) -> DataFrame:
        return stored(found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= 2 * k).drop("rank"), "ann-found")

    def visits(taken: int, step: int):
        """The next ``step`` leaves of each query by projected distance that its bound leaves open."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                p = unit(_matrix(batch.column(2))) @ plane if batch.num_rows else np.zeros((0, DIMENSIONS))
                at, leaves = [], []
                for i, (own, bound) in enumerate(zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                    reach = box_distance(p[i], low, high)
                    reach[own] = np.inf  # searched first
                    next_ = np.argsort(reach, kind="stable")[:-1][taken:taken + step]
                    reach = reach[next_]
                    open_ = reach <= 0 if bound <= 0 else np.ones(len(reach), bool) if bound == float("inf") else chi_square(reach / bound) < CONFIDENCE
                    leaves.append(next_[open_])
                    at.append(np.full(len(leaves[-1]), i))
                at = np.concatenate(at) if at else np.zeros(0, np.int64)
                part = batch.take(pa.array(at, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(leaves) if leaves else np.zeros(0, np.int64), pa.int64()), *part.columns[1:]],
                    names=["leaf", "vec_id", "v", "bound"])

        return run

    found = nearer(searched(unbounded))
    taken, step = 0, 1
    while taken < len(low) - 1:
        far = F.when(F.count("*") >= k, F.get(F.sort_array(F.collect_list("away")), k - 1)).otherwise(float("inf"))  # 2 k rows a query
        known = found.groupBy("query_id").agg(far.alias("far"))
        bounded = home.join(known, home["vec_id"] == known["query_id"], "left").select(
            "leaf", "vec_id", "v", F.coalesce("far", F.lit(float("inf"))).alias("bound"))
        asking = stored(bounded.mapInArrow(visits(taken, step), "leaf bigint, vec_id bigint, v array<double>, bound double"), "ann-visits")
        if asking.isEmpty():
            break  # leaves come by distance: where one is closed the later ones are
        found = nearer(found.unionByName(searched(asking)))
        taken, step = taken + step, 2 * step
    near = found
    # exact cosines of the few that are left, on the original vectors
    pairs = near.join(asked.select(F.col("vec_id").alias("query_id"), F.col("v").alias("a")), "query_id").join(
        rows.select("vec_id", F.col("v").alias("b")), "vec_id")

    def dot(x, y):
        return F.aggregate(F.zip_with(x, y, lambda s, t: s * t), F.lit(0.0), lambda acc, z: acc + z)

    cosine = dot("a", "b") / (F.sqrt(dot("a", "a")) * F.sqrt(dot("b", "b")))
    scored = pairs.select("query_id", "vec_id", cosine.alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
