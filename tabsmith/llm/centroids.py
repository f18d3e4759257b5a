"""Integer k-means whose search for the nearest centroid is an equal-average,
equal-variance search.

For a vector x of d components with mean m and deviation v (the length of x less its
mean), and a centroid c alike,  |x - c|^2 >= d (m_x - m_c)^2 + (v_x - v_c)^2.  Centroids
are sorted by their mean; a vector starts at the centroid whose mean is nearest to its
own and scans outward, on both sides in turn. A side ends when the mean's term alone
exceeds the best distance so far, because it only grows from there; a centroid on the
way is rejected when both terms together exceed it. The others are measured exactly in
whole numbers. Bounds are floats, so they must exceed the best distance by a margin
that covers their rounding before anything is rejected; ties stay in the race and go to
the smaller centroid number.

All vectors of a batch take a step outward together; each keeps its own place and best.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.llm.common import pick, schema
from tabsmith.session import materialize

#: components up to this size keep squared distances and their bounds within 64 bits
LARGEST = 2 ** 26
ROWS = 1 << 14          # vectors searched at a time


class Centroids:
    """Centroids sorted by the mean of their components; equal means by number."""

    def __init__(self, c: np.ndarray):
        self.c = c
        self.mean, self.dev = averages(c)
        self.number = np.lexsort((np.arange(len(c)), self.mean))
        self.sorted_mean, self.sorted_dev, self.sorted = self.mean[self.number], self.dev[self.number], c[self.number]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(number, squared distance) of the nearest centroid of each row of ``x``, ties to
        the smaller number, and how many distances were measured."""
        n, k, d = len(x), len(self.c), x.shape[1]
        mean, dev = averages(x)
        slack = 1e-9 * (d * mean ** 2 + dev ** 2 + float((d * self.mean ** 2 + self.dev ** 2).max(initial=0.0))) + 1e-3
        best, at = np.full(n, np.iinfo(np.int64).max), np.full(n, k)
        up = np.searchsorted(self.sorted_mean, mean)
        down = up - 1
        rows_up, rows_down = np.arange(n), np.arange(n)
        measured = 0
        for _ in range(k):
            for rows, place, step in ((rows_up, up, 1), (rows_down, down, -1)):
                rows = rows[(place[rows] < k) & (place[rows] >= 0)]
                p = place[rows]
                first = d * (mean[rows] - self.sorted_mean[p]) ** 2 - slack[rows]
                alive = first <= best[rows]
                rows, p, first = rows[alive], p[alive], first[alive]
                near = first + (dev[rows] - self.sorted_dev[p]) ** 2 <= best[rows]
                self._measure(x, rows[near], p[near], best, at)
                measured += int(near.sum())
                place[rows] += step
                if step > 0:
                    rows_up = rows
                else:
                    rows_down = rows
            if not len(rows_up) and not len(rows_down):
                break
        return at, best, measured

    def _measure(self, x, rows, p, best, at) -> None:
        """Exact distances of ``rows`` to the centroids at ``p``."""
        diff = x[rows] - self.sorted[p]
        dist, number = np.einsum("ij,ij->i", diff, diff), self.number[p]
        better = (dist < best[rows]) | ((dist == best[rows]) & (number < at[rows]))
        best[rows[better]], at[rows[better]] = dist[better], number[better]


def averages(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean of the components and length of the rest, for each row."""
    mean = x.mean(axis=1)
    return mean, np.sqrt(((x - mean[:, None]) ** 2).sum(axis=1))


def whole_vectors(vectors: DataFrame, dims: int, scale: int, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v): floor(scale * component) of the vectors that have ``dims`` components,
    none null or non-finite. A component beyond ``LARGEST`` raises an error."""
    x = pick(vectors, vec_id=id_col, v=vec_col).where(F.size("v") == dims).withColumn("v", F.transform("v", lambda c: c.cast("double")))
    x = x.where(F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))))
    checked = F.transform("v", lambda c: F.when(F.abs(F.lit(float(scale)) * c) <= LARGEST, F.floor(F.lit(float(scale)) * c)).otherwise(
        F.raise_error(F.lit(f"a component times {scale} exceeds {LARGEST}; squared distances would not fit 64 bits"))))
    return x.select("vec_id", checked.cast("array<bigint>").alias("v"))


def matrix(col: pa.Array, dims: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, dims)


def first_centroids(x: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors whose ``<seed>:<vec_id>`` has the smallest SHA-256, in that order;
    rows of one id by their components, rows without id never."""
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = x.where(F.col("vec_id").isNotNull()).withColumn("h", rank).orderBy("h", "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


def moved(x: DataFrame, c: np.ndarray) -> np.ndarray:
    """The centroids after one round: floor(sum / count) of the vectors of each, exact;
    an empty one stays. Each task sums its own vectors; k x d numbers reach the driver."""
    k, dims = c.shape

    def sums(batches):
        lists = Centroids(c)
        total, n, rows = np.zeros((k, dims), np.int64), np.zeros(k, np.int64), 0
        for batch in batches:
            v = matrix(batch.column(0), dims)
            for i in range(0, len(v), ROWS):
                part = v[i: i + ROWS]
                at, _, _ = lists.nearest(part)
                np.add.at(total, at, part)
                n += np.bincount(at, minlength=k)
                rows += len(part)
                if rows >= 2 ** 36:         # long before a sum leaves 64 bits
                    yield out(total, n)
                    total, n, rows = np.zeros_like(total), np.zeros_like(n), 0
        yield out(total, n)

    def out(total, n):
        full = np.flatnonzero(n)
        return pa.RecordBatch.from_arrays([pa.array(full), pa.array(n[full]), pa.array(total[full].tolist(), pa.list_(pa.int64()))], names=["c", "n", "s"])

    parts = x.select("v").mapInArrow(sums, schema(("c", "bigint"), ("n", "bigint"), ("s", "array<bigint>")))
    per_dim = parts.select("c", "n", F.posexplode("s")).groupBy("c", "pos").agg(
        F.sum("n").alias("n"), F.sum(F.col("col").cast("decimal(38,0)")).alias("s"))
    new = c.copy()
    for r in per_dim.collect():
        new[r["c"], r["pos"]] = int(r["s"]) // r["n"]
    return new


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, seed: int = 1, dims: int = 64, scale: int = 64, id_col: str = "vec_id",
            vec_col: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance (squared, to its centroid), cluster_inertia, inertia (the
    distances summed over the cluster and over all) and centroid_sha256 (of the final
    centroid's components, decimal, comma-joined) of every vector of ``dims`` components
    without a null or non-finite one, in whole numbers floor(scale * component).

    The start is the ``k`` vectors with the smallest hashes of their ids, then ``rounds``
    rounds move every centroid, then vectors are assigned once more. Ties go to the
    smaller centroid number. Fewer than k vectors give fewer centroids; repeated rows and
    ids each count; rows without id are clustered but never start a centroid, and an
    empty table, or one without any id, gives no rows. Other columns don't matter. A
    component beyond 2^26 / scale raises an error.

    Vectors are written once; rounds read them without a shuffle. Only centroids and one
    inertia a cluster (k x dims numbers) pass the driver."""
    x = materialize(whole_vectors(vectors, dims, scale, id_col, vec_col), "vectors")
    c = first_centroids(x, k, seed)
    out = schema(("vec_id", x.schema["vec_id"].dataType.simpleString()), ("cluster", "int"), ("distance", "bigint"))
    if not len(c):
        x, c = x.limit(0), np.zeros((1, dims), np.int64)
    else:
        for _ in range(rounds):
            c = moved(x, c)

    def assign(batches):
        lists = Centroids(c)
        for batch in batches:
            v = matrix(batch.column(1), dims)
            for i in range(0, len(v), ROWS):
                at, dist, _ = lists.nearest(v[i: i + ROWS])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, ROWS), pa.array(at.astype(np.int32)), pa.array(dist)], names=["vec_id", "cluster", "distance"])

    placed = materialize(x.mapInArrow(assign, out), "clusters")
    inertia = {r["cluster"]: r["s"] for r in placed.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    digest = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in c.tolist()]
    own = F.array(*[F.lit(inertia.get(i, 0)).cast("bigint") for i in range(len(c))])
    sha = F.array(*[F.lit(d) for d in digest])
    return placed.select("vec_id", "cluster", "distance", own[F.col("cluster")].alias("cluster_inertia"),
                         F.lit(sum(inertia.values())).cast("bigint").alias("inertia"), sha[F.col("cluster")].alias("centroid_sha256"))
