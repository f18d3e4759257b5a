"""Exact top-k inner products by Fagin's threshold algorithm.

Candidates lie in blocks of about ``block`` rows, each with one sorted list per
dimension. A query walks the lists of a block from the end that its sign favours; rows
met there are scored whole (random access). The sum over the dimensions of the query's
component times the list's value at the current depth bounds every row not met yet, and
the walk ends when that bound is below the k-th score so far. A first pass gives each
query the k-th score in one block; the second pass starts from that score in every
block, so a block seldom returns more than the few rows that can still win.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.llm.common import pick, schema
from tabsmith.session import materialize

EXACT_FLOAT32, EXACT_FLOAT64 = 2 ** 24, 2 ** 53


class SortedLists:
    """A block of integer vectors with its per-dimension lists."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        by_id = np.argsort(ids, kind="stable")      # so that ties go to smaller ids
        self.ids, self.x = ids[by_id], x[by_id]
        self.order = np.argsort(-self.x, axis=0, kind="stable").T.copy()       # dimension x rank
        self.values = np.take_along_axis(self.x.T, self.order, 1)
        self.largest = float(np.abs(x).max(initial=0)) * max(1, x.shape[1])

    def top(self, q: np.ndarray, k: int, floor: float, own: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of the k best rows scoring at least ``floor``, without the row
        whose id is ``own``; best first, ties by smaller id."""
        n = len(self.ids)
        if self.largest * max(1.0, float(np.abs(q).max(initial=0))) < EXACT_FLOAT32:
            x, qs = self.as_float32(), q.astype(np.float32)
        else:
            x, qs = self.x, q
        up, down = np.flatnonzero(q > 0), np.flatnonzero(q < 0)
        seen = np.zeros(n, bool)
        scored = np.zeros(n, bool)
        scored[self.ids == own] = True
        best_row, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
        depth, to = 0, min(n, 16)
        while True:
            seen[self.order[up, depth:to].ravel()] = True
            seen[self.order[down, n - to: n - depth].ravel()] = True
            new = np.flatnonzero(seen & ~scored) if to < n else np.flatnonzero(~scored)
            scored[new] = True
            s = (x[new] @ qs).astype(np.int64)
            kept = s >= floor
            best_row, best = np.concatenate([best_row, new[kept]]), np.concatenate([best, s[kept]])
            if len(best) > k:
                first = np.lexsort((best_row, -best))[:k]
                best_row, best = best_row[first], best[first]
            if len(best) == k:
                floor = max(floor, best.min())
            if to == n:
                break
            bound = int(q[up] @ self.values[up, to]) + int(q[down] @ self.values[down, n - 1 - to])
            if bound < floor:
                break
            depth, to = to, min(n, to * 4)
        first = np.lexsort((best_row, -best))
        return best_row[first], best[first]

    def as_float32(self) -> np.ndarray:
        if not hasattr(self, "_x32"):
            self._x32 = self.x.astype(np.float32)
        return self._x32


def matrix(col: pa.ChunkedArray, dims: int) -> np.ndarray:
    """Rows of an array column; shorter vectors are zero in the further dimensions."""
    col = col.combine_chunks()
    size = np.diff(np.asarray(col.offsets))
    out = np.zeros((len(size), dims), np.int64)
    out[np.arange(dims) < size[:, None]] = np.asarray(col.flatten())
    return out


def search_blocks(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score): for each pair of a query block and a row block with the
    same (qb, cb), the local top k of each query. ``queries``: qb, cb, query_id, v, floor."""
    # both sides come from one frame; columns get new identities
    queries = queries.select(*[F.col(c).alias({"v": "q"}.get(c, c)) for c in queries.columns])
    rows = rows.select(*[F.col(c).alias(c) for c in rows.columns])

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
        dims = max(int(np.max(np.asarray(c.combine_chunks().value_lengths()))) for c in (left.column("q"), right.column("v")))
        lists = SortedLists(right.column("vec_id").to_numpy(), matrix(right.column("v"), dims))
        ids, floors = left.column("query_id").to_numpy(), left.column("floor").to_numpy()
        got = [lists.top(q, k, f, own) for q, f, own in zip(matrix(left.column("q"), dims), floors, ids)]
        n = [len(s) for _, s in got]
        return pa.table({"query_id": pa.array(np.repeat(ids, n)), "vec_id": pa.array(lists.ids[np.concatenate([r for r, _ in got])]),
                         "score": pa.array(np.concatenate([s for _, s in got]))})

    return queries.groupBy("qb", "cb").cogroup(rows.groupBy("qb", "cb")).applyInArrow(
        join, schema(("query_id", "bigint"), ("vec_id", "bigint"), ("score", "bigint")))


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 64,
          block: int = 8192, query_block: int = 8192) -> DataFrame:
    """For each row whose id is divisible by ``every``: its k best other rows by inner
    product of floor(scale * component): query_id, rank, vec_id, score.

    Rows whose vector (or id) is null, or that hold a null or non-finite component, take
    no part. A query's own id is never a candidate; repeated ids are candidates each.
    Ties go to the smaller vec_id. Fewer than k other rows give fewer rows. Vectors of
    unequal length count as zero in the missing dimensions."""
    x = F.col("v")
    v = pick(vectors, vec_id=id_col, v=vec_col).where(F.col("vec_id").isNotNull() & x.isNotNull())
    v = v.withColumn("v", F.transform("v", lambda c: c.cast("double")))
    v = v.where(F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))))
    v = materialize(v.select("vec_id", F.transform("v", lambda c: F.floor(F.lit(float(scale)) * c).cast("bigint")).alias("v")), "vectors")
    n = v.count()
    n_c, n_q = max(1, -(-n // block)), max(1, -(-n // (every * query_block)))
    cb = F.pmod(F.xxhash64("vec_id"), F.lit(n_c)).cast("int")
    qb = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(n_q)).cast("int")
    rows = v.select("vec_id", "v", cb.alias("cb"))
    asked = v.where(F.pmod("vec_id", F.lit(every)) == 0).select(F.col("vec_id").alias("query_id"), "v", qb.alias("qb"), cb.alias("cb")).dropDuplicates(["query_id"])
    everywhere = rows.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))))
    first = search_blocks(asked.withColumn("floor", F.lit(-(2 ** 62))), everywhere, k)
    floor = materialize(first.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("floor")), "floors")
    again = (asked.drop("cb").join(floor, "query_id", "left").withColumn("floor", F.coalesce("floor", F.lit(-(2 ** 62))))
             .withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(n_c - 1)))))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    found = search_blocks(again, everywhere, k)
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
