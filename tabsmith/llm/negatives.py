"""Hard negatives by a vertical scan with bounds (BOND).

Rows lie in blocks of about ``block`` rows, stored by column: one array per dimension
with its smallest and largest value. An anchor reads the dimensions in descending
magnitude of its own components. After some of them every row has a partial score, and
the dimensions not read yet can add at most and at least what their largest and
smallest values allow; so each row's score lies between two bounds. A bitmap holds the
rows that can still be in the result, and shrinks after each step:

* positives (the best rows of the anchor's label): a row goes when its upper bound is
  below the k-th largest lower bound;
* negatives (rows of other labels in a window of scores under each positive's): a row
  goes when its interval meets no window, or only windows that already have enough
  higher rows for certain.

What is left is read to the end and is exact. All arithmetic is in whole numbers. A first
pass over one block gives each anchor (each window) a k-th score, and the second pass
over every block starts from it, so a block returns few rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.llm.common import pick, schema
from tabsmith.session import materialize

LOWEST, HIGHEST = -(2 ** 62), 2 ** 62
STEPS = (4, 4, 8, 8, 16, 16)        # dimensions read before each look at the bounds; then 32 at a time


class Columns:
    """A block of whole-number vectors by dimension, rows in order of their ids."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        by_id = np.argsort(ids, kind="stable")      # so that ties go to smaller ids
        self.ids, self.labels = ids[by_id], labels[by_id]
        self.columns = np.ascontiguousarray(x[by_id].T)
        self.low, self.high = self.columns.min(axis=1), self.columns.max(axis=1)

    def scan(self, q: np.ndarray, alive: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray]:
        """(rows, exact scores) that survive. ``alive`` is the bitmap; ``keep(low, high)``
        says which rows stay when their scores lie between ``low`` and ``high``."""
        order = np.argsort(-np.abs(q), kind="stable")
        order = order[q[order] != 0]
        least, most = np.minimum(q * self.low, q * self.high), np.maximum(q * self.low, q * self.high)
        left_low, left_high = int(least.sum()), int(most.sum())
        rows = np.flatnonzero(alive)
        partial, at, step = np.zeros(len(rows), np.int64), 0, 0
        while len(rows):
            stay = keep(partial + left_low, partial + left_high)
            rows, partial = rows[stay], partial[stay]
            if at == len(order):
                break
            to = min(len(order), at + (STEPS[step] if step < len(STEPS) else 32))
            whole = len(rows) == len(self.ids)
            for d in order[at:to]:
                partial += q[d] * (self.columns[d] if whole else self.columns[d][rows])
            left_low -= int(least[order[at:to]].sum())
            left_high -= int(most[order[at:to]].sum())
            at, step = to, step + 1
        return rows, partial

    def positives(self, q: np.ndarray, label: int, own: int, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best rows of ``label`` that score at least ``floor``; best first, ties by id."""
        def keep(low, high):
            least = max(floor, int(np.partition(low, len(low) - k)[len(low) - k])) if len(low) >= k else floor
            return high >= least

        rows, score = self.scan(q, (self.labels == label) & (self.ids != own), keep)
        first = np.lexsort((rows, -score))[:k]
        return rows[first], score[first]

    def negatives(self, q: np.ndarray, label: int, windows: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window (lowest, highest score; the lowest may be raised by a known k-th
        score): the k best rows of other labels inside; best first, ties by id."""
        def keep(low, high):
            stay = np.zeros(len(low), bool)
            for a, b in windows[windows[:, 0] <= windows[:, 1]]:
                sure = low[(low >= a) & (high <= b)]
                least = max(a, int(np.partition(sure, len(sure) - k)[len(sure) - k])) if len(sure) >= k else a
                stay |= (high >= least) & (low <= b)
            return stay

        rows, score = self.scan(q, self.labels != label, keep)
        out = []
        for a, b in windows:
            inside = np.flatnonzero((score >= a) & (score <= b))
            first = inside[np.lexsort((rows[inside], -score[inside]))[:k]]
            out.append((rows[first], score[first]))
        return out


def matrix(col: pa.ChunkedArray, dims: int) -> np.ndarray:
    """Rows of an array column; shorter vectors are zero in the further dimensions."""
    col = col.combine_chunks()
    size = np.diff(np.asarray(col.offsets))
    out = np.zeros((len(size), dims), np.int64)
    out[np.arange(dims) < size[:, None]] = np.asarray(col.flatten())
    return out


def search(anchors: DataFrame, rows: DataFrame, k: int, negative: bool) -> DataFrame:
    """(anchor_id, place, vec_id, score): each anchor against the row block with the same
    (qb, cb). ``anchors``: qb, cb, anchor_id, a_label, q, and floor, or windows (array of
    lowest, highest). ``place`` is the window's number, 0 for positives."""
    out = schema(("anchor_id", "bigint"), ("place", "int"), ("vec_id", "bigint"), ("score", "bigint"))
    anchors = anchors.select(*[F.col(c).alias(c) for c in anchors.columns])
    rows = rows.select(*[F.col(c).alias(c) for c in rows.columns])

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return out_table([], [], [], [])
        dims = max(int(np.max(np.asarray(c.combine_chunks().value_lengths()))) for c in (left.column("q"), right.column("v")))
        block = Columns(right.column("vec_id").to_numpy(), right.column("label").to_numpy(), matrix(right.column("v"), dims))
        a, p, i, s = [], [], [], []
        bounds = left.column("windows" if negative else "floor").to_pylist()
        for q, own, label, bound in zip(matrix(left.column("q"), dims), left.column("anchor_id").to_pylist(), left.column("a_label").to_pylist(), bounds):
            found = (block.negatives(q, label, np.array(bound, np.int64).reshape(-1, 2), k) if negative
                     else [block.positives(q, label, own, k, bound)])
            for place, (r, score) in enumerate(found):
                a += [own] * len(r)
                p += [place] * len(r)
                i += block.ids[r].tolist()
                s += score.tolist()
        return out_table(a, p, i, s)

    def out_table(a, p, i, s):
        return pa.table({"anchor_id": pa.array(a, pa.int64()), "place": pa.array(p, pa.int32()),
                         "vec_id": pa.array(i, pa.int64()), "score": pa.array(s, pa.int64())})

    return anchors.groupBy("qb", "cb").cogroup(rows.groupBy("qb", "cb")).applyInArrow(join, out)


def best(found: DataFrame, k: int) -> DataFrame:
    """The k best of each (anchor, window) over all blocks, numbered from 1. A block sends
    at most k rows, so a group has at most k rows a block."""
    w = Window.partitionBy("anchor_id", "place").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def kth(found: DataFrame, k: int) -> DataFrame:
    """The k-th score of each (anchor, window) that has k rows."""
    return found.groupBy("anchor_id", "place").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("kth"))


def labelled(vectors: DataFrame, scale: int, shift_every: int, n_labels: int, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, v, place) of the rows that take part, labels shifted and components
    whole; ``place`` differs between any two rows, also of one id."""
    x = pick(vectors, vec_id=id_col, v=vec_col, label=label_col).where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    x = x.withColumn("v", F.transform("v", lambda c: c.cast("double")))
    x = x.where(F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))))
    x = x.withColumn("label", F.col("label").cast("bigint"))
    if shift_every:
        x = x.withColumn("label", F.when(F.pmod("vec_id", F.lit(shift_every)) == 0, (F.col("label") + 1) % n_labels).otherwise(F.col("label")))
    norm = F.aggregate("v", F.lit(0.0), lambda s, c: s + F.pow(F.abs(F.lit(float(scale)) * c) + 1, 2))
    whole = F.transform("v", lambda c: F.floor(F.lit(float(scale)) * c).cast("bigint"))
    return x.select("vec_id", "label", F.when(norm < 2.0 ** 59, whole).otherwise(
        F.raise_error(F.lit("a vector is too long: inner products would not fit 64 bits"))).alias("v"), F.monotonically_increasing_id().alias("place"))


def hard_negatives(vectors: DataFrame, positives: int = 5, negatives: int = 10, every: int = 100, low: int = 30, high: int = 90, scale: int = 256,
                   shift_every: int = 7, n_labels: int = 10, block: int = 16384, anchor_block: int = 2048,
                   id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each
    anchor (ids divisible by ``every``) and each of its ``positives`` best other rows of the
    same label, the ``negatives`` best rows of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score.

    Scores are inner products of floor(scale * component); ties go to the smaller vec_id.
    Where vec_id is divisible by ``shift_every`` the label first becomes
    (label + 1) % ``n_labels`` (0: no shift). Rows with a null id, label, vector or a null or
    non-finite component take no part. An anchor's own id is never its positive; rows that
    repeat an id are partners each; of several rows with an anchor's id the smallest (label,
    vector) is the anchor. Vectors of unequal length count as zero in the missing
    dimensions; one longer than 2^29.5 raises an error. Fewer partners give fewer rows, an
    empty table none; other columns don't matter.

    Every anchor meets every row, in pairs of blocks of bounded size dealt by their
    numbers, so no label or id gathers in one task."""
    x = materialize(labelled(vectors, scale, shift_every, n_labels, id_col, vec_col, label_col), "vectors")
    n = x.count()
    n_c, n_q = max(1, -(-n // block)), max(1, -(-n // (every * anchor_block)))
    cb = F.pmod(F.xxhash64("place"), F.lit(n_c)).cast("int")
    qb = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(n_q)).cast("int")
    rows = x.select("vec_id", "label", "v", cb.alias("cb")).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))))
    one = x.where(F.pmod("vec_id", F.lit(every)) == 0).groupBy("vec_id").agg(F.min(F.struct("label", "v", "place")).alias("r"))
    anchors = materialize(one.select(F.col("vec_id").alias("anchor_id"), F.col("r.label").alias("a_label"), F.col("r.v").alias("q"), qb.alias("qb"),
                                     F.pmod(F.xxhash64("r.place"), F.lit(n_c)).cast("int").alias("cb")), "anchors")
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(n_c - 1)))

    floor = kth(search(anchors.withColumn("floor", F.lit(LOWEST)), rows, positives, False), positives)
    asked = (anchors.drop("cb").join(floor.select("anchor_id", F.col("kth").alias("floor")), "anchor_id", "left")
             .withColumn("floor", F.coalesce("floor", F.lit(LOWEST))).withColumn("cb", everywhere))
    good = materialize(best(search(asked, rows, positives, False), positives).select(
        "anchor_id", F.col("rank").alias("positive"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    # low% to high% of the positive's score in whole numbers; an empty window holds nothing
    p = F.col("positive_score")
    lowest, highest = F.ceil(F.lit(low) * p / F.lit(100).cast("decimal(20,0)")), F.floor(F.lit(high) * p / F.lit(100).cast("decimal(20,0)"))
    windows = good.select("anchor_id", "positive", F.array(lowest.cast("bigint"), highest.cast("bigint")).alias("w"))
    listed = windows.groupBy("anchor_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("positive", "w"))), lambda s: s["w"]).alias("windows"))
    pairs = anchors.join(listed, "anchor_id")
    raised = kth(search(pairs, rows, negatives, True), negatives).where("kth IS NOT NULL")
    raised = raised.groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("place", "kth"))).alias("kths"))
    pairs = (pairs.drop("cb").join(raised, "anchor_id", "left").withColumn(
        "windows", F.transform("windows", lambda w, i: F.array(F.greatest(w[0], F.coalesce(F.col("kths")[i], w[0])), w[1]))).drop("kths").withColumn("cb", everywhere))
    bad = best(search(pairs, rows, negatives, True), negatives).withColumn("positive", F.col("place") + 1)
    return bad.join(good, ["anchor_id", "positive"]).select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
