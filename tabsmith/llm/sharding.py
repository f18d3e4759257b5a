"""Sharding by best-fit-decreasing bin packing of groups that stay together.

Groups (rows with equal text) are taken by size, largest first; each enters the bin with
the least remaining capacity that still holds it, found in a balanced tree of bins.
Groups of one size are alike, so the packing runs over the table (size, number of
groups): a run of equal groups fills the tightest bin as far as it goes, then the next.
The sizes of that table sum to at most the total, so it has at most sqrt(2 * total)
rows, whatever the number of documents; only it reaches the driver.

With a number of shards instead of a capacity, the smallest capacity is searched by
bisection whose packing needs no more shards. A group above the capacity has a bin of
its own, so one huge group doesn't widen the other bins.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.llm.common import fresh, pick
from tabsmith.session import materialize

SPREAD = 64             # parts in which the groups of one size are numbered
SLOT_PARTS = 256        # parts in which the rows of one shard are numbered


class Bins:
    """Open bins as an AVL tree ordered by (remaining capacity, bin)."""

    def __init__(self):
        self.root = None

    def put(self, key: tuple[int, int]) -> None:
        self.root = self._put(self.root, key)

    def drop(self, key: tuple[int, int]) -> None:
        self.root = self._drop(self.root, key)

    def tightest(self, size: int) -> tuple[int, int] | None:
        """The bin with the least remaining capacity of at least ``size``."""
        node, best = self.root, None
        while node:
            if node[0][0] >= size:
                best, node = node[0], node[1]
            else:
                node = node[2]
        return best

    # a node is (key, left, right, height)
    @staticmethod
    def _height(node) -> int:
        return node[3] if node else 0

    def _node(self, key, left, right):
        return key, left, right, 1 + max(self._height(left), self._height(right))

    def _balanced(self, key, left, right):
        tilt = self._height(left) - self._height(right)
        if tilt > 1:
            k, a, b, _ = left
            if self._height(a) >= self._height(b):
                return self._node(k, a, self._node(key, b, right))
            return self._node(b[0], self._node(k, a, b[1]), self._node(key, b[2], right))
        if tilt < -1:
            k, a, b, _ = right
            if self._height(b) >= self._height(a):
                return self._node(k, self._node(key, left, a), b)
            return self._node(a[0], self._node(key, left, a[1]), self._node(k, a[2], b))
        return self._node(key, left, right)

    def _put(self, node, key):
        if not node:
            return self._node(key, None, None)
        k, left, right, _ = node
        return self._balanced(k, self._put(left, key), right) if key < k else self._balanced(k, left, self._put(right, key))

    def _drop(self, node, key):
        k, left, right, _ = node
        if key < k:
            return self._balanced(k, self._drop(left, key), right)
        if key > k:
            return self._balanced(k, left, self._drop(right, key))
        if not left or not right:
            return left or right
        low = right
        while low[1]:
            low = low[1]
        return self._balanced(low[0], left, self._drop(right, low[0]))


def best_fit_decreasing(sizes: list[tuple[int, int]], capacity: int, max_bins: int | None = None) -> list[tuple[int, int, int]] | None:
    """Pack ``sizes`` (size, number of groups), given by falling size: runs (size, number
    of groups, bin). None once more than ``max_bins`` bins would open."""
    bins, opened, runs = Bins(), 0, []
    for size, count in sizes:
        while count:
            best = bins.tightest(size)
            if best is None:
                if opened == max_bins:
                    return None
                best, opened = (max(capacity, size), opened), opened + 1
            else:
                bins.drop(best)
            left, at = best
            n = min(count, left // size) if size else count
            runs.append((size, n, at))
            count -= n
            if left > n * size:
                bins.put((left - n * size, at))
    return runs


def pack(sizes: list[tuple[int, int]], n_shards: int) -> list[tuple[int, int, int]]:
    """The packing into at most ``n_shards`` bins of the smallest capacity found."""
    if not sizes:
        return []
    # groups above the mean have bins of their own and leave less for the rest
    rest, own = sum(s * c for s, c in sizes), 0
    for s, c in sizes:
        if n_shards - own > c and s > rest / (n_shards - own):
            rest, own = rest - s * c, own + c
    low = max(1, -(-rest // (n_shards - own)))
    best, high, step = best_fit_decreasing(sizes, low, n_shards), low, 1
    while best is None:                         # widen until it fits
        low, high = high, high + max(step, high >> 20)
        step *= 4
        best = best_fit_decreasing(sizes, high, n_shards)
    while best is not None and high - low > max(1, high >> 16):
        mid = (low + high) // 2
        found = best_fit_decreasing(sizes, mid, n_shards)
        if found is None:
            low = mid
        else:
            best, high = found, mid
    return best


def assign_shards(docs: DataFrame, n_shards: int = 24, capacity: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, size (UTF-8 bytes of the text + 8), text_crc32, law
    ('bytes': shard sizes near equal), shard, slot (gapless from 0 in each shard),
    grown_shard (null under this law).

    Rows with equal text share a shard; a null text counts as empty. With ``capacity``
    the number of shards is what the packing needs. Repeated rows each get a slot, rows
    without doc_id too; an empty table gives no rows. A group larger than the mean has a
    shard of its own, and shards stay empty when there are fewer groups than shards."""
    text = F.coalesce("text", F.lit(""))
    rows = pick(docs, doc_id=id_col, text=text_col).select(
        "doc_id", row_size(F.col("text")).alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), group_key(F.col("text")).alias("key"))
    rows = materialize(rows, "sizes")
    out = materialize(rows.join(group_shards(rows, n_shards, capacity), "key").select("doc_id", "size", "text_crc32", "shard"), "placed")
    return with_slots(out).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def row_size(text: Column) -> Column:
    return (F.octet_length(F.coalesce(text, F.lit(""))) + F.lit(8)).cast("bigint")


def group_key(text: Column) -> Column:
    """Equal texts have equal keys (should two texts share a key, they stay together)."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def group_shards(rows: DataFrame, n_shards: int, capacity: int | None) -> DataFrame:
    """(key, shard) of each group of ``rows`` (key, size)."""
    groups = materialize(rows.groupBy("key").agg(F.sum("size").alias("total")), "groups")
    sizes = [(r["total"], r["n"]) for r in groups.groupBy("total").agg(F.count(F.lit(1)).alias("n")).toLocalIterator()]
    sizes.sort(reverse=True)
    return place_groups(groups, pack(sizes, n_shards) if capacity is None else best_fit_decreasing(sizes, capacity))


def sharded_documents(docs: DataFrame, n_shards: int = 24, text_col: str = "text") -> DataFrame:
    """``docs`` with a column shard (more underscores in front if there is one already),
    to be written with ``partitionBy`` on it. Same packing as ``assign_shards``."""
    key, name = fresh(docs, "_key"), fresh(docs, "shard")
    keyed = docs.withColumn(key, group_key(docs[text_col]))
    placed = group_shards(docs.select(group_key(docs[text_col]).alias("key"), row_size(docs[text_col]).alias("size")), n_shards, None)
    placed = placed.select(F.col("key").alias(key), F.col("shard").alias(name))
    return keyed.join(placed, key).select(*docs.columns, name)


def write_shards(docs: DataFrame, path: str, n_shards: int = 24, text_col: str = "text") -> None:
    """Write the documents as Parquet, one folder per shard."""
    out = sharded_documents(docs, n_shards, text_col)
    out.write.partitionBy(out.columns[-1]).parquet(path)


def place_groups(groups: DataFrame, runs: list[tuple[int, int, int]]) -> DataFrame:
    """(key, shard): the i-th group of a size goes where that size's runs say. Groups of
    one size are numbered in ``SPREAD`` parts of their key."""
    by_size: dict[int, list[tuple[int, int]]] = {}
    for size, n, shard in runs:
        ends = by_size.setdefault(size, [])
        ends.append((n + (ends[-1][0] if ends else 0), shard))
    table = groups.sparkSession.createDataFrame(pa.table({
        "total": pa.array(list(by_size), pa.int64()),
        "ends": pa.array([[e for e, _ in v] for v in by_size.values()], pa.list_(pa.int64())),
        "shards": pa.array([[s for _, s in v] for v in by_size.values()], pa.list_(pa.int32()))}))
    g = groups.withColumn("part", F.pmod("key", F.lit(SPREAD)))
    before = Window.partitionBy("total").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (g.groupBy("total", "part").agg(F.count(F.lit(1)).alias("n"))
             .withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))).join(table, "total").drop("n"))
    nth = F.col("offset") + F.row_number().over(Window.partitionBy("total", "part").orderBy("key"))      # from 1
    return (g.join(parts, ["total", "part"]).withColumn("nth", nth)
            .select("key", F.element_at("shards", F.size(F.filter("ends", lambda e: e < F.col("nth"))) + 1).alias("shard")))


def with_slots(rows: DataFrame) -> DataFrame:
    """Number the rows of each shard from 0, in ``SLOT_PARTS`` parts by doc_id."""
    r = rows.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(SLOT_PARTS)))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (r.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
               .select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))
    nth = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32"))
    return r.join(offsets, ["shard", "part"]).withColumn("slot", (F.col("offset") + nth - 1).cast("bigint")).drop("part", "offset")
