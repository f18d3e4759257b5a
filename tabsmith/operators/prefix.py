"""Prefix sums and per-key row numbers that never put a whole table or a whole hot
key into one task.

``prefix_sum``: blocked running sum over a unique long order key. Rows are cut into
blocks of ``block_size`` consecutive keys; per-block totals are aggregated (partial
aggregation, one row per block) and turned into block offsets by the same procedure one
level up (blocks of blocks), and the running sum inside each block is a window
partitioned by block. Three levels of 65,536 leave at most 2^16 rows for the only
unpartitioned window, however sparse a 64-bit key is (dense ids: n / 2^48 rows).

``keyed_row_number``: ``row_number() over (partition by keys order by ...)`` where each
key is further cut by a block column that is non-decreasing in the order (a day of
the timestamp, a range of ids). Counts per (key, block) give per-block offsets, so a
key holding a third of all rows is numbered by many tasks instead of one. Null keys and
null order values are numbered like others (null order values last).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsmith.operators.joins import checked_broadcast
from tabsmith.session import materialize

DEFAULT_BLOCK = 65536


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def levels_for(df: DataFrame, order_col: str, block_size: int = DEFAULT_BLOCK) -> int:
    """How many levels of blocks leave at most about ``block_size`` rows for the top window,
    from the smallest and largest key (one aggregate over one column)."""
    lo, hi = df.agg(F.min(F.col(order_col).cast("bigint")), F.max(F.col(order_col).cast("bigint"))).first()
    levels, span = 1, 0 if lo is None else (hi - lo) // block_size
    while span > block_size:
        levels, span = levels + 1, span // block_size
    return levels


def prefix_sum(
    df: DataFrame,
    order_col: str,
    sums: Sequence[tuple[str | Column, str]],
    block_size: int = DEFAULT_BLOCK,
    inclusive: bool = False,
    levels: int = 3,
) -> DataFrame:
    """Add running sums ``out = sum(value) over rows with order < this row`` (or <= when
    ``inclusive``) for each (value, out) pair. ``order_col`` is unique; it may be negative
    and sparse (hashed ids). A row without it is kept, with null sums.

    Block totals are themselves summed in blocks: with ``levels`` = 3 the unpartitioned
    window has one row per occupied block of block_size^3 keys."""
    return _prefix(df, order_col, sums, block_size, inclusive, levels, F.sum, lambda a, b: a + b, 0)


def prefix_max(df: DataFrame, order_col: str, values: Sequence[tuple[str | Column, str]], least: int, block_size: int = DEFAULT_BLOCK,
               inclusive: bool = False, levels: int = 3) -> DataFrame:
    """As ``prefix_sum``, with the largest value so far, ``least`` when there is none."""
    return _prefix(df, order_col, values, block_size, inclusive, levels, F.max, F.greatest, least)


def _prefix(df, order_col, sums, block_size, inclusive, levels, fold, join, empty) -> DataFrame:
    vals = [(F.col(v) if isinstance(v, str) else v, out) for v, out in sums]
    blk, vs = f"_blk{levels}", [f"_v{levels}_{i}" for i in range(len(vals))]
    ts, os_ = [f"_t{levels}_{i}" for i in range(len(vals))], [f"_o{levels}_{i}" for i in range(len(vals))]
    key = F.col(order_col).cast("bigint")       # div rounds towards 0, blocks go down
    d = df.withColumn(blk, F.when(key >= 0, F.call_function("div", key, F.lit(block_size)))
                      .otherwise(F.call_function("div", key + 1, F.lit(block_size)) - 1))
    for v_name, (v, _) in zip(vs, vals):
        d = d.withColumn(v_name, v.cast("bigint"))
    totals = d.where(F.col(blk).isNotNull()).groupBy(blk).agg(*[fold(v).alias(t) for v, t in zip(vs, ts)])
    if levels > 1:
        offsets = _prefix(totals, blk, list(zip(ts, os_)), block_size, False, levels - 1, fold, join, empty)
        offsets = offsets.select(blk, *os_)
    else:
        w_blocks = Window.orderBy(blk).rowsBetween(Window.unboundedPreceding, -1)
        offsets = totals.select(blk, *[F.coalesce(fold(t).over(w_blocks), F.lit(empty)).alias(o) for t, o in zip(ts, os_)])
    end = 0 if inclusive else -1
    w_in = Window.partitionBy(blk).orderBy(order_col).rowsBetween(Window.unboundedPreceding, end)
    out = d.join(offsets, blk, "left")
    for v_name, o, (_, name) in zip(vs, os_, vals):
        out = out.withColumn(name, join(F.col(o), F.coalesce(fold(v_name).over(w_in), F.lit(empty))).cast("bigint"))
    return out.drop(blk, *vs, *os_)


def keyed_row_number(
    df: DataFrame,
    keys: Sequence[str],
    order_cols: Sequence[str | Column],
    block: Column,
    out_col: str,
) -> DataFrame:
    """``row_number()`` per key in ``order_cols`` order, computed per (key, block).

    Null keys are one key and null blocks one block, after the others: each is carried as
    (is null, filled value), plain columns on which window and join share one shuffle."""
    d = df.withColumn("__kb", block)
    split = {}
    for i, k in enumerate([*keys, "__kb"]):
        split[f"__kf{i}"] = F.col(k).isNull()
        split[f"__kv{i}"] = F.coalesce(F.col(k), filler(d.schema[k].dataType))
    d = d.withColumns(split)
    parts = list(split)
    key_parts, block_parts = parts[:-2], parts[-2:]
    counts = d.groupBy(*parts).agg(F.count(F.lit(1)).alias("__kn"))
    w_keys = Window.partitionBy(*key_parts).orderBy(*block_parts).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*parts, F.coalesce(F.sum("__kn").over(w_keys), F.lit(0)).alias("__koff"))
    w_in = Window.partitionBy(*parts).orderBy(*[c.asc_nulls_last() for c in _cols(order_cols)])
    numbered = d.withColumn("__krn", F.row_number().over(w_in))
    out = numbered.join(offsets, parts, "inner").withColumn(out_col, (F.col("__koff") + F.col("__krn")).cast("bigint"))
    return out.select(*df.columns, out_col)


def filler(kind: T.DataType) -> Column:
    """Any value of a type, to stand for null."""
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01").cast(kind)
    return F.lit("").cast(kind) if isinstance(kind, (T.StringType, T.BinaryType)) else F.lit(0).cast(kind)


def dense_index(df: DataFrame, value_col: str, idx_col: str = "idx") -> DataFrame:
    """Dictionary (idx, value): distinct values numbered 0.. in value order, of any size.

    Values are dealt to ranges (``repartitionByRange``) and written once with their range;
    a range's offset is the count of the ranges before it (one row per range), and values
    are numbered inside their range. No window goes over all values."""
    dist = df.select(value_col).where(F.col(value_col).isNotNull()).distinct()
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialize(dist.repartitionByRange(parts, value_col).withColumn("__range", F.spark_partition_id()), "dictionary")
    sizes = dealt.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    inside = F.row_number().over(Window.partitionBy("__range").orderBy(value_col)) - 1
    numbered = dealt.withColumn("__in", inside).join(checked_broadcast(offsets), "__range")
    return numbered.select((F.col("__off") + F.col("__in")).cast("bigint").alias(idx_col), F.col(value_col))
