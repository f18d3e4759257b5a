"""Lookup sources: row source, dictionaries built from tables, distributions as data.

Dictionaries are small by nature (bounded by a vocabulary, not by the fact table);
operators that join them broadcast them behind a size check (``operators.joins``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabsmith.functions.draws import u
from tabsmith.operators.joins import checked_broadcast
from tabsmith.operators.prefix import dense_index

# entries of the second list of a dictionary product (S-3) that meet a word at once
CROSS_CHUNK = 10_000


# ---- S-1 row source ----------------------------------------------------------------

def row_source(spark: SparkSession, n: int, batch_size: int = 1000, partitions: int | None = None) -> DataFrame:
    """n generated rows (id 0..n-1) with their batch number ``id div batch_size``.
    ``spark.range`` splits the ids over partitions; no data passes through the driver."""
    df = spark.range(0, n, 1, partitions) if partitions else spark.range(0, n)
    return numbered_rows(df, "id", batch_size)


def numbered_rows(df: DataFrame, id_col: str, batch_size: int = 1000) -> DataFrame:
    """The rows of a table as a row source: id and batch number ``id div batch_size``."""
    return df.select(F.col(id_col).alias("id"), F.call_function("div", F.col(id_col), F.lit(batch_size)).alias("batch"))


def batch_counts(rows: DataFrame, batch_col: str = "batch") -> DataFrame:
    return rows.groupBy(batch_col).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("id").alias("first_id"), F.max("id").alias("last_id")
    )


# ---- S-2 lookup source -------------------------------------------------------------

def dictionary(df: DataFrame, value_col: str, idx_col: str = "idx", out_col: str = "value") -> DataFrame:
    """Distinct values of a column as a dense (idx, value) dictionary."""
    return dense_index(df, value_col, idx_col).withColumnRenamed(value_col, out_col)


def weights_table(spark: SparkSession, items: Sequence[tuple], key_type: str = "string") -> DataFrame:
    """Ordered distribution [(key, weight), ...] as (ord, key, weight, lo, hi) where
    [lo, hi) is the slice of [0, 1) that the cumulative scan gives each key."""
    rows, cum = [], 0.0
    for i, (k, w) in enumerate(items):
        lo = cum
        cum = cum + float(w)
        rows.append((i, k, float(w), lo, cum))
    return spark.createDataFrame(rows, f"ord int, key {key_type}, weight double, lo double, hi double")


def weighted_case(draw: Column, items: Sequence[tuple], default) -> Column:
    """Cumulative scan as a CASE ladder: the first key whose cumulative weight exceeds
    the draw, else ``default`` (weights summing past 1 leave the tail unreachable)."""
    cum, expr = 0.0, None
    for k, w in items:
        cum = cum + float(w)
        expr = F.when(draw < F.lit(cum), F.lit(k)) if expr is None else expr.when(draw < F.lit(cum), F.lit(k))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def sql_weighted_case(draw: str, items: Sequence[tuple], default) -> str:
    cum, parts = 0.0, []
    for k, w in items:
        cum = cum + float(w)
        parts.append(f"WHEN {draw} < CAST({cum!r} AS DOUBLE) THEN {_sql_lit(k)}")
    return f"(CASE {' '.join(parts)} ELSE {_sql_lit(default)} END)"


def _sql_lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def tier_table(spark: SparkSession, tiers: Sequence[tuple[int, int, int]]) -> tuple[DataFrame, int]:
    """Positional step weights [(lo, hi, weight), ...] as (value, weight, cum_lo, cum_hi)
    with integer cumulative weights, plus the total weight."""
    lo_all, hi_all = min(t[0] for t in tiers), max(t[1] for t in tiers)
    wexpr = None
    for lo, hi, w in tiers:
        cond = F.col("id").between(lo, hi)
        wexpr = F.when(cond, F.lit(w)) if wexpr is None else wexpr.when(cond, F.lit(w))
    base = spark.range(lo_all, hi_all + 1).select(F.col("id").alias("value"), wexpr.otherwise(0).cast("bigint").alias("weight"))
    w = Window.orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    table = base.withColumn("cum_hi", F.sum("weight").over(w)).withColumn("cum_lo", F.col("cum_hi") - F.col("weight"))
    total = sum((hi - lo + 1) * w for lo, hi, w in tiers)
    return table, total


# ---- S-3 .. S-7 dictionary building ------------------------------------------------

def dict_cross(a: DataFrame, a_col: str, b: DataFrame, b_col: str, sep: str = " ", out_col: str = "phrase",
               chunk: int = CROSS_CHUNK) -> DataFrame:
    """Phrases a + sep + b for every pair of two word lists.

    The product is the feature, so its size is |a| x |b|. The second list is cut into
    chunks of about ``chunk`` entries (one array each); every word of ``a`` meets every
    chunk by its number, so no list is refused and no array grows with it."""
    bd = b.select(F.col(b_col).alias("_b")).distinct()
    n = F.greatest(F.lit(1), F.ceil(bd.agg(F.count(F.lit(1))).scalar() / F.lit(chunk))).cast("int")
    chunks = bd.withColumn("_c", F.pmod(F.xxhash64("_b"), n).cast("int")).groupBy("_c").agg(F.collect_list("_b").alias("_bs"))
    words = a.select(F.col(a_col).alias("_a")).distinct().withColumn("_c", F.explode(F.sequence(F.lit(0), n - 1)))
    pairs = words.join(chunks, "_c").select("_a", F.explode("_bs").alias("_b"))
    return pairs.select(F.concat_ws(sep, "_a", "_b").alias(out_col))


def dict_flatten(df: DataFrame, key_cols: Sequence[str], list_col: Column, pos_col: str = "pos",
                 value_col: str = "value") -> DataFrame:
    """Map of lists -> rows (key..., pos, value); pos is 1-based."""
    return df.select(*key_cols, F.posexplode(list_col).alias("_p", value_col)).select(
        *key_cols, (F.col("_p") + 1).cast("bigint").alias(pos_col), value_col
    )


def dict_variants(df: DataFrame, col: str, prefixes: Sequence[str], sep: str = " ",
                  out_col: str = "variant") -> DataFrame:
    """Every entry in several prefixed forms (one row per prefix)."""
    arr = F.array(*[F.lit(p) for p in prefixes])
    return df.select(col, F.explode(arr).alias("_pre")).select(
        col, F.concat_ws(sep, "_pre", col).alias(out_col)
    )


def dict_union_distinct(parts: Sequence[DataFrame], col: str = "value") -> DataFrame:
    """Union of word lists without duplicates."""
    out = parts[0].select(col)
    for p in parts[1:]:
        out = out.unionByName(p.select(col))
    return out.distinct()


def dict_topup(tranches: DataFrame, threshold: int, tranche_col: str = "tranche",
               value_col: str = "value") -> DataFrame:
    """Append tranche t only while the distinct size of the tranches before it is below
    ``threshold``. Returns (value, tranche) for the kept values, each at its first tranche."""
    first = tranches.where(F.col(value_col).isNotNull()).groupBy(value_col).agg(
        F.min(tranche_col).alias(tranche_col))
    per_t = first.groupBy(tranche_col).agg(F.count(F.lit(1)).alias("_new"))
    w = Window.orderBy(tranche_col).rowsBetween(Window.unboundedPreceding, -1)
    kept = per_t.withColumn("_before", F.coalesce(F.sum("_new").over(w), F.lit(0))).where(
        F.col("_before") < threshold).select(tranche_col)
    # one row per tranche: a handful of rows, safe to broadcast
    return first.join(checked_broadcast(kept), tranche_col, "left_semi")


def tokens(col: str | Column, pattern: str = r"\s+") -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.split(F.trim(c), pattern)


__all__ = [
    "row_source", "numbered_rows", "batch_counts", "dictionary", "weights_table", "weighted_case", "sql_weighted_case",
    "tier_table", "dict_cross", "dict_flatten", "dict_variants", "dict_union_distinct", "dict_topup", "tokens", "u",
]
