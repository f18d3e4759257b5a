"""Sinks S-8..S-10: written with the DataFrame writer into a folder the caller names
(on a cluster: a shared file system, e.g. under ``spark.checkpoint.dir``), then read
back lazily, so later steps start from the written table instead of the lineage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def sink_project(df: DataFrame, drop: Sequence[str], rename: Mapping[str, str], path: str,
                 mode: str = "overwrite") -> DataFrame:
    """S-8: drop columns, rename the rest, write parquet, return the table read back."""
    out = df.drop(*drop).withColumnsRenamed(dict(rename))
    out.write.mode(mode).parquet(path)
    return df.sparkSession.read.parquet(path)


def sink_by_day(df: DataFrame, ts_col: str, path: str, day_col: str = "visit_day") -> DataFrame:
    """S-8 as a repeatable table: one folder per day of ``ts_col``, read back. Only the days
    in ``df`` are written anew (dynamic partition overwrite), so writing a day twice changes
    nothing and other days stay; a filter on the day reads its folder alone. Rows without a
    time go to a folder of their own. Rows are dealt by day and a few parts of it, so a busy
    day is written by several tasks and no task opens all folders."""
    parts = F.pmod(F.monotonically_increasing_id(), F.lit(8))
    dealt = df.withColumns({day_col: F.to_date(ts_col), "_part": parts}).repartition(day_col, "_part").drop("_part")
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day_col).parquet(path)
    kind = dealt.schema
    return df.sparkSession.read.schema(kind).parquet(path)


def sink_csv(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """S-9: CSV with a header, UTF-8; read back with the written schema (no inference)."""
    df.write.mode(mode).option("header", True).option("encoding", "UTF-8").csv(path)
    return df.sparkSession.read.schema(df.schema).option("header", True).csv(path)


def report_lines(metrics_long: DataFrame, metric_col: str = "metric", value_col: str = "value") -> DataFrame:
    """Metric rows -> report text lines ``metric: value``."""
    return metrics_long.select(F.concat_ws(": ", F.col(metric_col), F.col(value_col)).alias("value"))


def sink_report(metrics_long: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """S-10: the report as a text file, one line per metric; read back as lines."""
    report_lines(metrics_long).write.mode(mode).text(path)
    spark: SparkSession = metrics_long.sparkSession
    return spark.read.text(path)
