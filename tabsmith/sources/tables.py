"""Reading the input tables (parquet, one folder or file per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabsmith.session import table_path

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(table_path(sf_dir, name))
