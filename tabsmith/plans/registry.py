"""Registry of bound queries: key -> (builder(spark, sf_dir) -> DataFrame, oracle SQL).

Each binding runs one operator over the driver tables (whole tables, no row caps) and
carries an independent SQL formulation for DuckDB over the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return deco
