"""All bound queries, imported for their registration side effect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabsmith.plans import (  # noqa: F401
    bind_derive, bind_draws, bind_keyed, bind_profile, bind_quality, bind_sources, bind_stream, bind_visits)
from tabsmith.plans.registry import ORACLES, QUERIES


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The assembled visit table with its row-rule errors (K-7 + V-17)."""
    return QUERIES["visit_errors"](spark, sf_dir)


__all__ = ["QUERIES", "ORACLES", "flagship"]
