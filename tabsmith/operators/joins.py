"""Join helpers: a broadcast hint only behind a check of the size in bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# bound on the estimated bytes of a lookup that is broadcast
BROADCAST_MAX_BYTES = 64 << 20


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimized plan (an upper estimate for filters,
    projections and aggregates over files)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def checked_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast hint when the estimated size is within the bound; above it the plain
    DataFrame is returned and Spark plans a shuffle join (AQE may still convert it at
    run time under ``spark.sql.adaptive.autoBroadcastJoinThreshold``)."""
    return F.broadcast(df) if estimated_bytes(df) <= max_bytes else df
