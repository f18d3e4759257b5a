"""Keyed state across micro-batches.

T-1 ``run_usage_cap``: the n-th use per key carried across micro-batches. Inside a
micro-batch the rows are numbered natively (per key and time block, so a hot key is not
one task's work); the state is one snapshot of a count per key. Batch k reads the snapshot
of batch k - 1 and writes its own into the other of two folders, so work and disk follow
the number of keys and not that of batches, and a replayed batch finds the snapshot it
read before and changes nothing. Across micro-batches arrival order decides: a row that
arrives late gets a later number.

T-2 ``stream_first_seen``: first value per key (``dropDuplicates`` keeps state per key;
with a watermark column, ``dropDuplicatesWithinWatermark``, whose state expires).

T-3 ``stream_progress``: tumbling-window counts in update mode. Every row counts; only a
caller who asks for a watermark gives up rows that come later than it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tabsmith.operators.prefix import keyed_row_number


def run_usage_cap(stream: DataFrame, out: str, counts: str, checkpoint: str, key_col: str, order_cols: Sequence[str],
                  block: Column) -> StreamingQuery:
    """T-1: writes (columns of the stream, use_no) under ``out``/batch=k, use numbers
    continuing across micro-batches; ``counts``/slot=k mod 2 holds the uses per key after
    batch k."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        spark, cols = batch.sparkSession, batch.columns
        numbered = keyed_row_number(batch, [key_col], order_cols, block, "use_no")
        state = None
        if batch_id > 0:
            state = spark.read.parquet(f"{counts}/slot={(batch_id - 1) % 2}").select(F.col(key_col).alias("_key"), F.col("n").alias("_before"))
            numbered = (numbered.join(state, F.col(key_col).eqNullSafe(F.col("_key")), "left")
                        .withColumn("use_no", F.col("use_no") + F.coalesce("_before", F.lit(0))))
        numbered.select(*cols, "use_no").write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        uses = spark.read.parquet(f"{out}/batch={batch_id}").groupBy(key_col).agg(F.count(F.lit(1)).alias("n"))
        if state is not None:
            uses = uses.union(state).groupBy(key_col).agg(F.sum("n").alias("n"))
        uses.write.mode("overwrite").parquet(f"{counts}/slot={batch_id % 2}")

    return (stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def stream_first_seen(stream: DataFrame, key_col: str, ts_col: str | None = None, delay: str = "1 day") -> DataFrame:
    """T-2: one row per key, the first one the stream delivers. With ``ts_col`` the state
    of a key expires ``delay`` after it was seen (a later repeat comes through again)."""
    if ts_col is None:
        return stream.dropDuplicates([key_col])
    return stream.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark([key_col])


def stream_progress(stream: DataFrame, ts_col: str, window: str = "1 day", delay: str | None = None) -> DataFrame:
    """T-3: rows per tumbling event-time window. ``ts_col`` is a TIMESTAMP; for naive
    wall-clock input build it with ``timestamp_micros`` of the naive microseconds so
    windows align to wall-clock days in any session zone. Rows without a time belong to no
    window. ``delay``: drop state of windows older than this, and rows that come later."""
    s = stream if delay is None else stream.withWatermark(ts_col, delay)
    return s.groupBy(F.window(ts_col, window).alias("w")).agg(F.count(F.lit(1)).alias("n_rows")) \
        .select(F.col("w.start").alias("window_start"), "n_rows")
