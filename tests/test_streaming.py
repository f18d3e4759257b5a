"""T-1 and T-3 across several micro-batches and under replay."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tabsmith.plans import bind_stream
from tabsmith.plans.bind_keyed import day_block
from tabsmith.session import scratch_path
from tabsmith.streaming import keyed_state
from tests.conftest import SF_CHECK


def _expected_uses(ev):
    return ev.withColumn("use_no", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
                         .cast("bigint")).select("event_id", "user_id", "use_no")


def test_usage_cap_spans_micro_batches_and_survives_replay(spark):
    ev = spark.read.parquet(f"{SF_CHECK}/events.parquet").select("event_id", "ts", "user_id")
    out, counts = scratch_path(spark, "t1-out"), scratch_path(spark, "t1-counts")
    for run in range(2):        # a second run from the start replays every batch
        stream = bind_stream.events_stream(spark, SF_CHECK).select("event_id", "ts", "user_id")
        q = keyed_state.run_usage_cap(stream, out, counts, scratch_path(spark, "t1-ckpt"), "user_id", ["ts", "event_id"], day_block())
        q.awaitTermination()
        got = spark.read.parquet(out)
        assert got.select("batch").distinct().count() >= 3
        got = got.select("event_id", "user_id", "use_no")
        assert got.count() == ev.count()
        assert got.exceptAll(_expected_uses(ev)).count() == 0


def test_progress_counts_every_row_and_survives_replay(spark):
    ev = spark.read.parquet(f"{SF_CHECK}/events.parquet")
    out = scratch_path(spark, "t3-out")
    for run in range(2):
        s = bind_stream.events_stream(spark, SF_CHECK).withColumn("ets", F.col("ts").cast("timestamp"))
        res = bind_stream.run_updates(spark, keyed_state.stream_progress(s, "ets"), "t3", ["window_start"], out)
        assert res.agg(F.sum("n_rows")).first()[0] == ev.count()
