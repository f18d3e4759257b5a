"""The table by day, and the report observed while its table is written."""

from pyspark.sql import functions as F

from tabsmith.operators import profile
from tabsmith.session import scratch_path
from tabsmith.sources import sinks
from tests.conftest import SF_SMALL


def test_days_are_replaced_alone_and_pruned(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id", "ts").withColumn("ts", F.when(F.col("event_id") % 50 != 0, F.col("ts")))
    path = scratch_path(spark, "days")
    whole = sinks.sink_by_day(ev, "ts", path)
    assert whole.select("event_id", "ts").exceptAll(ev).count() == 0 and whole.count() == ev.count()
    day = ev.agg(F.max(F.to_date("ts"))).first()[0]
    one = ev.where(F.to_date("ts") == F.lit(day))
    again = sinks.sink_by_day(one, "ts", path)
    assert again.select("event_id", "ts").exceptAll(ev).count() == 0 and again.count() == ev.count()
    changed = sinks.sink_by_day(one.withColumn("event_id", -F.col("event_id")), "ts", path)
    assert changed.count() == ev.count() and changed.where("event_id < 0").count() == one.where("event_id > 0").count()
    plan = changed.where(F.col("visit_day") == F.lit(day))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(visit_day" in plan


def test_key_stats_expand_no_rows(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "b", "x"), (None, "b", "x"), (2, None, "y")], "p long, c string, k string")
    out = profile.key_stats(df, "p", "c", "k")
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()
    assert tuple(out.select("unique_passports", "unique_clients", "cards_in_use", "total_card_usage").first()) == (2, 2, 2, 3)
    none = profile.key_stats(df.limit(0), "p", "c", "k")
    assert tuple(none.first()) == (0, 0, 0, 0)
