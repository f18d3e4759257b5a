"""Working-time edge rows (FIXTURES §5) on inline rows."""

import datetime as dt

from pyspark.sql import functions as F

from tabsmith.functions import timecols
from tabsmith.operators import quality


def _snap(spark, ts, hours):
    df = spark.createDataFrame([(ts, hours)], "ts timestamp_ntz, h int")
    return df.select(timecols.result_snap(F.col("ts"), F.col("h")).alias("r")).first()["r"]


def test_friday_evening_rolls_to_monday(spark):
    fri = dt.datetime(2024, 1, 5, 17, 45)                  # Friday
    assert _snap(spark, fri, 24) == dt.datetime(2024, 1, 8, 17, 45)   # Sat 17:45 -> Mon 17:45
    assert _snap(spark, fri, 25) == dt.datetime(2024, 1, 8, 17, 0)    # Sat 18:45 -> Mon 18:45 -> 17:00
    assert _snap(spark, fri, 72) == dt.datetime(2024, 1, 8, 17, 45)   # Mon 17:45 stays
    assert _snap(spark, fri, 40) == dt.datetime(2024, 1, 8, 9, 45)    # Sun 09:45 -> Mon 09:45 (in hours)
    assert _snap(spark, fri, 36) == dt.datetime(2024, 1, 8, 9, 0)     # Sun 05:45 -> Mon 05:45 -> 09:00


def test_tuesday_plus_25h_is_clamped_below_24h(spark):
    tue = dt.datetime(2024, 1, 2, 17, 30)
    r = _snap(spark, tue, 25)                               # Wed 18:30 -> 17:00, 23.5 h later
    assert r == dt.datetime(2024, 1, 3, 17, 0)
    df = spark.createDataFrame([(tue, r)], "v timestamp_ntz, r timestamp_ntz")
    assert df.select(quality.gap_broken("v", "r")).first()[0] is True


def test_seconds_are_kept_when_hour_is_replaced(spark):
    ts = dt.datetime(2024, 1, 2, 3, 7, 11, 500)            # Tue 03:07:11.0005 + 24h -> Wed 03:07 -> 09:00:11.0005
    assert _snap(spark, ts, 24) == dt.datetime(2024, 1, 3, 9, 0, 11, 500)


def test_work_slot_is_on_working_days_and_hours(spark):
    df = spark.range(0, 2000).select(timecols.work_slot("t", "id", "2024-02-29").alias("v"))
    bad = df.where(~quality.working_day_ok("v") | ~quality.working_hour_ok("v") | (F.minute("v") % 15 != 0))
    assert bad.count() == 0
    assert df.agg(F.max("v")).first()[0] < dt.datetime(2024, 3, 1)
    assert df.agg(F.min("v")).first()[0] >= dt.datetime(2024, 1, 30)


def test_iso_text(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 2, 29, 9, 15),)], "ts timestamp_ntz")
    assert df.select(timecols.iso_text("ts")).first()[0] == "2024-02-29T09:15+03:00"
