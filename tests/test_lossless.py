"""Null keys, null order values and sparse ids: no row is lost, numbers as in plain windows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tabsmith.operators import draws, keyed, quality
from tabsmith.operators.prefix import keyed_row_number, prefix_sum
from tabsmith.plans.bind_keyed import day_block
from tests.conftest import SF_SMALL


def _events(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id", "user_id", "ts")
    ts = F.when(F.col("event_id") % 10 != 0, F.col("ts"))
    return ev.withColumn("ts", ts).withColumn("user_id", F.when(F.col("event_id") % 7 != 0, F.col("user_id")))


def test_usage_cap_keeps_rows_without_time_or_key(spark):
    ev = _events(spark)
    got = keyed.usage_cap(ev, ["user_id"], ["ts", "event_id"], day_block())
    w = Window.partitionBy("user_id").orderBy(F.col("ts").asc_nulls_last(), "event_id")
    want = ev.select("event_id", F.row_number().over(w).cast("bigint").alias("use_no"))
    assert got.count() == ev.count()
    assert got.select("event_id", "use_no").exceptAll(want).count() == 0
    over = want.where("use_no > 5")
    assert quality.cap_violations(got).select("event_id").exceptAll(over.select("event_id")).count() == 0


def test_numbering_adds_no_second_shuffle_of_the_table(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = keyed_row_number(_events(spark), ["user_id"], ["ts", "event_id"], day_block(), "n")
        plan = out._jdf.queryExecution().sparkPlan().toString()
        assert "coalesce(user_id" not in plan.split("SortMergeJoin")[1].splitlines()[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_revisit_gap_with_null_times(spark):
    ev = _events(spark).withColumn("res", F.col("ts") + F.expr("INTERVAL 1 HOUR"))
    out = quality.revisit_gaps(ev, "user_id", "ts", "res", "event_id", day_block())
    assert out.count() == ev.count()


def test_prefix_sum_on_hashed_ids(spark):
    df = spark.range(5000).select(F.xxhash64("id").alias("k"), (F.col("id") % 5).alias("v"))
    got = prefix_sum(df, "k", [("v", "s")])
    want = df.withColumn("s", F.coalesce(F.sum("v").over(Window.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    assert got.count() == 5000
    assert got.select("k", "s").exceptAll(want.select("k", "s")).count() == 0


def test_prefix_sum_keeps_rows_without_order(spark):
    df = spark.createDataFrame([(1, 2), (None, 3), (5, 4)], "k long, v long")
    got = {r.k: r.s for r in prefix_sum(df, "k", [("v", "s")], inclusive=True).collect()}
    assert got == {1: 2, 5: 6, None: None}


def test_unique_batch_places_every_row(spark):
    rows = spark.range(3000).withColumnRenamed("id", "k")
    out = draws.unique_batch(rows, "k", "t", "value")
    r = out.agg(F.count("value").alias("n"), F.count_distinct("value").alias("d")).first()
    assert (r.n, r.d) == (3000, 3000)


def test_cost_of_any_length(spark):
    df = spark.createDataFrame([("123456789012345678901 руб.",), ("-5 руб.",), ("007 руб.",), ("x руб.",), (None,)], "t string")
    got = [(r.ok, r.a, r.o) for r in df.select(quality.cost_ok("t").alias("ok"), quality.cost_amount("t").alias("a"),
                                               quality.cost_overflow("t").alias("o")).collect()]
    assert got[0][:2] == (True, None) and got[0][2] is True
    assert got[1] == (False, -5, False) and got[2] == (True, 7, False) and got[3][:2] == (False, None)
