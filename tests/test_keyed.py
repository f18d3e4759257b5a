"""Keyed pools: contracts, edge rows and partition independence."""

import pytest
from pyspark.sql import functions as F

from tabsmith.operators import keyed, prefix
from tests.conftest import SF_CHECK


def _events(spark):
    return spark.read.parquet(f"{SF_CHECK}/events.parquet")


def test_card_cap_never_exceeded_and_only_earlier_cards(spark):
    out = keyed.pool_reuse(_events(spark).select("event_id"), "event_id")
    assert out.agg(F.max("use_no")).first()[0] <= 5
    # a card id is the visit number that opened it, so reuse never points forward
    assert out.where(F.col("card_id") > F.col("event_id")).count() == 0
    per_card = out.groupBy("card_id").agg(F.count(F.lit(1)).alias("n"), F.max("use_no").alias("m"))
    assert per_card.where(F.col("n") != F.col("m")).count() == 0


def test_sixth_use_opens_a_new_card(spark):
    # 12 rows that all want to reuse: with p_reuse = 1 every row after the first reuses card 0
    rows = spark.range(0, 12).withColumnRenamed("id", "k")
    out = keyed.pool_reuse(rows, "k", p_reuse=1.0).orderBy("k").collect()
    assert [r.card_id for r in out[:5]] == [0, 0, 0, 0, 0]
    assert out[5].card_id == 5 and out[5].new_card and out[5].use_no == 1


def test_repeat_assign_first_rows_are_new_and_picks_are_earlier(spark):
    out = keyed.repeat_assign(_events(spark).select("event_id"), "event_id")
    assert out.where((F.col("event_id") < 50) & ~F.col("is_new")).count() == 0
    new_no = out.where("is_new").select(F.col("client_no").alias("c"), F.col("event_id").alias("first"))
    j = out.join(new_no, out.client_no == new_no.c)
    assert j.where(F.col("first") > F.col("event_id")).count() == 0


def test_same_rows_under_1_and_8_partitions(spark):
    ev = _events(spark).select("event_id")
    a = keyed.repeat_assign(ev.repartition(1), "event_id")
    b = keyed.repeat_assign(ev.repartition(8), "event_id")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("block_size,levels", [(37, 2), (5, 2), (5, 1), (3, 3)])
def test_prefix_sum_small_blocks_match_window(spark, block_size, levels):
    df = spark.range(0, 1000).withColumn("x", (F.col("id") % 7).cast("bigint"))
    got = prefix.prefix_sum(df, "id", [("x", "s")], block_size=block_size, levels=levels)
    from pyspark.sql import Window
    w = Window.orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    exp = df.withColumn("s", F.coalesce(F.sum("x").over(w), F.lit(0)).cast("bigint"))
    assert got.select("id", "x", "s").exceptAll(exp.select("id", "x", "s")).count() == 0


def test_keyed_row_number_hot_key_split(spark):
    # one key holds most rows; blocks of 100 ids split it over many tasks
    df = spark.range(0, 3000).withColumn("k", F.when(F.col("id") % 10 < 8, F.lit(1)).otherwise(F.col("id") % 3))
    got = prefix.keyed_row_number(df, ["k"], ["id"], F.floor(F.col("id") / 100), "rn")
    from pyspark.sql import Window
    exp = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("id")).cast("bigint"))
    assert got.select("id", "k", "rn").exceptAll(exp.select("id", "k", "rn")).count() == 0


def test_empty_input(spark):
    empty = spark.range(0, 0).withColumnRenamed("id", "k")
    assert keyed.repeat_assign(empty, "k").count() == 0
    assert keyed.pool_reuse(empty, "k").count() == 0
