"""Written stages leave no shuffle files behind."""

import time

from pyspark.sql import functions as F

from tabsmith.session import WHILE_WRITING, materialize


def shuffle_files(spark) -> set[str]:
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {x for x in blocks.mkString(",").split(",") if x.startswith("shuffle_")}


def test_settings_hold_only_while_a_stage_is_written(spark):
    settings = {x: spark.conf.get(x, None) for x in WHILE_WRITING}
    kept = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    out = materialize(kept.join(spark.range(7).withColumnRenamed("id", "k").repartition(3, "k"), "k"), "cleaned")
    assert {r["k"]: r["count"] for r in out.collect()} == {r["k"]: r["count"] for r in kept.collect()}
    assert {x: spark.conf.get(x, None) for x in WHILE_WRITING} == settings


def test_no_shuffle_files_wait_for_the_driver(spark):
    before = shuffle_files(spark)
    materialize(spark.range(1000).repartition(5).groupBy((F.col("id") % 7).alias("k")).count(), "cleaned")
    for _ in range(100):                # files go in the background
        if not shuffle_files(spark) - before:
            return
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
