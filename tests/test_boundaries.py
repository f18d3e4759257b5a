"""Boundary rows and partition independence of more operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tabsmith.operators import derive, draws, keyed, quality
from tests.conftest import SF_CHECK


def test_feb29_visit_never_drops_a_row(spark):
    rows = [(1, dt.date(1990, 3, 1), dt.datetime(2024, 2, 29, 10, 0)),   # birthday after the visit day
            (2, dt.date(2010, 2, 28), dt.datetime(2024, 2, 29, 10, 0)),  # age 14 exactly one day before
            (3, dt.date(2004, 2, 1), dt.datetime(2024, 2, 29, 10, 0))]   # turns 20 in the visit month
    df = spark.createDataFrame(rows, "k long, birth date, visit timestamp_ntz")
    out = df.select("k", "birth", "visit", derive.issue_date(F.col("birth"), F.col("visit"), "t", "k").alias("issue"))
    got = {r.k: r for r in out.collect()}
    assert len(got) == 3 and all(r.issue is not None for r in got.values())
    for r in got.values():
        assert r.issue <= r.visit.date()
        assert r.issue >= dt.date(1997, 10, 1)
    # k=2: window start = 14th birthday 2024-02-28, end = visit - 30 days = 2024-01-30 -> empty,
    # so the issue date is max(start, visit - 365 days = 2023-03-01) = 2024-02-28
    assert got[2].issue == dt.date(2024, 2, 28)


def test_unknown_country_is_an_error(spark):
    df = spark.createDataFrame([(1, "xx")], "k long, country string")
    with pytest.raises(Exception, match="unsupported country"):
        df.select(derive.foreign_passport(F.col("country"), "t", "k")).collect()


def test_missing_snils_and_unknown_country_rules(spark):
    df = spark.createDataFrame([("ru", None), ("ru", ""), ("by", "bad"), ("ru", "112-233-445 95")],
                               "country string, snils string")
    assert [r[0] for r in df.select(quality.snils_scope_broken("country", "snils")).collect()] == \
        [False, False, False, False]
    fmt = spark.createDataFrame([("AB1234567", "by"), ("N12345678", "xx")], "p string, c string")
    assert [r[0] for r in fmt.select(quality.passport_format_ok("p", "c")).collect()] == [True, False]


def test_cost_texts(spark):
    df = spark.createDataFrame([("0 руб.",), ("-5 руб.",), ("abc руб.",), ("2000 руб.",), ("2000 rub",)], "t string")
    got = [(r.ok, r.amount) for r in df.select(quality.cost_ok("t").alias("ok"), quality.cost_amount("t").alias("amount")).collect()]
    assert got == [(False, 0), (False, -5), (False, None), (True, 2000), (False, None)]


def test_group_shorter_than_k_and_absent_group(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "zz")], "k long, g string")
    own = spark.createDataFrame([("a", "x"), ("b", "x"), ("b", "y"), ("b", "z")], "g string, item string")
    general = spark.createDataFrame([("x",), ("p",), ("q",)], "item string")
    out = draws.fallback_fill(rows, ["k"], "g", own, general, "item", F.lit(3), 3, "t")
    got = {}
    for r in out.collect():
        got.setdefault(r.k, set()).add(r.item)
    assert got[1] == {"x", "p", "q"}            # own 'x' + general minus 'x'
    assert got[2] == {"x", "y", "z"}            # own list long enough
    assert got[3] == {"x", "p", "q"}            # absent group -> general only


@pytest.mark.parametrize("parts", [1, 8])
def test_pool_and_sampling_independent_of_partitions(spark, parts):
    ev = spark.read.parquet(f"{SF_CHECK}/events.parquet").select("event_id")
    base = keyed.pool_reuse(ev, "event_id")
    again = keyed.pool_reuse(ev.repartition(parts), "event_id")
    assert base.exceptAll(again).count() == 0
    li = spark.read.parquet(f"{SF_CHECK}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    items = ["l_linenumber", "l_partkey", "l_suppkey"]
    a = draws.sample_k_of_n(li, ["l_orderkey"], items, 1, 2, "t")
    b = draws.sample_k_of_n(li.repartition(parts), ["l_orderkey"], items, 1, 2, "t")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_range_join_pick_equals_case_ladder(spark):
    from tabsmith.functions.draws import u
    from tabsmith.sources import fixed, lookups
    cust = spark.read.parquet(f"{SF_CHECK}/customer.parquet").select("c_custkey")
    regions = [(str(c), w) for c, w in fixed.RU_REGIONS]
    weights = lookups.weights_table(spark, regions)
    slices = draws.weighted_slices(weights.withColumn("n", F.round(F.col("weight") * 100)), "ord", "key", "n")
    by_join = draws.pick_weighted_table(cust, slices, "t", ["c_custkey"], "region", total=100, default=str(fixed.RU_REGION_DEFAULT))
    by_case = cust.withColumn("region", lookups.weighted_case(u("t", "c_custkey"), regions, str(fixed.RU_REGION_DEFAULT)))
    assert by_join.exceptAll(by_case).count() == 0 and by_case.exceptAll(by_join).count() == 0
    # weights sum to 1.04: the tail past 1.0 is unreachable
    hi = {r.key: r.hi for r in weights.collect()}
    assert hi["10"] > 1.0 and by_join.where(F.col("region") == "10").count() == 0
