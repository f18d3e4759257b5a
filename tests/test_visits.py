"""Invariants of the assembled visit table (K-7) at sf0.001."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tabsmith.operators import quality
from tabsmith.plans import visits
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def table(spark):
    return visits.visit_errors(visits.visits_from(spark, SF_SMALL)).cache()


def test_one_row_per_source_row(spark, table):
    n = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    assert table.count() == n
    assert table.select("visit_id").distinct().count() == n


def test_card_cap_and_luhn(table):
    assert table.agg(F.max("card_use")).first()[0] <= 5
    assert table.where(~quality.luhn_ok("card")).count() == 0


def test_one_passport_per_name(table):
    assert quality.fd_violations(table, "full_name", "passport").count() == 0


def test_times_in_working_hours(table):
    bad = table.where(~quality.working_day_ok("visit_ts") | ~quality.working_hour_ok("visit_ts")
                      | ~quality.working_day_ok("result_ts") | ~quality.working_hour_ok("result_ts"))
    assert bad.count() == 0
    assert table.where(F.col("result_ts") <= F.col("visit_ts")).count() == 0


def test_lists_and_cost(table):
    sizes = table.select(F.size(F.split("symptoms", ", ")).alias("s"), F.size(F.split("analyses", ", ")).alias("a"))
    assert sizes.where(~F.col("s").between(1, 3) | ~F.col("a").between(1, 2)).count() == 0
    assert table.where(F.col("cost") <= 0).count() == 0


def test_only_expected_errors(table):
    codes = {r.code for r in quality.error_summary(table.withColumn("errors", F.split("errors", ";"))
                                                   .withColumn("errors", F.array_remove("errors", ""))).collect()}
    assert codes <= {"RESULT_GAP", "RU_PASSPORT"}


def test_entry_contract(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "errors" in df.columns and "visit_id" in df.columns


def test_rules_and_draws_stay_compiled(spark):
    """No rule is interpreted: a filter over the array of checks has no compiled form. Places
    that are not picked are not looked up."""
    from tabsmith.functions.draws import shuffled

    row = spark.range(3).select(F.lit("a b c").alias("full_name"), F.lit("4510 123456").alias("passport"), F.lit("ru").alias("passport_country"),
                                F.lit(None).cast("date").alias("passport_issue_date"), F.lit(None).cast("string").alias("dept_code"), F.lit("").alias("snils"),
                                F.lit("4111 1111 1111 1111").alias("card"), F.lit(100).alias("cost"), F.lit("2024-01-10 10:00:00").cast("timestamp_ntz").alias("visit_ts"),
                                F.lit("2024-01-12 10:00:00").cast("timestamp_ntz").alias("result_ts"))
    checked = visits.visit_errors(row)
    assert "lambda" not in checked._jdf.queryExecution().optimizedPlan().toString()
    assert {(r["errors"], r["passport_errors"], r["valid"]) for r in checked.collect()} == {("", "", True)}
    worse = row.withColumns({"card": F.lit("4111 1111 1111 1112"), "passport": F.lit("45 1"), "full_name": F.lit("a b")})
    assert {(r["errors"], r["passport_errors"], r["valid"]) for r in visits.visit_errors(worse).collect()} == {
        ("NAME_NOT_3_WORDS;RU_PASSPORT;CARD", "PASSPORT_FORMAT", False)}
    d = shuffled(spark.range(5), 9, {"a": F.lit(0), "b": F.when(F.col("id") > 2, F.lit(1))}, "t", "id")
    full = {r["id"]: (r["a"], r["b"]) for r in shuffled(spark.range(5), 9, {"a": 0, "b": 1}, "t", "id").collect()}
    assert {r["id"]: (r["a"], r["b"]) for r in d.collect()} == {i: (a, b if i > 2 else None) for i, (a, b) in full.items()}
