"""Bindings S-1..S-11: row source, dictionaries, sinks, column widths."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabsmith.operators import profile
from tabsmith.plans.registry import query
from tabsmith.plans.sqlbits import tokens
from tabsmith.session import scratch_path
from tabsmith.sources import lookups, sinks
from tabsmith.sources.tables import read


def brands(spark, sf):
    return lookups.dictionary(read(spark, sf, "part"), "p_brand")


def words(spark, sf):
    toks = read(spark, sf, "part").select(F.explode(lookups.tokens("p_name")).alias("w"))
    return lookups.dictionary(toks, "w")


@query("row_source", """
SELECT CAST(event_id // 1000 AS BIGINT) AS batch, count(*) AS n_rows, min(event_id) AS first_id, max(event_id) AS last_id
FROM events GROUP BY 1
""")
def row_source(spark, sf):
    return lookups.batch_counts(lookups.numbered_rows(read(spark, sf, "events"), "event_id"))


@query("lookup_source", """
SELECT CAST(row_number() OVER (ORDER BY p_brand) - 1 AS BIGINT) AS idx, p_brand AS value
FROM (SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL)
""")
def lookup_source(spark, sf):
    return brands(spark, sf)


@query("dict_cross", """
SELECT r.r_name || ' ' || t.p_type AS phrase
FROM (SELECT DISTINCT r_name FROM region) r, (SELECT DISTINCT p_type FROM part) t
""")
def dict_cross(spark, sf):
    return lookups.dict_cross(read(spark, sf, "region"), "r_name", read(spark, sf, "part"), "p_type")


@query("dict_flatten", f"""
SELECT p_partkey, p_brand, CAST(t.pos AS BIGINT) AS pos, t.value
FROM part, unnest({tokens('p_name')}) WITH ORDINALITY AS t(value, pos)
""")
def dict_flatten(spark, sf):
    return lookups.dict_flatten(read(spark, sf, "part"), ["p_partkey", "p_brand"], lookups.tokens("p_name"))


# binding parameter: three severity prefixes
VARIANT_PREFIXES = ["mild", "moderate", "severe"]


@query("dict_variants", """
SELECT p_type, v.pre || ' ' || p_type AS variant
FROM (SELECT DISTINCT p_type FROM part) p, (VALUES ('mild'), ('moderate'), ('severe')) v(pre)
""")
def dict_variants(spark, sf):
    return lookups.dict_variants(read(spark, sf, "part").select("p_type").distinct(), "p_type", VARIANT_PREFIXES)


@query("dict_union_distinct", f"""
SELECT DISTINCT value FROM (
  SELECT unnest({tokens('p_name')}) AS value FROM part
  UNION ALL SELECT lower(p_type) AS value FROM part) x
""")
def dict_union_distinct(spark, sf):
    part = read(spark, sf, "part")
    a = part.select(F.explode(lookups.tokens("p_name")).alias("value"))
    b = part.select(F.lower("p_type").alias("value"))
    return lookups.dict_union_distinct([a, b])


TOPUP_THRESHOLD = 40


@query("dict_topup", f"""
WITH tr AS (
  SELECT 1 AS tranche, p_brand AS value FROM part
  UNION ALL SELECT 2 AS tranche, unnest({tokens('p_name')}) AS value FROM part
  UNION ALL SELECT 3 AS tranche, p_type AS value FROM part),
first AS (SELECT value, min(tranche) AS tranche FROM tr WHERE value IS NOT NULL GROUP BY value),
per AS (SELECT tranche, count(*) AS new FROM first GROUP BY tranche),
kept AS (SELECT tranche FROM (
  SELECT tranche, coalesce(sum(new) OVER (ORDER BY tranche ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM per) WHERE before < {TOPUP_THRESHOLD})
SELECT value, tranche FROM first WHERE tranche IN (SELECT tranche FROM kept)
""")
def dict_topup(spark, sf):
    part = read(spark, sf, "part")
    tr = part.select(F.lit(1).alias("tranche"), F.col("p_brand").alias("value")) \
        .unionByName(part.select(F.lit(2).alias("tranche"), F.explode(lookups.tokens("p_name")).alias("value"))) \
        .unionByName(part.select(F.lit(3).alias("tranche"), F.col("p_type").alias("value")))
    return lookups.dict_topup(tr, TOPUP_THRESHOLD)


@query("sink_project", """
SELECT c_custkey AS client_id, c_name AS full_name, c_nationkey AS region, c_mktsegment AS segment FROM customer
""")
def sink_project(spark, sf):
    return sinks.sink_project(
        read(spark, sf, "customer"), ["c_acctbal"],
        {"c_custkey": "client_id", "c_name": "full_name", "c_nationkey": "region", "c_mktsegment": "segment"},
        scratch_path(spark, "sink-project"))


@query("sink_by_day", """
SELECT event_id, user_id, ts, CAST(ts AS DATE) AS visit_day FROM events
""")
def sink_by_day(spark, sf):
    """The events by day, written twice: the second write replaces each day by itself."""
    path, ev = scratch_path(spark, "sink-days"), read(spark, sf, "events").select("event_id", "user_id", "ts")
    sinks.sink_by_day(ev, "ts", path)
    return sinks.sink_by_day(ev, "ts", path).select("event_id", "user_id", "ts", "visit_day")


@query("sink_csv", "SELECT * FROM nation")
def sink_csv(spark, sf):
    return sinks.sink_csv(read(spark, sf, "nation"), scratch_path(spark, "sink-csv"))


def event_metrics(spark, sf):
    ev = read(spark, sf, "events")
    return ev.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("user_id").alias("users"),
                  F.count_distinct("event_type").alias("event_types"))


@query("sink_report", """
SELECT 'rows: ' || CAST(count(*) AS VARCHAR) AS value FROM events
UNION ALL SELECT 'users: ' || CAST(count(DISTINCT user_id) AS VARCHAR) FROM events
UNION ALL SELECT 'event_types: ' || CAST(count(DISTINCT event_type) AS VARCHAR) FROM events
""")
def sink_report(spark, sf):
    return sinks.sink_report(profile.run_report(event_metrics(spark, sf)), scratch_path(spark, "sink-report"))


WIDTH_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]


@query("column_widths", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(least(greatest(max(length(coalesce(CAST({c} AS VARCHAR), 'None'))), "
    f"length('{c}')) + 2, 50) AS BIGINT) AS width FROM customer" for c in WIDTH_COLUMNS))
def column_widths(spark, sf):
    return profile.column_widths(read(spark, sf, "customer"), WIDTH_COLUMNS)
