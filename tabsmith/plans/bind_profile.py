"""Bindings A-1..A-10: profiles and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabsmith.operators import profile, quality
from tabsmith.plans import bind_derive as bd
from tabsmith.plans import bind_keyed as bk
from tabsmith.plans import bind_quality as bq
from tabsmith.plans.registry import query
from tabsmith.sources.tables import read


@query("key_stats", f"""
WITH RECURSIVE {bk.SQL_CARDS}, {bk.SQL_CLIENTS}
SELECT count(DISTINCT e.user_id) AS unique_passports, count(DISTINCT cl.client_no) AS unique_clients,
       count(DISTINCT ca.card_id) AS cards_in_use, count(ca.card_id) AS total_card_usage
FROM events e JOIN cards ca ON ca.event_id = e.event_id JOIN clients cl ON cl.event_id = e.event_id
""")
def key_stats(spark, sf):
    ev = read(spark, sf, "events").select("event_id", "user_id")
    j = ev.join(bk.cards(spark, sf).select("event_id", "card_id"), "event_id") \
        .join(bk.clients(spark, sf).select("event_id", "client_no"), "event_id")
    return profile.key_stats(j, "user_id", "client_no", "card_id")


SQL_REPEAT = """rep AS (SELECT CAST(sum(v) AS BIGINT) AS visits, count(*) AS new_clients,
       CAST(sum(v) - count(*) AS BIGINT) AS repeat_visits,
       round(sum(v) / nullif(count(*), 0), 4) AS visits_per_client,
       round((sum(v) - count(*)) * 100.0 / nullif(sum(v), 0), 4) AS repeat_pct
FROM (SELECT o_custkey, count(*) AS v FROM orders GROUP BY o_custkey) x)"""


@query("repeat_stats", f"WITH {SQL_REPEAT} SELECT * FROM rep")
def repeat_stats(spark, sf):
    return profile.repeat_stats(read(spark, sf, "orders"), "o_custkey")


@query("card_stats", """
SELECT count(*) AS cards, round(avg(u), 4) AS mean_uses, CAST(max(u) AS BIGINT) AS max_uses
FROM (SELECT user_id, count(*) AS u FROM events GROUP BY user_id) x
""")
def card_stats(spark, sf):
    return profile.card_stats(read(spark, sf, "events"), "user_id")


SQL_QUALITY = f"""{bq.SQL_DOC_ERRORS},
qs AS (SELECT count(*) AS rows, CAST(coalesce(sum(len(errors)), 0) AS BIGINT) AS errors,
   CAST(coalesce(sum(CASE WHEN len(errors) > 0 THEN 1 ELSE 0 END), 0) AS BIGINT) AS bad_rows FROM doc_err),
qual AS (SELECT rows, errors, bad_rows,
   round((rows - errors) * 100.0 / nullif(rows, 0), 4) AS pct_correct_by_errors,
   round((rows - bad_rows) * 100.0 / nullif(rows, 0), 4) AS pct_correct_by_rows FROM qs)"""


@query("quality_stats", f"WITH {SQL_QUALITY} SELECT * FROM qual")
def quality_stats(spark, sf):
    return profile.quality_stats(bq.doc_errors(spark, sf))


@query("batch_progress", """
SELECT batch, n_rows, CAST(sum(n_rows) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum_rows,
       round(sum(n_rows) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) * 100.0
             / sum(n_rows) OVER (), 4) AS cum_pct
FROM (SELECT CAST(event_id // 1000 AS BIGINT) AS batch, count(*) AS n_rows FROM events GROUP BY 1) x
""")
def batch_progress(spark, sf):
    return profile.batch_progress(read(spark, sf, "events"), "event_id")


@query("batch_sample", """
SELECT batch, event_id, pos FROM (
  SELECT CAST(event_id // 1000 AS BIGINT) AS batch, event_id,
         row_number() OVER (PARTITION BY event_id // 1000 ORDER BY event_id) AS pos FROM events) x WHERE pos <= 2
""")
def batch_sample(spark, sf):
    out = profile.batch_sample(read(spark, sf, "events").select("event_id"), "event_id")
    return out.select("batch", "event_id", F.col("pos").cast("bigint").alias("pos"))


@query("error_summary", f"""
WITH {bq.SQL_DOC_ERRORS}
SELECT code, count(*) AS n_rows FROM (SELECT unnest(errors) AS code FROM doc_err) x GROUP BY code
""")
def error_summary(spark, sf):
    return quality.error_summary(bq.doc_errors(spark, sf))


_REP_COLS = ["visits", "new_clients", "repeat_visits", "visits_per_client", "repeat_pct"]
_QUAL_COLS = ["rows", "errors", "bad_rows", "pct_correct_by_errors", "pct_correct_by_rows"]


@query("run_report", f"""
WITH {SQL_REPEAT}, {SQL_QUALITY}
""" + " UNION ALL ".join(
    [f"SELECT '{c}' AS metric, CAST({c} AS VARCHAR) AS value FROM rep" for c in _REP_COLS]
    + [f"SELECT '{c}' AS metric, CAST({c} AS VARCHAR) AS value FROM qual" for c in _QUAL_COLS]))
def run_report(spark, sf):
    """A-8: one-row metric sets stacked to (metric, value) and unioned (no join of
    the one-row frames)."""
    rep = profile.run_report(profile.repeat_stats(read(spark, sf, "orders"), "o_custkey"))
    qual = profile.run_report(profile.quality_stats(bq.doc_errors(spark, sf)))
    return rep.unionByName(qual)


@query("best_match", f"""
WITH {bd.SQL_SPEC},
mx AS (SELECT doc_id, max(score) AS max_score FROM scores GROUP BY doc_id)
SELECT s.doc_id, mx.max_score, string_agg(s.spec, ',' ORDER BY s.spec) AS holders, count(*) AS n_holders
FROM scores s JOIN mx ON mx.doc_id = s.doc_id AND s.score = mx.max_score GROUP BY s.doc_id, mx.max_score
""")
def best_match(spark, sf):
    return profile.best_match(bd.doc_scores(spark, sf), "doc_id", "spec")


@query("hour_diff", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey,
       CAST(epoch_us(l.l_shipdate) - epoch_us(o.o_orderdate) AS DOUBLE) / 3600000000.0 AS hours
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
""")
def hour_diff(spark, sf):
    li = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    o = read(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return li.join(o, "l_orderkey").select("l_orderkey", "l_linenumber", "l_partkey",
                                           quality.gap_hours("o_orderdate", "l_shipdate").alias("hours"))
