"""Bindings K-1..K-6: keyed constraints over events / customer."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabsmith.functions import timecols
from tabsmith.operators import keyed
from tabsmith.plans.registry import query
from tabsmith.plans.sqlbits import sql_shuffled, sql_u
from tabsmith.sources import fixed
from tabsmith.sources.tables import read


def day_block(ts: str = "ts"):
    """Block column for per-key numbering in time order: the hour of the timestamp
    (hours since the epoch), so a very active key is split into many pieces."""
    return F.floor(timecols.micros(F.col(ts)) / F.lit(timecols.US_HOUR)).cast("bigint")


@query("first_wins_fd", """
SELECT user_id, first(event_type ORDER BY ts, event_id) AS first_type FROM events GROUP BY user_id
""")
def first_wins_fd(spark, sf):
    ev = read(spark, sf, "events")
    return keyed.first_wins(ev, ["user_id"], "event_type", ["ts", "event_id"], "first_type")


@query("pair_lookup", """
SELECT e.event_id, f.v AS pair_value FROM events e
LEFT JOIN (SELECT user_id, event_type, first(value ORDER BY ts, event_id) AS v FROM events GROUP BY user_id, event_type) f
  ON f.user_id = e.user_id AND f.event_type = e.event_type
""")
def pair_lookup(spark, sf):
    ev = read(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "ts")
    out = keyed.apply_first_wins(ev, ["user_id", "event_type"], "value", ["ts", "event_id"], "pair_value")
    return out.select("event_id", "pair_value")


SQL_USES = f"""uses AS (SELECT event_id, user_id,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS use_no FROM events)"""


def uses(spark, sf):
    ev = read(spark, sf, "events").select("event_id", "user_id", "ts")
    return keyed.usage_cap(ev, ["user_id"], ["ts", "event_id"], day_block())


@query("usage_cap", f"WITH {SQL_USES} SELECT event_id, user_id, use_no, use_no <= {fixed.CARD_REUSE_LIMIT} AS allowed FROM uses")
def usage_cap(spark, sf):
    return uses(spark, sf).select("event_id", "user_id", "use_no", "allowed")


def sql_cards(rows: str, key: str, stream: str, p_reuse: float, cap: int, name: str = "cards") -> str:
    """CTEs up to ``name`` (key, card_id, card_no, use_no, new_card) of ``pool_reuse`` over the
    table ``rows``: the rounds of deferred acceptance as a recursion over whole rounds."""
    return f"""
{name}_w AS (SELECT {key}, row_number() OVER (ORDER BY {key}) - 1 AS i, CASE WHEN {sql_u(stream + ':reuse', key)} >= {p_reuse} THEN 1 ELSE 0 END AS wants FROM {rows}),
{name}_n AS (SELECT *, coalesce(sum(wants) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS n FROM {name}_w),
{name}_b AS (SELECT *, CAST(n + greatest(0, coalesce(max(i // {cap} + 1 - n - wants) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS BIGINT) AS before FROM {name}_n),
{name}_o AS (SELECT {key}, before, wants = 1 OR before < i // {cap} + 1 AS opens FROM {name}_b),
{name}_a AS (
  SELECT 0 AS round, {key} AS k, before AS n, 0 AS try, {sql_shuffled('before', '0', stream + ':pick', key)} AS card FROM {name}_o WHERE NOT opens
  UNION ALL
  SELECT round + 1, k, n, try + bump, CASE WHEN bump = 0 THEN card ELSE {sql_shuffled('n', 'try + 1', stream + ':pick', 'k')} END
  FROM (SELECT *, max(bump) OVER () AS more FROM (
    SELECT *, CASE WHEN row_number() OVER (PARTITION BY card ORDER BY k) >= {cap} THEN 1 ELSE 0 END AS bump FROM {name}_a)) WHERE more = 1),
{name}_u AS (SELECT {key}, before AS card FROM {name}_o WHERE opens
  UNION ALL SELECT k, card FROM {name}_a WHERE round = (SELECT max(round) FROM {name}_a)),
{name} AS (SELECT {key}, min({key}) OVER (PARTITION BY card) AS card_id, card AS card_no,
  row_number() OVER (PARTITION BY card ORDER BY {key}) AS use_no, {key} = min({key}) OVER (PARTITION BY card) AS new_card FROM {name}_u)"""


SQL_CARDS = sql_cards("events", "event_id", "card", fixed.CARD_REUSE_PROBABILITY, fixed.CARD_REUSE_LIMIT)


def cards(spark, sf):
    ev = read(spark, sf, "events").select("event_id")
    return keyed.pool_reuse(ev, "event_id")


@query("pool_reuse", f"WITH RECURSIVE {SQL_CARDS} SELECT event_id, card_id, card_no, use_no, new_card FROM cards")
def pool_reuse(spark, sf):
    return cards(spark, sf)


SQL_CLIENTS = f"""
cb AS (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS rn FROM events),
cf AS (SELECT event_id, (rn < {fixed.CLIENT_POOL_MIN} OR {sql_u('client:repeat', 'event_id')} >= {fixed.CLIENT_REPEAT_PROBABILITY}) AS is_new FROM cb),
cc AS (SELECT event_id, is_new, coalesce(sum(CASE WHEN is_new THEN 1 ELSE 0 END) OVER (
         ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM cf),
clients AS (SELECT event_id, is_new, CASE WHEN is_new THEN before
                   ELSE CAST(floor({sql_u('client:pick', 'event_id')} * before) AS BIGINT) END AS client_no FROM cc)"""


def clients(spark, sf):
    ev = read(spark, sf, "events").select("event_id")
    return keyed.repeat_assign(ev, "event_id")


@query("repeat_assign", f"WITH {SQL_CLIENTS} SELECT event_id, CAST(client_no AS BIGINT) AS client_no, is_new FROM clients")
def repeat_assign(spark, sf):
    return clients(spark, sf).select("event_id", "client_no", "is_new")


@query("unique_register", """
SELECT c_custkey, c_nationkey, (c_custkey = min(c_custkey) OVER (PARTITION BY c_nationkey)) AS accepted FROM customer
""")
def unique_register(spark, sf):
    c = read(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return keyed.unique_register(c, "c_nationkey", "c_custkey").select("c_custkey", "c_nationkey", "accepted")
