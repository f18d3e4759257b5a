"""Bindings D-1..D-11: reproducible draws over customer / events / lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabsmith.functions.draws import rand_int, u
from tabsmith.operators import draws
from tabsmith.plans.bind_sources import brands, words
from tabsmith.plans.registry import query
from tabsmith.plans.sqlbits import BRANDS, WORDS, sql_pick_index, sql_rand_int, sql_shuffled, sql_u, tokens
from tabsmith.sources import fixed, lookups
from tabsmith.sources.tables import read

# D-1 brand per customer (shared by later bindings)
SQL_CUST_BRAND = f"""
cust_brand AS (
  SELECT c.c_custkey, d.value AS brand
  FROM customer c CROSS JOIN (SELECT count(*) AS n FROM {BRANDS}) n
  LEFT JOIN {BRANDS} d ON d.idx = {sql_pick_index('n.n', 'd1', 'c.c_custkey')})"""


def cust_brand(spark, sf, cols=("c_custkey",)):
    cust = read(spark, sf, "customer").select(*cols)
    return draws.pick_uniform(cust, brands(spark, sf), "d1", ["c_custkey"], "brand")


@query("pick_uniform", f"WITH {SQL_CUST_BRAND} SELECT c_custkey, brand FROM cust_brand")
def pick_uniform(spark, sf):
    return cust_brand(spark, sf)


SQL_COUNTRY = lookups.sql_weighted_case(sql_u("d2", "c_custkey"), fixed.COUNTRY_WEIGHTS, fixed.COUNTRY_DEFAULT)


@query("pick_weighted", f"SELECT c_custkey, {SQL_COUNTRY} AS country FROM customer")
def pick_weighted(spark, sf):
    cust = read(spark, sf, "customer").select("c_custkey")
    return cust.withColumn("country", lookups.weighted_case(u("d2", "c_custkey"), fixed.COUNTRY_WEIGHTS,
                                                            fixed.COUNTRY_DEFAULT))


def sql_tiers(stream: str, key: str) -> str:
    """Age by positional step weights, integer cumulative weights."""
    wcase = " ".join(f"WHEN range BETWEEN {lo} AND {hi} THEN {w}" for lo, hi, w in fixed.AGE_TIERS)
    lo_all, hi_all = fixed.AGE_TIERS[0][0], fixed.AGE_TIERS[-1][1]
    total = sum((hi - lo + 1) * w for lo, hi, w in fixed.AGE_TIERS)
    return f"""(SELECT age, cum_hi - weight AS cum_lo, cum_hi FROM (
      SELECT age, weight, sum(weight) OVER (ORDER BY age ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_hi
      FROM (SELECT range AS age, CASE {wcase} ELSE 0 END AS weight FROM range({lo_all}, {hi_all + 1}))))""", total


_TIERS_SQL, _TIERS_TOTAL = sql_tiers("d3", "c_custkey")


@query("pick_tiered", f"""
SELECT c.c_custkey, t.age FROM customer c
LEFT JOIN {_TIERS_SQL} t
  ON {sql_pick_index(_TIERS_TOTAL, 'd3', 'c.c_custkey')} >= t.cum_lo
 AND {sql_pick_index(_TIERS_TOTAL, 'd3', 'c.c_custkey')} < t.cum_hi
""")
def pick_tiered(spark, sf):
    tiers, total = lookups.tier_table(spark, fixed.AGE_TIERS)
    cust = read(spark, sf, "customer").select("c_custkey")
    return draws.pick_tiered(cust, tiers, total, "d3", ["c_custkey"], "age")


@query("pick_weighted_data", """
WITH w AS (SELECT n_nationkey, n_name, CAST(n_regionkey + 1 AS BIGINT) AS weight FROM nation),
c AS (SELECT n_name, sum(weight) OVER (ORDER BY n_nationkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_hi,
             weight FROM w),
t AS (SELECT n_name, cum_hi - weight AS cum_lo, cum_hi FROM c),
tot AS (SELECT sum(weight) AS total FROM w)
SELECT cu.c_custkey, t.n_name AS nation FROM customer cu CROSS JOIN tot
LEFT JOIN t ON CAST(floor(""" + sql_u("d2:data", "cu.c_custkey") + """ * tot.total) AS BIGINT) >= t.cum_lo
 AND CAST(floor(""" + sql_u("d2:data", "cu.c_custkey") + """ * tot.total) AS BIGINT) < t.cum_hi
""")
def pick_weighted_data(spark, sf):
    """D-2 with the distribution as data: nation weights (region + 1) in key order."""
    nat = read(spark, sf, "nation").select("n_nationkey", "n_name", (F.col("n_regionkey") + 1).alias("weight"))
    cust = read(spark, sf, "customer").select("c_custkey")
    return draws.pick_weighted_table(cust, draws.weighted_slices(nat, "n_nationkey", "n_name", "weight"), "d2:data", ["c_custkey"], "nation")


@query("pick_weighted_orders", """
WITH w AS (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) % 1000 * (CASE WHEN o_orderkey % 50 = 0 THEN 1000 ELSE 1 END) AS weight FROM orders),
c AS (SELECT o_orderkey, weight, sum(weight) OVER (ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hi FROM w WHERE weight > 0),
tot AS (SELECT max(hi) AS total FROM c),
d AS (SELECT event_id, CAST(floor(""" + sql_u("d2:orders", "event_id") + """ * tot.total) AS BIGINT) AS t FROM events, tot)
SELECT d.event_id, c.o_orderkey FROM d ASOF JOIN (SELECT o_orderkey, CAST(hi - weight AS BIGINT) AS lo FROM c) c ON d.t >= c.lo
""")
def pick_weighted_orders(spark, sf):
    """D-2 from a large weights table: an order per event, weighted by its price, orders with
    a key divisible by 50 a thousand times as much (so slices are of very unequal width)."""
    o = read(spark, sf, "orders").select("o_orderkey", (F.floor("o_totalprice").cast("bigint") % 1000 * F.when(F.col("o_orderkey") % 50 == 0, 1000).otherwise(1)).alias("weight"))
    ev = read(spark, sf, "events").select("event_id")
    return draws.pick_weighted_table(ev, draws.weighted_slices(o, "o_orderkey", "o_orderkey", "weight"), "d2:orders", ["event_id"], "o_orderkey")


@query("rand_int", f"SELECT event_id, {sql_rand_int(24, 72, 'd4', 'event_id')} AS hours FROM events")
def rand_int_q(spark, sf):
    return read(spark, sf, "events").select("event_id", rand_int(24, 72, "d4", "event_id").alias("hours"))


@query("bernoulli_branch", f"""
SELECT CASE WHEN {sql_u('d5:path', 'event_id')} < 0.8 THEN 'by_gender' ELSE 'by_symptoms' END AS path,
       ({sql_u('d5:reuse', 'event_id')} < 0.4) AS reuse_card, count(*) AS n_rows
FROM events GROUP BY ALL
""")
def bernoulli_branch(spark, sf):
    ev = read(spark, sf, "events").select("event_id")
    b = ev.select(
        draws.bernoulli("d5:path", ["event_id"], fixed.PATH_BY_GENDER_PROBABILITY,
                        F.lit("by_gender"), F.lit("by_symptoms")).alias("path"),
        (u("d5:reuse", "event_id") < F.lit(fixed.CARD_REUSE_PROBABILITY)).alias("reuse_card"))
    return b.groupBy("path", "reuse_card").agg(F.count(F.lit(1)).alias("n_rows"))


@query("sample_k_of_n", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, rank FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY
            {sql_u('d6', 'l_orderkey', 'l_linenumber', 'l_partkey', 'l_suppkey')}, l_linenumber, l_partkey, l_suppkey) AS rank,
         {sql_rand_int(1, 2, 'd6:k', 'l_orderkey')} AS k
  FROM lineitem) x
WHERE rank <= 2 AND rank <= k
""")
def sample_k_of_n(spark, sf):
    li = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    out = draws.sample_k_of_n(li, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"], 1, 2, "d6")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "rank")


@query("sample_replace", f"""
WITH d AS {WORDS}, n AS (SELECT count(*) AS n FROM d),
slots AS (SELECT c_custkey, s.slot FROM customer,
          LATERAL (SELECT unnest(range(1, {sql_rand_int(1, 10, 'd7:k', 'c_custkey')} + 1)) AS slot) s)
SELECT s.c_custkey, s.slot, d.value AS word FROM slots s CROSS JOIN n
LEFT JOIN d ON d.idx = {sql_pick_index('n.n', 'd7', 's.c_custkey', 's.slot')}
""")
def sample_replace(spark, sf):
    cust = read(spark, sf, "customer").select("c_custkey")
    out = draws.sample_replace(cust, words(spark, sf), "d7", ["c_custkey"], 1, 10, "word")
    return out.select("c_custkey", "slot", "word")


@query("pick_grouped", f"""
WITH {SQL_CUST_BRAND},
lk AS (SELECT p_brand AS g, p_partkey AS v,
              CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS BIGINT) AS idx
       FROM (SELECT DISTINCT p_brand, p_partkey FROM part)),
sz AS (SELECT g, count(*) AS n FROM lk GROUP BY g)
SELECT cb.c_custkey, cb.brand, lk.v AS p_partkey
FROM cust_brand cb LEFT JOIN sz ON sz.g = cb.brand
LEFT JOIN lk ON lk.g = cb.brand AND lk.idx = CAST(floor({sql_u('d8', 'cb.c_custkey')} * sz.n) AS BIGINT)
""")
def pick_grouped(spark, sf):
    part = read(spark, sf, "part").select("p_brand", "p_partkey")
    blk = F.floor(F.col("p_partkey") / F.lit(65536)).cast("bigint")
    return draws.pick_grouped(cust_brand(spark, sf), "brand", part, "p_brand", "p_partkey", "d8",
                              ["c_custkey"], "p_partkey", block=blk).select("c_custkey", "brand", "p_partkey")


# D-9 binding: a brand's own list keeps each word of its parts by a draw on (brand, word),
# so lists are short (some shorter than k) while every part is read; general = type names
OWN_SHARE = 0.12
SQL_OWN_SMALL = f"""own AS (SELECT brand, word FROM (SELECT DISTINCT p_brand AS brand, t.w AS word
  FROM part, unnest({tokens('p_name')}) AS t(w)) WHERE {sql_u('own', 'brand', 'word')} < {OWN_SHARE})"""


def own_small(spark, sf):
    pairs = read(spark, sf, "part").select(F.col("p_brand").alias("brand"), F.explode(lookups.tokens("p_name")).alias("word")).distinct()
    return pairs.where(u("own", "brand", "word") < F.lit(OWN_SHARE))


def sql_fallback(name: str, rows: str, key: str, group: str, own: str, own_group: str, general: str, item: str, k: str, k_max: int, stream: str) -> str:
    """CTEs up to ``name`` (key, item, rank) of ``fallback_lists``: places of a permutation of
    the own list, then places of one of the general list that are not in the own list."""
    return f"""{name}_o AS (SELECT {own_group} AS g, {item}, row_number() OVER (PARTITION BY {own_group} ORDER BY {item}) - 1 AS idx FROM (SELECT DISTINCT {own_group}, {item} FROM {own})),
{name}_g AS (SELECT {item}, row_number() OVER (ORDER BY {item}) - 1 AS idx FROM (SELECT DISTINCT {item} FROM {general} WHERE {item} IS NOT NULL)),
{name}_k AS (SELECT r.{key}, r.{group} AS g, least({k}, {k_max}) AS k, coalesce(s.n, 0) AS n, (SELECT count(*) FROM {name}_g) AS n_g FROM {rows} r
  LEFT JOIN (SELECT g, count(*) AS n FROM {name}_o GROUP BY g) s ON s.g = r.{group}),
{name}_p AS (SELECT *, {sql_shuffled('n', 'i', stream, key)} AS at, CASE WHEN n < k THEN {sql_shuffled('n_g', 'i', stream + ':general', key)} END AS at_g
  FROM (SELECT *, unnest(range(k)) AS i FROM {name}_k)),
{name}_m AS (SELECT p.{key}, o.{item}, 0 AS part, p.i, p.k FROM {name}_p p JOIN {name}_o o ON o.g = p.g AND o.idx = p.at
  UNION ALL SELECT p.{key}, q.{item}, 1, p.i, p.k FROM {name}_p p JOIN {name}_g q ON q.idx = p.at_g
  WHERE NOT EXISTS (SELECT 1 FROM {name}_o o WHERE o.g = p.g AND o.{item} = q.{item})),
{name} AS (SELECT {key}, {item}, rank FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY part, i) AS rank FROM {name}_m) WHERE rank <= k)"""


@query("fallback_fill", f"""
WITH {SQL_CUST_BRAND}, {SQL_OWN_SMALL}, gen AS (SELECT DISTINCT lower(p_type) AS word FROM part),
{sql_fallback('f', 'cust_brand', 'c_custkey', 'brand', 'own', 'brand', 'gen', 'word', sql_rand_int(1, 3, 'd9:k', 'r.c_custkey'), 3, 'd9')}
SELECT c_custkey, word, rank FROM f
""")
def fallback_fill(spark, sf):
    gen = read(spark, sf, "part").select(F.lower("p_type").alias("word"))
    out = draws.fallback_fill(cust_brand(spark, sf), ["c_custkey"], "brand", own_small(spark, sf), gen,
                              "word", rand_int(1, 3, "d9:k", "c_custkey"), 3, "d9")
    return out.select("c_custkey", "word", "rank")


# D-10 binding parameter: two common words added to every candidate list
COMMON_WORDS = ["anvil", "gear"]


@query("candidates_merge", f"""
WITH {SQL_CUST_BRAND}, {SQL_OWN_SMALL}, d AS {WORDS}, n AS (SELECT count(*) AS n FROM d),
rk AS (SELECT c_custkey, brand, {sql_rand_int(1, 5, 'd10:k', 'c_custkey')} AS k FROM cust_brand),
base AS (SELECT c_custkey, word, row_number() OVER (PARTITION BY c_custkey ORDER BY word) - 1 AS ord FROM (SELECT DISTINCT c_custkey, word FROM (
   SELECT rk.c_custkey, o.word FROM rk JOIN own o ON o.brand = rk.brand
   UNION ALL SELECT rk.c_custkey, c.word FROM rk, (VALUES ('anvil'), ('gear')) c(word)))),
cnt AS (SELECT c_custkey, count(*) AS n_c FROM base GROUP BY c_custkey),
extra AS (SELECT rk.c_custkey, d.value AS word, cnt.n_c + s.slot AS ord FROM rk JOIN cnt ON cnt.c_custkey = rk.c_custkey CROSS JOIN n,
   LATERAL (SELECT unnest(range(1, rk.k - cnt.n_c + 1)) AS slot) s
   JOIN d ON d.idx = {sql_pick_index('n.n', 'd10:extra', 'rk.c_custkey', 's.slot')}
   WHERE cnt.n_c < rk.k),
allc AS (SELECT c_custkey, word, row_number() OVER (PARTITION BY c_custkey ORDER BY ord) - 1 AS idx, count(*) OVER (PARTITION BY c_custkey) AS n_all FROM (
   SELECT c_custkey, word, min(ord) AS ord FROM (SELECT * FROM base UNION ALL SELECT * FROM extra) GROUP BY ALL)),
sizes AS (SELECT DISTINCT rk.c_custkey, k, n_all FROM rk JOIN allc USING (c_custkey)),
places AS (SELECT c_custkey, i, {sql_shuffled('n_all', 'i', 'd10', 'c_custkey')} AS at FROM (SELECT *, unnest(range(least(k, n_all))) AS i FROM sizes))
SELECT p.c_custkey, a.word, p.i + 1 AS rank FROM places p JOIN allc a ON a.c_custkey = p.c_custkey AND a.idx = p.at
""")
def candidates_merge(spark, sf):
    out = draws.candidates_merge(cust_brand(spark, sf), ["c_custkey"], "brand", own_small(spark, sf), COMMON_WORDS,
                                 words(spark, sf), "word", rand_int(1, 5, "d10:k", "c_custkey"), 5, "d10")
    return out.select("c_custkey", "word", "rank")


def _sql_rounds(rounds: int) -> str:
    """The rounds of ``unique_batch`` one after the other: l rows left, c draws, w winners."""
    ctes, placed = [], []
    for r in range(1, rounds + 1):
        left = "SELECT c_custkey FROM customer" if r == 1 else f"SELECT l{r - 1}.c_custkey FROM l{r - 1} ANTI JOIN w{r - 1} USING (c_custkey)"
        taken = "".join(f" AND value NOT IN (SELECT value FROM w{k})" for k in range(1, r))
        ctes += [f"l{r} AS ({left})",
                 f"c{r} AS (SELECT c_custkey, {sql_pick_index('(SELECT 16 * count(*) FROM customer)', 'd11', 'c_custkey', str(r))} AS value FROM l{r})",
                 f"w{r} AS (SELECT min(c_custkey) AS c_custkey, CAST({r} AS BIGINT) AS attempt, value FROM c{r} WHERE true{taken} GROUP BY value)"]
        placed.append(f"SELECT * FROM w{r}")
    return f"WITH {', '.join(ctes)}, p AS ({' UNION ALL '.join(placed)}) SELECT c.c_custkey, p.attempt, p.value FROM customer c LEFT JOIN p ON p.c_custkey = c.c_custkey"


@query("unique_batch", _sql_rounds(8))
def unique_batch(spark, sf):
    return draws.unique_batch(read(spark, sf, "customer").select("c_custkey"), "c_custkey", "d11", "value")
