"""Bindings V-1..V-23: data-quality rules. Corrupted inputs are made by key
arithmetic (every n-th key broken in a fixed way) so the oracle can repeat them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabsmith.functions import codecs, timecols
from tabsmith.operators import derive, quality
from tabsmith.plans import bind_derive as bd
from tabsmith.plans import bind_keyed as bk
from tabsmith.plans.registry import query
from tabsmith.plans.sqlbits import tokens
from tabsmith.sources import fixed, lookups
from tabsmith.sources.tables import read


@query("rule_name3", r"""
SELECT p_partkey, NOT (p_name IS NULL OR trim(p_name) = '' OR len(regexp_split_to_array(trim(p_name), '\s+')) <> 3) AS ok
FROM part
""")
def rule_name3(spark, sf):
    return read(spark, sf, "part").select("p_partkey", (~quality.name3_broken("p_name")).alias("ok"))


# ---- V-2 Russian passport ----------------------------------------------------------

_P, _D = bd._sql_ru_passport("c.c_nationkey", "f8.issue_date", "v2", "f8.o_orderkey")
_SQL_V2_ROWS = f"""
{bd.SQL_F8},
f9 AS (SELECT o_orderkey, o_custkey, o_orderdate, {bd._sql_issue('f8.birth_date', 'f8.o_orderdate', 'f9', 'f8.o_orderkey')} AS issue_date
       FROM f8 JOIN orders USING (o_orderkey, o_orderdate)),
gen AS (SELECT f8.o_orderkey, f8.o_orderdate, f8.issue_date, {_P} AS passport, {_D} AS dept
        FROM f9 AS f8 JOIN customer c ON c.c_custkey = f8.o_custkey),
v2 AS (SELECT o_orderkey, o_orderdate AS visit,
   CASE WHEN o_orderkey % 7 = 0 THEN substr(passport, 2) ELSE passport END AS p,
   CASE WHEN o_orderkey % 7 = 1 THEN '999' || substr(dept, 4) ELSE dept END AS d,
   CASE WHEN o_orderkey % 7 = 2 THEN 'not-a-date' WHEN o_orderkey % 7 = 3 THEN '1990-01-01'
        ELSE CAST(issue_date AS VARCHAR) END AS i
   FROM gen)"""


def _sql_ru_errors(p: str, i: str, d: str, visit: str) -> str:
    has_d = f"({d} IS NOT NULL AND {d} <> '')"
    has_i = f"({i} IS NOT NULL AND {i} <> '')"
    idt = f"CAST(try_strptime({i}, '%Y-%m-%d') AS DATE)"
    dig = lambda s, k: f"(ascii(substr({s}, {k}, 1)) - 48)"
    sreg = f"({dig(p, 1)} * 10 + {dig(p, 2)})"
    syear = f"({dig(p, 3)} * 10 + {dig(p, 4)})"
    dreg = f"({dig(d, 1)} * 100 + {dig(d, 2)} * 10 + {dig(d, 3)})"
    dpat = fixed.DEPT_CODE_PATTERN[1:-1]
    ppat = fixed.PASSPORT_PATTERNS[0][1][1:-1]
    return f"""(CASE WHEN {p} IS NULL OR NOT regexp_full_match({p}, '{ppat}') THEN 'PASSPORT_FORMAT' ELSE concat_ws(';',
      CASE WHEN {has_d} AND NOT regexp_full_match({d}, '{dpat}') THEN 'DEPT_FORMAT' END,
      CASE WHEN {has_d} AND regexp_full_match({d}, '{dpat}') AND {sreg} <> {dreg} THEN 'REGION_MISMATCH' END,
      CASE WHEN {has_i} AND {idt} IS NULL THEN 'ISSUE_UNPARSABLE' END,
      CASE WHEN {has_i} AND {idt} < DATE '{fixed.RU_NEW_FORM_DATE}' THEN 'ISSUE_BEFORE_NEW_FORM' END,
      CASE WHEN {has_i} AND {idt} IS NOT NULL AND {syear} <> year({idt}) % 100 THEN 'SERIES_YEAR' END,
      CASE WHEN {has_i} AND {idt} > CAST({visit} AS DATE) THEN 'ISSUE_AFTER_VISIT' END) END)"""


@query("rule_ru_passport", f"WITH {_SQL_V2_ROWS} SELECT o_orderkey, {_sql_ru_errors('p', 'i', 'd', 'visit')} AS errors FROM v2")
def rule_ru_passport(spark, sf):
    b = bd.births(spark, sf).withColumn(
        "issue_date", derive.issue_date(F.col("birth_date"), F.col("o_orderdate"), "f9", "o_orderkey"))
    o = read(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = read(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    g = b.join(o, "o_orderkey").join(c, "o_custkey")
    rp = derive.ru_passport(F.col("c_nationkey"), F.col("issue_date"), "v2", "o_orderkey")
    k = F.col("o_orderkey") % 7
    g = g.select(
        "o_orderkey", F.col("o_orderdate").alias("visit"),
        F.when(k == 0, F.substring(rp["passport"], 2, 100)).otherwise(rp["passport"]).alias("p"),
        F.when(k == 1, F.concat(F.lit("999"), F.substring(rp["dept_code"], 4, 100))).otherwise(rp["dept_code"]).alias("d"),
        F.when(k == 2, F.lit("not-a-date")).when(k == 3, F.lit("1990-01-01"))
        .otherwise(F.col("issue_date").cast("string")).alias("i"))
    errs = quality.ru_passport_errors(F.col("p"), F.col("i"), F.col("d"), F.col("visit"))
    return g.select("o_orderkey", F.array_join(errs, ";").alias("errors"))


_SQL_V3 = "CASE " + " ".join(f"WHEN c2 = '{c}' THEN regexp_full_match(p2, '{p[1:-1]}')"
                             for c, p in fixed.PASSPORT_PATTERNS) + " ELSE false END"


@query("rule_passport_fmt", f"""
WITH {bd.SQL_F7}
SELECT c_custkey, c2 AS country, p2 AS passport, coalesce({_SQL_V3}, false) AS ok FROM (
  SELECT c_custkey, CASE WHEN c_custkey % 5 = 1 THEN 'xx' ELSE country END AS c2,
         CASE WHEN c_custkey % 5 = 0 THEN lower(passport) ELSE passport END AS p2 FROM f7) x
""")
def rule_passport_fmt(spark, sf):
    p = bd.passports(spark, sf)
    k = F.col("c_custkey") % 5
    p = p.select("c_custkey", F.when(k == 1, F.lit("xx")).otherwise(F.col("country")).alias("country"),
                 F.when(k == 0, F.lower("passport")).otherwise(F.col("passport")).alias("passport"))
    return p.withColumn("ok", quality.passport_format_ok("passport", "country"))


_SQL_SNILS_BAD = f"""sn AS (SELECT c_custkey, CASE
    WHEN c_custkey % 6 = 0 THEN substr(s, 1, 12) || substr(s, 14, 1) || substr(s, 13, 1)
    WHEN c_custkey % 6 = 1 THEN replace(s, '-', ' ') ELSE s END AS snils
  FROM (SELECT c_custkey, {bd.SQL_SNILS} AS s FROM customer) x)"""


def bad_snils(spark, sf):
    c = read(spark, sf, "customer").select("c_custkey", derive.snils_for("f3", "c_custkey").alias("s"))
    k = F.col("c_custkey") % 6
    s = F.col("s")
    bad = (F.when(k == 0, F.concat(F.substring(s, 1, 12), F.substring(s, 14, 1), F.substring(s, 13, 1)))
           .when(k == 1, F.replace(s, F.lit("-"), F.lit(" "))).otherwise(s))
    return c.select("c_custkey", bad.alias("snils"))


@query("rule_snils", f"WITH {_SQL_SNILS_BAD} SELECT c_custkey, snils, {codecs.sql_snils_valid('snils')} AS ok FROM sn")
def rule_snils(spark, sf):
    return bad_snils(spark, sf).withColumn("ok", quality.snils_ok("snils"))


@query("rule_luhn", f"""
WITH {bd.SQL_CARD_CTE}
SELECT c_custkey, c2 AS card, {codecs.sql_luhn_valid('c2')} AS ok FROM (
  SELECT c_custkey, CASE
    WHEN c_custkey % 4 = 0 THEN substr(card, 1, 15) || CAST((ascii(substr(card, 16, 1)) - 48 + 1) % 10 AS VARCHAR)
    WHEN c_custkey % 4 = 1 THEN substr(card, 1, 15) ELSE card END AS c2 FROM card) x
""")
def rule_luhn(spark, sf):
    c = bd.cards(spark, sf)
    k = F.col("c_custkey") % 4
    card = F.col("card")
    last = F.pmod(F.ascii(F.substring(card, 16, 1)) - 48 + 1, F.lit(10)).cast("string")
    c2 = F.when(k == 0, F.concat(F.substring(card, 1, 15), last)).when(k == 1, F.substring(card, 1, 15)).otherwise(card)
    return c.select("c_custkey", c2.alias("card")).withColumn("ok", quality.luhn_ok("card"))


@query("rule_iso", f"""
SELECT event_id, coalesce(regexp_full_match(t, '{quality.ISO_PATTERN[1:-1]}'), false) AS ok FROM (
  SELECT event_id, CASE WHEN event_id % 3 = 0 THEN replace(iso, 'T', ' ') ELSE iso END AS t
  FROM (SELECT event_id, {timecols.sql_iso_text('ts')} AS iso FROM events) x) y
""")
def rule_iso(spark, sf):
    ev = read(spark, sf, "events").select("event_id", timecols.iso_text("ts").alias("iso"))
    t = F.when(F.col("event_id") % 3 == 0, F.replace("iso", F.lit("T"), F.lit(" "))).otherwise(F.col("iso"))
    return ev.select("event_id", quality.iso_ok(t).alias("ok"))


@query("rule_hours", "SELECT event_id, (hour(ts) >= 9 AND hour(ts) < 18) AS ok FROM events")
def rule_hours(spark, sf):
    return read(spark, sf, "events").select("event_id", quality.working_hour_ok("ts").alias("ok"))


@query("rule_workday", "SELECT event_id, (isodow(ts) - 1) IN (0, 1, 2, 3, 4) AS ok FROM events")
def rule_workday(spark, sf):
    return read(spark, sf, "events").select("event_id", quality.working_day_ok("ts").alias("ok"))


@query("rule_cost_suffix", f"""
WITH {bd.SQL_COSTS}
SELECT l_orderkey, suffix(t, '{fixed.COST_SUFFIX}') AS ok FROM (
  SELECT l_orderkey, CASE WHEN l_orderkey % 5 = 0 THEN CAST(cost AS VARCHAR) || ' rub'
                          ELSE CAST(cost AS VARCHAR) || '{fixed.COST_SUFFIX}' END AS t FROM costs) x
""")
def rule_cost_suffix(spark, sf):
    c = bd.costs(spark, sf)
    t = F.when(F.col("l_orderkey") % 5 == 0, F.concat(F.col("cost").cast("string"), F.lit(" rub"))) \
        .otherwise(derive.cost_text(F.col("cost")))
    return c.select("l_orderkey", quality.cost_suffix_ok(t).alias("ok"))


_SUF = fixed.COST_SUFFIX
_STRIPPED = f"replace(replace(t, '{_SUF}', ''), ' ', '')"
_SQL_AMOUNT = (f"(CASE WHEN suffix(t, '{_SUF}') AND regexp_full_match({_STRIPPED}, '[+-]?[0-9]+') "
               f"THEN TRY_CAST({_STRIPPED} AS BIGINT) END)")


@query("rule_cost_parse", f"""
WITH {bd.SQL_COSTS}
SELECT l_orderkey, coalesce(suffix(t, '{_SUF}') AND try_cast({_STRIPPED} AS HUGEINT) > 0, false) AS ok, {_SQL_AMOUNT} AS amount,
       coalesce(suffix(t, '{_SUF}') AND try_cast({_STRIPPED} AS HUGEINT) IS NOT NULL AND {_SQL_AMOUNT} IS NULL, false) AS overflow FROM (
  SELECT l_orderkey, CASE WHEN l_orderkey % 9 = 0 THEN '12345678901234567890123{_SUF}' WHEN l_orderkey % 4 = 0 THEN 'abc{_SUF}' WHEN l_orderkey % 4 = 1 THEN '0{_SUF}'
     WHEN l_orderkey % 4 = 2 THEN '-5{_SUF}' ELSE CAST(cost AS VARCHAR) || '{_SUF}' END AS t FROM costs) x
""")
def rule_cost_parse(spark, sf):
    c = bd.costs(spark, sf)
    k = F.col("l_orderkey") % 4
    t = (F.when(F.col("l_orderkey") % 9 == 0, F.lit("12345678901234567890123" + _SUF)).when(k == 0, F.lit("abc" + _SUF)).when(k == 1, F.lit("0" + _SUF)).when(k == 2, F.lit("-5" + _SUF))
         .otherwise(derive.cost_text(F.col("cost"))))
    return c.select("l_orderkey", quality.cost_ok(t).alias("ok"), quality.cost_amount(t).alias("amount"),
                    F.coalesce(quality.cost_overflow(t), F.lit(False)).alias("overflow"))


@query("rule_list_size", f"""
SELECT l_orderkey, count(*) AS n_lines, count(*) BETWEEN 1 AND {fixed.ANALYSES_MAX} AS ok FROM lineitem GROUP BY l_orderkey
""")
def rule_list_size(spark, sf):
    n = read(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"))
    return n.withColumn("ok", quality.list_size_ok("n_lines"))


@query("rule_snils_scope", f"""
WITH {_SQL_SNILS_BAD}
SELECT sn.c_custkey, (cc.country = 'ru' AND sn.snils IS NOT NULL AND sn.snils <> ''
        AND NOT {codecs.sql_snils_valid('sn.snils')}) AS broken
FROM sn JOIN (SELECT c_custkey, {bd.SQL_COUNTRY} AS country FROM customer) cc ON cc.c_custkey = sn.c_custkey
""")
def rule_snils_scope(spark, sf):
    s = bad_snils(spark, sf)
    from tabsmith.functions.draws import u
    s = s.withColumn("country", lookups.weighted_case(u("d2", "c_custkey"), fixed.COUNTRY_WEIGHTS, fixed.COUNTRY_DEFAULT))
    return s.select("c_custkey", quality.snils_scope_broken("country", "snils").alias("broken"))


@query("rule_member", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, (m.p IS NOT NULL) AS is_member FROM lineitem l
LEFT JOIN (SELECT DISTINCT p_partkey AS p FROM part WHERE p_size <= 25) m ON m.p = l.l_partkey
""")
def rule_member(spark, sf):
    li = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    d = read(spark, sf, "part").where(F.col("p_size") <= 25)
    return quality.member(li, "l_partkey", d, "p_partkey")


@query("rule_after", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, (l.l_shipdate > o.o_orderdate) AS ok
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
""")
def rule_after(spark, sf):
    li = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    o = read(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return li.join(o, "l_orderkey").select("l_orderkey", "l_linenumber", "l_partkey",
                                           quality.after_ok("o_orderdate", "l_shipdate").alias("ok"))


@query("rule_parse", """
SELECT event_id, (t IS NOT NULL AND try_strptime(t, '%Y-%m-%d %H:%M:%S') IS NULL) AS broken FROM (
  SELECT event_id, '2024-01-' || lpad(json_extract_string(props, '$.k'), 2, '0') || ' 10:00:00' AS t FROM events) x
""")
def rule_parse(spark, sf):
    ev = read(spark, sf, "events")
    t = F.concat(F.lit("2024-01-"), F.lpad(F.get_json_object("props", "$.k"), 2, "0"), F.lit(" 10:00:00"))
    return ev.select("event_id", quality.parse_broken(t).alias("broken"))


@query("rule_gap_range", f"""
SELECT event_id, g AS gap_hours, (g < 24 OR g > 168) AS broken, {quality.sql_gap_message('g')} AS message FROM (
  SELECT event_id, {timecols.sql_hours_between('ts', 'r')} AS g FROM (
    SELECT event_id, ts, {bd.SQL_RESULT} AS r FROM events) x) y
""")
def rule_gap_range(spark, sf):
    r = bd.results(spark, sf)
    return r.select("event_id", quality.gap_hours("ts", "result_ts").alias("gap_hours"),
                    quality.gap_broken("ts", "result_ts").alias("broken"), quality.gap_message("ts", "result_ts").alias("message"))


def doc_rules():
    return [
        quality.Rule("EMPTY_TEXT", F.col("text").isNull() | (F.trim("text") == "")),
        quality.Rule("FEW_WORDS", F.size(F.split(F.trim("text"), r"\s+")) < 3),
        quality.Rule("SOURCE_FORMAT", ~F.col("source").rlike(r"^src[0-9]+$")),
        quality.Rule("PASSPORT_LIKE", F.col("text").rlike(r"[0-9]{4} [0-9]{6}")),
        quality.Rule("CARD_LIKE", F.col("text").rlike(r"[0-9]{4} [0-9]{4} [0-9]{4} [0-9]{4}")),
    ]


SQL_DOC_ERRORS = r"""doc_err AS (SELECT doc_id, list_filter([
    CASE WHEN text IS NULL OR trim(text) = '' THEN 'EMPTY_TEXT' END,
    CASE WHEN len(regexp_split_to_array(trim(text), '\s+')) < 3 THEN 'FEW_WORDS' END,
    CASE WHEN NOT regexp_full_match(source, 'src[0-9]+') THEN 'SOURCE_FORMAT' END,
    CASE WHEN regexp_matches(text, '[0-9]{4} [0-9]{6}') THEN 'PASSPORT_LIKE' END,
    CASE WHEN regexp_matches(text, '[0-9]{4} [0-9]{4} [0-9]{4} [0-9]{4}') THEN 'CARD_LIKE' END], lambda x: x IS NOT NULL) AS errors
  FROM documents)"""


def doc_errors(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "text", "source")
    return quality.row_errors(docs, doc_rules())


@query("row_errors", f"WITH {SQL_DOC_ERRORS} SELECT doc_id, array_to_string(errors, ';') AS errors, len(errors) = 0 AS valid FROM doc_err")
def row_errors(spark, sf):
    return doc_errors(spark, sf).select("doc_id", F.array_join("errors", ";").alias("errors"), "valid")


@query("cap_violations", f"WITH {bk.SQL_USES} SELECT event_id, user_id, use_no FROM uses WHERE use_no > {fixed.CARD_REUSE_LIMIT}")
def cap_violations(spark, sf):
    return quality.cap_violations(bk.uses(spark, sf)).select("event_id", "user_id", "use_no")


@query("fd_violations", "SELECT p_brand, count(DISTINCT p_type) AS n_values FROM part GROUP BY p_brand HAVING count(DISTINCT p_type) > 1")
def fd_violations(spark, sf):
    return quality.fd_violations(read(spark, sf, "part"), "p_brand", "p_type")


@query("unique_violations", """
SELECT c_nationkey, count(DISTINCT c_custkey) AS n_owners FROM customer GROUP BY c_nationkey
HAVING count(DISTINCT c_custkey) > 1
""")
def unique_violations(spark, sf):
    return quality.unique_violations(read(spark, sf, "customer"), "c_nationkey", "c_custkey")


@query("min_rows", f"""
SELECT r.n AS rows_count, w.n AS distinct_words, s.n AS distinct_specialists, i.n AS distinct_items,
       r.n >= {fixed.DATASET_MIN_ROWS} AS rows_ok, w.n >= {fixed.DICT_MIN_SYMPTOMS} AS words_ok,
       s.n >= {fixed.DICT_MIN_DOCTORS} AS specialists_ok, i.n >= {fixed.DICT_MIN_ANALYSES} AS items_ok
FROM (SELECT count(*) AS n FROM events) r,
     (SELECT count(DISTINCT t.w) AS n FROM part, unnest({tokens('p_name')}) AS t(w)) w,
     (SELECT count(DISTINCT p_brand) AS n FROM part) s,
     (SELECT count(DISTINCT p_name) AS n FROM part) i
""")
def min_rows(spark, sf):
    part = read(spark, sf, "part")
    words = part.select(F.explode(lookups.tokens("p_name")).alias("w")).agg(F.count_distinct("w")).scalar()
    specs = part.agg(F.count_distinct("p_brand")).scalar()
    items = part.agg(F.count_distinct("p_name")).scalar()
    r = read(spark, sf, "events").agg(F.count(F.lit(1)).alias("rows_count"))
    m = r.select("rows_count", words.alias("distinct_words"), specs.alias("distinct_specialists"),
                 items.alias("distinct_items"))
    return m.select(
        "rows_count", "distinct_words", "distinct_specialists", "distinct_items",
        (F.col("rows_count") >= fixed.DATASET_MIN_ROWS).alias("rows_ok"),
        (F.col("distinct_words") >= fixed.DICT_MIN_SYMPTOMS).alias("words_ok"),
        (F.col("distinct_specialists") >= fixed.DICT_MIN_DOCTORS).alias("specialists_ok"),
        (F.col("distinct_items") >= fixed.DICT_MIN_ANALYSES).alias("items_ok"))


@query("revisit_gap", f"""
WITH r AS (SELECT event_id, user_id, ts, {bd.SQL_RESULT} AS result_ts FROM events),
p AS (SELECT event_id, user_id, ts, lag(result_ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_result FROM r)
SELECT event_id, user_id, {timecols.sql_hours_between('prev_result', 'ts')} AS gap_hours,
       coalesce({timecols.sql_hours_between('prev_result', 'ts')} < 24, false) AS too_soon FROM p
""")
def revisit_gap(spark, sf):
    r = bd.results(spark, sf, cols=("event_id", "user_id", "ts"))
    out = quality.revisit_gaps(r, "user_id", "ts", "result_ts", "event_id", bk.day_block())
    return out.select("event_id", "user_id", "gap_hours", "too_soon")


@query("dict_audit", """
SELECT 'duplicate' AS check_name, p_name AS item, count(*) AS n FROM part GROUP BY p_name HAVING count(*) > 1
UNION ALL SELECT 'weight_sum', '', CAST(sum(n_nationkey % 5 + 1) AS BIGINT) FROM nation
UNION ALL SELECT 'unreachable', n_name, CAST(lo AS BIGINT) FROM (
  SELECT n_name, coalesce(sum(n_nationkey % 5 + 1) OVER (ORDER BY n_nationkey
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lo FROM nation) x WHERE lo >= 50
""")
def dict_audit(spark, sf):
    """V-23 on two dictionaries: duplicate item names, and nation weights (integer
    units of 1/50) whose running sum leaves the tail unreachable."""
    from pyspark.sql import Window
    part = read(spark, sf, "part")
    dup = part.groupBy("p_name").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1) \
        .select(F.lit("duplicate").alias("check_name"), F.col("p_name").alias("item"), "n")
    nat = read(spark, sf, "nation").withColumn("w", (F.col("n_nationkey") % 5 + 1).cast("bigint"))
    total = nat.agg(F.sum("w").alias("n")).select(F.lit("weight_sum").alias("check_name"), F.lit("").alias("item"), "n")
    wlo = Window.orderBy("n_nationkey").rowsBetween(Window.unboundedPreceding, -1)
    lo = nat.withColumn("n", F.coalesce(F.sum("w").over(wlo), F.lit(0)).cast("bigint")).where(F.col("n") >= 50) \
        .select(F.lit("unreachable").alias("check_name"), F.col("n_name").alias("item"), "n")
    return dup.unionByName(total).unionByName(lo)
