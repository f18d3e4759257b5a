"""Binding K-7: the assembled visit table (one visit per events row, dictionaries from
part), its row-rule check, and the report over it, each with its DuckDB form restated
step by step."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from tabsmith.functions import codecs, timecols
from tabsmith.operators import derive, profile, quality
from tabsmith.plans import bind_derive as bd
from tabsmith.plans import bind_quality as bq
from tabsmith.plans import visits
from tabsmith.plans.bind_draws import sql_fallback, sql_tiers
from tabsmith.plans.bind_keyed import sql_cards
from tabsmith.plans.registry import query
from tabsmith.plans.sqlbits import sql_pick_index, sql_rand_int, sql_shuffled, sql_u, tokens
from tabsmith.session import materialize
from tabsmith.sources import fixed, lookups

P = visits.VisitParams()


def _values(items) -> str:
    return ", ".join(f"('{x}')" for x in items)


def _index(name: str, source: str) -> str:
    """A dictionary (idx, value) over ``source``, a query of one column v, and its size."""
    return (f"{name} AS (SELECT CAST(row_number() OVER (ORDER BY v) - 1 AS BIGINT) AS idx, v AS value FROM (SELECT DISTINCT v FROM ({source}))),\n"
            f"n_{name} AS (SELECT count(*) AS n FROM {name})")


def _grouped(name: str, source: str) -> str:
    """A dictionary per group over ``source`` (g, v): (g, v, idx), and sizes."""
    return (f"{name} AS (SELECT g, v, CAST(row_number() OVER (PARTITION BY g ORDER BY v) - 1 AS BIGINT) AS idx FROM (SELECT DISTINCT g, v FROM ({source}))),\n"
            f"n_{name} AS (SELECT g, count(*) AS n FROM {name} GROUP BY g)")


def _own(name: str, items: str, item: str, stream: str, size: tuple[int, int]) -> str:
    """(doctor, item): each doctor's own list, items at places of the doctor's permutation."""
    return f"""{name}_d AS (SELECT {item}, row_number() OVER (ORDER BY {item}) - 1 AS idx FROM (SELECT DISTINCT {item} FROM {items})),
{name}_p AS (SELECT doctor, {sql_shuffled(f'(SELECT count(*) FROM {name}_d)', 'i', stream, 'doctor')} AS idx
  FROM (SELECT doctor, unnest(range({sql_rand_int(*size, stream + ':k', 'doctor')})) AS i FROM doctors)),
{name} AS (SELECT doctor, {item} FROM {name}_p JOIN {name}_d USING (idx))"""


def _lpad(x: str, n: int) -> str:
    return f"lpad(CAST({x} AS VARCHAR), {n}, '0')"


# a number in the code space of its group: Russian series, or the country
_SERIES = f"CASE WHEN country = 'ru' THEN {_lpad('region', 2)} || strftime(issue_date, '%y') ELSE country END"
_SPACE = f"CASE country WHEN 'ru' THEN 999999 WHEN 'by' THEN {9_000_000 * len(fixed.BY_PREFIXES)} ELSE 90000000 END"
_PASSPORT = (f"CASE country WHEN 'ru' THEN grp || ' ' || {_lpad('place + 1', 6)} "
             f"WHEN 'by' THEN {bd._BY_LIST}[place // 9000000 + 1] || CAST(1000000 + place % 9000000 AS VARCHAR) ELSE '{fixed.KZ_PREFIX}' || CAST(10000000 + place AS VARCHAR) END")
_P15 = f"(bin || {_lpad(sql_shuffled('1000000000', 'card_no', 'k7:card_digits'), 9)})"
_CARD = f"p15 || CAST({codecs.sql_luhn_check_digit('p15')} AS VARCHAR)"


_TIERS, _TIERS_TOTAL = sql_tiers("k7:age", "client_no")
_REGION = lookups.sql_weighted_case(sql_u("k7:region", "client_no"), fixed.RU_REGIONS, fixed.RU_REGION_DEFAULT)
_COUNTRY = lookups.sql_weighted_case(sql_u("k7:country", "client_no"), fixed.COUNTRY_WEIGHTS, fixed.COUNTRY_DEFAULT)
_AGE = sql_pick_index(_TIERS_TOTAL, "k7:age", "c.client_no")
_BANK = lookups.sql_weighted_case(sql_u("k7:bank", "card_id"), fixed.BANK_WEIGHTS, fixed.BANK_DEFAULT)
_SYSTEM = lookups.sql_weighted_case(sql_u("k7:system", "card_id"), fixed.SYSTEM_WEIGHTS, fixed.SYSTEM_DEFAULT)
_INFER = "CASE " + " ".join(f"WHEN regexp_full_match(passport, '{p}') THEN '{c}'" for c, p in bd._PAT) + " ELSE 'ru' END"
_EXACT = "CASE " + " ".join(f"WHEN item = '{n}' THEN {x}" for n, x in fixed.ANALYSIS_PRICES) + " END"
_PRICE = f"coalesce({_EXACT}, {derive.sql_keyword_price('item', fixed.PRICE_KEYWORDS, fixed.PRICE_RANGES, fixed.PRICE_DEFAULT)})"
_SWAPS = ", ".join(f"('{g}', '{a}', '{b}')" for g, a, b in P.swaps)
_ONE, _NONE = fixed.SPECIALIST_ONE_MATCH_PROBABILITY, fixed.DEFAULT_ON_NO_MATCH_PROBABILITY

SQL_DICTIONARIES = f"""
voc AS (SELECT DISTINCT p_name, p_type, p_brand FROM part),
pnames AS (SELECT DISTINCT p_name FROM voc), ptypes AS (SELECT DISTINCT lower(p_type) AS t FROM voc),
pwords AS (SELECT DISTINCT unnest({tokens('p_name')}) AS w FROM pnames),
pbrands AS (SELECT DISTINCT lower(replace(p_brand, '#', '')) AS b FROM voc),
pjoined AS (SELECT DISTINCT replace(p_name, ' ', '') AS n FROM pnames),
doctors AS (SELECT DISTINCT b.p_brand || ' ' || t.p_type AS doctor FROM voc b, (SELECT DISTINCT p_type FROM voc) t),
{_index('doc', 'SELECT doctor AS v FROM doctors')},
symptoms AS (SELECT g || ' ' || p_name || ' ' || t AS word FROM pnames, ptypes, (VALUES {_values(P.grades)}) v(g)),
analyses AS (SELECT k || ' ' || p_name AS item FROM pnames, (VALUES {_values(P.kinds)}) v(k)),
{_own('own_s', 'symptoms', 'word', 'k7:own_s', P.own_symptoms)},
{_own('own_a', 'analyses', 'item', 'k7:own_a', P.own_analyses)},
general_a AS (SELECT * FROM (VALUES {_values(P.general_analyses)}) v(item)),
{_grouped('allowed', f"SELECT g, doctor AS v FROM doctors, (VALUES ('M'), ('F')) x(g) WHERE {sql_u('k7:allow', 'g', 'doctor')} < {P.allowed}")},
{_index('surn', 'SELECT n || t AS v FROM pjoined, ptypes')},
{_index('patr', 'SELECT t || w AS v FROM ptypes, pwords')},
{_grouped('given', f"SELECT CASE WHEN {sql_u('k7:name_g', 'v')} < 0.5 THEN 'M' ELSE 'F' END AS g, v FROM (SELECT w || b AS v FROM pwords, pbrands)")},
{_grouped('bins', f"SELECT * FROM (VALUES {bd._BIN_VALUES}) x(g, v)")}"""

SQL_VISITS = f"""{SQL_DICTIONARIES},
rf AS (SELECT visit_id, rn < {P.pool_min} OR {sql_u('k7:client:repeat', 'visit_id')} >= {P.p_repeat} AS is_new
       FROM (SELECT event_id AS visit_id, row_number() OVER (ORDER BY event_id) - 1 AS rn FROM events)),
rc AS (SELECT visit_id, is_new, coalesce(sum(CASE WHEN is_new THEN 1 ELSE 0 END) OVER (ORDER BY visit_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM rf),
vrows AS (SELECT visit_id, is_new, CAST(CASE WHEN is_new THEN before ELSE floor({sql_u('k7:client:pick', 'visit_id')} * before) END AS BIGINT) AS client_no,
          {timecols.sql_work_slot('k7:visit', 'visit_id', P.anchor, P.window_days)} AS visit_ts FROM rc),
c0 AS (SELECT client_no, visit_ts, CASE WHEN {sql_u('k7:gender', 'client_no')} < 0.5 THEN 'M' ELSE 'F' END AS gender FROM vrows WHERE is_new),
c1 AS (SELECT c.client_no, c.visit_ts, c.gender, concat_ws(' ',
         CASE WHEN c.gender = 'F' THEN {derive.sql_suffix_rewrite('s.value', P.name_rules)} ELSE s.value END, g.v, p.value) AS full_name,
         {_COUNTRY} AS country, {_REGION} AS region,
         make_date(CAST(year(c.visit_ts) - t.age AS BIGINT), {sql_rand_int(1, 12, 'k7:birth:month', 'c.client_no')}, {sql_rand_int(1, 28, 'k7:birth:day', 'c.client_no')}) AS birth_date
       FROM c0 c CROSS JOIN n_surn CROSS JOIN n_patr
       LEFT JOIN surn s ON s.idx = {sql_pick_index('n_surn.n', 'k7:surname', 'c.client_no')}
       LEFT JOIN patr p ON p.idx = {sql_pick_index('n_patr.n', 'k7:patronymic', 'c.client_no')}
       LEFT JOIN n_given ng ON ng.g = c.gender
       LEFT JOIN given g ON g.g = c.gender AND g.idx = CAST(floor({sql_u('k7:name', 'c.client_no')} * ng.n) AS BIGINT)
       LEFT JOIN {_TIERS} t ON {_AGE} >= t.cum_lo AND {_AGE} < t.cum_hi),
c2 AS (SELECT *, {bd._sql_issue('birth_date', 'visit_ts', 'k7:issue', 'client_no')} AS issue_date FROM c1),
c3 AS (SELECT *, CASE WHEN country = 'ru' THEN {_lpad('region', 3)} || '-' || {_lpad(sql_rand_int(1, 999, 'k7:dept:unit', 'client_no'), 3)} END AS dept_code FROM c2),
c3g AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY client_no) - 1 AS no, {_SPACE} AS space FROM (SELECT *, {_SERIES} AS grp FROM c3)),
c3p AS (SELECT *, {sql_shuffled('space', 'no', 'k7:passport', 'grp')} AS place, {_lpad(sql_shuffled('1000000000', 'client_no', 'k7:snils'), 9)} AS nine FROM c3g),
c4 AS (SELECT *, {_PASSPORT} AS passport, {codecs.sql_snils_format('nine')} AS snils FROM c3p),
first AS (SELECT full_name, min(client_no) AS fc, arg_min(passport, client_no) AS passport, arg_min(snils, client_no) AS snils FROM c4 GROUP BY full_name),
clients AS (SELECT c4.client_no, full_name, gender, f.passport, f.snils,
       CASE WHEN f.fc <> c4.client_no THEN {_INFER.replace('passport,', 'f.passport,')} ELSE country END AS passport_country,
       CASE WHEN f.fc = c4.client_no AND country = 'ru' THEN issue_date END AS passport_issue_date,
       CASE WHEN f.fc = c4.client_no THEN dept_code END AS dept_code FROM c4 JOIN first f USING (full_name)),
v1 AS (SELECT r.visit_id, r.is_new, r.visit_ts, c.*, {sql_u('k7:path', 'r.visit_id')} < {P.p_gender_path} AS path_gender, a.v AS doc_g, d.value AS doc_t
       FROM vrows r JOIN clients c USING (client_no) CROSS JOIN n_doc
       LEFT JOIN n_allowed na ON na.g = c.gender
       LEFT JOIN allowed a ON a.g = c.gender AND a.idx = CAST(floor({sql_u('k7:doc_g', 'r.visit_id')} * na.n) AS BIGINT)
       LEFT JOIN doc d ON d.idx = {sql_pick_index('n_doc.n', 'k7:doc_t', 'r.visit_id')}),
v2 AS (SELECT *, CASE WHEN path_gender THEN doc_g ELSE doc_t END AS symptom_doctor FROM v1),
{sql_fallback('sym', 'v2', 'visit_id', 'symptom_doctor', 'own_s', 'doctor', 'symptoms', 'word', sql_rand_int(*P.symptoms, 'k7:k_symptoms', 'r.visit_id'), P.symptoms[1], 'k7:symptoms')},
sym_text AS (SELECT visit_id, string_agg(word, ', ' ORDER BY rank) AS symptoms FROM sym GROUP BY visit_id),
vocab AS (SELECT DISTINCT word AS term FROM sym JOIN v2 USING (visit_id) WHERE NOT path_gender),
own_w AS (SELECT DISTINCT word FROM own_s),
hit AS (SELECT t.term, o.doctor FROM (SELECT term, word FROM vocab, own_w WHERE contains(term, word) OR contains(word, term)) t JOIN own_s o USING (word) GROUP BY ALL),
scores AS (SELECT s.visit_id, h.doctor, count(DISTINCT s.word) AS score FROM sym s JOIN v2 USING (visit_id) JOIN hit h ON h.term = s.word WHERE NOT path_gender GROUP BY ALL),
best AS (SELECT visit_id, doctor, score, row_number() OVER (PARTITION BY visit_id ORDER BY doctor) - 1 AS bi, count(*) OVER (PARTITION BY visit_id) AS nb
         FROM (SELECT *, max(score) OVER (PARTITION BY visit_id) AS mx FROM scores) WHERE score = mx),
chosen AS (SELECT visit_id, doctor, score FROM best WHERE bi = floor({sql_u('k7:doc_s:best', 'visit_id')} * nb)),
v3 AS (SELECT v2.*, CASE WHEN path_gender THEN doc_g
         WHEN coalesce(c.score, 0) >= 2 THEN c.doctor
         WHEN c.score = 1 THEN CASE WHEN {sql_u('k7:doc_s:one', 'v2.visit_id')} < {_ONE} THEN c.doctor ELSE '{P.default_specialist}' END
         ELSE CASE WHEN {sql_u('k7:doc_s:none', 'v2.visit_id')} < {_NONE} THEN '{P.default_specialist}' ELSE d.value END END AS doctor0
       FROM v2 LEFT JOIN chosen c ON c.visit_id = v2.visit_id CROSS JOIN n_doc
       LEFT JOIN doc d ON d.idx = floor({sql_u('k7:doc_s:any', 'v2.visit_id')} * n_doc.n)),
v4 AS (SELECT v3.*, CASE WHEN a.v IS NULL AND s.nv IS NOT NULL THEN s.nv ELSE doctor0 END AS doctor FROM v3
       LEFT JOIN allowed a ON a.g = gender AND a.v = doctor0 LEFT JOIN (VALUES {_SWAPS}) s(g, ov, nv) ON s.g = gender AND s.ov = doctor0),
{sql_fallback('ana', 'v4', 'visit_id', 'doctor', 'own_a', 'doctor', 'general_a', 'item', sql_rand_int(*P.analyses, 'k7:k_analyses', 'r.visit_id'), P.analyses[1], 'k7:analyses')},
ana_text AS (SELECT visit_id, string_agg(item, ', ' ORDER BY rank) AS analyses, CAST(sum({_PRICE}) AS BIGINT) AS cost FROM ana GROUP BY visit_id),
{sql_cards('vrows', 'visit_id', 'k7:card', P.p_reuse, P.card_cap, 'uses').lstrip()},
k1 AS (SELECT card_id, card_no, {_BANK} || '/' || {_SYSTEM} AS grp FROM uses WHERE new_card),
k2 AS (SELECT k1.card_id, k1.card_no, b.v AS bin FROM k1 LEFT JOIN n_bins n ON n.g = k1.grp
       LEFT JOIN bins b ON b.g = k1.grp AND b.idx = CAST(floor({sql_u('k7:bin', 'k1.card_id')} * n.n) AS BIGINT)),
num AS (SELECT card_id, {_CARD} AS code FROM (SELECT card_id, {_P15} AS p15 FROM k2)),
visits AS (SELECT v4.visit_id, v4.client_no AS client_id, full_name, gender, passport, passport_country, passport_issue_date, dept_code, snils,
       symptoms, doctor, visit_ts, analyses, {timecols.sql_result_snap('visit_ts', sql_rand_int(24, 72, 'k7:result_hours', 'v4.visit_id'))} AS result_ts,
       cost, u.card_id, CAST(u.use_no AS BIGINT) AS card_use, {codecs.sql_group4('num.code')} AS card, is_new
     FROM v4 JOIN sym_text USING (visit_id) JOIN ana_text USING (visit_id) JOIN uses u ON u.visit_id = v4.visit_id JOIN num ON num.card_id = u.card_id)"""


@query("assemble_visits", f"WITH RECURSIVE {SQL_VISITS} SELECT * FROM visits")
def assemble_visits(spark, sf):
    return visits.visits_from(spark, sf)


_RU = bq._sql_ru_errors("passport", "CAST(passport_issue_date AS VARCHAR)", "dept_code", "visit_ts")
_FORMAT = "CASE " + " ".join(f"WHEN passport_country = '{c}' THEN regexp_full_match(passport, '{p[1:-1]}')" for c, p in fixed.PASSPORT_PATTERNS) + " ELSE false END"
_GAP = timecols.sql_hours_between("visit_ts", "result_ts")
_ISO = quality.ISO_PATTERN[1:-1]
SQL_CHECKED = f"""{SQL_VISITS},
ru AS (SELECT *, CASE WHEN passport_country = 'ru' THEN {_RU} ELSE '' END AS passport_errors FROM visits),
er AS (SELECT *, concat_ws(';',
    CASE WHEN len(regexp_split_to_array(trim(full_name), '\\s+')) <> 3 THEN 'NAME_NOT_3_WORDS' END,
    CASE WHEN passport_errors <> '' THEN 'RU_PASSPORT' END,
    CASE WHEN passport_country <> 'ru' AND NOT coalesce({_FORMAT}, false) THEN 'PASSPORT_FORMAT' END,
    CASE WHEN passport_country = 'ru' AND snils <> '' AND NOT {codecs.sql_snils_valid('snils')} THEN 'SNILS' END,
    CASE WHEN NOT regexp_full_match({timecols.sql_iso_text('visit_ts')}, '{_ISO}') THEN 'VISIT_ISO' END,
    CASE WHEN NOT regexp_full_match({timecols.sql_iso_text('result_ts')}, '{_ISO}') THEN 'RESULT_ISO' END,
    CASE WHEN NOT {codecs.sql_luhn_valid('card')} THEN 'CARD' END,
    CASE WHEN result_ts <= visit_ts THEN 'RESULT_NOT_AFTER' END,
    CASE WHEN {_GAP} < {timecols.RESULT_MIN_HOURS} OR {_GAP} > {timecols.GAP_MAX_HOURS} THEN 'RESULT_GAP' END) AS errors FROM ru),
checked AS (SELECT *, errors = '' AS valid FROM er)"""


@query("visit_errors", f"WITH RECURSIVE {SQL_CHECKED} SELECT * FROM checked")
def visit_errors(spark, sf):
    return visits.visit_errors(visits.visits_from(spark, sf))


SQL_REPORT = f"""WITH RECURSIVE {SQL_CHECKED},
m AS (SELECT count(*) AS rows, count(DISTINCT client_id) AS clients, sum(CASE WHEN is_new THEN 1 ELSE 0 END) AS new_clients,
  count(DISTINCT passport) AS unique_passports, count(DISTINCT snils) AS unique_snils, count(DISTINCT card) AS cards,
  max(card_use) AS max_card_use, sum(len(string_split(errors, ';')) * CASE WHEN errors = '' THEN 0 ELSE 1 END) AS errors,
  sum(CASE WHEN valid THEN 0 ELSE 1 END) AS bad_rows, sum(cost) AS total_cost FROM checked)
SELECT unnest(['rows', 'clients', 'new_clients', 'unique_passports', 'unique_snils', 'cards', 'max_card_use', 'errors', 'bad_rows', 'total_cost']) AS metric,
  unnest([rows::VARCHAR, clients::VARCHAR, new_clients::VARCHAR, unique_passports::VARCHAR, unique_snils::VARCHAR, cards::VARCHAR, max_card_use::VARCHAR,
          errors::BIGINT::VARCHAR, bad_rows::BIGINT::VARCHAR, total_cost::BIGINT::VARCHAR]) AS value FROM m"""


@query("visit_report", SQL_REPORT)
def visit_report(spark, sf):
    """A-1..A-4, A-8 over the visit table itself: one number per metric. Counters and sums
    are observed while the table is written; only distinct counts read it again."""
    n_errors = F.when(F.col("errors") == "", 0).otherwise(F.size(F.split("errors", ";")))
    seen = Observation("visit-report")
    v = materialize(visit_errors(spark, sf).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.sum(F.col("is_new").cast("bigint")).alias("new_clients"), F.max("card_use").alias("max_card_use"),
        F.sum(n_errors).alias("errors"), F.sum((~F.col("valid")).cast("bigint")).alias("bad_rows"), F.sum("cost").alias("total_cost")), "visits-checked")
    one = spark.range(1).select(
        *[F.lit(x).cast("bigint").alias(name) for name, x in seen.get.items()],
        *[profile.distinct_count(v, c).alias(name) for c, name in (("client_id", "clients"), ("passport", "unique_passports"), ("snils", "unique_snils"), ("card", "cards"))])
    order = ["rows", "clients", "new_clients", "unique_passports", "unique_snils", "cards", "max_card_use", "errors", "bad_rows", "total_cost"]
    return profile.run_report(one.select(*order))


@query("visit_text", f"""WITH RECURSIVE {SQL_VISITS} SELECT visit_id, full_name, passport, passport_country, passport_issue_date, dept_code, coalesce(snils, '') AS snils,
  symptoms, doctor, {timecols.sql_iso_text('visit_ts')} AS visit_date, analyses, {timecols.sql_iso_text('result_ts')} AS analysis_date,
  CAST(cost AS VARCHAR) || '{fixed.COST_SUFFIX}' AS analysis_cost, card AS payment_card FROM visits""")
def visit_text(spark, sf):
    """The record as text (S-8), as the sinks write it."""
    return visits.text_projection(visits.visits_from(spark, sf))
