"""K-7 ``assemble_visits``: the full visit table.

Rows come from a driver table (one visit per row, ordered by a unique long key);
dictionaries come from the whole catalogue table, grown by products and variants (S-3,
S-5) to more than 5,000 symptoms, 50 doctors and 250 analyses. Every draw is keyed by
the visit number, the client number or the card number, so the table is the same under
any number of partitions. The builder writes stages that several branches reuse (rows,
clients, cards) before it returns the final plan. Codes are places of keyed permutations
of their spaces, unique without rounds or a register.
Shuffles are the prefix sums of the client and card pools, the per-card use numbering
and the joins to clients and cards; lists are arrays chosen inside projections.

Pieces (SURVEY §2): K-5 client pool, F-2 names, D-2 country, F-6/F-7 passport,
F-8/F-9 dates, F-3 SNILS, K-6 no passport, SNILS or card number twice, K-1 one passport
per name, D-5 path, D-8 doctor by gender, D-9 symptoms with fallback, F-20 doctor by
symptoms, F-13 gender swap, F-10 visit time, D-9 analyses, F-11 result time, F-15/F-16
cost, K-4 card pool, F-4 card, F-12/F-17/F-18 text forms; ``visit_errors`` applies the
row rules (V-17).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.functions import codecs, timecols
from tabsmith.functions.draws import rand_int, shuffled, u
from tabsmith.operators import derive, draws, keyed, quality
from tabsmith.plans import vocab
from tabsmith.sources import fixed, lookups
from tabsmith.session import materialize
from tabsmith.sources.tables import read


@dataclass(frozen=True)
class VisitParams:
    anchor: str = "2024-01-31"               # last day of the visit window
    window_days: int = 30
    symptoms: tuple[int, int] = fixed.SYMPTOMS_PER_VISIT
    analyses: tuple[int, int] = fixed.ANALYSES_PER_VISIT
    p_repeat: float = fixed.CLIENT_REPEAT_PROBABILITY
    pool_min: int = fixed.CLIENT_POOL_MIN
    p_reuse: float = fixed.CARD_REUSE_PROBABILITY
    card_cap: int = fixed.CARD_REUSE_LIMIT
    p_gender_path: float = fixed.PATH_BY_GENDER_PROBABILITY
    grades: tuple = ("faint", "mild", "light", "brief", "dull", "sharp", "severe", "acute", "chronic", "morning", "evening",
                     "sudden", "steady", "rare")             # symptom = grade + part name + type
    kinds: tuple = ("анализ крови", "анализ мочи", "мазок", "узи", "проба")   # analysis = kind + part name
    own_symptoms: tuple[int, int] = (30, 78)     # sizes of a doctor's own lists
    own_analyses: tuple[int, int] = (8, 24)
    allowed: float = 0.6                     # share of the allow-lists
    default_specialist: str = "Brand#1 ECONOMY"
    swaps: tuple = (("M", "Brand#1 ECONOMY", "Brand#2 ECONOMY"), ("M", "Brand#3 PROMO", "Brand#2 PROMO"),
                    ("F", "Brand#4 SMALL", "Brand#5 SMALL"), ("F", "Brand#6 LARGE", "Brand#5 LARGE"))
    general_analyses: tuple = ("общий анализ крови", "общий анализ мочи")
    name_rules: tuple = vocab.ENGLISH_RULES


class Dictionaries:
    """Clinic dictionaries derived from the whole catalogue table (part). All are bounded
    by its vocabulary (words, names, types, brands), not by its rows."""

    def __init__(self, spark: SparkSession, part: DataFrame, p: VisitParams):
        vocabulary = materialize(part.select("p_name", "p_type", "p_brand").distinct(), "visits-vocabulary")
        names = vocabulary.select("p_name").distinct()
        types = vocabulary.select(F.lower("p_type").alias("t")).distinct()
        words = names.select(F.explode(lookups.tokens("p_name")).alias("w")).distinct()
        brand_word = vocabulary.select(F.lower(F.replace("p_brand", F.lit("#"), F.lit(""))).alias("b")).distinct()
        joined = names.select(F.replace("p_name", F.lit(" "), F.lit("")).alias("n")).distinct()

        doctors = lookups.dict_cross(vocabulary, "p_brand", vocabulary, "p_type", out_col="doctor")
        self.doctors = lookups.dictionary(doctors, "doctor")
        phrases = lookups.dict_cross(names, "p_name", types, "t", out_col="phrase")
        self.symptoms = materialize(lookups.dict_variants(phrases, "phrase", p.grades, out_col="word").select("word"), "visits-symptoms")
        self.analyses = materialize(lookups.dict_variants(names, "p_name", p.kinds, out_col="item").select("item"), "visits-analyses")
        self.own_symptoms = materialize(self._own(doctors, self.symptoms, "word", "k7:own_s", p.own_symptoms), "visits-own-symptoms")
        self.own_analyses = materialize(self._own(doctors, self.analyses, "item", "k7:own_a", p.own_analyses), "visits-own-analyses")
        self.general_analyses = spark.createDataFrame([(x,) for x in p.general_analyses], "item string")
        self.allowed = doctors.select(F.explode(F.array(F.lit("M"), F.lit("F"))).alias("gender"), "doctor").where(
            u("k7:allow", "gender", "doctor") < F.lit(p.allowed))
        self.surnames = lookups.dictionary(lookups.dict_cross(joined, "n", types, "t", "", "w"), "w")
        self.patronymics = lookups.dictionary(lookups.dict_cross(types, "t", words, "w", "", "v"), "v")
        given = lookups.dict_cross(words, "w", brand_word, "b", "", "w")
        self.names = given.select(F.when(u("k7:name_g", "w") < F.lit(0.5), "M").otherwise("F").alias("g"), "w")
        self.swaps = spark.createDataFrame(list(p.swaps), "gender string, doctor string, new_value string")
        rows = [(f"{b}/{s}", x) for b, ss in fixed.BANK_BINS.items() for s, xs in ss.items() for x in xs]
        self.bins = spark.createDataFrame(rows, "grp string, bin string")

    @staticmethod
    def _own(doctors: DataFrame, items: DataFrame, item_col: str, stream: str, size: tuple[int, int]) -> DataFrame:
        """Each doctor's own list: as many items as a draw says, at the first places of a
        permutation keyed by the doctor, joined on their index."""
        numbered = lookups.dictionary(items, item_col, out_col=item_col)
        n = numbered.count()
        slots = doctors.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), rand_int(*size, stream + ":k", "doctor"))))
        at = shuffled(slots, n, {"idx": F.col("_i") - 1}, stream, "doctor")
        return at.join(numbered, "idx").select("doctor", item_col)


def _clients(spark: SparkSession, new_rows: DataFrame, d: Dictionaries, p: VisitParams) -> DataFrame:
    """Client dimension, one row per client_no, drawn from the client's first visit."""
    c = new_rows.select("client_no", "visit_ts").withColumn(
        "gender", F.when(u("k7:gender", "client_no") < F.lit(0.5), "M").otherwise("F"))
    c = draws.pick_uniform(c, d.surnames, "k7:surname", ["client_no"], "surname")
    c = draws.pick_uniform(c, d.patronymics, "k7:patronymic", ["client_no"], "patronymic")
    c = draws.pick_grouped(c, "gender", d.names, "g", "w", "k7:name", ["client_no"], "name")
    surname = derive.gendered_surname(F.col("surname"), F.col("gender"), p.name_rules)
    c = c.withColumn("full_name", derive.full_name(surname, F.col("name"), F.col("patronymic")))
    # draws that a ladder of cases compares again and again are columns first
    c = c.withColumns({"_country": u("k7:country", "client_no"), "_region": u("k7:region", "client_no")})
    c = c.withColumn("country", lookups.weighted_case(F.col("_country"), fixed.COUNTRY_WEIGHTS, fixed.COUNTRY_DEFAULT))
    tiers, total = lookups.tier_table(spark, fixed.AGE_TIERS)
    c = draws.pick_tiered(c, tiers, total, "k7:age", ["client_no"], "age")
    c = c.withColumn("birth_date", derive.birth_date(F.col("visit_ts"), F.col("age"), "k7:birth", "client_no"))
    c = c.withColumn("issue_date", derive.issue_date(F.col("birth_date"), F.col("visit_ts"), "k7:issue", "client_no"))
    c = c.withColumn("region", lookups.weighted_case(F.col("_region"), fixed.RU_REGIONS, fixed.RU_REGION_DEFAULT))
    ru = F.col("country") == "ru"
    unit = derive.ru_passport(F.col("region"), F.col("issue_date"), "k7:dept", "client_no")["dept_code"]
    c = c.select("client_no", "gender", "full_name", "country", "region", "issue_date", F.when(ru, unit).alias("dept_code"))
    c = materialize(c, "visits-client-draws")
    # K-6: no passport and no SNILS twice, by permutations of their code spaces
    series = F.concat(F.lpad(F.col("region").cast("string"), 2, "0"), F.date_format("issue_date", "yy"))
    prefixes = F.array(*[F.lit(x) for x in fixed.BY_PREFIXES])
    space = F.when(ru, F.lit(999_999)).when(F.col("country") == "by", F.lit(9_000_000 * len(fixed.BY_PREFIXES))).otherwise(F.lit(90_000_000))
    c = c.withColumn("_series", F.when(ru, series).otherwise(F.col("country")))
    c = draws.ranked_codes(c, "client_no", F.col("_series"), space, "k7:passport", "_place")
    place, digits = F.col("_place"), lambda x, n: F.lpad(x.cast("string"), n, "0")
    by = F.concat(F.element_at(prefixes, (F.call_function("div", place, F.lit(9_000_000)) + 1).cast("int")), (F.lit(1_000_000) + place % 9_000_000).cast("string"))
    kz = F.concat(F.lit(fixed.KZ_PREFIX), (F.lit(10_000_000) + place).cast("string"))
    c = c.withColumn("passport", F.when(ru, F.concat("_series", F.lit(" "), digits(place + 1, 6))).when(F.col("country") == "by", by).otherwise(kz))
    c = shuffled(c, 10 ** 9, {"_nine": F.col("client_no")}, "k7:snils")
    full = F.raise_error(F.lit("more clients than SNILS numbers")).cast("bigint")
    c = c.withColumn("_digits", digits(F.coalesce("_nine", full), 9))
    c = materialize(c.withColumn("snils", codecs.snils_format("_digits")).drop("_series", "_place", "_nine", "_digits"), "visits-client-codes")
    # K-1: one passport per name, first client wins; a later client with the same name
    # takes the first client's passport and SNILS (country from the passport format)
    first = c.groupBy("full_name").agg(F.min_by(F.struct("client_no", "passport", "snils"), "client_no").alias("_f"))
    c = c.join(first, "full_name")
    reused = F.col("_f.client_no") != F.col("client_no")
    return c.select(
        "client_no", "full_name", "gender", F.col("_f.passport").alias("passport"),
        F.when(reused, derive.infer_country(F.col("_f.passport"))).otherwise(F.col("country")).alias("passport_country"),
        F.when(~reused & ru, F.col("issue_date")).alias("passport_issue_date"),
        F.when(~reused, F.col("dept_code")).alias("dept_code"), F.col("_f.snils").alias("snils"),
    )


def _cards(v: DataFrame, d: Dictionaries, p: VisitParams) -> DataFrame:
    """(visit_id, card_id, use_no, card): the card pool, and one number per card, no
    number twice (K-6)."""
    uses = materialize(keyed.pool_reuse(v, "visit_id", "k7:card", p.p_reuse, p.card_cap), "visits-card-uses")
    cards = uses.where("new_card").select("card_id", "card_no")
    bank = lookups.weighted_case(F.col("_bank"), fixed.BANK_WEIGHTS, fixed.BANK_DEFAULT)
    system = lookups.weighted_case(F.col("_system"), fixed.SYSTEM_WEIGHTS, fixed.SYSTEM_DEFAULT)
    cards = cards.withColumns({"_bank": u("k7:bank", "card_id"), "_system": u("k7:system", "card_id")})
    cards = draws.pick_grouped(cards.withColumn("_grp", F.concat_ws("/", bank, system)), "_grp", d.bins, "grp", "bin", "k7:bin", ["card_id"], "bin")
    cards = shuffled(cards, 10 ** 9, {"_nine": F.col("card_no")}, "k7:card_digits")
    full = F.raise_error(F.lit("more cards than numbers")).cast("bigint")
    cards = cards.withColumn("_p15", F.concat("bin", F.lpad(F.coalesce("_nine", full).cast("string"), 9, "0")))
    numbers = cards.select("card_id", F.concat("_p15", codecs.luhn_check_digit(F.col("_p15")).cast("string")).alias("number"))
    return uses.join(numbers, "card_id", "left").select("visit_id", "card_id", "use_no", codecs.group4(F.col("number")).alias("card"))


def _price(name: Column) -> Column:
    """F-15 as an expression: the price list as a CASE ladder, else the keyword rule."""
    by_rule = derive.keyword_price(name, fixed.PRICE_KEYWORDS, fixed.PRICE_RANGES, fixed.PRICE_DEFAULT)
    exact = F.lit(None).cast("bigint")
    for item, price in fixed.ANALYSIS_PRICES:
        exact = F.when(name == item, F.lit(price).cast("bigint")).otherwise(exact)
    return F.coalesce(exact, by_rule)


def assemble_visits(spark: SparkSession, visits_src: DataFrame, order_col: str, part: DataFrame,
                    p: VisitParams | None = None) -> DataFrame:
    """The visit table: one row per source row (``order_col`` = visit number)."""
    p = p or VisitParams()
    d = Dictionaries(spark, part, p)
    rows = visits_src.select(F.col(order_col).alias("visit_id"))
    rows = keyed.repeat_assign(rows, "visit_id", "k7:client", p.p_repeat, p.pool_min)
    rows = rows.withColumn("visit_ts", timecols.work_slot("k7:visit", "visit_id", p.anchor, p.window_days))
    rows = materialize(rows, "visits-rows")
    clients = materialize(_clients(spark, rows.where("is_new"), d, p), "visits-clients")
    v = rows.join(clients, "client_no", "left")

    # doctor: by gender (p) or by symptoms of a doctor drawn at random (1 - p)
    v = v.withColumn("path_gender", u("k7:path", "visit_id") < F.lit(p.p_gender_path))
    v = draws.pick_grouped(v, "gender", d.allowed, "gender", "doctor", "k7:doc_g", ["visit_id"], "doc_g")
    v = draws.pick_uniform(v, d.doctors, "k7:doc_t", ["visit_id"], "doc_t")
    v = v.withColumn("symptom_doctor", F.when(F.col("path_gender"), F.col("doc_g")).otherwise(F.col("doc_t")))
    k_s = rand_int(p.symptoms[0], p.symptoms[1], "k7:k_symptoms", "visit_id")
    v = draws.fallback_lists(v, ["visit_id"], "symptom_doctor", d.own_symptoms.withColumnRenamed("doctor", "symptom_doctor"), d.symptoms,
                             "word", k_s, p.symptoms[1], "k7:symptoms", "symptom_list")
    v = materialize(v, "visits-symptom-draws")
    by_sym = v.where(~F.col("path_gender"))
    terms = by_sym.select("visit_id", F.explode("symptom_list").alias("term"))
    best = derive.best_specialists(terms, "visit_id", d.own_symptoms.withColumnRenamed("doctor", "spec"), "spec")
    chosen = derive.choose_specialist(by_sym.select("visit_id"), "visit_id", best, "spec", d.doctors.select(F.col("value").alias("spec")),
                                      p.default_specialist, "k7:doc_s", out_col="doc_s").drop("score")
    v = v.join(chosen, "visit_id", "left")
    v = v.withColumn("doctor", F.when(F.col("path_gender"), F.col("doc_g")).otherwise(F.col("doc_s")))
    v = derive.reassign(v, "gender", "doctor", d.allowed, d.swaps, "doctor_final").drop("doctor").withColumnRenamed("doctor_final", "doctor")

    # analyses of the doctor, their prices and the total
    k_a = rand_int(p.analyses[0], p.analyses[1], "k7:k_analyses", "visit_id")
    v = draws.fallback_lists(v, ["visit_id"], "doctor", d.own_analyses, d.general_analyses, "item", k_a, p.analyses[1], "k7:analyses", "analysis_list")
    cost = F.aggregate(F.transform("analysis_list", _price), F.lit(0).cast("bigint"), lambda a, x: a + x)
    v = v.withColumn("cost", cost).withColumn("_hours", rand_int(24, 72, "k7:result_hours", "visit_id"))
    v = v.withColumn("result_ts", timecols.result_snap(F.col("visit_ts"), F.col("_hours"))).drop("_hours")
    out = v.join(_cards(rows.select("visit_id"), d, p), "visit_id", "left")
    return out.select(
        "visit_id", F.col("client_no").alias("client_id"), "full_name", "gender", "passport", "passport_country",
        "passport_issue_date", "dept_code", "snils", F.array_join("symptom_list", ", ").alias("symptoms"), "doctor", "visit_ts",
        F.array_join("analysis_list", ", ").alias("analyses"), "result_ts", "cost", "card_id", F.col("use_no").alias("card_use"), "card", "is_new",
    )


def _ru_errors() -> Column:
    return quality.ru_passport_errors(F.col("passport"), F.col("passport_issue_date").cast("string"), F.col("dept_code"), F.col("visit_ts"))


def visit_rules(p: VisitParams | None = None, ru_errs: Column | None = None) -> list[quality.Rule]:
    """The row rules of the clinic table (V-1..V-6, V-9, V-12, V-14, V-16). ``ru_errs``: the
    faults of a Russian passport, if there is a column of them."""
    visit_iso, result_iso = timecols.iso_text("visit_ts"), timecols.iso_text("result_ts")
    ru = F.col("passport_country") == "ru"
    ru_errs = _ru_errors() if ru_errs is None else ru_errs
    return [
        quality.Rule("NAME_NOT_3_WORDS", quality.name3_broken("full_name")),
        quality.Rule("RU_PASSPORT", ru & (F.size(ru_errs) > 0)),
        quality.Rule("PASSPORT_FORMAT", ~ru & ~quality.passport_format_ok("passport", "passport_country")),
        quality.Rule("SNILS", quality.snils_scope_broken("passport_country", "snils")),
        quality.Rule("VISIT_ISO", ~quality.iso_ok(visit_iso)),
        quality.Rule("RESULT_ISO", ~quality.iso_ok(result_iso)),
        quality.Rule("CARD", ~quality.luhn_ok("card")),
        quality.Rule("COST_SUFFIX", ~quality.cost_suffix_ok(derive.cost_text(F.col("cost")))),
        quality.Rule("RESULT_NOT_AFTER", ~quality.after_ok("visit_ts", "result_ts")),
        quality.Rule("RESULT_GAP", quality.gap_broken("visit_ts", "result_ts")),
    ]


def visit_errors(visits: DataFrame) -> DataFrame:
    """Visits with their error codes (V-17 over ``visit_rules``) and, in passport_errors,
    every fault of a Russian passport; rows kept."""
    ru = F.col("passport_country") == "ru"
    out = quality.row_errors(visits.withColumn("_ru", F.when(ru, _ru_errors())), visit_rules(ru_errs=F.col("_ru")))
    detail = F.when(ru, F.array_join("_ru", ";")).otherwise("")
    return out.withColumn("errors", F.array_join("errors", ";")).withColumn("passport_errors", detail).drop("_ru")


def visits_from(spark: SparkSession, sf_dir: str, p: VisitParams | None = None) -> DataFrame:
    """The bound form: one visit per ``events`` row, dictionaries from ``part``."""
    return assemble_visits(spark, read(spark, sf_dir, "events"), "event_id", read(spark, sf_dir, "part"), p)


def text_projection(visits: DataFrame) -> DataFrame:
    """The record as text (ISO times with the offset, cost with its suffix)."""
    return visits.select(
        "visit_id", "full_name", "passport", "passport_country", "passport_issue_date", "dept_code",
        F.coalesce("snils", F.lit("")).alias("snils"), "symptoms", "doctor",
        timecols.iso_text("visit_ts").alias("visit_date"), "analyses",
        timecols.iso_text("result_ts").alias("analysis_date"),
        derive.cost_text(F.col("cost")).alias("analysis_cost"), F.col("card").alias("payment_card"))
