"""Derived columns F-1..F-20.

Per-row derivations are column expressions (no shuffle). Table-level ones use joins:
exact prices through a broadcast lookup, per-visit totals through a partial
aggregation, and the specialist score through a substring index of the *distinct* term
vocabulary and the dictionary, so the substring test is an equi-join that runs once per
distinct term, not once per row.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tabsmith.functions import codecs
from tabsmith.functions.draws import pick_index, rand_int, u
from tabsmith.operators.joins import checked_broadcast
from tabsmith.session import materialize
from tabsmith.sources import fixed


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---- F-1, F-2 names --------------------------------------------------------------

def suffix_rewrite(word, rules: Sequence[tuple[str, int, str]]) -> Column:
    """F-1: first rule whose suffix ends the word: strip n characters, append text.
    A rule with (0, '') keeps the word and stops the scan."""
    w = _c(word)
    expr = None
    for suffix, strip, add in rules:
        base = w if strip == 0 else _strip(w, strip)
        new = F.concat(base, F.lit(add))
        cond = w.endswith(suffix)
        expr = F.when(cond, new) if expr is None else expr.when(cond, new)
    return expr.otherwise(w) if expr is not None else w


def _strip(w: Column, n: int) -> Column:
    return F.left(w, F.length(w) - n)


def sql_suffix_rewrite(word: str, rules: Sequence[tuple[str, int, str]]) -> str:
    parts = []
    for suffix, strip, add in rules:
        base = word if strip == 0 else f"left({word}, length({word}) - {strip})"
        parts.append(f"WHEN suffix({word}, '{suffix}') THEN {base} || '{add}'")
    return f"(CASE {' '.join(parts)} ELSE {word} END)"


def gendered_surname(surname, gender, rules=fixed.FEMALE_SURNAME_RULES) -> Column:
    return F.when(_c(gender) == "F", suffix_rewrite(surname, rules)).otherwise(_c(surname))


def full_name(surname, name, patronymic) -> Column:
    """F-2: three words joined by a blank."""
    return F.concat_ws(" ", _c(surname), _c(name), _c(patronymic))


# ---- F-3 .. F-5 numbers with check digits -------------------------------------------

def digits(n_digits: int, stream: str, *keys) -> Column:
    """n random decimal digits as text (leading zeros kept)."""
    return F.lpad(pick_index(10 ** n_digits, stream, *keys).cast("string"), n_digits, "0")


def snils_for(stream: str, *keys) -> Column:
    """F-3: 9 random digits + control number, ``XXX-XXX-XXX YY``."""
    return codecs.snils_format(digits(9, stream, *keys))


def card_number(bin_col, stream: str, *keys) -> Column:
    """F-4: BIN (6) + 9 random digits + Luhn check digit (16 digits, no blanks)."""
    p15 = F.concat(_c(bin_col), digits(9, stream, *keys))
    return F.concat(p15, codecs.luhn_check_digit(p15).cast("string"))


# ---- F-6 .. F-9 passports and dates ------------------------------------------------

def ru_passport(region, issue_date, stream: str, *keys) -> dict[str, Column]:
    """F-6: series = region(2) + issue year(2), number(6) in 1..999999,
    department code = region(3) '-' unit(3) with unit in 1..999."""
    reg = _c(region).cast("string")
    series = F.concat(F.lpad(reg, 2, "0"), F.date_format(_c(issue_date), "yy"))
    number = F.lpad(rand_int(1, 999999, stream + ":number", *keys).cast("string"), 6, "0")
    dept = F.concat(F.lpad(reg, 3, "0"), F.lit("-"),
                    F.lpad(rand_int(1, 999, stream + ":unit", *keys).cast("string"), 3, "0"))
    return {"passport": F.concat(series, F.lit(" "), number), "dept_code": dept}


def foreign_passport(country, stream: str, *keys) -> Column:
    """F-7: by = prefix + 7 digits (1000000..9999999); kz = N + 8 digits
    (10000000..99999999); anything else except ru is an error."""
    pre = F.element_at(F.array(*[F.lit(p) for p in fixed.BY_PREFIXES]),
                       (pick_index(len(fixed.BY_PREFIXES), stream + ":prefix", *keys) + 1).cast("int"))
    by = F.concat(pre, rand_int(1000000, 9999999, stream + ":by", *keys).cast("string"))
    kz = F.concat(F.lit(fixed.KZ_PREFIX), rand_int(10000000, 99999999, stream + ":kz", *keys).cast("string"))
    c = _c(country)
    return (F.when(c == "by", by).when(c == "kz", kz).when(c == "ru", F.lit(None).cast("string"))
            .otherwise(F.raise_error(F.concat(F.lit("unsupported country: "), c))))


def birth_date(visit, age, stream: str, *keys) -> Column:
    """F-8: visit year - age, month 1..12, day 1..28."""
    return F.make_date(
        (F.year(_c(visit)) - _c(age)).cast("int"),
        rand_int(1, 12, stream + ":month", *keys).cast("int"),
        rand_int(1, 28, stream + ":day", *keys).cast("int"),
    )


def issue_date(birth, visit, stream: str, *keys) -> Column:
    """F-9: passport issue date inside the window for the age at the visit.

    first passport at 14 and not before 1997-10-01; under 20 the window ends at 20;
    20..44 it runs from 20 to 45; from 45 it starts at 45. The end is at most
    visit - 30 days. An empty window gives max(start, visit - 365 days); otherwise a
    uniform day inside it."""
    b, v = _c(birth), F.to_date(_c(visit))
    before_bday = (F.month(v) < F.month(b)) | ((F.month(v) == F.month(b)) & (F.dayofmonth(v) < F.dayofmonth(b)))
    age = F.year(v) - F.year(b) - F.when(before_bday, 1).otherwise(0)
    b14, b20, b45 = F.add_months(b, 14 * 12), F.add_months(b, 20 * 12), F.add_months(b, 45 * 12)
    start0 = F.greatest(b14, F.lit(fixed.RU_NEW_FORM_DATE).cast("date"))
    start = F.when(age < 20, start0).when(age < 45, F.greatest(start0, b20)).otherwise(F.greatest(start0, b45))
    end = F.when(age < 20, F.least(v, b20)).when(age < 45, F.least(v, b45)).otherwise(v)
    end = F.least(end, F.date_sub(v, 30))
    span = F.datediff(end, start)
    pick = F.date_add(start, rand_int(F.lit(0), span, stream, *keys).cast("int"))
    return F.when(span <= 0, F.greatest(start, F.date_sub(v, 365))).otherwise(pick)


def infer_country(passport) -> Column:
    """F-14: first matching format ru / by / kz, default ru."""
    p = _c(passport)
    expr = None
    for country, pat in fixed.PASSPORT_PATTERNS:
        expr = F.when(p.rlike(pat), F.lit(country)) if expr is None else expr.when(p.rlike(pat), F.lit(country))
    return expr.otherwise(F.lit(fixed.COUNTRY_DEFAULT))


# ---- F-13 reassignment ------------------------------------------------------------

def reassign(df: DataFrame, group_col: str, value_col: str, allowed: DataFrame, swaps: DataFrame,
             out_col: str) -> DataFrame:
    """F-13: a value not in the group's allow-list is swapped when a rule exists for
    (group, value); unlisted values stay. ``allowed``: (group, value);
    ``swaps``: (group, value, new_value). Both are small lookups."""
    al = allowed.select(F.col(group_col).alias("_ag"), F.col(value_col).alias("_av")).distinct() \
        .withColumn("_ok", F.lit(True))
    sw = swaps.select(F.col(group_col).alias("_sg"), F.col(value_col).alias("_sv"), F.col("new_value").alias("_nv"))
    j = df.join(al, (df[group_col] == al["_ag"]) & (df[value_col] == al["_av"]), "left")
    j = j.join(checked_broadcast(sw), (j[group_col] == sw["_sg"]) & (j[value_col] == sw["_sv"]), "left")
    out = F.when(F.col("_ok").isNull() & F.col("_nv").isNotNull(), F.col("_nv")).otherwise(F.col(value_col))
    return j.withColumn(out_col, out).drop("_ag", "_av", "_ok", "_sg", "_sv", "_nv")


# ---- F-15 .. F-19 prices and text --------------------------------------------------

def keyword_price(name, keyword_classes, ranges, default: int) -> Column:
    """Keyword part of F-15: first class with a keyword inside the lower-cased name
    gives (lo + hi) div 2 of its range, else ``default``."""
    low = F.lower(_c(name))
    expr = None
    for kws, cls in keyword_classes:
        lo, hi = ranges[cls]
        cond = None
        for kw in kws:
            cond = low.contains(kw) if cond is None else (cond | low.contains(kw))
        price = F.lit((lo + hi) // 2)
        expr = F.when(cond, price) if expr is None else expr.when(cond, price)
    return (expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)).cast("bigint")


def sql_keyword_price(name: str, keyword_classes, ranges, default: int) -> str:
    parts = []
    for kws, cls in keyword_classes:
        lo, hi = ranges[cls]
        cond = " OR ".join(f"contains(lower({name}), '{kw}')" for kw in kws)
        parts.append(f"WHEN {cond} THEN {(lo + hi) // 2}")
    return f"CAST(CASE {' '.join(parts)} ELSE {default} END AS BIGINT)"


def price_rule(df: DataFrame, name_col: str, exact: DataFrame, keyword_classes, ranges, default: int,
               out_col: str = "price") -> DataFrame:
    """F-15: exact price by name (broadcast lookup of a price list), else keyword rule."""
    ex = checked_broadcast(exact.select(F.col("name").alias("_xn"), F.col("price").cast("bigint").alias("_xp")))
    j = df.join(ex, df[name_col] == ex["_xn"], "left")
    return j.withColumn(out_col, F.coalesce(F.col("_xp"), keyword_price(F.col(name_col), keyword_classes, ranges, default))) \
        .drop("_xn", "_xp")


def price_sum(lines: DataFrame, visit_col: str, price_col: str, out_col: str = "cost") -> DataFrame:
    """F-16: total per visit (partial aggregation before the shuffle)."""
    return lines.groupBy(visit_col).agg(F.sum(price_col).cast("bigint").alias(out_col))


def list_text(lines: DataFrame, key_cols: Sequence[str], order_cols: Sequence[str], value_col: str,
              out_col: str, sep: str = ", ") -> DataFrame:
    """F-17: a visit's items as one text, in item order. Meant for bounded lists
    (V-11 caps them at a handful of items)."""
    st = F.struct(*[F.col(c) for c in order_cols], F.col(value_col).cast("string").alias("_v"))
    agg = lines.groupBy(*key_cols).agg(F.array_sort(F.collect_list(st)).alias("_l"))
    return agg.select(*key_cols, F.array_join(F.transform("_l", lambda x: x["_v"]), sep).alias(out_col))


def cost_text(cost, suffix: str = fixed.COST_SUFFIX) -> Column:
    """F-18: ``"{n} руб."``."""
    return F.concat(_c(cost).cast("string"), F.lit(suffix))


def null_default(col, default) -> Column:
    """F-19: missing -> default."""
    return F.coalesce(_c(col), F.lit(default))


# ---- F-20 specialist by matching terms ----------------------------------------------

TERM_SPLIT = r"[^\p{L}\p{N}]+"
PIECE = 256             # characters of a text whose substrings one row holds
SCORE_CELLS = 1 << 20   # sets x specialists added up at a time


def row_terms(df: DataFrame, key: str, text_col: str, out_col: str = "term") -> DataFrame:
    """Distinct lower-cased terms of a whole text, one row per (key, term)."""
    arr = F.array_distinct(F.split(F.lower(F.col(text_col)), TERM_SPLIT))
    return df.select(key, F.explode(arr).alias(out_col)).where(F.length(out_col) > 0)


def contained(needles: DataFrame, needle_col: str, haystack: DataFrame, hay_col: str) -> DataFrame:
    """(needle, hay) pairs where the needle occurs in the hay: an equi-join of the needles
    with the substrings of the hays that have a needle's length. Both frames have distinct
    values; nothing is compared pair by pair.

    A hay is cut into overlapping pieces, so a row's array of substrings is bounded by
    PIECE x the number of lengths; pieces carry the hay's number, not its text."""
    hays = materialize(haystack.select(F.col(hay_col).alias("hay")).where(F.length(hay_col) > 0).withColumn("_id", F.monotonically_increasing_id()), "hays")
    longest = hays.agg(F.max(F.length("hay"))).first()[0] or 0
    size = F.length(needle_col)
    lengths = sorted(r[0] for r in needles.where((size > 0) & (size <= longest)).select(size).distinct().collect())
    if not lengths:
        return hays.select(F.col("hay").alias("needle"), "hay").limit(0)
    pieces = hays.withColumn("_at", F.explode(F.expr(f"sequence(0, (length(hay) - 1) div {PIECE})"))).select(
        "_id", F.expr(f"substring(hay, _at * {PIECE} + 1, {PIECE + lengths[-1] - 1})").alias("_p"))
    inside = F.expr(f"""array_distinct(flatten(transform(filter(array({', '.join(map(str, lengths))}), n -> n <= length(_p)),
        n -> transform(sequence(1, least({PIECE}, length(_p) - n + 1)), s -> substring(_p, s, n)))))""")
    found = pieces.select("_id", F.explode(inside).alias("needle")).join(needles.select(F.col(needle_col).alias("needle")), "needle").distinct()
    return found.join(hays, "_id").select("needle", "hay")


def term_matches(terms: DataFrame, words: DataFrame, term_col: str = "term", word_col: str = "word") -> DataFrame:
    """(term, word) pairs where either contains the other, by the substrings of each side
    (``contained``): work follows the two vocabularies, not their product. Empty terms and
    words match nothing."""
    voc, wd = materialize(terms.select(term_col).distinct(), "terms"), materialize(words.select(word_col).distinct(), "words")
    in_term = contained(wd, word_col, voc, term_col).select(F.col("hay").alias(term_col), F.col("needle").alias(word_col))
    in_word = contained(voc, term_col, wd, word_col).select(F.col("needle").alias(term_col), F.col("hay").alias(word_col))
    return in_term.union(in_word).distinct()


def _score_lists(row_terms_df: DataFrame, key: str, spec_words: DataFrame, spec_col: str, word_col: str, term_col: str,
                 best: bool) -> DataFrame:
    """(key, specialists, their scores) as two lists, one row per key with a match; with
    ``best`` only the specialists of the highest score. Specialists are in order.

    A term stands for the set of specialists it matches; a key's terms are counted by set,
    and the counts of a key's sets are added up inside its row, so a row per (key,
    specialist) is neither shuffled nor sorted. The distinct sets and the specialists are
    bounded by the dictionary."""
    sw = spec_words.select(spec_col, F.lower(F.col(word_col)).alias(word_col)).distinct()
    matched = term_matches(row_terms_df, sw, term_col, word_col)           # (term, word)
    term_specs = materialize(matched.join(checked_broadcast(sw), word_col).groupBy(term_col).agg(
        F.array_sort(F.collect_set(spec_col)).alias("_specs")).where(F.size("_specs") > 0), "term-specialists")
    sets = materialize(term_specs.select("_specs").distinct().withColumn("_set", F.monotonically_increasing_id()), "specialist-sets")
    term_sets = term_specs.join(checked_broadcast(sets), "_specs").select(term_col, "_set")
    counts = row_terms_df.join(checked_broadcast(term_sets), term_col).groupBy(key, "_set").agg(F.count(F.lit(1)).alias("_n"))
    lists = counts.groupBy(key).agg(F.collect_list(F.struct("_set", "_n")).alias("_l")).select(key, "_l._set", "_l._n")

    known = sorted((r["_set"], r["_specs"]) for r in sets.collect())
    ids = np.array([i for i, _ in known], np.int64)
    names = sorted({x for _, specs in known for x in specs})
    place = {x: i for i, x in enumerate(names)}
    member = np.zeros((len(known), len(names)), bool)
    for i, (_, specs) in enumerate(known):
        member[i, [place[x] for x in specs]] = True
    kind = sw.schema[spec_col].dataType
    held = pa.array(names, to_arrow_type(kind))

    def rows(batches):
        for b in batches:
            offs = np.asarray(b.column(1).offsets).astype(np.int64)         # the two lists have equal lengths
            at = 0
            while at < b.num_rows:          # so many rows that their sets x specialists stay small
                end = max(at + 1, int(np.searchsorted(offs, offs[at] + SCORE_CELLS // max(1, len(names)), "right")) - 1)
                of = np.searchsorted(ids, np.asarray(b.column(1).values)[offs[at]:offs[end]])
                n = np.asarray(b.column(2).values)[offs[at]:offs[end]]
                score = np.add.reduceat(member[of] * n[:, None], offs[at:end] - offs[at], axis=0)
                row, spec = np.nonzero((score == score.max(1, keepdims=True)) if best else (score > 0))
                cuts = pa.array(np.searchsorted(row, np.arange(end - at + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, end - at), pa.ListArray.from_arrays(cuts, held.take(pa.array(spec))),
                     pa.ListArray.from_arrays(cuts, pa.array(score[row, spec]))], names=[key, spec_col, "score"])
                at = end

    fields = [T.StructField(key, lists.schema[key].dataType), T.StructField(spec_col, T.ArrayType(kind)), T.StructField("score", T.ArrayType(T.LongType()))]
    return lists.mapInArrow(rows, T.StructType(fields))


def specialist_scores(row_terms_df: DataFrame, key: str, spec_words: DataFrame, spec_col: str,
                      word_col: str = "word", term_col: str = "term") -> DataFrame:
    """(key, specialist, score): score = number of the row's distinct terms that match
    at least one word of the specialist (substring either way)."""
    lists = _score_lists(row_terms_df, key, spec_words, spec_col, word_col, term_col, best=False)
    return lists.select(key, F.explode(F.arrays_zip(spec_col, "score")).alias("_s")).select(key, f"_s.{spec_col}", "_s.score")


def best_specialists(row_terms_df: DataFrame, key: str, spec_words: DataFrame, spec_col: str,
                     word_col: str = "word", term_col: str = "term") -> DataFrame:
    """(key, specialists, score): the highest of ``specialist_scores`` of each key and the
    sorted list of all who have it."""
    lists = _score_lists(row_terms_df, key, spec_words, spec_col, word_col, term_col, best=True)
    return lists.select(key, spec_col, F.get("score", F.lit(0)).alias("score"))


def choose_specialist(rows: DataFrame, key: str, best: DataFrame, spec_col: str, all_specs: DataFrame,
                      default: str, stream: str, out_col: str = "specialist",
                      p_one: float = fixed.SPECIALIST_ONE_MATCH_PROBABILITY,
                      p_default: float = fixed.DEFAULT_ON_NO_MATCH_PROBABILITY) -> DataFrame:
    """F-20 decision over ``best_specialists``: best score >= 2 -> a best holder at random;
    = 1 -> a best holder with p_one, else the default; 0 -> the default with p_default,
    else any specialist."""
    at = F.floor(u(stream + ":best", key) * F.size(spec_col)).cast("int")
    chosen = best.select(key, F.get(spec_col, at).alias("_best"), "score")
    specs = all_specs.select(F.col(spec_col).alias("_any")).distinct()
    n_specs = specs.agg(F.count(F.lit(1))).scalar()
    wa = Window.orderBy("_any")
    specs = specs.withColumn("_ai", (F.row_number().over(wa) - 1).cast("bigint"))
    d = rows.select(key).join(chosen, key, "left").withColumn("score", F.coalesce("score", F.lit(0)).cast("bigint"))
    d = d.withColumn("_ai", F.floor(u(stream + ":any", key) * n_specs).cast("bigint"))
    d = d.join(checked_broadcast(specs), "_ai", "left")
    choice = (
        F.when(F.col("score") >= 2, F.col("_best"))
        .when(F.col("score") == 1, F.when(u(stream + ":one", key) < F.lit(p_one), F.col("_best")).otherwise(F.lit(default)))
        .otherwise(F.when(u(stream + ":none", key) < F.lit(p_default), F.lit(default)).otherwise(F.col("_any")))
    )
    return d.select(key, choice.alias(out_col), "score")
