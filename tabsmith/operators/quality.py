"""Data-quality rules V-1..V-23.

A rule is a (code, Column) pair whose column is true when the row breaks the rule.
``row_errors`` evaluates a list of rules in one projection (no shuffle) and yields an
``errors`` array of codes plus ``valid``; rows are kept, routing is up to the caller.
Table-wide checks (uniqueness, dependencies, caps, gaps) are aggregations or keyed
row numbers, never per-row loops.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabsmith.functions import codecs, timecols
from tabsmith.operators.prefix import filler, keyed_row_number
from tabsmith.sources import fixed


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


@dataclass(frozen=True)
class Rule:
    code: str
    broken: Column          # true when the row breaks the rule (null counts as not broken)


def row_errors(df: DataFrame, rules: Sequence[Rule], errors_col: str = "errors", valid_col: str = "valid") -> DataFrame:
    """V-17: all rules in one pass -> errors array<string> (in rule order) and valid flag."""
    return df.withColumn(errors_col, _codes((r.broken, r.code) for r in rules)).withColumn(valid_col, F.size(errors_col) == 0)


def _codes(checks: Iterable[tuple[Column, str]]) -> Column:
    """The codes of the checks that are true, in order. A concatenation, as a filter over an
    array of all checks would have each of them interpreted and not compiled."""
    none = F.array().cast("array<string>")
    return F.concat(none, *[F.when(broken, F.array(F.lit(code))).otherwise(none) for broken, code in checks])


def error_summary(df: DataFrame, errors_col: str = "errors") -> DataFrame:
    """A-7: number of rows per error code."""
    return df.select(F.explode(errors_col).alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("n_rows"))


# ---- single-column rules ---------------------------------------------------------

def name3_broken(name) -> Column:
    """V-1: not exactly three words (empty counts as broken)."""
    n = _c(name)
    return n.isNull() | (F.trim(n) == "") | (F.size(F.split(F.trim(n), r"\s+")) != 3)


def ru_passport_errors(passport, issue, dept, visit) -> Column:
    """V-2: array of codes for a Russian passport. A bad number format stops the
    check; then department code format / region match, and for a present issue date:
    parse, not before 1997-10-01, series year = issue year mod 100, not after visit."""
    p, i, d = _c(passport), _c(issue), _c(dept)
    has_d = d.isNotNull() & (d != "")
    has_i = i.isNotNull() & (i != "")
    idt = F.try_to_date(i, "yyyy-MM-dd")
    vdt = F.to_date(_c(visit))
    series_region = (F.ascii(F.substring(p, 1, 1)) - 48) * 10 + (F.ascii(F.substring(p, 2, 1)) - 48)
    series_year = (F.ascii(F.substring(p, 3, 1)) - 48) * 10 + (F.ascii(F.substring(p, 4, 1)) - 48)
    dept_region = (F.ascii(F.substring(d, 1, 1)) - 48) * 100 + (F.ascii(F.substring(d, 2, 1)) - 48) * 10 \
        + (F.ascii(F.substring(d, 3, 1)) - 48)
    checks = [
        (has_d & ~d.rlike(fixed.DEPT_CODE_PATTERN), "DEPT_FORMAT"),
        (has_d & d.rlike(fixed.DEPT_CODE_PATTERN) & (series_region != dept_region), "REGION_MISMATCH"),
        (has_i & idt.isNull(), "ISSUE_UNPARSABLE"),
        (has_i & (idt < F.lit(fixed.RU_NEW_FORM_DATE).cast("date")), "ISSUE_BEFORE_NEW_FORM"),
        (has_i & idt.isNotNull() & (series_year != F.pmod(F.year(idt), F.lit(100))), "SERIES_YEAR"),
        (has_i & (idt > vdt), "ISSUE_AFTER_VISIT"),
    ]
    return F.when(~p.rlike(fixed.PASSPORT_PATTERNS[0][1]) | p.isNull(), F.array(F.lit("PASSPORT_FORMAT"))) \
        .otherwise(_codes(checks))


def passport_format_ok(passport, country) -> Column:
    """V-3: pattern by country; unknown country -> false."""
    p, c = _c(passport), _c(country)
    expr = None
    for ctry, pat in fixed.PASSPORT_PATTERNS:
        expr = F.when(c == ctry, p.rlike(pat)) if expr is None else expr.when(c == ctry, p.rlike(pat))
    return F.coalesce(expr.otherwise(F.lit(False)), F.lit(False))


def snils_ok(s) -> Column:
    """V-4."""
    return F.coalesce(codecs.snils_valid(s), F.lit(False))


def luhn_ok(card) -> Column:
    """V-5."""
    return F.coalesce(codecs.luhn_valid(card), F.lit(False))


ISO_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}[+-][0-9]{2}:[0-9]{2}$"


def iso_ok(text) -> Column:
    """V-6: pattern only, no calendar check."""
    return F.coalesce(_c(text).rlike(ISO_PATTERN), F.lit(False))


def working_hour_ok(ts, start: int = timecols.WORK_HOUR_START, end: int = timecols.WORK_HOUR_END) -> Column:
    """V-7: start <= hour < end."""
    h = F.hour(_c(ts))
    return (h >= start) & (h < end)


def working_day_ok(ts, days: Sequence[int] = timecols.WORK_DAYS) -> Column:
    """V-8: weekday (Monday = 0) in the working days."""
    return F.weekday(F.to_date(_c(ts))).isin(list(days))


def cost_suffix_ok(text, suffix: str = fixed.COST_SUFFIX) -> Column:
    """V-9."""
    return F.coalesce(_c(text).endswith(suffix), F.lit(False))


def cost_amount(text, suffix: str = fixed.COST_SUFFIX) -> Column:
    """V-10 amount: suffix removed, blanks removed, optional sign, digits only; else null.
    Null too when the number doesn't fit a bigint (``cost_overflow`` tells)."""
    return _cost_digits(text, suffix).try_cast("bigint")


def _cost_digits(text, suffix: str) -> Column:
    t = _c(text)
    stripped = F.regexp_replace(F.replace(t, F.lit(suffix), F.lit("")), " ", "")
    return F.when(t.endswith(suffix) & stripped.rlike(r"^[+-]?[0-9]+$"), stripped)


def cost_overflow(text, suffix: str = fixed.COST_SUFFIX) -> Column:
    """V-10: an amount of any length that is a number but no bigint."""
    digits = _cost_digits(text, suffix)
    return digits.isNotNull() & digits.try_cast("bigint").isNull()


def cost_ok(text, suffix: str = fixed.COST_SUFFIX) -> Column:
    """V-10 flag: parsable and > 0, whatever the number of digits."""
    return F.coalesce(_cost_digits(text, suffix).rlike(r"^\+?0*[1-9][0-9]*$"), F.lit(False))


def list_size_ok(n, lo: int = 1, hi: int = fixed.ANALYSES_MAX) -> Column:
    """V-11."""
    return _c(n).between(lo, hi)


def snils_scope_broken(country, snils) -> Column:
    """V-12: SNILS is checked only for ru and only when not empty."""
    s = _c(snils)
    return (_c(country) == "ru") & s.isNotNull() & (s != "") & ~snils_ok(s)


def member(df: DataFrame, col: str, dictionary: DataFrame, dict_col: str, out_col: str = "is_member") -> DataFrame:
    """V-13: membership flag via a left join on the distinct dictionary values."""
    dd = dictionary.select(F.col(dict_col).alias("_m")).distinct().withColumn("_hit", F.lit(True))
    j = df.join(dd, df[col] == dd["_m"], "left")
    return j.withColumn(out_col, F.coalesce(F.col("_hit"), F.lit(False))).drop("_m", "_hit")


def after_ok(visit, result) -> Column:
    """V-14: result strictly after the visit."""
    return _c(result) > _c(visit)


def parse_broken(text, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """V-15: text that does not parse as a timestamp is an error, not a crash."""
    return _c(text).isNotNull() & F.try_to_timestamp(_c(text), F.lit(fmt)).isNull()


def gap_hours(visit, result) -> Column:
    """A-10: gap in hours as double."""
    return timecols.hours_between(visit, result)


def gap_broken(visit, result, lo: float = timecols.RESULT_MIN_HOURS, hi: float = timecols.GAP_MAX_HOURS) -> Column:
    """V-16: lo <= gap <= hi."""
    g = gap_hours(visit, result)
    return (g < lo) | (g > hi)


def gap_message(visit, result, lo: float = timecols.RESULT_MIN_HOURS, hi: float = timecols.GAP_MAX_HOURS) -> Column:
    """The message of V-16: empty when the rule holds, else the bounds and the gap with one
    decimal (tenths rounded half up from whole microseconds)."""
    g = gap_hours(visit, result)
    tenths = F.floor(F.abs(g) * 10 + 0.5).cast("bigint")
    one = F.concat(F.when(g < 0, "-").otherwise(""), F.call_function("div", tenths, F.lit(10)).cast("string"), F.lit("."), (tenths % 10).cast("string"))
    text = F.concat(F.lit(f"results are due after {lo:g} to {hi:g} hours, got "), one)
    return F.when(gap_broken(visit, result, lo, hi), text).otherwise("")


def sql_gap_message(g: str, lo: float = timecols.RESULT_MIN_HOURS, hi: float = timecols.GAP_MAX_HOURS) -> str:
    """``g``: a column with the gap in hours."""
    tenths = f"CAST(floor(abs({g}) * 10 + 0.5) AS BIGINT)"
    return (f"(CASE WHEN {g} < {lo} OR {g} > {hi} THEN 'results are due after {lo:g} to {hi:g} hours, got ' || "
            f"CASE WHEN {g} < 0 THEN '-' ELSE '' END || ({tenths} // 10) || '.' || ({tenths} % 10) ELSE '' END)")


# ---- table-wide checks -------------------------------------------------------------

def cap_violations(used: DataFrame, cap: int = fixed.CARD_REUSE_LIMIT, use_col: str = "use_no") -> DataFrame:
    """V-18: uses beyond the cap."""
    return used.where(F.col(use_col) > cap)


def fd_violations(df: DataFrame, key_col: str, dep_col: str) -> DataFrame:
    """V-19: keys mapped to more than one value (should be a functional dependency)."""
    return df.groupBy(key_col).agg(F.count_distinct(dep_col).alias("n_values")).where(F.col("n_values") > 1)


def unique_violations(df: DataFrame, value_col: str, owner_col: str) -> DataFrame:
    """V-20: values held by more than one owner."""
    return df.groupBy(value_col).agg(F.count_distinct(owner_col).alias("n_owners")).where(F.col("n_owners") > 1)


def revisit_gaps(visits: DataFrame, client_col: str, visit_col: str, result_col: str, id_col: str,
                 block: Column, min_hours: float = timecols.RESULT_MIN_HOURS) -> DataFrame:
    """V-22: each visit against the previous visit's result of the same client.

    ``lag`` without a whole-client window: visits are numbered per (client, block)
    with offsets, then joined to their predecessor on (client, n - 1), which hash
    partitions on the number too, so a very active client is spread over tasks. Visits
    without a client are one client's, as in the numbering and in ``lag``."""
    n = keyed_row_number(visits, [client_col], [visit_col, id_col], block, "_n")
    n = n.withColumns({"_c0": F.col(client_col).isNull(), "_c1": F.coalesce(F.col(client_col), filler(visits.schema[client_col].dataType))})
    prev = n.select("_c0", "_c1", (F.col("_n") + 1).alias("_n"), F.col(result_col).alias("prev_result"))
    j = n.join(prev, ["_c0", "_c1", "_n"], "left").select(*visits.columns, "_n", "prev_result")
    gap = timecols.hours_between(F.col("prev_result"), F.col(visit_col))
    return j.withColumn("gap_hours", gap).withColumn(
        "too_soon", F.coalesce(F.col("gap_hours") < F.lit(float(min_hours)), F.lit(False))).drop("_n")
