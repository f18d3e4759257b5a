"""Check-digit codecs as column expressions (SNILS-style mod-101 and Luhn).

Digits are read with ``ascii(ch) - 48`` so a malformed value never raises under ANSI
mode; callers gate the arithmetic behind a format check. Sums are unrolled into plain
arithmetic so the whole expression stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def digit(s, pos: int) -> Column:
    """Digit at 1-based position ``pos`` of a string column."""
    return F.ascii(F.substring(_c(s), pos, 1)) - 48


def sql_digit(s: str, pos: int) -> str:
    return f"(ascii(substr({s}, {pos}, 1)) - 48)"


# ---- mod-101 personal-number control (9 digits + 2 control digits) ------------------

def snils_sum(d9) -> Column:
    return sum((digit(d9, i + 1) * (9 - i) for i in range(9)), F.lit(0))


def snils_control(d9) -> Column:
    """Control number of 9 digits: weighted sum s = sum d_i * (9 - i);
    s < 100 -> s; s in (100, 101) -> 0; else s mod 101 with 100 -> 0."""
    return _control_of(snils_sum(d9))


def _control_of(s: Column) -> Column:
    """The rule in one formula, which holds each digit once or twice: the remainders of 101
    are 0 to 100, and 100 stands for 0."""
    return F.when(s < 0, s).otherwise(F.pmod(F.pmod(s, F.lit(101)), F.lit(100))).cast("int")


def snils_format(d9) -> Column:
    d = _c(d9)
    return F.concat(
        F.substring(d, 1, 3), F.lit("-"), F.substring(d, 4, 3), F.lit("-"), F.substring(d, 7, 3),
        F.lit(" "), F.lpad(snils_control(d).cast("string"), 2, "0"),
    )


SNILS_PATTERN = r"^[0-9]{3}-[0-9]{3}-[0-9]{3} [0-9]{2}$"


def snils_valid(s) -> Column:
    """Format ``XXX-XXX-XXX YY`` and matching control number."""
    x = _c(s)
    s = sum((digit(x, at) * (9 - i) for i, at in enumerate((1, 2, 3, 5, 6, 7, 9, 10, 11))), F.lit(0))
    given = digit(x, 13) * 10 + digit(x, 14)
    return F.when(x.rlike(SNILS_PATTERN), _control_of(s) == given).otherwise(F.lit(False))


def sql_snils_control(d9: str) -> str:
    s = " + ".join(f"{sql_digit(d9, i + 1)} * {9 - i}" for i in range(9))
    s = f"({s})"
    return (
        f"CAST(CASE WHEN {s} < 100 THEN {s} WHEN {s} IN (100, 101) THEN 0 "
        f"WHEN {s} % 101 = 100 THEN 0 ELSE {s} % 101 END AS INTEGER)"
    )


def sql_snils_format(d9: str) -> str:
    return (
        f"(substr({d9}, 1, 3) || '-' || substr({d9}, 4, 3) || '-' || substr({d9}, 7, 3) || ' ' || "
        f"lpad(CAST({sql_snils_control(d9)} AS VARCHAR), 2, '0'))"
    )


def sql_snils_valid(s: str) -> str:
    d9 = f"(substr({s}, 1, 3) || substr({s}, 5, 3) || substr({s}, 9, 3))"
    given = f"({sql_digit(s, 13)} * 10 + {sql_digit(s, 14)})"
    return (
        f"(CASE WHEN regexp_full_match({s}, '{SNILS_PATTERN[1:-1]}') "
        f"THEN {sql_snils_control(d9)} = {given} ELSE false END)"
    )


# ---- Luhn ------------------------------------------------------------------------

def _luhn_term(d: Column, doubled: bool) -> Column:
    if not doubled:
        return d
    return F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)


def luhn_check_digit(p15) -> Column:
    """Check digit for a 15-digit prefix, closed form (10 - s mod 10) mod 10.
    In the full 16-digit number the prefix digit at 0-based index j sits at position
    15 - j from the right, so it is doubled when j is even."""
    s = sum((_luhn_term(digit(p15, j + 1), j % 2 == 0) for j in range(15)), F.lit(0))
    return F.pmod(10 - F.pmod(s, F.lit(10)), F.lit(10)).cast("int")


def luhn_valid(card) -> Column:
    """16 digits once blanks are removed, Luhn sum divisible by 10."""
    x = F.regexp_replace(_c(card), " ", "")
    return F.when(x.rlike(r"^[0-9]{16}$"), F.call_function("luhn_check", x)).otherwise(F.lit(False))


def group4(d16) -> Column:
    d = _c(d16)
    return F.concat_ws(" ", *[F.substring(d, 1 + 4 * k, 4) for k in range(4)])


def _sql_luhn_term(d: str, doubled: bool) -> str:
    if not doubled:
        return d
    return f"(CASE WHEN {d} * 2 > 9 THEN {d} * 2 - 9 ELSE {d} * 2 END)"


def sql_luhn_check_digit(p15: str) -> str:
    s = " + ".join(_sql_luhn_term(sql_digit(p15, j + 1), j % 2 == 0) for j in range(15))
    return f"CAST((10 - ({s}) % 10) % 10 AS INTEGER)"


def sql_luhn_valid(card: str) -> str:
    x = f"replace({card}, ' ', '')"
    s = " + ".join(_sql_luhn_term(sql_digit(x, j + 1), j % 2 == 0) for j in range(16))
    return f"(CASE WHEN regexp_full_match({x}, '[0-9]{{16}}') THEN ({s}) % 10 = 0 ELSE false END)"


def sql_group4(d16: str) -> str:
    return " || ' ' || ".join(f"substr({d16}, {1 + 4 * k}, 4)" for k in range(4))
