"""Binding parameters shared by several queries: rules and names for tables that hold no
clinic words of their own."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabsmith.sources import fixed

# suffix rules for English part words (suffix, strip, append)
ENGLISH_RULES = (("get", 3, "gette"), ("et", 0, ""), ("od", 0, "s"), ("t", 1, "te"), ("ng", 2, "nga"))

# analyses for the price rule: a listed name as it is, or a kind followed by a part name
ANALYSIS_KINDS = ("анализ крови", "кровь из вены", "анализ мочи", "моча утренняя", "мазок", "рентген", "узи", "мрт", "томография", "кт", "проба")

# surnames are a stem and an ending
SURNAME_STEMS = ("Лебед", "Волк", "Орл", "Камен", "Верес", "Дубр", "Полев")
SURNAME_ENDINGS = ("ов", "ев", "ин", "ский", "ук", "юк", "ко")


def _nth(items, i: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in items]), (i + 1).cast("int"))


def sql_nth(items, i: str) -> str:
    listed = ", ".join(f"'{x}'" for x in items)
    return f"[{listed}][{i} + 1]"


def analysis_name(key: Column, part_name: Column) -> Column:
    """The analysis of a part, by arithmetic on its key."""
    names = [n for n, _ in fixed.ANALYSIS_PRICES]
    i = F.pmod(key, F.lit(len(names) + 2 * len(ANALYSIS_KINDS)))
    kind = F.concat(_nth(ANALYSIS_KINDS, F.pmod(i, F.lit(len(ANALYSIS_KINDS)))), F.lit(" "), part_name)
    return F.when(i < len(names), _nth(names, F.least(i, F.lit(len(names) - 1)))).otherwise(kind)


def sql_analysis_name(key: str, part_name: str) -> str:
    names = [n for n, _ in fixed.ANALYSIS_PRICES]
    i = f"({key} % {len(names) + 2 * len(ANALYSIS_KINDS)})"
    return (f"(CASE WHEN {i} < {len(names)} THEN {sql_nth(names, i)} "
            f"ELSE {sql_nth(ANALYSIS_KINDS, f'{i} % {len(ANALYSIS_KINDS)}')} || ' ' || {part_name} END)")


def surname(key: Column) -> Column:
    n = len(SURNAME_STEMS)
    return F.concat(_nth(SURNAME_STEMS, F.pmod(key, F.lit(n))), _nth(SURNAME_ENDINGS, F.pmod(F.floor(key / n), F.lit(len(SURNAME_ENDINGS)))))


def sql_surname(key: str) -> str:
    n = len(SURNAME_STEMS)
    return f"({sql_nth(SURNAME_STEMS, f'{key} % {n}')} || {sql_nth(SURNAME_ENDINGS, f'({key} // {n}) % {len(SURNAME_ENDINGS)}')})"
