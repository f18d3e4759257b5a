"""Working-time arithmetic on TIMESTAMP_NTZ columns.

Times are naive wall-clock values (the offset is only appended as text, see
``iso_text``). All calendar math is done on integer microseconds since
1970-01-01 00:00, which is exact, time-zone free and stays inside codegen.
1970-01-01 was a Thursday, so ``weekday = (day + 3) mod 7`` with Monday = 0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabsmith.functions.draws import rand_int, sql_rand_int

# fixed values: clinic working time and result window
WORK_HOUR_START = 9          # first working hour (09:00)
WORK_HOUR_END = 18           # end of the working day (18:00, exclusive)
WORK_DAYS = (0, 1, 2, 3, 4)  # Monday..Friday, Monday = 0
RESULT_MIN_HOURS = 24
RESULT_MAX_HOURS = 72
GAP_MAX_HOURS = 168          # upper bound used by the gap check
TZ_TEXT = "+03:00"           # appended as text, never converted
MINUTE_STEP = 15             # visit minutes are 0, 15, 30, 45

US_MIN = 60_000_000
US_HOUR = 3_600_000_000
US_DAY = 86_400_000_000
_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def micros(ts) -> Column:
    """Microseconds since 1970-01-01 00:00 of a TIMESTAMP_NTZ column."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), _c(ts))


def from_micros(us) -> Column:
    return F.timestamp_add("MICROSECOND", _c(us), F.expr(_EPOCH))


def day_of(us) -> Column:
    return F.floor(_c(us) / F.lit(US_DAY)).cast("bigint")


def weekday_of_day(day) -> Column:
    return F.pmod(_c(day) + 3, F.lit(7))


def epoch_day(d) -> Column:
    """Days since 1970-01-01 of a DATE column."""
    return F.datediff(_c(d), F.lit("1970-01-01").cast("date")).cast("bigint")


def day_to_date(day) -> Column:
    return F.date_add(F.lit("1970-01-01").cast("date"), _c(day).cast("int"))


def roll_to_workday(day) -> Column:
    """Saturday -> +2 days, Sunday -> +1 day (Mon-Fri working week)."""
    wd = weekday_of_day(day)
    return _c(day) + F.when(wd == 5, 2).when(wd == 6, 1).otherwise(0)


def work_slot(stream: str, key, anchor: str, window_days: int = 30) -> Column:
    """Visit time: a uniform day in [anchor - window, anchor], weekend rolled forward
    (wrapping to the first working day of the window when the roll passes the anchor),
    hour uniform in working hours, minute a multiple of 15."""
    end_day = epoch_day(F.lit(anchor).cast("date"))
    start_day = end_day - window_days
    d = start_day + rand_int(0, window_days, stream + ":day", key)
    rolled = roll_to_workday(d)
    first = roll_to_workday(start_day)
    day = F.when(rolled > end_day, first).otherwise(rolled)
    hour = rand_int(WORK_HOUR_START, WORK_HOUR_END - 1, stream + ":hour", key)
    minute = rand_int(0, 60 // MINUTE_STEP - 1, stream + ":minute", key) * MINUTE_STEP
    return from_micros(day * US_DAY + hour * US_HOUR + minute * US_MIN)


def result_snap(ts, hours) -> Column:
    """Result time: ts + hours, weekend rolled forward, then clamped into working hours
    (before 09:00 -> 09:mm:ss with minutes zeroed; from 18:00 -> 17:00). Seconds and
    fractions of the shifted time are kept, as a wall-clock ``replace(hour, minute)``
    would. One pass only: rows that end up < 24 h after the visit are left for the gap
    rule to report."""
    r = micros(ts) + _c(hours) * F.lit(US_HOUR)
    day = roll_to_workday(day_of(r))
    r2 = day * US_DAY + F.pmod(r, F.lit(US_DAY))
    hour = F.floor(F.pmod(r2, F.lit(US_DAY)) / F.lit(US_HOUR))
    sec_part = F.pmod(r2, F.lit(US_MIN))
    snapped = (
        F.when(hour < WORK_HOUR_START, day * US_DAY + WORK_HOUR_START * US_HOUR + sec_part)
        .when(hour >= WORK_HOUR_END, day * US_DAY + (WORK_HOUR_END - 1) * US_HOUR + sec_part)
        .otherwise(r2)
    )
    return from_micros(snapped)


def hours_between(a, b) -> Column:
    """(b - a) in hours as double."""
    return F.timestamp_diff("MICROSECOND", _c(a), _c(b)).cast("double") / F.lit(float(US_HOUR))


def iso_text(ts, tz_text: str = TZ_TEXT) -> Column:
    return F.concat(F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm"), F.lit(tz_text))


# ---- SQL twins --------------------------------------------------------------------

def sql_micros(ts: str) -> str:
    return f"epoch_us({ts})"


def sql_from_micros(us: str) -> str:
    return f"make_timestamp(CAST({us} AS BIGINT))"


def sql_roll(day: str) -> str:
    wd = f"(((({day}) + 3) % 7 + 7) % 7)"
    return f"(({day}) + CASE WHEN {wd} = 5 THEN 2 WHEN {wd} = 6 THEN 1 ELSE 0 END)"


def sql_work_slot(stream: str, key: str, anchor: str, window_days: int = 30) -> str:
    end_day = f"(DATE '{anchor}' - DATE '1970-01-01')"
    start_day = f"({end_day} - {window_days})"
    d = f"({start_day} + {sql_rand_int(0, window_days, stream + ':day', key)})"
    rolled = sql_roll(d)
    first = sql_roll(start_day)
    day = f"(CASE WHEN {rolled} > {end_day} THEN {first} ELSE {rolled} END)"
    hour = sql_rand_int(WORK_HOUR_START, WORK_HOUR_END - 1, stream + ":hour", key)
    minute = f"({sql_rand_int(0, 60 // MINUTE_STEP - 1, stream + ':minute', key)} * {MINUTE_STEP})"
    return sql_from_micros(f"{day} * {US_DAY} + {hour} * {US_HOUR} + {minute} * {US_MIN}")


def sql_result_snap(ts: str, hours: str) -> str:
    r = f"({sql_micros(ts)} + ({hours}) * {US_HOUR})"
    day = sql_roll(f"(({r}) // {US_DAY})")
    r2 = f"({day} * {US_DAY} + ({r}) % {US_DAY})"
    hour = f"(({r2} % {US_DAY}) // {US_HOUR})"
    sec = f"({r2} % {US_MIN})"
    return sql_from_micros(
        f"CASE WHEN {hour} < {WORK_HOUR_START} THEN {day} * {US_DAY} + {WORK_HOUR_START * US_HOUR} + {sec} "
        f"WHEN {hour} >= {WORK_HOUR_END} THEN {day} * {US_DAY} + {(WORK_HOUR_END - 1) * US_HOUR} + {sec} "
        f"ELSE {r2} END"
    )


def sql_hours_between(a: str, b: str) -> str:
    return f"(CAST(epoch_us({b}) - epoch_us({a}) AS DOUBLE) / {float(US_HOUR)!r})"


def sql_iso_text(ts: str, tz_text: str = TZ_TEXT) -> str:
    return f"(strftime({ts}, '%Y-%m-%dT%H:%M') || '{tz_text}')"
