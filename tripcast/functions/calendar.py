"""Calendar column expressions: hour/weekday parts, US federal holidays,
days since epoch and the yearly sine/cosine wave.

All of them are native Catalyst expressions (no Python per row), so they stay
inside whole-stage code generation.
"""

from __future__ import annotations

import math
from calendar import monthrange
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spark dayofweek(): 1 = Sunday ... 7 = Saturday
_SUN, _MON, _THU, _FRI, _SAT = 1, 2, 5, 6, 7

# --- fixed values: US federal holidays -----------------------------------
# Fixed-date holidays (month, day, first year), moved to the Friday before
# when on a Saturday and to the Monday after when on a Sunday; the original
# date stays a holiday as well.
FIXED_HOLIDAYS = [
    (1, 1, 1871),    # New Year's Day
    (6, 19, 2021),   # Juneteenth National Independence Day
    (7, 4, 1871),    # Independence Day
    (11, 11, 1978),  # Veterans Day (on Nov 11 again from 1978)
    (12, 25, 1871),  # Christmas Day
]
# Weekday holidays (month, spark dayofweek, n-th occurrence or -1 = last, first year)
WEEKDAY_HOLIDAYS = [
    (1, _MON, 3, 1986),   # Martin Luther King Jr. Day
    (2, _MON, 3, 1971),   # Washington's Birthday
    (5, _MON, -1, 1971),  # Memorial Day
    (9, _MON, 1, 1894),   # Labor Day
    (10, _MON, 2, 1971),  # Columbus Day
    (11, _THU, 4, 1942),  # Thanksgiving
]


def to_day(ts: Column) -> Column:
    return F.to_date(ts)


def _holiday_rules() -> dict[tuple[int | None, int], list[int]]:
    """(weekday or None, first year) -> days as month * 100 + day."""
    rules: dict[tuple[int | None, int], list[int]] = {}
    for month, day, first in FIXED_HOLIDAYS:
        # any year without a leap day serves to step over a month's end
        at = date(2001, month, day)
        before, after = at - timedelta(days=1), at + timedelta(days=1)
        rules.setdefault((None, first), []).append(month * 100 + day)
        # the year of the holiday counts, which for Dec 31 is the next
        rules.setdefault((_FRI, first - (before.year < at.year)), []).append(before.month * 100 + before.day)
        rules.setdefault((_MON, first + (after.year > at.year)), []).append(after.month * 100 + after.day)
    for month, weekday, nth, first in WEEKDAY_HOLIDAYS:
        last = monthrange(2001, month)[1]
        begin = last - 6 if nth == -1 else 7 * nth - 6
        rules.setdefault((weekday, first), []).extend(month * 100 + d for d in range(begin, begin + 7))
    return rules


def is_us_holiday(d: Column) -> Column:
    """1 when the date is a US federal holiday or an observed day of one: a
    few set lookups of the day in the year, most of them behind the weekday."""
    day, weekday, cond = F.month(d) * 100 + F.dayofmonth(d), F.dayofweek(d), F.lit(False)
    for (on, first), days in _holiday_rules().items():
        rule = day.isin(*days) & (F.year(d) >= first)
        cond = cond | (rule if on is None else (weekday == on) & rule)
    return F.coalesce(cond, F.lit(False)).cast("int")


def days_since_epoch(ts: Column) -> Column:
    """whole days since 1970-01-01 (floor for times before midnight)."""
    return F.unix_date(F.to_date(ts)).cast("long")


def season_sin(ts: Column) -> Column:
    return F.sin(F.lit(2 * math.pi) * F.dayofyear(ts) / F.lit(365.25))


def season_cos(ts: Column) -> Column:
    return F.cos(F.lit(2 * math.pi) * F.dayofyear(ts) / F.lit(365.25))


def holiday_calendar(days: DataFrame, date_col: str = "day") -> DataFrame:
    """A calendar dimension (one row per day between the first and the
    last day of ``days``) built with ``sequence``; columns ``day, is_holiday``.

    Its size is the number of days spanned, not the number of trips.
    """
    span = days.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    cal = span.select(F.explode(F.sequence(F.col("lo"), F.col("hi"))).alias("day"))
    return cal.select("day", is_us_holiday(F.col("day")).alias("is_holiday"))
