"""Calendar expressions.  All are row-local Columns: no join, no shuffle, no UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Period rules per declared frequency, periods in a year, and the
# usual gap in days between observations.
PERIOD_RULE = {"D": "D", "W": "W", "M": "ME", "Q": "QE"}
PERIODS_PER_YEAR = {"D": 252, "W": 52, "M": 12, "Q": 4}
EXPECTED_GAP_DAYS = {"D": 1, "W": 7, "M": 30, "Q": 91}

# US federal holidays.  A dated holiday on Saturday is observed on
# Friday, on Sunday on Monday.  (month, day, first year)
DATED_HOLIDAYS = [
    (1, 1, 1),  # New Year's Day
    (6, 19, 2021),  # Juneteenth
    (7, 4, 1),  # Independence Day
    (11, 11, 1),  # Veterans Day
    (12, 25, 1),  # Christmas Day
]
# (month, weekday with Monday = 0, first and last day of month it can fall on, first year)
FLOATING_HOLIDAYS = [
    (1, 0, 15, 21, 1986),  # Martin Luther King Jr. Day, third Monday
    (2, 0, 15, 21, 1),  # Washington's Birthday, third Monday
    (5, 0, 25, 31, 1),  # Memorial Day, last Monday
    (9, 0, 1, 7, 1),  # Labor Day, first Monday
    (10, 0, 8, 14, 1),  # Columbus Day, second Monday
    (11, 3, 22, 28, 1),  # Thanksgiving, fourth Thursday
]


def is_weekday(d: Column) -> Column:
    return F.weekday(d) < 5


def period_end(d: Column, rule: str) -> Column:
    """Label of the period ``d`` lies in: ``D``, ``W`` (Sunday), ``ME``, ``QE`` or ``MS`` (month start)."""
    if rule == "D":
        return d
    if rule == "W":
        return F.date_add(F.trunc(d, "week"), 6)
    if rule == "ME":
        return F.last_day(d)
    if rule == "QE":
        return F.last_day(F.add_months(F.trunc(d, "quarter"), 2))
    if rule == "MS":
        return F.trunc(d, "month")
    raise ValueError(f"unknown period rule {rule!r}")


def native_label(d: Column, frequency: Column, month_rule: str = "ME") -> Column:
    """Label at the declared frequency, chosen per row; on the right edge unless months are stamped at their start."""
    rules = PERIOD_RULE | {"M": month_rule}
    label = F.when(frequency == "D", d)
    for freq in ("W", "M", "Q"):
        label = label.when(frequency == freq, period_end(d, rules[freq]))
    return label.otherwise(
        F.raise_error(F.concat(F.lit("unknown frequency "), F.coalesce(frequency, F.lit("NULL")))).cast("date")
    )


def business_month_end(d: Column) -> Column:
    """Last Monday-to-Friday day of the month ``d`` lies in."""
    end = F.last_day(d)
    return F.date_sub(end, F.greatest(F.weekday(end) - F.lit(4), F.lit(0)))


def _falls_on(d: Column, month: int, day: int) -> Column:
    return (F.month(d) == month) & (F.dayofmonth(d) == day)


def is_federal_holiday(d: Column) -> Column:
    """True on the days a US federal holiday is observed (weekdays only)."""
    hit = F.lit(False)
    for month, day, since in DATED_HOLIDAYS:
        observed = (
            (is_weekday(d) & _falls_on(d, month, day))
            | ((F.weekday(d) == 4) & _falls_on(F.date_add(d, 1), month, day))
            | ((F.weekday(d) == 0) & _falls_on(F.date_sub(d, 1), month, day))
        )
        hit = hit | (observed & (F.year(F.date_add(d, 1)) >= since))
    for month, weekday, lo, hi, since in FLOATING_HOLIDAYS:
        hit = hit | (
            (F.month(d) == month)
            & (F.weekday(d) == weekday)
            & F.dayofmonth(d).between(lo, hi)
            & (F.year(d) >= since)
        )
    return hit


def is_business_day(d: Column) -> Column:
    return is_weekday(d) & ~is_federal_holiday(d)


def add_business_days(d: Column, n: int) -> Column:
    """The n-th business day strictly after ``d``.

    A span of 2n + 10 days always holds n business days, so a short array per
    row replaces a join to a calendar table.
    """
    if n < 1:
        raise ValueError(f"n must be >= 1, got {n}")
    ahead = F.sequence(F.date_add(d, 1), F.date_add(d, 2 * n + 10))
    return F.element_at(F.filter(ahead, is_business_day), n)
