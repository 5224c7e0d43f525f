"""Held values as runs: one row per value and the days it is the latest one.

A held panel repeats a value on every weekday until the next one comes: some 260
rows a year for a quarterly series of four values.  A run ``series_id, since,
until, value, obs_date`` says the same in one row.  What can be counted on runs
is counted on them; days appear at the sink (``spread``).  Runs of one series do
not overlap and hold weekdays only in the sense of ``spread``: days of a weekend
inside a run are not part of the grid.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import native_label
from tidemark.operators.asof import spread_on_days, validity

RUN = ("series_id", "since", "until", "value", "obs_date")


def as_day(end: Column | str) -> Column:
    """An explicit end date, given as a column or as ``yyyy-MM-dd``."""
    return F.lit(end).cast("date") if isinstance(end, str) else end


def split_at(rows: DataFrame, end: Column | str, *dates: str) -> tuple[DataFrame, DataFrame]:
    """Rows none of whose ``dates`` is after ``end``, and all others: nothing is lost between the two."""
    late = F.lit(False)
    for name in dates:
        late = late | F.coalesce(F.col(name) > as_day(end), F.lit(False))
    return rows.where(~late), rows.where(late)


def runs(shifted: DataFrame, end: Column | str) -> DataFrame:
    """Runs of the non-missing values of ``shifted`` (``series_id, date, value, obs_date``) up to ``end``.

    A value first seen after ``end`` has no run yet, and ends none that is before it.
    """
    known = shifted.where(F.col("value").isNotNull()).withColumnRenamed("date", "since")
    return cut(validity(known, "since", end=as_day(end)), "since", as_day(end))


def cut(spans: DataFrame, since: str, end: Column, start: Column | None = None) -> DataFrame:
    """Spans with ``valid_to`` as runs, cut to ``[start, end]``; what holds no weekday there drops out."""
    first = F.col(since) if start is None else F.greatest(since, start)
    cutting = spans.select(
        "series_id",
        first.alias("since"),
        F.least("valid_to", end).alias("until"),
        "value",
        "obs_date",
    )
    return cutting.where(first_weekday(F.col("since")) <= F.col("until"))


def first_weekday(day: Column) -> Column:
    """The day itself, or the Monday after a weekend."""
    return F.date_add(day, F.when(F.weekday(day) < 5, 0).otherwise(7 - F.weekday(day)))


def last_weekday(day: Column) -> Column:
    """The day itself, or the Friday before it."""
    return F.date_sub(day, F.greatest(F.weekday(day) - 4, F.lit(0)))


def weekdays_between(since: Column, until: Column) -> Column:
    """Number of weekdays in ``[since, until]``, in closed form: whole weeks count five."""

    def before(day):  # weekdays from a fixed Monday up to, but without, the day
        days = F.datediff(day, F.lit("1900-01-01").cast("date"))
        return F.floor(days / 7) * 5 + F.least(F.pmod(days, F.lit(7)), F.lit(5))

    return (before(F.date_add(until, 1)) - before(since)).cast("int")


def spread(held: DataFrame) -> DataFrame:
    """The panel the runs stand for: one row per weekday, made without a shuffle."""
    days = spread_on_days(held.withColumnRenamed("until", "valid_to"), "since", "date", weekdays_only=True)
    return days.select("series_id", "date", "value", "obs_date")


def coverage(held: DataFrame) -> DataFrame:
    """First and last grid day and number of grid days per series, counted on runs."""
    return held.groupBy("series_id").agg(
        F.min(first_weekday(F.col("since"))).alias("first_valid"),
        F.max(last_weekday(F.col("until"))).alias("last_valid"),
        F.sum(weekdays_between(F.col("since"), F.col("until"))).alias("n"),
    )


def with_weekdays(held: DataFrame) -> DataFrame:
    """Adds the first and last weekday of each run, ``__lo`` and ``__hi``; a run that holds none drops out."""
    ends = {"__lo": first_weekday(F.col("since")), "__hi": last_weekday(F.col("until"))}
    return held.withColumns(ends).where(F.col("__lo") <= F.col("__hi"))


def grid(held: DataFrame) -> DataFrame:
    """The distinct days of ``spread(held)``: equal runs of different series are spread once."""
    spans = held.select("since", F.col("until").alias("valid_to")).distinct()
    return spread_on_days(spans, "since", "date", weekdays_only=True).select("date").distinct()


def _period_starts(since: Column, until: Column, frequency: Column) -> Column:
    """Some day of every period of the declared frequency that has a weekday in ``[since, until]`` (both weekdays), and if periods are days all of them."""

    def stepped(unit, step):
        return F.sequence(F.trunc(since, unit), F.trunc(until, unit), F.expr(f"interval {step}"))

    return (
        F.when(frequency == "W", stepped("week", "7 days"))
        .when(frequency == "M", stepped("month", "1 month"))
        .when(frequency == "Q", stepped("quarter", "3 months"))
        .otherwise(F.sequence(since, until))
    )


def to_native(held: DataFrame, registry: DataFrame, keep: Sequence[str] = (), month_rule: str = "ME") -> DataFrame:
    """The rows ``calendar.to_native`` makes of the spread panel, without spreading it.

    A run puts forward its value for each period it has a weekday in, and the
    last run of a period wins.  A quarterly series so moves a few rows a year
    through the shuffle, not one per day.
    """
    spec = registry.select("series_id", "frequency", *keep)
    longer = F.coalesce(F.col("frequency").isin("W", "M", "Q"), F.lit(False))
    labelled = (
        with_weekdays(held.where(F.col("value").isNotNull()))
        .join(spec.hint("shuffle_hash"), "series_id")
        .withColumn("__day", F.explode(_period_starts(F.col("__lo"), F.col("__hi"), F.col("frequency"))))
        .where(longer | (F.weekday("__day") < 5))
    )
    return (
        labelled.groupBy("series_id", "frequency", *keep, native_label(F.col("__day"), F.col("frequency"), month_rule).alias("label"))
        .agg(F.max_by("value", "since").alias("value"))
        .select("series_id", F.col("label").alias("date"), "value", "frequency", *keep)
    )
