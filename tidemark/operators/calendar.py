"""Grids, resampling to native frequency, fills and date filters (one row per series and day)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import native_label, period_end
from tidemark.operators.asof import calendar_side, spread_on_days, validity
from tidemark.operators.windows import by_date


def business_grid(df: DataFrame, date: str = "date") -> DataFrame:
    """Monday-to-Friday days between the first and last ``date``, no holidays."""
    span = df.agg(F.min(date).alias("lo"), F.max(date).alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("date"))
    return days.where(F.weekday("date") < 5)


def resample_last(panel: DataFrame, rule: str) -> DataFrame:
    """Last non-missing value per period, stamped with the period label."""
    return (
        panel.where(F.col("value").isNotNull())
        .groupBy("series_id", period_end(F.col("date"), rule).alias("label"))
        .agg(F.max_by("value", "date").alias("value"))
        .select("series_id", F.col("label").alias("date"), "value")
    )


def to_native(panel: DataFrame, registry: DataFrame, keep: Sequence[str] = (), month_rule: str = "ME") -> DataFrame:
    """Restore each series to its declared frequency in one aggregation for all of them.

    Labels sit on the right edge of the period, so a value never shows before
    its period is over (month-start labels, for display only, break that).
    ``keep`` carries further registry columns along.
    """
    spec = registry.select("series_id", "frequency", *keep)
    labelled = panel.where(F.col("value").isNotNull()).join(spec.hint("shuffle_hash"), "series_id")
    return (
        labelled.groupBy("series_id", "frequency", *keep, native_label(F.col("date"), F.col("frequency"), month_rule).alias("label"))
        .agg(F.max_by("value", "date").alias("value"))
        .select("series_id", F.col("label").alias("date"), "value", "frequency", *keep)
    )


def ffill_value(value: str = "value", by: str = "series_id", order: str = "date") -> Column:
    """Last non-missing value so far, as a window column."""
    return F.last(value, ignorenulls=True).over(
        Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def ffill_on_grid(panel: DataFrame, grid: DataFrame) -> DataFrame:
    """Value at the latest label at or before each grid date, also where that value is NULL.

    ``grid`` holds distinct dates (bounded by the calendar).  Each row produces
    the days it is valid for and the grid keeps its own; nothing is paired with
    the history.  Dates before the first label have no row.
    """
    end = grid.agg(F.max("date")).scalar()
    held = spread_on_days(validity(panel, "date", end=end), "date", "grid_date")
    on_grid = held.join(calendar_side(grid, name="grid_date"), "grid_date", "left_semi")
    return on_grid.select("series_id", F.col("grid_date").alias("date"), F.col("date").alias("label"), "value")


def reindex(panel: DataFrame, index: DataFrame) -> DataFrame:
    """Restrict or extend every series to ``index`` (series_id, date); missing rows are NULL."""
    return index.select("series_id", "date").join(panel, ["series_id", "date"], "left")


def date_union(*panels: DataFrame) -> DataFrame:
    """Distinct dates occurring in any of the panels."""
    out = panels[0].select("date")
    for other in panels[1:]:
        out = out.union(other.select("date"))
    return out.distinct()


def trading_days(panel: DataFrame, min_obs: int = 100, min_density: float = 0.5, min_weekday_share: float = 0.95) -> DataFrame:
    """Panel rows on real trading days.

    A series is a daily market series when it has ``min_obs`` values, fills more
    than ``min_density`` of the panel's dates in its active span, and lies on
    weekdays for more than ``min_weekday_share`` of its dates.  A date is kept
    when it is a weekday and any such series has a value on it; without any such
    series all weekdays are kept.
    """
    valued = panel.where(F.col("value").isNotNull())
    weekday = F.weekday("date") < 5
    stats = valued.groupBy("series_id").agg(
        F.count("*").alias("n"),
        F.min("date").alias("lo"),
        F.max("date").alias("hi"),
        F.avg(weekday.cast("double")).alias("weekday_share"),
    )
    # Panel dates inside [lo, hi] by ordinal difference rather than a range join:
    # both ends are panel dates themselves.  The index is bounded by the calendar.
    ordinal = (
        panel.select("date").distinct().withColumn("k", F.row_number().over(Window.orderBy("date")))
    )
    lo = ordinal.select(F.col("date").alias("lo"), F.col("k").alias("k_lo"))
    hi = ordinal.select(F.col("date").alias("hi"), F.col("k").alias("k_hi"))
    market = (
        stats.where((F.col("n") >= min_obs) & (F.col("weekday_share") > min_weekday_share))
        .join(lo, "lo")
        .join(hi, "hi")
        .where(F.col("n") / (F.col("k_hi") - F.col("k_lo") + 1) > min_density)
        .select("series_id")
    )
    open_days = calendar_side(valued.where(weekday).join(market, "series_id", "left_semi"))
    any_market = F.coalesce(market.agg(F.count("*") > 0).scalar(), F.lit(False))
    marked = panel.where(weekday).join(open_days.withColumn("is_open", F.lit(True)), "date", "left")
    return marked.where(F.col("is_open").isNotNull() | ~any_market).select("series_id", "date", "value")


def hybrid_grid_change(panel: DataFrame, cutover: str, periods: int = 252) -> DataFrame:
    """Row-counted change in percent on a grid that is dense before ``cutover``.

    Before the cut-over every business day from the series' first date is a row
    and blanks count as zero; from it on only observed dates are rows.
    """
    cut = F.to_date(F.lit(cutover))
    valued = panel.where(F.col("value").isNotNull())
    # Each early value emits the business days up to the next one; an early
    # weekend observation is off the dense grid and drops out.
    until = F.least(F.coalesce(F.date_sub(F.lead("date").over(by_date()), 1), cut), F.date_sub(cut, 1))
    spans = valued.withColumn("until", until).where(F.col("date") < cut)
    days = spans.withColumn("day", F.explode(F.sequence("date", "until"))).where(F.weekday("day") < 5)
    early = days.select(
        "series_id",
        F.col("day").alias("date"),
        F.when(F.col("day") == F.col("date"), F.col("value")).otherwise(0.0).alias("value"),
    )
    grid = early.unionByName(valued.where(F.col("date") >= cut))
    base = F.lag("value", periods).over(by_date())
    return grid.select(
        "series_id", "date", "value", (F.try_divide(F.col("value") - base, base) * 100.0).alias("change_pct")
    )


def anchor_trim(panel: DataFrame, anchors: Sequence[str], floor: str | None = None, to_year_start: bool = False) -> DataFrame:
    """Rows from the first date any anchor series has a value, optionally not before ``floor``."""
    start = (
        panel.where(F.col("series_id").isin(list(anchors)) & F.col("value").isNotNull()).agg(F.min("date")).scalar()
    )
    if to_year_start:
        start = F.trunc(start, "year")
    if floor is not None:
        start = F.greatest(start, F.to_date(F.lit(floor)))
    return panel.where(F.col("date") >= start)


def pending_tail(panel: DataFrame, index: DataFrame) -> DataFrame:
    """Hold the last value to the end of ``index`` (distinct dates) and flag the held rows.

    Interior gaps stay NULL and unflagged.
    """
    valued = panel.where(F.col("value").isNotNull())
    first_day, last_day = (index.agg(f("date")).scalar() for f in (F.min, F.max))
    # Each value emits the days up to the next one, the first also those before it.
    spans = valued.withColumns(
        {
            "since": F.when(F.lag("date").over(by_date()).isNull(), F.least(first_day, F.col("date"))).otherwise(F.col("date")),
            "next": F.lead("date").over(by_date()),
        }
    ).withColumn("until", F.coalesce(F.date_sub("next", 1), F.greatest(last_day, F.col("date"))))
    days = spans.withColumn("day", F.explode(F.sequence("since", "until"))).join(
        calendar_side(index, name="day"), "day", "left_semi"
    )
    held = F.col("next").isNull() & (F.col("day") > F.col("date"))
    value = F.when(held | (F.col("day") == F.col("date")), F.col("value"))
    return days.select("series_id", F.col("day").alias("date"), value.alias("value"), held.alias("is_pending"))


def trailing_years(panel: DataFrame, *years: int) -> DataFrame:
    """Rows of the last so many years before the panel's latest date, for each number of years."""
    latest = panel.agg(F.max("date")).scalar()
    spans = panel.withColumn("years", F.explode(F.array(*[F.lit(n) for n in years])))
    return spans.where(F.col("date") >= F.add_months(latest, F.col("years") * -12))
