"""Past-only transforms of a series.

All functions take and return panels and read rows up to the current one only.
Row-counted transforms count the rows they are given: restore the native
frequency first (``calendar.to_native``) unless the rows are the intended unit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import EXPECTED_GAP_DAYS, PERIODS_PER_YEAR
from tidemark.functions.numeric import pct_change
from tidemark.operators.windows import by_date, expanding_moments, months_back, rolling_moments, so_far


def rolling_zscore(
    panel: DataFrame,
    window: int | str = 252,
    min_periods: int | None = None,
    lag: int = 0,
    by: str | Sequence[str] = "series_id",
    widths: Sequence[int] | None = None,
) -> DataFrame:
    """Distance of the current value from the mean of a trailing window, in its sample deviations.

    ``lag`` moves the window back, never the current value.  ``min_periods``
    counts non-missing values in the window (default: half of it).  ``window``
    may name a column with one width per ``by`` group; ``widths`` as in ``rolling_moments``.
    """
    width = F.lit(window) if isinstance(window, int) else F.col(window)
    need = F.floor(width / 2) if min_periods is None else F.lit(min_periods)
    keep = [F.col(c) for c in panel.columns]
    z = F.try_divide(F.col("value") - F.col("roll_mean"), F.col("roll_std"))
    return rolling_moments(panel, window, lag, by=by, widths=widths).select(*keep, F.when(F.col("roll_n") >= need, z).alias("z"))


def expanding_zscore(panel: DataFrame, min_periods: int = 60, lag: int = 0) -> DataFrame:
    """As ``rolling_zscore`` with the whole history as window."""
    keep = [F.col(c) for c in panel.columns]
    z = F.try_divide(F.col("value") - F.col("exp_mean"), F.col("exp_std"))
    return expanding_moments(panel, lag).select(*keep, F.when(F.col("exp_n") >= min_periods, z).alias("z"))


def yoy(native: DataFrame, periods: int) -> DataFrame:
    """Change in percent against the row ``periods`` back; rows must be native periods."""
    return native.withColumn("yoy", pct_change(F.col("value"), F.lag("value", periods).over(by_date())))


def yoy_calendar(monthly: DataFrame, months: int = 12) -> DataFrame:
    """Change in percent against the same month a year earlier, by calendar.

    ``monthly`` has one row per month.  A month missing a year earlier gives NULL
    instead of moving the comparison to its neighbour.
    """
    return monthly.select(
        "series_id", "date", "value", pct_change(F.col("value"), months_back("value", months)).alias("yoy")
    )


def pct_change_rows(panel: DataFrame, periods: int = 21, name: str = "pct1m") -> DataFrame:
    """Change in percent over ``periods`` rows after carrying the last value over gaps."""
    filled = panel.withColumn(
        "__filled",
        F.last("value", ignorenulls=True).over(so_far()),
    )
    change = pct_change(F.col("__filled"), F.lag("__filled", periods).over(by_date()))
    return filled.withColumn(name, change).drop("__filled")


def diff(panel: DataFrame, periods: int = 1, scale: float = 1.0, name: str = "diff") -> DataFrame:
    """Difference to the row ``periods`` back, times ``scale``."""
    return panel.withColumn(name, (F.col("value") - F.lag("value", periods).over(by_date())) * F.lit(float(scale)))


def diff_bps(panel: DataFrame, periods: int = 1) -> DataFrame:
    """Difference of a percentage, in basis points."""
    return diff(panel, periods, 100.0, "diff_bps")


def resolve_window(frequency: str, years: float) -> int:
    """Rows of a window given as a duration."""
    if frequency not in PERIODS_PER_YEAR:
        raise ValueError(f"unknown frequency {frequency!r}, expected one of {sorted(PERIODS_PER_YEAR)}")
    return round(PERIODS_PER_YEAR[frequency] * years)


def frequency_check(panel: DataFrame, registry: DataFrame) -> DataFrame:
    """Median observed gap per series against the declared frequency.

    A series with at least three values must have a median gap between half and
    twice the expected one; ``ok`` says whether it does.
    """
    gaps = (
        panel.where(F.col("value").isNotNull())
        .withColumn("gap", F.datediff("date", F.lag("date").over(by_date())))
        .groupBy("series_id")
        .agg(F.count("*").alias("n_obs"), F.median("gap").alias("median_gap"))
    )
    expected = F.create_map(*[F.lit(x) for pair in EXPECTED_GAP_DAYS.items() for x in pair])
    with_spec = gaps.join(registry.select("series_id", "frequency"), "series_id").withColumn(
        "expected_gap", expected[F.col("frequency")]
    )
    fits = F.col("median_gap").between(F.col("expected_gap") * 0.5, F.col("expected_gap") * 2.0)
    return with_spec.select(
        "series_id",
        "frequency",
        "n_obs",
        "median_gap",
        "expected_gap",
        ((F.col("n_obs") < 3) | fits).alias("ok"),
    )


def window_rows(frequency: Column, years) -> Column:
    """Rows of a window given as a duration, per row; half rows round to the even number."""
    per_year = F.create_map(*[F.lit(x) for pair in PERIODS_PER_YEAR.items() for x in pair])
    return F.bround(per_year[frequency] * years, 0).cast("int")


def zscore_by_duration(native: DataFrame, years: float, lag: int = 0) -> DataFrame:
    """Rolling z over a duration for a native panel with a ``frequency`` column, all frequencies in one pass."""
    sized = native.withColumn("__rows", window_rows(F.col("frequency"), F.lit(years)))
    return rolling_zscore(sized, "__rows", lag=lag).drop("__rows")


def zscore_of_diff(panel: DataFrame, window: int = 260) -> DataFrame:
    """Rolling z of row differences, full windows only."""
    changes = diff(panel.where(F.col("value").isNotNull())).select("series_id", "date", F.col("diff").alias("value"))
    return rolling_zscore(changes, window, min_periods=window).withColumnRenamed("value", "diff")
