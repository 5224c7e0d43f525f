"""Guards and data-quality queries.

Each check is a query returning the offending rows, so it can be stored,
counted or inspected; ``enforce`` turns a non-empty result into an error before
anything is written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enforce(violations: DataFrame, message: str, show: int = 20) -> None:
    """Raise with a few examples when there is any violation (one small job)."""
    found = violations.limit(show).collect()
    if found:
        raise ValueError(f"{message}: " + "; ".join(str(r.asDict()) for r in found))


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """A primary input must not be empty."""
    if df.isEmpty():
        raise ValueError(f"{what}: no rows")
    return df


def missing_lags(panel: DataFrame, registry: DataFrame) -> DataFrame:
    """Series of the panel that cannot be lagged: not registered, or without a lag and not of vintages."""
    known = registry.where(F.col("lag").isNotNull() | F.col("is_vintage")).select("series_id")
    return panel.select("series_id").distinct().join(known, "series_id", "left_anti")


def required_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, present, n_rows, n_missing`` for each of ``columns``: is it there, and in how many rows without a value."""
    counts = [F.count(F.lit(1)).alias("n_rows")]
    counts += [(F.count_if(F.col(c).isNull()) if c in df.columns else F.count(F.lit(1))).alias(f"m{i}") for i, c in enumerate(columns)]
    rows = [
        F.struct(F.lit(c).alias("column"), F.lit(c in df.columns).alias("present"), "n_rows", F.col(f"m{i}").alias("n_missing"))
        for i, c in enumerate(columns)
    ]
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def empty_sources(panel: DataFrame, registry: DataFrame) -> DataFrame:
    """Registered series without any value: ``series_id, source``."""
    valued = panel.where(F.col("value").isNotNull()).select("series_id").distinct()
    return registry.select("series_id", "source").join(valued, "series_id", "left_anti")


def series_coverage(panel: DataFrame) -> DataFrame:
    """First and last date with a value, number of values and latest value per series."""
    return (
        panel.where(F.col("value").isNotNull())
        .groupBy("series_id")
        .agg(
            F.min("date").alias("first_valid"),
            F.max("date").alias("last_valid"),
            F.count("*").alias("n"),
            F.max_by("value", "date").alias("last_value"),
        )
    )


def registry_violations(registry: DataFrame) -> DataFrame:
    """Series that reach the features without a lag or a vintage table behind them."""
    return registry.where(
        (F.size("fm_transforms") > 0) & F.col("lag").isNull() & ~F.col("is_vintage")
    ).select("series_id", "category", "fm_transforms")


def coverage_violations(panel: DataFrame, floors: DataFrame) -> DataFrame:
    """Protected series that start too late or have too few values.

    ``floors`` holds ``(series_id, first_by, min_n)``.  A series absent from the
    panel altogether is not judged; one present with missing values only is.
    """
    # Restricted before the shuffle: floors name the few series to protect.
    stats = (
        panel.join(floors.select("series_id"), "series_id", "left_semi")
        .groupBy("series_id")
        .agg(
            F.min(F.when(F.col("value").isNotNull(), F.col("date"))).alias("first_valid"),
            F.count("value").alias("n"),
        )
    )
    bad = F.col("first_valid").isNull() | (F.col("first_valid") > F.col("first_by")) | (F.col("n") < F.col("min_n"))
    return stats.join(floors, "series_id").where(bad).select("series_id", "first_valid", "first_by", "n", "min_n")


def dropped_counts(before: DataFrame, after: DataFrame, within: DataFrame | None = None) -> DataFrame:
    """Non-missing counts per series before and after a join, inside the date range of ``within``.

    Without ``within`` the range is that of ``after``.  Values outside it are out
    of scope, not lost.
    """
    lo, hi = ((within or after).agg(f("date")).scalar() for f in (F.min, F.max))
    sides = (
        before.where(F.col("date").between(lo, hi))
        .select("series_id", "value", F.lit(True).alias("is_before"))
        .unionByName(after.select("series_id", "value", F.lit(False).alias("is_before")))
    )
    valued = F.col("value").isNotNull()
    counts = sides.groupBy("series_id").agg(
        F.count_if(valued & F.col("is_before")).alias("n_before"), F.count_if(valued & ~F.col("is_before")).alias("n_after")
    )
    return counts.withColumn("dropped", F.col("n_after") < F.col("n_before"))


def shallow_history(panel: DataFrame, listed: DataFrame, since_year: int = 2019) -> DataFrame:
    """Listed series whose history only starts in ``since_year`` or later."""
    return (
        series_coverage(panel.join(listed.select("series_id"), "series_id", "left_semi"))
        .where(F.year("first_valid") >= since_year)
        .select("series_id", "first_valid", "n")
    )
