"""Point-in-time operators: what was known on a day, and nothing later."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import prefix
from tidemark.operators import runs as R
from tidemark.operators.asof import asof_last, calendar_side, spread_on_days, validity
from tidemark.schema import require_columns


def publication_lag(panel: DataFrame, registry: DataFrame, strict: bool = True) -> DataFrame:
    """Move every value to the calendar day it could be known on; ``obs_date`` keeps the old stamp.

    With ``strict`` a series without a lag fails the job when it is met;
    otherwise such series are left out.
    """
    lags = registry.select("series_id", "lag")
    if strict:
        joined = panel.join(lags, "series_id", "left").withColumn(
            "lag",
            F.coalesce(
                "lag", F.raise_error(F.concat(F.lit("no publication lag for series "), F.col("series_id"))).cast("int")
            ),
        )
    else:
        joined = panel.join(lags.where(F.col("lag").isNotNull()), "series_id")
    return joined.select(
        "series_id", F.date_add("date", F.col("lag")).alias("date"), "value", F.col("date").alias("obs_date")
    )


def shift_days(panel: DataFrame, lag_days: int) -> DataFrame:
    """One lag for the whole panel: dates move, values do not."""
    return panel.withColumn("date", F.date_add("date", lag_days))


def pit_align(panel: DataFrame, registry: DataFrame, strict: bool = True, end: Column | str | None = None) -> DataFrame:
    """Lagged values on a Monday-to-Friday grid, each held until the next one.

    The grid ends at ``end``, without one at the last shifted date of any series,
    missing values included: one wrong date then stretches the whole grid, so a
    job should name its end.  Each value knows the days it is the latest one and
    emits them, so the grid is never joined.  Grid days before a series starts
    have no row.
    """
    shifted = publication_lag(panel, registry, strict)
    return R.spread(R.runs(shifted, shifted.agg(F.max("date")).scalar() if end is None else end))


def first_release(vintages: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """Earliest published value of every data date; a NULL first release stays NULL.

    An aggregation, not a per-date sort: revisions are combined before the
    shuffle, so a series with very many of them is no heavier than others.
    ``ties`` orders rows published on the same day (needed only when
    ``(series_id, date, realtime_start)`` is not unique).
    """
    require_columns(vintages, ["series_id", "realtime_start", "date", "value"], "first_release")
    order = F.struct("realtime_start", *ties) if ties else F.col("realtime_start")
    return (
        vintages.groupBy("series_id", "date")
        .agg(F.min("realtime_start").alias("effective_date"), F.min_by("value", order).alias("value"))
        .select("series_id", "effective_date", "date", "value")
    )


def first_vintages(vintages: DataFrame, registry: DataFrame) -> DataFrame:
    """First releases of the registry's vintage series, as vintages of their own: a row per series and data date.

    They are all that ``pit_runs`` and ``publications`` take from a vintage
    table, so a job with several passes over it can store them in between.
    ``any_value`` is a value of the date in any release, NULL if it never had one.
    """
    listed = registry.where(F.col("is_vintage")).select("series_id")
    return (
        vintages.join(listed, "series_id", "left_semi")
        .groupBy("series_id", "date")
        .agg(
            F.min("realtime_start").alias("realtime_start"),
            F.min_by("value", "realtime_start").alias("value"),
            F.max("value").alias("any_value"),
        )
        .select("series_id", "realtime_start", "date", "value", "any_value")
    )


def latest_release(vintages: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """Last published value of every data date."""
    require_columns(vintages, ["series_id", "realtime_start", "date", "value"], "latest_release")
    order = F.struct("realtime_start", *ties) if ties else F.col("realtime_start")
    return (
        vintages.groupBy("series_id", "date")
        .agg(F.max("realtime_start").alias("release_date"), F.max_by("value", order).alias("value"))
        .select("series_id", "release_date", "date", "value")
    )


def check_release_order(releases: DataFrame, effective: str = "effective_date") -> DataFrame:
    """Fail the job on a value published before the period it describes."""
    bad = F.col(effective) < F.col("date")
    message = F.concat(F.lit("published before its data date: "), F.col("series_id"), F.lit(" "), F.col("date").cast("string"))
    return releases.withColumn(effective, F.when(bad, F.raise_error(message).cast("date")).otherwise(F.col(effective)))


def release_order_violations(releases: DataFrame, effective: str = "effective_date") -> DataFrame:
    """Rows published before the period they describe: to be put in quarantine."""
    return releases.where(F.col(effective) < F.col("date"))


def asof_backward(releases: DataFrame, queries: DataFrame, lag_days: int = 0, width: int | None = None) -> DataFrame:
    """Latest release with ``effective_date + lag_days <= query_date`` per (series_id, query_date).

    Releases of one day are ordered by data date.  The output shows the true
    effective date, a matched NULL stays NULL, and no match gives a NULL row.
    With a ``width`` every stretch of so many days of a series is a task of its
    own: for series too long for one.
    """
    if lag_days < 0:
        raise ValueError(f"lag_days must not be negative, releases cannot be moved back in time: {lag_days}")
    known = releases.select(
        "series_id",
        F.date_add("effective_date", lag_days).alias("usable_from"),
        F.col("date").alias("data_date"),
        "effective_date",
        F.col("value").alias("pit_value"),
    )
    asked = queries.select("series_id", "query_date").distinct()
    carry = ["pit_value", "data_date", "effective_date"]
    if width is not None:
        return prefix.asof_last(asked, known, "query_date", "usable_from", ["series_id"], carry, ["data_date"], width, one_per_day=True)
    return asof_last(
        asked,
        known,
        left_on="query_date",
        right_on="usable_from",
        by=["series_id"],
        carry=carry,
        ties=["data_date"],
        one_per_day=True,
    )


def vintage_levels(vintages: DataFrame, grid: DataFrame, lag_days: int = 0, ties: Sequence[str] = ()) -> DataFrame:
    """First-release level of every series on every day of ``grid`` (distinct dates).

    Same answer as ``asof_backward`` with the grid as query dates, without
    building series x days requests first.  Grid days before the first release
    have no row.
    """
    if lag_days < 0:
        raise ValueError(f"lag_days must not be negative, releases cannot be moved back in time: {lag_days}")
    end = grid.agg(F.max("date")).scalar()
    held = spread_on_days(_release_spans(vintages, end, lag_days, ties), "usable_from", "grid_date")
    on_grid = held.join(calendar_side(grid, name="grid_date"), "grid_date", "left_semi")
    return on_grid.select("series_id", F.col("grid_date").alias("date"), "value", F.col("date").alias("obs_date"))


def _release_spans(vintages: DataFrame, end: Column, lag_days: int, ties: Sequence[str]) -> DataFrame:
    """First releases with the days each is the latest one known."""
    releases = check_release_order(first_release(vintages, ties)).withColumn(
        "usable_from", F.date_add("effective_date", lag_days)
    )
    return validity(releases, "usable_from", ties=["date"], end=end)


def pit_runs(
    panel: DataFrame,
    vintages: DataFrame | None,
    registry: DataFrame,
    lag_days: int = 0,
    ties: Sequence[str] = (),
    end: Column | str | None = None,
) -> DataFrame:
    """Fixed-lag series and first-release levels as runs on one business grid.

    The grid goes from the first shifted date to ``end``, without one to the last
    shifted date.
    """
    shifted = publication_lag(panel, registry, strict=False)
    lo = shifted.agg(F.min("date")).scalar()
    hi = shifted.agg(F.max("date")).scalar() if end is None else R.as_day(end)
    fixed = R.runs(shifted, hi).select(*R.RUN)
    if vintages is None:
        return fixed
    listed = registry.where(F.col("is_vintage")).select("series_id")
    spans = _release_spans(vintages.join(listed, "series_id", "left_semi"), hi, lag_days, ties)
    # The grid is all weekdays of one span, so cutting the spans replaces a join to it.
    return fixed.unionByName(R.cut(spans.withColumnRenamed("date", "obs_date"), "usable_from", hi, start=lo))


def pit_panel(
    panel: DataFrame,
    vintages: DataFrame | None,
    registry: DataFrame,
    lag_days: int = 0,
    ties: Sequence[str] = (),
    end: Column | str | None = None,
) -> DataFrame:
    """Fixed-lag series on the business grid plus first-release levels on the same grid: the days of ``pit_runs``."""
    return R.spread(pit_runs(panel, vintages, registry, lag_days, ties, end))


def diagnose_lookahead(raw: DataFrame, pit: DataFrame, day: str, tolerance: float = 1e-9) -> DataFrame:
    """Per series: latest raw value and latest point-in-time value at ``day``, and whether they differ."""
    at = F.to_date(F.lit(day))

    sides = raw.select("series_id", "date", "value", F.lit(0).alias("side")).unionByName(
        pit.select("series_id", "date", "value", F.lit(1).alias("side"))
    )
    known = sides.where((F.col("date") <= at) & F.col("value").isNotNull())

    def latest(side: int):
        return F.max_by("value", F.when(F.col("side") == side, F.col("date")))

    both = known.groupBy("series_id").agg(latest(0).alias("raw_value"), latest(1).alias("pit_value"))
    diff = F.col("raw_value") - F.col("pit_value")
    flagged = F.coalesce(F.abs(diff) > tolerance, F.lit(False)) & F.col("raw_value").isNotNull()
    return both.select("series_id", "raw_value", "pit_value", diff.alias("diff"), flagged.alias("look_ahead"))


def asof_coverage(aligned: DataFrame) -> DataFrame:
    """Matched and asked query dates per series."""
    return aligned.groupBy("series_id").agg(
        F.count("pit_value").alias("n_aligned"), F.count("*").alias("n_total")
    )


def release_date(panel: DataFrame, registry: DataFrame, business_prefix: str | None = None, business_days: int = 3) -> DataFrame:
    """Stamp the day a value became public; vintage series and series without lag get NULL.

    Series whose id starts with ``business_prefix`` are released a number of US
    federal business days after the data date instead.
    """
    from tidemark.functions.dates import add_business_days

    spec = registry.select("series_id", "lag", "is_vintage")
    stamp = F.date_add("date", F.col("lag"))
    if business_prefix is not None:
        stamp = F.when(
            F.col("series_id").startswith(business_prefix), add_business_days(F.col("date"), business_days)
        ).otherwise(stamp)
    vintage = F.coalesce("is_vintage", F.lit(False))
    return (
        panel.join(spec, "series_id", "left")
        .withColumn("release_date", F.when(~vintage, stamp))
        .select(*panel.columns, "release_date")
    )


def release_date_vintage(panel: DataFrame, vintages: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """Stamp each row with the latest first-release day at or before its date.

    Rows before the first release of their series drop out.  ``panel`` may be
    long (many transforms per day): one lookup is made per distinct day.
    """
    releases = first_release(vintages, ties).select("series_id", F.col("effective_date").alias("release_date"))
    stamped = asof_last(
        panel, releases, left_on="date", right_on="release_date", by=["series_id"], carry=["release_date"]
    )
    return stamped.where(F.col("release_date").isNotNull())
