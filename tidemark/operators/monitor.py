"""Monitoring queries: scorecards, episodes above a threshold, named intervals, snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import light
from tidemark.operators.windows import by_date, so_far


def latest_values(panel: DataFrame) -> DataFrame:
    """Latest non-missing value and its date per series: one combinable aggregation."""
    return (
        panel.where(F.col("value").isNotNull())
        .groupBy("series_id")
        .agg(F.max("date").alias("as_of"), F.max_by("value", "date").alias("value"))
    )


def scorecard(panel: DataFrame, spec: DataFrame) -> DataFrame:
    """One row per spec row: latest value, the day it is as of, and its light.

    ``spec`` holds ``(card, label, series_id, as_of_series, scale, rule, threshold)``.
    The day comes from ``as_of_series`` when that is set and has values: a
    derived series carried forward is only as fresh as its youngest input.  The
    light is judged on the scaled value.  A label without values stays as a
    blank row.
    """
    latest = latest_values(panel)
    as_of = latest.select(F.col("series_id").alias("__dated_by"), F.col("as_of").alias("__as_of"))
    value = F.col("value") * F.coalesce("scale", F.lit(1.0))
    # Rows without another series are dated by their own: no pile of NULL keys.
    dated = spec.withColumn("__dated_by", F.coalesce("as_of_series", "series_id"))
    rows = dated.join(latest, "series_id", "left").join(as_of, "__dated_by", "left").withColumn("value", value)
    day = F.when(F.col("value").isNotNull(), F.coalesce("__as_of", "as_of"))
    return rows.select(
        "card",
        "label",
        day.alias("as_of"),
        "value",
        light(F.col("value"), F.col("rule"), F.col("threshold")).alias("light"),
    )


def _runs(panel: DataFrame, threshold: float) -> DataFrame:
    """Consecutive rows at or above the threshold: one row per run, first peak on ties."""
    hot = F.coalesce(F.col("value") >= threshold, F.lit(False))
    marked = panel.select("series_id", "date", "value", hot.alias("hot")).withColumn(
        "starts", (F.col("hot") & ~F.coalesce(F.lag("hot").over(by_date()), F.lit(False))).cast("int")
    )
    return (
        marked.withColumn("run", F.sum("starts").over(so_far()))
        .where("hot")
        .groupBy("series_id", "run")
        .agg(
            F.min("date").alias("start"),
            F.max("date").alias("end"),
            F.min_by("date", F.struct(-F.col("value"), F.col("date"))).alias("peak_date"),
            F.max("value").alias("peak_value"),
            F.count("*").alias("n_days"),
        )
    )


def _clusters(df: DataFrame, order: str, gap_days: Column, merge_days: int) -> DataFrame:
    """Number rows so that a gap of ``merge_days`` or more starts a new cluster."""
    w = Window.partitionBy("series_id").orderBy(order)
    starts = F.when(gap_days < merge_days, 0).otherwise(1)
    return df.withColumn("__starts", starts).withColumn(
        "cluster", F.sum("__starts").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ).drop("__starts")


def episodes(panel: DataFrame, threshold: float = 5.0, merge_days: int = 180) -> DataFrame:
    """Runs of observations at or above a threshold; runs less than ``merge_days`` apart are one episode."""
    runs = _runs(panel.where(F.col("value").isNotNull()), threshold)
    gap = F.datediff("start", F.lag("end").over(Window.partitionBy("series_id").orderBy("start")))
    return (
        _clusters(runs, "start", gap, merge_days)
        .groupBy("series_id", "cluster")
        .agg(
            F.min("start").alias("start_date"),
            F.max("end").alias("end_date"),
            F.min_by("peak_date", F.struct(-F.col("peak_value"), F.col("peak_date"))).alias("peak_date"),
            F.max("peak_value").alias("peak_value"),
            F.sum("n_days").alias("n_days"),
        )
        .drop("cluster")
    )


def episode_peaks(panel: DataFrame, threshold: float, merge_days: int = 180) -> DataFrame:
    """Highest peak of every group of runs whose peaks follow each other within ``merge_days``.

    A missing value breaks a run.  Distance is measured to the previous peak,
    not to the end of the previous run.
    """
    peaks = _runs(panel, threshold)
    gap = F.datediff("peak_date", F.lag("peak_date").over(Window.partitionBy("series_id").orderBy("peak_date")))
    return (
        _clusters(peaks, "peak_date", gap, merge_days)
        .groupBy("series_id", "cluster")
        .agg(
            F.min_by("peak_date", F.struct(-F.col("peak_value"), F.col("peak_date"))).alias("peak_date"),
            F.max("peak_value").alias("peak_value"),
        )
        .drop("cluster")
    )


def interval_label(events: DataFrame, intervals: DataFrame, date: str = "peak_date") -> DataFrame:
    """Name of the first interval (by ``priority``) a date lies in, NULL for none.

    The intervals are turned into one name per calendar day, which bounds their
    size by the calendar however many overlap; events then look their day up.
    """
    named = (
        intervals.select(
            F.explode(F.sequence("start", "end")).alias(date), F.struct("priority", "name").alias("__named")
        )
        .groupBy(date)
        .agg(F.min("__named").getField("name").alias("interval_name"))
    )
    return events.join(named, date, "left").select(*events.columns, "interval_name")


def interval_clip(panel: DataFrame, intervals: DataFrame) -> DataFrame:
    """Intervals overlapping the span of each series, cut to that span.

    A pair is produced in the first year both cover, once.
    """
    spans = panel.groupBy("series_id").agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    span_years = spans.withColumn("__year", F.explode(F.sequence(F.year("lo"), F.year("hi"))))
    interval_years = intervals.select(
        "name", "start", "end", F.explode(F.sequence(F.year("start"), F.year("end"))).alias("__year")
    )
    pairs = span_years.join(interval_years, "__year").where(
        (F.col("__year") == F.greatest(F.year("lo"), F.year("start")))
        & (F.col("end") >= F.col("lo"))
        & (F.col("start") <= F.col("hi"))
    )
    return pairs.select(
        "series_id",
        "name",
        F.greatest("start", "lo").alias("start_date"),
        F.least("end", "hi").alias("end_date"),
    )


def extremes(panel: DataFrame, threshold: float, stack_days: int = 60) -> DataFrame:
    """Every value at or above a threshold, counted within groups less than ``stack_days`` apart."""
    hot = panel.where(F.col("value") >= threshold)
    grouped = _clusters(hot, "date", F.datediff("date", F.lag("date").over(by_date())), stack_days)
    within = Window.partitionBy("series_id", "cluster").orderBy("date")
    return grouped.select("series_id", "date", "value", (F.row_number().over(within) - 1).alias("stack_level"))


def latest_snapshot(panel: DataFrame, n: int = 15) -> DataFrame:
    """The first ``n`` series with a value on the panel's last date."""
    last = panel.agg(F.max("date")).scalar()
    return (
        panel.where((F.col("date") == last) & F.col("value").isNotNull())
        .select("series_id", "date", "value")
        .orderBy("series_id")
        .limit(n)
    )
