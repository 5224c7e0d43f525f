"""The complete batch job: stored observations to monitoring and feature tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.merge import accumulate
from tidemark.operators.pit import first_vintages, pit_runs
from tidemark.operators.quality import require_rows
from tidemark.operators.runs import spread, split_at
from tidemark.operators.watch import Watch, covered, guarded, join_registered_whole, metrics
from tidemark.plans.features import OwnTransform, apply_transforms, with_checked_frequency
from tidemark.session import materialize
from tidemark.sources import store
from tidemark.sources.registry import validate


def run(
    spark: SparkSession,
    observations: DataFrame,
    registry: DataFrame,
    out: str,
    vintages: DataFrame | None = None,
    extra: list[DataFrame] | None = None,
    floors: DataFrame | None = None,
    buckets: int = store.BUCKETS,
    mode: str = "errorifexists",
    tables: str | None = None,
    check_frequency: bool = True,
    own: Mapping[str, OwnTransform] | None = None,
    end: str | None = None,
) -> dict[str, str]:
    """Write the raw, monitoring, point-in-time and feature tables below ``out``; returns their paths.

    ``end`` is the last day of every grid (``yyyy-MM-dd``).  Observations and
    vintages dated after it go to the table ``quarantine`` and nowhere else, so a
    wrong date cannot stretch the grid.  Without it grids end at the last date.
    The point-in-time values are also stored as runs (table ``runs``).

    ``extra`` are further sources (positions, margin) joined onto the dates of
    the observations; losing a value there is an error.  ``floors`` protect the
    history of named series: a violation stops the job before the
    point-in-time tables are written.  Both checks are made by the pass that
    writes the table, which fails with nothing committed; so are the counts of the
    table ``metrics`` (rows, values, first and last date of each stage).  Each stage reads the stored result of the
    one before, so nothing is computed twice and a lost executor costs its tasks
    only.  A rolling window of a series whose data dates contradict its declared
    frequency stops the job in either list, for a series of vintages by the
    dates of those; ``check_frequency=False`` leaves that out.  ``own`` are
    further transforms by name.  With a table name prefix in ``tables`` the two panels are saved as
    tables bucketed by series, and the passes over them do not shuffle.
    """
    paths = {name: f"{out}/{name}" for name in ("raw", "monitoring", "runs", "pit", "features", "metrics")}
    validate(registry)
    watches: list[Watch] = []

    def watched(name: str, date: str = "date") -> Watch:
        watches.append(Watch(name, date))
        return watches[-1]

    def stored(df: DataFrame, name: str) -> DataFrame:
        with guarded():
            if tables is not None:
                return store.save_panel_table(df, f"{tables}_{name}", paths[name], buckets, mode, watched(name))
            store.write_panel(df, paths[name], buckets, mode, watched(name))
        return store.read_panel(spark, paths[name], buckets=buckets)

    if end is not None:
        paths["quarantine"] = f"{out}/quarantine"
        observations, beyond = split_at(observations, end, "date")
        beyond = beyond.select("series_id", F.lit(None).cast("date").alias("realtime_start"), "date", "value")
        if vintages is not None:
            vintages, late = split_at(vintages, end, "date", "realtime_start")
            beyond = beyond.unionByName(late.select(*beyond.columns))
        extra_kept = []
        for source in extra or []:
            inside, late = split_at(source, end, "date")
            extra_kept.append(inside)
            beyond = beyond.unionByName(late.select("series_id", F.lit(None).cast("date").alias("realtime_start"), "date", "value"))
        extra = extra_kept
        beyond.write.mode(mode).parquet(paths["quarantine"])
    panel = accumulate(require_rows(observations, "observations"))
    for source in extra or []:
        panel = join_registered_whole(panel, source, registry)
    raw = stored(panel, "raw")

    def checked(dates: DataFrame, transforms: str) -> DataFrame:
        # Stored, as every pass that uses the list would check all dates again.
        return materialize(with_checked_frequency(registry, dates, transforms), "checked") if check_frequency else registry

    if vintages is not None:
        vintages = materialize(first_vintages(vintages, registry), "vintages")
    monitored = checked(raw, "mon_transforms")
    store.write_features(apply_transforms(raw, monitored, "mon", check_frequency=False, own=own), paths["monitoring"], buckets, mode, watched("monitoring"))

    held = pit_runs(raw, vintages, registry, end=end)
    with guarded():
        watched("runs", "since").on(held if floors is None else covered(held, floors)).write.mode(mode).parquet(paths["runs"])
    held = spark.read.parquet(paths["runs"])
    pit = stored(spread(held), "pit")
    # The stored grid is daily for every series, so the list is checked on the dates behind it.
    listed = registry.where("is_vintage").select("series_id")
    dates = raw.select("series_id", "date", "value").join(listed, "series_id", "left_anti")
    if vintages is not None:
        dates = dates.unionByName(vintages.select("series_id", "date", F.col("any_value").alias("value")))
    features = apply_transforms(pit, checked(dates, "fm_transforms"), "fm", check_frequency=False, own=own, runs=held)
    store.write_features(features, paths["features"], buckets, mode, watched("features"))
    metrics(spark, watches).write.mode(mode).parquet(paths["metrics"])
    return paths
