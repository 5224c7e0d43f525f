"""Merging observations without losing history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.asof import calendar_side
from tidemark.operators.calendar import resample_last

KEY = ("series_id", "date")


def accumulate(*batches: DataFrame) -> DataFrame:
    """Union of batches, oldest first: a newer value wins, a newer missing one does not.

    One combinable aggregation per key and day; no sort, no join.
    """
    stacked = None
    for seq, batch in enumerate(batches):
        tagged = batch.select("series_id", "date", "value", F.lit(seq).alias("load_seq"))
        stacked = tagged if stacked is None else stacked.unionByName(tagged)
    return accumulate_by(stacked, "load_seq")


def accumulate_by(rows: DataFrame, order: str) -> DataFrame:
    """As ``accumulate`` for rows already carrying their load order."""
    # A NULL order is never the maximum, so missing values lose without a filter.
    rank = F.when(F.col("value").isNotNull(), F.col(order))
    return rows.groupBy(*KEY).agg(F.max_by("value", rank).alias("value"))


def refresh_window(stored: DataFrame, incoming: DataFrame, overlap_days: int = 7) -> DataFrame:
    """Incoming rows from ``overlap_days`` before the stored end of their series; new series whole."""
    ends = stored.groupBy("series_id").agg(F.max("date").alias("stored_end"))
    joined = incoming.join(ends, "series_id", "left")
    fresh = F.col("stored_end").isNull() | (F.col("date") >= F.date_sub("stored_end", overlap_days))
    return joined.where(fresh).select(*incoming.columns)


def refresh(stored: DataFrame, incoming: DataFrame, overlap_days: int = 7) -> DataFrame:
    """Incremental refresh: the overlapping tail of the new batch merged onto the store."""
    return accumulate(stored, refresh_window(stored, incoming, overlap_days))


def splice(canonical: DataFrame, deep: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """Canonical values where there are any, deep history elsewhere.

    ``index`` (distinct dates) restricts the result to the canonical calendar.
    """
    out = accumulate(deep, canonical)
    return out if index is None else out.join(calendar_side(index), "date", "left_semi").select(*KEY, "value")


def splice_origin(canonical: DataFrame, deep: DataFrame) -> DataFrame:
    """As ``splice`` without an index, with the store each value comes from in ``origin``."""
    both = canonical.select(*KEY, "value", F.lit("canonical").alias("origin"), F.lit(1).alias("rank")).unionByName(
        deep.select(*KEY, "value", F.lit("deep").alias("origin"), F.lit(0).alias("rank"))
    )
    rank = F.when(F.col("value").isNotNull(), F.col("rank"))
    return both.groupBy(*KEY).agg(F.max_by("value", rank).alias("value"), F.max_by("origin", rank).alias("origin"))


def splice_monthly(canonical: DataFrame, deep: DataFrame) -> DataFrame:
    """Splice at month ends, not held to the canonical calendar."""
    return splice(resample_last(canonical, "ME"), resample_last(deep, "ME"))


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key in ``order``, by a combinable aggregation."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    return picked.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest])


def insert_ignore(target: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Incoming rows whose key the target does not hold: what to append.

    Of several incoming rows with one key the first in ``order`` is kept (any,
    when no order is given).
    """
    keys = list(keys)
    if order:
        rest = [c for c in incoming.columns if c not in keys]
        first = incoming.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__row"))
        unique = first.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest]).select(*incoming.columns)
    else:
        unique = incoming.dropDuplicates(keys)
    return unique.join(target.select(*keys), keys, "left_anti")


def join_registered(panel: DataFrame, extra: DataFrame, registry: DataFrame) -> DataFrame:
    """Panel plus the rows of ``extra`` whose series has a lag and whose date the panel knows.

    Long form of a left join onto the panel's dates: off-grid dates drop.
    """
    listed = registry.where(F.col("lag").isNotNull()).select("series_id")
    days = calendar_side(panel)
    kept = extra.join(listed, "series_id", "left_semi").join(days, "date", "left_semi")
    return panel.select(*KEY, "value").unionByName(kept.select(*KEY, "value"))


