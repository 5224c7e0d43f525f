"""Backward matching and expanding statistics of one very long series over several tasks.

A window over a series is one task, however many there are.  Here a series is cut
into buckets of time and both needs are met as prefix sums are: every bucket is
worked on by itself, leaves a summary of one row, the summaries of a series (few:
its days divided by the width) are carried forward, and each bucket takes what
the ones before it left.  The rows are shuffled once, by series and bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.windows import merge_moments, running_moments

WIDTH = 1024
STAT = "struct<n: bigint, mean: double, m2: double, lo: double, hi: double>"


def time_bucket(day: Column, width: int = WIDTH) -> Column:
    """Number of the stretch of ``width`` days that a day lies in."""
    if width < 1:
        raise ValueError(f"width must be at least one day, got {width}")
    return F.floor(F.unix_date(day) / width)


def asof_last(
    left: DataFrame,
    right: DataFrame,
    left_on: str,
    right_on: str,
    by: Sequence[str],
    carry: Sequence[str],
    ties: Sequence[str] = (),
    width: int = WIDTH,
    one_per_day: bool = False,
) -> DataFrame:
    """As ``asof.asof_last`` with dates, each (by, stretch of days) being a task of its own.

    The left side may hold any number of rows of one day: distinct (by, day)
    pairs are matched and joined back.  ``one_per_day`` says that the left side
    consists of such pairs, none of them twice and no day missing: nothing is joined back then.
    """
    by = list(by)
    slot = [*by, "__bucket"]
    tie_names = [f"__tie{i}" for i in range(len(ties))]
    types = dict(right.dtypes)
    requests = left.select(*by, F.col(left_on).alias("__day"))
    requests = requests if one_per_day else requests.where(F.col("__day").isNotNull()).distinct()
    requests = requests.withColumns(
        {"__side": F.lit(1)}
        | {n: F.lit(None).cast(types[t]) for t, n in zip(ties, tie_names)}
        | {"__row": F.struct(*[F.lit(None).cast(types[c]).alias(c) for c in carry])}
    )
    history = right.where(F.col(right_on).isNotNull()).select(
        *by,
        F.col(right_on).alias("__day"),
        F.lit(0).alias("__side"),
        *[F.col(t).alias(n) for t, n in zip(ties, tie_names)],
        F.struct(*[F.col(c) for c in carry]).alias("__row"),
    )
    bucket = time_bucket(F.col("__day"), width)
    both = history.unionByName(requests).withColumn("__bucket", bucket)
    order = ["__day", "__side", *tie_names]
    known = F.when(F.col("__side") == 0, F.col("__row"))
    inside = Window.partitionBy(*slot).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(*by).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    keyed = F.lit(True)  # a missing key matches nothing
    for c in by:
        keyed = keyed & F.col(c).isNotNull()
    # The carried row of every bucket, also of those that hold requests only.
    summary = (
        both.groupBy(*slot)
        .agg(F.max_by(known, F.when(F.col("__side") == 0, F.struct("__day", *tie_names))).alias("__last"))
        .withColumn("__before", F.last("__last", ignorenulls=True).over(earlier))
        .select(*slot, "__before")
    )
    matched = (
        both.withColumn("__here", F.last(known, ignorenulls=True).over(inside))
        .where(F.col("__side") == 1)
        .join(summary, slot, "left")
        .select(*by, F.col("__day").alias(left_on), F.when(keyed, F.coalesce("__here", "__before")).alias("__hit"))
    )
    found = matched.select(*by, left_on, *[F.col(f"__hit.{c}").alias(c) for c in carry])
    return found if one_per_day else left.join(found, [*by, left_on], "left")


def expanding_moments(df: DataFrame, lag: int = 0, value: str = "value", by: str = "series_id", order: str = "date", width: int = WIDTH) -> DataFrame:
    """As ``windows.expanding_moments``, each (series, stretch of days) being a task of its own.

    Means and sums of squared deviations are merged pairwise, never subtracted.
    With a lag the statistics of a row go to the row ``lag`` places on, by a join
    on the place, which is as spread as the rows are.
    """
    placed = df.withColumn("__bucket", time_bucket(F.col(order), width))
    inside = Window.partitionBy(by, "__bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summary = placed.groupBy(by, "__bucket").agg(F.count(F.lit(1)).alias("rows"), running_moments(value).alias("stat"))
    # One array per series, as long as it has stretches: carried forward in date order.
    steps = F.array_sort(F.collect_list(F.struct("__bucket", "rows", "stat"))).alias("steps")
    empty = F.struct(
        F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"),
        F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"),
    ).cast(STAT)
    carried = F.array(F.struct(F.lit(0).cast("long").alias("rows"), empty.alias("stat")))

    def forward(acc, step):
        last = F.element_at(acc, -1)
        return F.concat(acc, F.array(F.struct((last["rows"] + step["rows"]).alias("rows"), merge_moments(last["stat"], step["stat"]).cast(STAT).alias("stat"))))

    before = (
        summary.groupBy(by)
        .agg(steps)
        .withColumn("carried", F.aggregate("steps", carried, forward))
        .select(by, F.inline(F.arrays_zip(F.col("steps.__bucket").alias("__bucket"), F.slice("carried", 1, F.size("steps")).alias("before"))))
    )
    rows = (
        placed.withColumns({"__pos": F.row_number().over(inside), "__here": running_moments(value, inside)})
        .join(before, [by, "__bucket"])
        .withColumns({"__pos": F.col("__pos") + F.col("before.rows"), "__stat": merge_moments(F.col("before.stat"), F.col("__here"))})
    )
    if lag:
        moved = rows.select(by, (F.col("__pos") + lag).alias("__pos"), F.col("__stat"))
        rows = rows.drop("__stat").join(moved, [by, "__pos"], "left")
    stat = F.col("__stat")
    flat = stat["lo"] == stat["hi"]
    return rows.select(
        *[F.col(c) for c in df.columns],
        F.coalesce(stat["n"], F.lit(0)).alias("exp_n"),
        F.when(flat, stat["lo"]).when(stat["n"] > 0, stat["mean"]).alias("exp_mean"),
        F.when(stat["n"] > 1, F.when(flat, F.lit(0.0)).otherwise(F.sqrt(stat["m2"] / (stat["n"] - 1)))).alias("exp_std"),
    )


def expanding_zscore(panel: DataFrame, min_periods: int = 60, lag: int = 0, width: int = WIDTH) -> DataFrame:
    """As ``transforms.expanding_zscore`` for panels with very long series."""
    z = F.try_divide(F.col("value") - F.col("exp_mean"), F.col("exp_std"))
    keep = [F.col(c) for c in panel.columns]
    return expanding_moments(panel, lag, width=width).select(*keep, F.when(F.col("exp_n") >= min_periods, z).alias("z"))
