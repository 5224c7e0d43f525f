"""Rolling and expanding moments over the rows of a series.

Spark evaluates a sliding frame from scratch for every row, which costs
rows x width.  ``rolling_moments`` therefore cuts each series into blocks as
long as the window: any window is then the tail of one block plus the head of
the next, and head and tail statistics are running aggregates.  The cost per
row does not depend on the width, and since nothing is ever subtracted there is
no cancellation as with differences of prefix sums.  All passes share one hash
partitioning by series, so there is a single shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def by_date(key: str | Sequence[str] = "series_id") -> WindowSpec:
    """Rows of one key in date order: at most one per calendar day."""
    return Window.partitionBy(key).orderBy("date")


def so_far(key: str = "series_id") -> WindowSpec:
    """Rows of one key up to the current one."""
    return by_date(key).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def months_back(value: str, months: int, key: str = "series_id") -> Column:
    """Value of the same key exactly ``months`` calendar months earlier, NULL when that month has no row.

    A range frame over the month number: no self-join, and a gap never moves the
    comparison to its neighbour.
    """
    month = F.year("date") * 12 + F.month("date")
    return F.max(value).over(Window.partitionBy(key).orderBy(month).rangeBetween(-months, -months))


def merge_moments(a: Column, b: Column) -> Column:
    """Combine the statistics of two disjoint row sets; either may be empty."""
    n = a["n"] + b["n"]
    delta = b["mean"] - a["mean"]
    both = F.struct(
        n.alias("n"),
        (a["mean"] + delta * (b["n"] / n)).alias("mean"),
        (a["m2"] + b["m2"] + delta * delta * (a["n"] * b["n"] / n)).alias("m2"),
        F.least(a["lo"], b["lo"]).alias("lo"),
        F.greatest(a["hi"], b["hi"]).alias("hi"),
    )
    return F.when(a.isNull() | (a["n"] == 0), b).when(b["n"] == 0, a).otherwise(both)


def running_moments(value: str, over: WindowSpec | None = None) -> Column:
    """Statistics of the non-missing values of a running frame, or of a group; m2 is the sum of squared deviations."""

    def stat(aggregate: Column) -> Column:
        return aggregate if over is None else aggregate.over(over)

    n = stat(F.count(value))
    return F.struct(
        n.alias("n"),
        F.coalesce(stat(F.avg(value)), F.lit(0.0)).alias("mean"),
        (F.coalesce(stat(F.var_pop(value)), F.lit(0.0)) * n).alias("m2"),
        stat(F.min(value)).alias("lo"),
        stat(F.max(value)).alias("hi"),
    )


def rolling_moments(
    df: DataFrame,
    window: int | str,
    lag: int = 0,
    value: str = "value",
    by: str | Sequence[str] = "series_id",
    order: str = "date",
    widths: Sequence[int] | None = None,
) -> DataFrame:
    """Adds ``roll_n``, ``roll_mean``, ``roll_std`` over the ``window`` rows ending ``lag`` rows back.

    ``window`` is a number, or the name of a column holding one width per ``by``
    group, so series with different windows share one pass.  The standard
    deviation is the sample one; NULL for fewer than two values.

    ``widths`` are all widths the column can hold, if they are few: rows a width
    back are then looked up in the order at hand, which saves a sort.  Any other
    width fails the job.
    """
    if lag < 0 or (isinstance(window, int) and window < 1):
        raise ValueError(f"window must be >= 1 and lag >= 0, got {window} and {lag}")
    by = [by] if isinstance(by, str) else list(by)
    rows = Window.partitionBy(*by).orderBy(order)
    width = F.lit(window) if isinstance(window, int) else F.col(window)
    block = Window.partitionBy(*by, "__block")
    head = block.orderBy("__pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = block.orderBy(F.desc("__pos")).rowsBetween(Window.unboundedPreceding, -1)
    blocked = (
        df.withColumn("__pos", F.row_number().over(rows) - 1)
        .withColumn("__block", F.floor(F.col("__pos") / width).cast("int"))
        .withColumn("__after", running_moments(value, after))
    )
    # The window of a row is its block up to the row, plus the rows of the block
    # before that come after the same position; the last position needs none.
    if isinstance(window, int) or widths:
        # Ordered like the head frames, so that both passes share one sort.
        placed = Window.partitionBy(*by).orderBy("__block", "__pos")
        if isinstance(window, int):
            before = F.lag("__after", window).over(placed)
        else:
            before = F.raise_error(F.concat(F.lit("window of a width not given: "), width.cast("string")))
            for n in sorted(set(widths)):
                before = F.when(width == n, F.lag("__after", n).over(placed)).otherwise(before)
    else:
        blocked = blocked.withColumn("__offset", F.col("__pos") % width)
        before = F.lag("__after", 1).over(Window.partitionBy(*by, "__offset").orderBy("__block"))
    out = (
        blocked.withColumn("__before", before)
        .withColumn("__head", running_moments(value, head))
        .withColumn("__stat", merge_moments(F.col("__before"), F.col("__head")))
    )
    if lag:
        out = out.withColumn("__stat", F.lag("__stat", lag).over(Window.partitionBy(*by).orderBy("__block", "__pos")))
    stat = F.col("__stat")
    # A constant window has exactly zero spread, whatever rounding did to its mean.
    flat = stat["lo"] == stat["hi"]
    return out.withColumns(
        {
            "roll_n": F.coalesce(stat["n"], F.lit(0)),
            "roll_mean": F.when(flat, stat["lo"]).when(stat["n"] > 0, stat["mean"]),
            "roll_std": F.when(stat["n"] > 1, F.when(flat, F.lit(0.0)).otherwise(F.sqrt(stat["m2"] / (stat["n"] - 1)))),
        }
    ).drop("__pos", "__block", "__offset", "__after", "__head", "__before", "__stat")


def expanding_moments(
    df: DataFrame, lag: int = 0, value: str = "value", by: str | Sequence[str] = "series_id", order: str = "date"
) -> DataFrame:
    """Adds ``exp_n``, ``exp_mean``, ``exp_std`` over all rows up to ``lag`` rows back."""
    frame = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, -lag)
    return df.withColumns(
        {
            "exp_n": F.count(value).over(frame),
            "exp_mean": F.avg(value).over(frame),
            "exp_std": F.stddev_samp(value).over(frame),
        }
    )
