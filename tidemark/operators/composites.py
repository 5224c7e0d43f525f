"""Series built from several series.

A composite is a row of a *legs* table ``(composite_id, role, series_id)``: any
number of composites of one kind is computed together.  Legs are brought side by
side by a conditional aggregation per (composite, day), never by a chain of
joins.  Whether gaps are carried forward, dropped or left is part of each
definition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import pct_change, ratio
from tidemark.operators.asof import asof_last
from tidemark.operators.calendar import resample_last
from tidemark.operators.transforms import rolling_zscore
from tidemark.operators.windows import by_date, months_back, so_far


def legs_table(df: DataFrame, composite_id: str, roles: dict[str, Column | str]) -> DataFrame:
    """Legs rows from a table with one row per composite and a column per role."""
    cols = {r: (F.col(c) if isinstance(c, str) else c) for r, c in roles.items()}
    pairs = F.array(*[F.struct(F.lit(r).alias("role"), c.alias("series_id")) for r, c in cols.items()])
    return df.select(F.col(composite_id).alias("composite_id"), F.inline(pairs))


def align_legs(panel: DataFrame, legs: DataFrame, roles: Sequence[str], ffill: bool = False) -> DataFrame:
    """One row per (composite_id, date) any leg is observed on, one column per role."""
    side = panel.join(legs, "series_id")
    wide = side.groupBy("composite_id", "date").agg(
        *[F.max(F.when(F.col("role") == r, F.col("value"))).alias(r) for r in roles]
    )
    if not ffill:
        return wide
    return wide.select("composite_id", "date", *[F.last(r, ignorenulls=True).over(so_far("composite_id")).alias(r) for r in roles])


def _present(df: DataFrame, roles: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(roles))


def _out(df: DataFrame, value: Column) -> DataFrame:
    return df.select("composite_id", "date", value.alias("value"))


def net_of_two(panel: DataFrame, legs: DataFrame) -> DataFrame:
    """``a/1000 - b/1000 - c`` with all legs carried forward (a, b in millions, c in billions)."""
    t = align_legs(panel, legs, ["a", "b", "c"], ffill=True)
    return _out(t, F.col("a") / 1000.0 - F.col("b") / 1000.0 - F.col("c"))


def spread_bps(panel: DataFrame, legs: DataFrame) -> DataFrame:
    """``(x - y) * 100`` on days both are observed."""
    t = _present(align_legs(panel, legs, ["x", "y"]), ["x", "y"])
    return _out(t, (F.col("x") - F.col("y")) * 100.0)


def spread(panel: DataFrame, legs: DataFrame) -> DataFrame:
    """``x - y`` on every day either is observed; one-sided days stay as NULL."""
    t = align_legs(panel, legs, ["x", "y"])
    return _out(t, F.col("x") - F.col("y"))


def growth_differential(panel: DataFrame, legs: DataFrame) -> DataFrame:
    """Difference of calendar year-over-year changes, at month starts."""
    t = align_legs(resample_last(panel, "MS"), legs, ["m", "c"])
    m0, c0 = (months_back(x, 12, "composite_id") for x in ("m", "c"))
    return _out(
        t.withColumns({"__m0": m0, "__c0": c0}),
        pct_change(F.col("m"), F.col("__m0")) - pct_change(F.col("c"), F.col("__c0")),
    )


def ratio_scaled(panel: DataFrame, legs: DataFrame, scale: float = 0.001) -> DataFrame:
    """``x * scale / y`` with both legs carried forward; days before both start are dropped.

    Also serves mixed frequencies: a daily leg over a monthly one.
    """
    t = _present(align_legs(panel, legs, ["x", "y"], ffill=True), ["x", "y"])
    return _out(t, ratio(F.col("x") * F.lit(float(scale)), F.col("y")))


def three_term_balance(panel: DataFrame, legs: DataFrame) -> DataFrame:
    """``a + b - d`` with all legs carried forward, from the day all have started."""
    t = _present(align_legs(panel, legs, ["a", "b", "d"], ffill=True), ["a", "b", "d"])
    return _out(t, F.col("a") + F.col("b") - F.col("d"))


def _as_series(composite: DataFrame) -> DataFrame:
    return composite.withColumnRenamed("composite_id", "series_id")


def month_end_ratio(panel: DataFrame, legs: DataFrame, scale: float = 1.0) -> DataFrame:
    """``x * scale / y`` at month ends where both have a value in that month.

    Months in which only one leg is observed stay as NULL rows: an unfinished
    last month never mixes this month's x with last month's y.
    """
    t = align_legs(resample_last(panel, "ME"), legs, ["x", "y"])
    return _out(t, ratio(F.col("x") * F.lit(float(scale)), F.col("y")))


def ratio_with_monthly_z(panel: DataFrame, legs: DataFrame, scale: float = 1000.0, window: int = 60) -> DataFrame:
    """Daily ratio line and, from month-end ratios, its full-window z held until the next month end."""
    line = ratio_scaled(panel, legs, scale)
    monthly = _as_series(month_end_ratio(panel, legs, scale))
    # Every calendar month is a row, so a gap counts as a missing value, not as
    # no row: each month also emits the empty months up to the next one.
    this = F.trunc("date", "month")
    following = F.add_months(F.trunc(F.lead("date").over(by_date()), "month"), -1)
    spans = monthly.withColumn("until", F.coalesce(following, this))
    filled = spans.withColumn("month", F.explode(F.sequence(this, "until", F.expr("interval 1 month")))).select(
        "series_id", F.last_day("month").alias("date"), F.when(F.col("month") == this, F.col("value")).alias("value")
    )
    z = rolling_zscore(filled, window, min_periods=window)
    labels = z.select(F.col("series_id").alias("composite_id"), F.col("date").alias("label"), "z")
    return asof_last(
        line.withColumnRenamed("value", "ratio"), labels, "date", "label", by=["composite_id"], carry=["z"], one_per_day=True
    )


def ratio_excess_growth(panel: DataFrame, legs: DataFrame, window: int = 60) -> DataFrame:
    """Month-end ``x/1000/y*100``, its full-window z, and the growth of x over that of y.

    Rows are months with both legs; growth compares calendar months.
    """
    t = align_legs(resample_last(panel, "ME"), legs, ["x", "y"])
    x0, y0 = (months_back(x, 12, "composite_id").alias(f"{x}0") for x in ("x", "y"))
    full = _present(t.select("*", x0, y0), ["x", "y"])
    rows = full.select(
        F.col("composite_id").alias("series_id"),
        "date",
        (ratio(F.col("x") / 1000.0, F.col("y")) * 100.0).alias("value"),
        (pct_change(F.col("x"), F.col("x0")) - pct_change(F.col("y"), F.col("y0"))).alias("excess_growth"),
    )
    return rolling_zscore(rows, window, min_periods=window).select(
        F.col("series_id").alias("composite_id"), "date", F.col("value").alias("ratio_pct"), "z", "excess_growth"
    )


def net_of_two_hybrid_change(panel: DataFrame, legs: DataFrame, cutover: str, periods: int = 252) -> DataFrame:
    """Row-counted change in percent of ``net_of_two`` on a grid that is dense before ``cutover``.

    Before the cut-over every business day is a row and a blank c counts as
    zero; from it on only days c is observed are rows.  a and b count where they
    fall on the grid and are carried forward from there.
    """
    cut = F.to_date(F.lit(cutover))
    t = align_legs(panel, legs, ["a", "b", "c"])
    # Each early row emits the business days up to the next one.
    until = F.least(F.coalesce(F.date_sub(F.lead("date").over(by_date("composite_id")), 1), cut), F.date_sub(cut, 1))
    spans = t.withColumn("until", until).where(F.col("date") < cut)
    days = spans.withColumn("day", F.explode(F.sequence("date", "until"))).where(F.weekday("day") < 5)
    own = F.col("day") == F.col("date")
    early = days.select(
        "composite_id",
        F.col("day").alias("date"),
        F.when(own, F.col("a")).alias("a"),
        F.when(own, F.col("b")).alias("b"),
        F.coalesce(F.when(own, F.col("c")), F.lit(0.0)).alias("c"),
    )
    grid = early.unionByName(t.where((F.col("date") >= cut) & F.col("c").isNotNull()))
    a, b = (F.last(x, ignorenulls=True).over(so_far("composite_id")) for x in ("a", "b"))
    net = grid.select("composite_id", "date", (a / 1000.0 - b / 1000.0 - F.col("c")).alias("net"))
    base = F.lag("net", periods).over(by_date("composite_id"))
    return _out(net.withColumn("__change", pct_change(F.col("net"), base)), F.col("__change"))


def notional(panel: DataFrame, face_values: DataFrame) -> DataFrame:
    """Contracts times face value, in billions; series without a face value are left out."""
    return panel.join(face_values.select("series_id", "face_value"), "series_id").select(
        "series_id", "date", (F.col("value") * F.col("face_value") / 1e9).alias("value")
    )


def band(panel: DataFrame, legs: DataFrame) -> DataFrame:
    """Lower and upper bound per day."""
    return align_legs(panel, legs, ["lower", "upper"])
