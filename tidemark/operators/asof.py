"""Backward as-of matching: the latest right row at or before each left row.

Never a ``<=`` join followed by a maximum, which pairs every left row with the
whole history before it.  Two linear plans instead:

* ``asof_last``: union of both sides, one sort per key, last right row carried
  forward.  For distinct (key, day) requests.
* ``validity`` / ``spread_on_days``: when the requests are a calendar, each
  right row knows the days it is valid for and produces them itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_last(
    left: DataFrame,
    right: DataFrame,
    left_on: str,
    right_on: str,
    by: Sequence[str],
    carry: Sequence[str],
    ties: Sequence[str] = (),
    one_per_day: bool = False,
) -> DataFrame:
    """Left rows plus ``carry`` columns of the latest right row with ``right_on <= left_on``.

    A matched right row keeps its NULLs (they are carried as one struct); a left
    row without match gets NULLs.  Among right rows of the same day the last in
    ``ties`` order wins.

    ``one_per_day`` says the left side holds at most one row per (by, day): its
    rows then pass through the window themselves.  Otherwise each distinct
    (by, day) is matched once and joined back, so a key holding most of the facts
    is spread over its days.
    """
    by = list(by)
    extra = [c for c in left.columns if c not in (*by, left_on)] if one_per_day else []
    asked = left if one_per_day else left.select(*by, left_on).where(F.col(left_on).isNotNull()).distinct()
    right_types, left_types = dict(right.dtypes), dict(left.dtypes)
    tie_names = [f"__tie{i}" for i in range(len(ties))]

    def nulls(columns, types):
        return F.struct(*[F.lit(None).cast(types[c]).alias(c) for c in columns])

    requests = asked.select(
        *by,
        F.col(left_on).alias("__ts"),
        F.lit(1).alias("__side"),
        *[F.lit(None).cast(right_types[t]).alias(n) for t, n in zip(ties, tie_names)],
        nulls(carry, right_types).alias("__row"),
        *[F.col(c).alias(f"__left_{c}") for c in extra],
    )
    history = right.where(F.col(right_on).isNotNull()).select(
        *by,
        F.col(right_on).alias("__ts"),
        F.lit(0).alias("__side"),
        *[F.col(t).alias(n) for t, n in zip(ties, tie_names)],
        F.struct(*[F.col(c) for c in carry]).alias("__row"),
        *[F.lit(None).cast(left_types[c]).alias(f"__left_{c}") for c in extra],
    )
    seen = (
        Window.partitionBy(*by)
        .orderBy("__ts", "__side", *tie_names)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    matched = (
        history.unionByName(requests)
        .withColumn("__hit", F.last(F.when(F.col("__side") == 0, F.col("__row")), ignorenulls=True).over(seen))
        .where(F.col("__side") == 1)
        .select(
            *by,
            F.col("__ts").alias(left_on),
            *[F.col(f"__left_{c}").alias(c) for c in extra],
            *[F.col(f"__hit.{c}").alias(c) for c in carry],
        )
    )
    return matched if one_per_day else left.join(matched, [*by, left_on], "left")


#: Series of one task in a pass over series: a series is bounded by the calendar, so this bounds the task.
SERIES_A_TASK = 128


def series_tasks(series: DataFrame) -> int:
    """Number of tasks for a pass over all of ``series``, a table with a row per series (a registry): it grows with their number.

    Adaptive execution sizes tasks by compressed bytes, and held values compress
    so well that few tasks would get all series.
    """
    return max(1, -(-series.count() // SERIES_A_TASK))


def calendar_side(df: DataFrame, date: str = "date", name: str = "date") -> DataFrame:
    """Distinct days of ``df``, sent to every task: a calendar is short, the rows matched with it must not be shuffled by day."""
    return F.broadcast(df.select(F.col(date).alias(name)).distinct())


def validity(
    rows: DataFrame, start: str, ties: Sequence[str] = (), end: Column | None = None, key: str | Sequence[str] = "series_id"
) -> DataFrame:
    """Adds ``valid_to``: the last day a row is the latest one of its series.

    The next row of the same series ends it; the last row stays valid up to
    ``end`` (every series is held to the same global end).  A row replaced on
    its own day gets ``valid_to < start``.
    """
    order = Window.partitionBy(key).orderBy(start, *ties)
    last_day = F.date_sub(F.lead(start).over(order), 1)
    return rows.withColumn("valid_to", last_day if end is None else F.coalesce(last_day, end))


def spread_on_days(rows: DataFrame, start: str, day: str, weekdays_only: bool = False) -> DataFrame:
    """One output row per day of ``[start, valid_to]``; rows valid on no day vanish."""
    alive = rows.where(F.col(start) <= F.col("valid_to"))
    out = alive.withColumn(day, F.explode(F.sequence(F.col(start), F.col("valid_to")))).drop("valid_to")
    return out.where(F.weekday(day) < 5) if weekdays_only else out
