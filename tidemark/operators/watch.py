"""Checks and counts made in the pass that writes a table, so that no row is read a second time for them.

``stop_where`` fails the pass on a wrong row; ``Watch`` collects the counts of a
table with ``DataFrame.observe`` while it is written.  A watch belongs behind the
last shuffle before the write: there each partition counts once, whatever tasks
were repeated after a lost executor.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.asof import calendar_side
from tidemark.operators.runs import first_weekday, weekdays_between

GUARD = "guard failed: "
METRICS = "stage string, n_rows bigint, n_valued bigint, first_date date, last_date date"


def stop_where(df: DataFrame, wrong: Column, column: str, *message: Column | str) -> DataFrame:
    """``df``, failing the pass that reads ``column`` at a row for which ``wrong`` holds (NULL does not)."""
    text = F.concat_ws("", F.lit(GUARD), *message)
    raised = F.raise_error(text).cast(df.schema[column].dataType)
    return df.withColumn(column, F.when(F.coalesce(wrong, F.lit(False)), raised).otherwise(F.col(column)))


@contextmanager
def guarded() -> Iterator[None]:
    """A pass that ``stop_where`` ends shows as a ``ValueError`` with its message; every other failure stays as it is."""
    try:
        yield
    except Exception as e:
        found = re.search(re.escape(GUARD) + r"(.*?)(?: SQLSTATE.*)?$", str(e), re.MULTILINE)
        if found is None:
            raise
        raise ValueError(found.group(1)) from e


class Watch:
    """Rows, values and dates of one table, known when its write is over."""

    def __init__(self, stage: str, date: str = "date"):
        self.stage, self.date = stage, date
        self._seen = Observation()

    def on(self, df: DataFrame) -> DataFrame:
        return df.observe(
            self._seen,
            F.count(F.lit(1)).alias("n_rows"),
            F.count("value").alias("n_valued"),
            F.min(self.date).alias("first_date"),
            F.max(self.date).alias("last_date"),
        )

    def row(self) -> tuple:
        """The row of ``METRICS``; waits for the write it belongs to."""
        seen = self._seen.get
        return (self.stage, seen["n_rows"], seen["n_valued"], seen["first_date"], seen["last_date"])


def metrics(spark: SparkSession, watches: list[Watch]) -> DataFrame:
    """One row per watched table."""
    return spark.createDataFrame([w.row() for w in watches], METRICS)


def covered(held: DataFrame, floors: DataFrame) -> DataFrame:
    """The runs ``held``, failing the pass on a protected series that starts too late or has too few grid days.

    ``floors`` as in ``quality.coverage_violations``: ``series_id, first_by,
    min_n``; of several floors of one series each holds.  First day and number
    of days of a series are window sums over its runs, which lie together where
    they are made; the floors are joined to them, however many they are.
    """
    strictest = floors.groupBy("series_id").agg(F.min("first_by").alias("__first_by"), F.max("min_n").alias("__min_n"))
    series = Window.partitionBy("series_id")
    counted = held.withColumns(
        {
            "__first": F.min(first_weekday(F.col("since"))).over(series),
            "__n": F.sum(weekdays_between(F.col("since"), F.col("until"))).over(series),
        }
    ).join(strictest, "series_id", "left")
    # A missing floor or bound says nothing; what the other one says counts.
    late = F.coalesce(F.col("__first") > F.col("__first_by"), F.lit(False))
    few = F.coalesce(F.col("__n") < F.col("__min_n"), F.lit(False))
    checked = stop_where(
        counted, late | few, "value", F.lit("protected history is too short: series "), "series_id",
        F.lit(" from "), F.col("__first").cast("string"), F.lit(" with "), F.col("__n").cast("string"), F.lit(" days"),
    )
    return checked.select(*held.columns)


def join_registered_whole(panel: DataFrame, extra: DataFrame, registry: DataFrame) -> DataFrame:
    """As ``merge.join_registered``, failing the pass where a value would be lost.

    Lost is a value of a registered series between the first and the last date
    of the panel on a date the panel does not have.  Values outside that range
    and missing ones are out of scope and drop as before.
    """
    listed = registry.where(F.col("lag").isNotNull()).select("series_id")
    days = calendar_side(panel)
    lo, hi = (days.agg(f("date")).scalar() for f in (F.min, F.max))
    placed = extra.select("series_id", "date", "value").join(listed, "series_id", "left_semi")
    placed = placed.join(days.withColumn("__known", F.lit(True)), "date", "left")
    lost = F.col("__known").isNull() & F.col("value").isNotNull() & F.col("date").between(lo, hi)
    checked = stop_where(
        placed.where(F.col("__known").isNotNull() | lost), F.col("__known").isNull(), "value",
        F.lit("values lost when joining onto the panel dates: series "), "series_id", F.lit(" at "), F.col("date").cast("string"),
    )
    return panel.select("series_id", "date", "value").unionByName(checked.select("series_id", "date", "value"))
