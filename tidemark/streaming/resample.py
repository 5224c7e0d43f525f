"""Streaming last value per key and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def utc_day(ts: Column) -> Column:
    """Day of an instant in UTC, whatever the time zone of the session; windows of a day start there too."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(ts) / 86_400).cast("int"))


def late_rows(query) -> int:
    """Rows that came after their window was closed, so far, of the batches that the query still reports."""
    return sum(int(s["numRowsDroppedByWatermark"]) for p in query.recentProgress for s in p["stateOperators"])


def resample_stream(events: DataFrame, key: str, value: str, time: str = "ts", late: str = "1 day", width: str = "1 day") -> DataFrame:
    """Last value per key and window, final once the watermark has passed the window.

    The state is one row per key and open window, never the events.  Rows for a
    closed window cannot change it any more; ``late_rows`` counts them.
    """
    return (
        events.withWatermark(time, late)
        .groupBy(F.window(time, width), F.col(key).alias("series_id"))
        .agg(F.max_by(value, time).alias("value"), F.count("*").alias("n"))
        .select(utc_day(F.col("window.start")).alias("date"), "series_id", "value", "n")
    )
