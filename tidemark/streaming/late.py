"""Streaming last value per key and window, with the late rows kept aside instead of dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.streaming.resample import utc_day

PARTIAL = "series_id string, opens timestamp, closes timestamp, last struct<ts: timestamp, value: double>, n long, batch long"
CLOCK = "seen timestamp, batch long"


def _clock(spark: SparkSession, path: str, before: int | None = None):
    """Latest instant seen, of the batches before ``before`` if given; None before the first."""
    try:
        batches = spark.read.schema(CLOCK).parquet(f"{path}/clock")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None
    batches = batches if before is None else batches.where(F.col("batch") < before)
    return batches.agg(F.max("seen")).first()[0]


def resample_keeping_late(
    events: DataFrame, path: str, checkpoint: str, key: str, value: str, time: str = "ts", late: str = "1 day", width: str = "1 day"
):
    """Start a query that splits every micro-batch on the windows closed before it.

    A window is closed once an earlier batch has seen an instant ``late`` after
    its end.  Rows of open windows are folded to one row per key and window below
    ``<path>/partial``; rows of closed ones, and rows without an instant, are
    written whole to ``<path>/late``.  Every batch writes under its own number
    and replaces what a failed attempt left, so on-time and late rows together
    are the input, each once.
    """
    spark = events.sparkSession

    def split(batch: DataFrame, number: int) -> None:
        seen = _clock(spark, path, before=number)
        # A window drops rows without an instant; any instant will do, as they are late in any case.
        placed = batch.withColumn("__window", F.window(F.coalesce(time, F.lit(0).cast("timestamp")), width))
        closed = F.col(time).isNull()
        if seen is not None:
            edge = F.lit(seen) - F.expr(f"interval {late}")
            closed = closed | (F.col("__window.end") <= edge)
        placed = placed.withColumn("__late", F.coalesce(closed, F.lit(True)))
        placed.persist()
        try:
            placed.where("__late").drop("__window", "__late").write.mode("overwrite").parquet(f"{path}/late/batch={number}")
            (
                placed.where(~F.col("__late"))
                .groupBy(F.col(key).cast("string").alias("series_id"), F.col("__window.start").alias("opens"), F.col("__window.end").alias("closes"))
                .agg(
                    F.max(F.struct(F.col(time).alias("ts"), F.col(value).cast("double").alias("value"))).alias("last"),
                    F.count(F.lit(1)).alias("n"),
                )
                .withColumn("batch", F.lit(number).cast("long"))
                .write.mode("overwrite")
                .parquet(f"{path}/partial/batch={number}")
            )
            clock = placed.agg(F.max(time).alias("seen")).withColumn("batch", F.lit(number).cast("long"))
            clock.write.mode("overwrite").parquet(f"{path}/clock/batch={number}")
        finally:
            placed.unpersist()

    return (
        events.writeStream.foreachBatch(split).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def closed_windows(spark: SparkSession, path: str, late: str = "1 day") -> DataFrame:
    """Last value and number of rows of every window that no later row can change any more."""
    seen = _clock(spark, path)
    rows = spark.read.schema(PARTIAL).option("recursiveFileLookup", "true").parquet(f"{path}/partial")
    done = rows.where(F.lit(False)) if seen is None else rows.where(F.col("closes") <= F.lit(seen) - F.expr(f"interval {late}"))
    return (
        done.groupBy("series_id", "opens")
        .agg(F.max("last").alias("last"), F.sum("n").alias("n"))
        .select(utc_day(F.col("opens")).alias("date"), "series_id", "last.value", "n")
    )


def on_time_rows(spark: SparkSession, path: str) -> int:
    """Rows taken into windows so far, open ones included."""
    rows = spark.read.schema(PARTIAL).option("recursiveFileLookup", "true").parquet(f"{path}/partial")
    return rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def late_rows(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows that came after their window was closed, as they came."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{path}/late")
