"""Streaming accumulate-and-merge: late and revised observations onto a stored panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATE = "series_id string, date date, value double, ts timestamp, load_seq long"


def folded(rows: DataFrame, *order: str) -> DataFrame:
    """``series_id, date, value, ts``: the value observed last, and when; a missing value never replaces one.

    Two values of one instant are settled by ``order`` after the time, then by
    the larger value, so the result does not depend on the order of arrival.
    """
    seen = F.struct("ts", *order, "value")
    last = F.max(F.when(F.col("value").isNotNull(), seen))
    return (
        rows.groupBy("series_id", "date")
        .agg(last.alias("last"), F.max("ts").alias("missing_at"))
        .select("series_id", "date", "last.value", F.coalesce("last.ts", "missing_at").alias("ts"))
    )


def merge_stream(spark: SparkSession, observations: DataFrame, log_path: str, checkpoint: str, time: str = "ts"):
    """Start a query appending each micro-batch, already merged within itself, to a log of loads.

    A load is written under its batch number and replaces what a failed attempt
    of the same batch left there, so a batch replayed after a failure does not
    count twice.  However late a row comes, it is merged by its own time; the
    query keeps no state.  ``read_merged`` folds the log, ``compact`` shortens it.
    """

    def write_load(batch: DataFrame, batch_id: int) -> None:
        merged = folded(batch.withColumn("ts", F.col(time).cast("timestamp")))
        merged.withColumn("load_seq", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(
            f"{log_path}/load={batch_id}"
        )

    return (
        observations.writeStream.foreachBatch(write_load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _log(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.schema(STATE).option("recursiveFileLookup", "true").parquet(*paths)


def read_merged(spark: SparkSession, *log_paths: str) -> DataFrame:
    """The panel the logs stand for: the value observed last, of one instant that of the later load."""
    return folded(_log(spark, *log_paths), "load_seq").select("series_id", "date", "value")


def compact(spark: SparkSession, log_path: str, target: str) -> None:
    """Fold a log, its query stopped, into one load at ``target``, to be read along with the log that goes on."""
    rows = folded(_log(spark, log_path), "load_seq")
    rows.withColumn("load_seq", F.lit(-1).cast("long")).write.mode("errorifexists").parquet(target)
