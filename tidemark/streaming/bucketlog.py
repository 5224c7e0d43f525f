"""A log of loads that gets shorter: revisions by bucket, folded bucket by bucket.

A load is split by a hash of its series and touches only the buckets it has rows
for.  Folding makes one base per touched bucket out of its old base and its
loads; the other buckets keep theirs.  A version (``sources.versions``) names the
base of every bucket and the last load folded, so the change is visible at once,
readers of the version before are not disturbed, and what no version that may
still be read names is deleted afterwards.  Reading costs the bases and at most
the loads since the last folding, whatever the number of loads there ever was.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import versions
from tidemark.streaming.merge import STATE, folded

BUCKETS = 64
EMPTY = {"bases": {}, "folded": -1, "dropped": []}


def _write(rows: DataFrame, path: str, buckets: int) -> None:
    """One folder per bucket that has rows; a bucket made large by a hot series is split over files."""
    placed = rows.withColumn("bucket", F.pmod(F.xxhash64("series_id"), F.lit(buckets)).cast("int"))
    placed.hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(path)


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, hadoop = versions.filesystem(spark, path)
    folder = hadoop(path)
    return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []


def _open_loads(spark: SparkSession, path: str, folded_to: int) -> dict[int, list[int]]:
    """Whole loads that are not folded yet, with the buckets each has rows for."""
    out = {}
    for name in _children(spark, f"{path}/loads"):
        number = int(name.split("=")[1])
        if number > folded_to:
            inside = _children(spark, f"{path}/loads/{name}")
            if "_SUCCESS" in inside:  # written last: without it the attempt failed
                out[number] = [int(n.split("=")[1]) for n in inside if n.startswith("bucket=")]
    return dict(sorted(out.items()))


def _rows(spark: SparkSession, path: str, version: dict, loads: dict[int, list[int]], only: set[int] | None = None) -> DataFrame:
    """One scan over the bucket folders that count; their number is bounded by the bases and the open loads."""
    folders = [f"{path}/{base}/bucket={b}" for b, base in version["bases"].items() if only is None or int(b) in only]
    folders += [f"{path}/loads/load={n}/bucket={b}" for n, inside in loads.items() for b in inside]
    if not folders:
        return spark.createDataFrame([], STATE)
    return spark.read.schema(STATE).option("recursiveFileLookup", "true").parquet(*folders)


def append_stream(spark: SparkSession, observations: DataFrame, path: str, checkpoint: str, time: str = "ts", buckets: int = BUCKETS, fold_every: int = 16):
    """Start a query appending each micro-batch, merged within itself, and folding the log every ``fold_every`` loads."""

    def write_load(batch: DataFrame, number: int) -> None:
        merged = folded(batch.withColumn("ts", F.col(time).cast("timestamp")))
        append(spark, path, merged, number, buckets)
        if (number + 1) % fold_every == 0:
            compact(spark, path, buckets)

    return (
        observations.writeStream.foreachBatch(write_load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def append(spark: SparkSession, path: str, merged: DataFrame, number: int, buckets: int = BUCKETS) -> None:
    """Write one load under its number, unless it has been folded already: a batch replayed counts once."""
    if number <= (versions.current(spark, path) or EMPTY)["folded"]:
        return
    rows = merged.select("series_id", "date", "value", "ts", F.lit(number).cast("long").alias("load_seq"))
    _write(rows, f"{path}/loads/load={number}", buckets)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The panel the log stands for: the value observed last, of one instant that of the later load."""
    version = versions.current(spark, path) or EMPTY
    rows = _rows(spark, path, version, _open_loads(spark, path, version["folded"]))
    return folded(rows, "load_seq").select("series_id", "date", "value")


def compact(spark: SparkSession, path: str, buckets: int = BUCKETS) -> list[int]:
    """Fold the open loads into new bases of the buckets they touch; returns these buckets.

    Folders that no longer count are deleted by the next folding, not by this
    one, so a reader that opened the version before may finish.
    """
    known = versions.numbers(spark, path)
    version = versions.current(spark, path) or EMPTY
    loads = _open_loads(spark, path, version["folded"])
    if not loads:
        return []
    last, touched = max(loads), sorted({b for inside in loads.values() for b in inside})
    bases = dict(version["bases"])
    if touched:
        name = f"base-{uuid.uuid4().hex}"
        rows = folded(_rows(spark, path, version, loads, set(touched)), "load_seq")
        _write(rows.withColumn("load_seq", F.lit(last).cast("long")), f"{path}/{name}", buckets)
        bases |= {str(b): name for b in touched}
    gone = sorted(set(version["bases"].values()) - set(bases.values())) + [f"loads/load={n}" for n in loads]
    versions.publish(spark, path, {"bases": bases, "folded": last, "dropped": gone}, after=known[-1] if known else 0)
    for old in version["dropped"]:
        versions.remove(spark, path, old)
    return touched
