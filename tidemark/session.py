"""Session helpers: the shared scratch folder and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session that names none (tests, a laptop) gets a temporary
    folder; on a cluster a machine-local folder would be lost with its host.
    """
    named = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set(CHECKPOINT_CONF, made)
    return made


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; nothing is ever overwritten there."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a plan computed once.

    Unlike a cache it survives the loss of executors, and unlike a plain reuse
    it cuts the lineage for several downstream sinks.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
