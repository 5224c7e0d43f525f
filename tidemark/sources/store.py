"""Panel and vintage stores on parquet.

Two layouts, for two kinds of reading:

* ``write_panel`` / ``read_panel``: folders by a hash bucket of the series id, not
  one folder per series.  The number of folders stays fixed for millions of
  series, a named series prunes to one folder, and sorting inside the files lets
  row-group statistics skip the rest.  A hot bucket is split over files.
* ``save_panel_table`` / ``open_panel_table``: a table bucketed by series id, for
  passes over everything.  Windows, aggregations and joins by series then need
  no shuffle at all.  Only for panels, where a series is bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
import pyarrow
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.watch import Watch
from tidemark.schema import PANEL, VINTAGE

BUCKETS = 256


def _bucket(series_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(series_id), F.lit(buckets)).cast("int")


def write_store(
    df: DataFrame, path: str, sort: Sequence[str], buckets: int = BUCKETS, mode: str = "errorifexists", watch: Watch | None = None
) -> None:
    """Write rows bucketed by series and sorted; AQE splits a bucket a hot series makes too large.

    ``watch`` counts the rows on their way to the files.
    """
    laid_out = df.withColumn("bucket", _bucket(F.col("series_id"), buckets)).hint("rebalance", F.col("bucket"))
    if watch is not None:
        laid_out = watch.on(laid_out)
    (
        laid_out.sortWithinPartitions("bucket", *sort)
        .write.mode(mode)
        .partitionBy("bucket")
        .option("compression", "snappy")
        .parquet(path)
    )


def write_panel(panel: DataFrame, path: str, buckets: int = BUCKETS, mode: str = "errorifexists", watch: Watch | None = None) -> None:
    write_store(panel.select("series_id", "date", "value"), path, ["series_id", "date"], buckets, mode, watch)


def write_vintages(vintages: DataFrame, path: str, buckets: int = BUCKETS, mode: str = "errorifexists") -> None:
    write_store(
        vintages.select("series_id", "realtime_start", "date", "value"),
        path,
        ["series_id", "date", "realtime_start"],
        buckets,
        mode,
    )


def write_features(features: DataFrame, path: str, buckets: int = BUCKETS, mode: str = "errorifexists", watch: Watch | None = None) -> None:
    write_store(features, path, ["series_id", "transform", "date"], buckets, mode, watch)


def _plain(path: str) -> str:
    """A local path in one spelling, whoever listed it."""
    return path.replace("file:///", "file:/", 1)


def _read(spark: SparkSession, path: str, schema, series: Sequence[str] | None, buckets: int, bad: Sequence[str] = ()) -> DataFrame:
    """The store's rows; a damaged file fails the job, unless it is one of ``bad``, which are left out."""
    with_bucket = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
    df = spark.read.schema(with_bucket).parquet(path)
    if bad:
        left_out = {_plain(f) for f in bad}
        good = [f for f in df.inputFiles() if _plain(f) not in left_out]
        df = spark.read.schema(with_bucket).option("basePath", path).parquet(*good) if good else spark.createDataFrame([], with_bucket)
    if series is not None:
        # The hashes are constants to the optimizer, so this prunes folders.
        buckets_of = [_bucket(F.lit(i), buckets) for i in series]
        df = df.where(F.col("bucket").isin(*buckets_of) & F.col("series_id").isin(list(series)))
    return df.drop("bucket")


DAMAGE = "path string, error string"


def damage_report(spark: SparkSession, path: str, schema: T.StructType | str = PANEL) -> DataFrame:
    """``path, error`` of the files below ``path`` that cannot be read to their end: a damaged file is a row, not a failure.

    The paths are the rows of one job; each file is read by the task that has its
    path, row group by row group with the checksums compared, so memory is that
    of one batch.  A file that lacks a column of ``schema``, or holds it in a type
    of another kind, counts as damaged too.  A file without a byte is passed over
    by every Spark reader, this one included.
    """
    wanted = {f.name: f.dataType.typeName() for f in (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema)}
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path).select("path")

    def examine(batches):
        for batch in batches:
            found = [(p, fault_of(p, wanted)) for p in batch["path"]]
            yield pd.DataFrame([f for f in found if f[1] is not None], columns=["path", "error"])

    # The listing packs many small files into a task; reading them is the work, so they are dealt out.
    return files.repartition("path").mapInPandas(examine, DAMAGE)


def fault_of(uri: str, wanted: dict[str, str]) -> str | None:
    """What is wrong with one parquet file, None when it can be read to its end."""
    kinds = {"string": ("string", "large_string"), "date": ("date32", "date64"), "double": ("double", "float"), "timestamp": ("timestamp",)}
    # ``file:/a`` as the listing writes it is ``file:///a`` elsewhere.
    name = "file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri
    try:
        system, inner = pyarrow.fs.FileSystem.from_uri(name)
    except (pyarrow.ArrowInvalid, NotImplementedError) as e:
        raise ValueError(f"no way to read {uri} in tasks") from e
    try:
        with system.open_input_file(inner) as source, pq.ParquetFile(source, page_checksum_verification=True) as file:
            have = {f.name: str(f.type).split("[")[0] for f in file.schema_arrow}
            for column, kind in wanted.items():
                if column not in have:
                    return f"no column {column}"
                if kind in kinds and have[column] not in kinds[kind]:
                    return f"column {column} is {have[column]}, not {kind}"
            seen = sum(batch.num_rows for batch in file.iter_batches(batch_size=65_536))
            return None if seen == file.metadata.num_rows else f"{seen} of {file.metadata.num_rows} rows"
    except (pyarrow.ArrowException, OSError, EOFError) as e:
        return f"{type(e).__name__}: {str(e)[:200]}"


def damaged_files(spark: SparkSession, path: str, schema: T.StructType | str = PANEL) -> list[str]:
    """Paths of the damaged files, for ``quarantined=``: as many as there are damaged ones, not files."""
    return sorted(r.path for r in damage_report(spark, path, schema).select("path").collect())


def read_panel(
    spark: SparkSession,
    path: str,
    series: Sequence[str] | None = None,
    skip_prefix: str | None = None,
    buckets: int = BUCKETS,
    quarantined: Sequence[str] = (),
) -> DataFrame:
    """Stored panel; ``series`` prunes folders, ``skip_prefix`` leaves a family of ids out.

    A damaged file fails the job.  To go on without some, name them as
    ``quarantined`` (see ``damaged_files``).
    """
    df = _read(spark, path, PANEL, series, buckets, quarantined)
    return df if skip_prefix is None else df.where(~F.col("series_id").startswith(skip_prefix))


def read_vintages(
    spark: SparkSession,
    path: str,
    series: Sequence[str] | None = None,
    data_from: str | None = None,
    realtime_from: str | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Stored vintages, bounded on data date and publication date by pushed filters."""
    from tidemark.sources.landing import bound_vintages

    return bound_vintages(_read(spark, path, VINTAGE, series, buckets), data_from, realtime_from)


def save_panel_table(
    panel: DataFrame, table: str, path: str, buckets: int = BUCKETS, mode: str = "errorifexists", watch: Watch | None = None
) -> DataFrame:
    """Panel as an external table bucketed by series id, one sorted file per bucket."""
    rows = panel.select("series_id", "date", "value").repartition(buckets, "series_id")
    if watch is not None:
        rows = watch.on(rows)
    (
        rows.write.mode(mode)
        .format("parquet")
        .bucketBy(buckets, "series_id")
        .sortBy("series_id", "date")
        .option("path", path)
        .saveAsTable(table)
    )
    return panel.sparkSession.table(table)


def open_panel_table(spark: SparkSession, table: str, path: str, buckets: int = BUCKETS) -> DataFrame:
    """The same table in a session whose catalog does not know it yet."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} (series_id STRING, date DATE, value DOUBLE) USING parquet "
        f"CLUSTERED BY (series_id) SORTED BY (series_id, date) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(table)


def stack_series_files(spark: SparkSession, folder: str, skip_prefix: str | None = None) -> DataFrame:
    """One parquet file per series (``date``, ``value``), the series id being the file stem."""
    files = spark.read.schema("date date, value double").parquet(folder)
    stem = F.regexp_extract(F.input_file_name(), r"([^/]+)\.parquet$", 1)
    df = files.select(stem.alias("series_id"), "date", "value")
    return df if skip_prefix is None else df.where(~F.col("series_id").startswith(skip_prefix))


def write_report(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Report as CSV with a header."""
    df.write.mode(mode).option("header", True).csv(path)


def append_new(spark: SparkSession, path: str, incoming: DataFrame, keys: Sequence[str]) -> None:
    """Append the rows whose key the stored table does not hold yet."""
    from tidemark.operators.merge import insert_ignore

    stored = spark.read.parquet(path)
    insert_ignore(stored, incoming.select(*stored.columns), keys).write.mode("append").parquet(path)


def write_keyed(
    rows: DataFrame, path: str, keys: Sequence[str], buckets: int = BUCKETS, mode: str = "errorifexists", parts: int | None = None
) -> None:
    """Rows in folders by a hash of the first key, sorted by all keys within a file.

    ``parts`` is the number of files to aim at, for rows that compress too well
    to be dealt out by their bytes: each bucket is then cut by a second hash of the key.
    """
    placed = rows.withColumn("bucket", _bucket(F.col(keys[0]), buckets))
    if parts is None:
        placed = placed.hint("rebalance", F.col("bucket"))
    else:
        cuts = max(1, -(-parts // buckets))
        placed = placed.repartition(cuts * buckets, "bucket", F.pmod(F.hash(keys[0]), F.lit(cuts)))
    placed.sortWithinPartitions("bucket", *keys).write.mode(mode).partitionBy("bucket").parquet(path)


def touched_part(spark: SparkSession, path: str, incoming: DataFrame, keys: Sequence[str], schema: T.StructType, buckets: int = BUCKETS) -> DataFrame:
    """The stored rows that can share a key with ``incoming``: its buckets, and its range of the other keys.

    Both come from one small aggregation over the incoming rows (at most one row
    per bucket reaches the driver) and are constants in the scan: folders are
    pruned, and row groups outside the range skipped by their statistics.
    """
    ranged = keys[1:]
    bounds = [f(F.col(k)).alias(f"{n}_{k}") for k in ranged for n, f in (("lo", F.min), ("hi", F.max))]
    found = incoming.groupBy(_bucket(F.col(keys[0]), buckets).alias("bucket")).agg(F.count(F.lit(1)).alias("n"), *bounds).collect()
    stored = spark.read.schema(T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])).parquet(path)
    stored = stored.where(F.col("bucket").isin([r.bucket for r in found]))
    for k in ranged:
        los, his = [r[f"lo_{k}"] for r in found if r[f"lo_{k}"] is not None], [r[f"hi_{k}"] for r in found if r[f"hi_{k}"] is not None]
        if los:
            stored = stored.where(F.col(k).between(F.lit(min(los)), F.lit(max(his))))
    return stored.drop("bucket")


def append_new_keyed(
    spark: SparkSession, path: str, incoming: DataFrame, keys: Sequence[str], order: Sequence[str] = (), buckets: int = BUCKETS,
    parts: int | None = None,
) -> None:
    """As ``append_new`` for a table of ``write_keyed``: a load reads the part of the table it can touch, not all of it.

    Rows with a NULL key are not in a table of keys and fail the load.  Pass
    stored rows: ``incoming`` is read twice.  Stored keys and incoming rows meet
    in one shuffle by the first key (into ``parts``, if given), which keeps the
    rows of a series together and so small.
    """
    schema = T.StructType([f for f in spark.read.parquet(path).schema.fields if f.name != "bucket"])
    whole = incoming.select(*schema.fieldNames())
    for k in keys:
        message = F.lit(f"NULL in key {k} of a load")
        whole = whole.withColumn(k, F.coalesce(F.col(k), F.raise_error(message).cast(schema[k].dataType)))
    stored = touched_part(spark, path, whole, keys, schema, buckets)
    rest = [c for c in whole.columns if c not in keys]
    row = F.struct(F.lit(True).alias("__new"), *rest)
    both = whole.select(*keys, row.alias("__row")).unionByName(stored.select(*keys, F.lit(None).cast(T.NullType()).alias("__row")))
    both = both.repartition(keys[0]) if parts is None else both.repartition(parts, keys[0])
    rank = F.when(F.col("__row").isNotNull(), F.struct(*[F.col(c) if c in keys else F.col(f"__row.{c}") for c in order])) if order else None
    first = F.first("__row", ignorenulls=True) if rank is None else F.min_by("__row", rank)
    found = both.groupBy(*keys).agg(F.count_if(F.col("__row").isNull()).alias("__held"), first.alias("__row"))
    new = found.where("__held = 0").select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in whole.columns])
    write_keyed(new, path, keys, buckets, mode="append", parts=parts)
