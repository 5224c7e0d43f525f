"""Guards, the deep store, report sinks and whole jobs as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import statistics as _statistics  # noqa: F401  registers the SQL used below
from catalog.base import (
    CTES,
    SQL,
    job_registry,
    money,
    ordered_vintages,
    orders_daily,
    query,
    r,
    supplier_daily,
    supplier_registry,
    supplier_vintages,
    table,
    with_ctes,
)
from catalog.jobs import FACT_SQL, fact
from catalog.merging import LOADS_SQL, newer_load
from catalog.pit import PIT_PANEL_SQL
from tidemark.operators import calendar as C
from tidemark.operators import merge as M
from tidemark.operators import quality as Q
from tidemark.operators import stats as T
from tidemark.operators.asof import series_tasks
from tidemark.operators.watch import join_registered_whole
from tidemark.plans import pipeline
from tidemark.plans import warehouse as W
from tidemark.plans.features import OwnTransform, apply_transforms
from tidemark.session import materialize, scratch_path
from tidemark.sources import store as S
from tidemark.sources import versions


@query(
    "guard_missing_lag",
    with_ctes(
        "s3", "reg", body="SELECT DISTINCT s3.series_id FROM s3 LEFT JOIN reg USING (series_id) WHERE lag IS NULL AND NOT coalesce(is_vintage, false)"
    ),
)
def guard_missing_lag(spark, d):
    return Q.missing_lags(supplier_daily(spark, d), supplier_registry(spark, d))


@query(
    "guard_required_columns",
    with_ctes(
        "vint",
        body="""SELECT 'series_id' AS "column", true AS present, count(*) AS n_rows, count(*) - count(series_id) AS n_missing FROM vint
UNION ALL SELECT 'realtime_start', true, count(*), count(*) - count(realtime_start) FROM vint
UNION ALL SELECT 'value', true, count(*), count(*) - count(value) FROM vint
UNION ALL SELECT 'realtime_end', false, count(*), count(*) FROM vint""",
    ),
)
def guard_required_columns(spark, d):
    return Q.required_columns(supplier_vintages(spark, d), ["series_id", "realtime_start", "value", "realtime_end"])


@query(
    "guard_empty_source",
    """SELECT 'C' || CAST(c_custkey AS VARCHAR) AS series_id, c_mktsegment AS source FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""",
)
def guard_empty_source(spark, d):
    """Customers are registered; those without an order have no data."""
    key = lambda c: F.concat(F.lit("C"), F.col(c).cast("string")).alias("series_id")
    panel = table(spark, d, "orders").groupBy(key("o_custkey"), F.col("o_orderdate").cast("date").alias("date"))
    registry = table(spark, d, "customer").select(key("c_custkey"), F.col("c_mktsegment").alias("source"))
    return Q.empty_sources(panel.agg(money("o_totalprice").cast("double").alias("value")), registry)


@query("report_lag_sweep", SQL["lag_sweep"])
def report_lag_sweep(spark, d):
    """The sweep as a CSV report, largest gaps first, read back."""
    sweep = T.lag_sweep(ordered_vintages(spark, d), supplier_registry(spark, d), since="1998-06-01")
    path = scratch_path(spark, "report")
    S.write_report(sweep.orderBy(F.abs("gap_vs_config").desc_nulls_last(), "series_id"), path)
    return spark.read.schema(sweep.schema).option("header", True).csv(path)


@query(
    "deep_history",
    with_ctes(
        "s3",
        body=LOADS_SQL
        + """SELECT series_id, date, coalesce(n.value, o.value) AS value,
  CASE WHEN n.value IS NOT NULL THEN 'canonical' WHEN o.value IS NOT NULL THEN 'deep' END AS origin
FROM s3 o FULL JOIN newer n USING (series_id, date)""",
    ),
)
def deep_history(spark, d):
    """Deep history kept in a store of its own and used by the splice only."""
    path = scratch_path(spark, "deep")
    S.write_panel(supplier_daily(spark, d), path, buckets=8)
    return M.splice_origin(newer_load(spark, d), S.read_panel(spark, path, buckets=8))


@query(
    "features_guarded",
    with_ctes(
        "s3v",
        body=""", w AS (SELECT series_id, CAST(date_trunc('week', date) AS DATE) + 6 AS date, arg_max(value, s3v.date) AS value FROM s3v GROUP BY 1, 2),
z AS (SELECT series_id, date, CASE WHEN count(value) OVER r >= 26 AND stddev_samp(value) OVER r > 0
    THEN (value - avg(value) OVER r) / stddev_samp(value) OVER r END AS z
  FROM w WINDOW r AS (PARTITION BY series_id ORDER BY date ROWS BETWEEN 51 PRECEDING AND CURRENT ROW))
SELECT series_id, 'level' AS transform, date, value FROM w
UNION ALL SELECT g.series_id, 'zscore', g.date, round(z.z, 5)
  FROM (SELECT * FROM (SELECT DISTINCT series_id FROM w), (SELECT DISTINCT date FROM w)) g
  ASOF JOIN z ON g.series_id = z.series_id AND g.date >= z.date""",
    ),
)
def features_guarded(spark, d):
    """Weekly series declared as such: the dispatch checks the dates and lets them pass."""
    weekly = materialize(C.resample_last(supplier_daily(spark, d).where("value is not null"), "W").select("series_id", "date", "value"), "weekly")
    wanted = F.array(F.lit("zscore_rolling_1y"))
    registry = supplier_registry(spark, d).withColumns({"frequency": F.lit("W"), "mon_transforms": wanted})
    out = apply_transforms(weekly, registry, "mon")
    rounded = F.when(F.col("transform") == "level", F.col("value")).otherwise(F.round("value", 5))
    return out.withColumn("value", rounded).select("series_id", "transform", "date", "value")


@query("pipeline_run", SQL["features_mon"])
def pipeline_run(spark, d):
    """The whole batch job; its monitoring table is shown."""
    paths = pipeline.run(
        spark,
        supplier_daily(spark, d),
        job_registry(spark, d),
        scratch_path(spark, "job"),
        vintages=ordered_vintages(spark, d),
        buckets=8,
        check_frequency=False,
    )
    return spark.read.parquet(paths["monitoring"]).select("series_id", "transform", "date", r("value", 5))


#: The tables of the job as the SQL of the queries on them builds them.
_STAGES = {
    "raw": with_ctes("s3", body="SELECT date, value FROM s3"),
    "monitoring": SQL["features_mon"],
    "pit": with_ctes("fixed", "first", body=PIT_PANEL_SQL),
}


@query(
    "pipeline_metrics",
    " UNION ALL ".join(
        f"SELECT '{stage}' AS stage, count(*) AS n_rows, count(value) AS n_valued, min(date) AS first_date, max(date) AS last_date FROM ({sql})"
        for stage, sql in _STAGES.items()
    ),
)
def pipeline_metrics(spark, d):
    """What the batch job counted while it wrote its tables, with floors that hold and values none of which is lost."""
    panel = supplier_daily(spark, d)
    floors = panel.groupBy("series_id").agg(F.date_add(F.max("date"), 30).alias("first_by"), F.lit(1).alias("min_n"))
    paths = pipeline.run(
        spark, panel, job_registry(spark, d), scratch_path(spark, "job"), ordered_vintages(spark, d), floors=floors, buckets=8, check_frequency=False
    )
    return spark.read.parquet(paths["metrics"]).where(F.col("stage").isin(*_STAGES))


@query(
    "join_whole",
    with_ctes("s1", "s3", "reg", body="""SELECT * FROM s1 UNION ALL SELECT * FROM s3
WHERE series_id IN (SELECT series_id FROM reg WHERE lag IS NOT NULL) AND date IN (SELECT date FROM s1)"""),
)
def join_whole(spark, d):
    """The orders' days joined by supplier values none of which may be lost: those on other days are withdrawn first."""
    orders, panel = orders_daily(spark, d), supplier_daily(spark, d)
    known = panel.join(orders.select("date").distinct(), "date", "left_semi")
    return join_registered_whole(orders, known, supplier_registry(spark, d))


#: The supplier values at the frequency each series declares; weekly instead of daily, and monthly for those of vintages.
_DECLARED = """SELECT series_id, CASE frequency WHEN 'W' THEN CAST(date_trunc('week', date) AS DATE) + 6 WHEN 'M' THEN last_day(date)
  ELSE last_day(date_trunc('quarter', date) + INTERVAL 2 MONTH) END AS date, arg_max(value, date) AS value
  FROM (SELECT * FROM ({daily}) WHERE value IS NOT NULL) JOIN (SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS series_id, {frequency} AS frequency
    FROM supplier) USING (series_id) GROUP BY 1, 2"""
_FREQUENCY = "CASE WHEN s_suppkey % 7 = 0 THEN 'M' ELSE ['W', 'W', 'M', 'Q'][CAST(s_suppkey % 4 + 1 AS INTEGER)] END"
_GUARDED_SQL = SQL["features_mon"].replace(
    f"s3 AS ({CTES['s3']})", f"s3 AS ({_DECLARED.format(daily=CTES['s3'], frequency=_FREQUENCY)})"
).replace("['D', 'W', 'M', 'Q'][CAST(s_suppkey % 4 + 1 AS INTEGER)]", _FREQUENCY)


@query("pipeline_guarded", _GUARDED_SQL)
def pipeline_guarded(spark, d):
    """The whole batch job with the frequency guard on, over series that have the frequency they declare."""
    registry = job_registry(spark, d)
    declared = F.when(F.col("is_vintage"), "M").otherwise(F.when(F.col("frequency") == "D", "W").otherwise(F.col("frequency")))
    registry = registry.withColumn("frequency", declared)
    panel = C.to_native(supplier_daily(spark, d).where("value is not null"), registry, [])
    paths = pipeline.run(
        spark, panel.select("series_id", "date", "value"), registry, scratch_path(spark, "job"), vintages=ordered_vintages(spark, d), buckets=8
    )
    return spark.read.parquet(paths["monitoring"]).select("series_id", "transform", "date", r("value", 5))


@query(
    "features_own",
    with_ctes(
        "s3v",
        "reg",
        body=""", n AS (SELECT series_id, last_day(date) AS label, arg_max(value, s3v.date) AS value FROM s3v GROUP BY 1, 2),
h AS (SELECT series_id, label, CASE WHEN count(*) OVER w >= 3 THEN value / max(value) OVER w - 1 END AS value
  FROM n WINDOW w AS (PARTITION BY series_id ORDER BY label ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)),
g AS (SELECT DISTINCT date FROM s3v)
SELECT series_id, 'level' AS transform, date, round(value, 5) AS value FROM s3v
UNION ALL SELECT k.series_id, 'drawdown', k.date, round(h.value, 5)
  FROM (SELECT * FROM (SELECT DISTINCT series_id FROM n), g) k ASOF JOIN h ON k.series_id = h.series_id AND k.date >= h.label""",
    ),
)
def features_own(spark, d):
    """A transform defined here, not in the package: the distance from the highest of the last three months."""

    def drawdown(value, series):
        recent = series.rowsBetween(-2, 0)
        return F.when(F.count(value).over(recent) >= 3, value / F.max(value).over(recent) - 1)

    panel = materialize(supplier_daily(spark, d).where("value is not null"), "own-panel")
    registry = supplier_registry(spark, d).withColumns({"frequency": F.lit("M"), "mon_transforms": F.array(F.lit("drawdown_3m"))})
    out = apply_transforms(panel, registry, "mon", own={"drawdown_3m": OwnTransform("drawdown", drawdown)})
    return out.select("series_id", "transform", "date", r("value", 5))


@query("warehouse_load", FACT_SQL + "SELECT transform, count(*) AS n FROM fact GROUP BY 1")
def warehouse_load(spark, d):
    """Two loads of the same facts: the second one adds nothing."""
    path, tasks = scratch_path(spark, "facts"), series_tasks(supplier_registry(spark, d))
    rows = materialize(fact(spark, d), "fact")
    W.load_facts(spark, rows, path, first=True, buckets=8, tasks=tasks)
    W.load_facts(spark, rows, path, first=False, buckets=8, tasks=tasks)
    return W.rows_by_transform(spark.read.parquet(path))


@query(
    "load_date_text",
    FACT_SQL + """SELECT series_id, strftime(date, '%Y-%m-%d') AS date, transform, strftime(release_date, '%Y-%m-%d') AS release_date,
  strftime(obs_date, '%Y-%m-%d') AS obs_date, block FROM fact""",
)
def load_date_text(spark, d):
    """The load with its dates as text, keyed and stored like the other one."""
    path, tasks = scratch_path(spark, "facts"), series_tasks(supplier_registry(spark, d))
    W.load_facts(spark, W.dates_as_text(fact(spark, d)), path, first=True, buckets=8, tasks=tasks)
    return spark.read.parquet(path).select("series_id", "date", "transform", "release_date", "obs_date", "block")


@query(
    "load_insert_ignore",
    with_ctes(
        "s3",
        body="""SELECT series_id, date, CASE WHEN date < DATE '1996-01-01' THEN value ELSE value + 1 END AS value FROM s3
WHERE date < DATE '1996-01-01' OR CAST(substr(series_id, 2) AS BIGINT) % 3 = 0""",
    ),
)
def load_insert_ignore(spark, d):
    """Two loads: the second one has other values for all keys of a third of the series, and counts only where the key is new."""
    path, key = scratch_path(spark, "keyed"), ["series_id", "date"]
    panel = supplier_daily(spark, d)
    S.write_keyed(panel.where("date < '1996-01-01'"), path, key, buckets=8)
    third = panel.where(F.substring("series_id", 2, 20).cast("long") % 3 == 0)
    S.append_new_keyed(spark, path, materialize(third.withColumn("value", F.col("value") + 1), "load"), key, buckets=8)
    return spark.read.parquet(path).select("series_id", "date", "value")


@query(
    "quarantine_files",
    with_ctes("s3", body="SELECT series_id, count(*) AS n, count(value) AS n_valued, 1 AS n_damaged FROM s3 GROUP BY 1"),
)
def quarantine_files(spark, d):
    """A store with a damaged file among the good ones: found by the tasks, named, left out."""
    path = scratch_path(spark, "store")
    S.write_panel(supplier_daily(spark, d), path, buckets=8)
    fs, hadoop = versions.filesystem(spark, path)
    broken = fs.create(hadoop(f"{path}/bucket=3/part-damaged.parquet"), False)
    broken.write(bytearray(b"PAR1 cut short"))
    broken.close()
    report = S.damage_report(spark, path)
    bad = [r.path for r in report.collect()]
    good = S.read_panel(spark, path, buckets=8, quarantined=bad)
    counts = good.groupBy("series_id").agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("n_valued"))
    return counts.withColumn("n_damaged", F.lit(len(bad)))
