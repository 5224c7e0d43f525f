"""Inputs derived from the given tables, as DataFrames and as the same CTEs in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register a query and, where plain SQL can say the same, its check."""

    def register(fn):
        QUERIES[key] = fn
        if sql is not None:
            SQL[key] = sql
        return fn

    return register


def with_ctes(*names: str, body: str) -> str:
    """SQL from the named input CTEs (with what they need) and a body continuing the WITH list."""
    order: list[str] = []

    def need(n: str) -> None:
        for dep in CTE_NEEDS.get(n, ()):
            need(dep)
        if n not in order:
            order.append(n)

    for n in names:
        need(n)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in order) + "\n" + body


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(column):
    """Sum of money over whole cents: the same to the last digit in any order of addition."""
    value = F.col(column) if isinstance(column, str) else column
    return F.sum(F.rint(value * 100).cast("bigint")) / F.lit(100.0)


def r(column: str, digits: int = 6):
    return F.round(column, digits).alias(column)


# --- panels -----------------------------------------------------------------


def orders_daily(spark, sf_dir) -> DataFrame:
    """Five daily series: order value per priority."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderpriority").alias("series_id"), F.col("o_orderdate").cast("date").alias("date"))
        .agg(money("o_totalprice").cast("double").alias("value"))
    )


def ship_daily(spark, sf_dir) -> DataFrame:
    """Six dense daily series: shipped value per return flag and line status."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            F.concat("l_returnflag", "l_linestatus").alias("series_id"), F.col("l_shipdate").cast("date").alias("date")
        )
        .agg(money("l_extendedprice").cast("double").alias("value"))
    )


def supplier_daily(spark, sf_dir) -> DataFrame:
    """One daily series per supplier; a day with a one-piece line counts as a missing value."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("series_id"),
            F.col("l_shipdate").cast("date").alias("date"),
        )
        .agg(F.when(F.min("l_quantity") > 1, money("l_extendedprice")).cast("double").alias("value"))
    )


def supplier_vintages(spark, sf_dir, dated=None) -> DataFrame:
    """Per supplier: order month as data date, ship day as the day a (revised) value came out."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("od"))
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("series_id"),
        F.col("l_shipdate").cast("date").alias("realtime_start"),
        "l_extendedprice",
        "l_tax",
    )
    return (
        lines.join(orders, "o_orderkey")
        .groupBy("series_id", F.trunc("od" if dated is None else dated, "month").alias("date"), "realtime_start")
        .agg(F.when(F.min("l_tax") > 0, money("l_extendedprice")).cast("double").alias("value"))
        .select("series_id", "realtime_start", "date", "value")
    )


def ordered_vintages(spark, sf_dir) -> DataFrame:
    """The same with the month of the earlier of order and shipping as data date: nothing is out before its date."""
    return supplier_vintages(spark, sf_dir, F.least("od", "realtime_start"))


def supplier_registry(spark, sf_dir) -> DataFrame:
    """Registry row per supplier, its properties taken from the key."""
    key = F.col("s_suppkey")

    def pick(values, by):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (by % len(values) + 1).cast("int"))

    lists = ["zscore_rolling_1y,diff", "zscore_expanding,yoy", "pct_change_1m,diff_bps", "level,zscore_rolling_5y,yoy", ""]
    transforms = F.filter(F.split(pick(lists, key), ","), lambda x: x != "")
    vintage = key % 7 == 0
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S"), key.cast("string")).alias("series_id"),
        F.col("s_name").alias("name"),
        F.lit("TABLE").alias("source"),
        pick(["D", "W", "M", "Q"], key).alias("frequency"),
        F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("category"),
        F.lit("money").alias("unit"),
        transforms.alias("mon_transforms"),
        transforms.alias("fm_transforms"),
        F.when(~vintage & (key % 11 != 0), pick([0, 1, 3, 5, 25], key)).cast("int").alias("lag"),
        vintage.alias("is_vintage"),
    )


def job_registry(spark, sf_dir) -> DataFrame:
    """The same fit for the batch job: a series without lag and vintages has no feature transforms."""
    dated = F.col("lag").isNotNull() | F.col("is_vintage")
    registry = supplier_registry(spark, sf_dir)
    return registry.withColumn("fm_transforms", F.when(dated, F.col("fm_transforms")).otherwise(F.array().cast("array<string>")))


CTES = {
    "s1": """SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS date,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value FROM orders GROUP BY 1, 2""",
    "s2": """SELECT l_returnflag || l_linestatus AS series_id, CAST(l_shipdate AS DATE) AS date,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS value FROM lineitem GROUP BY 1, 2""",
    "s3": """SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS series_id, CAST(l_shipdate AS DATE) AS date,
  CAST(CASE WHEN min(l_quantity) > 1 THEN sum(CAST(l_extendedprice AS DECIMAL(18,2))) END AS DOUBLE) AS value
  FROM lineitem GROUP BY 1, 2""",
    "s3v": "SELECT * FROM s3 WHERE value IS NOT NULL",
    "vint": """SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS series_id, CAST(l_shipdate AS DATE) AS realtime_start,
  CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
  CAST(CASE WHEN min(l_tax) > 0 THEN sum(CAST(l_extendedprice AS DECIMAL(18,2))) END AS DOUBLE) AS value
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3""",
    "ovint": """SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS series_id, CAST(l_shipdate AS DATE) AS realtime_start,
  CAST(date_trunc('month', least(CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) AS DATE) AS date,
  CAST(CASE WHEN min(l_tax) > 0 THEN sum(CAST(l_extendedprice AS DECIMAL(18,2))) END AS DOUBLE) AS value
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3""",
    "first": """SELECT series_id, realtime_start AS effective_date, date, value FROM ovint
  QUALIFY row_number() OVER (PARTITION BY series_id, date ORDER BY realtime_start) = 1""",
    "reg": """SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS series_id, s_name AS name, 'TABLE' AS source,
  ['D', 'W', 'M', 'Q'][CAST(s_suppkey % 4 + 1 AS INTEGER)] AS frequency,
  'N' || CAST(s_nationkey AS VARCHAR) AS category,
  [['zscore_rolling_1y', 'diff'], ['zscore_expanding', 'yoy'], ['pct_change_1m', 'diff_bps'],
   ['level', 'zscore_rolling_5y', 'yoy'], []][CAST(s_suppkey % 5 + 1 AS INTEGER)] AS tf,
  CASE WHEN s_suppkey % 7 <> 0 AND s_suppkey % 11 <> 0
    THEN [0, 1, 3, 5, 25][CAST(s_suppkey % 5 + 1 AS INTEGER)] END AS lag,
  s_suppkey % 7 = 0 AS is_vintage FROM supplier""",
    # Lagged values of the series that have a lag, and the business grid they span.
    "shifted": """SELECT p.series_id, CAST(p.date + CAST(g.lag AS INTEGER) AS DATE) AS date, p.value, p.date AS obs_date
  FROM s3 p JOIN reg g USING (series_id) WHERE g.lag IS NOT NULL""",
    "bgrid": """SELECT CAST(d AS DATE) AS date FROM (SELECT unnest(generate_series(
  (SELECT CAST(min(date) AS TIMESTAMP) FROM shifted), (SELECT CAST(max(date) AS TIMESTAMP) FROM shifted),
  INTERVAL 1 DAY)) AS d) WHERE isodow(d) < 6""",
    "fixed": """SELECT s.series_id, g.date, s.value, s.obs_date
  FROM (SELECT * FROM (SELECT DISTINCT series_id FROM shifted), bgrid) g
  ASOF JOIN (SELECT * FROM shifted WHERE value IS NOT NULL) s ON g.series_id = s.series_id AND g.date >= s.date""",
    "native": """SELECT series_id, label AS date, value, frequency, tf FROM (
    SELECT p.series_id, g.frequency, g.tf, CASE g.frequency WHEN 'D' THEN p.date
      WHEN 'W' THEN CAST(date_trunc('week', p.date) AS DATE) + 6 WHEN 'M' THEN last_day(p.date)
      ELSE last_day(date_trunc('quarter', p.date) + INTERVAL 2 MONTH) END AS label,
      arg_max(p.value, p.date) AS value
    FROM s3v p JOIN reg g USING (series_id) GROUP BY 1, 2, 3, 4)""",
}
CTE_NEEDS = {
    "s3v": ["s3"],
    "first": ["ovint"],
    "shifted": ["s3", "reg"],
    "bgrid": ["shifted"],
    "fixed": ["bgrid"],
    "native": ["s3v", "reg"],
}
