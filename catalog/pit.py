"""Point-in-time queries on supplier series and supplier vintages."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import (
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
from catalog.calendars import HOLIDAYS_SQL
from catalog.transforms import features_sql
from tidemark.operators import pit as P
from tidemark.operators import runs as RUNS
from tidemark.operators.calendar import business_grid
from tidemark.operators.monitor import scorecard
from tidemark.operators.transforms import rolling_zscore
from tidemark.plans.features import apply_transforms
from tidemark.session import materialize
from tidemark.sources.literal import literal_table

# The flagship's registry: lag in calendar days per order priority.
PRIORITY_LAG = [("1-URGENT", 0), ("2-HIGH", 1), ("3-MEDIUM", 3), ("4-NOT SPECIFIED", 5), ("5-LOW", 25)]


@query(
    "flagship",
    with_ctes(
        "s1",
        body=""", lags AS (SELECT * FROM (VALUES ('1-URGENT', 0), ('2-HIGH', 1), ('3-MEDIUM', 3), ('4-NOT SPECIFIED', 5),
  ('5-LOW', 25)) v(series_id, lag)),
sh AS (SELECT series_id, date + lag AS date, value FROM s1 JOIN lags USING (series_id)),
grid AS (SELECT CAST(d AS DATE) AS date FROM (SELECT unnest(generate_series(
  (SELECT CAST(min(date) AS TIMESTAMP) FROM sh), (SELECT CAST(max(date) AS TIMESTAMP) FROM sh), INTERVAL 1 DAY)) AS d)
  WHERE isodow(d) < 6),
pit AS (SELECT g.series_id, g.date, sh.value FROM (SELECT * FROM lags, grid) g
  ASOF JOIN sh ON g.series_id = sh.series_id AND g.date >= sh.date),
z AS (SELECT series_id, date, CASE WHEN count(value) OVER w >= 126 THEN (value - avg(value) OVER w) / stddev_samp(value) OVER w END AS z
  FROM pit WINDOW w AS (PARTITION BY series_id ORDER BY date ROWS BETWEEN 251 PRECEDING AND CURRENT ROW))
SELECT 'orders' AS card, series_id AS label, max(date) AS as_of, round(arg_max(z, date), 6) AS value,
  CASE WHEN arg_max(z, date) >= 2 THEN 'r' ELSE 'g' END AS light
FROM z WHERE z IS NOT NULL GROUP BY series_id""",
    ),
)
def flagship(spark, d):
    """Order value per priority: publication lag, business grid, rolling z, latest value with its light."""
    registry = literal_table(spark, PRIORITY_LAG, "series_id string, lag int")
    z = rolling_zscore(P.pit_align(orders_daily(spark, d), registry), 252)
    panel = z.select("series_id", "date", F.col("z").alias("value"))
    spec = registry.select(
        F.lit("orders").alias("card"),
        F.col("series_id").alias("label"),
        "series_id",
        F.lit(None).cast("string").alias("as_of_series"),
        F.lit(1.0).alias("scale"),
        F.lit("high").alias("rule"),
        F.lit(2.0).alias("threshold"),
    )
    return scorecard(panel, spec).withColumn("value", F.round("value", 6))


@query("pub_lag", with_ctes("shifted", body="SELECT * FROM shifted"))
def pub_lag(spark, d):
    return P.publication_lag(supplier_daily(spark, d), supplier_registry(spark, d), strict=False)


@query("pit_align", with_ctes("fixed", body="SELECT * FROM fixed"))
def pit_align(spark, d):
    return P.pit_align(supplier_daily(spark, d), supplier_registry(spark, d), strict=False)


@query("first_release", with_ctes("first", body="SELECT * FROM first"))
def first_release(spark, d):
    return P.check_release_order(P.first_release(ordered_vintages(spark, d)))


@query(
    "latest_release",
    with_ctes(
        "ovint",
        body="""SELECT series_id, realtime_start AS release_date, date, value FROM ovint
QUALIFY row_number() OVER (PARTITION BY series_id, date ORDER BY realtime_start DESC) = 1""",
    ),
)
def latest_release(spark, d):
    return P.latest_release(ordered_vintages(spark, d))


@query("pit_invariant", with_ctes("vint", body="SELECT * FROM vint WHERE realtime_start < date"))
def pit_invariant(spark, d):
    """Rows published before the month they describe."""
    return P.release_order_violations(supplier_vintages(spark, d), "realtime_start")


ASOF_SQL = """, q AS (SELECT DISTINCT 'S' || CAST(l_suppkey AS VARCHAR) AS series_id, CAST(l_shipdate AS DATE) AS query_date FROM lineitem),
rel AS (SELECT * FROM (SELECT series_id, effective_date + {lag} AS usable, effective_date, date AS data_date, value AS pit_value FROM first)
  QUALIFY row_number() OVER (PARTITION BY series_id, usable ORDER BY data_date DESC) = 1),
a AS (SELECT q.series_id, q.query_date, rel.pit_value, rel.data_date, rel.effective_date
  FROM q ASOF LEFT JOIN rel ON q.series_id = rel.series_id AND q.query_date >= rel.usable)
"""


def _ship_days(spark, d):
    return table(spark, d, "lineitem").select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("series_id"),
        F.col("l_shipdate").cast("date").alias("query_date"),
    )


@query("asof_backward", with_ctes("first", body=ASOF_SQL.format(lag=0) + "SELECT * FROM a"))
def asof_backward(spark, d):
    """What was known about a supplier on each of its ship days."""
    return P.asof_backward(P.first_release(ordered_vintages(spark, d)), _ship_days(spark, d))


@query("asof_backward_lag", with_ctes("first", body=ASOF_SQL.format(lag=10) + "SELECT * FROM a"))
def asof_backward_lag(spark, d):
    return P.asof_backward(P.first_release(ordered_vintages(spark, d)), _ship_days(spark, d), lag_days=10)


@query(
    "asof_coverage",
    with_ctes(
        "first",
        body=ASOF_SQL.format(lag=0)
        + "SELECT series_id, count(pit_value) AS n_aligned, count(*) AS n_total FROM a GROUP BY 1",
    ),
)
def asof_coverage(spark, d):
    return P.asof_coverage(P.asof_backward(P.first_release(ordered_vintages(spark, d)), _ship_days(spark, d)))


LEVELS_SQL = """SELECT g.series_id, g.date, f.value, f.date AS obs_date
FROM (SELECT * FROM (SELECT DISTINCT series_id FROM first {member}), {grid}) g
ASOF JOIN (SELECT * FROM first QUALIFY row_number() OVER (PARTITION BY series_id, effective_date ORDER BY date DESC) = 1) f
  ON g.series_id = f.series_id AND g.date >= f.effective_date"""


@query(
    "vintage_levels",
    with_ctes(
        "first",
        "s1",
        body=""", ogrid AS (SELECT CAST(d AS DATE) AS date FROM (SELECT unnest(generate_series(
  (SELECT CAST(min(date) AS TIMESTAMP) FROM s1), (SELECT CAST(max(date) AS TIMESTAMP) FROM s1), INTERVAL 1 DAY)) AS d)
  WHERE isodow(d) < 6)
"""
        + LEVELS_SQL.format(member="", grid="ogrid"),
    ),
)
def vintage_levels(spark, d):
    return P.vintage_levels(ordered_vintages(spark, d), business_grid(orders_daily(spark, d)))


PIT_PANEL_SQL = "SELECT * FROM fixed UNION ALL " + LEVELS_SQL.format(
    member="WHERE series_id IN (SELECT series_id FROM reg WHERE is_vintage)", grid="bgrid"
)


@query("pit_panel", with_ctes("fixed", "first", body=PIT_PANEL_SQL))
def pit_panel(spark, d):
    return P.pit_panel(supplier_daily(spark, d), ordered_vintages(spark, d), supplier_registry(spark, d))


@query(
    "features_fm",
    features_sql(
        f"SELECT series_id, date, value FROM ({PIT_PANEL_SQL})",
        "SELECT series_id, date, value FROM src",
        "SELECT DISTINCT date FROM src",
        ("fixed", "first"),
    ),
)
def features_fm(spark, d):
    registry = supplier_registry(spark, d)
    # Stored first, as a pipeline does: the transforms read it several times.
    held = materialize(P.pit_runs(supplier_daily(spark, d), ordered_vintages(spark, d), registry), "runs")
    panel = materialize(RUNS.spread(held), "pit")
    return apply_transforms(panel.drop("obs_date"), registry, "fm", check_frequency=False, runs=held).select(
        "series_id", "transform", "date", r("value", 5)
    )


@query(
    "diagnose_lookahead",
    with_ctes(
        "fixed",
        "s3v",
        body=""", a AS (SELECT series_id, arg_max(value, date) AS raw_value FROM s3v WHERE date <= DATE '2000-06-30' GROUP BY 1),
b AS (SELECT series_id, arg_max(value, date) AS pit_value FROM fixed WHERE date <= DATE '2000-06-30' GROUP BY 1)
SELECT series_id, raw_value, pit_value, round(raw_value - pit_value, 4) AS diff,
  coalesce(abs(raw_value - pit_value) > 1e-9, false) AND raw_value IS NOT NULL AS look_ahead
FROM a FULL JOIN b USING (series_id)""",
    ),
)
def diagnose_lookahead(spark, d):
    raw = supplier_daily(spark, d)
    pit = P.pit_align(raw, supplier_registry(spark, d), strict=False)
    return P.diagnose_lookahead(raw, pit, "2000-06-30").withColumn("diff", F.round("diff", 4))


@query(
    "release_date",
    with_ctes(
        "s3",
        "reg",
        body=f""", {HOLIDAYS_SQL},
ord AS (SELECT days.d, count(bdays.d) OVER (ORDER BY days.d) AS k FROM days LEFT JOIN bdays ON days.d = bdays.d)
SELECT s3.series_id, s3.date, s3.value, CASE WHEN NOT reg.is_vintage THEN
  CASE WHEN starts_with(s3.series_id, 'S1') THEN b.d ELSE s3.date + reg.lag END END AS release_date
FROM s3 JOIN reg USING (series_id) JOIN ord ON s3.date = ord.d JOIN bdays b ON b.k = ord.k + 3""",
    ),
)
def release_date(spark, d):
    return P.release_date(supplier_daily(spark, d), supplier_registry(spark, d), business_prefix="S1")


@query(
    "release_date_vintage",
    with_ctes(
        "first",
        "s3",
        body="""SELECT s3.series_id, s3.date, s3.value, f.effective_date AS release_date
FROM s3 ASOF JOIN (SELECT DISTINCT series_id, effective_date FROM first) f
  ON s3.series_id = f.series_id AND s3.date >= f.effective_date""",
    ),
)
def release_date_vintage(spark, d):
    return P.release_date_vintage(supplier_daily(spark, d), ordered_vintages(spark, d)).select(
        "series_id", "date", "value", "release_date"
    )
