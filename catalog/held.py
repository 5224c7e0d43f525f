"""Held values as runs with an explicit end, and long series spread over tasks."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import ordered_vintages, query, r, supplier_daily, supplier_registry, with_ctes
from catalog.pit import ASOF_SQL, PIT_PANEL_SQL, _ship_days
from catalog.transforms import z_sql
from tidemark.operators import pit as P
from tidemark.operators import prefix
from tidemark.operators import runs as R
from tidemark.session import materialize

END = "1998-06-30"

# The supplier series, in which every tenth supplier's last value bears a wrong date.
MISDATED_SQL = """, mis AS (SELECT series_id, CASE WHEN CAST(substr(series_id, 2) AS BIGINT) % 10 = 0
  AND date = max(date) OVER (PARTITION BY series_id) THEN DATE '9999-12-31' ELSE date END AS date, value FROM s3)
"""
BOUNDED_SQL = (
    MISDATED_SQL
    + f""", sh AS (SELECT m.series_id, CAST(m.date + CAST(g.lag AS INTEGER) AS DATE) AS date, m.value, m.date AS obs_date
  FROM mis m JOIN reg g USING (series_id) WHERE g.lag IS NOT NULL AND m.date <= DATE '{END}'),
gr AS (SELECT CAST(d AS DATE) AS date FROM (SELECT unnest(generate_series((SELECT CAST(min(date) AS TIMESTAMP) FROM sh),
  TIMESTAMP '{END}', INTERVAL 1 DAY)) AS d) WHERE isodow(d) < 6),
held AS (SELECT s.series_id, g.date, s.value, s.obs_date FROM (SELECT * FROM (SELECT DISTINCT series_id FROM sh), gr) g
  ASOF JOIN (SELECT * FROM sh WHERE value IS NOT NULL) s ON g.series_id = s.series_id AND g.date >= s.date)
"""
)


def misdated(spark, d):
    panel = supplier_daily(spark, d)
    last = panel.groupBy("series_id").agg(F.max("date").alias("__last"))
    wrong = (F.substring("series_id", 2, 20).cast("long") % 10 == 0) & (F.col("date") == F.col("__last"))
    dated = F.when(wrong, F.lit("9999-12-31").cast("date")).otherwise(F.col("date"))
    return panel.join(last, "series_id").select("series_id", dated.alias("date"), "value")


@query("pit_align_bounded", with_ctes("s3", "reg", body=BOUNDED_SQL + "SELECT * FROM held"))
def pit_align_bounded(spark, d):
    """The grid ends where it is told to, whatever a wrong date says."""
    inside, _ = R.split_at(misdated(spark, d), END, "date")
    return P.pit_align(inside, supplier_registry(spark, d), strict=False, end=END)


@query("pit_quarantine", with_ctes("s3", body=MISDATED_SQL + f"SELECT * FROM mis WHERE date > DATE '{END}'"))
def pit_quarantine(spark, d):
    """What the bounded grid leaves out, kept aside."""
    return R.split_at(misdated(spark, d), END, "date")[1]


@query(
    "runs_coverage",
    with_ctes("fixed", "first", body=f"SELECT series_id, min(date) AS first_valid, max(date) AS last_valid, count(*) AS n FROM ({PIT_PANEL_SQL}) GROUP BY 1"),
)
def runs_coverage(spark, d):
    """Days of the point-in-time panel counted without building them."""
    return R.coverage(P.pit_runs(supplier_daily(spark, d), ordered_vintages(spark, d), supplier_registry(spark, d)))


@query(
    "runs_native",
    with_ctes(
        "fixed",
        "first",
        body=f"""SELECT series_id, date, value, frequency FROM (
  SELECT p.series_id, g.frequency, CASE g.frequency WHEN 'D' THEN p.date
    WHEN 'W' THEN CAST(date_trunc('week', p.date) AS DATE) + 6 WHEN 'M' THEN last_day(p.date)
    ELSE last_day(date_trunc('quarter', p.date) + INTERVAL 2 MONTH) END AS date, arg_max(p.value, p.date) AS value
  FROM ({PIT_PANEL_SQL}) p JOIN reg g USING (series_id) WHERE p.value IS NOT NULL GROUP BY 1, 2, 3)""",
    ),
)
def runs_native(spark, d):
    """Native periods of the point-in-time panel from its runs."""
    registry = supplier_registry(spark, d)
    held = materialize(P.pit_runs(supplier_daily(spark, d), ordered_vintages(spark, d), registry), "runs")
    return R.to_native(held, registry)


@query("asof_backward_split", with_ctes("first", body=ASOF_SQL.format(lag=10) + "SELECT * FROM a"))
def asof_backward_split(spark, d):
    """As ``asof_backward_lag``, every 256 days of a supplier being a task of its own."""
    return P.asof_backward(P.first_release(ordered_vintages(spark, d)), _ship_days(spark, d), lag_days=10, width=256)


@query("zscore_expanding_split", z_sql("s3", "UNBOUNDED PRECEDING AND 1 PRECEDING", 60))
def zscore_expanding_split(spark, d):
    return prefix.expanding_zscore(supplier_daily(spark, d), lag=1, width=256).select("series_id", "date", r("z"))
