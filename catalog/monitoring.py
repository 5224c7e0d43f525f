"""Monitoring queries: scorecard, episodes, intervals, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import query, supplier_daily, table, with_ctes
from tidemark.functions import numeric as N
from tidemark.operators import monitor as M
from tidemark.sources.literal import literal_table

SPEC_SQL = """spec AS (SELECT 'N' || CAST(s_nationkey AS VARCHAR) AS card, s_name AS label, 'S' || CAST(s_suppkey AS VARCHAR) AS series_id,
  CASE WHEN s_suppkey % 4 = 0 THEN 'S' || CAST(s_suppkey + 1 AS VARCHAR) END AS as_of_series,
  CASE WHEN s_suppkey % 2 = 0 THEN 0.001 ELSE 1.0 END AS scale,
  ['high', 'low', 'sign', 'flip', 'floor', 'none'][CAST(s_suppkey % 6 + 1 AS INTEGER)] AS rule,
  CASE WHEN s_suppkey % 2 = 0 THEN 40.0 ELSE 40000.0 END AS threshold FROM supplier)"""


def spec_of(spark, d):
    """A scorecard row per supplier; some are as of their neighbour, some are scaled."""
    key = F.col("s_suppkey")
    rules = F.array(*[F.lit(x) for x in ("high", "low", "sign", "flip", "floor", "none")])
    return table(spark, d, "supplier").select(
        F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("card"),
        F.col("s_name").alias("label"),
        F.concat(F.lit("S"), key.cast("string")).alias("series_id"),
        F.when(key % 4 == 0, F.concat(F.lit("S"), (key + 1).cast("string"))).alias("as_of_series"),
        F.when(key % 2 == 0, 0.001).otherwise(1.0).alias("scale"),
        F.element_at(rules, (key % 6 + 1).cast("int")).alias("rule"),
        F.when(key % 2 == 0, 40.0).otherwise(40_000.0).alias("threshold"),
    )


@query(
    "scorecard",
    with_ctes(
        "s3",
        body=f""", {SPEC_SQL}, s3n AS (SELECT series_id, date, CASE WHEN series_id NOT LIKE '%9' THEN value END AS value FROM s3), lv AS (SELECT series_id, max(date) AS as_of, arg_max(value, date) AS value FROM s3n WHERE value IS NOT NULL GROUP BY 1)
SELECT card, label, CASE WHEN a.value IS NOT NULL THEN coalesce(b.as_of, a.as_of) END AS as_of, round(a.value * scale, 6) AS value,
  CASE WHEN a.value IS NULL OR rule = 'none' THEN ''
    WHEN rule IN ('high', 'floor') THEN CASE WHEN a.value * scale >= threshold THEN 'r' ELSE 'g' END
    WHEN rule = 'low' THEN CASE WHEN a.value * scale < threshold THEN 'r' ELSE 'g' END
    WHEN rule = 'sign' THEN CASE WHEN a.value * scale < 0 THEN 'r' ELSE 'g' END
    ELSE CASE WHEN a.value * scale > 0 THEN 'r' ELSE 'g' END END AS light
FROM spec LEFT JOIN lv a ON a.series_id = spec.series_id LEFT JOIN lv b ON b.series_id = spec.as_of_series""",
    ),
)
def scorecard(spark, d):
    """Suppliers ending in 9 have no values and stay as blank rows."""
    panel = supplier_daily(spark, d).withColumn("value", F.when(~F.col("series_id").endswith("9"), F.col("value")))
    return M.scorecard(panel, spec_of(spark, d)).withColumn("value", F.round("value", 6))


THRESHOLD = 80_000.0
MERGE_DAYS = 30
RUNS_SQL = """, m AS (SELECT series_id, date, value, coalesce(value >= {thr}, false) AS hot FROM {src}),
g AS (SELECT *, sum(CASE WHEN hot AND NOT coalesce(ph, false) THEN 1 ELSE 0 END) OVER (PARTITION BY series_id ORDER BY date) AS run FROM (
  SELECT *, lag(hot) OVER (PARTITION BY series_id ORDER BY date) AS ph FROM m)),
runs AS (SELECT series_id, run, min(date) AS s, max(date) AS e, max(value) AS pv, count(*) AS n,
  min(date) FILTER (value = mx) AS pd FROM (SELECT *, max(value) OVER (PARTITION BY series_id, run) AS mx FROM g WHERE hot) GROUP BY 1, 2)"""


@query(
    "episodes",
    with_ctes(
        "s3v",
        body=RUNS_SQL.format(thr=THRESHOLD, src="s3v")
        + f""", c AS (SELECT *, sum(CASE WHEN s - pe < {MERGE_DAYS} THEN 0 ELSE 1 END) OVER (PARTITION BY series_id ORDER BY s) AS k FROM (
  SELECT *, lag(e) OVER (PARTITION BY series_id ORDER BY s) AS pe FROM runs))
SELECT series_id, min(s) AS start_date, max(e) AS end_date, min(pd) FILTER (pv = mx) AS peak_date, max(pv) AS peak_value,
  CAST(sum(n) AS BIGINT) AS n_days
FROM (SELECT *, max(pv) OVER (PARTITION BY series_id, k) AS mx FROM c) GROUP BY series_id, k""",
    ),
)
def episodes(spark, d):
    return M.episodes(supplier_daily(spark, d), THRESHOLD, MERGE_DAYS)


PEAKS_SQL = (
    RUNS_SQL.format(thr=THRESHOLD, src="s3")
    + f""", c AS (SELECT *, sum(CASE WHEN pd - pp < {MERGE_DAYS} THEN 0 ELSE 1 END) OVER (PARTITION BY series_id ORDER BY pd) AS k FROM (
  SELECT *, lag(pd) OVER (PARTITION BY series_id ORDER BY pd) AS pp FROM runs)),
peaks AS (SELECT series_id, min(pd) FILTER (pv = mx) AS peak_date, max(pv) AS peak_value
  FROM (SELECT *, max(pv) OVER (PARTITION BY series_id, k) AS mx FROM c) GROUP BY series_id, k)
"""
)


@query("episode_peaks", with_ctes("s3", body=PEAKS_SQL + "SELECT * FROM peaks"))
def episode_peaks(spark, d):
    return M.episode_peaks(supplier_daily(spark, d), THRESHOLD, MERGE_DAYS)


INTERVALS = [
    (1, "spring boom", "1996-03-01", "1996-06-30"),
    (2, "long slump", "1996-05-01", "1998-02-15"),
    (3, "short scare", "1999-12-20", "2000-01-10"),
    (4, "before everything", "1980-01-01", "1995-01-20"),
    (5, "after everything", "2001-10-01", "2030-12-31"),
]
INTERVALS_SQL = ", iv AS (SELECT * FROM (VALUES " + ", ".join(
    f"({p}, '{n}', DATE '{a}', DATE '{b}')" for p, n, a, b in INTERVALS
) + ") v(priority, name, s, e))\n"


def intervals_of(spark):
    rows = literal_table(spark, INTERVALS, "priority int, name string, start string, end string")
    return rows.select("priority", "name", F.col("start").cast("date").alias("start"), F.col("end").cast("date").alias("end"))


@query(
    "interval_label",
    with_ctes(
        "s3",
        body=PEAKS_SQL
        + INTERVALS_SQL
        + """SELECT series_id, peak_date, peak_value, (SELECT arg_min(name, priority) FROM iv WHERE peak_date BETWEEN s AND e) AS interval_name
FROM peaks""",
    ),
)
def interval_label(spark, d):
    """Peaks of all suppliers, named after the interval they fall into."""
    peaks = M.episode_peaks(supplier_daily(spark, d), THRESHOLD, MERGE_DAYS)
    return M.interval_label(peaks, intervals_of(spark))


@query(
    "interval_clip",
    with_ctes(
        "s3",
        body=INTERVALS_SQL
        + """, sp AS (SELECT series_id, min(date) AS lo, max(date) AS hi FROM s3 GROUP BY 1)
SELECT series_id, name, greatest(s, lo) AS start_date, least(e, hi) AS end_date FROM sp JOIN iv ON e >= lo AND s <= hi""".replace(
            ", sp AS", ", sp AS"
        ),
    ),
)
def interval_clip(spark, d):
    return M.interval_clip(supplier_daily(spark, d), intervals_of(spark))


@query(
    "threshold_split",
    with_ctes(
        "s3",
        body="""SELECT series_id, date, CASE WHEN sd < 40000 THEN sd ELSE 0 END AS below, CASE WHEN sd >= 40000 THEN sd ELSE 0 END AS above
FROM (SELECT *, CASE WHEN value IS NOT NULL THEN least(greatest(round(value, 2), 10000), 90000) END AS sd FROM s3)""",
    ),
)
def threshold_split(spark, d):
    below, above = N.threshold_split(F.col("value"), 40_000.0, 10_000.0, 90_000.0)
    return supplier_daily(spark, d).select("series_id", "date", below.alias("below"), above.alias("above"))


@query(
    "signed_split",
    with_ctes(
        "s3",
        body="""SELECT series_id, date, CASE WHEN v IS NOT NULL THEN greatest(v, 0) END AS positive, CASE WHEN v IS NOT NULL THEN least(v, 0) END AS negative
FROM (SELECT series_id, date, round(value - lag(value) OVER (PARTITION BY series_id ORDER BY date), 2) AS v FROM s3)""",
    ),
)
def signed_split(spark, d):
    from tidemark.operators.transforms import diff

    positive, negative = N.signed_split(F.col("diff"))
    return diff(supplier_daily(spark, d)).select("series_id", "date", positive.alias("positive"), negative.alias("negative"))


@query(
    "extremes",
    with_ctes(
        "s3",
        body=f""", h AS (SELECT *, CASE WHEN date - lag(date) OVER (PARTITION BY series_id ORDER BY date) < 60 THEN 0 ELSE 1 END AS st
  FROM s3 WHERE value >= {THRESHOLD}),
k AS (SELECT *, sum(st) OVER (PARTITION BY series_id ORDER BY date) AS k FROM h)
SELECT series_id, date, value, CAST(row_number() OVER (PARTITION BY series_id, k ORDER BY date) - 1 AS INTEGER) AS stack_level FROM k""",
    ),
)
def extremes(spark, d):
    return M.extremes(supplier_daily(spark, d), THRESHOLD, 60)


@query(
    "latest_snapshot",
    with_ctes(
        "s3",
        body="SELECT * FROM s3 WHERE date = (SELECT max(date) FROM s3) AND value IS NOT NULL ORDER BY series_id LIMIT 15",
    ),
)
def latest_snapshot(spark, d):
    return M.latest_snapshot(supplier_daily(spark, d), 15)


SCALES_SQL = ", ".join(
    f"round(value * {x}, 9) AS {n}" for n, x in (("bps", "100"), ("bn", "0.001"), ("tn", "0.000001"))
)


@query("unit_scaling", with_ctes("s3", body=f"SELECT series_id, date, {SCALES_SQL} FROM s3"))
def unit_scaling(spark, d):
    scaled = {"bps": "pct_to_bps", "bn": "mn_to_bn", "tn": "mn_to_tn"}
    return supplier_daily(spark, d).select(
        "series_id", "date", *[F.round(F.col("value") * F.lit(N.SCALES[k]), 9).alias(n) for n, k in scaled.items()]
    )


