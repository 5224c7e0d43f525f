"""Lag, revision and stationarity statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import orders_daily, ordered_vintages, query, r, supplier_daily, supplier_registry, with_ctes
from tidemark.operators import composites as K
from tidemark.operators import stationarity as U
from tidemark.operators import stats as T
from tidemark.session import scratch_path
from tidemark.sources import store as S

ENDS_SQL = """, ends AS (SELECT series_id, date, min(realtime_start) AS eff, arg_min(CAST({v} AS STRUCT(v DOUBLE)), realtime_start).v AS fv,
  arg_max(CAST({v} AS STRUCT(v DOUBLE)), realtime_start).v AS lv FROM ovint GROUP BY 1, 2)
""".format(v="{'v': value}")


@query(
    "revision_rate",
    with_ctes(
        "ovint",
        body=ENDS_SQL
        + """SELECT series_id, count(CASE WHEN fv IS NOT NULL AND lv IS NOT NULL THEN 1 END) AS n_both,
  avg(CASE WHEN round(fv, 4) <> round(lv, 4) THEN 1.0 WHEN fv IS NOT NULL AND lv IS NOT NULL THEN 0.0 END) AS revised_share
FROM ends GROUP BY 1""",
    ),
)
def revision_rate(spark, d):
    return T.revision_rate(ordered_vintages(spark, d))


@query(
    "lag_sweep",
    with_ctes(
        "ovint",
        "reg",
        body=ENDS_SQL
        + """, m AS (SELECT series_id, count(*) AS n, CAST(trunc(median(eff - date)) AS INTEGER) AS median_lag,
  CAST(trunc(round(quantile_cont(eff - date, 0.9), 6)) AS INTEGER) AS p90_lag,
  round(avg(CASE WHEN round(fv, 4) <> round(lv, 4) THEN 1.0 WHEN fv IS NOT NULL AND lv IS NOT NULL THEN 0.0 END) * 100, 1) AS revised_pct
  FROM ends WHERE date >= DATE '1998-06-01' GROUP BY 1)
SELECT reg.series_id, frequency AS freq, CASE WHEN reg.series_id NOT IN (SELECT series_id FROM ovint) THEN 'NO-VINTAGE'
  WHEN m.n IS NULL THEN 'NO-RECENT-PERIOD' ELSE 'OK' END AS status, coalesce(n, 0) AS n, median_lag, p90_lag,
  lag AS config_lag, median_lag - coalesce(lag, 1) AS gap_vs_config, revised_pct, is_vintage
FROM reg LEFT JOIN m USING (series_id)""",
    ),
)
def lag_sweep(spark, d):
    return T.lag_sweep(ordered_vintages(spark, d), supplier_registry(spark, d), since="1998-06-01")


@query(
    "df_tstat",
    with_ctes(
        "s3v",
        body=""", p AS (SELECT series_id, value - x AS dy, x FROM (
  SELECT series_id, value, lag(value) OVER (PARTITION BY series_id ORDER BY date) AS x FROM s3v)),
g AS (SELECT series_id, CAST(regr_count(dy, x) AS BIGINT) AS n, regr_slope(dy, x) AS b, regr_sxx(dy, x) AS sxx,
  regr_sxy(dy, x) AS sxy, regr_syy(dy, x) AS syy FROM p GROUP BY 1)
SELECT series_id, n, round(b, 8) AS slope, round(b / sqrt((syy - b * sxy) / (n - 2) / sxx), 6) AS t_stat FROM g""",
    ),
)
def df_tstat(spark, d):
    return T.df_tstat(supplier_daily(spark, d)).select("series_id", "n", r("slope", 8), r("t_stat"))


@query("adf_screen")
def adf_screen(spark, d):
    """No SQL check: the lag order is searched.  Tested against a direct computation."""
    out = T.recommend_window(T.adf_screen(supplier_daily(spark, d)))
    return out.withColumns({"adf_stat": F.round("adf_stat", 6), "p_value": F.round("p_value", 6)})


@query(
    "monthly_change",
    with_ctes(
        "s3v",
        body="""SELECT series_id, date, value, round(value - b, 4) AS diff, round((value / nullif(b, 0) - 1) * 100, 6) AS pct FROM (
  SELECT *, lag(value) OVER (PARTITION BY series_id ORDER BY date) AS b FROM (
    SELECT series_id, last_day(date) AS date, arg_max(value, s3v.date) AS value FROM s3v GROUP BY 1, 2))""",
    ),
)
def monthly_change(spark, d):
    return T.monthly_change(supplier_daily(spark, d)).select("series_id", "date", "value", r("diff", 4), r("pct"))


# --- unit-root screen in aggregates ---------------------------------------------

#: The distribution function of the normal distribution as a sum, and the p-value of a statistic.
_CDF = """CASE WHEN z < -7 THEN 0.0 WHEN z > 7 THEN 1.0 ELSE greatest(0.0, 0.5 + exp(-z * z / 2) / sqrt(2 * pi()) * list_sum(list_transform(
  range(0, 121), lambda k: z * pow(z * z, k) * exp(k * ln(2) + lgamma(k + 1) - lgamma(2 * k + 2))))) END"""
_SCORE = f"""CASE WHEN t <= {U.TAU_STAR} THEN {U.SMALL_P[0]} + {U.SMALL_P[1]} * t + {U.SMALL_P[2]} * t * t
  ELSE {U.LARGE_P[0]} + {U.LARGE_P[1]} * t + {U.LARGE_P[2]} * t * t + {U.LARGE_P[3]} * t * t * t END"""
_P_VALUE = f"CASE WHEN t > {U.TAU_MAX} THEN 1.0 WHEN t < {U.TAU_MIN} THEN 0.0 ELSE {_CDF} END"


def _regressed(source: str, on: str, *columns: str) -> str:
    """Residuals of ``columns`` after a constant and ``on``, by series."""
    fits = ", ".join(f"regr_slope({c}, {on}) OVER w AS b_{c}, regr_intercept({c}, {on}) OVER w AS a_{c}" for c in columns)
    kept = ", ".join(f"{c} - a_{c} - b_{c} * {on} AS {c}" for c in columns)
    return f"SELECT series_id, {kept} FROM (SELECT *, {fits} FROM {source} WINDOW w AS (PARTITION BY series_id))"


def _steps(source: str, lags: int) -> str:
    """Rows of the regression: difference d, level before it y, lagged differences d1, d2."""
    lagged = ", ".join(f"lag(d, {k}) OVER (PARTITION BY series_id ORDER BY date) AS d{k}" for k in range(1, lags + 1))
    return f"""SELECT * FROM (SELECT *, {lagged} FROM (SELECT series_id, date, value - lag(value) OVER w AS d, lag(value) OVER w AS y
  FROM {source} WINDOW w AS (PARTITION BY series_id ORDER BY date))) WHERE d{lags} IS NOT NULL"""


@query(
    "adf_fixed_lag",
    with_ctes(
        "s3v",
        body=f""", e AS ({_steps("s3v", 2)}),
e1 AS ({_regressed("e", "d1", "d", "y", "d2")}),
e2 AS ({_regressed("e1", "d2", "d", "y")}),
g AS (SELECT series_id, count(*) AS obs, regr_slope(d, y) AS b, regr_sxx(d, y) AS sxx, regr_sxy(d, y) AS sxy, regr_syy(d, y) AS syy FROM e2 GROUP BY 1),
f AS (SELECT series_id, obs, b / sqrt((syy - b * sxy) / (obs - 4) / sxx) AS t FROM g WHERE obs > 4)
SELECT series_id, n, 2 AS used_lag, obs, round(t, 6) AS adf_stat, round({_P_VALUE}, 6) AS p_value
FROM (SELECT *, {_SCORE} AS z FROM f) JOIN (SELECT series_id, count(*) AS n FROM s3v GROUP BY 1) USING (series_id)""",
    ),
)
def adf_fixed_lag(spark, d):
    """Two lagged differences; the SQL takes them out one after the other."""
    return U.adf_fixed_lag(supplier_daily(spark, d), 2).select("series_id", "n", "used_lag", "obs", r("adf_stat"), r("p_value"))


def _items(spark):
    """What is screened: levels and a composite, changes of rows and of month ends, and a series nobody has."""
    rows = [
        ("A", "urgent", "level", "1-URGENT"),
        ("A", "urgent over high", "level", "urgent-high"),
        ("A", "low rows", "diff", "5-LOW"),
        ("A", "unknown", "level", "none"),
        ("B", "dhigh", "month_diff", "2-HIGH"),
        ("B", "dspread", "month_diff", "urgent-high"),
        ("B", "medium", "month_pct", "3-MEDIUM"),
    ]
    return spark.createDataFrame(rows, "section string, label string, transform string, series_id string")


def _with_composite(spark, d):
    legs = spark.createDataFrame([("urgent-high", "x", "1-URGENT"), ("urgent-high", "y", "2-HIGH")], "composite_id string, role string, series_id string")
    panel = orders_daily(spark, d)
    spread = K.spread_bps(panel, legs).select(F.col("composite_id").alias("series_id"), "date", "value")
    return panel.select("series_id", "date", "value").unionByName(spread)


_INPUTS_SQL = with_ctes(
    "s1",
    body=""", every AS (SELECT * FROM s1 WHERE value IS NOT NULL UNION ALL SELECT 'urgent-high', a.date, (a.value - b.value) * 100
  FROM s1 a JOIN s1 b ON a.date = b.date AND a.series_id = '1-URGENT' AND b.series_id = '2-HIGH'),
m AS (SELECT series_id, last_day(date) AS date, arg_max(value, every.date) AS value FROM every GROUP BY 1, 2),
c AS (SELECT a.series_id, a.date, a.value - b.value AS diff FROM m a JOIN m b ON a.series_id = b.series_id AND last_day(b.date + INTERVAL 1 DAY) = a.date),
inputs AS (SELECT 'A' AS section, 'urgent' AS label, 'level' AS transform, date, value FROM every WHERE series_id = '1-URGENT'
UNION ALL SELECT 'A', 'urgent over high', 'level', date, value FROM every WHERE series_id = 'urgent-high'
UNION ALL SELECT * FROM (SELECT 'A', 'low rows', 'diff', date, value - lag(value) OVER (ORDER BY date) AS v FROM every WHERE series_id = '5-LOW') WHERE v IS NOT NULL
UNION ALL SELECT 'B', 'dhigh', 'month_diff', date, diff FROM c WHERE series_id = '2-HIGH'
UNION ALL SELECT 'B', 'dspread', 'month_diff', date, diff FROM c WHERE series_id = 'urgent-high'
UNION ALL SELECT * FROM (SELECT 'B', 'medium', 'month_pct', date, (value / lag(value) OVER (ORDER BY date) - 1) * 100 AS v FROM m WHERE series_id = '3-MEDIUM') WHERE v IS NOT NULL)
""",
)


@query("adf_inputs", _INPUTS_SQL + "SELECT section, label, transform, date, round(value, 4) AS value FROM inputs")
def adf_inputs(spark, d):
    """The series that go into the screen, composites among them."""
    return U.screen_inputs(_with_composite(spark, d), _items(spark)).select("section", "label", "transform", "date", r("value", 4))


_REPORT_SQL = f"""{{inputs}}, k AS (SELECT section || '|' || label AS series_id, date, value FROM inputs),
e AS ({_steps("k", 1)}),
e1 AS ({_regressed("e", "d1", "d", "y")}),
g AS (SELECT series_id, count(*) AS obs, regr_slope(d, y) AS b, regr_sxx(d, y) AS sxx, regr_sxy(d, y) AS sxy, regr_syy(d, y) AS syy FROM e1 GROUP BY 1),
f AS (SELECT *, {_SCORE} AS z FROM (SELECT series_id, b / sqrt((syy - b * sxy) / (obs - 3) / sxx) AS t FROM g WHERE obs > 3)),
p AS (SELECT series_id, t, {_P_VALUE} AS p FROM f),
n AS (SELECT section || '|' || label AS series_id, count(*) AS n, min(date) AS first, max(date) AS last FROM inputs GROUP BY 1),
j AS (SELECT i.*, coalesce(n.n, 0) AS n, first, last, CASE section WHEN 'A' THEN 60 ELSE 48 END AS floor, t, p
  FROM items i LEFT JOIN n ON n.series_id = section || '|' || label LEFT JOIN p ON p.series_id = n.series_id)
SELECT section, label AS series, transform, n, CASE WHEN n >= floor THEN first END AS start, CASE WHEN n >= floor THEN last END AS "end",
  CASE WHEN n >= floor THEN 1 END AS used_lag, CASE WHEN n >= floor THEN round(t, 6) END AS adf_stat, CASE WHEN n >= floor THEN round(p, 6) END AS p_value,
  CASE WHEN n = 0 THEN 'SKIP: no data' WHEN n < floor THEN 'SKIP: n<' || floor WHEN p < 0.05 THEN 'stationary' ELSE 'non-stationary' END AS verdict,
  CASE WHEN n < floor THEN '' WHEN section = 'A' THEN CASE WHEN p < 0.05 THEN 'expanding' ELSE 'rolling(252d)' END
    ELSE CASE WHEN p < 0.05 THEN 'OK as FM factor' ELSE '!! re-examine form' END END AS recommendation
FROM j"""
_ITEMS_SQL = """, items AS (SELECT * FROM (VALUES ('A', 'urgent', 'level'), ('A', 'urgent over high', 'level'), ('A', 'low rows', 'diff'), ('A', 'unknown', 'level'),
  ('B', 'dhigh', 'month_diff'), ('B', 'dspread', 'month_diff'), ('B', 'medium', 'month_pct')) v(section, label, transform))"""
_MONTHLY_SQL = with_ctes(
    "s3v",
    "reg",
    body=""", m AS (SELECT series_id, last_day(date) AS date, arg_max(value, s3v.date) AS value FROM s3v GROUP BY 1, 2),
inputs AS (SELECT 'B' AS section, a.series_id AS label, 'month_diff' AS transform, a.date, a.value - b.value AS value
  FROM m a JOIN m b ON a.series_id = b.series_id AND last_day(b.date + INTERVAL 1 DAY) = a.date),
items AS (SELECT 'B' AS section, series_id AS label, 'month_diff' AS transform FROM reg)""",
)


def _report(df):
    return df.withColumns({"adf_stat": F.round("adf_stat", 6), "p_value": F.round("p_value", 6)})


@query("adf_screen_monthly", _REPORT_SQL.format(inputs=_MONTHLY_SQL))
def adf_screen_monthly(spark, d):
    """Month-end changes of every supplier series at one lag, the shorter ones skipped."""
    items = supplier_registry(spark, d).select(
        F.lit("B").alias("section"), F.col("series_id").alias("label"), F.lit("month_diff").alias("transform"), "series_id"
    )
    return _report(U.screen(U.screen_inputs(supplier_daily(spark, d), items), items, lags=1))


@query("report_stationarity", _REPORT_SQL.format(inputs=_INPUTS_SQL + _ITEMS_SQL))
def report_stationarity(spark, d):
    """Both sections of the screen, composites among them, as a CSV report read back."""
    items = _items(spark)
    report = _report(U.screen(U.screen_inputs(_with_composite(spark, d), items), items, lags=1))
    path = scratch_path(spark, "stationarity")
    S.write_report(report.orderBy("section", "series"), path)
    return spark.read.schema(report.schema).option("header", True).csv(path).fillna("", ["recommendation"])
