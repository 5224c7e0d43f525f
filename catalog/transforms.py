"""Window transforms (past-only), on the supplier series unless said otherwise."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import orders_daily, query, r, supplier_daily, supplier_registry, with_ctes
from tidemark.operators import calendar as C
from tidemark.operators import transforms as X
from tidemark.plans.features import apply_transforms
from tidemark.session import materialize


def z_sql(name: str, frame: str, need: int) -> str:
    """Rolling or expanding z as plain window functions."""
    return with_ctes(
        name,
        body=f"""SELECT series_id, date, round(CASE WHEN n >= {need} AND sd > 0 THEN (value - m) / sd END, 6) AS z
FROM (SELECT series_id, date, value, count(value) OVER w AS n, avg(value) OVER w AS m, stddev_samp(value) OVER w AS sd
  FROM {name} WINDOW w AS (PARTITION BY series_id ORDER BY date ROWS BETWEEN {frame}))""",
    )


@query("zscore_rolling", z_sql("s3", "251 PRECEDING AND CURRENT ROW", 126))
def zscore_rolling(spark, d):
    return X.rolling_zscore(supplier_daily(spark, d), 252).select("series_id", "date", r("z"))


@query("zscore_rolling_lag1", z_sql("s3", "252 PRECEDING AND 1 PRECEDING", 126))
def zscore_rolling_lag1(spark, d):
    return X.rolling_zscore(supplier_daily(spark, d), 252, lag=1).select("series_id", "date", r("z"))


@query("zscore_expanding", z_sql("s3", "UNBOUNDED PRECEDING AND CURRENT ROW", 60))
def zscore_expanding(spark, d):
    return X.expanding_zscore(supplier_daily(spark, d)).select("series_id", "date", r("z"))


@query("zscore_expanding_lag1", z_sql("s3", "UNBOUNDED PRECEDING AND 1 PRECEDING", 60))
def zscore_expanding_lag1(spark, d):
    return X.expanding_zscore(supplier_daily(spark, d), lag=1).select("series_id", "date", r("z"))


@query(
    "yoy_native",
    with_ctes(
        "s3v",
        body="""SELECT series_id, date, round((value / nullif(b, 0) - 1) * 100, 6) AS yoy FROM (
  SELECT series_id, date, value, lag(value, 12) OVER (PARTITION BY series_id ORDER BY date) AS b
  FROM (SELECT series_id, last_day(date) AS date, arg_max(value, date) AS value FROM s3v GROUP BY 1, 2))""",
    ),
)
def yoy_native(spark, d):
    return X.yoy(C.resample_last(supplier_daily(spark, d), "ME"), 12).select("series_id", "date", r("yoy"))


@query(
    "yoy_calendar",
    with_ctes(
        "s3v",
        body=""", m AS (SELECT series_id, CAST(date_trunc('month', date) AS DATE) AS date, arg_max(value, date) AS value
  FROM s3v GROUP BY 1, 2)
SELECT a.series_id, a.date, round((a.value / nullif(b.value, 0) - 1) * 100, 6) AS yoy
FROM m a LEFT JOIN m b ON a.series_id = b.series_id AND b.date = a.date - INTERVAL 12 MONTH""",
    ),
)
def yoy_calendar(spark, d):
    return X.yoy_calendar(C.resample_last(supplier_daily(spark, d), "MS")).select("series_id", "date", r("yoy"))


@query(
    "pct_change_1m",
    with_ctes(
        "s3",
        body="""SELECT series_id, date, round((f / nullif(lag(f, 21) OVER (PARTITION BY series_id ORDER BY date), 0) - 1) * 100, 6) AS pct1m
FROM (SELECT series_id, date, last_value(value IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY date
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS f FROM s3)""",
    ),
)
def pct_change_1m(spark, d):
    return X.pct_change_rows(supplier_daily(spark, d), 21).select("series_id", "date", r("pct1m"))


@query(
    "diff_bps",
    with_ctes(
        "s3",
        body="""SELECT series_id, date, round((value - lag(value) OVER (PARTITION BY series_id ORDER BY date)) * 100, 4) AS diff_bps
FROM s3""",
    ),
)
def diff_bps(spark, d):
    return X.diff_bps(supplier_daily(spark, d)).select("series_id", "date", r("diff_bps", 4))


@query(
    "diff_native",
    with_ctes(
        "s3v",
        body=""", n AS (SELECT series_id, label, value - lag(value) OVER (PARTITION BY series_id ORDER BY label) AS diff FROM (
  SELECT series_id, CAST(date_trunc('week', date) AS DATE) + 6 AS label, arg_max(value, date) AS value FROM s3v GROUP BY 1, 2))
SELECT g.series_id, g.date, n.label, round(n.diff, 4) AS diff
FROM (SELECT * FROM (SELECT DISTINCT series_id FROM s3v), (SELECT DISTINCT date FROM s3)) g
ASOF JOIN n ON g.series_id = n.series_id AND g.date >= n.label""",
    ),
)
def diff_native(spark, d):
    panel = supplier_daily(spark, d)
    weekly = X.diff(C.resample_last(panel, "W")).select("series_id", "date", F.col("diff").alias("value"))
    held = C.ffill_on_grid(weekly, panel.select("date").distinct())
    return held.select("series_id", "date", "label", F.round("value", 4).alias("diff"))


@query("level", with_ctes("s3", body="SELECT series_id, 'level' AS transform, date, value FROM s3"))
def level(spark, d):
    # A registry without transforms leaves exactly the levels.
    panel = supplier_daily(spark, d)
    empty = F.array().cast("array<string>")
    registry = supplier_registry(spark, d).withColumns({"mon_transforms": empty, "fm_transforms": empty})
    return apply_transforms(panel, registry, "mon").select("series_id", "transform", "date", "value")


def duration_sql(years: int) -> str:
    sizes = {"D": 252 * years, "W": 52 * years, "M": 12 * years, "Q": 4 * years}
    parts = " UNION ALL ".join(
        f"""SELECT series_id, date, round(CASE WHEN n >= {w // 2} AND sd > 0 THEN (value - m) / sd END, 6) AS z
FROM (SELECT series_id, date, value, count(value) OVER w AS n, avg(value) OVER w AS m, stddev_samp(value) OVER w AS sd
  FROM native WHERE frequency = '{f}'
  WINDOW w AS (PARTITION BY series_id ORDER BY date ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW))"""
        for f, w in sizes.items()
    )
    return with_ctes("native", body=parts)


def _duration(years: int):
    def run(spark, d):
        native = C.to_native(supplier_daily(spark, d), supplier_registry(spark, d))
        return X.zscore_by_duration(native, years).select("series_id", "date", r("z"))

    return run


for _years in (1, 3, 5):
    query(f"zscore_{_years}y", duration_sql(_years))(_duration(_years))


@query(
    "frequency_guard",
    with_ctes(
        "s3v",
        "reg",
        body=""", gaps AS (SELECT series_id, date - lag(date) OVER (PARTITION BY series_id ORDER BY date) AS gap FROM s3v),
m AS (SELECT series_id, count(*) AS n_obs, median(gap) AS median_gap FROM gaps GROUP BY 1)
SELECT series_id, frequency, n_obs, CAST(median_gap AS DOUBLE) AS median_gap,
  CAST(CASE frequency WHEN 'D' THEN 1 WHEN 'W' THEN 7 WHEN 'M' THEN 30 ELSE 91 END AS INTEGER) AS expected_gap,
  n_obs < 3 OR median_gap BETWEEN 0.5 * expected_gap AND 2 * expected_gap AS ok
FROM m JOIN reg USING (series_id)""",
    ),
)
def frequency_guard(spark, d):
    return X.frequency_check(supplier_daily(spark, d), supplier_registry(spark, d))


@query(
    "zscore_of_diff",
    with_ctes(
        "s1",
        body=""", w AS (SELECT series_id, CAST(date_trunc('week', date) AS DATE) + 6 AS date, arg_max(value, date) AS value
  FROM s1 GROUP BY 1, 2),
dd AS (SELECT series_id, date, value - lag(value) OVER (PARTITION BY series_id ORDER BY date) AS diff FROM w)
SELECT series_id, date, round(diff, 4) AS diff,
  round(CASE WHEN count(diff) OVER f >= 260 THEN (diff - avg(diff) OVER f) / stddev_samp(diff) OVER f END, 6) AS z
FROM dd WINDOW f AS (PARTITION BY series_id ORDER BY date ROWS BETWEEN 259 PRECEDING AND CURRENT ROW)""",
    ),
)
def zscore_of_diff(spark, d):
    weekly = C.resample_last(orders_daily(spark, d), "W")
    return X.zscore_of_diff(weekly, 260).select("series_id", "date", r("diff", 4), r("z"))


def features_sql(source: str, levels: str, grid: str, needs: tuple[str, ...]) -> str:
    """The dispatch spelled out: transforms at native frequency held over the dates, and row-counted ones."""
    rolling = " UNION ALL ".join(
        f"""SELECT series_id, '{suffix}' AS transform, date, CASE WHEN n >= {w // 2} AND sd > 0 THEN (value - m) / sd END AS value
FROM (SELECT series_id, date, value, count(value) OVER w AS n, avg(value) OVER w AS m, stddev_samp(value) OVER w AS sd
  FROM nat WHERE frequency = '{f}' AND list_contains(tf, '{t}')
  WINDOW w AS (PARTITION BY series_id ORDER BY date ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW))"""
        for t, suffix, y in (("zscore_rolling_1y", "zscore", 1), ("zscore_rolling_5y", "zscore_5y", 5))
        for f, w in (("D", 252 * y), ("W", 52 * y), ("M", 12 * y), ("Q", 4 * y))
    )
    return with_ctes(
        *needs,
        body=f""", src AS ({source}),
nat AS (SELECT p.series_id, g.frequency, g.tf, CASE g.frequency WHEN 'D' THEN p.date
      WHEN 'W' THEN CAST(date_trunc('week', p.date) AS DATE) + 6 WHEN 'M' THEN last_day(p.date)
      ELSE last_day(date_trunc('quarter', p.date) + INTERVAL 2 MONTH) END AS date,
      arg_max(p.value, p.date) AS value
    FROM src p JOIN reg g USING (series_id) WHERE p.value IS NOT NULL GROUP BY 1, 2, 3, 4),
grid AS ({grid}),
lagged AS (SELECT *, value - lag(value) OVER o AS diff,
    CASE frequency WHEN 'D' THEN lag(value, 252) OVER o WHEN 'W' THEN lag(value, 52) OVER o
      WHEN 'M' THEN lag(value, 12) OVER o ELSE lag(value, 4) OVER o END AS base,
    count(value) OVER x AS n, avg(value) OVER x AS m, stddev_samp(value) OVER x AS sd,
    CASE frequency WHEN 'D' THEN 252 WHEN 'W' THEN 52 WHEN 'M' THEN 12 ELSE 4 END AS need
  FROM nat WINDOW o AS (PARTITION BY series_id ORDER BY date),
    x AS (PARTITION BY series_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
labelled AS (
  SELECT series_id, 'diff' AS transform, date, diff AS value FROM lagged WHERE list_contains(tf, 'diff')
  UNION ALL SELECT series_id, 'yoy', date, (value / nullif(base, 0) - 1) * 100 FROM lagged WHERE list_contains(tf, 'yoy')
  UNION ALL SELECT series_id, 'zscore_exp', date, CASE WHEN n >= need AND sd > 0 THEN (value - m) / sd END
    FROM lagged WHERE list_contains(tf, 'zscore_expanding')
  UNION ALL {rolling}),
held AS (SELECT g.series_id, g.transform, g.date, l.value
  FROM (SELECT * FROM (SELECT DISTINCT series_id, transform FROM labelled), grid) g
  ASOF JOIN labelled l ON g.series_id = l.series_id AND g.transform = l.transform AND g.date >= l.date),
dense AS (SELECT q.series_id, q.tf, q.date, s.value AS filled, CASE WHEN s.date = q.date THEN s.value END AS observed
  FROM (SELECT * FROM (SELECT series_id, tf FROM reg WHERE list_has_any(tf, ['pct_change_1m', 'diff_bps'])), grid) q
  ASOF JOIN (SELECT * FROM src WHERE value IS NOT NULL) s ON q.series_id = s.series_id AND q.date >= s.date),
counted AS (SELECT *, (filled / nullif(lag(filled, 21) OVER o, 0) - 1) * 100 AS pct,
    (observed - lag(observed) OVER o) * 100 AS bps
  FROM dense WINDOW o AS (PARTITION BY series_id ORDER BY date))
SELECT series_id, transform, date, round(value, 5) AS value FROM (
  SELECT series_id, 'level' AS transform, date, value FROM ({levels})
  UNION ALL SELECT series_id, 'pct1m', date, pct FROM counted WHERE list_contains(tf, 'pct_change_1m')
  UNION ALL SELECT series_id, 'diff_bps', date, bps FROM counted WHERE list_contains(tf, 'diff_bps')
  UNION ALL SELECT * FROM held)""",
    )


@query(
    "features_mon",
    features_sql(
        "SELECT series_id, date, value FROM s3",
        "SELECT series_id, date, value FROM src JOIN reg USING (series_id)",
        "SELECT DISTINCT date FROM src",
        ("s3", "reg"),
    ),
)
def features_mon(spark, d):
    panel = materialize(supplier_daily(spark, d), "panel")
    # Ship days are irregular on purpose: resampling is what the query shows.
    out = apply_transforms(panel, supplier_registry(spark, d), "mon", check_frequency=False)
    return out.select("series_id", "transform", "date", r("value", 5))
