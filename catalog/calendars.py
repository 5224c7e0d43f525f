"""Calendars, grids, resampling and fills."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import orders_daily, query, r, ship_daily, supplier_daily, table, with_ctes
from tidemark.functions import dates as D
from tidemark.operators import calendar as C


@query(
    "bday_grid",
    with_ctes(
        "s1",
        body="""SELECT CAST(d AS DATE) AS date FROM (SELECT unnest(generate_series(
  (SELECT CAST(min(date) AS TIMESTAMP) FROM s1), (SELECT CAST(max(date) AS TIMESTAMP) FROM s1), INTERVAL 1 DAY)) AS d)
WHERE isodow(d) < 6""",
    ),
)
def bday_grid(spark, d):
    return C.business_grid(orders_daily(spark, d))


RULES = {
    "W": "CAST(date_trunc('week', date) AS DATE) + 6",
    "ME": "last_day(date)",
    "QE": "last_day(date_trunc('quarter', date) + INTERVAL 2 MONTH)",
    "MS": "CAST(date_trunc('month', date) AS DATE)",
}


@query(
    "resample_last",
    with_ctes(
        "s3v",
        body=" UNION ALL ".join(
            f"SELECT '{k}' AS rule, series_id, {e} AS date, arg_max(value, s3v.date) AS value FROM s3v GROUP BY 2, 3"
            for k, e in RULES.items()
        ),
    ),
)
def resample_last(spark, d):
    panel = supplier_daily(spark, d)
    parts = [C.resample_last(panel, k).select(F.lit(k).alias("rule"), "series_id", "date", "value") for k in RULES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query(
    "ffill_grid",
    with_ctes(
        "s3",
        body=""", grid AS (SELECT CAST(d AS DATE) AS date FROM (SELECT unnest(generate_series(
  (SELECT CAST(min(date) AS TIMESTAMP) FROM s3), (SELECT CAST(max(date) AS TIMESTAMP) FROM s3), INTERVAL 1 DAY)) AS d)
  WHERE isodow(d) < 6)
SELECT g.series_id, g.date, s.date AS label, s.value
FROM (SELECT * FROM (SELECT DISTINCT series_id FROM s3), grid) g
ASOF JOIN s3 s ON g.series_id = s.series_id AND g.date >= s.date""",
    ),
)
def ffill_grid(spark, d):
    panel = supplier_daily(spark, d)
    return C.ffill_on_grid(panel, C.business_grid(panel)).select("series_id", "date", "label", "value")


@query(
    "bmonth_end",
    """SELECT month, bme AS business_month_end, n FROM (
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n,
  last_day(month) - CAST(greatest(isodow(last_day(month)) - 5, 0) AS INTEGER) AS bme
FROM orders GROUP BY 1)""",
)
def bmonth_end(spark, d):
    months = table(spark, d, "orders").groupBy(F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month"))
    return months.agg(F.count("*").alias("n")).withColumn(
        "business_month_end", D.business_month_end(F.col("month"))
    )


HOLIDAYS_SQL = """days AS (SELECT CAST(d AS DATE) AS d FROM (SELECT unnest(generate_series(
  TIMESTAMP '1994-12-01', TIMESTAMP '2002-03-01', INTERVAL 1 DAY)) AS d)),
dated AS (SELECT make_date(y, m, k) AS h FROM (SELECT unnest(range(1994, 2004)) AS y),
  (VALUES (1, 1), (7, 4), (11, 11), (12, 25)) v(m, k)),
holidays AS (
  SELECT CASE isodow(h) WHEN 6 THEN h - 1 WHEN 7 THEN h + 1 ELSE h END AS h FROM dated
  UNION SELECT d FROM days WHERE isodow(d) = 1 AND ((month(d) IN (1, 2) AND day(d) BETWEEN 15 AND 21)
    OR (month(d) = 5 AND day(d) >= 25) OR (month(d) = 9 AND day(d) <= 7) OR (month(d) = 10 AND day(d) BETWEEN 8 AND 14))
  UNION SELECT d FROM days WHERE isodow(d) = 4 AND month(d) = 11 AND day(d) BETWEEN 22 AND 28),
bdays AS (SELECT d, row_number() OVER (ORDER BY d) AS k FROM days
  WHERE isodow(d) < 6 AND d NOT IN (SELECT h FROM holidays))"""


@query(
    "add_business_days",
    with_ctes(
        "s3",
        body=f""", {HOLIDAYS_SQL},
ord AS (SELECT days.d, count(bdays.d) OVER (ORDER BY days.d) AS k FROM days LEFT JOIN bdays ON days.d = bdays.d)
SELECT s3.series_id, s3.date, b.d AS release_date FROM s3 JOIN ord ON s3.date = ord.d JOIN bdays b ON b.k = ord.k + 3""",
    ),
)
def add_business_days(spark, d):
    return supplier_daily(spark, d).select(
        "series_id", "date", D.add_business_days(F.col("date"), 3).alias("release_date")
    )


TRADING_SQL = """, idx AS (SELECT date, row_number() OVER (ORDER BY date) AS k FROM (SELECT DISTINCT date FROM src)),
st AS (SELECT series_id, count(*) AS n, min(date) AS lo, max(date) AS hi,
  avg(CASE WHEN isodow(date) < 6 THEN 1.0 ELSE 0.0 END) AS share FROM src WHERE value IS NOT NULL GROUP BY 1),
market AS (SELECT series_id FROM st JOIN idx a ON a.date = lo JOIN idx b ON b.date = hi
  WHERE n >= 100 AND n / (b.k - a.k + 1) > 0.5 AND share > 0.95),
open AS (SELECT DISTINCT date FROM src WHERE value IS NOT NULL AND isodow(date) < 6
  AND series_id IN (SELECT series_id FROM market))
SELECT series_id, date, value FROM src WHERE isodow(date) < 6
  AND (date IN (SELECT date FROM open) OR NOT EXISTS (SELECT 1 FROM market))"""


@query(
    "trading_days",
    with_ctes(
        "s2",
        body=""", src AS (SELECT series_id, date,
    CASE WHEN series_id NOT LIKE 'A%' OR isodow(date) < 6 AND day(date) <> 4 THEN value END AS value FROM s2)"""
        + TRADING_SQL,
    ),
)
def trading_days(spark, d):
    # Series A* have values as five-day market series closed on the 4th have, the others stay seven-day ones.
    has_value = ~F.col("series_id").startswith("A") | ((F.weekday("date") < 5) & (F.dayofmonth("date") != 4))
    return C.trading_days(ship_daily(spark, d).withColumn("value", F.when(has_value, F.col("value"))))


@query("trading_days_none", with_ctes("s2", body=", src AS (SELECT * FROM s2)" + TRADING_SQL))
def trading_days_none(spark, d):
    """No market series among seven-day ones: weekdays stay."""
    return C.trading_days(ship_daily(spark, d))


@query(
    "hybrid_grid_yoy",
    with_ctes(
        "s3v",
        body=""", starts AS (SELECT series_id, min(date) AS lo FROM s3v GROUP BY 1 HAVING min(date) < DATE '1998-01-01'),
dense AS (SELECT series_id, CAST(d AS DATE) AS date FROM (SELECT series_id,
  unnest(generate_series(CAST(lo AS TIMESTAMP), TIMESTAMP '1997-12-31', INTERVAL 1 DAY)) AS d FROM starts) WHERE isodow(d) < 6),
g AS (SELECT dense.series_id, dense.date, coalesce(s3v.value, 0) AS value
    FROM dense LEFT JOIN s3v ON dense.series_id = s3v.series_id AND dense.date = s3v.date
  UNION ALL SELECT series_id, date, value FROM s3v WHERE date >= DATE '1998-01-01')
SELECT series_id, date, value, round((value - b) / nullif(b, 0) * 100, 6) AS change_pct FROM (
  SELECT *, lag(value, 252) OVER (PARTITION BY series_id ORDER BY date) AS b FROM g)""",
    ),
)
def hybrid_grid_yoy(spark, d):
    out = C.hybrid_grid_change(supplier_daily(spark, d), "1998-01-01")
    return out.select("series_id", "date", "value", r("change_pct"))


@query(
    "anchor_trim",
    with_ctes(
        "s3",
        body="""SELECT * FROM s3 WHERE date >= (SELECT CAST(date_trunc('year', min(date)) AS DATE) FROM s3
  WHERE series_id IN ('S3', 'S5') AND value IS NOT NULL) AND date >= DATE '1995-02-01'""",
    ),
)
def anchor_trim(spark, d):
    return C.anchor_trim(supplier_daily(spark, d), ["S3", "S5"], floor="1995-02-01", to_year_start=True)


@query(
    "pending_tail",
    with_ctes(
        "s3",
        body=""", idx AS (SELECT DISTINCT date FROM s3),
lv AS (SELECT series_id, max(date) AS ld, arg_max(value, date) AS lval FROM s3 WHERE value IS NOT NULL GROUP BY 1)
SELECT lv.series_id, idx.date, CASE WHEN idx.date > ld THEN lval ELSE s3.value END AS value, idx.date > ld AS is_pending
FROM lv CROSS JOIN idx LEFT JOIN s3 ON s3.series_id = lv.series_id AND s3.date = idx.date""",
    ),
)
def pending_tail(spark, d):
    panel = supplier_daily(spark, d)
    return C.pending_tail(panel, panel.select("date").distinct())


@query(
    "trailing_years",
    with_ctes(
        "s3",
        body=" UNION ALL ".join(
            f"SELECT {n} AS years, * FROM s3 WHERE date >= (SELECT max(date) FROM s3) - INTERVAL {12 * n} MONTH"
            for n in (1, 2, 3, 5, 7, 10)
        ),
    ),
)
def trailing_years(spark, d):
    return C.trailing_years(supplier_daily(spark, d), 1, 2, 3, 5, 7, 10)


@query(
    "date_union",
    with_ctes("s1", "s3", body="SELECT date FROM s1 UNION SELECT date FROM s3"),
)
def date_union(spark, d):
    return C.date_union(orders_daily(spark, d), supplier_daily(spark, d))


@query(
    "reindex",
    with_ctes(
        "s1",
        "s2",
        body=""", idx AS (SELECT s1.series_id, d.date FROM (SELECT DISTINCT series_id FROM s1) s1, (SELECT DISTINCT date FROM s2) d)
SELECT idx.series_id, idx.date, s1.value FROM idx LEFT JOIN s1 ON idx.series_id = s1.series_id AND idx.date = s1.date""",
    ),
)
def reindex(spark, d):
    panel, other = orders_daily(spark, d), ship_daily(spark, d)
    lo, hi = (other.agg(f("date")).scalar() for f in (F.min, F.max))
    every_day = panel.select("series_id").distinct().withColumn("date", F.explode(F.sequence(lo, hi)))
    index = every_day.join(other.select("date").distinct(), "date", "left_semi")
    return C.reindex(panel, index)
