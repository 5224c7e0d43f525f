"""Composites over groups of suppliers: legs come from the supplier table, many composites at once."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import orders_daily, query, r, supplier_daily, table, with_ctes
from tidemark.operators import composites as K
from tidemark.operators.calendar import resample_last


def legs_of(spark, d, roles):
    """Consecutive suppliers form one composite, one supplier per role."""
    n = len(roles)
    key = F.col("s_suppkey")
    return table(spark, d, "supplier").select(
        F.concat(F.lit("C"), F.floor(key / n).cast("string")).alias("composite_id"),
        F.element_at(F.array(*[F.lit(x) for x in roles]), (key % n + 1).cast("int")).alias("role"),
        F.concat(F.lit("S"), key.cast("string")).alias("series_id"),
    )


def legs_sql(roles, source="s3") -> str:
    n = len(roles)
    cols = ", ".join(f"max(p.value) FILTER (role = '{x}') AS {x}" for x in roles)
    return f"""legs AS (SELECT 'C' || CAST(s_suppkey // {n} AS VARCHAR) AS composite_id,
  {list(roles)!r}[CAST(s_suppkey % {n} + 1 AS INTEGER)] AS role, 'S' || CAST(s_suppkey AS VARCHAR) AS series_id FROM supplier),
t AS (SELECT composite_id, date, {cols} FROM {source} p JOIN legs USING (series_id) GROUP BY 1, 2)"""


def filled_sql(roles) -> str:
    return "f AS (SELECT composite_id, date, " + ", ".join(
        f"last_value({x} IGNORE NULLS) OVER w AS {x}" for x in roles
    ) + " FROM t WINDOW w AS (PARTITION BY composite_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"


ABC, XY, ABD, MC = ("a", "b", "c"), ("x", "y"), ("a", "b", "d"), ("m", "c")


@query(
    "composite_net3",
    with_ctes(
        "s3",
        body=f", {legs_sql(ABC)}, {filled_sql(ABC)} SELECT composite_id, date, round(a / 1000 - b / 1000 - c, 5) AS value FROM f",
    ),
)
def composite_net3(spark, d):
    return K.net_of_two(supplier_daily(spark, d), legs_of(spark, d, ABC)).select("composite_id", "date", r("value", 5))


@query(
    "spread_inner_bps",
    with_ctes(
        "s3",
        body=f", {legs_sql(XY)} SELECT composite_id, date, round((x - y) * 100, 4) AS value FROM t WHERE x IS NOT NULL AND y IS NOT NULL",
    ),
)
def spread_inner_bps(spark, d):
    return K.spread_bps(supplier_daily(spark, d), legs_of(spark, d, XY)).select("composite_id", "date", r("value", 4))


@query("spread_outer", with_ctes("s3", body=f", {legs_sql(XY)} SELECT composite_id, date, round(x - y, 4) AS value FROM t"))
def spread_outer(spark, d):
    return K.spread(supplier_daily(spark, d), legs_of(spark, d, XY)).select("composite_id", "date", r("value", 4))


@query(
    "growth_differential",
    with_ctes(
        "s3v",
        body=f""", ms AS (SELECT series_id, CAST(date_trunc('month', date) AS DATE) AS date, arg_max(value, s3v.date) AS value
  FROM s3v GROUP BY 1, 2), {legs_sql(MC, "ms")}
SELECT t.composite_id, t.date, round((t.m / nullif(o.m, 0) - 1) * 100 - (t.c / nullif(o.c, 0) - 1) * 100, 5) AS value
FROM t LEFT JOIN t o ON o.composite_id = t.composite_id AND o.date = t.date - INTERVAL 12 MONTH""",
    ),
)
def growth_differential(spark, d):
    out = K.growth_differential(supplier_daily(spark, d), legs_of(spark, d, MC))
    return out.select("composite_id", "date", r("value", 5))


@query(
    "ratio_ffill",
    with_ctes(
        "s3",
        body=f""", {legs_sql(XY)}, {filled_sql(XY)}
SELECT composite_id, date, round(x / 1000 / y, 8) AS value FROM f WHERE x IS NOT NULL AND y IS NOT NULL""",
    ),
)
def ratio_ffill(spark, d):
    return K.ratio_scaled(supplier_daily(spark, d), legs_of(spark, d, XY)).select("composite_id", "date", r("value", 8))


# A daily series over the month-end total of all orders, which every composite shares.
MIXED_SQL = f""", mo AS (SELECT last_day(date) AS date, arg_max(value, s1.date) AS y FROM s1 WHERE series_id = '1-URGENT' GROUP BY 1),
t AS (SELECT series_id AS composite_id, date, value AS x, NULL AS y FROM s3
  UNION ALL SELECT s.series_id, mo.date, NULL, mo.y FROM (SELECT DISTINCT series_id FROM s3) s, mo),
u AS (SELECT composite_id, date, max(x) AS x, max(y) AS y FROM t GROUP BY 1, 2),
f AS (SELECT composite_id, date, last_value(x IGNORE NULLS) OVER w AS x, last_value(y IGNORE NULLS) OVER w AS y
  FROM u WINDOW w AS (PARTITION BY composite_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT composite_id, date, round(x / y, 8) AS value FROM f WHERE x IS NOT NULL AND y IS NOT NULL"""


@query("ratio_mixed_freq", with_ctes("s3", "s1", body=MIXED_SQL))
def ratio_mixed_freq(spark, d):
    monthly = resample_last(orders_daily(spark, d).where("series_id = '1-URGENT'"), "ME")
    daily = supplier_daily(spark, d)
    ids = table(spark, d, "supplier").select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("composite_id"))
    legs = K.legs_table(ids, "composite_id", {"x": F.col("composite_id"), "y": F.lit("1-URGENT")})
    out = K.ratio_scaled(daily.unionByName(monthly), legs, scale=1.0)
    return out.select("composite_id", "date", r("value", 8))


@query(
    "composite_balance",
    with_ctes(
        "s3",
        body=f""", {legs_sql(ABD)}, {filled_sql(ABD)}
SELECT composite_id, date, round(a + b - d, 4) AS value FROM f WHERE a IS NOT NULL AND b IS NOT NULL AND d IS NOT NULL""",
    ),
)
def composite_balance(spark, d):
    out = K.three_term_balance(supplier_daily(spark, d), legs_of(spark, d, ABD))
    return out.select("composite_id", "date", r("value", 4))


ME_SQL = "me AS (SELECT series_id, last_day(date) AS date, arg_max(value, s3v.date) AS value FROM s3v GROUP BY 1, 2)"


@query(
    "ratio_z_monthly",
    with_ctes(
        "s3v",
        body=f""", {legs_sql(XY)}, {filled_sql(XY)}, {ME_SQL},
line AS (SELECT composite_id, date, x * 1000 / y AS ratio FROM f WHERE x IS NOT NULL AND y IS NOT NULL),
mt AS (SELECT composite_id, me.date, max(me.value) FILTER (role = 'x') AS x, max(me.value) FILTER (role = 'y') AS y
  FROM me JOIN legs USING (series_id) GROUP BY 1, 2),
sp AS (SELECT composite_id, unnest(generate_series(date_trunc('month', min(date)), date_trunc('month', max(date)), INTERVAL 1 MONTH)) AS m
  FROM mt GROUP BY 1),
md AS (SELECT sp.composite_id, last_day(sp.m) AS date, x * 1000 / y AS v FROM sp LEFT JOIN mt
  ON mt.composite_id = sp.composite_id AND mt.date = last_day(sp.m)),
z AS (SELECT composite_id, date, CASE WHEN count(v) OVER w >= 60 THEN (v - avg(v) OVER w) / stddev_samp(v) OVER w END AS z
  FROM md WINDOW w AS (PARTITION BY composite_id ORDER BY date ROWS BETWEEN 59 PRECEDING AND CURRENT ROW))
SELECT line.composite_id, line.date, round(ratio, 6) AS ratio, round(z.z, 6) AS z
FROM line ASOF LEFT JOIN z ON line.composite_id = z.composite_id AND line.date >= z.date""",
    ),
)
def ratio_z_monthly(spark, d):
    out = K.ratio_with_monthly_z(supplier_daily(spark, d), legs_of(spark, d, XY))
    return out.select("composite_id", "date", r("ratio"), r("z"))


@query(
    "ratio_excess_growth",
    with_ctes(
        "s3v",
        body=f""", {ME_SQL}, {legs_sql(XY, "me")},
b AS (SELECT t.*, o.x AS x0, o.y AS y0 FROM t LEFT JOIN t o ON o.composite_id = t.composite_id AND o.date = last_day(t.date - INTERVAL 12 MONTH)
  WHERE t.x IS NOT NULL AND t.y IS NOT NULL),
v AS (SELECT *, x / 1000 / y * 100 AS p FROM b)
SELECT composite_id, date, round(p, 6) AS ratio_pct,
  round(CASE WHEN count(p) OVER w >= 60 THEN (p - avg(p) OVER w) / stddev_samp(p) OVER w END, 6) AS z,
  round((x / nullif(x0, 0) - 1) * 100 - (y / nullif(y0, 0) - 1) * 100, 5) AS excess_growth
FROM v WINDOW w AS (PARTITION BY composite_id ORDER BY date ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)""",
    ),
)
def ratio_excess_growth(spark, d):
    out = K.ratio_excess_growth(supplier_daily(spark, d), legs_of(spark, d, XY))
    return out.select("composite_id", "date", r("ratio_pct"), r("z"), r("excess_growth", 5))


@query(
    "notional",
    with_ctes(
        "s3",
        body="""SELECT series_id, date, round(value * CASE s_suppkey % 3 WHEN 0 THEN 200000 ELSE 100000 END / 1e9, 6) AS value
FROM s3 JOIN supplier ON series_id = 'S' || CAST(s_suppkey AS VARCHAR) WHERE s_suppkey % 3 < 2""",
    ),
)
def notional(spark, d):
    key = F.col("s_suppkey")
    faces = table(spark, d, "supplier").where(key % 3 < 2).select(
        F.concat(F.lit("S"), key.cast("string")).alias("series_id"),
        F.when(key % 3 == 0, 200_000).otherwise(100_000).alias("face_value"),
    )
    return K.notional(supplier_daily(spark, d), faces).select("series_id", "date", r("value"))


@query("band", with_ctes("s3", body=f", {legs_sql(('lower', 'upper'))} SELECT * FROM t"))
def band(spark, d):
    return K.band(supplier_daily(spark, d), legs_of(spark, d, ("lower", "upper")))
