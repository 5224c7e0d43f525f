"""Merge, refresh, splice and insert queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import money, query, supplier_daily, supplier_registry, table, with_ctes
from tidemark.operators import merge as M
from tidemark.operators import quality as Q

# An older and a newer load of the supplier series: the newer one is dated 30 days
# later, has another value, and holds missing values of its own.
LOADS_SQL = """, newer AS (SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS series_id, CAST(l_shipdate AS DATE) + 30 AS date,
  CAST(CASE WHEN max(l_discount) < 0.1 THEN sum(CAST(l_quantity AS DECIMAL(18,2))) END AS DOUBLE) AS value
  FROM lineitem GROUP BY 1, 2)
"""


def newer_load(spark, d):
    return (
        table(spark, d, "lineitem")
        .groupBy(
            F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("series_id"),
            F.date_add(F.col("l_shipdate").cast("date"), 30).alias("date"),
        )
        .agg(F.when(F.max("l_discount") < 0.1, money("l_quantity")).cast("double").alias("value"))
    )


@query(
    "merge_accumulate",
    with_ctes(
        "s3",
        body=LOADS_SQL
        + """SELECT series_id, date, coalesce(n.value, o.value) AS value
FROM s3 o FULL JOIN newer n USING (series_id, date)""",
    ),
)
def merge_accumulate(spark, d):
    return M.accumulate(supplier_daily(spark, d), newer_load(spark, d))


@query(
    "merge_incremental",
    with_ctes(
        "s3",
        body=LOADS_SQL
        + """, old AS (SELECT * FROM s3),
ends AS (SELECT series_id, max(date) AS e FROM old GROUP BY 1),
fresh AS (SELECT newer.* FROM newer LEFT JOIN ends USING (series_id) WHERE e IS NULL OR date >= e - 7)
SELECT series_id, date, coalesce(n.value, o.value) AS value FROM old o FULL JOIN fresh n USING (series_id, date)""",
    ),
)
def merge_incremental(spark, d):
    """The whole store refreshed by the whole newer load, which counts from a week before each series ends."""
    return M.refresh(supplier_daily(spark, d), newer_load(spark, d))


@query(
    "splice_history",
    with_ctes(
        "s3",
        body=LOADS_SQL
        + """SELECT series_id, date, coalesce(n.value, o.value) AS value FROM newer n FULL JOIN s3 o USING (series_id, date)
WHERE date IN (SELECT date FROM newer)""",
    ),
)
def splice_history(spark, d):
    canonical = newer_load(spark, d)
    return M.splice(canonical, supplier_daily(spark, d), canonical.select("date").distinct())


@query(
    "splice_monthly",
    with_ctes(
        "s3v",
        body=LOADS_SQL
        + """, a AS (SELECT series_id, last_day(date) AS date, arg_max(value, newer.date) AS value FROM newer WHERE value IS NOT NULL GROUP BY 1, 2),
b AS (SELECT series_id, last_day(date) AS date, arg_max(value, s3v.date) AS value FROM s3v GROUP BY 1, 2)
SELECT series_id, date, coalesce(a.value, b.value) AS value FROM a FULL JOIN b USING (series_id, date)""",
    ),
)
def splice_monthly(spark, d):
    return M.splice_monthly(newer_load(spark, d), supplier_daily(spark, d))


@query(
    "dedupe_last",
    """SELECT o_custkey, CAST(o_orderdate AS DATE) AS date, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) = 1""",
)
def dedupe_last(spark, d):
    orders = table(spark, d, "orders").select(
        "o_custkey", F.col("o_orderdate").cast("date").alias("date"), "o_orderkey", "o_totalprice"
    )
    return M.keep_last(orders, ["o_custkey", "date"], ["o_orderkey"])


@query(
    "insert_ignore",
    with_ctes(
        "s3",
        body=LOADS_SQL + "SELECT * FROM s3 WHERE (series_id, date) NOT IN (SELECT (series_id, date) FROM newer)",
    ),
)
def insert_ignore(spark, d):
    return M.insert_ignore(newer_load(spark, d), supplier_daily(spark, d), ["series_id", "date"])


@query(
    "join_registered",
    with_ctes(
        "s1",
        "s3",
        "reg",
        body="""SELECT * FROM s1 UNION ALL SELECT * FROM s3
WHERE series_id IN (SELECT series_id FROM reg WHERE lag IS NOT NULL) AND date IN (SELECT date FROM s1)""",
    ),
)
def join_registered(spark, d):
    from catalog.base import orders_daily

    return M.join_registered(orders_daily(spark, d), supplier_daily(spark, d), supplier_registry(spark, d))


@query(
    "no_drop_guard",
    with_ctes(
        "s1",
        "s3",
        "reg",
        body=""", kept AS (SELECT * FROM s3 WHERE series_id IN (SELECT series_id FROM reg WHERE lag IS NOT NULL)
  AND date IN (SELECT date FROM s1)),
b AS (SELECT series_id, count(value) AS n FROM s3 WHERE date BETWEEN (SELECT min(date) FROM kept) AND (SELECT max(date) FROM kept) GROUP BY 1),
a AS (SELECT series_id, count(value) AS n FROM kept GROUP BY 1)
SELECT series_id, coalesce(b.n, 0) AS n_before, coalesce(a.n, 0) AS n_after, coalesce(a.n, 0) < coalesce(b.n, 0) AS dropped
FROM b FULL JOIN a USING (series_id)""",
    ),
)
def no_drop_guard(spark, d):
    """Which supplier series lose values when held to the order dates."""
    from catalog.base import orders_daily

    before = supplier_daily(spark, d)
    empty = orders_daily(spark, d).where(F.lit(False))
    days = orders_daily(spark, d).select("date").distinct()
    listed = supplier_registry(spark, d).where(F.col("lag").isNotNull()).select("series_id")
    after = empty.unionByName(before.join(listed, "series_id", "left_semi").join(days, "date", "left_semi"))
    return Q.dropped_counts(before, after)
