"""Landing files, stores, registry and sinks; the files are written by Spark from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import (
    query,
    supplier_daily,
    supplier_registry,
    supplier_vintages,
    table,
    with_ctes,
)
from tidemark.operators import quality as Q
from tidemark.operators import reshape as R
from tidemark.session import scratch_path
from tidemark.sources import landing as L
from tidemark.sources import registry as G
from tidemark.sources import store as S


@query("scan_panel", with_ctes("s3", body="SELECT * FROM s3 WHERE NOT starts_with(series_id, 'S1')"))
def scan_panel(spark, d):
    """Stored panel read back without one family of series."""
    path = scratch_path(spark, "panel")
    S.write_panel(supplier_daily(spark, d), path, buckets=8)
    return S.read_panel(spark, path, skip_prefix="S1", buckets=8)


@query(
    "scan_panel_pruned",
    with_ctes("s3", body="SELECT * FROM s3 WHERE series_id IN ('S2', 'S5')"),
)
def scan_panel_pruned(spark, d):
    """Two named series: the other buckets are not opened."""
    path = scratch_path(spark, "panel")
    S.write_panel(supplier_daily(spark, d), path, buckets=8)
    return S.read_panel(spark, path, series=["S2", "S5"], buckets=8)


@query(
    "scan_bucketed",
    with_ctes(
        "s3v",
        body="SELECT series_id, min(date) AS first_valid, max(date) AS last_valid, count(*) AS n, arg_max(value, date) AS last_value FROM s3v GROUP BY 1",
    ),
)
def scan_bucketed(spark, d):
    """Coverage read off a table bucketed by series: no shuffle."""
    path = scratch_path(spark, "bucketed")
    stored = S.save_panel_table(supplier_daily(spark, d), "panel_" + path[-32:], path, buckets=8)
    return Q.series_coverage(stored)


@query(
    "scan_vintage",
    with_ctes(
        "vint", body="SELECT * FROM vint WHERE date >= DATE '1997-01-01' AND realtime_start >= DATE '1998-01-01'"
    ),
)
def scan_vintage(spark, d):
    path = scratch_path(spark, "vintages")
    S.write_vintages(supplier_vintages(spark, d), path, buckets=8)
    return S.read_vintages(spark, path, data_from="1997-01-01", realtime_from="1998-01-01", buckets=8)


def observation_documents(spark, d):
    """Vintages as a provider would send them: one document per series and data date, all text."""
    rows = supplier_vintages(spark, d).groupBy("series_id", "date").agg(
        F.collect_list(
            F.struct(
                F.date_format("realtime_start", "yyyy-MM-dd").alias("realtime_start"),
                F.date_format("date", "yyyy-MM-dd").alias("date"),
                # A missing value is sent as a dot.
                F.coalesce(F.col("value").cast("decimal(28,2)").cast("string"), F.lit(".")).alias("value"),
            )
        ).alias("observations")
    )
    good = F.to_json(F.struct("series_id", "observations"))
    # Documents of December months arrive cut off.
    return rows.select(
        "series_id", "date", F.when(F.month("date") == 12, F.substring(good, 1, 30)).otherwise(good).alias("payload")
    )


@query("ingest_vintage", with_ctes("vint", body="SELECT * FROM vint WHERE month(date) <> 12"))
def ingest_vintage(spark, d):
    path = scratch_path(spark, "landing")
    observation_documents(spark, d).select("payload").write.text(path)
    return L.ingest_vintages(spark, path)


@query(
    "ingest_quarantine",
    with_ctes("vint", body="SELECT count(DISTINCT (series_id, date)) AS n_bad, CAST(30 AS BIGINT) AS longest FROM vint WHERE month(date) = 12"),
)
def ingest_quarantine(spark, d):
    path = scratch_path(spark, "landing")
    observation_documents(spark, d).select("payload").write.text(path)
    bad = L.quarantined_pages(L.read_observation_pages(spark, path))
    return bad.agg(F.count("*").alias("n_bad"), F.max(F.length("payload")).cast("bigint").alias("longest"))


def raw_positions(spark, d):
    """Positions per contract (supplier) and ship day in the provider's columns, all text."""
    line = F.col("l_linenumber")

    def held(k):
        total = F.sum(F.when(line % 6 == k, F.col("l_quantity").cast("decimal(18,0)")))
        return F.coalesce(total.cast("string"), F.lit("."))

    names = list(L.POSITION_COLUMNS)
    return (
        table(spark, d, "lineitem")
        .groupBy(
            F.concat(F.lit("C"), F.col("l_suppkey").cast("string")).alias(L.POSITION_CONTRACT),
            F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias(L.POSITION_DATE),
        )
        .agg(*[held(k).alias(names[k]) for k in range(6)])
    )


POSITIONS_SQL = """SELECT {contract} AS contract, CAST(l_shipdate AS DATE) AS date,
""" + ",\n".join(
    f"CAST(sum(CAST(l_quantity AS DECIMAL(18,0))) FILTER (l_linenumber % 6 = {k}) AS DOUBLE) AS {c}"
    for k, c in enumerate(["lev_long", "lev_short", "dealer_long", "dealer_short", "asset_mgr_long", "asset_mgr_short"])
) + """,
lev_long - lev_short AS lev_net, dealer_long - dealer_short AS dealer_net,
asset_mgr_long - asset_mgr_short AS asset_mgr_net FROM lineitem GROUP BY 1, 2"""


@query("ingest_positions", POSITIONS_SQL.format(contract="'C' || CAST(l_suppkey AS VARCHAR)"))
def ingest_positions(spark, d):
    return L.normalize_positions(raw_positions(spark, d))


# Contracts shown side by side: the return flag and line status of the lines.
SHOWN = {"AF": "UST_AF", "AO": "UST_AO", "NF": "UST_NF", "NO": "UST_NO", "RF": "UST_RF", "RO": "UST_RO"}


@query(
    "positions_panel",
    "WITH p AS ("
    + POSITIONS_SQL.format(contract="l_returnflag || l_linestatus")
    + ") SELECT date, "
    + ", ".join(
        f"max(lev_net) FILTER (contract = '{c}') AS TFF_{c}_LEVERAGED, "
        f"max(asset_mgr_net) FILTER (contract = '{c}') AS UST_{c}_asset_mgr_net"
        for c in SHOWN
    )
    + " FROM p GROUP BY 1",
)
def positions_panel(spark, d):
    line = F.col("l_linenumber")
    names = list(L.POSITION_COLUMNS)
    raw = (
        table(spark, d, "lineitem")
        .groupBy(
            F.concat("l_returnflag", "l_linestatus").alias(L.POSITION_CONTRACT),
            F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias(L.POSITION_DATE),
        )
        .agg(
            *[
                F.coalesce(
                    F.sum(F.when(line % 6 == k, F.col("l_quantity").cast("decimal(18,0)"))).cast("string"), F.lit(".")
                ).alias(names[k])
                for k in range(6)
            ]
        )
    )
    return L.positions_panel(L.normalize_positions(raw), SHOWN)


@query(
    "scan_filtered",
    """SELECT l_shipdate, l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_returnflag = 'R' AND l_shipdate >= TIMESTAMP '1998-01-01'""",
)
def scan_filtered(spark, d):
    lines = table(spark, d, "lineitem").select("l_returnflag", "l_shipdate", "l_orderkey", "l_linenumber", "l_quantity")
    return L.scan_filtered(lines, "l_returnflag", "R", "l_shipdate", "1998-01-01").drop("l_returnflag")


MARGIN_SQL = """SELECT last_day(m) - CAST(greatest(isodow(last_day(m)) - 5, 0) AS INTEGER) AS date, debit, fc_cash, fc_margin FROM (
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS m, o_orderpriority AS p,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS debit,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = 'F') AS DOUBLE) AS fc_cash,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = 'O') AS DOUBLE) AS fc_margin
FROM orders GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY m ORDER BY p DESC) = 1"""


@query("ingest_margin", MARGIN_SQL)
def ingest_margin(spark, d):
    """A sheet with one line per month and priority, so every month occurs again; the last line counts."""
    status, price = F.col("o_orderstatus"), F.col("o_totalprice").cast("decimal(18,2)")
    sheet = (
        table(spark, d, "orders")
        .groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("Year-Month"), F.col("o_orderpriority").alias("p"))
        .agg(
            F.sum(price).alias("a"),
            F.coalesce(F.sum(F.when(status == "F", price)).cast("string"), F.lit("n/a")).alias("b"),
            F.coalesce(F.sum(F.when(status == "O", price)).cast("string"), F.lit("n/a")).alias("c"),
        )
    )
    path = scratch_path(spark, "sheet")
    # 5 lines per month, newest month first, landed as three files that follow each other; a month may lie in two.
    placed = sheet.repartitionByRange(3, F.desc("Year-Month"), "p").sortWithinPartitions(F.desc("Year-Month"), "p")
    placed.drop("p").write.option("header", True).csv(path)
    return L.normalize_margin(L.read_margin_sheet(spark, path))


@query(
    "registry_lookup",
    with_ctes(
        "reg",
        body="""SELECT lookup, series_id, frequency, category, lag, is_vintage FROM (
SELECT 'category' AS lookup, * FROM reg WHERE category = 'N7' UNION ALL SELECT 'source', * FROM reg WHERE source = 'TABLE'
UNION ALL SELECT 'frequency', * FROM reg WHERE frequency = 'W' UNION ALL SELECT 'get', * FROM reg WHERE series_id = 'S5')""",
    ),
)
def registry_lookup(spark, d):
    registry = supplier_registry(spark, d)
    found = {
        "category": G.by_category(registry, "N7"),
        "source": G.by_source(registry, "TABLE"),
        "frequency": G.by_frequency(registry, "W"),
        "get": G.get(registry, "S5"),
    }
    out = None
    for name, df in found.items():
        part = df.select(F.lit(name).alias("lookup"), "series_id", "frequency", "category", "lag", "is_vintage")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "series_coverage",
    with_ctes(
        "s3v",
        body="""SELECT series_id, min(date) AS first_valid, max(date) AS last_valid, count(*) AS n,
  arg_max(value, date) AS last_value FROM s3v GROUP BY 1""",
    ),
)
def series_coverage(spark, d):
    return Q.series_coverage(supplier_daily(spark, d))


@query(
    "validate_registry",
    with_ctes(
        "reg", body="SELECT series_id, category, tf AS fm_transforms FROM reg WHERE len(tf) > 0 AND lag IS NULL AND NOT is_vintage"
    ).replace("tf AS fm_transforms", "array_to_string(tf, ',') AS fm_transforms"),
)
def validate_registry(spark, d):
    return Q.registry_violations(supplier_registry(spark, d)).withColumn(
        "fm_transforms", F.array_join("fm_transforms", ",")
    )


@query(
    "coverage_guard",
    with_ctes(
        "s3",
        body=""", floors AS (SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS series_id,
  CAST(DATE '1995-01-01' + CAST(s_suppkey % 10 AS INTEGER) AS DATE) AS first_by, 450 + s_suppkey % 100 AS min_n FROM supplier WHERE s_acctbal > 0),
st AS (SELECT series_id, min(CASE WHEN value IS NOT NULL THEN date END) AS first_valid, count(value) AS n FROM s3 GROUP BY 1)
SELECT series_id, first_valid, first_by, n, min_n FROM st JOIN floors USING (series_id)
WHERE first_valid IS NULL OR first_valid > first_by OR n < min_n""",
    ),
)
def coverage_guard(spark, d):
    """Series of suppliers in credit are protected, each with its own floor."""
    floors = table(spark, d, "supplier").where("s_acctbal > 0").select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("series_id"),
        F.date_add(F.lit("1995-01-01").cast("date"), (F.col("s_suppkey") % 10).cast("int")).alias("first_by"),
        (F.col("s_suppkey") % 100 + 450).alias("min_n"),
    )
    return Q.coverage_violations(supplier_daily(spark, d), floors)


@query(
    "shallow_history",
    with_ctes(
        "vint",
        body="""SELECT series_id, min(date) AS first_valid, count(*) AS n FROM (
  SELECT series_id, date, value FROM vint QUALIFY row_number() OVER (PARTITION BY series_id, date ORDER BY realtime_start DESC) = 1)
WHERE value IS NOT NULL GROUP BY 1 HAVING year(min(date)) >= 1995""",
    ),
)
def shallow_history(spark, d):
    from tidemark.operators.pit import latest_release

    return Q.shallow_history(
        latest_release(supplier_vintages(spark, d)), supplier_registry(spark, d), since_year=1995
    )


WIDE = ["AF", "AO", "NF", "NO", "RF", "RO"]


@query(
    "pivot_wide",
    with_ctes(
        "s2",
        body="SELECT date, " + ", ".join(f"max(value) FILTER (series_id = '{c}') AS {c}" for c in WIDE) + " FROM s2 GROUP BY 1",
    ),
)
def pivot_wide(spark, d):
    from catalog.base import ship_daily

    return R.long_to_wide(ship_daily(spark, d), WIDE)


@query(
    "unpivot",
    with_ctes(
        "s2",
        body=f"""SELECT date, name, value FROM (SELECT DISTINCT date FROM s2) CROSS JOIN
(SELECT unnest({WIDE!r}) AS name) LEFT JOIN (SELECT series_id AS name, date, value FROM s2) USING (name, date)""",
    ),
)
def unpivot(spark, d):
    from catalog.base import ship_daily

    return R.wide_to_long(R.long_to_wide(ship_daily(spark, d), WIDE), WIDE)


@query(
    "parse_feature_name",
    with_ctes(
        "reg",
        body="""SELECT DISTINCT name, series_id, transform FROM (
SELECT series_id, suffix AS transform, CASE suffix WHEN 'level' THEN series_id ELSE series_id || '_' || suffix END AS name
FROM reg, (SELECT unnest(['level', 'diff', 'diff_bps', 'yoy', 'pct1m', 'zscore', 'zscore_3y', 'zscore_5y', 'zscore_exp']) AS suffix))""",
    ),
)
def parse_feature_name(spark, d):
    from tidemark.functions.names import SUFFIX, feature_name

    names = supplier_registry(spark, d).select("series_id", F.explode(F.array(*[F.lit(s) for s in SUFFIX.values()])).alias("s"))
    bare = F.when(F.col("s") == "level", F.col("series_id")).otherwise(feature_name(F.col("series_id"), F.col("s")))
    return R.parse_feature_names(names.select(bare.alias("name")))


@query(
    "sink_features",
    with_ctes("s3", "reg", body="SELECT series_id, 'level' AS transform, date, value FROM s3 JOIN reg USING (series_id)"),
)
def sink_features(spark, d):
    """Round trip of a feature table through its sink."""
    path = scratch_path(spark, "features")
    levels = supplier_daily(spark, d).select("series_id", F.lit("level").alias("transform"), "date", "value")
    S.write_features(levels, path, buckets=8)
    return spark.read.parquet(path).select("series_id", "transform", "date", "value")
