"""Whole jobs: warehouse reports, monitoring pages, the default scorecard, streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import pit as _pit  # noqa: F401  registers the feature SQL used below
from catalog.base import (
    CTE_NEEDS,
    CTES,
    SQL,
    money,
    ordered_vintages,
    query,
    r,
    supplier_daily,
    supplier_registry,
    table,
    with_ctes,
)
from catalog.calendars import HOLIDAYS_SQL
from tidemark.operators.pit import first_vintages, pit_runs
from tidemark.operators.runs import spread
from tidemark.plans import dashboards as B
from tidemark.plans import warehouse as W
from tidemark.plans.features import apply_transforms
from tidemark.session import materialize, scratch_path
from tidemark.sources.registry import INDICATORS
from tidemark.streaming import bucketlog, late
from tidemark.streaming.merge import merge_stream, read_merged
from tidemark.streaming.resample import resample_stream, utc_day

# --- warehouse ----------------------------------------------------------------

LOADED_AT = "2024-01-01 00:00:00"


def fact(spark, d):
    """Stamped feature table of all supplier series."""
    registry = supplier_registry(spark, d)
    panel = materialize(supplier_daily(spark, d), "panel")
    vintages = materialize(first_vintages(ordered_vintages(spark, d), registry), "vintages")
    held = materialize(pit_runs(panel, vintages, registry), "runs")
    pit = spread(held)
    features = apply_transforms(pit, registry, "fm", check_frequency=False, runs=held)
    published = W.publications(panel, vintages, registry, business_prefix="S1")
    return W.fact_table(features, published, registry, LOADED_AT)


_FEATURES = SQL["features_fm"]
_HEAD, _TAIL = _FEATURES.rsplit("SELECT series_id, transform, date, round(value, 5) AS value FROM (", 1)
FACT_SQL = (
    _HEAD
    + f""", {HOLIDAYS_SQL},
ord AS (SELECT days.d, count(bdays.d) OVER (ORDER BY days.d) AS k FROM days LEFT JOIN bdays ON days.d = bdays.d),
feat AS (SELECT * FROM ({_TAIL} WHERE value IS NOT NULL),
pub AS (SELECT series_id, release_date, max(obs_date) AS obs_date FROM (
  SELECT series_id, CASE WHEN starts_with(series_id, 'S1') THEN b.d ELSE sh.date END AS release_date, sh.obs_date
    FROM shifted sh JOIN ord ON sh.obs_date = ord.d JOIN bdays b ON b.k = ord.k + 3 WHERE sh.value IS NOT NULL
  UNION ALL SELECT series_id, effective_date, date FROM first WHERE series_id IN (SELECT series_id FROM reg WHERE is_vintage))
  GROUP BY 1, 2),
fact AS (SELECT f.series_id, f.date, f.transform, f.value, p.release_date, p.obs_date, reg.category AS block, 'TABLE' AS source
  FROM feat f ASOF JOIN pub p ON f.series_id = p.series_id AND f.date >= p.release_date JOIN reg ON reg.series_id = f.series_id)
"""
)
DIM_SQL = """SELECT series_id, name AS full_name, CAST(NULL AS VARCHAR) AS fred_id, category AS block, CAST(NULL AS VARCHAR) AS block_name,
  category, lag AS publication_lag, CASE WHEN is_vintage THEN 'alfred_vintage' ELSE 'standard_fixed_lag' END AS pit_path,
  CASE series_id WHEN 'S7' THEN 50 WHEN 'S14' THEN 52 ELSE lag END AS real_lag_days, CAST(NULL AS INTEGER) AS tier, 1 AS is_working
FROM reg"""
MEASURED = {"S7": 50, "S14": 52}


@query("dim_indicators", with_ctes("reg", body=DIM_SQL))
def dim_indicators(spark, d):
    return W.dim_indicators(supplier_registry(spark, d), MEASURED)


@query(
    "fact_table",
    FACT_SQL
    + f"SELECT series_id, date, transform, round(value, 5) AS value, release_date, obs_date, block, source, '{LOADED_AT}' AS fetched_at FROM fact",
)
def fact_table(spark, d):
    return fact(spark, d).withColumn("value", F.round("value", 5))


@query("q_rows_by_transform", FACT_SQL + "SELECT transform, count(*) AS n FROM fact GROUP BY 1")
def q_rows_by_transform(spark, d):
    return W.rows_by_transform(fact(spark, d))


@query(
    "q_series_by_block",
    FACT_SQL + "SELECT block, count(DISTINCT series_id) AS n_series, count(*) AS n_rows FROM fact GROUP BY 1",
)
def q_series_by_block(spark, d):
    return W.series_by_block(fact(spark, d))


@query(
    "q_lag_distribution",
    FACT_SQL
    + """SELECT series_id, round(avg(release_date - obs_date), 1) AS avg_lag_days, CAST(max(release_date - obs_date) AS INTEGER) AS max_lag_days,
  CAST(min(release_date - obs_date) AS INTEGER) AS min_lag_days
FROM fact WHERE transform = 'level' GROUP BY 1 ORDER BY avg_lag_days DESC, series_id LIMIT 20""",
)
def q_lag_distribution(spark, d):
    return W.lag_distribution(fact(spark, d))


@query(
    "q_lag_vs_config",
    FACT_SQL
    + f""", dim AS ({DIM_SQL})
SELECT f.series_id, pit_path, publication_lag AS std_config_lag, round(avg(release_date - obs_date), 1) AS empirical_lag, real_lag_days AS sweep_lag
FROM fact f JOIN dim USING (series_id) WHERE transform = 'level' GROUP BY 1, 2, 3, 5""",
)
def q_lag_vs_config(spark, d):
    return W.lag_vs_config(fact(spark, d), W.dim_indicators(supplier_registry(spark, d), MEASURED))


RETURNS_SQL = """, u AS (SELECT strftime(m, '%Y-%m') AS year_month, p AS universe_label, round((v - b) / b, 8) AS monthly_return FROM (
  SELECT *, lag(v) OVER (PARTITION BY p ORDER BY m) AS b FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS m, o_orderpriority AS p,
    CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS v FROM orders GROUP BY 1, 2)))
"""


def returns(spark, d):
    """Monthly change of order value per priority stands for the returns of a universe."""
    from pyspark.sql import Window

    monthly = (
        table(spark, d, "orders")
        .groupBy(F.col("o_orderpriority").alias("universe_label"), F.date_format("o_orderdate", "yyyy-MM").alias("year_month"))
        .agg(money("o_totalprice").cast("double").alias("v"))
    )
    base = F.lag("v").over(Window.partitionBy("universe_label").orderBy("year_month"))
    return monthly.select("year_month", "universe_label", F.round((F.col("v") - base) / base, 8).alias("monthly_return"))


@query(
    "q_theta_join",
    FACT_SQL
    + RETURNS_SQL
    + """SELECT year_month, universe_label, monthly_return AS lhs_return, round(m.value, 5) AS rhs_value, m.release_date AS rhs_release_date
FROM u LEFT JOIN fact m ON m.series_id = 'S5' AND m.transform = 'zscore' AND m.release_date <= CAST(year_month || '-01' AS DATE)
WHERE universe_label = '5-LOW' ORDER BY year_month DESC, m.release_date DESC NULLS LAST, m.date DESC NULLS LAST LIMIT 10""",
)
def q_theta_join(spark, d):
    out = W.preview_returns(returns(spark, d), fact(spark, d), "S5", "zscore", "5-LOW", 10)
    return out.withColumn("rhs_value", F.round("rhs_value", 5))


@query(
    "q_asof_join",
    FACT_SQL
    + RETURNS_SQL
    + """, l AS (SELECT * FROM fact WHERE series_id = 'S5' AND transform = 'zscore'
  QUALIFY row_number() OVER (PARTITION BY release_date ORDER BY date DESC) = 1)
SELECT year_month, universe_label, monthly_return AS lhs_return, round(l.value, 5) AS rhs_value, l.release_date AS rhs_release_date
FROM (SELECT *, CAST(year_month || '-01' AS DATE) AS ms FROM u WHERE universe_label = '5-LOW') u ASOF LEFT JOIN l ON u.ms >= l.release_date""",
)
def q_asof_join(spark, d):
    out = W.asof_returns(returns(spark, d), fact(spark, d), "S5", "zscore", "5-LOW")
    return out.withColumn("rhs_value", F.round("rhs_value", 5))


# --- monitoring pages -----------------------------------------------------------

MACRO_IDS = [row[0] for row in INDICATORS] + ["FINRA_FC_CASH", "FINRA_FC_MARGIN"]
CUTOVER = "1997-07-01"
# The pages' own earliest starts lie after the given data.
PAGE_FLOOR = {"leverage": "1997-01-01", "basis_trade": "1998-01-01"}


def macro_daily(spark, d):
    """All lines dealt out to the registry's indicators by supplier; the value is the line value in thousands."""
    key = (F.col("l_suppkey") % len(MACRO_IDS) + 1).cast("int")
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return (
        table(spark, d, "lineitem")
        .groupBy(
            F.element_at(F.array(*[F.lit(i) for i in MACRO_IDS]), key).alias("series_id"),
            F.col("l_shipdate").cast("date").alias("date"),
        )
        .agg((F.sum(price).cast("double") / 1000.0).alias("value"))
    )


def derived(spark, d):
    return B.derived_panel(materialize(macro_daily(spark, d), "macro"), CUTOVER)


def _z(source: str, need: int, frame: str) -> str:
    return f"""SELECT series_id, date, CASE WHEN count(value) OVER w >= {need} AND stddev_samp(value) OVER w > 0
  THEN (value - avg(value) OVER w) / stddev_samp(value) OVER w END AS z FROM ({source})
  WINDOW w AS (PARTITION BY series_id ORDER BY date ROWS BETWEEN {frame} AND CURRENT ROW)"""


def _names(mapping: dict[str, str]) -> str:
    return "CASE series_id " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in mapping.items()) + " END"


def _pair(name: str, x: str, y: str, source: str = "mac") -> str:
    return f"""{name} AS (SELECT date, max(value) FILTER (series_id = '{x}') AS x, max(value) FILTER (series_id = '{y}') AS y
  FROM {source} WHERE series_id IN ('{x}', '{y}') GROUP BY 1)"""


def _in(ids) -> str:
    return "(" + ", ".join(f"'{i}'" for i in ids) + ")"


CTES["mac"] = f"""SELECT {MACRO_IDS!r}[CAST(l_suppkey % {len(MACRO_IDS)} + 1 AS INTEGER)] AS series_id, CAST(l_shipdate AS DATE) AS date,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / 1000 AS value FROM lineitem GROUP BY 1, 2"""
CTE_NEEDS["mac"] = []
FILL = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"

DERIVED_SQL = with_ctes(
    "mac",
    body=f""", mend AS (SELECT series_id, last_day(date) AS date, arg_max(value, mac.date) AS value FROM mac GROUP BY 1, 2),
mst AS (SELECT series_id, CAST(date_trunc('month', date) AS DATE) AS date, arg_max(value, mac.date) AS value FROM mac GROUP BY 1, 2),
{_pair("rp", "SOFR", "EFFR")}, {_pair("qp", "BAMLH0A3HYC", "BAMLH0A1HYBB")},
{_pair("vp", "SP500", "M2SL")}, {_pair("vm", "SP500", "M2SL", "mend")}, {_pair("mp", "FINRA_MARGIN_DEBT", "M2SL", "mend")},
{_pair("gp", "M2SL", "CPIAUCSL", "mst")},
repo AS (SELECT 'repo_spread' AS series_id, date, (x - y) * 100 AS value FROM rp WHERE x IS NOT NULL AND y IS NOT NULL),
qual AS (SELECT 'quality_spread' AS series_id, date, x - y AS value FROM qp),
np AS (SELECT date, max(value) FILTER (series_id = 'WALCL') AS a, max(value) FILTER (series_id = 'WDTGAL') AS b,
  max(value) FILTER (series_id = 'RRPONTSYD') AS c FROM mac WHERE series_id IN ('WALCL', 'WDTGAL', 'RRPONTSYD') GROUP BY 1),
nf AS (SELECT date, last_value(a IGNORE NULLS) OVER w AS a, last_value(b IGNORE NULLS) OVER w AS b, last_value(c IGNORE NULLS) OVER w AS c
  FROM np WINDOW w AS (ORDER BY date {FILL})),
ng AS (SELECT g.date, np.a, np.b, coalesce(np.c, 0) AS c FROM (SELECT CAST(d AS DATE) AS date FROM (SELECT unnest(generate_series(
    (SELECT CAST(min(date) AS TIMESTAMP) FROM np), TIMESTAMP '{CUTOVER}' - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d) WHERE isodow(d) < 6) g
    LEFT JOIN np ON np.date = g.date
  UNION ALL SELECT date, a, b, c FROM np WHERE date >= DATE '{CUTOVER}' AND c IS NOT NULL),
nn AS (SELECT date, last_value(a IGNORE NULLS) OVER w / 1000 - last_value(b IGNORE NULLS) OVER w / 1000 - c AS net
  FROM ng WINDOW w AS (ORDER BY date {FILL})),
vf AS (SELECT * FROM (SELECT date, last_value(x IGNORE NULLS) OVER w AS x, last_value(y IGNORE NULLS) OVER w AS y
  FROM vp WINDOW w AS (ORDER BY date {FILL})) WHERE x IS NOT NULL AND y IS NOT NULL),
vz AS (SELECT date, CASE WHEN count(v) OVER w >= 60 THEN (v - avg(v) OVER w) / stddev_samp(v) OVER w END AS z
  FROM (SELECT date, x * 1000 / y AS v FROM vm) WINDOW w AS (ORDER BY date ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)),
mm AS (SELECT a.date, a.x / 1000 / a.y * 100 AS p, (a.x / o.x - 1) * 100 - (a.y / o.y - 1) * 100 AS g
  FROM mp a LEFT JOIN mp o ON o.date = last_day(a.date - INTERVAL 12 MONTH) WHERE a.x IS NOT NULL AND a.y IS NOT NULL),
cr AS (SELECT date, max(value) FILTER (series_id = 'FINRA_FC_CASH') AS a, max(value) FILTER (series_id = 'FINRA_FC_MARGIN') AS b,
  max(value) FILTER (series_id = 'FINRA_MARGIN_DEBT') AS d FROM mend WHERE series_id LIKE 'FINRA%' GROUP BY 1),
cf AS (SELECT date, last_value(a IGNORE NULLS) OVER w AS a, last_value(b IGNORE NULLS) OVER w AS b, last_value(d IGNORE NULLS) OVER w AS d
  FROM cr WINDOW w AS (ORDER BY date {FILL})),
fut AS (SELECT {_names({s: n for s, n, _ in B.NOTIONALS})} AS series_id, date,
  value * CASE series_id WHEN 'TFF_2Y_LEVERAGED' THEN 200000 ELSE 100000 END / 1e9 AS value FROM mac WHERE series_id LIKE 'TFF%'),
fd AS (SELECT series_id, date, value - lag(value) OVER (PARTITION BY series_id ORDER BY date) AS value FROM fut),
derived AS (SELECT series_id, date, value FROM mac UNION ALL SELECT * FROM repo UNION ALL SELECT * FROM qual
  UNION ALL SELECT 'net_liquidity', date, a / 1000 - b / 1000 - c FROM nf
  UNION ALL SELECT 'net_liquidity_yoy', date, (net / nullif(lag(net, 252) OVER (ORDER BY date), 0) - 1) * 100 FROM nn
  UNION ALL SELECT 'real_m2_yoy', a.date, (a.x / o.x - 1) * 100 - (a.y / o.y - 1) * 100
    FROM gp a LEFT JOIN gp o ON o.date = a.date - INTERVAL 12 MONTH
  UNION ALL SELECT {_names(B.EXPANDING_Z)}, date, z FROM ({_z(f"SELECT * FROM mac WHERE series_id IN {_in(B.EXPANDING_Z)} UNION ALL SELECT * FROM repo", 60, "UNBOUNDED PRECEDING")})
  UNION ALL SELECT {_names(B.ROLLING_Z)}, date, z FROM ({_z(f"SELECT * FROM mac WHERE series_id IN {_in(B.ROLLING_Z)} UNION ALL SELECT * FROM qual", 126, "251 PRECEDING")})
  UNION ALL SELECT CASE a.series_id WHEN 'CPIAUCSL' THEN 'cpi_yoy' ELSE 'core_pce_yoy' END, a.date, (a.value / o.value - 1) * 100
    FROM mst a LEFT JOIN mst o ON o.series_id = a.series_id AND o.date = a.date - INTERVAL 12 MONTH WHERE a.series_id IN {_in(B.CALENDAR_YOY)}
  UNION ALL SELECT 'margin_m2', date, p FROM mm
  UNION ALL SELECT 'margin_m2_z', date, CASE WHEN count(p) OVER w >= 60 THEN (p - avg(p) OVER w) / stddev_samp(p) OVER w END FROM mm
    WINDOW w AS (ORDER BY date ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)
  UNION ALL SELECT 'margin_excess_growth', date, g FROM mm
  UNION ALL SELECT 'net_credit_bn', date, (a + b - d) / 1000 FROM cf WHERE a IS NOT NULL AND b IS NOT NULL AND d IS NOT NULL
  UNION ALL SELECT * FROM fut UNION ALL SELECT series_id || '_diff', date, value FROM fd
  UNION ALL SELECT series_id || '_diff_z', date, z FROM ({_z("SELECT * FROM fd", 260, "259 PRECEDING")})
  UNION ALL SELECT 'sp500_m2', date, x * 1000 / y FROM vf
  UNION ALL SELECT 'sp500_m2_z', vf.date, vz.z FROM vf ASOF LEFT JOIN vz ON vf.date >= vz.date)
""",
)


def _page_sql(name: str) -> str:
    series, anchors, earliest, year_start = B.PAGES[name]
    start = f"(SELECT min(date) FROM derived WHERE series_id IN {_in(anchors)} AND value IS NOT NULL)"
    if year_start:
        start = f"CAST(date_trunc('year', {start}) AS DATE)"
    floor = PAGE_FLOOR.get(name, earliest)
    if floor is not None:
        start = f"greatest({start}, DATE '{floor}')"
    return DERIVED_SQL + (
        f"SELECT series_id, date, round(value, 6) AS value FROM derived WHERE series_id IN {_in(series)} "
        f"AND value IS NOT NULL AND date >= {start}"
    )


def _page(name: str):
    def run(spark, d):
        shown = B.page(derived(spark, d), name, PAGE_FLOOR.get(name))
        return shown.select("series_id", "date", r("value"))

    return run


for _name in B.PAGES:
    query(f"panel_{_name}", _page_sql(_name))(_page(_name))


def _literal(v) -> str:
    return "NULL" if v is None else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else repr(v)


@query(
    "macro_scorecard",
    DERIVED_SQL
    + ", spec AS (SELECT * FROM (VALUES "
    + ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in B.SCORECARD)
    + """) v(card, label, series_id, as_of_series, scale, rule, threshold)),
lv AS (SELECT series_id, max(date) AS as_of, arg_max(value, date) AS value FROM derived WHERE value IS NOT NULL GROUP BY 1)
SELECT card, label, coalesce(b.as_of, a.as_of) AS as_of, round(a.value * scale, 5) AS value,
  CASE WHEN a.value IS NULL OR rule = 'none' THEN ''
    WHEN rule IN ('high', 'floor') THEN CASE WHEN a.value * scale >= threshold THEN 'r' ELSE 'g' END
    WHEN rule = 'low' THEN CASE WHEN a.value * scale < threshold THEN 'r' ELSE 'g' END
    WHEN rule = 'sign' THEN CASE WHEN a.value * scale < 0 THEN 'r' ELSE 'g' END
    ELSE CASE WHEN a.value * scale > 0 THEN 'r' ELSE 'g' END END AS light
FROM spec LEFT JOIN lv a ON a.series_id = spec.series_id LEFT JOIN lv b ON b.series_id = spec.as_of_series AND a.value IS NOT NULL""",
)
def macro_scorecard(spark, d):
    return B.macro_scorecard(derived(spark, d)).withColumn("value", F.round("value", 5))


# --- streams ----------------------------------------------------------------------


def event_stream(spark, d, landed_files=None):
    """The events as a stream; landed in so many files, out of order, and read one after the other, if asked for."""
    events = table(spark, d, "events")
    if landed_files:
        path = scratch_path(spark, "landed")
        events.repartition(landed_files, "event_id" if "event_id" in events.columns else "ts").write.parquet(path)
        files = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)
    else:
        files = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(d)
    # A watermark needs an instant: the wall clock is read as UTC in any session.
    return files.withColumn("ts", F.from_utc_timestamp(F.col("ts").cast("timestamp"), F.current_timezone()))


@query(
    "stream_merge",
    """SELECT 'U' || CAST(user_id AS VARCHAR) AS series_id, CAST(ts AS DATE) AS date,
  arg_max(value, ts) FILTER (event_type <> 'error') AS value FROM events GROUP BY 1, 2""",
)
def stream_merge(spark, d):
    """Events as observations of their user's day; an error event is a missing value."""
    seen = event_stream(spark, d, landed_files=3).select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("series_id"),
        utc_day(F.col("ts")).alias("date"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
        "ts",
    )
    log, checkpoint = scratch_path(spark, "loads"), scratch_path(spark, "stream")
    merge_stream(spark, seen, log, checkpoint).awaitTermination()
    return read_merged(spark, log)


@query(
    "stream_resample",
    """SELECT event_type AS series_id, CAST(ts AS DATE) AS date, arg_max(value, ts) AS value, count(*) AS n FROM events
WHERE CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY GROUP BY 1, 2""",
)
def stream_resample(spark, d):
    """Days the watermark has closed."""
    path, checkpoint = scratch_path(spark, "days"), scratch_path(spark, "stream")
    out = resample_stream(event_stream(spark, d), "event_type", "value")
    (
        out.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
        .awaitTermination()
    )
    return spark.read.schema(out.schema).parquet(path)


def landed_in_turn(spark, d, parts, deliver):
    """Land the events in so many deliveries by their number and hand the stream over after each."""
    events, path = table(spark, d, "events"), scratch_path(spark, "landed")
    for part in range(parts):
        events.where(F.col("event_id") % parts == part).write.mode("append").parquet(path)
        files = spark.readStream.schema(events.schema).parquet(path)
        deliver(files.withColumn("ts", F.from_utc_timestamp(F.col("ts").cast("timestamp"), F.current_timezone())))
    return events.schema


@query(
    "stream_late",
    """WITH wm AS (SELECT max(ts) - INTERVAL 1 DAY AS w FROM events WHERE event_id % 2 = 0),
e AS (SELECT *, event_id % 2 = 1 AND CAST(ts AS DATE) + INTERVAL 1 DAY <= w AS is_late FROM events, wm),
done AS (SELECT event_type AS series_id, CAST(ts AS DATE) AS date, arg_max(value, ts) AS value, count(*) AS n FROM e WHERE NOT is_late
  AND CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY GROUP BY 1, 2),
late AS (SELECT event_type AS series_id, CAST(ts AS DATE) AS date, count(*) AS n_late FROM e WHERE is_late GROUP BY 1, 2)
SELECT series_id, date, value, n, coalesce(n_late, 0) AS n_late FROM done FULL JOIN late USING (series_id, date)""",
)
def stream_late(spark, d):
    """Events in two deliveries, the second one mostly behind the watermark of the first: late rows are kept and counted exactly."""
    path, checkpoint = scratch_path(spark, "days"), scratch_path(spark, "stream")

    def deliver(events):
        late.resample_keeping_late(events, path, checkpoint, "event_type", "value").awaitTermination()

    schema = landed_in_turn(spark, d, 2, deliver)
    behind = late.late_rows(spark, path, schema).groupBy(F.col("event_type").alias("series_id"), utc_day(F.col("ts").cast("timestamp")).alias("date"))
    closed = late.closed_windows(spark, path)
    both = closed.join(behind.agg(F.count(F.lit(1)).alias("n_late")), ["series_id", "date"], "full")
    return both.select("series_id", "date", "value", "n", F.coalesce("n_late", F.lit(0)).alias("n_late"))


@query("stream_compacted", SQL["stream_merge"])
def stream_compacted(spark, d):
    """Events in four deliveries onto a log folded after every second one."""
    path, checkpoint = scratch_path(spark, "log"), scratch_path(spark, "stream")

    def deliver(events):
        seen = events.select(
            F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("series_id"),
            utc_day(F.col("ts")).alias("date"),
            F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
            "ts",
        )
        bucketlog.append_stream(spark, seen, path, checkpoint, buckets=8, fold_every=2).awaitTermination()

    landed_in_turn(spark, d, 4, deliver)
    return bucketlog.read(spark, path)
