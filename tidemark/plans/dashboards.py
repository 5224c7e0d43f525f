"""Data behind the monitoring pages and the default scorecard.

``derived_panel`` computes all derived series of all pages in one go, grouped by
kind of computation; a page is then a selection of series from its anchor on,
and the scorecard the latest value of each.  Drawing is left to the reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import composites as K
from tidemark.operators.calendar import anchor_trim, resample_last
from tidemark.operators.monitor import scorecard
from tidemark.operators.transforms import diff, expanding_zscore, rolling_zscore, yoy_calendar, zscore_of_diff
from tidemark.sources.literal import literal_table

# Day the overnight facility opened; before it a blank means zero.
FACILITY_START = "2013-09-23"

# Legs of the composites (composite, role, series).
BPS_SPREADS = [("repo_spread", "x", "SOFR"), ("repo_spread", "y", "EFFR")]
SPREADS = [("quality_spread", "x", "BAMLH0A3HYC"), ("quality_spread", "y", "BAMLH0A1HYBB")]
NET_LIQUIDITY = [("net_liquidity", "a", "WALCL"), ("net_liquidity", "b", "WDTGAL"), ("net_liquidity", "c", "RRPONTSYD")]
REAL_GROWTH = [("real_m2_yoy", "m", "M2SL"), ("real_m2_yoy", "c", "CPIAUCSL")]
MARGIN = [("margin", "x", "FINRA_MARGIN_DEBT"), ("margin", "y", "M2SL")]
NET_CREDIT = [
    ("net_credit", "a", "FINRA_FC_CASH"),
    ("net_credit", "b", "FINRA_FC_MARGIN"),
    ("net_credit", "d", "FINRA_MARGIN_DEBT"),
]
VALUATION = [("sp500_m2", "x", "SP500"), ("sp500_m2", "y", "M2SL")]

# Series -> name of the derived one.
EXPANDING_Z = {"repo_spread": "repo_spread_z", "BAMLH0A0HYM2": "hy_oas_z", "VIXCLS": "vix_z"}
ROLLING_Z = {"quality_spread": "quality_spread_z", "BAMLEMHYHYLCRPIUSOAS": "em_oas_z", "BAMLC0A0CM": "ig_oas_z"}
CALENDAR_YOY = {"CPIAUCSL": "cpi_yoy", "PCEPILFE": "core_pce_yoy"}
# (series, derived notional, face value of one contract)
NOTIONALS = [("TFF_2Y_LEVERAGED", "futures_2y", 200_000), ("TFF_10Y_LEVERAGED", "futures_10y", 100_000)]

# Page -> (series shown, anchor series, earliest start or None, start at 1 January).
PAGES = {
    "repo_plumbing": (
        ["DFEDTARL", "DFEDTARU", "TGCRRATE", "RRPONTSYAWARD", "IORB", "EFFR", "SOFR", "repo_spread", "repo_spread_z",
         "WRBWFRBL", "SP500", "sp500_m2", "sp500_m2_z"],
        ["SOFR"], None, True,
    ),
    "liquidity": (
        ["WALCL", "WDTGAL", "RRPONTSYD", "net_liquidity", "net_liquidity_yoy", "M2SL", "real_m2_yoy", "WRBWFRBL",
         "RPONTSYD", "WLCFLPCL", "H41RESPPALDKNWW", "SP500", "sp500_m2", "sp500_m2_z"],
        ["WALCL", "WDTGAL", "RRPONTSYD", "WRBWFRBL"], None, False,
    ),
    "credit_hy": (
        ["BAMLH0A0HYM2", "hy_oas_z", "SP500", "sp500_m2", "sp500_m2_z"],
        ["BAMLH0A0HYM2"], None, False,
    ),
    "credit_other": (
        ["BAMLC0A0CM", "BAMLH0A1HYBB", "BAMLH0A3HYC", "BAMLEMHYHYLCRPIUSOAS", "quality_spread", "quality_spread_z",
         "em_oas_z", "ig_oas_z", "SP500", "sp500_m2", "sp500_m2_z"],
        ["BAMLC0A0CM", "BAMLH0A1HYBB", "BAMLH0A3HYC", "BAMLEMHYHYLCRPIUSOAS"], None, True,
    ),
    "yield_curve": (
        ["DGS2", "DGS10", "DFII10", "T10YIE", "T10Y3M", "T10Y2Y", "SP500", "sp500_m2", "sp500_m2_z"],
        ["DGS2", "DGS10", "T10Y2Y", "T10Y3M"], None, False,
    ),
    "fx_vol_inflation": (
        ["DEXTAUS", "DTWEXEMEGS", "VIXCLS", "vix_z", "cpi_yoy", "core_pce_yoy", "SP500", "sp500_m2", "sp500_m2_z"],
        ["DEXTAUS", "VIXCLS"], None, False,
    ),
    "leverage": (
        ["NFCILEVERAGE", "NFCI", "NFCIRISK", "NFCICREDIT", "ANFCI", "margin_m2", "margin_m2_z", "margin_excess_growth",
         "net_credit_bn", "SP500", "sp500_m2", "sp500_m2_z"],
        ["NFCI"], "1997-01-01", False,
    ),
    "basis_trade": (
        ["DGS2", "DGS10", "futures_2y", "futures_10y", "futures_2y_diff", "futures_10y_diff", "futures_2y_diff_z",
         "futures_10y_diff_z", "repo_spread", "SP500", "sp500_m2", "sp500_m2_z"],
        ["TFF_2Y_LEVERAGED", "TFF_10Y_LEVERAGED"], "2015-01-01", False,
    ),
    "overview": (
        ["repo_spread", "net_liquidity", "SP500", "BAMLH0A0HYM2", "hy_oas_z", "T10Y2Y", "NFCILEVERAGE", "quality_spread",
         "VIXCLS", "DFII10"],
        ["SOFR", "WALCL", "SP500", "BAMLH0A0HYM2", "T10Y2Y", "NFCILEVERAGE", "VIXCLS", "DFII10"], None, False,
    ),
}

# The default scorecard.
# (card, label, series, series the date is taken from, scale, light rule, threshold)
SCORECARD = [
    (1, "Fed Policy Band, lower", "DFEDTARL", "DFEDTARU", 1.0, "none", None),
    (1, "Fed Policy Band, upper", "DFEDTARU", None, 1.0, "none", None),
    (1, "TGCR", "TGCRRATE", None, 1.0, "none", None),
    (1, "SOFR", "SOFR", None, 1.0, "none", None),
    (1, "EFFR", "EFFR", None, 1.0, "none", None),
    (1, "Repo Spread", "repo_spread", None, 1.0, "high", 20.0),
    (1, "Z · Repo Spread", "repo_spread_z", None, 1.0, "high", 2.0),
    (1, "Reserve Balances", "WRBWFRBL", None, 1e-6, "low", 3.0),
    (2, "Fed's TA", "WALCL", None, 1e-3, "none", None),
    (2, "TGA", "WDTGAL", None, 1e-3, "none", None),
    (2, "ON RRP", "RRPONTSYD", None, 1.0, "none", None),
    (2, "Net Liquidity", "net_liquidity", "RRPONTSYD", 1.0, "none", None),
    (2, "Net Liq. YoY", "net_liquidity_yoy", "RRPONTSYD", 1.0, "sign", None),
    (2, "M2", "M2SL", None, 1e-3, "none", None),
    (2, "Real M2 YoY", "real_m2_yoy", None, 1.0, "sign", None),
    (2, "SRF Use", "RPONTSYD", None, 1.0, "floor", 1.0),
    (2, "Discount Window", "WLCFLPCL", None, 1e-3, "none", None),
    (3, "HY OAS", "BAMLH0A0HYM2", None, 100.0, "none", None),
    (3, "Z · HY OAS", "hy_oas_z", None, 1.0, "high", 2.0),
    (3, "Quality Spread", "quality_spread", None, 100.0, "none", None),
    (3, "Z · Quality Spread", "quality_spread_z", None, 1.0, "high", 2.0),
    (3, "EM HY OAS", "BAMLEMHYHYLCRPIUSOAS", None, 100.0, "none", None),
    (3, "Z · EM HY OAS", "em_oas_z", None, 1.0, "high", 2.0),
    (3, "IG OAS", "BAMLC0A0CM", None, 100.0, "none", None),
    (3, "Z · IG OAS", "ig_oas_z", None, 1.0, "high", 2.0),
    (4, "2Y UST", "DGS2", None, 1.0, "none", None),
    (4, "10Y UST", "DGS10", None, 1.0, "none", None),
    (4, "10Y Real (TIPS)", "DFII10", None, 1.0, "none", None),
    (4, "10Y Breakeven", "T10YIE", None, 1.0, "none", None),
    (4, "10Y − 3M Term Spread", "T10Y3M", None, 100.0, "sign", None),
    (4, "10Y − 2Y Term Spread", "T10Y2Y", None, 100.0, "sign", None),
    (5, "USD/TWD", "DEXTAUS", None, 1.0, "none", None),
    (5, "EM USD Index", "DTWEXEMEGS", None, 1.0, "none", None),
    (5, "VIX", "VIXCLS", None, 1.0, "high", 30.0),
    (5, "Z · VIX", "vix_z", None, 1.0, "high", 2.0),
    (5, "CPI YoY", "cpi_yoy", None, 1.0, "none", None),
    (5, "Core PCE YoY", "core_pce_yoy", None, 1.0, "none", None),
    (6, "NFCI Leverage", "NFCILEVERAGE", None, 1.0, "high", 2.0),
    (6, "NFCI", "NFCI", None, 1.0, "high", 2.0),
    (6, "NFCI Risk", "NFCIRISK", None, 1.0, "high", 2.0),
    (6, "NFCI Credit", "NFCICREDIT", None, 1.0, "high", 2.0),
    (6, "ANFCI", "ANFCI", None, 1.0, "high", 2.0),
    (6, "Margin Debt / M2", "margin_m2", "FINRA_MARGIN_DEBT", 1.0, "none", None),
    (6, "Z · Margin Debt / M2", "margin_m2_z", "FINRA_MARGIN_DEBT", 1.0, "high", 2.0),
    (6, "Margin Debt YoY − M2 YoY", "margin_excess_growth", "FINRA_MARGIN_DEBT", 1.0, "flip", None),
    (6, "Margin Net Credit", "net_credit_bn", "FINRA_FC_CASH", 1.0, "sign", None),
    (7, "2Y Fut. Net Pos.", "futures_2y", None, 1.0, "none", None),
    (7, "10Y Fut. Net Pos.", "futures_10y", None, 1.0, "none", None),
    (7, "Δ 2Y Fut. Net Pos.", "futures_2y_diff", None, 1.0, "none", None),
    (7, "Z · Δ 2Y Fut. Net Pos.", "futures_2y_diff_z", None, 1.0, "high", 2.0),
    (7, "Δ 10Y Fut. Net Pos.", "futures_10y_diff", None, 1.0, "none", None),
    (7, "Z · Δ 10Y Fut. Net Pos.", "futures_10y_diff_z", None, 1.0, "high", 2.0),
    (8, "SP500", "SP500", None, 1.0, "none", None),
    (8, "SP500 / M2 (per $1 Tn)", "sp500_m2", None, 1.0, "none", None),
    (8, "Z · SP500 / M2", "sp500_m2_z", "M2SL", 1.0, "high", 2.0),
]
SPEC_SCHEMA = (
    "card int, label string, series_id string, as_of_series string, scale double, rule string, threshold double"
)


def _legs(spark: SparkSession, rows) -> DataFrame:
    return literal_table(spark, rows, "composite_id string, role string, series_id string")


def _named(df: DataFrame, name: str, value: str = "value") -> DataFrame:
    return df.select(F.lit(name).alias("series_id"), "date", F.col(value).alias("value"))


def _renamed(df: DataFrame, names: dict[str, str], value: str) -> DataFrame:
    to = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return df.select(to[F.col("series_id")].alias("series_id"), "date", F.col(value).alias("value"))


def _series(composite: DataFrame) -> DataFrame:
    return composite.select(F.col("composite_id").alias("series_id"), "date", "value")


def _only(panel: DataFrame, ids) -> DataFrame:
    return panel.where(F.col("series_id").isin(list(ids)))


def derived_panel(panel: DataFrame, cutover: str = FACILITY_START) -> DataFrame:
    """The panel with all derived series of the pages added; read a stored panel, it is scanned often."""
    spark = panel.sparkSession
    repo = _series(K.spread_bps(panel, _legs(spark, BPS_SPREADS)))
    quality = _series(K.spread(panel, _legs(spark, SPREADS)))
    net = _legs(spark, NET_LIQUIDITY)
    valuation = K.ratio_with_monthly_z(panel, _legs(spark, VALUATION))
    margin = K.ratio_excess_growth(panel, _legs(spark, MARGIN))
    credit = K.three_term_balance(resample_last(panel, "ME"), _legs(spark, NET_CREDIT))
    faces = literal_table(spark, [(s, f) for s, _, f in NOTIONALS], "series_id string, face_value long")
    notionals = _renamed(K.notional(panel, faces), {s: n for s, n, _ in NOTIONALS}, "value")
    changes = diff(notionals.where(F.col("value").isNotNull()))
    change_z = zscore_of_diff(notionals, 260)

    expanding = expanding_zscore(_only(panel, EXPANDING_Z).unionByName(repo))
    rolling = rolling_zscore(_only(panel, ROLLING_Z).unionByName(quality), 252)
    yoy = yoy_calendar(resample_last(_only(panel, CALENDAR_YOY), "MS"))
    parts = [
        repo,
        quality,
        _series(K.net_of_two(panel, net)),
        _named(K.net_of_two_hybrid_change(panel, net, cutover), "net_liquidity_yoy"),
        _series(K.growth_differential(panel, _legs(spark, REAL_GROWTH))),
        _renamed(expanding, EXPANDING_Z, "z"),
        _renamed(rolling, ROLLING_Z, "z"),
        _renamed(yoy, CALENDAR_YOY, "yoy"),
        _named(margin, "margin_m2", "ratio_pct"),
        _named(margin, "margin_m2_z", "z"),
        _named(margin, "margin_excess_growth", "excess_growth"),
        _named(credit.withColumn("value", F.col("value") / 1000.0), "net_credit_bn"),
        notionals,
        changes.select(F.concat("series_id", F.lit("_diff")).alias("series_id"), "date", F.col("diff").alias("value")),
        change_z.select(F.concat("series_id", F.lit("_diff_z")).alias("series_id"), "date", F.col("z").alias("value")),
        _named(valuation, "sp500_m2", "ratio"),
        _named(valuation, "sp500_m2_z", "z"),
    ]
    out = panel.select("series_id", "date", "value")
    for part in parts:
        out = out.unionByName(part)
    return out


def page(derived: DataFrame, name: str, floor: str | None = None) -> DataFrame:
    """Rows of one page from its anchor on; ``floor`` replaces the page's earliest start."""
    series, anchors, earliest, year_start = PAGES[name]
    shown = anchor_trim(derived, anchors, floor if floor is not None else earliest, year_start)
    return _only(shown.where(F.col("value").isNotNull()), series)


def macro_scorecard(derived: DataFrame) -> DataFrame:
    spec = literal_table(derived.sparkSession, SCORECARD, SPEC_SCHEMA)
    return scorecard(derived, spec)
