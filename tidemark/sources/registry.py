"""The indicator registry: one row per series decides how it is treated everywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.quality import enforce, registry_violations
from tidemark.schema import REGISTRY
from tidemark.sources.literal import literal_table

# The macro-financial indicators this engine ships with.
# (series_id, name, source, frequency, category, unit, monitoring transforms,
#  feature transforms, publication lag in calendar days or None, vintage table)
INDICATORS = [
    ("SOFR", "SOFR", "FRED", "D", "rates", "%", [], [], 1, False),
    ("EFFR", "EFFR", "FRED", "D", "rates", "%", [], [], 1, False),
    ("IORB", "IORB", "FRED", "D", "rates", "%", [], [], None, False),
    ("RRPONTSYAWARD", "ON RRP Award Rate", "FRED", "D", "rates", "%", [], [], None, False),
    ("DFEDTARU", "Fed Funds Target Upper", "FRED", "D", "rates", "%", [], [], None, False),
    ("DFEDTARL", "Fed Funds Target Lower", "FRED", "D", "rates", "%", [], [], None, False),
    ("TGCRRATE", "Tri-Party GC Repo Rate", "FRED", "D", "rates", "%", [], [], None, False),
    ("RRPONTSYD", "ON RRP Volume", "FRED", "D", "liquidity", "Billions of $", [], [], 1, False),
    ("WALCL", "Fed Total Assets", "FRED", "W", "liquidity", "Millions of $", [], [], 1, False),
    ("WDTGAL", "Treasury General Account", "FRED", "W", "liquidity", "Millions of $", [], [], 1, False),
    ("M2SL", "M2 Money Stock", "FRED", "M", "liquidity", "Billions of $", [], [], None, True),
    ("WRBWFRBL", "Reserve Balances", "FRED", "W", "liquidity", "Millions of $", [], [], None, False),
    ("RPONTSYD", "Standing Repo Facility Use", "FRED", "D", "liquidity", "Billions of $", [], [], None, False),
    ("WLCFLPCL", "Discount Window Primary Credit", "FRED", "W", "liquidity", "Millions of $", [], [], None, False),
    ("H41RESPPALDKNWW", "BTFP Outstanding", "FRED", "W", "liquidity", "Millions of $", [], [], None, False),
    ("BAMLH0A0HYM2", "HY OAS", "FRED", "D", "credit", "%", ["zscore_expanding"], ["diff_bps"], 1, False),
    ("BAMLC0A0CM", "IG Corp OAS", "FRED", "D", "credit", "%", ["zscore_rolling_1y"], [], None, False),
    ("BAMLH0A1HYBB", "BB HY OAS", "FRED", "D", "credit", "%", [], [], None, False),
    ("BAMLH0A3HYC", "CCC HY OAS", "FRED", "D", "credit", "%", [], [], None, False),
    ("BAMLEMHYHYLCRPIUSOAS", "EM HY OAS", "FRED", "D", "credit", "%", ["zscore_rolling_1y"], [], None, False),
    ("DGS2", "2Y Treasury", "FRED", "D", "curve", "%", [], [], None, False),
    ("DGS10", "10Y Treasury", "FRED", "D", "curve", "%", [], [], None, False),
    ("T10Y2Y", "10Y-2Y Spread", "FRED", "D", "curve", "%", [], ["diff_bps"], 0, False),
    ("T10Y3M", "10Y-3M Spread", "FRED", "D", "curve", "%", [], ["diff_bps"], 0, False),
    ("DFII10", "10Y Real Yield", "FRED", "D", "curve", "%", [], ["diff_bps"], 1, False),
    ("T10YIE", "10Y Breakeven", "FRED", "D", "curve", "%", [], ["diff_bps"], 1, False),
    ("VIXCLS", "VIX", "FRED", "D", "vol", "index", ["zscore_expanding"], ["diff"], 1, False),
    ("NFCILEVERAGE", "NFCI Leverage Subindex", "FRED", "W", "leverage", "index", [], ["level", "diff"], None, True),
    ("NFCI", "NFCI Headline", "FRED", "W", "leverage", "index", [], ["level", "diff"], None, True),
    ("NFCIRISK", "NFCI Risk Subindex", "FRED", "W", "leverage", "index", [], ["level", "diff"], None, True),
    ("NFCICREDIT", "NFCI Credit Subindex", "FRED", "W", "leverage", "index", [], ["level", "diff"], None, True),
    ("ANFCI", "Adjusted NFCI", "FRED", "W", "leverage", "index", [], ["level", "diff"], None, True),
    ("FINRA_MARGIN_DEBT", "FINRA Margin Debt", "FINRA", "M", "leverage", "Millions of $", ["yoy"], [], 25, False),
    ("DEXTAUS", "USD/TWD", "FRED", "D", "fx", "TWD per USD", ["pct_change_1m"], ["pct_change_1m"], 1, False),
    ("DTWEXEMEGS", "Nominal EM USD Index", "FRED", "D", "fx", "index", ["pct_change_1m"], ["pct_change_1m"], 5, False),
    ("CPIAUCSL", "CPI", "FRED", "M", "macro", "index", ["yoy"], ["yoy"], None, True),
    ("PCEPILFE", "Core PCE", "FRED", "M", "macro", "index", ["yoy"], ["yoy"], None, True),
    ("SP500", "S&P 500", "FRED", "D", "macro", "index", ["pct_change_1m"], ["pct_change_1m"], 0, False),
    ("TFF_10Y_LEVERAGED", "Leveraged Net, 10Y Futures", "CFTC", "W", "cftc", "contracts", ["diff"], ["diff"], 3, False),
    ("TFF_2Y_LEVERAGED", "Leveraged Net, 2Y Futures", "CFTC", "W", "cftc", "contracts", ["diff"], ["diff"], 3, False),
]

# Display name of a category.
BLOCK_NAMES = {
    "rates": "Repo Plumbing",
    "liquidity": "Liquidity",
    "credit": "Credit",
    "curve": "Yield Curve & Real Rates",
    "vol": "Volatility",
    "leverage": "Leverage",
    "fx": "FX",
    "macro": "Macro Reference",
    "cftc": "CFTC Positioning",
}

# Measured days to first release where they replace the configured lag.
MEASURED_LAG = {"CPIAUCSL": 50, "M2SL": 52, "PCEPILFE": 58}


def default_registry(spark: SparkSession) -> DataFrame:
    return literal_table(spark, INDICATORS, REGISTRY)


def by_category(registry: DataFrame, category: str) -> DataFrame:
    return registry.where(F.col("category") == category)


def by_source(registry: DataFrame, source: str) -> DataFrame:
    return registry.where(F.col("source") == source)


def by_frequency(registry: DataFrame, frequency: str) -> DataFrame:
    return registry.where(F.col("frequency") == frequency)


def get(registry: DataFrame, series_id: str) -> DataFrame:
    """At most one row."""
    return registry.where(F.col("series_id") == series_id)


def validate(registry: DataFrame) -> DataFrame:
    """Fail when a series reaches the features with neither lag nor vintage table."""
    enforce(registry_violations(registry), "feature series without publication lag")
    return registry
