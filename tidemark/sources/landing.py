"""Normalising landed provider files.

Everything external arrives as text.  A bad number or date becomes NULL, never
an error; a bad document is set aside with its text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import business_month_end
from tidemark.operators.merge import keep_last
from tidemark.operators.quality import require_rows
from tidemark.schema import nan_to_null

OBSERVATION_PAGE = (
    "series_id string, observations array<struct<realtime_start: string, date: string, value: string>>, _corrupt string"
)

# Provider column -> our column.
POSITION_COLUMNS = {
    "lev_money_positions_long": "lev_long",
    "lev_money_positions_short": "lev_short",
    "dealer_positions_long_all": "dealer_long",
    "dealer_positions_short_all": "dealer_short",
    "asset_mgr_positions_long": "asset_mgr_long",
    "asset_mgr_positions_short": "asset_mgr_short",
    "other_rept_positions_long": "other_long",
    "other_rept_positions_short": "other_short",
}
POSITION_DATE = "report_date_as_yyyy_mm_dd"
POSITION_CONTRACT = "cftc_contract_market_code"
# Contract code -> label of the contract.
CONTRACTS = {
    "043602": "UST_10Y",
    "042601": "UST_2Y",
    "044601": "UST_5Y",
    "020601": "UST_Bond_30Y",
    "043607": "UST_Ultra_10Y",
}

MARGIN_SHEET = "year_month string, debit string, fc_cash string, fc_margin string"


def number(text: Column) -> Column:
    """Text to DOUBLE; anything that is no number (also ``.`` and ``NaN``) is NULL."""
    return nan_to_null(F.trim(text).try_cast("double"))


def day(text: Column) -> Column:
    """Leading ``yyyy-MM-dd`` of a text to DATE, NULL when there is none."""
    return F.substring(F.trim(text), 1, 10).try_cast("date")


def parse_observation_pages(raw: DataFrame, payload: str) -> DataFrame:
    """Documents held in a text column, split from unreadable ones by ``_corrupt``."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    return raw.select(F.from_json(payload, OBSERVATION_PAGE, options).alias("page")).select("page.*")


def read_observation_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed files with one JSON document per line."""
    return parse_observation_pages(spark.read.text(path), "value")


def quarantined_pages(pages: DataFrame) -> DataFrame:
    """Documents that could not be read, with their text."""
    return pages.where(F.col("_corrupt").isNotNull()).select(F.col("_corrupt").alias("payload"))


def normalize_vintages(pages: DataFrame, data_from: str | None = None, realtime_from: str | None = None) -> DataFrame:
    """Readable documents to a vintage table, optionally bounded on either date."""
    rows = pages.where(F.col("_corrupt").isNull()).select("series_id", F.explode("observations").alias("o"))
    typed = rows.select(
        "series_id",
        day(F.col("o.realtime_start")).alias("realtime_start"),
        day(F.col("o.date")).alias("date"),
        number(F.col("o.value")).alias("value"),
    )
    return bound_vintages(typed, data_from, realtime_from)


def bound_vintages(vintages: DataFrame, data_from: str | None = None, realtime_from: str | None = None) -> DataFrame:
    """Lower bounds on data date and publication date; both reach the scan of a stored table."""
    out = vintages
    if data_from is not None:
        out = out.where(F.col("date") >= F.lit(data_from).cast("date"))
    if realtime_from is not None:
        out = out.where(F.col("realtime_start") >= F.lit(realtime_from).cast("date"))
    return out


def ingest_vintages(spark: SparkSession, path: str, **bounds) -> DataFrame:
    """Landing folder to vintage table; a landing without any readable row is an error."""
    return require_rows(normalize_vintages(read_observation_pages(spark, path), **bounds), f"observations in {path}")


def normalize_positions(raw: DataFrame) -> DataFrame:
    """Provider rows (all text) to typed long, short and net positions per contract and date."""
    have = set(raw.columns)
    typed = raw.select(
        F.col(POSITION_CONTRACT).alias("contract"),
        day(F.col(POSITION_DATE)).alias("date"),
        *[
            (number(F.col(src)) if src in have else F.lit(None).cast("double")).alias(dst)
            for src, dst in POSITION_COLUMNS.items()
        ],
    )
    holders = ["lev", "dealer", "asset_mgr"]
    columns = [c for h in holders for c in (f"{h}_long", f"{h}_short", f"{h}_net")]
    nets = {f"{h}_net": F.col(f"{h}_long") - F.col(f"{h}_short") for h in holders}
    return typed.withColumns(nets).select("contract", "date", *columns)


def scan_filtered(df: DataFrame, key: str, wanted, date: str, start: str) -> DataFrame:
    """The provider's own row selection: every row of one key from a start date on; both filters reach the scan."""
    return df.where((F.col(key) == wanted) & (F.col(date) >= F.lit(start).cast(df.schema[date].dataType)))


def positions_panel(positions: DataFrame, labels: dict[str, str]) -> DataFrame:
    """Wide panel of net positions per labelled contract, outer-aligned on the date.

    Columns are ``TFF_<tenor>_LEVERAGED`` and ``<label>_asset_mgr_net``.
    """
    named = []
    for code, label in labels.items():
        mine = F.col("contract") == code
        tenor = label.removeprefix("UST_")
        named.append(F.max(F.when(mine, F.col("lev_net"))).alias(f"TFF_{tenor}_LEVERAGED"))
        named.append(F.max(F.when(mine, F.col("asset_mgr_net"))).alias(f"{label}_asset_mgr_net"))
    return positions.where(F.col("contract").isin(list(labels))).groupBy("date").agg(*named)


def read_margin_sheet(spark: SparkSession, path: str) -> DataFrame:
    """Landed sheet as CSV, in one file or several; the first four columns count, whatever their headings say.

    ``src_order`` is the place of a row: files by name, then by the part of the
    file that a task reads, then as they follow in it.
    """
    rows = spark.read.schema(MARGIN_SHEET).option("header", True).option("enforceSchema", True).csv(path)
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),  # ascending within a block, which one task reads from its start
    )
    return rows.withColumn("src_order", place)


def normalize_margin(raw: DataFrame) -> DataFrame:
    """Sheet rows to one typed row per business month end; the last of duplicate months wins."""
    month = F.concat(F.substring(F.trim("year_month"), 1, 7), F.lit("-01")).try_cast("date")
    typed = raw.select(
        business_month_end(month).alias("date"),
        number(F.col("debit")).alias("debit"),
        number(F.col("fc_cash")).alias("fc_cash"),
        number(F.col("fc_margin")).alias("fc_margin"),
        "src_order",
    ).where(F.col("date").isNotNull())
    return keep_last(typed, ["date"], ["src_order"]).select("date", "debit", "fc_cash", "fc_margin")
