"""Schemas shared by sources, operators and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PANEL = T.StructType(
    [
        T.StructField("series_id", T.StringType(), False),
        T.StructField("date", T.DateType(), False),
        T.StructField("value", T.DoubleType(), True),
    ]
)

VINTAGE = T.StructType(
    [
        T.StructField("series_id", T.StringType(), False),
        T.StructField("realtime_start", T.DateType(), False),
        T.StructField("date", T.DateType(), False),
        T.StructField("value", T.DoubleType(), True),
    ]
)

FIRST_RELEASE = T.StructType(
    [
        T.StructField("series_id", T.StringType(), False),
        T.StructField("effective_date", T.DateType(), False),
        T.StructField("date", T.DateType(), False),
        T.StructField("value", T.DoubleType(), True),
    ]
)

REGISTRY = T.StructType(
    [
        T.StructField("series_id", T.StringType(), False),
        T.StructField("name", T.StringType(), True),
        T.StructField("source", T.StringType(), False),
        T.StructField("frequency", T.StringType(), False),
        T.StructField("category", T.StringType(), False),
        T.StructField("unit", T.StringType(), True),
        T.StructField("mon_transforms", T.ArrayType(T.StringType()), False),
        T.StructField("fm_transforms", T.ArrayType(T.StringType()), False),
        T.StructField("lag", T.IntegerType(), True),
        T.StructField("is_vintage", T.BooleanType(), False),
    ]
)

FEATURES = T.StructType(
    [
        T.StructField("series_id", T.StringType(), False),
        T.StructField("transform", T.StringType(), False),
        T.StructField("date", T.DateType(), False),
        T.StructField("value", T.DoubleType(), True),
    ]
)


def require_columns(df: DataFrame, columns, what: str) -> DataFrame:
    """Raise when ``df`` lacks one of ``columns`` (checked on the schema, no job)."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing required columns {missing}; got {df.columns}")
    return df


def nan_to_null(value: Column) -> Column:
    """Pandas-born data carries NaN for missing; the engine only knows NULL."""
    return F.when(~F.isnan(value), value)


def as_panel(df: DataFrame, series_id, date, value) -> DataFrame:
    """Project any table to panel columns: day stamps are dates, missing is NULL."""

    def col(c):
        return F.col(c) if isinstance(c, str) else c

    return df.select(
        col(series_id).cast("string").alias("series_id"),
        col(date).cast("date").alias("date"),
        nan_to_null(col(value).cast("double")).alias("value"),
    )
