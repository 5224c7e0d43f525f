"""Wide and long forms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.names import feature_name, parse_series, parse_transform


def wide_to_long(wide: DataFrame, columns: Sequence[str], date: str = "date") -> DataFrame:
    """One row per date and column; missing values stay as rows."""
    return wide.unpivot([date], list(columns), "name", "value")


def long_to_wide(panel: DataFrame, series: Sequence[str], key: str = "series_id") -> DataFrame:
    """One column per named series, outer-aligned on the date.

    The list of columns is always given: asking the data for it costs a job and
    makes the schema depend on the rows.
    """
    return panel.groupBy("date").pivot(key, list(series)).agg(F.max("value"))


def parse_feature_names(long: DataFrame, name: str = "name") -> DataFrame:
    """Split derived column names into series id and transform."""
    return long.withColumns({"series_id": parse_series(F.col(name)), "transform": parse_transform(F.col(name))})


def features_to_wide(features: DataFrame, names: Sequence[str]) -> DataFrame:
    """Wide feature table with columns named ``<series_id>_<transform>``; levels carry the bare id."""
    named = F.when(F.col("transform") == "level", F.col("series_id")).otherwise(
        feature_name(F.col("series_id"), F.col("transform"))
    )
    return long_to_wide(features.withColumn("name", named), names, "name")
