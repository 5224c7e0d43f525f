"""Names of derived columns: ``<series_id>`` for a level, else ``<series_id>_<suffix>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Transform name in the registry -> suffix of the derived column.
SUFFIX = {
    "zscore_rolling_1y": "zscore",
    "zscore_rolling_3y": "zscore_3y",
    "zscore_rolling_5y": "zscore_5y",
    "zscore_expanding": "zscore_exp",
    "yoy": "yoy",
    "pct_change_1m": "pct1m",
    "diff": "diff",
    "diff_bps": "diff_bps",
    "level": "level",
}

_ALTERNATIVES = "|".join(sorted(SUFFIX.values(), key=len, reverse=True))


def parse_series(name: Column) -> Column:
    """Series id of a derived column name; the longest known suffix is cut."""
    return F.regexp_replace(name, f"_(?:{_ALTERNATIVES})$", "")


def parse_transform(name: Column) -> Column:
    """Suffix of a derived column name, ``level`` when it carries none."""
    found = F.regexp_extract(name, f"_({_ALTERNATIVES})$", 1)
    return F.when(found == "", F.lit("level")).otherwise(found)


def feature_name(series_id: Column, suffix: Column) -> Column:
    return F.concat_ws("_", series_id, suffix)
