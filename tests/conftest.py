import datetime as dt
import os
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.schema import PANEL, VINTAGE  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def day(text):
    return dt.date.fromisoformat(text)


def _null(v):
    return None if v is None or (isinstance(v, float) and np.isnan(v)) else v


@pytest.fixture(scope="session")
def panel_of(spark):
    """Panel from ``{series_id: pandas Series with a date index}``."""

    def make(series):
        rows = [
            (sid, pd.Timestamp(d).date(), _null(float(v)) if v is not None else None)
            for sid, s in series.items()
            for d, v in s.items()
        ]
        return spark.createDataFrame(rows, PANEL)

    return make


@pytest.fixture(scope="session")
def vintages_of(spark):
    """Vintage table from ``(series_id, realtime_start, date, value)`` with text dates."""

    def make(rows):
        return spark.createDataFrame([(s, day(r), day(d), v) for s, r, d, v in rows], VINTAGE)

    return make


@pytest.fixture(scope="session")
def registry_of(spark):
    """Registry from ``{series_id: dict of properties}``."""
    from tidemark.schema import REGISTRY

    def make(spec):
        rows = []
        for sid, p in spec.items():
            tf = p.get("transforms", [])
            rows.append(
                (
                    sid,
                    p.get("name", sid),
                    p.get("source", "FRED"),
                    p.get("frequency", "D"),
                    p.get("category", "rates"),
                    p.get("unit", "%"),
                    p.get("mon", tf),
                    p.get("fm", tf),
                    p.get("lag"),
                    p.get("is_vintage", False),
                )
            )
        return spark.createDataFrame(rows, REGISTRY)

    return make


def walk(n=500, seed=42, start="2020-01-01", freq="B"):
    """Seeded random walk around 100 on weekdays (or another pandas frequency)."""
    steps = np.random.default_rng(seed).normal(size=n)
    return pd.Series(steps.cumsum() + 100.0, index=pd.date_range(start, periods=n, freq=freq))


def corrupt_after(s, row):
    """The same series with every value after ``row`` replaced by nonsense."""
    out = s.copy()
    out.iloc[row + 1 :] = -99999.0
    return out


def collect(df, value, key="series_id"):
    """``{(key, date): value}``"""
    return {(r[key], r["date"]): r[value] for r in df.select(key, "date", value).collect()}


def assert_same(got, want, tol=1e-9):
    assert got.keys() == want.keys()
    for k, g in got.items():
        w = _null(want[k])
        assert (g is None) == (w is None), (k, g, w)
        if g is not None:
            assert abs(g - w) <= tol * max(1.0, abs(w)), (k, g, w)


def as_dict(s, sid="a"):
    return {(sid, d.date()): _null(float(v)) for d, v in s.items()}


def differing_rows(a, b, until):
    """Rows up to a day that one result has and the other has not."""
    a, b = (x.where(F.col("date") <= F.lit(until)) for x in (a, b))
    return a.exceptAll(b).count() + b.exceptAll(a).count()
