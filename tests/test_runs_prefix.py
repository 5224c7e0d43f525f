"""Runs against the panel they stand for, the bounded grid, and series cut into stretches against whole ones."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from conftest import day, walk
from pyspark.sql import functions as F

from tidemark.operators import pit as P
from tidemark.operators import prefix
from tidemark.operators import runs as R
from tidemark.operators.asof import asof_last
from tidemark.operators.calendar import to_native
from tidemark.operators.windows import expanding_moments
from tidemark.plans import pipeline
from tidemark.schema import PANEL
from tidemark.session import scratch_path


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_weekday_arithmetic_in_closed_form(spark):
    days = pd.date_range("2024-02-20", "2024-03-20").date
    pairs = spark.createDataFrame([(a, b) for a in days for b in days if a <= b], "a date, b date")
    got = pairs.select("a", "b", R.weekdays_between(F.col("a"), F.col("b")).alias("n"), R.first_weekday(F.col("a")).alias("f"), R.last_weekday(F.col("b")).alias("l")).collect()
    for r in got:
        assert r.n == np.busday_count(r.a, r.b + dt.timedelta(days=1))
        assert r.f == np.busday_offset(r.a, 0, roll="forward").astype(object) and r.l == np.busday_offset(r.b, 0, roll="backward").astype(object)


def test_native_periods_of_runs_are_those_of_the_panel(spark, panel_of, registry_of):
    """All four frequencies, gaps, missing values, values seen on a weekend only, and a grid ending inside a period."""
    rng = np.random.default_rng(3)
    series = {k: walk(60, i, freq=f) for i, (k, f) in enumerate([("d", "D"), ("w", "W-SAT"), ("m", "MS"), ("q", "QS")])}
    for s in series.values():
        s[rng.random(60) < 0.2] = np.nan
    spec = {k: {"lag": 2, "frequency": k.upper()} for k in series} | {"v": {"is_vintage": True, "frequency": "M"}}
    vintages = [("v", day("2020-02-15"), day("2020-01-01"), 1.0), ("v", day("2020-04-18"), day("2020-02-01"), None), ("v", day("2020-05-02"), day("2020-03-01"), 3.0)]
    table = spark.createDataFrame(vintages, "series_id string, realtime_start date, date date, value double")
    registry = registry_of(spec)
    for end in (None, "2020-02-19"):
        held = P.pit_runs(panel_of(series), table, registry, end=end)
        panel = P.pit_panel(panel_of(series), table, registry, end=end)
        want = rows(to_native(panel, registry), "series_id", "date", "value", "frequency")
        assert rows(R.to_native(held, registry), "series_id", "date", "value", "frequency") == want and len(want) > 30
        counted = panel.groupBy("series_id").agg(F.min("date"), F.max("date"), F.count("*").cast("int"))
        assert rows(R.coverage(held), "series_id", "first_valid", "last_valid", "n") == rows(counted, *counted.columns)
    assert not P.pit_panel(panel_of(series), table, registry, end="2020-02-19").where("date > '2020-02-19'").count()


def test_a_wrong_date_neither_stretches_the_grid_nor_vanishes(spark, panel_of, registry_of):
    good = panel_of({"a": walk(30), "b": walk(30, 1)})
    wrong = spark.createDataFrame([("a", day("9999-12-31"), 7.0), ("c", day("2031-01-01"), None)], PANEL)
    late = spark.createDataFrame([("v", day("9999-01-01"), day("2020-01-01"), 5.0), ("v", day("2020-01-20"), day("2020-01-01"), 4.0)], "series_id string, realtime_start date, date date, value double")
    registry = registry_of({"a": {"lag": 1}, "b": {"lag": 3}, "c": {"lag": 0}, "v": {"is_vintage": True, "frequency": "M"}})
    paths = pipeline.run(spark, good.unionByName(wrong), registry, scratch_path(spark, "job"), vintages=late, buckets=4, end="2020-03-31")
    aside = spark.read.parquet(paths["quarantine"])
    assert rows(aside, "series_id", "date", "value") == rows(wrong.unionByName(late.where("value = 5").select(*wrong.columns)), "series_id", "date", "value")
    pit = spark.read.parquet(paths["pit"]).where("value is not null")
    assert pit.agg(F.max("date")).first()[0] == day("2020-03-31")
    clean = P.pit_panel(good, late.where("value = 4"), registry, end="2020-03-31")
    assert rows(pit, "series_id", "date", "value") == rows(clean, "series_id", "date", "value")


@pytest.fixture(scope="module")
def long_series(spark):
    """One series of 30,000 days and 40 short ones; the long one has most rows, and every tenth value is missing."""
    long = spark.range(30_000).select(F.lit("long").alias("series_id"), F.col("id"))
    short = spark.range(40 * 100).select(F.concat(F.lit("s"), (F.col("id") % 40).cast("string")).alias("series_id"), (F.floor(F.col("id") / 40) * 7).alias("id"))
    value = F.when(F.col("id") % 10 != 3, 1e6 + F.sin(F.col("id") * 0.37) * 5)
    rows = long.unionByName(short).select("series_id", F.date_add(F.lit("1940-01-01").cast("date"), F.col("id").cast("int")).alias("date"), value.alias("value"))
    path = scratch_path(spark, "long")
    rows.write.parquet(path)
    return spark.read.parquet(path)


def test_expanding_moments_of_a_long_series(long_series):
    for lag, width in ((0, 1024), (5, 100)):
        one, many = expanding_moments(long_series, lag), prefix.expanding_moments(long_series, lag, width=width)
        both = one.alias("a").join(many.alias("b"), ["series_id", "date"])
        off = both.where(
            ~F.col("a.exp_n").eqNullSafe(F.col("b.exp_n"))
            | (F.col("a.exp_mean").isNull() != F.col("b.exp_mean").isNull())
            | (F.col("a.exp_std").isNull() != F.col("b.exp_std").isNull())
            | (F.abs(F.col("a.exp_mean") - F.col("b.exp_mean")) > 1e-6)
            | (F.abs(F.col("a.exp_std") - F.col("b.exp_std")) > 1e-6)
        )
        assert both.count() == long_series.count() == many.count() and off.count() == 0


def test_backward_match_of_a_long_series(spark, long_series):
    """Ties on a day, missing values carried, stretches without any history, several requests of one day."""
    history = long_series.where("day(date) < 12").withColumn("tie", F.lit(1))
    history = history.unionByName(history.where("day(date) = 5").withColumns({"tie": F.lit(2), "value": F.lit(None).cast("double")}))
    asked = long_series.select("series_id", F.date_add("date", 3).alias("date"), F.lit("x").alias("note"))
    asked = asked.unionByName(asked.where("day(date) = 1").withColumn("note", F.lit("y")))
    asked = asked.unionByName(spark.createDataFrame([("none", day("2000-01-01"), "z"), ("long", day("1900-01-01"), "early"), ("long", None, "no day")], "series_id string, date date, note string"))
    history = history.select("series_id", F.col("date").alias("seen"), "value", "tie")
    args = (asked, history, "date", "seen", ["series_id"], ["value", "seen"], ["tie"])
    one, many = asof_last(*args), prefix.asof_last(*args, width=50)
    assert one.count() == many.count() == asked.count()
    assert one.select(*many.columns).exceptAll(many).count() == 0
    assert max(r["count"] for r in asked.groupBy("series_id", prefix.time_bucket(F.col("date"), 50)).count().collect()) < 1_700
