import numpy as np
import pandas as pd
import pytest
from conftest import collect, day, walk
from pyspark.sql import functions as F

from tidemark.operators import pit as P
from tidemark.operators.asof import asof_last
from tidemark.operators.calendar import business_grid


def test_align_matches_pandas(panel_of, registry_of):
    """Shift, business grid from the first to the last shifted stamp of all, drop missing, hold."""
    rng = np.random.default_rng(5)
    series = {k: walk(80, i, freq=f) for i, (k, f) in enumerate([("a", "B"), ("b", "W-WED"), ("c", "MS")])}
    series["a"][rng.random(80) < 0.2] = np.nan
    series["b"].iloc[-1] = np.nan
    lags = {"a": 1, "b": 3, "c": 14}
    shifted = {k: s.set_axis(s.index + pd.Timedelta(days=lags[k])) for k, s in series.items()}
    stamps = pd.concat(shifted.values()).index
    grid = pd.date_range(stamps.min(), stamps.max(), freq="B")
    want = {
        (k, d.date()): v for k, s in shifted.items() for d, v in s.dropna().reindex(grid, method="ffill").dropna().items()
    }
    got = collect(P.pit_align(panel_of(series), registry_of({k: {"lag": v} for k, v in lags.items()})), "value")
    assert got == want


def test_series_without_lag_stops_the_job(panel_of, registry_of):
    with pytest.raises(Exception, match="no publication lag for series b"):
        P.pit_align(panel_of({"a": walk(5), "b": walk(5)}), registry_of({"a": {"lag": 1}, "b": {}})).collect()


VINTAGES = [
    ("a", "2024-02-10", "2024-01-01", None),  # the first release was blank
    ("a", "2024-02-20", "2024-01-01", 1.1),
    ("a", "2024-03-12", "2024-02-01", 2.0),
    ("a", "2024-03-12", "2023-12-01", 0.5),  # released the same day
    ("a", "2024-05-01", "2024-02-01", 2.2),
]


def test_first_and_latest_release(vintages_of):
    v = vintages_of(VINTAGES)
    first = {r.date: (r.effective_date, r.value) for r in P.first_release(v).collect()}
    assert first[day("2024-01-01")] == (day("2024-02-10"), None)
    assert first[day("2024-02-01")] == (day("2024-03-12"), 2.0)
    last = {r.date: (r.release_date, r.value) for r in P.latest_release(v).collect()}
    assert last[day("2024-01-01")] == (day("2024-02-20"), 1.1)
    assert last[day("2024-02-01")] == (day("2024-05-01"), 2.2)


def test_release_ties_are_ordered(spark, vintages_of):
    v = vintages_of([("a", "2024-02-10", "2024-01-01", x) for x in (3.0, 1.0, 2.0)]).withColumn(
        "line", F.when(F.col("value") == 2.0, 0).otherwise(1)
    )
    assert P.first_release(v, ties=["line"]).collect()[0].value == 2.0


def test_missing_column_and_empty_input(spark, vintages_of):
    with pytest.raises(ValueError, match="missing required columns"):
        P.first_release(vintages_of(VINTAGES).drop("value"))
    empty = vintages_of(VINTAGES).where("false")
    out = P.first_release(empty)
    assert out.columns == ["series_id", "effective_date", "date", "value"] and out.count() == 0
    queries = spark.createDataFrame([("a", day("2024-03-01"))], "series_id string, query_date date")
    row = P.asof_backward(out, queries).collect()[0]
    assert (row.pit_value, row.data_date, row.effective_date) == (None, None, None)


def test_asof_keeps_a_matched_blank_and_orders_ties(spark, vintages_of):
    queries = spark.createDataFrame(
        [("a", day(d)) for d in ("2024-02-09", "2024-02-10", "2024-03-11", "2024-03-12", "2025-01-01")],
        "series_id string, query_date date",
    )
    got = {
        r.query_date: (r.pit_value, r.data_date, r.effective_date)
        for r in P.asof_backward(P.first_release(vintages_of(VINTAGES)), queries).collect()
    }
    assert got[day("2024-02-09")] == (None, None, None)
    assert got[day("2024-02-10")] == (None, day("2024-01-01"), day("2024-02-10"))
    # Two data dates came out on the same day: the later one counts.
    assert got[day("2024-03-12")] == (2.0, day("2024-02-01"), day("2024-03-12"))
    assert got[day("2025-01-01")] == (2.0, day("2024-02-01"), day("2024-03-12"))


def test_asof_lag_delays_use_but_not_the_stamp(spark, vintages_of):
    queries = spark.createDataFrame([("a", day("2024-03-15")), ("a", day("2024-03-17"))], "series_id string, query_date date")
    got = {
        r.query_date: r.effective_date
        for r in P.asof_backward(P.first_release(vintages_of(VINTAGES)), queries, lag_days=5).collect()
    }
    assert got == {day("2024-03-15"): day("2024-02-10"), day("2024-03-17"): day("2024-03-12")}
    with pytest.raises(ValueError, match="lag_days"):
        P.asof_backward(P.first_release(vintages_of(VINTAGES)), queries, lag_days=-1)


def test_levels_agree_with_asof(spark, vintages_of):
    rng = np.random.default_rng(3)
    rows = []
    for sid in ("a", "b"):
        for m in pd.date_range("2020-01-01", periods=30, freq="MS"):
            for k in range(rng.integers(1, 4)):
                release = m + pd.Timedelta(days=int(rng.integers(10, 90)) + 100 * k)
                rows.append((sid, str(release.date()), str(m.date()), None if rng.random() < 0.1 else float(rng.normal())))
    v = vintages_of(list({r[:3]: r for r in rows}.values()))
    grid = business_grid(spark.sql("SELECT explode(array(DATE'2020-01-01', DATE'2023-06-30')) AS date"))
    asked = v.select("series_id").distinct().crossJoin(grid.withColumnRenamed("date", "query_date"))
    a = P.asof_backward(P.first_release(v), asked).where("effective_date IS NOT NULL")
    b = P.vintage_levels(v, grid)
    want = {(r.series_id, r.query_date): (r.pit_value, r.data_date) for r in a.collect()}
    got = {(r.series_id, r.date): (r.value, r.obs_date) for r in b.collect()}
    assert got == want and len(want) > 1000


def test_published_before_its_period_stops_the_job(vintages_of):
    v = vintages_of([("a", "2023-12-31", "2024-01-01", 1.0)])
    assert P.release_order_violations(v, "realtime_start").count() == 1
    with pytest.raises(Exception, match="published before its data date"):
        P.check_release_order(P.first_release(v)).collect()


def test_asof_for_many_facts_a_day(spark):
    """Facts repeating a (key, day) are all answered, a NULL day included."""
    left = spark.createDataFrame(
        [("k", day("2024-01-05"), i) for i in range(50)] + [("k", None, 99), ("other", day("2024-01-05"), 98)],
        "k string, ts date, id int",
    )
    right = spark.createDataFrame([("k", day("2024-01-03"), 7.0), ("k", day("2024-01-09"), 8.0)], "k string, d date, v double")
    got = {r.id: r.v for r in asof_last(left, right, "ts", "d", by=["k"], carry=["v"]).collect()}
    assert got == {**{i: 7.0 for i in range(50)}, 99: None, 98: None}


def test_lookahead_diagnostic(panel_of, registry_of):
    p = panel_of({"a": walk(50), "flat": walk(50) * 0 + 1})
    pit = P.pit_align(p, registry_of({"a": {"lag": 5}, "flat": {"lag": 5}}))
    got = {r.series_id: r.look_ahead for r in P.diagnose_lookahead(p, pit, "2020-02-20").collect()}
    assert got == {"a": True, "flat": False}
