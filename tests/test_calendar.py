import numpy as np
import pandas as pd
import pytest
from conftest import as_dict, assert_same, collect, day, walk
from pandas.tseries.holiday import USFederalHolidayCalendar
from pandas.tseries.offsets import BMonthEnd, CustomBusinessDay
from pyspark.sql import functions as F

from tidemark.functions import dates as D
from tidemark.functions import names, numeric
from tidemark.operators import calendar as C


@pytest.fixture(scope="module")
def days(spark):
    return spark.sql("SELECT explode(sequence(DATE'1984-01-01', DATE'2030-12-31')) AS d")


def test_federal_holidays_match_a_known_calendar(days):
    got = {r.d for r in days.where(D.is_federal_holiday(F.col("d"))).collect()}
    known = {d.date() for d in USFederalHolidayCalendar().holidays("1984-01-01", "2031-01-31")}
    assert got == {d for d in known if d.weekday() < 5 and d <= day("2030-12-31")}


@pytest.mark.parametrize("n", [1, 3, 10])
def test_business_days_match_a_known_calendar(n, days):
    step = n * CustomBusinessDay(calendar=USFederalHolidayCalendar())
    got = days.where("d BETWEEN DATE'2018-01-01' AND DATE'2024-12-31'").select("d", D.add_business_days(F.col("d"), n).alias("x"))
    for r in got.collect():
        start = pd.Timestamp(r.d)
        # From a closed day the first step lands on the next open one.
        assert r.x == (start + step).date(), r.d


def test_business_month_end(days):
    for r in days.where("day(d) = 10").select("d", D.business_month_end(F.col("d")).alias("x")).collect():
        assert r.x == (pd.Timestamp(r.d).replace(day=1) + BMonthEnd(0)).date()


@pytest.mark.parametrize("rule, pandas_rule", [("W", "W"), ("ME", "ME"), ("QE", "QE"), ("MS", "MS")])
def test_resample_matches_pandas(rule, pandas_rule, panel_of):
    s = walk(300, freq="D")
    s[np.random.default_rng(2).random(300) < 0.4] = np.nan
    want = s.dropna().resample(pandas_rule).last().dropna()
    assert_same(collect(C.resample_last(panel_of({"a": s}), rule), "value"), as_dict(want))


def test_label_fill_keeps_missing_labels_and_value_fill_does_not(panel_of, spark):
    s = pd.Series([1.0, np.nan], index=pd.to_datetime(["2024-01-01", "2024-01-04"]))
    grid = spark.sql("SELECT explode(sequence(DATE'2023-12-30', DATE'2024-01-06')) AS date")
    got = collect(C.ffill_on_grid(panel_of({"a": s}), grid), "value")
    assert {d.day: v for (_, d), v in got.items()} == {1: 1.0, 2: 1.0, 3: 1.0, 4: None, 5: None, 6: None}
    filled = panel_of({"a": s}).withColumn("f", C.ffill_value())
    assert [r.f for r in filled.orderBy("date").collect()] == [1.0, 1.0]


def test_weekly_label_is_not_visible_early(panel_of, spark):
    s = pd.Series([1.0, 2.0], index=pd.to_datetime(["2024-01-03", "2024-01-10"]))  # two Wednesdays
    grid = spark.sql("SELECT explode(sequence(DATE'2024-01-03', DATE'2024-01-16')) AS date")
    got = collect(C.ffill_on_grid(C.resample_last(panel_of({"a": s}), "W"), grid), "value")
    assert ("a", day("2024-01-06")) not in got
    assert got[("a", day("2024-01-07"))] == 1.0 and got[("a", day("2024-01-13"))] == 1.0 and got[("a", day("2024-01-14"))] == 2.0


def test_pending_tail(panel_of, spark):
    s = pd.Series([1.0, 2.0], index=pd.to_datetime(["2024-01-02", "2024-01-04"]))
    index = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-01-06')) AS date")
    got = {r.date.day: (r.value, r.is_pending) for r in C.pending_tail(panel_of({"a": s}), index).collect()}
    assert got == {1: (None, False), 2: (1.0, False), 3: (None, False), 4: (2.0, False), 5: (2.0, True), 6: (2.0, True)}


def test_trading_days(panel_of):
    market = walk(150, freq="B").drop(pd.Timestamp("2020-03-02"))  # a weekday holiday
    policy = pd.Series(5.0, index=pd.date_range("2020-01-01", "2020-07-28"))  # seven days a week
    got = {r.date for r in C.trading_days(panel_of({"m": market, "p": policy})).collect()}
    assert got == {d.date() for d in market.index}


def test_hybrid_grid(panel_of):
    s = pd.Series([4.0, 6.0, 3.0], index=pd.to_datetime(["2024-01-02", "2024-01-04", "2024-01-10"]))
    got = collect(C.hybrid_grid_change(panel_of({"a": s}), "2024-01-08", periods=3), "value")
    # 2nd to 5th January are weekdays before the cut, then only the observed 10th.
    assert {d.day: v for (_, d), v in got.items()} == {2: 4.0, 3: 0.0, 4: 6.0, 5: 0.0, 10: 3.0}
    change = collect(C.hybrid_grid_change(panel_of({"a": s}), "2024-01-08", periods=3), "change_pct")
    assert change[("a", day("2024-01-10"))] is None  # three rows back is a zero
    assert change[("a", day("2024-01-05"))] == -100.0


def test_trailing_years_and_anchor(panel_of):
    p = panel_of({"a": walk(1000), "b": walk(300, start="2022-06-01")})
    last = max(r.date for r in p.collect())
    assert min(r.date for r in C.trailing_years(p, 1).collect()) == (pd.Timestamp(last) - pd.DateOffset(years=1)).date()
    assert min(r.date for r in C.anchor_trim(p, ["b"]).collect()) == day("2022-06-01")
    assert min(r.date for r in C.anchor_trim(p, ["b"], to_year_start=True).collect()) == day("2022-01-03")


def test_names_and_lights(spark):
    cases = {
        "SOFR": ("SOFR", "level"), "SOFR_pct1m": ("SOFR", "pct1m"), "X_diff_bps": ("X", "diff_bps"), "X_diff": ("X", "diff"),
        "X_zscore_exp": ("X", "zscore_exp"), "X_zscore_5y": ("X", "zscore_5y"), "TFF_2Y_LEVERAGED": ("TFF_2Y_LEVERAGED", "level"),
        "NFCI_level": ("NFCI", "level"),
    }
    df = spark.createDataFrame([(n,) for n in cases], "n string")
    for r in df.select("n", names.parse_series(F.col("n")).alias("s"), names.parse_transform(F.col("n")).alias("t")).collect():
        assert (r.s, r.t) == cases[r.n]
    rows = [
        ("high", 2.0, 2.0, "r"), ("high", 1.9, 2.0, "g"), ("low", 3.0, 3.0, "g"), ("low", 2.9, 3.0, "r"),
        ("sign", 0.0, None, "g"), ("sign", -0.1, None, "r"), ("flip", 0.0, None, "g"), ("flip", 0.1, None, "r"),
        ("floor", 0.01, 1.0, "g"), ("floor", 1.0, 1.0, "r"), ("none", 5.0, None, ""), ("high", None, 2.0, ""),
    ]
    df = spark.createDataFrame(rows, "rule string, v double, thr double, want string")
    assert all(r.got == r.want for r in df.withColumn("got", numeric.light(F.col("v"), F.col("rule"), F.col("thr"))).collect())


def test_threshold_is_judged_on_the_rounded_value(spark):
    below, above = numeric.threshold_split(F.col("v"), 2.0, -2.0, 6.0)
    df = spark.createDataFrame([(1.996,), (1.994,), (9.0,), (-5.0,), (None,)], "v double").select(below.alias("b"), above.alias("a"))
    assert [tuple(r) for r in df.collect()] == [(0.0, 2.0), (1.99, 0.0), (0.0, 6.0), (-2.0, 0.0), (0.0, 0.0)]
