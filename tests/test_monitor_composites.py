import pandas as pd
from conftest import collect, day, walk

from tidemark.operators import composites as K
from tidemark.operators import monitor as M
from tidemark.plans import dashboards as B


def s(values, dates):
    return pd.Series(values, index=pd.to_datetime(dates), dtype=float)


def legs(spark, *rows):
    return spark.createDataFrame(list(rows), "composite_id string, role string, series_id string")


def runs(*parts):
    """Daily series from (start, values) pieces."""
    return pd.concat([pd.Series(v, index=pd.date_range(d, periods=len(v)), dtype=float) for d, v in parts])


def test_episodes_merge_below_180_days_and_not_at_180(panel_of):
    # The first run ends on 2020-01-03; the next starts 179 or 180 days later.
    near = runs(("2020-01-01", [5, 7, 6, 0]), ("2020-06-30", [7, 5, 0]))
    far = runs(("2020-01-01", [5, 7, 6, 0]), ("2020-07-01", [8, 5, 0]))
    assert (pd.Timestamp("2020-06-30") - pd.Timestamp("2020-01-03")).days == 179
    got = [r.asDict() for r in M.episodes(panel_of({"near": near, "far": far}), 5.0).orderBy("series_id", "start_date").collect()]
    assert got == [
        dict(series_id="far", start_date=day("2020-01-01"), end_date=day("2020-01-03"), peak_date=day("2020-01-02"), peak_value=7.0, n_days=3),
        dict(series_id="far", start_date=day("2020-07-01"), end_date=day("2020-07-02"), peak_date=day("2020-07-01"), peak_value=8.0, n_days=2),
        # Both peaks are 7: the first one counts.
        dict(series_id="near", start_date=day("2020-01-01"), end_date=day("2020-07-01"), peak_date=day("2020-01-02"), peak_value=7.0, n_days=5),
    ]


def test_episodes_skip_missing_values_peaks_do_not(panel_of):
    x = runs(("2020-01-01", [5, 6, None, 9, 0]))
    assert [r.n_days for r in M.episodes(panel_of({"a": x}), 5.0).collect()] == [3]
    # A gap splits the run in two; their peaks still form one event.
    assert [(r.peak_date, r.peak_value) for r in M.episode_peaks(panel_of({"a": x}), 5.0).collect()] == [(day("2020-01-04"), 9.0)]
    assert [r.peak_value for r in M.episode_peaks(panel_of({"a": x}), 5.0, merge_days=2).orderBy("peak_date").collect()] == [6.0, 9.0]


def test_peak_distance_is_to_the_previous_peak(panel_of):
    # Peaks 100 days apart each: a chain of three is one cluster although its ends are 200 days apart.
    x = runs(("2020-01-01", [6, 0]), ("2020-04-10", [7, 0]), ("2020-07-19", [5, 0]))
    assert [(r.peak_date, r.peak_value) for r in M.episode_peaks(panel_of({"a": x}), 5.0).collect()] == [(day("2020-04-10"), 7.0)]


def test_intervals(spark, panel_of):
    iv = spark.createDataFrame(
        [(1, "x", day("2019-12-01"), day("2020-01-15")), (2, "y", day("2020-01-10"), day("2021-06-30")), (3, "z", day("2030-01-01"), day("2031-01-01"))],
        "priority int, name string, start date, end date",
    )
    events = spark.createDataFrame([(day(d),) for d in ("2019-11-30", "2020-01-15", "2021-01-01", "2020-01-15")], "peak_date date")
    got = sorted((str(r.peak_date), r.interval_name) for r in M.interval_label(events, iv).collect())
    assert got == [("2019-11-30", None), ("2020-01-15", "x"), ("2020-01-15", "x"), ("2021-01-01", "y")]
    p = panel_of({"a": s([1, 1], ["2020-01-12", "2021-03-01"]), "b": s([1], ["2025-01-01"])})
    clipped = sorted((r.series_id, r.name, str(r.start_date), str(r.end_date)) for r in M.interval_clip(p, iv).collect())
    assert clipped == [("a", "x", "2020-01-12", "2020-01-15"), ("a", "y", "2020-01-12", "2021-03-01")]


def test_extremes_restart_after_60_days(panel_of):
    x = s([100, 120, 100, 100], ["2020-01-01", "2020-02-29", "2020-04-29", "2020-05-01"])
    got = [(str(r.date), r.stack_level) for r in M.extremes(panel_of({"a": x}), 100.0).orderBy("date").collect()]
    assert got == [("2020-01-01", 0), ("2020-02-29", 1), ("2020-04-29", 0), ("2020-05-01", 1)]


def test_scorecard_dates_blanks_and_lights(spark, panel_of):
    p = panel_of({"v": s([1, 3, None], ["2020-01-01", "2020-01-05", "2020-01-06"]), "under": s([1], ["2020-01-03"])})
    spec = spark.createDataFrame(
        [("1", "own", "v", None, 1.0, "high", 3.0), ("1", "other", "v", "under", 0.5, "high", 3.0), ("1", "gone", "v", "nothing", 1.0, "none", None), ("2", "blank", "zzz", "under", 1.0, "high", 1.0)],
        "card string, label string, series_id string, as_of_series string, scale double, rule string, threshold double",
    )
    got = {r.label: (str(r.as_of) if r.as_of else None, r.value, r.light) for r in M.scorecard(p, spec).collect()}
    assert got == {
        "own": ("2020-01-05", 3.0, "r"),
        "other": ("2020-01-03", 1.5, "g"),
        "gone": ("2020-01-05", 3.0, ""),
        "blank": (None, None, ""),
    }


def test_composite_gap_rules(spark, panel_of):
    x = s([10, 20, 30], ["2020-01-01", "2020-01-02", "2020-01-05"])
    y = s([1, 2], ["2020-01-02", "2020-01-03"])
    p, xy = panel_of({"x": x, "y": y}), legs(spark, ("c", "x", "x"), ("c", "y", "y"))

    def days(df):
        return {d.day: v for (_, d), v in collect(df, "value", "composite_id").items()}

    assert days(K.spread_bps(p, xy)) == {2: 1900.0}
    assert days(K.spread(p, xy)) == {1: None, 2: 19.0, 3: None, 5: None}
    assert days(K.ratio_scaled(p, xy, 1.0)) == {2: 20.0, 3: 10.0, 5: 15.0}
    assert days(K.three_term_balance(p, legs(spark, ("c", "a", "x"), ("c", "b", "y"), ("c", "d", "x")))) == {2: 1.0, 3: 2.0, 5: 2.0}
    net = K.net_of_two(panel_of({"x": x * 1000, "y": y * 1000}), legs(spark, ("c", "a", "x"), ("c", "b", "y"), ("c", "c", "y")))
    assert days(net)[3] == 20.0 - 2.0 - 2000.0


def test_unfinished_month_gives_no_monthly_z(spark, panel_of):
    months = pd.date_range("2015-01-31", periods=70, freq="ME")
    daily = walk(70 * 31, start="2015-01-01", freq="D")
    monthly = pd.Series(walk(70, 9).values, index=months).iloc[:-2]
    p = panel_of({"x": daily, "y": monthly})
    got = K.ratio_with_monthly_z(p, legs(spark, ("c", "x", "x"), ("c", "y", "y"))).orderBy("date").collect()
    z = {r.date: r.z for r in got}
    ratio = (daily.resample("ME").last() / monthly).dropna() * 1000
    want = (ratio.iloc[-1] - ratio.iloc[-60:].mean()) / ratio.iloc[-60:].std()
    last = ratio.index[-1].date()
    assert abs(z[last] - want) < 1e-9
    # From the first month end without y on the z is blank, the ratio line goes on.
    assert z[months[-2].date()] is None and got[-1].ratio is not None


def test_excess_growth_uses_the_calendar(spark, panel_of):
    months = pd.date_range("2020-01-31", periods=30, freq="ME")
    x, y = (pd.Series(walk(30, k).values + 100, index=months) for k in (1, 2))
    gap = x.drop(months[5])
    got = K.ratio_excess_growth(panel_of({"x": gap, "y": y}), legs(spark, ("c", "x", "x"), ("c", "y", "y")))
    g = {r.date: r.excess_growth for r in got.collect()}
    assert months[5].date() not in g and g[months[17].date()] is None
    want = (x.iloc[20] / x.iloc[8] - y.iloc[20] / y.iloc[8]) * 100
    assert abs(g[months[20].date()] - want) < 1e-9


def test_default_pages_and_scorecard_name_existing_series(panel_of, registry_of):
    from tidemark.sources.registry import INDICATORS

    base = {row[0] for row in INDICATORS} | {"FINRA_FC_CASH", "FINRA_FC_MARGIN"}
    made = (
        {"repo_spread", "quality_spread", "net_liquidity", "net_liquidity_yoy", "real_m2_yoy", "margin_m2", "margin_m2_z"}
        | {"margin_excess_growth", "net_credit_bn", "sp500_m2", "sp500_m2_z"}
        | {*B.EXPANDING_Z.values(), *B.ROLLING_Z.values(), *B.CALENDAR_YOY.values()}
        | {n + x for _, n, _ in B.NOTIONALS for x in ("", "_diff", "_diff_z")}
    )
    for series, anchors, _, _ in B.PAGES.values():
        assert set(series) | set(anchors) <= base | made
    for _, _, sid, dated_by, *_ in B.SCORECARD:
        assert {sid, dated_by or sid} <= base | made
    assert {c for c, *_ in B.SCORECARD} == set(range(1, 9))
