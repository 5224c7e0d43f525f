import numpy as np
import pandas as pd
import pytest
from conftest import as_dict, assert_same, collect, day, walk
from pyspark.sql import functions as F

from tidemark.operators import calendar as C
from tidemark.operators import transforms as X
from tidemark.operators import windows as W
from tidemark.plans.features import apply_transforms


def holed(n=400, seed=1, share=0.3):
    s = walk(n, seed)
    s[np.random.default_rng(seed).random(n) < share] = np.nan
    return s


def direct_z(s, window, lag, need):
    """Each window taken by itself; pandas' own rolling sums lose digits where the spread is small."""
    out = pd.Series(np.nan, index=s.index)
    for t in range(len(s)):
        w = s.iloc[max(0, t - lag - window + 1) : max(0, t - lag + 1)].dropna()
        if len(w) >= max(need, 2) and w.std() > 0:
            out.iloc[t] = (s.iloc[t] - w.mean()) / w.std()
    return out


@pytest.mark.parametrize("window, lag", [(5, 1), (30, 0), (49, 1), (60, 0), (60, 3), (252, 1), (1000, 0)])
def test_rolling_z_against_each_window(window, lag, panel_of):
    s = holed()
    got = collect(X.rolling_zscore(panel_of({"a": s}), window, lag=lag), "z")
    assert_same(got, as_dict(direct_z(s, window, lag, window // 2)), 1e-9)


def test_rolling_window_from_a_column(panel_of):
    a, b = holed(seed=1), holed(seed=2)
    p = panel_of({"a": a, "b": b}).withColumn("w", F.when(F.col("series_id") == "a", 60).otherwise(7))
    got = collect(X.rolling_zscore(p, "w", lag=1), "z")
    want = {}
    for sid, s, w in (("a", a, 60), ("b", b, 7)):
        want |= as_dict(direct_z(s, w, 1, w // 2), sid)
    assert_same(got, want)


def test_constant_window_has_no_z(panel_of):
    """0.1 has no exact mean in floating point; the spread must still be exactly zero."""
    s = pd.Series(0.1, index=pd.date_range("2020-01-01", periods=300))
    s.iloc[:20] = 1e9
    got = [v for (_, d), v in collect(X.rolling_zscore(panel_of({"a": s}), 60), "z").items() if d > day("2020-03-25")]
    assert got and all(v is None for v in got)


def test_block_form_keeps_precision_after_a_jump(panel_of):
    """Early huge values leave no trace in later windows, unlike with differences of prefix sums."""
    s = walk(400) / 1000
    s.iloc[:50] = 1e12
    got = collect(X.rolling_zscore(panel_of({"a": s}), 60), "z")
    for t in (150, 300, 399):
        w = s.iloc[t - 59 : t + 1]
        assert abs(got[("a", s.index[t].date())] - (s.iloc[t] - w.mean()) / w.std()) < 1e-9


@pytest.mark.parametrize("lag", [0, 1])
def test_expanding_z_matches_pandas(lag, panel_of):
    s = holed()
    base = s.shift(lag).expanding(min_periods=60)
    assert_same(
        collect(X.expanding_zscore(panel_of({"a": s}), lag=lag), "z"), as_dict((s - base.mean()) / base.std())
    )


def test_min_periods_counts_values_not_rows(panel_of):
    s = pd.Series([1.0, None, 2.0, None, 4.0, 8.0], index=pd.date_range("2020-01-01", periods=6))
    got = collect(X.rolling_zscore(panel_of({"a": s}), 4, min_periods=3), "z")
    assert [k[1].day for k, v in sorted(got.items()) if v is not None] == [6]


def test_zero_base_is_missing(panel_of):
    s = pd.Series([0.0, 5.0, 10.0], index=pd.date_range("2020-01-01", periods=3))
    got = collect(X.yoy(panel_of({"a": s}), 1), "yoy")
    assert [v for _, v in sorted(got.items())] == [None, None, 100.0]


def test_missing_month_row_versus_calendar(panel_of):
    months = pd.date_range("2020-01-01", periods=26, freq="MS").delete(13)  # February 2021 is missing
    s = pd.Series(np.arange(25.0) + 100, index=months)
    p = panel_of({"a": s})
    rows, calendar = collect(X.yoy(p, 12), "yoy"), collect(X.yoy_calendar(p), "yoy")
    march = ("a", day("2021-03-01"))
    assert abs(rows[march] - (s["2021-03-01"] / s["2020-02-01"] - 1) * 100) < 1e-9  # 13 months back
    assert abs(calendar[march] - (s["2021-03-01"] / s["2020-03-01"] - 1) * 100) < 1e-9
    assert calendar[("a", day("2022-02-01"))] is None


def test_density_anchor(panel_of, registry_of):
    """A monthly index rising 4 % in a year shows 4 % however densely it is stored."""
    months = pd.date_range("2020-01-01", periods=13, freq="MS")
    monthly = pd.Series(np.linspace(300, 312, 13), index=months)
    dense = monthly.reindex(pd.date_range("2020-01-01", "2021-01-31", freq="B"), method="ffill").combine_first(monthly)
    reg = registry_of({"m": {"frequency": "M", "transforms": ["yoy"]}, "d": {"frequency": "M", "transforms": ["yoy"]}})
    # Another series carries the calendar past the last month end.
    tail = pd.Series([1.0], index=[pd.Timestamp("2021-02-01")])
    p = panel_of({"m": monthly, "d": dense, "x": tail})
    got = apply_transforms(p, reg, "mon").where("transform = 'yoy' AND date = DATE'2021-02-01'").collect()
    assert sorted((r.series_id, round(r.value, 9)) for r in got) == [("d", 4.0), ("m", 4.0)]


def test_frequency_check(panel_of, registry_of):
    weekly = pd.Series(1.0, index=pd.date_range("2020-01-01", periods=30, freq="7D"))
    spec = {"ok": {"frequency": "W"}, "bad": {"frequency": "D"}, "short": {"frequency": "D"}}
    got = X.frequency_check(
        panel_of({"ok": weekly, "bad": weekly, "short": weekly.iloc[:2]}), registry_of(spec)
    ).collect()
    assert {r.series_id: r.ok for r in got} == {"ok": True, "bad": False, "short": True}


def test_dispatch_refuses_a_misdeclared_series(panel_of, registry_of):
    weekly = walk(60, freq="7D")
    for frequency, fits in (("W", True), ("D", False), ("M", False)):
        reg = registry_of({"a": {"frequency": frequency, "transforms": ["zscore_rolling_1y"]}})
        out = apply_transforms(panel_of({"a": weekly}), reg, "mon")
        if fits:
            assert out.count() > 0
        else:
            with pytest.raises(Exception, match="is declared"):
                out.collect()
        assert apply_transforms(panel_of({"a": weekly}), reg, "mon", check_frequency=False).count() > 0
    reg = registry_of({"a": {"frequency": "D", "transforms": ["zscore_rolling_1y"]}, "b": {"frequency": "D", "transforms": ["diff"]}})
    assert apply_transforms(panel_of({"a": weekly.iloc[:2], "b": weekly}), reg, "mon").count() > 0


def test_window_rows(spark):
    assert [X.resolve_window(f, 1) for f in "DWMQ"] == [252, 52, 12, 4]
    assert X.resolve_window("M", 5) == 60
    with pytest.raises(ValueError):
        X.resolve_window("H", 1)


def test_rolling_moments_reject_nonsense(panel_of):
    with pytest.raises(ValueError):
        W.rolling_moments(panel_of({"a": walk(5)}), 0)
    with pytest.raises(ValueError):
        W.rolling_moments(panel_of({"a": walk(5)}), 5, lag=-1)


def test_dispatch_against_pandas(panel_of, registry_of):
    """Every transform of the dispatch on a sparse panel, against pandas on the wide table."""
    daily = holed(700, share=0.1)
    weekly = walk(140, 3, freq="W-WED")
    frame = pd.DataFrame({"d": daily, "w": weekly})
    reg = registry_of(
        {
            "d": {"frequency": "D", "transforms": ["zscore_rolling_1y", "pct_change_1m", "diff_bps", "diff"]},
            "w": {"frequency": "W", "transforms": ["zscore_expanding", "zscore_rolling_1y", "yoy", "diff", "level"]},
        }
    )
    got = apply_transforms(panel_of({c: frame[c].dropna() for c in frame}), reg, "mon")
    index = frame.dropna(how="all").index

    def z(s, roll):
        return (s - roll.mean()) / roll.std()

    native = frame["w"].dropna().resample("W").last().dropna()
    d = frame["d"].dropna()
    padded = frame.loc[index, "d"].ffill()
    want = {
        ("d", "zscore"): z(d, d.rolling(252, min_periods=126)).reindex(index, method="ffill"),
        ("d", "diff"): d.diff().reindex(index, method="ffill"),
        ("d", "pct1m"): padded.pct_change(21, fill_method=None) * 100,
        ("d", "diff_bps"): frame.loc[index, "d"].diff() * 100,
        ("w", "zscore"): z(native, native.rolling(52, min_periods=26)).reindex(index, method="ffill"),
        ("w", "zscore_exp"): z(native, native.expanding(52)).reindex(index, method="ffill"),
        ("w", "yoy"): (native.pct_change(52, fill_method=None) * 100).reindex(index, method="ffill"),
        ("w", "diff"): native.diff().reindex(index, method="ffill"),
        ("w", "level"): frame.loc[index, "w"],
        ("d", "level"): frame.loc[index, "d"],
    }
    for (sid, tf), s in want.items():
        mine = collect(got.where((F.col("series_id") == sid) & (F.col("transform") == tf) & F.col("value").isNotNull()), "value")
        assert_same(mine, as_dict(s.dropna(), sid), 1e-9)


def test_dispatch_rejects_unknown_names(panel_of, registry_of):
    p = panel_of({"a": walk(5)})
    with pytest.raises(ValueError, match="mode"):
        apply_transforms(p, registry_of({"a": {}}), "other")
    with pytest.raises(Exception, match="unknown transform"):
        apply_transforms(p, registry_of({"a": {"transforms": ["zscore_2y"]}}), "mon").collect()


def test_year_over_year_does_not_hang_on_density(panel_of, registry_of):
    """An index going from 300 to 312 in a year: 4.00 % on monthly rows and on the same values held over days.

    Counting 12 rows of the held form would give 0.00 %, and 252 rows, which are
    11.6 months, 3.65 % (published anchors).
    """
    months = pd.date_range("2020-01-01", periods=25, freq="MS")
    monthly = pd.Series(300 * 1.04 ** (np.arange(25) / 12), index=months)
    held = monthly.reindex(pd.bdate_range("2020-01-01", "2022-01-31"), method="ffill")
    reg = registry_of({"m": {"frequency": "M"}})
    last = lambda df: df.orderBy(F.desc("date")).first().yoy
    assert last(X.yoy(panel_of({"m": monthly}), 12)) == pytest.approx(4.0)
    assert last(X.yoy(C.to_native(panel_of({"m": held}), reg), 12)) == pytest.approx(4.0)
    dense = panel_of({"m": held})
    assert last(X.yoy(dense, 12)) == pytest.approx(0.0)
    assert last(X.yoy(dense, 252)) == pytest.approx(3.65, abs=0.02)
