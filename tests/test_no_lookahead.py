"""Nothing known later may change what was computed earlier."""

import datetime as dt

import pandas as pd
import pytest
from conftest import as_dict, assert_same, collect, corrupt_after, day, differing_rows, walk
from pyspark.sql import functions as F

from tidemark.operators import calendar as C
from tidemark.operators import composites as K
from tidemark.operators import pit as P
from tidemark.operators import transforms as X
from tidemark.plans.features import apply_transforms

PAST_ONLY = {
    "rolling z": (250, lambda p: X.rolling_zscore(p, 60), "B"),
    "rolling z, lag 1": (250, lambda p: X.rolling_zscore(p, 60, lag=1), "B"),
    "rolling z, plain frame": (250, lambda p: X.rolling_zscore(p, 30), "B"),
    "expanding z": (300, lambda p: X.expanding_zscore(p, 30), "B"),
    "expanding z, lag 1": (300, lambda p: X.expanding_zscore(p, 30, lag=1), "B"),
    "yoy": (40, lambda p: X.yoy(p, 12), "MS"),
    "calendar yoy": (40, lambda p: X.yoy_calendar(p), "MS"),
    "one-month change": (200, lambda p: X.pct_change_rows(p, 21), "B"),
    "difference in bps": (100, lambda p: X.diff_bps(p), "B"),
    "z of differences": (300, lambda p: X.zscore_of_diff(p, 60), "B"),
}


@pytest.mark.parametrize("name", PAST_ONLY)
def test_future_values_do_not_matter(name, panel_of):
    row, transform, freq = PAST_ONLY[name]
    s = walk(60 if freq == "MS" else 500, freq=freq)
    cut = s.index[row].date()
    a, b = (transform(panel_of({"a": x})) for x in (s, corrupt_after(s, row)))
    assert differing_rows(a, b, cut) == 0
    # The corruption is real: it shows after the cut.
    assert differing_rows(a, b, s.index[-1].date()) > 0


def test_lag_changes_the_result(panel_of):
    p = panel_of({"a": walk()})
    now, strict = (collect(X.rolling_zscore(p, 60, lag=k), "z") for k in (0, 1))
    both = [k for k in now if now[k] is not None and strict[k] is not None]
    assert max(abs(now[k] - strict[k]) for k in both) > 0.01


def test_lag_one_uses_the_window_before(panel_of):
    s = walk()
    got = collect(X.rolling_zscore(panel_of({"a": s}), 60, lag=1), "z")
    for t in (60, 100, 250, 499):
        past = s.iloc[t - 60 : t]
        want = (s.iloc[t] - past.mean()) / past.std()
        assert abs(got[("a", s.index[t].date())] - want) < 1e-9


def test_publication_lag_moves_dates_not_values(panel_of, registry_of):
    s = walk(20)
    got = P.publication_lag(panel_of({"a": s}), registry_of({"a": {"lag": 14}})).collect()
    assert {(r.date, r.value) for r in got} == {(d.date() + dt.timedelta(14), v) for d, v in s.items()}
    assert {(r.obs_date, r.value) for r in got} == {(d.date(), v) for d, v in s.items()}


def test_publication_lag_zero_is_identity(panel_of, registry_of):
    s = walk(20)
    got = collect(P.publication_lag(panel_of({"a": s}), registry_of({"a": {"lag": 0}})), "value")
    assert_same(got, as_dict(s))


def test_value_is_hidden_until_published(panel_of, registry_of):
    ramp = pd.Series(range(12), index=pd.date_range("2024-01-01", periods=12, freq="MS"), dtype=float)
    got = collect(P.pit_align(panel_of({"a": ramp}), registry_of({"a": {"lag": 14}})), "value")
    # March is published on the 15th; on the 11th (a Monday) February is the news.
    assert got[("a", day("2024-03-11"))] == 1.0
    assert got[("a", day("2024-03-20"))] == 2.0
    assert ("a", day("2024-03-10")) not in got  # Sunday


def test_aligned_panel_knows_nothing_later(panel_of, registry_of):
    """What a day shows does not change when later values do; the grid may not end earlier for it."""
    s = walk(300)
    reg = registry_of({"a": {"lag": 3}})
    a, b = (P.pit_align(panel_of({"a": x}), reg) for x in (s, corrupt_after(s, 150)))
    assert differing_rows(a, b, s.index[150].date() + dt.timedelta(3)) == 0


def test_revisions_do_not_reach_the_past(vintages_of, spark):
    base = [
        ("a", "2024-02-10", "2024-01-01", 1.0),
        ("a", "2024-03-12", "2024-02-01", 2.0),
        ("a", "2024-04-11", "2024-03-01", 3.0),
    ]
    revised = base + [("a", "2024-05-01", "2024-01-01", 99.0), ("a", "2024-05-01", "2024-04-01", 98.0)]
    grid = spark.sql("SELECT explode(sequence(DATE'2024-02-01', DATE'2024-06-28')) AS date")
    a, b = (P.vintage_levels(vintages_of(rows), grid) for rows in (base, revised))
    assert differing_rows(a, b, day("2024-04-30")) == 0
    assert collect(b, "value")[("a", day("2024-05-31"))] == 98.0


def test_features_know_nothing_later(panel_of, registry_of):
    transforms = [
        "zscore_rolling_1y", "zscore_expanding", "diff", "yoy", "pct_change_1m", "diff_bps", "level"
    ]
    reg = registry_of(
        {sid: {"frequency": f, "lag": 1, "transforms": transforms} for sid, f in (("d", "D"), ("w", "W"), ("m", "M"))}
    )
    s = walk(700)
    a, b = (
        apply_transforms(P.pit_align(panel_of({k: x for k in "dwm"}), reg).drop("obs_date"), reg, "fm", check_frequency=False)
        for x in (s, corrupt_after(s, 500))
    )
    assert differing_rows(a, b, s.index[500].date() + dt.timedelta(1)) == 0


def test_composites_know_nothing_later(panel_of, spark):
    legs = spark.createDataFrame([("c", "x", "a"), ("c", "y", "b")], "composite_id string, role string, series_id string")
    s, other = walk(1500), walk(1500, seed=7)
    results = []
    for x in (s, corrupt_after(s, 1399)):
        p = panel_of({"a": x, "b": other})
        results.append(K.ratio_with_monthly_z(p, legs, window=24))
    assert differing_rows(*results, s.index[1399].date()) == 0


def test_month_start_labels_leak(panel_of):
    """The check of the check: a month stamped at its start shows values of its end."""
    s = walk(300)
    row = 205  # in the middle of a month
    start, end = (
        [C.ffill_on_grid(C.resample_last(panel_of({"a": x}), rule), panel_of({"a": s}).select("date")) for x in (s, corrupt_after(s, row))]
        for rule in ("MS", "ME")
    )
    cut = s.index[row].date()
    assert differing_rows(*start, cut) > 0
    assert differing_rows(*end, cut) == 0


def test_features_refuse_month_start_labels(panel_of, registry_of):
    with pytest.raises(ValueError, match="month rule"):
        apply_transforms(panel_of({"a": walk(20)}), registry_of({"a": {}}), "fm", month_rule="MS")


def test_lag_of_windows_only(panel_of, registry_of):
    """The lag of the dispatch moves z windows and leaves changes alone."""
    reg = registry_of({"a": {"transforms": ["zscore_expanding", "diff_bps"]}})
    p = panel_of({"a": walk(400)})
    now, strict = (apply_transforms(p, reg, "mon", lag=k) for k in (0, 1))
    same = F.col("transform") == "diff_bps"
    assert differing_rows(now.where(same), strict.where(same), day("2030-01-01")) == 0
    assert differing_rows(now.where(~same), strict.where(~same), day("2030-01-01")) > 0
