import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from conftest import collect, day, walk
from pyspark.sql import functions as F

from tidemark.operators import quality, runs, watch
from tidemark.operators import stats as T
from tidemark.operators.pit import pit_panel, pit_runs
from tidemark.plans import pipeline
from tidemark.plans import warehouse as W
from tidemark.session import scratch_path
from tidemark.sources import store as S
from tidemark.streaming.merge import compact, merge_stream, read_merged
from tidemark.streaming.resample import late_rows, resample_stream


def ols_t(y, p):
    """t-statistic of the level in the test regression with p lagged differences, by normal equations."""
    dy = np.diff(y)
    rows = range(p, len(dy))
    x = np.array([[y[t], 1.0] + [dy[t - j] for j in range(1, p + 1)] for t in rows])
    target = dy[p:]
    inv = np.linalg.inv(x.T @ x)
    beta = inv @ x.T @ target
    resid = target - x @ beta
    s2 = resid @ resid / (len(target) - x.shape[1])
    return beta[0] / math.sqrt(s2 * inv[0, 0])


def ar1(n, phi, seed):
    e = np.random.default_rng(seed).normal(size=n)
    out = np.zeros(n)
    for t in range(1, n):
        out[t] = phi * out[t - 1] + e[t]
    return pd.Series(out, index=pd.date_range("2020-01-01", periods=n))


def test_df_tstat(panel_of):
    a = ar1(200, 0.8, 1)
    got = T.df_tstat(panel_of({"a": a})).collect()[0]
    assert got.n == 199 and abs(got.t_stat - ols_t(a.to_numpy(), 0)) < 1e-9


def test_adf_screen(panel_of):
    series = {"noise": ar1(300, 0.2, 1), "walk": ar1(300, 1.0, 2), "short": ar1(59, 0.5, 3), "flat": ar1(100, 0, 4) * 0}
    got = {r.series_id: r for r in T.recommend_window(T.adf_screen(panel_of(series))).collect()}
    for sid in ("noise", "walk"):
        y = series[sid].to_numpy()
        top = math.ceil(12 * (len(y) / 100) ** 0.25)
        # Brute force over the lag: all candidates on the sample of the longest.
        dy = np.diff(y)
        aic = []
        for p in range(top + 1):
            x = np.array([[y[t], 1.0] + [dy[t - j] for j in range(1, p + 1)] for t in range(top, len(dy))])
            beta = np.linalg.lstsq(x, dy[top:], rcond=None)[0]
            rss = ((dy[top:] - x @ beta) ** 2).sum()
            aic.append(len(x) * math.log(rss / len(x)) + 2 * (p + 2))
        best = int(np.argmin(aic))
        assert got[sid].used_lag == best and abs(got[sid].adf_stat - ols_t(y, best)) < 1e-8
    assert got["noise"].verdict == "stationary" and got["noise"].recommendation == "expanding"
    assert got["walk"].verdict == "non-stationary" and got["walk"].recommendation == "rolling(252d)"
    assert got["short"].verdict == "SKIP: n<60" and got["short"].recommendation == ""
    assert got["flat"].adf_stat is None


def test_p_value_scale(panel_of):
    """Known pairs of statistic and p-value of this test: -3.251 is 0.0172, -2.48 is 0.1205."""
    coef = [2.1659, 1.4412, 0.038269]
    for stat, p in ((-3.251, 0.0172), (-2.48, 0.1205)):
        score = sum(c * stat**i for i, c in enumerate(coef))
        assert abs(0.5 * math.erfc(-score / math.sqrt(2)) - p) < 1e-4


def test_lag_sweep_and_revision(vintages_of, registry_of):
    rows = []
    for i, m in enumerate(pd.date_range("2023-01-01", periods=10, freq="MS")):
        first = m + pd.Timedelta(days=40 + i)
        rows.append(("a", str(first.date()), str(m.date()), 1.0))
        rows.append(("a", str((first + pd.Timedelta(days=30)).date()), str(m.date()), 1.00001 if i < 4 else 2.0 if i < 8 else None))
    reg = registry_of({"a": {"frequency": "M", "lag": 14}, "none": {"frequency": "M"}})
    got = {r.series_id: r for r in T.lag_sweep(vintages_of(rows), reg).collect()}
    assert (got["a"].n, got["a"].median_lag, got["a"].p90_lag, got["a"].gap_vs_config) == (10, 44, 48, 30)
    assert got["a"].revised_pct == 50.0 and got["none"].status == "NO-VINTAGE"
    late = {r.series_id: r.status for r in T.lag_sweep(vintages_of(rows), reg, since="2024-01-01").collect()}
    assert late["a"] == "NO-RECENT-PERIOD"
    assert T.revision_rate(vintages_of(rows)).collect()[0].revised_share == 0.5


def test_fact_stamps_the_publication_behind_a_value(spark, panel_of, vintages_of, registry_of):
    reg = registry_of({"f": {"lag": 2, "category": "rates"}, "v": {"is_vintage": True, "category": "macro"}})
    raw = panel_of({"f": pd.Series([1.0, 2.0], index=pd.to_datetime(["2024-01-02", "2024-01-08"]))})
    v = vintages_of([("v", "2024-01-05", "2023-12-01", 5.0)])
    features = panel_of(
        {k: pd.Series(1.0, index=pd.date_range("2024-01-03", "2024-01-11")) for k in ("f", "v")}
    ).select("series_id", F.lit("level").alias("transform"), "date", "value")
    got = W.fact_table(features, W.publications(raw, v, reg), reg, "2024-02-01")
    stamps = {(r.series_id, r.date.day): r.release_date.day for r in got.collect()}
    assert stamps == {("f", d): 4 for d in range(4, 10)} | {("f", d): 10 for d in (10, 11)} | {("v", d): 5 for d in range(5, 12)}
    assert {r.block: r.n_series for r in W.series_by_block(got).collect()} == {"rates": 1, "macro": 1}
    assert {(r.source, r.fetched_at) for r in got.collect()} == {("FRED", "2024-02-01")}


def test_a_series_with_lag_25_reports_25(panel_of, vintages_of, registry_of):
    reg = registry_of({"m": {"lag": 25, "frequency": "M"}, "b": {"lag": 0}})
    raw = panel_of({"m": walk(24, freq="MS"), "b": walk(600)})
    pit = pit_panel(raw, None, reg)
    features = pit.select("series_id", F.lit("level").alias("transform"), "date", "value")
    fact = W.fact_table(features, W.publications(raw, vintages_of([]), reg), reg, "2024-02-01")
    got = {r.series_id: (r.avg_lag_days, r.min_lag_days, r.max_lag_days) for r in W.lag_distribution(fact).collect()}
    assert got == {"m": (25.0, 25, 25), "b": (0.0, 0, 0)}
    compared = W.lag_vs_config(fact, W.dim_indicators(reg)).collect()
    assert {r.series_id: (r.std_config_lag, r.empirical_lag) for r in compared} == {"m": (25, 25.0), "b": (0, 0.0)}


def test_preview_equals_the_pairs_it_avoids(spark):
    rng = np.random.default_rng(1)
    fact = spark.createDataFrame(
        [("s", day("2020-01-01") + dt.timedelta(i), "zscore", float(i), day("2020-01-01") + dt.timedelta(i + int(rng.integers(0, 9))), "b") for i in range(200)],
        "series_id string, date date, transform string, value double, release_date date, block string",
    )
    months = [f"2020-{m:02d}" for m in range(1, 9)] + ["2019-11"]
    returns = spark.createDataFrame([(m, "u", 0.1 * i) for i, m in enumerate(months)], "year_month string, universe_label string, monthly_return double")
    for n in (3, 10, 40, 5000):
        got = [(r.year_month, r.rhs_value, r.rhs_release_date) for r in W.preview_returns(returns, fact, "s", "zscore", "u", n).collect()]
        pairs = []
        rows = fact.collect()
        for m in months:
            hits = [(m, r.value, r.release_date, r.date) for r in rows if str(r.release_date) <= m + "-01"]
            pairs += hits or [(m, None, None, None)]
        pairs.sort(key=lambda t: (t[0], t[2] or dt.date.min, t[3] or dt.date.min), reverse=True)
        assert got == [t[:3] for t in pairs[:n]]


def test_pipeline_end_to_end(spark, panel_of, vintages_of, registry_of):
    reg = registry_of(
        {
            "d": {"lag": 1, "transforms": ["diff_bps", "zscore_expanding"]},
            "p": {"frequency": "W", "lag": 3, "transforms": ["diff"]},
            "m": {"frequency": "M", "is_vintage": True, "fm": ["yoy"], "mon": []},
        }
    )
    daily, weekly = walk(600), walk(100, 5, freq="W-TUE")
    months = pd.date_range("2020-01-01", periods=26, freq="MS")
    v = vintages_of([("m", str((m + pd.Timedelta(days=45)).date()), str(m.date()), 100.0 + i) for i, m in enumerate(months)])
    floors = spark.createDataFrame([("d", day("2020-02-01"), 300)], "series_id string, first_by date, min_n int")
    out = scratch_path(spark, "pipeline")
    paths = pipeline.run(spark, panel_of({"d": daily}), reg, out, v, [panel_of({"p": weekly})], floors, buckets=4)
    raw = S.read_panel(spark, paths["raw"], buckets=4)
    assert raw.where("series_id = 'p'").count() == 100
    features = spark.read.parquet(paths["features"])
    names = {(r.series_id, r.transform) for r in features.select("series_id", "transform").distinct().collect()}
    assert names == {("d", "level"), ("d", "diff_bps"), ("d", "zscore_exp"), ("p", "level"), ("p", "diff"), ("m", "level"), ("m", "yoy")}
    assert features.groupBy("series_id", "transform", "date").count().where("count > 1").isEmpty()
    counted = {r.stage: r for r in spark.read.parquet(paths["metrics"]).collect()}
    assert list(counted) and set(counted) == {"raw", "monitoring", "runs", "pit", "features"}
    for stage in ("raw", "monitoring", "pit", "features"):
        table = spark.read.parquet(paths[stage])
        want = table.agg(F.count(F.lit(1)), F.count("value"), F.min("date"), F.max("date")).first()
        assert tuple(counted[stage])[1:] == tuple(want), stage
    # The same job over bucketed tables gives the same features.
    again = pipeline.run(
        spark, panel_of({"d": daily}), reg, scratch_path(spark, "pipeline"), v, [panel_of({"p": weekly})], floors, 4, tables="job"
    )
    assert spark.read.parquet(again["metrics"]).exceptAll(spark.read.parquet(paths["metrics"])).isEmpty()
    other = spark.read.parquet(again["features"]).select(*features.columns)
    assert features.exceptAll(other).isEmpty() and other.exceptAll(features).isEmpty()
    monitoring = spark.read.parquet(paths["monitoring"])
    assert "m" not in {r.series_id for r in monitoring.select("series_id").distinct().collect()}


def test_pipeline_stops_before_writing_on_short_history(spark, panel_of, registry_of):
    floors = spark.createDataFrame([("d", day("2000-01-01"), 1)], "series_id string, first_by date, min_n int")
    out = scratch_path(spark, "pipeline")
    with pytest.raises(ValueError, match="too short"):
        pipeline.run(spark, panel_of({"d": walk(50)}), registry_of({"d": {"lag": 1}}), out, floors=floors, buckets=4)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{out}/pit")


def test_floors_in_the_pass_say_what_the_guard_says(spark, panel_of, registry_of):
    """Series by series the pass fails exactly where ``coverage_violations`` has a row; missing bounds and unknown series say nothing."""
    series = {f"s{i}": walk(40 + 3 * i, i) for i in range(2)}
    held = pit_runs(panel_of(series), None, registry_of({s: {"lag": 1} for s in series}), end="2020-12-31")
    days = runs.coverage(held).orderBy("series_id").collect()
    kind = "series_id string, first_by date, min_n int"
    for r in days:
        before = r.first_valid - dt.timedelta(days=1)
        for floor in [(r.first_valid, r.n), (before, 1), (r.first_valid, r.n + 1), (None, None), (None, r.n + 1), (before, None)]:
            floors = spark.createDataFrame([(r.series_id, *floor), ("unknown", before, 10**6)], kind)
            want = quality.coverage_violations(runs.spread(held), floors).count()
            try:
                with watch.guarded():
                    assert watch.covered(held, floors).exceptAll(held).isEmpty()
                failed = 0
            except ValueError as e:
                assert str(e).startswith(f"protected history is too short: series {r.series_id} from {r.first_valid} with {r.n} days")
                failed = 1
            assert failed == want, (r, floor)


def test_a_watch_counts_an_empty_table(spark):
    seen = watch.Watch("none")
    S.write_panel(spark.createDataFrame([], "series_id string, date date, value double"), scratch_path(spark, "empty"), 4, watch=seen)
    assert seen.row() == ("none", 0, 0, None, None)


def test_guarded_leaves_other_errors_alone():
    with pytest.raises(KeyError), watch.guarded():
        raise KeyError("x")


def test_pipeline_stops_when_a_join_loses_values(spark, panel_of, registry_of):
    weekend = pd.Series([1.0], index=pd.to_datetime(["2020-01-04"]))
    with pytest.raises(ValueError, match="values lost"):
        pipeline.run(
            spark, panel_of({"d": walk(50)}), registry_of({"d": {"lag": 1}, "x": {"lag": 1}}), scratch_path(spark, "p"),
            extra=[panel_of({"x": weekend})], buckets=4,
        )


def test_stream_merge_folds_late_revisions(spark, tmp_path):
    src, log, cp = (str(tmp_path / n) for n in ("in", "log", "cp"))
    schema = "series_id string, date date, value double, ts timestamp"

    def land(rows):
        spark.createDataFrame([(s, day(d), v, dt.datetime.fromisoformat(t)) for s, d, v, t in rows], schema).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        merge_stream(spark, stream, log, cp).awaitTermination()

    land([("a", "2024-01-01", 1.0, "2024-01-02 09:00:00"), ("a", "2024-01-01", 1.5, "2024-01-02 10:00:00"), ("a", "2024-01-02", 2.0, "2024-01-03 09:00:00")])
    land([("a", "2024-01-01", None, "2024-01-05 09:00:00"), ("a", "2024-01-02", 2.5, "2024-01-05 09:00:00")])
    assert collect(read_merged(spark, log), "value") == {("a", day("2024-01-01")): 1.5, ("a", day("2024-01-02")): 2.5}
    # However late, a row is merged by its own time: it replaces older values and yields to newer ones.
    land([("a", "2024-01-09", 9.0, "2024-01-20 09:00:00"), ("b", "2023-06-01", 4.0, "2023-06-02 09:00:00")])
    land([("a", "2024-01-01", 7.0, "2024-01-02 12:00:00"), ("a", "2024-01-02", 0.5, "2024-01-02 12:00:00")])
    # One instant with and without a value.
    land([("c", "2024-01-03", None, "2024-01-04 09:00:00"), ("c", "2024-01-03", 7.0, "2024-01-04 09:00:00")])
    want = {
        ("a", day("2024-01-01")): 7.0,
        ("a", day("2024-01-02")): 2.5,
        ("a", day("2024-01-09")): 9.0,
        ("b", day("2023-06-01")): 4.0,
        ("c", day("2024-01-03")): 7.0,
    }
    assert collect(read_merged(spark, log), "value") == want
    base = str(tmp_path / "base")
    compact(spark, log, base)
    assert collect(read_merged(spark, base), "value") == want and collect(read_merged(spark, base, log), "value") == want


def test_stream_resample_emits_closed_days_only(spark, tmp_path):
    src = str(tmp_path / "in")
    rows = [(dt.datetime(2024, 1, 1, h), "k", float(h)) for h in (3, 9)] + [(dt.datetime(2024, 1, 4, 1), "k", 0.0)]
    spark.createDataFrame(rows, "ts timestamp, key string, value double").write.parquet(src)
    stream = spark.readStream.schema("ts timestamp, key string, value double").parquet(src)
    q = (
        resample_stream(stream, "key", "value").writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(str(tmp_path / "out"))
    )
    q.awaitTermination()
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [(day("2024-01-01"), "k", 9.0, 2)]
    assert late_rows(q) == 0


def test_late_rows_of_a_closed_window_are_counted(spark, tmp_path):
    src, schema = str(tmp_path / "in"), "ts timestamp, key string, value double"

    def land(*hours):
        rows = [(dt.datetime(2024, 1, d, h), "k", 1.0) for d, h in hours]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        q = (
            resample_stream(spark.readStream.schema(schema).parquet(src), "key", "value").writeStream.format("parquet")
            .outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True)
            .start(str(tmp_path / "out"))
        )
        q.awaitTermination()
        return late_rows(q)

    assert land((1, 3), (9, 1)) == 0
    assert land((1, 5), (1, 6), (9, 2)) > 0


# --- unit-root screen in aggregates ------------------------------------------------


def _walks(panel_of, n_series=6, n=150):
    rng = np.random.default_rng(12)
    days = pd.date_range("2010-01-01", periods=n, freq="D")
    series = {}
    for k in range(n_series):
        noise = rng.normal(size=n)
        keep = [1.0, 0.9, 0.5, 0.0, 1.0, 0.97][k % 6]
        level = 50.0 * k
        values = []
        for i, e in enumerate(noise):
            level = keep * level + e + (0.4 * noise[i - 1] if i else 0)
            values.append(level)
        series[f"w{k}"] = pd.Series(values, days)
    series["w1"].iloc[40:45] = None
    return panel_of(series)


def test_fixed_lag_equals_least_squares_at_the_chosen_lag(spark, panel_of):
    from tidemark.operators import stationarity as U

    panel = _walks(panel_of)
    searched = {r.series_id: r for r in T.adf_screen(panel).collect()}
    chosen = {r.series_id: r.p for r in U.choose_lags(panel).collect()}
    assert chosen == {s: r.used_lag for s, r in searched.items()}
    lags = spark.createDataFrame(list(chosen.items()), "series_id string, p int")
    for r in U.adf_fixed_lag(panel, lags).collect():
        assert r.n == searched[r.series_id].n and r.used_lag == chosen[r.series_id]
        assert abs(r.adf_stat - searched[r.series_id].adf_stat) < 1e-7
        assert abs(r.p_value - searched[r.series_id].p_value) < 1e-9


@pytest.mark.parametrize("lags", [0, 1, 5])
def test_fixed_lag_equals_numpy(panel_of, lags):
    from tidemark.operators import stationarity as U

    panel = _walks(panel_of)
    got = {r.series_id: r for r in U.adf_fixed_lag(panel, lags).collect()}
    for sid in got:
        y = np.array([r.value for r in panel.where(f"series_id = '{sid}' and value is not null").orderBy("date").collect()])
        d = np.diff(y)
        at = np.arange(lags, len(d))
        x = np.column_stack([y[at], np.ones(len(at)), *[d[at - j] for j in range(1, lags + 1)]])
        beta, *_ = np.linalg.lstsq(x, d[at], rcond=None)
        rest = d[at] - x @ beta
        error = np.sqrt(rest @ rest / (len(at) - lags - 2) * np.linalg.inv(x.T @ x)[0, 0])
        assert abs(got[sid].adf_stat - beta[0] / error) < 1e-7 and got[sid].obs == len(at)


def test_screen_skips_and_advises(spark, panel_of):
    from tidemark.operators import stationarity as U

    rng = np.random.default_rng(2)
    days = pd.date_range("2000-01-31", periods=90, freq="ME")
    panel = panel_of(
        {
            "noise": pd.Series(rng.normal(size=90), days),
            "walk": pd.Series(np.cumsum(rng.normal(size=90)), days),
            "short": pd.Series(rng.normal(size=20), days[:20]),
            "flat": pd.Series(np.ones(90), days),
        }
    )
    rows = [("A", "n", "level", "noise"), ("A", "w", "level", "walk"), ("A", "f", "level", "flat"), ("A", "x", "level", "nobody"), ("B", "s", "month_diff", "short"), ("B", "dw", "month_diff", "walk")]
    items = spark.createDataFrame(rows, "section string, label string, transform string, series_id string")
    report = {r.series: r for r in U.screen(U.screen_inputs(panel, items), items).collect()}
    assert {k: r.verdict for k, r in report.items()} == {
        "n": "stationary", "w": "non-stationary", "f": "SKIP: no variation", "x": "SKIP: no data", "s": "SKIP: n<48", "dw": "stationary",
    }
    assert report["n"].recommendation == "expanding" and report["w"].recommendation == "rolling(252d)"
    assert report["dw"].recommendation == "OK as FM factor" and report["s"].recommendation == ""
    assert (report["x"].n, report["s"].n, report["dw"].n) == (0, 19, 89) and report["s"].start is None


def test_normal_distribution_function(spark):
    import math

    from tidemark.functions.numeric import normal_cdf

    points = [-9.0, -6.0, -3.5, -1.0, -0.1, 0.0, 0.7, 2.5, 6.5, 8.0]
    df = spark.createDataFrame([(x,) for x in points], "x double").select("x", normal_cdf(F.col("x")).alias("p"))
    assert all(abs(r.p - 0.5 * math.erfc(-r.x / math.sqrt(2))) < 1e-12 for r in df.collect())


def test_pipeline_refuses_a_rolling_window_on_a_wrong_frequency_in_the_feature_list(spark, panel_of, vintages_of, registry_of):
    """The series is only in the feature list, once by its own dates and once by those of its vintages."""
    days = pd.date_range("2015-01-31", periods=60, freq="ME")
    monthly = panel_of({"m": pd.Series(range(60), days, dtype=float), "d": walk(50)})
    v = vintages_of([("v", str((d + pd.Timedelta(days=20)).date()), str(d.date()), float(i)) for i, d in enumerate(days)])

    def registry(frequency, sid):
        reg = registry_of({"m": {"lag": 1, "frequency": "M"}, "d": {"lag": 1, "frequency": "D"}, "v": {"vintage": True, "frequency": "M"}})
        rolling, none = F.array(F.lit("zscore_rolling_1y")), F.array().cast("array<string>")
        return reg.withColumns(
            {
                "frequency": F.when(F.col("series_id") == sid, frequency).otherwise(F.col("frequency")),
                "is_vintage": F.col("series_id") == "v",
                "mon_transforms": none,
                "fm_transforms": F.when(F.col("series_id") == sid, rolling).otherwise(none),
            }
        )

    for sid in ("m", "v"):
        pipeline.run(spark, monthly, registry("M", sid), scratch_path(spark, "p"), vintages=v, buckets=4)
        with pytest.raises(Exception, match="is declared D but its dates are"):
            pipeline.run(spark, monthly, registry("D", sid), scratch_path(spark, "p"), vintages=v, buckets=4)


def test_own_transforms_join_the_dispatch(spark, panel_of, registry_of):
    from tidemark.plans.features import OwnTransform, apply_transforms

    panel = panel_of({"a": walk(60), "b": walk(60, seed=2)})
    reg = registry_of({"a": {"lag": 1}, "b": {"lag": 1}}).withColumn(
        "mon_transforms", F.when(F.col("series_id") == "a", F.array(F.lit("doubled"), F.lit("step"), F.lit("diff"))).otherwise(F.array(F.lit("diff")))
    )
    own = {
        "doubled": OwnTransform("twice", lambda v, series: v * 2),
        "step": OwnTransform("step", lambda v, series: v - F.lag(v, 5).over(series), counts="rows"),
    }
    got = {(r.series_id, r.transform): r.n for r in apply_transforms(panel, reg, "mon", own=own).where("value is not null").groupBy("series_id", "transform").agg(F.count("*").alias("n")).collect()}
    assert got == {("a", "level"): 60, ("a", "twice"): 60, ("a", "step"): 55, ("a", "diff"): 59, ("b", "level"): 60, ("b", "diff"): 59}
    with pytest.raises(Exception, match="unknown transform for a: doubled"):
        apply_transforms(panel, reg, "mon", own={"step": own["step"]}).count()
    with pytest.raises(ValueError, match="must be new"):
        apply_transforms(panel, reg, "mon", own={"diff": own["step"]})
    with pytest.raises(ValueError, match="counts"):
        OwnTransform("x", own["step"].build, counts="weeks")


def test_dates_as_text_and_back(spark):
    rows = spark.createDataFrame([("a", day("2024-02-29"), None, 1.0), ("b", None, day("0999-01-02"), None)], "k string, d date, e date, v double")
    text = W.dates_as_text(rows)
    listed = lambda df: [tuple(r) for r in df.orderBy("k").collect()]
    assert listed(text) == [("a", "2024-02-29", None, 1.0), ("b", None, "0999-01-02", None)]
    assert listed(W.dates_from_text(text, ["d", "e"])) == listed(rows)
    assert W.dates_as_text(rows.select("k")).columns == ["k"]
    with pytest.raises(Exception, match="2024-13-01"):
        W.dates_from_text(spark.createDataFrame([("2024-13-01",)], "d string"), ["d"]).collect()
