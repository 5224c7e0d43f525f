import json

import pandas as pd
import pytest
from conftest import collect, day, walk
from pyspark.sql import functions as F

from tidemark.operators import merge as M
from tidemark.operators import quality as Q
from tidemark.operators import reshape as R
from tidemark.session import scratch_path
from tidemark.sources import landing as L
from tidemark.sources import registry as G
from tidemark.sources import store as S


def s(values, start="2024-01-01"):
    return pd.Series(values, index=pd.date_range(start, periods=len(values)), dtype=float)


def test_newer_value_wins_but_newer_blank_does_not(panel_of):
    old, new = panel_of({"a": s([1, 2, 3])}), panel_of({"a": s([None, 20, None, 40])})
    got = collect(M.accumulate(old, new), "value")
    assert [v for _, v in sorted(got.items())] == [1.0, 20.0, 3.0, 40.0]


def test_refresh_takes_the_overlap_only(panel_of):
    old = panel_of({"a": s([1.0] * 20)})
    new = panel_of({"a": s([9.0] * 25), "b": s([5.0] * 3)})
    got = collect(M.refresh(old, new), "value")
    assert [v for (k, _), v in sorted(got.items()) if k == "a"] == [1.0] * 12 + [9.0] * 13
    assert sum(k == "b" for k, _ in got) == 3


def test_splice_prefers_canonical_on_its_calendar(panel_of):
    canon, deep = panel_of({"a": s([None, 2, None], "2024-01-03")}), panel_of({"a": s([7, 7, 7, 7, 7])})
    got = collect(M.splice(canon, deep, canon.select("date").distinct()), "value")
    assert [v for _, v in sorted(got.items())] == [7.0, 2.0, 7.0]
    assert len(collect(M.splice(canon, deep), "value")) == 5


def test_insert_ignore(spark):
    target = spark.createDataFrame([("a", 1, 10.0)], "k string, n int, v double")
    incoming = spark.createDataFrame([("a", 1, 99.0), ("a", 2, 5.0), ("a", 2, 4.0)], "k string, n int, v double")
    got = M.insert_ignore(target, incoming, ["k", "n"], order=["v"]).collect()
    assert [tuple(r) for r in got] == [("a", 2, 4.0)]


def test_append_new_keeps_what_is_stored(spark):
    path = scratch_path(spark, "fact")
    spark.createDataFrame([("a", 1, 10.0)], "k string, n int, v double").write.parquet(path)
    S.append_new(spark, path, spark.createDataFrame([("a", 1, 99.0), ("b", 1, 2.0)], "k string, n int, v double"), ["k", "n"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [("a", 1, 10.0), ("b", 1, 2.0)]


def test_observation_landing(spark, tmp_path):
    rows = [{"realtime_start": "2024-02-01", "date": "2024-01-01", "value": v} for v in ("1.5", ".", "x", "NaN")]
    (tmp_path / "a.json").write_text(json.dumps({"series_id": "a", "observations": rows}) + "\n{broken\n")
    got = L.ingest_vintages(spark, str(tmp_path)).collect()
    assert [r.value for r in got] == [1.5, None, None, None] and got[0].realtime_start == day("2024-02-01")
    assert [r.payload for r in L.quarantined_pages(L.read_observation_pages(spark, str(tmp_path))).collect()] == ["{broken"]


def test_empty_landing_is_an_error(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"series_id": "a", "observations": []}))
    with pytest.raises(ValueError, match="no rows"):
        L.ingest_vintages(spark, str(tmp_path))


def test_margin_sheet(spark, tmp_path):
    (tmp_path / "m.csv").write_text(
        "Year-Month,Debit Balances,Free Cash,Free Margin,Note\n"
        "2024-03,300,30,3,x\n2024-02,200,bad,2,\nnonsense,1,1,1,\n2024-02,210,21,,\n2024-01,100,10,1,\n"
    )
    got = L.normalize_margin(L.read_margin_sheet(spark, str(tmp_path))).orderBy("date").collect()
    assert [tuple(r) for r in got] == [
        (day("2024-01-31"), 100.0, 10.0, 1.0),
        (day("2024-02-29"), 210.0, 21.0, None),  # the later line of the month
        (day("2024-03-29"), 300.0, 30.0, 3.0),  # the 31st is a Sunday
    ]


def test_positions(spark):
    raw = spark.createDataFrame(
        [("043602", "2024-01-02T00:00:00.000", "10", "4", "7", ".", "1", "2"), ("042601", "2024-01-09T00:00:00.000", "1", "1", "1", "1", "5", "2")],
        f"{L.POSITION_CONTRACT} string, {L.POSITION_DATE} string, " + ", ".join(f"{c} string" for c in list(L.POSITION_COLUMNS)[:6]),
    )
    typed = L.normalize_positions(raw)
    first = typed.where("contract = '043602'").collect()[0]
    assert (first.lev_net, first.dealer_net, first.asset_mgr_net) == (6.0, None, -1.0)
    wide = L.positions_panel(typed, L.CONTRACTS).orderBy("date").collect()
    assert wide[0].TFF_10Y_LEVERAGED == 6.0 and wide[0].TFF_2Y_LEVERAGED is None  # both dates stay
    assert wide[1].UST_2Y_asset_mgr_net == 3.0


def test_store_round_trip_and_pruning(spark, panel_of, vintages_of):
    p = panel_of({f"s{i}": walk(30, i) for i in range(6)} | {"skip_1": walk(5)})
    path = scratch_path(spark, "panel")
    S.write_panel(p, path, buckets=16)
    assert S.read_panel(spark, path, buckets=16).exceptAll(p).count() == 0
    assert S.read_panel(spark, path, skip_prefix="skip_", buckets=16).select("series_id").distinct().count() == 6
    two = S.read_panel(spark, path, series=["s1", "s2"], buckets=16)
    assert {r.series_id for r in two.collect()} == {"s1", "s2"} and two.count() == 60
    plan = two._jdf.queryExecution().toString()
    assert "PartitionFilters: [bucket" in plan and "PushedFilters: [In(series_id" in plan


def test_bucketed_table_needs_no_shuffle(spark, panel_of):
    from tidemark.operators.transforms import expanding_zscore, rolling_zscore

    p = panel_of({f"s{i}": walk(80, i) for i in range(6)})
    path = scratch_path(spark, "table")
    t = S.save_panel_table(p, "panel_a", path, buckets=4)
    assert t.exceptAll(p).count() == 0 and t.count() == p.count()
    for df in (rolling_zscore(t, 60), expanding_zscore(t), t.groupBy("series_id").count()):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    again = S.open_panel_table(spark, "panel_b", path, buckets=4)
    assert again.exceptAll(p).count() == 0
    assert "Exchange" not in again.groupBy("series_id").count()._jdf.queryExecution().executedPlan().toString()


def test_an_unreadable_file_fails_the_scan_and_can_be_put_in_quarantine(spark, tmp_path):
    for name in ("GOOD", "prefix_A"):
        pd.DataFrame({"date": [day("2024-01-01")], "value": [1.0]}).to_parquet(tmp_path / f"{name}.parquet")
    (tmp_path / "BAD.parquet").write_bytes(b"not parquet at all")
    with pytest.raises(Exception, match="not a Parquet file|FAILED_READ_FILE"):
        S.stack_series_files(spark, str(tmp_path), skip_prefix="prefix_").collect()
    bad = S.damaged_files(spark, str(tmp_path), "date date, value double")
    assert [b.rsplit("/", 1)[1] for b in bad] == ["BAD.parquet"]
    (tmp_path / "BAD.parquet").rename(tmp_path / "BAD.txt")
    got = S.stack_series_files(spark, str(tmp_path / "*.parquet"), skip_prefix="prefix_").collect()
    assert [(r.series_id, r.value) for r in got] == [("GOOD", 1.0)]


def test_a_damaged_store_is_refused_and_repaired(spark, tmp_path, panel_of):
    path = str(tmp_path / "store")
    S.write_panel(panel_of({k: pd.Series(1.0, index=pd.date_range("2024-01-01", periods=5)) for k in "abcdefgh"}), path, buckets=4)
    names = sorted(p for p in (tmp_path / "store").rglob("*.parquet"))
    whole = S.read_panel(spark, path, buckets=4).count()
    lost = spark.read.parquet(str(names[0])).count()
    names[0].write_bytes(names[0].read_bytes()[:40])
    with pytest.raises(Exception, match="not a Parquet file|FAILED_READ_FILE"):
        S.read_panel(spark, path, buckets=4).collect()
    bad = S.damaged_files(spark, path)
    assert [b.rsplit("/", 1)[1] for b in bad] == [names[0].name]
    assert whole == 40 and S.read_panel(spark, path, buckets=4, quarantined=bad).count() == whole - lost


def test_report(spark, tmp_path):
    S.write_report(spark.createDataFrame([("a", 1.5)], "k string, v double"), str(tmp_path / "r"))
    assert spark.read.option("header", True).csv(str(tmp_path / "r")).collect()[0].v == "1.5"


def test_default_registry(spark):
    reg = G.validate(G.default_registry(spark))
    assert reg.count() == 40 and reg.where("lag IS NOT NULL").count() == 17 and reg.where("is_vintage").count() == 8
    counts = {r.category: r["count"] for r in reg.groupBy("category").count().collect()}
    assert counts == {"rates": 7, "liquidity": 8, "credit": 5, "curve": 6, "vol": 1, "leverage": 6, "fx": 2, "macro": 3, "cftc": 2}
    assert G.get(reg, "SP500").collect()[0].lag == 0 and G.get(reg, "none").isEmpty()


def test_registry_without_lag_is_refused(registry_of):
    with pytest.raises(ValueError, match="without publication lag"):
        G.validate(registry_of({"a": {"fm": ["diff"]}}))
    G.validate(registry_of({"a": {"fm": []}, "b": {"fm": ["diff"], "is_vintage": True}}))


def test_coverage_guard(spark, panel_of):
    floors = spark.createDataFrame(
        [("late", day("2019-12-31"), 1), ("few", day("2030-01-01"), 100), ("fine", day("2020-01-01"), 10), ("absent", day("2000-01-01"), 1)],
        "series_id string, first_by date, min_n int",
    )
    p = panel_of({k: walk(20) for k in ("late", "few", "fine")})
    bad = Q.coverage_violations(p, floors)
    assert {r.series_id for r in bad.collect()} == {"late", "few"}
    with pytest.raises(ValueError, match="too short"):
        Q.enforce(bad, "history too short")


def test_wide_and_long(panel_of):
    p = panel_of({"a": s([1, 2]), "b": s([5], "2024-01-02")})
    wide = R.long_to_wide(p, ["a", "b"]).orderBy("date").collect()
    assert [(r.a, r.b) for r in wide] == [(1.0, None), (2.0, 5.0)]
    assert R.wide_to_long(R.long_to_wide(p, ["a", "b"]), ["a", "b"]).where(F.col("value").isNull()).count() == 1
    features = p.withColumn("transform", F.when(F.col("series_id") == "a", "level").otherwise("yoy"))
    assert R.features_to_wide(features, ["a", "b_yoy"]).columns == ["date", "a", "b_yoy"]
