"""Late rows kept, the log that gets shorter, tables published together, loads by bucket, damaged files, sheets in parts."""

import datetime as dt
import random
import re

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import collect, day, walk

from tidemark.plans import pipeline
from tidemark.sources import landing as L
from tidemark.sources import store as S
from tidemark.sources import versions
from tidemark.streaming import bucketlog, late
from tidemark.streaming.merge import folded

EVENT = "key string, value double, ts timestamp, note string"
SEEN = "series_id string, date date, value double, ts timestamp"


def test_late_rows_are_kept_and_counted(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    at = lambda d, h: dt.datetime(2024, 1, d, h)

    def land(*rows):
        spark.createDataFrame(rows, EVENT).write.mode("append").parquet(src)
        events = spark.readStream.schema(EVENT).parquet(src)
        late.resample_keeping_late(events, out, cp, "key", "value").awaitTermination()

    land(("k", 1.0, at(1, 3), "a"), ("k", 2.0, at(1, 9), "b"), (None, 5.0, at(1, 9), "no key"), ("k", 9.0, at(4, 1), "c"))
    assert late.late_rows(spark, out, EVENT).count() == 0
    # Of the second delivery: a closed day twice, a row without an instant, an open day, a missing value that is the last.
    land(("k", 7.0, at(1, 23), "late"), ("k", 7.0, at(1, 23), "late"), ("k", 1.0, None, "when"), ("k", 3.0, at(3, 5), "d"), ("k", None, at(3, 6), "e"), ("k", 0.0, at(9, 0), "f"))
    aside = late.late_rows(spark, out, EVENT)
    assert sorted(r.note for r in aside.collect()) == ["late", "late", "when"]
    assert late.on_time_rows(spark, out) + aside.count() == spark.read.parquet(src).count()
    got = {(r.date, r.series_id): (r.value, r.n) for r in late.closed_windows(spark, out).collect()}
    assert got == {(day("2024-01-01"), "k"): (2.0, 2), (day("2024-01-01"), None): (5.0, 1), (day("2024-01-03"), "k"): (None, 2), (day("2024-01-04"), "k"): (9.0, 1)}


def test_no_delivery_yet(spark, tmp_path):
    assert late._clock(spark, str(tmp_path / "none")) is None
    assert bucketlog.read(spark, str(tmp_path / "none")).count() == 0 and bucketlog.compact(spark, str(tmp_path / "none")) == []


def _loads(n, rng):
    base = dt.datetime(2024, 1, 1)
    return [
        [
            (f"s{rng.randrange(6)}", day(f"2024-01-0{rng.randrange(1, 5)}"), None if rng.random() < 0.2 else float(rng.randrange(100)), base + dt.timedelta(hours=rng.randrange(200)))
            for _ in range(6)
        ]
        for _ in range(n)
    ]


def test_the_log_gets_shorter_and_says_the_same(spark, tmp_path):
    """Loads in any order of their times, a replayed batch before and after folding; what is read stays bounded."""
    path, loads = str(tmp_path / "log"), _loads(14, random.Random(4))
    for number, rows in enumerate(loads):
        merged = folded(spark.createDataFrame(rows, SEEN))
        bucketlog.append(spark, path, merged, number, buckets=4)
        if number in (2, 9):
            bucketlog.append(spark, path, merged, number, buckets=4)
        if number % 4 == 3:
            before = collect(bucketlog.read(spark, path), "value")
            assert bucketlog.compact(spark, path, buckets=4)
            assert collect(bucketlog.read(spark, path), "value") == before
            # A batch of an earlier number counts once, also when it comes again after the folding.
            bucketlog.append(spark, path, folded(spark.createDataFrame(loads[number - 1], SEEN)), number - 1, buckets=4)
            assert collect(bucketlog.read(spark, path), "value") == before
    # In one piece: of every key and day the last instant with a value, of one instant the later load, then the larger value.
    best = {}
    for number, rows in enumerate(loads):
        for sid, d, v, ts in rows:
            best.setdefault((sid, d), []).append((ts, number, v) if v is not None else None)
    want = {k: (max(x for x in v if x)[2] if any(v) else None) for k, v in best.items()}
    assert collect(bucketlog.read(spark, path), "value") == want
    version = versions.current(spark, path)
    assert version["folded"] == 11 and sorted(bucketlog._open_loads(spark, path, 11)) == [12, 13]
    kept = [p.name for p in (tmp_path / "log" / "loads").iterdir()]
    assert len(kept) <= 6  # the open loads and the last four folded, kept for readers of the version before


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = [(f"s{i}", day("2024-01-01"), float(i), dt.datetime(2024, 1, 2)) for i in range(20)]
    bucketlog.append(spark, path, folded(spark.createDataFrame(rows, SEEN)), 0, buckets=4)
    assert bucketlog.compact(spark, path, buckets=4) == [0, 1, 2, 3]
    first = versions.current(spark, path)["bases"]
    bucketlog.append(spark, path, folded(spark.createDataFrame([("s0", day("2024-01-01"), 50.0, dt.datetime(2024, 1, 3))], SEEN)), 1, buckets=4)
    (touched,) = bucketlog.compact(spark, path, buckets=4)
    second = versions.current(spark, path)["bases"]
    assert {b for b in second if second[b] != first[b]} == {str(touched)}
    got = collect(bucketlog.read(spark, path), "value")
    assert len(got) == 20 and got[("s0", day("2024-01-01"))] == 50.0


def test_publishing_is_all_or_nothing(spark, tmp_path, panel_of, registry_of):
    root, registry = str(tmp_path / "root"), registry_of({"a": {"lag": 1, "frequency": "D", "fm": ["diff"], "mon": ["diff"]}})
    job = lambda series, **kw: lambda out: pipeline.run(spark, panel_of({"a": series}), registry, out, buckets=2, **kw)
    assert versions.current(spark, root) is None
    first = versions.run_published(spark, root, job(walk(30)))
    levels = collect(spark.read.parquet(versions.current(spark, root)["pit"]), "value")
    assert versions.current(spark, root) == first and set(first) == {"raw", "monitoring", "runs", "pit", "features", "metrics"}

    def fails_late(out):
        job(walk(40))(out)
        raise RuntimeError("last stage")

    with pytest.raises(RuntimeError, match="last stage"):
        versions.run_published(spark, root, fails_late)
    assert versions.current(spark, root) == first and collect(spark.read.parquet(first["pit"]), "value") == levels
    with pytest.raises(RuntimeError, match="was published since"):
        versions.publish(spark, root, {}, after=0)
    assert versions.publish(spark, root, {"pit": "x"}, after=1) == 2 and versions.current(spark, root) == {"pit": "x"}
    for name in ("../x", "", "/x", "_versions"):
        with pytest.raises(ValueError):
            versions.remove(spark, root, name)


def test_a_load_reads_only_the_buckets_it_touches(spark, tmp_path):
    path, key, schema = str(tmp_path / "t"), ["k", "n"], "k string, n int, v double"
    S.write_keyed(spark.createDataFrame([(f"k{i}", n, 1.0) for i in range(40) for n in range(3)], schema), path, key, buckets=16)
    incoming = spark.createDataFrame([("k1", 2, 9.0), ("k1", 3, 2.0), ("k1", 3, 3.0), ("new", 0, 4.0)], schema)
    part = S.touched_part(spark, path, incoming, key, incoming.schema, buckets=16)
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ IN \(\d+,\d+\)", plan) and "GreaterThanOrEqual(n,0)" in plan, plan
    S.append_new_keyed(spark, path, incoming, key, order=["v"], buckets=16)
    got = {(r.k, r.n): r.v for r in spark.read.parquet(path).collect()}
    assert len(got) == spark.read.parquet(path).count() == 122 and got[("k1", 2)] == 1.0 and got[("k1", 3)] == 2.0 and got[("new", 0)] == 4.0
    S.append_new_keyed(spark, path, incoming.limit(0), key, buckets=16)
    assert spark.read.parquet(path).count() == 122
    with pytest.raises(Exception, match="NULL in key n"):
        S.append_new_keyed(spark, path, spark.createDataFrame([("k", None, 1.0)], schema), key, buckets=16)


def test_damage_is_found_by_the_tasks(spark, tmp_path):
    good = pa.table({"series_id": ["a"] * 50_000, "date": [day("2024-01-01")] * 50_000, "value": [float(i) for i in range(50_000)]})
    for name in ("good", "cut", "flipped", "garbage"):
        pq.write_table(good, tmp_path / f"{name}.parquet", compression="none", use_dictionary=False, write_page_checksum=True)
    raw = bytearray((tmp_path / "flipped.parquet").read_bytes())
    raw[len(raw) // 2] ^= 0xFF
    (tmp_path / "flipped.parquet").write_bytes(raw)
    (tmp_path / "cut.parquet").write_bytes((tmp_path / "cut.parquet").read_bytes()[:-9])
    (tmp_path / "garbage.parquet").write_bytes(b"no parquet")
    pq.write_table(good.drop_columns(["value"]), tmp_path / "short.parquet")
    pq.write_table(good.set_column(2, "value", pa.array(["x"] * 50_000)), tmp_path / "typed.parquet")
    pq.write_table(good.slice(0, 0), tmp_path / "none.parquet")
    found = {r.path.rsplit("/", 1)[1].split(".")[0]: r.error for r in S.damage_report(spark, str(tmp_path)).collect()}
    assert set(found) == {"cut", "flipped", "garbage", "short", "typed"}
    assert found["short"] == "no column value" and found["typed"].startswith("column value is string")


def test_a_sheet_in_parts_keeps_its_order(spark, tmp_path):
    """The last line of a month counts, also when the month goes on in the next file."""
    parts = [["2024-01,1,1,1", "2024-02,2,2,2"], ["2024-02,3,x,3", "2024-03,4,4,4"], ["2024-03,5,5,5", "2024-03,6,6,6"]]
    for i, lines in enumerate(parts):
        (tmp_path / f"part-{i}.csv").write_text("\n".join(["a,b,c,d", *lines]) + "\n")
    got = {r.date.isoformat()[:7]: (r.debit, r.fc_cash) for r in L.normalize_margin(L.read_margin_sheet(spark, str(tmp_path))).collect()}
    assert got == {"2024-01": (1.0, 1.0), "2024-02": (3.0, None), "2024-03": (6.0, 6.0)}
