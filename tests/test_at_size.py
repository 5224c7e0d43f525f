"""Passes over many series: their tasks grow with the series, and days of held values are not shuffled."""

import re

import pytest
from conftest import day
from pyspark.sql import functions as F

from tidemark.operators import asof, prefix
from tidemark.operators import runs as R
from tidemark.operators.windows import rolling_moments
from tidemark.plans import pipeline
from tidemark.plans import warehouse as W
from tidemark.plans.features import apply_transforms
from tidemark.session import scratch_path
from tidemark.sources import store as S

PANEL = "series_id string, date date, value double"


@pytest.fixture
def no_small_side(spark):
    """Tables as the optimizer sees them at size: none is small enough to be broadcast unasked."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def panel(spark, n=6):
    ids = spark.range(n).select(F.concat(F.lit("s"), "id").alias("series_id"))
    days = spark.range(40).select(F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("date"))
    return ids.crossJoin(days).withColumn("value", F.dayofyear("date") * 1.0)


def registry(spark, n=6):
    rows = [(f"s{i}", f"n{i}", "T", "W", "c", "u", ["yoy", "diff"], ["yoy", "diff"], 1, False) for i in range(n)]
    return spark.createDataFrame(
        rows,
        "series_id string, name string, source string, frequency string, category string, unit string, "
        "mon_transforms array<string>, fm_transforms array<string>, lag int, is_vintage boolean",
    )


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tasks_of_a_pass_follow_the_series(spark, monkeypatch, no_small_side):
    monkeypatch.setattr(asof, "SERIES_A_TASK", 1)
    plan = plan_of(apply_transforms(panel(spark), registry(spark), "mon", check_frequency=True))
    assert "6), REPARTITION_BY_NUM" in plan
    # The calendar goes to the held days; they are not shuffled by day to meet it.
    assert re.search(r"BroadcastHashJoin \[day#\d+\], \[day#\d+\], LeftSemi", plan)
    assert not re.search(r"SortMergeJoin \[day#\d+\]", plan)


def test_stamps_come_to_the_facts(spark, no_small_side):
    features = panel(spark).repartition(1, "series_id").withColumn("transform", F.lit("level"))
    published = spark.createDataFrame(
        [("s0", day("2020-01-05"), day("2020-01-02")), ("s0", day("2020-01-09"), day("2020-01-08")), ("s1", day("2020-02-01"), None), ("s2", None, day("2020-01-01"))],
        "series_id string, release_date date, obs_date date",
    )
    fact = W.fact_table(features, published, registry(spark), "now")
    got = {(r.series_id, r.date): (r.release_date, r.obs_date) for r in fact.collect()}
    assert min(d for s, d in got if s == "s0") == day("2020-01-05")
    assert got["s0", day("2020-01-08")] == (day("2020-01-05"), day("2020-01-02"))
    assert got["s0", day("2020-02-09")] == (day("2020-01-09"), day("2020-01-08"))
    assert got["s1", day("2020-02-01")] == (day("2020-02-01"), None) and not any(s == "s2" for s, _ in got)
    assert not re.search(r"hashpartitioning\(series_id#\d+, date#\d+", plan_of(fact))


def test_keyed_write_in_parts_and_second_load(spark, tmp_path):
    rows = panel(spark, 64)
    path = str(tmp_path / "keyed")
    S.write_keyed(rows, path, ["series_id", "date"], buckets=2, parts=8)
    assert spark.read.parquet(path).select(F.input_file_name()).distinct().count() > 2
    more = panel(spark, 65).withColumn("value", F.lit(-1.0))
    S.append_new_keyed(spark, path, more.unionByName(more), ["series_id", "date"], order=["value"], buckets=2, parts=8)
    stored = spark.read.parquet(path).select("series_id", "date", "value")
    assert stored.count() == 65 * 40 and stored.where("value = -1").select("series_id").distinct().collect()[0].series_id == "s64"


def test_split_match_of_distinct_days_joins_nothing_back(spark, no_small_side):
    left = spark.createDataFrame([("a", day("2020-01-03")), ("a", None), (None, day("2020-01-03"))], "series_id string, q date")
    right = spark.createDataFrame([("a", day("2020-01-01"), 1.0), (None, day("2020-01-01"), 2.0)], "series_id string, d date, v double")
    args = (left, right, "q", "d", ["series_id"], ["v"])
    once, joined = prefix.asof_last(*args, one_per_day=True), prefix.asof_last(*args)
    assert sorted(once.collect(), key=str) == sorted(joined.collect(), key=str)
    assert plan_of(once).count("SortMergeJoin") < plan_of(joined).count("SortMergeJoin")


def held_and_published(spark, n=6):
    """Runs of three days with a gap after every second one, and a publication for each."""
    starts = panel(spark, n).where("day(date) % 3 = 1")
    held = starts.select("series_id", F.col("date").alias("since"), F.date_add("date", F.when(F.day("date") % 2 == 0, 2).otherwise(0)).alias("until"), "value", F.date_sub("date", 1).alias("obs_date"))
    return held, held.select("series_id", F.col("since").alias("release_date"), "obs_date")


def test_facts_of_runs_over_several_tasks(spark, monkeypatch, no_small_side):
    """One task or one per series: the same facts, which are not sorted to meet their stamps; no array is read once per publication."""
    held, published = held_and_published(spark)
    wanted = F.array(*[F.lit(t) for t in ("zscore_rolling_1y", "yoy", "diff", "pct_change_1m", "diff_bps")])
    some = F.when(F.col("series_id") != "s1", wanted).otherwise(F.array(F.lit("diff"), F.lit("zscore_expanding")))
    reg = registry(spark).withColumns({"fm_transforms": some, "frequency": F.when(F.col("series_id") < "s3", "D").otherwise("W")})

    def facts():
        return W.fact_table(apply_transforms(R.spread(held), reg, "fm", check_frequency=False, runs=held), published, reg, "now")

    whole = sorted(facts().collect(), key=str)
    assert {r.transform for r in whole} >= {"level", "diff", "diff_bps"} and len(whole) > 100
    monkeypatch.setattr(asof, "SERIES_A_TASK", 1)
    split = facts()
    assert sorted(split.collect(), key=str) == whole
    plan = plan_of(split)
    assert "SortMergeJoin [series_id" not in plan and "datediff(pubs" not in plan
    counted = split.groupBy("series_id").count().collect()
    assert len(counted) == len({r.series_id for r in counted}) == 6


def test_transforms_of_runs_are_those_of_their_days(spark):
    held, _ = held_and_published(spark)
    names = ("zscore_rolling_1y", "zscore_rolling_3y", "zscore_expanding", "yoy", "diff", "pct_change_1m", "diff_bps")
    reg = registry(spark).withColumns({"fm_transforms": F.array(*[F.lit(t) for t in names]), "frequency": F.when(F.col("series_id") < "s4", "D").otherwise("W")})
    days = R.spread(held)
    a, b = (apply_transforms(days, reg, "fm", check_frequency=False, runs=r) for r in (held, None))
    assert a.count() == b.count() > 500 and a.exceptAll(b).isEmpty()
    assert R.grid(held).exceptAll(days.select("date").distinct()).isEmpty() and R.grid(held).count() == days.select("date").distinct().count()


def test_widths_that_are_known_save_a_sort(spark):
    rows = panel(spark).withColumn("w", F.when(F.col("series_id") < "s3", 4).otherwise(7))
    any_width, known = rolling_moments(rows, "w", lag=1), rolling_moments(rows, "w", lag=1, widths=[7, 4])
    assert known.exceptAll(any_width).isEmpty() and known.count() == any_width.count()
    assert plan_of(known).count("Sort [") < plan_of(any_width).count("Sort [")
    with pytest.raises(Exception, match="width not given: 7"):
        rolling_moments(rows, "w", widths=[4]).collect()


def test_batch_job_checks_each_list_and_reads_the_vintages_once(spark, monkeypatch):
    """A first release without a value, revised later: its date counts in the check and its value stays missing."""
    stored, store = [], pipeline.materialize
    monkeypatch.setattr(pipeline, "materialize", lambda df, label: stored.append(label) or store(df, label))
    weekly = panel(spark).where("dayofweek(date) = 1")
    reg = registry(spark).withColumns({"is_vintage": F.col("series_id") == "s5", "lag": F.when(F.col("series_id") != "s5", 1)})
    reg = reg.withColumn("fm_transforms", F.array(F.lit("zscore_rolling_1y")))
    vintages = weekly.where("series_id = 's5'").select("series_id", F.date_add("date", 2).alias("realtime_start"), "date", F.when(F.day("date") > 9, F.col("value")).alias("value"))
    vintages = vintages.unionByName(vintages.withColumns({"realtime_start": F.date_add("realtime_start", 1), "value": F.lit(9.0)}))
    paths = pipeline.run(spark, weekly, reg, scratch_path(spark, "job"), vintages, buckets=2)
    assert stored == ["vintages", "checked", "checked"]
    runs = spark.read.parquet(paths["runs"]).where("series_id = 's5'").collect()
    assert len(runs) == 5 and {r.value for r in runs if r.obs_date.day <= 9} == {None}
