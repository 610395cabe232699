"""Versions, tables in buckets, digests of series, ranges by bins, exact shares and the banded blur."""
import datetime
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from geotally.model import SERIES, Dataset, days_back, materialize_by_series
from geotally.operators import qa, quality, rt, windows
from geotally.operators.intervals import in_intervals
from geotally.plans import flow
from geotally.sources import pointers, versions
from tests.conftest import START, make_dataset, make_obs

SERIES_TAG = ("r", "x", "all", "provenance", "p")


def rows_of(ds):
    return [sorted(map(str, getattr(ds, t).collect())) for t in versions.TABLES]


# ------------------------------------------------------------------ versions
def test_an_update_writes_the_changed_variable_alone(spark, tmp_path):
    root = str(tmp_path)
    ds = make_dataset(spark, {"r": {"x": [1, 2], "y": [3]}, "s": {"x": [4]}}, {"r": {"population": 5, "name": "R"}}, [SERIES_TAG])
    assert versions.save(ds, root) == {"obs": ["x", "y"], "static": ["name", "population"], "tags": ["x"]}
    assert rows_of(versions.load(spark, root)) == rows_of(ds)
    parts = set(tmp_path.glob("obs/*/_part=*"))
    changed = ds.with_obs(ds.obs.withColumn("value", F.when(F.col("variable") == "y", 9.0).otherwise(F.col("value"))).repartition(3))
    assert versions.save(changed, root) == {"obs": ["y"], "static": [], "tags": []}
    assert len(set(tmp_path.glob("obs/*/_part=*")) - parts) == 1 and rows_of(versions.load(spark, root)) == rows_of(changed)
    gone = changed.with_obs(changed.obs.filter("variable = 'x'"))
    assert versions.save(gone, root) == {"obs": [], "static": [], "tags": []} and rows_of(versions.load(spark, root)) == rows_of(gone)


def test_a_failed_write_leaves_the_version_before(spark, tmp_path):
    root, ds = str(tmp_path), make_dataset(spark, {"r": {"x": [1]}})
    versions.save(ds, root)
    broken = ds.with_obs(ds.obs.unionByName(ds.obs.withColumn("variable", F.when(F.col("value") == 1, F.raise_error(F.lit("lost")).cast("string")).otherwise("y"))))
    with pytest.raises(Exception, match="lost"):
        versions.save(broken, root)
    assert pointers.latest(spark, root)[0] == 1 and rows_of(versions.load(spark, root)) == rows_of(ds)
    with pytest.raises(LookupError):
        versions.load(spark, f"{root}/none")


def test_only_named_parts_are_opened(spark, tmp_path):
    ds = make_dataset(spark, {"r": {"x": [1], "y": [2], "odd/name é": [3]}})
    versions.save(ds, str(tmp_path))
    some = versions.load(spark, str(tmp_path), ["odd/name é"])
    assert [r["value"] for r in some.obs.collect()] == [3.0] and len(some.obs.inputFiles()) == 1
    assert versions.load(spark, str(tmp_path), ["none"]).obs.count() == 0


def test_digests_see_order_of_nothing_and_change_of_anything(spark):
    a = make_obs(spark, {"r": {"x": [1, 2, 2]}})
    digest = lambda df: [tuple(r) for r in versions.digests(df, ["variable"]).collect()]
    assert digest(a) == digest(a.repartition(3).orderBy(F.desc("date")))
    assert len({str(digest(x)) for x in (a, a.unionByName(a), a.withColumn("value", -F.col("value")), a.withColumn("bucket", F.lit("b")))}) == 4


# ------------------------------------------------------------------ buckets
def test_steps_after_stored_shuffle_nothing_by_series(spark):
    ds = flow.stored(make_dataset(spark, {f"r{i}": {"x": [1, 2, 3]} for i in range(20)}, tags=[SERIES_TAG]), "test")
    chained = windows.smooth_rolling_mean(windows.trim_trailing_zeros(windows.spread_after_stall(ds.obs), drop_all_zero=False))
    latest = ds.obs.groupBy(*SERIES).agg(F.max("date").alias("last"))
    joined = ds.obs.join(latest, SERIES).join(ds.tags.select(*SERIES, "content"), SERIES, "left")
    plain = make_obs(spark, {"r": {"x": [1]}}).withColumn("n", F.count("*").over(days_back(6)))
    text = lambda df: df._jdf.queryExecution().executedPlan().toString()
    hashed = "Exchange hashpartitioning"
    assert hashed not in text(chained) and hashed not in text(joined.hint("merge")) and hashed in text(plain)
    assert joined.count() == 60


def test_a_bucket_is_one_file(spark):
    table = materialize_by_series(make_obs(spark, {f"r{i}": {"x": [1, 2]} for i in range(50)}).repartition(7), "files")
    assert len(table.inputFiles()) <= int(spark.conf.get("spark.sql.shuffle.partitions")) and table.count() == 100


# ------------------------------------------------------------------ digests in comparisons
def pairs(spark, rows):
    return spark.createDataFrame([(v, loc, START + datetime.timedelta(days=d), x) for v, loc, d, x in rows], "variable string, location_id string, date date, value double")


def test_equal_snapshots_join_no_points(spark):
    rows = [("x", "a", d, float(d)) for d in range(5)] + [("x", "b", 0, 1.0)]
    left, right = pairs(spark, rows), pairs(spark, rows[::-1])
    assert qa.series_digests(left, right).filter("not same").count() == 0 and qa.joined_points(left, right).count() == 0
    assert sorted(tuple(r) for r in qa.diff_smape(left, right).collect()) == [("x", "a", 0.0, 5, True), ("x", "b", 0.0, 1, True)]
    assert qa.points_only_in_one(left, right).count() == 0


def test_only_series_that_differ_are_joined(spark):
    left = pairs(spark, [("x", "same", 0, 1.0), ("x", "null", 0, None), ("x", "null", 1, 2.0), ("x", "more", 0, 1.0), ("x", "other", 0, 1.0), ("x", "left", 0, 1.0)])
    right = pairs(spark, [("x", "same", 0, 1.0), ("x", "null", 0, None), ("x", "null", 1, 2.0), ("x", "more", 0, 1.0), ("x", "more", 1, 1.0), ("x", "other", 0, 3.0)])
    assert {r["location_id"] for r in qa.joined_points(left, right).collect()} == {"null", "more", "other"}
    assert [(r["location_id"], r["side"]) for r in qa.points_only_in_one(left, right).filter("value is not null").collect()] == [("more", "right")]
    assert {r["location_id"]: round(r["diff"], 6) for r in qa.diff_smape(left, right).collect()} == {"same": 0.0, "null": 0.0, "more": 0.0, "other": 0.5}


def test_equal_summaries_are_not_taken_apart(spark):
    frame = lambda rows: spark.createDataFrame(rows, "location_id string, a struct<n: int, s: string>, b double")
    old, new = frame([("x", (1, "k"), 1.0), ("y", (2, None), None), ("z", (3, "z"), 0.0)]), frame([("x", (1, "k"), 1.0), ("y", (2, "m"), None), ("w", (4, None), 2.0)])
    assert {tuple(r) for r in qa.nested_differences(old, new).collect()} == {
        ("y", "a.s", None, "m"), ("z", "a.n", "3", None), ("z", "a.s", "z", None), ("z", "b", "0.0", None), ("w", "a.n", None, "4"), ("w", "b", None, "2.0")}


# ------------------------------------------------------------------ ranges
def test_ranges_by_bins(spark):
    rng = random.Random(4)
    day = lambda i: START + datetime.timedelta(days=i)
    points = [(rng.choice("ab"), day(rng.randrange(-90, 120)), i) for i in range(200)]
    end = lambda: rng.choice([None, rng.randrange(-100, 130)])
    ranges = [(rng.choice("abc"), end(), end(), i) for i in range(40)] + [("a", 5, 4, 40), ("b", 0, 0, 41), ("a", None, None, 42)]
    frame = spark.createDataFrame([(k, None if a is None else day(a), None if b is None else day(b), i) for k, a, b, i in ranges], "k string, start date, end date, rule int")
    got = sorted((r["point"], r["rule"]) for r in in_intervals(spark.createDataFrame(points, "k string, date date, point int"), frame, ["k"], width=7).collect())
    assert got == sorted((p, i) for k, d, p in points for key, a, b, i in ranges if k == key and (a is None or d >= day(a)) and (b is None or d <= day(b)))
    none = spark.createDataFrame([], "k string, date date, point int")
    assert in_intervals(none, frame, ["k"]).count() == 0


def test_anomalies_that_are_listed_but_kept(spark):
    ds = make_dataset(spark, {"r": {"new_cases": [1, 2, 3, 4], "new_deaths": [5]}})
    day = lambda i: START + datetime.timedelta(days=i)
    rules = spark.createDataFrame([("r", "new_cases", day(2), None, "open", True), ("r", "new_cases", day(0), day(0), "kept", False), ("r", "new_deaths", None, day(0), "early", True)],
                                  "location_id string, variable string, start date, end date, note string, omit boolean")
    out = quality.anomaly_filter(ds, rules)
    assert sorted((r["variable"], r["value"]) for r in out.obs.collect()) == [("new_cases", 1.0), ("new_cases", 2.0)]
    assert sorted(re.findall(r"\d{4}-\d\d-\d\d", r["content"])[0] for r in out.tags.collect()) == [str(day(i)) for i in (0, 2, 3)]


# ------------------------------------------------------------------ shares and blur
@pytest.mark.parametrize("parts", [1, 3, 50])
def test_ecdf_is_exact(spark, parts):
    rng = random.Random(parts)
    values = [rng.choice([None, 7.0, float(rng.randrange(40))]) for _ in range(300)]
    got = {r["v"]: r["share"] for r in windows.ecdf(spark.createDataFrame([(v,) for v in values], "v double"), "v", parts).collect()}
    rank = lambda v: (v is not None, v or 0.0)
    assert got == {v: sum(rank(x) <= rank(v) for x in values) / len(values) for v in set(values)}


def dense_blur(values, sigma):
    n, step = len(rt.R_BINS), rt.R_BINS[1] - rt.R_BINS[0]
    m = np.zeros((n, n))
    for row in range(n):
        for col in range(n):
            if not (row < (n - 1) / 2 and col > 2 * row) and not (row > (n - 1) / 2 and col < 2 * row - n):
                m[row, col] = np.exp(-0.5 * (abs(row - col) * step / sigma) ** 2)
    return (m / m.sum(axis=1, keepdims=True)) @ values


@pytest.mark.parametrize("sigma", [0.03, 0.05, 0.4, 5.0])
def test_band_equals_the_whole_matrix(sigma):
    values = np.random.default_rng(1).random(len(rt.R_BINS))
    blur = rt.Blur()
    assert np.abs(blur(values, sigma) - dense_blur(values, sigma)).max() < 1e-12
    assert blur.half == min(len(rt.R_BINS) - 1, int(np.ceil(rt.REACH * sigma / (rt.R_BINS[1] - rt.R_BINS[0]))))
