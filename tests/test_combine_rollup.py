"""Merging, rollups, comparison and reports on literal inputs."""
import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from geotally.model import assert_unique
from geotally.operators import combine as C, measures as M, qa, rollup as R
from tests.conftest import START, make_dataset, make_obs, near, series

N = None


def test_priority_takes_whole_groups(spark):
    one = make_obs(spark, {"cbsa": {"m": [2.2, 3.3]}, "f1": {"m": {"all": [1], "age:0-9": [5]}}}).withColumn("source", F.lit("one"))
    two = make_obs(spark, {"cbsa": {"m": [333, 333, 333]}, "f2": {"m": [7]}, "f1": {"m": {"all": [9, 9], "sex:f": [4]}}}).withColumn("source", F.lit("two"))
    tags = spark.createDataFrame([("cbsa", "m", "all", "provenance", s, s) for s in ("one", "two")], "location_id string, variable string, bucket string, tag_type string, content string, source string")
    points, kept = C.combine_by_priority(one.unionByName(two), tags, C.feature_priorities(spark, {"m": ["two", "one"]}))
    assert near(series(points, "cbsa"), [2.2, 3.3]) and near(series(points, "f2"), [7]) and near(series(points, "f1"), [1])
    assert near(series(points, "f1", bucket="sex:f"), [4])
    assert [r["content"] for r in kept.collect()] == ["one"]


def aggregate(spark, spec, static, **kwargs):
    ds = make_dataset(spark, spec, static)
    m = spark.createDataFrame([(k, "us") for k in static], "location_id string, parent_id string")
    return R.aggregate_regions(ds, m, **kwargs)


@pytest.mark.parametrize("parent", [None, "us"])
def test_coverage(spark, parent):
    out = aggregate(spark, {"tx": {"m1": [1, 3]}, "az": {"m1": [1]}}, {"tx": {"population": 1000}, "az": {"population": 2000}}, coverage=1.0, parent=parent)
    assert near(series(out.obs, "us"), [2])
    assert {(r["attr"], r["num"]) for r in out.static.collect()} == {("population", 3000.0)}


def test_weighted(spark):
    static = {"tx": {"population": 2500, "s1": 4}, "az": {"population": 7500, "s1": 12}}
    spec = {"tx": {"m1": [4, 4], "m2": [4, 4]}, "az": {"m1": [8, 12], "m2": [18, 40]}}
    out = aggregate(spark, spec, static, weighted={"m1": "population", "s1": "population"})
    assert near(series(out.obs, "us", "m1"), [7, 10]) and near(series(out.obs, "us", "m2"), [22, 44])
    assert {r["attr"]: r["num"] for r in out.static.collect()} == {"population": 10000.0, "s1": 10.0}


def test_hsa_broadcast_reaches_counties_without_data(spark):
    hsa = spark.createDataFrame([("a", "001"), ("b", "001"), ("c", "002")], "location_id string, hsa string")
    out = R.rollup_hsa_broadcast(make_dataset(spark, {"a": {"icu_beds": [3]}}), hsa)
    assert near(series(out.obs, "b", "icu_beds_hsa"), [3]) and series(out.obs, "c", "icu_beds_hsa") == []


def test_country_native_wins(spark):
    ds = make_dataset(spark, {"tx": {"m": [1], "n": [2]}, "iso1:us": {"m": [50]}}, {"tx": {"population": 5}})
    out = R.rollup_country(ds, spark.createDataFrame([("tx",)], "location_id string"))
    assert near(series(out.obs, "iso1:us", "m"), [50]) and near(series(out.obs, "iso1:us", "n"), [2])


def test_disjoint_unions_fail_on_overlap(spark):
    a, b = make_dataset(spark, {"r": {"x": [1]}}), make_dataset(spark, {"r": {"y": [1]}})
    assert C.join_columns(a, b).obs.count() == 2
    with pytest.raises(PySparkException, match="not disjoint"):
        C.append_regions(a, b).obs.collect()
    with pytest.raises(PySparkException, match="not disjoint"):
        C.join_columns(a, a).obs.collect()


def test_assert_unique(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "k int, v string")
    assert assert_unique(df.filter("k = 1"), ["k"]).collect() == [(1, "a")]
    with pytest.raises(PySparkException, match="duplicate key"):
        assert_unique(df, ["k"]).collect()


def test_smape(spark):
    day = lambda i: START + datetime.timedelta(days=i)
    left = spark.createDataFrame([("a", "r", day(1), 1.1), ("b", "r", day(0), 1.0), ("b", "r", day(1), 2.2)], "variable string, location_id string, date date, value double")
    right = spark.createDataFrame([("a", "r", day(0), 1.0), ("a", "r", day(1), 1.1), ("b", "r", day(0), 2.0)], "variable string, location_id string, date date, value double")
    got = {r["variable"]: (round(r["diff"], 9), r["points_overlap"], r["has_overlap"]) for r in qa.diff_smape(left, right).collect()}
    assert got == {"a": (0.0, 1, True), "b": (round(1 / 3, 9), 1, True)}
    assert {(r["variable"], r["side"]) for r in qa.points_only_in_one(left, right).collect()} == {("a", "right"), ("b", "left")}


def test_smape_without_overlap(spark):
    mk = lambda i: spark.createDataFrame([("a", "r", START + datetime.timedelta(days=i), 1.0)], "variable string, location_id string, date date, value double")
    r = qa.diff_smape(mk(0), mk(3)).first()
    assert (r["diff"], r["points_overlap"], r["has_overlap"]) == (1.0, 0, False)


def test_duplicates_all_dropped(spark):
    df = spark.createDataFrame([("r", START, 1.0, "x"), ("r", START, 2.0, "y"), ("s", START, 3.0, "z")], "location_id string, date date, v double, t string")
    assert [(r["location_id"], r["variable"], r["value"]) for r in qa.diff_prepare(df).collect()] == [("s", "v", 3.0)]


def test_field_summary(spark):
    r = qa.field_summary(make_obs(spark, {"r": {"x": [N, N, 10, 30, 32, N, 40, N]}})).first()
    assert (r["largest_delta"], r["largest_delta_date"], r["latest_value"], r["num_observations"]) == (20.0, START + datetime.timedelta(days=3), 40.0, 4)


def test_positivity_choice(spark):
    as_of = START + datetime.timedelta(days=29)
    methods = [M.Method("first", ["a"], M.pass_through("a"), 5), M.Method("second", ["b"], M.pass_through("b"), 5), M.Method("SmoothedTests", ["c"], M.pass_through("c"), 5)]
    obs = make_obs(spark, {"x": {"a": [1] * 10, "b": [2] * 30}, "y": {"a": [3] * 30, "b": [4] * 30}, "z": {"c": [5] * 3}, "w": {"a": [6] * 3}})
    best = M.positivity_best(M.positivity_methods(obs, as_of, methods))
    assert {(r["location_id"], r["method"]) for r in best.collect()} == {("x", "second"), ("y", "first"), ("z", "SmoothedTests")}


def test_positivity_without_recent_negatives(spark):
    up = [10.0 * i for i in range(20)]
    flat = [5.0 * i for i in range(8)] + [35.0] * 12
    good = M.positivity_smoothed(make_obs(spark, {"r": {"p": up}}), make_obs(spark, {"r": {"n": up}}))
    assert good.count() > 10 and {round(r["value"], 6) for r in good.collect()} == {0.5}
    assert M.positivity_smoothed(make_obs(spark, {"r": {"p": up}}), make_obs(spark, {"r": {"n": flat}})).count() == 0


def test_smoothed_method_is_the_smoothed_ratio(spark):
    """Stalls, gaps, a fall, series that end on different days, and one series only."""
    rows = {
        "a": {"p": [1, 3, 3, 8, N, N, 20, 21, 30, 30, 41, 55], "n": [5, 9, 9, N, 30, 28, 44, 60, 61, 80]},
        "b": {"p": [N, N, 4, 9, 9, 9, 9, 30], "n": [2, 2, 2, 7, 7, 19, 40, 40, 40, 77]},
        "c": {"p": [1, 2, 3, 9]}, "d": {"n": [1, 2, 3, 9]},
    }
    obs = make_obs(spark, rows)
    of = lambda v: obs.filter(F.col("variable") == v)
    points = lambda df: sorted((r["location_id"], r["date"], round(r["value"], 12)) for r in df.collect())
    methods = [M.Method("SmoothedTests", ["p", "n"], M.smoothed_tests("p", "n"), 10, True)]
    want = points(M.positivity_smoothed(of("p"), of("n")))
    assert want and points(M.positivity_methods(obs, START, methods)) == want


def test_latest_metrics_ages(spark):
    rows = [("r", START + datetime.timedelta(days=i), 1.0 * i if i < 5 else None, 2.0, float(i), 0.1) for i in range(30)]
    df = spark.createDataFrame(rows, "location_id string, date date, caseDensity double, testPositivityRatio double, infectionRate double, infectionRateCI90 double")
    r = M.latest_metrics(df, ["caseDensity", "testPositivityRatio", "infectionRate", "infectionRateCI90"]).first()
    assert r["caseDensity"] is None and r["testPositivityRatio"] == 2.0 and r["infectionRate"] == 22.0


def test_weights_by_default_and_by_field(spark):
    """Ratios are means by population without being listed; a field may have a weight of its own."""
    ds = make_dataset(
        spark, {"a": {"test_positivity_7d": [0.1], "cases": [5], "use": [0.5]}, "b": {"test_positivity_7d": [0.3], "cases": [7], "use": [1.0]}},
        {"a": {"population": 100, "beds": 30}, "b": {"population": 300, "beds": 10}})
    area = spark.createDataFrame([("a", "p"), ("b", "p")], "location_id string, parent_id string")
    out = {r["variable"]: r["value"] for r in R.aggregate_regions(ds, area).obs.collect()}
    assert out["cases"] == 12 and abs(out["test_positivity_7d"] - 0.25) < 1e-12 and out["use"] == 1.5
    out = {r["variable"]: r["value"] for r in R.aggregate_regions(ds, area, weighted={"use": "beds", "test_positivity_7d": "population"}).obs.collect()}
    assert abs(out["use"] - 0.625) < 1e-12 and abs(out["test_positivity_7d"] - 0.25) < 1e-12


def test_undeclared_names_fail(spark):
    """A list that names the columns of a result must hold all names in the data."""
    from geotally.operators import qa

    rows = spark.createDataFrame([("r", START, "x", 1.0), ("r", START, "y", 2.0)], "location_id string, date date, source string, value double")
    assert qa.source_comparison(rows, ["x", "y"]).first()["y"] == 2
    with pytest.raises(Exception, match="undeclared source"):
        qa.source_comparison(rows, ["x"]).collect()


def test_padding_never_shortens(spark):
    from pyspark.sql import functions as F

    from geotally.functions import regions

    got = spark.createDataFrame([(0,), (1,), (1001,), (4805000,)], "n int").select(regions.fips_from_int(F.col("n")), regions.hsa_code(F.col("n"))).collect()
    assert [tuple(r) for r in got] == [("0", "000"), ("01", "001"), ("01001", "1001"), ("4805000", "4805000")]
