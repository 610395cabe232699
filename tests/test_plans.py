"""Properties of plans and sources that matter at scale."""
import datetime
import pathlib
import re

import pytest
from pyspark.sql import functions as F

from geotally.operators import layout, measures, rollup, windows
from geotally.sources import provider, readers, writers
from tests.conftest import make_dataset, make_obs

ROOT = pathlib.Path(__file__).parent.parent / "geotally"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


def test_a_chain_of_windows_shares_one_exchange(spark):
    obs = make_obs(spark, {"r": {"x": [1, 0, 3]}})
    chained = windows.smooth_rolling_mean(windows.trim_trailing_zeros(windows.spread_after_stall(obs), drop_all_zero=False))
    assert exchanges(chained) == 1
    assert exchanges(windows.interpolate_stalled(obs)) == 1


def test_positivity_needs_two_exchanges(spark):
    obs = make_obs(spark, {"r": {"p": [1, 2, 3], "n": [1, 2, 4]}})
    assert exchanges(measures.positivity_smoothed(obs.filter("variable = 'p'"), obs.filter("variable = 'n'"))) == 2


def test_positivity_methods_share_one_scan(spark, tmp_path):
    path = str(tmp_path / "obs")
    make_obs(spark, {"r": {"p": [1, 2, 3], "n": [1, 2, 4], "g": [0.5]}}).write.parquet(path)
    methods = [
        measures.Method("SmoothedTests", ["p", "n"], measures.smoothed_tests("p", "n"), 10, True),
        measures.Method("Given", ["g"], measures.pass_through("g")),
        measures.Method("Delta", ["p", "n"], measures.division("p", "n")),
    ]
    best = measures.positivity_best(measures.positivity_methods(spark.read.parquet(path), datetime.date(2024, 1, 3), methods))
    assert exchanges(best) == 2 and plan(best).count("FileScan") == 1


def test_latest_is_a_hash_aggregate_without_sort(spark):
    p = plan(rollup.latest_values(make_obs(spark, {"r": {"x": [1]}})))
    assert "HashAggregate" in p and "Sort" not in p and "Window" not in p


def test_single_parent_rollup_has_no_cross_join(spark):
    ds = make_dataset(spark, {"a": {"x": [1]}}, {"a": {"population": 1}})
    p = plan(rollup.aggregate_regions(ds, spark.createDataFrame([("a",)], "location_id string"), parent="us", coverage=0.5).obs)
    assert "CartesianProduct" not in p and "NestedLoop" not in p


def test_snapshot_prunes_folders_and_columns(spark, tmp_path):
    ds = make_dataset(spark, {"r": {"x": [1, 2], "y": [3]}})
    writers.snapshot(ds, str(tmp_path / "s"))
    p = plan(readers.snapshot(spark, str(tmp_path / "s")).obs.filter("variable = 'x' and value > 1").select("date"))
    assert re.search(r"PartitionFilters: \[[^\]]*variable", p) and "GreaterThan(value,1.0)" in p
    assert re.search(r"ReadSchema: struct<date:date,value:double>", p)


def test_provider_names_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "fact")
    spark.createDataFrame([], provider.FACT_SCHEMA).write.parquet(path)
    ds = provider.query_variables(readers.parquet_long(spark, path), [("p", "v", "m", "u", "f")], "T")
    p = plan(ds.obs)
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(provider,p\)|PushedFilters: \[[^\]]*In\(provider", p)
    assert "race" in p and "last_updated" not in p


def test_rollup_combines_before_the_shuffle(spark):
    ds = make_dataset(spark, {"a": {"x": [1]}}, {"a": {"population": 1}})
    m = spark.createDataFrame([("a", "p")], "location_id string, parent_id string")
    assert "partial_sum" in plan(rollup.aggregate_regions(ds, m).obs)


@pytest.mark.parametrize("word", ["crossJoin", "localCheckpoint", ".cache(", ".persist(", "toPandas", "udf(", ".rdd"])
def test_words_not_used(word):
    hits = [str(p) for p in ROOT.rglob("*.py") if "llm" not in p.parts and word in p.read_text()]
    assert not hits


def test_nothing_is_collected_in_operators():
    hits = [str(p) for p in (ROOT / "operators").glob("*.py") if ".collect()" in p.read_text()]
    assert not hits


def test_duplicates_of_one_key_meet_map_side(spark):
    """A third of all rows are copies of one key; the check counts them in parallel."""
    from geotally.operators import qa

    df = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("location_id"), F.lit("2020-01-01").cast("date").alias("date"), F.col("id").cast("double").alias("v"))
    out = qa.diff_prepare(df)
    assert "partial_count" in plan(out) and "Window" not in plan(out)
    assert out.count() == 600
