"""Declared sources in one scan, files with reports of what they drop."""
import datetime

import pytest
from pyspark.sql import functions as F

from geotally.operators import filters
from geotally.sources import files, provider, registry
from tests.conftest import START, make_dataset

COUNTY, OTHER, STATE = "iso1:us#iso2:us-fl#fips:12001", "iso1:us#iso2:us-al#fips:01001", "iso1:us#iso2:us-al"


@pytest.fixture(scope="module")
def geo(spark):
    return spark.createDataFrame([(COUNTY, "12001", "FL", "county"), (OTHER, "01001", "AL", "county"), (STATE, "01", "AL", "state")], "location_id string, fips string, state string, level string")


def fact(spark, rows, path):
    """rows: provider, variable, measurement, unit, location, day, value."""
    full = [(p, START + datetime.timedelta(days=day), 0, "x", loc, v, m, u, "all", "all", "all", "all", value, "", "", None) for p, v, m, u, loc, day, value in rows]
    spark.createDataFrame(full, provider.FACT_SCHEMA).write.parquet(str(path))
    return spark.read.schema(provider.FACT_SCHEMA).parquet(str(path))


DOSES = ("total_vaccine_distributed", "cumulative", "doses")


def test_labels_of_one_source_share_a_scan(spark, geo, tmp_path):
    rows = [("state", *DOSES, COUNTY, 0, 1.0), ("state", *DOSES, OTHER, 0, 2.0), ("cdc", *DOSES, OTHER, 0, 3.0), ("cdc", *DOSES, STATE, 0, 4.0), ("nyt", "cases", "cumulative", "people", OTHER, 0, 5.0)]
    table = fact(spark, rows, tmp_path / "fact")
    features = {"vaccines_distributed": ["CDCVaccine:counties", "StateDashboards:no-fl", "StateDashboards", "CDCVaccine:no-boosters"], "cases": ["NYTimes"]}
    obs, tags = registry.load_features(table, geo, features=features)
    got = {(r["source"], r["location_id"], r["value"]) for r in obs.collect()}
    assert got == {
        ("CDCVaccine:counties", OTHER, 3.0), ("StateDashboards:no-fl", OTHER, 2.0), ("StateDashboards", COUNTY, 1.0), ("StateDashboards", OTHER, 2.0),
        ("CDCVaccine:no-boosters", STATE, 4.0), ("NYTimes", OTHER, 5.0)}
    assert {r["source"] for r in tags.collect()} == {s for s, *_ in got}
    # the fact table is read when the matched rows are written, and never again; sources without steps share a scan
    again, _ = registry.load_features(table, geo, features=features)
    assert all("/matched-" in f for f in again.inputFiles()) and again._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_unknown_names_fail_before_anything_runs(spark, geo):
    none = spark.createDataFrame([], provider.FACT_SCHEMA)
    with pytest.raises(ValueError, match="unknown mask"):
        registry.load_features(none, geo, features={"cases": ["NYTimes:nowhere"]})
    with pytest.raises(ValueError, match="unknown source"):
        registry.load_features(none, geo, features={"cases": ["Nobody"]})


def test_a_connector_fails_on_repeated_keys(spark, geo, tmp_path):
    table = fact(spark, [("nyt", "cases", "cumulative", "people", OTHER, 0, 5.0)] * 2, tmp_path / "twice")
    with pytest.raises(Exception, match="duplicate key"):
        registry.load_features(table, geo, features={"cases": ["NYTimes"]})[0].collect()


def test_combined_positivity(spark, geo, tmp_path):
    spec = ("pcr_tests_positive", "rolling_average_7_day", "percentage")
    capital = registry.CAPITAL_COUNTY
    rows = [("cdc2", *spec, capital, 0, 50.0), ("cdc2", *spec, capital, 1, 0.0), ("cdc_originally_posted", *spec, capital, 0, 10.0), ("cdc_originally_posted", *spec, capital, 2, 20.0)]
    got = {(r["location_id"], r["date"].day, r["value"]) for r in registry.load_source("CDCCombinedTesting", fact(spark, rows, tmp_path / "p"), geo, {}).obs.collect()}
    # the trailing zero of the one source is no value, so the other one fills later days
    assert got == {(p, day, v) for p in (capital, "iso1:us#iso2:us-dc") for day, v in ((1, 0.5), (3, 0.2))}


def test_file_source(spark, geo, tmp_path):
    path = tmp_path / "tracers.csv"
    path.write_text("fips,date,state,contact_tracers_count,color\n12001,2020-04-01,FL,7,red\n12001,2019-12-31,FL,3,red\n99999,2020-04-01,XX,1,blue\n01001,2020-04-02,AL,NaN,red\n")
    ds, reports = files.TEST_AND_TRACE.load(spark, str(path), geo)
    assert [(r["location_id"], r["value"]) for r in ds.obs.collect()] == [(COUNTY, 7.0)]
    old, unknown = reports["old"], reports["unknown"]
    assert (old.get()["rows"], old.get()["dropped"], old.extra, old.missing) == (4, 1, ["color"], [])
    assert "2019-12-31" in old.get()["sample"][0] and len(old.get()["sample"]) == 1
    assert unknown.get()["dropped"] == 1 and "99999" in unknown.get()["sample"][0]
    assert [r["content"] for r in ds.tags.collect()] == ['{"type":"TestAndTrace"}']


def test_file_source_without_its_field(spark, geo, tmp_path):
    path = tmp_path / "other.csv"
    path.write_text("fips,date,color\n12001,2020-04-01,red\n")
    ds, reports = files.TEST_AND_TRACE.load(spark, str(path), geo)
    assert ds.obs.count() == 0 and reports["old"].missing == ["contact_tracers_count"]


def test_reports_cost_no_scan(spark):
    df = spark.range(100).withColumn("date", F.expr("date_add(date'2019-12-30', cast(id % 4 as int))"))
    kept, report = filters.drop_old_dates_reported(df, ["id", "date"])
    text = kept._jdf.queryExecution().executedPlan().toString()
    assert text.count("Range (") == 1 and "Exchange" not in text
    assert kept.count() == 50
    assert (report.get()["rows"], report.get()["dropped"], len(report.get()["sample"])) == (100, 50, 3)


def test_report_of_regions_without_population(spark):
    ds = make_dataset(spark, {"a": {"x": [1, 2]}, "b": {"x": [3]}}, {"a": {"population": 5}})
    kept, report = filters.drop_regions_without_population_reported(ds)
    assert {r["location_id"] for r in kept.obs.collect()} == {"a"}
    assert report.get()["dropped"] == 1 and '"b"' in report.get()["sample"][0]
