"""The cleaning run on a literal dataset."""
import datetime

from geotally.operators import quality as Q
from geotally.plans import flow as FL
from tests.conftest import START, make_dataset, series

N = None


def geo(spark):
    rows = [("s", "48", "TX", "state"), ("c1", "48001", "TX", "county"), ("c2", "48003", "TX", "county"), ("c3", "48005", "TX", "county")]
    return spark.createDataFrame(rows, "location_id string, fips string, state string, level string")


def parents(spark):
    return spark.createDataFrame([("c1", "s"), ("c2", "s"), ("c3", "s")], "location_id string, parent_id string")


def test_clean_in_order(spark):
    as_of = START + datetime.timedelta(days=39)
    rising = [100.0 * i for i in range(40)]
    ds = make_dataset(spark, {
        "s": {"cases": rising, "new_hospital_admissions_covid": [1] * 40, "vaccinations_initiated": [200] * 40, "vaccinations_completed": [100] * 40},
        "c1": {"cases": rising[:30] + [2900] * 10 + [5000], "new_hospital_admissions_covid": [1] * 40, "vaccinations_completed": [50] * 40},
        "c2": {"cases": rising, "vaccines_administered": [0] * 40},
        "c3": {"cases": rising}}, {"s": {"population": 100}, "c1": {"population": 10}, "c2": {"population": 10}})
    rule = Q.Rule("location_id = 'c2'", ["cases"], True, "blocked")
    out, touched = FL.clean(ds, geo(spark), parents(spark), None, FL.Config(as_of=as_of, rules=[rule]))
    found = {(r["location_id"], r["variable"]) for r in out.obs.collect()}
    assert ("c2", "cases") not in found and ("c2", "vaccines_administered") not in found
    assert not any(loc == "c3" for loc, _ in found)
    assert series(out.obs, "c1", "cases", n=41)[30:] == [N] * 11
    assert series(out.obs, "c1", "new_cases")[1:30] == [100.0] * 29
    assert series(out.obs, "c1", "vaccinations_initiated") == [100.0] * 40
    assert series(out.obs, "s", "weekly_new_hospital_admissions_covid")[6:] == [7.0] * 34
    assert ("c1", "weekly_new_hospital_admissions_covid") not in found
    tags = {(r["location_id"], r["variable"], r["tag_type"]) for r in out.tags.collect()}
    assert {("c1", "cases", "cumulative_long_tail_truncated"), ("c1", "vaccinations_initiated", "derived"), ("c1", "cases", "drop_future_observation")} <= tags
    assert {(r["location_id"], r["variable"]) for r in touched.obs.collect()} == {("c2", "cases")}


def test_special_regions(spark):
    ds = make_dataset(spark, {"s": {"x": [9]}, "c1": {"x": [1]}, "c2": {"x": [2]}}, {k: {"population": v} for k, v in {"c1": 1, "c2": 2}.items()} | {"s": {"population": 3, "name": "S"}})
    cfg = FL.Config(as_of=START, incidents={"cases": "new_cases"}, estimate=None, city=("location_id in ('c1', 'c2')", "city"), replace=("s", "c1"))
    out, _ = FL.clean(ds, geo(spark), parents(spark), None, cfg)
    assert series(out.obs, "city", "x") == [3.0] and series(out.obs, "c1", "x") == [9.0]


def test_two_states_with_all_steps(spark):
    """Each state is judged by its own calendar, and a spread range patches one state only."""
    day = lambda i: START + datetime.timedelta(days=i)
    where = spark.createDataFrame(
        [("s", "48", "TX", "state"), ("t", "06", "CA", "state")], "location_id string, fips string, state string, level string")
    none = spark.createDataFrame([], "location_id string, parent_id string")
    ratio = [0.10, 0.11] * 10 + [0.9]  # jumps at its end
    stalled = [0.0] + [10.0] * 8 + [0.0, 0.0, 30.0] + [10.0] * 4
    total = [sum(stalled[: i + 1]) for i in range(len(stalled))]
    ds = make_dataset(spark, {
        "s": {"test_positivity_7d": ratio, "cases": total},
        "t": {"test_positivity_7d": [0.1] * 40, "cases": total}}, {"s": {"population": 10}, "t": {"population": 10}})
    anomalies = spark.createDataFrame([("s", "new_cases", day(11), day(11), "late"), ("s", "new_cases", day(13), day(13), "odd")], "location_id string, variable string, start date, end date, note string")
    cfg = FL.Config(
        as_of=day(60), cumulative=[], estimate=None, weekly={}, outliers={}, spread_ranges=[("state = 'TX'", "new_cases", day(8), day(11))],
        anomalies_exempt=f"location_id = 's' and date = DATE '{day(11)}'")
    out, _ = FL.clean(ds, where, none, anomalies, cfg)
    assert len(series(out.obs, "s", "test_positivity_7d")) == 20
    assert [(r["location_id"], r["variable"]) for r in out.tags.filter("tag_type = 'zscore_outlier'").collect()] == [("s", "test_positivity_7d")]
    assert series(out.obs, "s", "new_cases", n=14)[8:] == [10.0, 10.0, 10.0, 10.0, 10.0, N]
    assert series(out.obs, "t", "new_cases", n=14)[8:] == [10.0, 0.0, 0.0, 30.0, 10.0, 10.0]


def test_a_derived_variable_must_be_new(spark):
    import pytest

    ds = make_dataset(spark, {"s": {"cases": [1, 2, 4], "new_cases": [1, 1, 2]}}, {"s": {"population": 10}})
    with pytest.raises(Exception, match="not disjoint"):
        FL.clean(ds, geo(spark), parents(spark), None, FL.Config(as_of=START + datetime.timedelta(days=9), estimate=None, weekly={}))


def test_all_metrics_of_a_county_and_a_state(spark):
    """A county reads its HSA, a state itself; a provided figure goes before a calculated one; zero cases give no ratio."""
    own = {"current_hospitalized": [4] * 10, "staffed_beds": [8] * 10, "weekly_new_hospital_admissions_covid": [3] * 10}
    hsa = {"current_hospitalized_hsa": [1] * 10, "staffed_beds_hsa": [10] * 10, "weekly_new_hospital_admissions_covid_hsa": [5] * 10}
    ds = make_dataset(spark, {
        "s": own | hsa | {"vaccinations_completed_pct": [50] * 10, "test_positivity": [0.1234] * 10},
        "c1": own | hsa | {"new_cases": [N, N, N, N, N, 14, 14], "contact_tracers_count": [10] * 10, "beds_with_covid_patients_ratio_hsa": [0.5]}},
        {"s": {"population": 100_000}, "c1": {"population": 50_000, "hsa_population": 200_000}})
    rows = {(r["location_id"], (r["date"] - START).days): r for r in FL.metrics(ds, geo=geo(spark)).collect()}
    assert len(rows) == 20
    s, c = rows["s", 0], rows["c1", 0]
    assert (s["bedsWithCovidPatientsRatio"], s["weeklyCovidAdmissionsPer100k"], s["vaccinationsCompletedRatio"], s["testPositivityRatio"]) == (0.5, 3.0, 0.5, 0.123)
    assert (c["bedsWithCovidPatientsRatio"], rows["c1", 1]["bedsWithCovidPatientsRatio"], c["weeklyCovidAdmissionsPer100k"]) == (0.5, 0.1, 2.5)
    assert s["caseDensity"] is None and c["caseDensity"] == 0.0 and c["contactTracerCapacityRatio"] is None
    assert rows["c1", 6]["caseDensity"] == 8.0 and rows["c1", 6]["weeklyNewCasesPer100k"] == 56.0
    assert rows["c1", 6]["contactTracerCapacityRatio"] == 0.5 and rows["c1", 7]["contactTracerCapacityRatio"] is None


def test_a_given_positivity_and_rate(spark):
    ds = make_dataset(spark, {"s": {"new_cases": [7] * 8, "test_positivity": [0.9] * 8}}, {"s": {"population": 100_000}})
    day = lambda i: START + datetime.timedelta(days=i)
    given = spark.createDataFrame([("s", day(2), 0.25)], "location_id string, date date, value double")
    rate = spark.createDataFrame([("s", day(2), 1.1, 1.3), ("s", day(99), 1.0, 1.2)], "location_id string, date date, Rt_MAP_composite double, Rt_ci95_composite double")
    found = {(r["date"] - START).days: r for r in FL.metrics(ds, rt=rate, positivity=given).collect()}
    assert sorted(found) == list(range(8))
    assert [found[i]["testPositivityRatio"] for i in (1, 2)] == [None, 0.25]
    assert (found[2]["infectionRate"], found[2]["infectionRateCI90"], found[3]["infectionRate"]) == (1.1, 0.2, None)


def test_metrics_without_any_row(spark):
    ds = make_dataset(spark, {"s": {"new_cases": [1]}}, {"s": {"population": 10}})
    empty = ds.with_obs(ds.obs.limit(0))
    out = FL.metrics(empty, geo=geo(spark))
    assert len(out.columns) == 15 and out.count() == 0


def test_files_of_regions_and_states(spark, tmp_path):
    """One file per region, the counties of a state together, no NaN as text anywhere, annotations in the record."""
    import json

    ds = make_dataset(spark, {
        "s": {"cases": [1, 2], "new_cases": [1, 2]}, "c1": {"cases": {"all": [1, float("nan")], "age:0-9": [3]}, "new_cases": [1, 1]}, "c2": {"new_cases": [5, 5]}},
        {k: {"population": 100_000} for k in ("s", "c1", "c2")}, [("c1", "cases", "all", "source", '{"type":"NYTimes","url":"u","name":"n"}')])
    where = geo(spark).selectExpr("*", "'USA' as country")
    daily = FL.materialize(FL.metrics(ds, geo=where), "metrics")
    FL.publish(where, FL.summaries(ds, where, daily), FL.daily_parts(ds, daily), str(tmp_path / "out"), by_region=True)

    def names(kind):
        return sorted(f"{p.parent.name.removeprefix('_level=')}/{p.name.removeprefix('_file=')}" for p in (tmp_path / "out" / kind).glob("_level=*/_file=*"))

    assert names("regions/timeseries_json") == ["county/48001.timeseries.json", "county/48003.timeseries.json", "state/TX.timeseries.json"]
    assert names("regions/timeseries_csv") == ["state/TX.timeseries.csv"]
    assert names("states/summary_csv") == ["county/TX.csv"] and names("states/timeseries_json") == ["county/TX.timeseries.json"]
    lines = [x for p in (tmp_path / "out").rglob("*.json") if p.is_file() for x in p.read_text().splitlines()]
    assert lines and not any("NaN" in x for x in lines)
    single = next((tmp_path / "out/regions/timeseries_json/_level=county/_file=48001.timeseries.json").glob("*.json"))
    record = json.loads(single.read_text())
    assert [x.get("cases") for x in record["actualsTimeseries"]] == [1.0, None]
    assert record["annotations"]["cases"]["sources"][0]["type"] == "NYTimes"
    assert record["annotations"]["caseDensity"] == record["annotations"]["cases"]
    assert record["demographics"] == {"cases/age": {"0-9": 3.0}}
    both = [json.loads(x) for p in (tmp_path / "out/states/summary_json/_level=county/_file=TX.json").glob("*.json") for x in p.read_text().splitlines()]
    assert sorted(r["location_id"] for r in both) == ["c1", "c2"]


def test_no_nan_inside_arrays_and_maps(spark):
    from geotally.sources import writers as WR

    df = spark.sql("select array(named_struct('v', double('NaN')), named_struct('v', 1D)) as a, map('k', double('NaN'), 'l', 2D) as m, array(array(double('NaN'))) as b")
    row = WR.without_nan(df).first()
    assert [x["v"] for x in row["a"]] == [None, 1.0] and row["m"] == {"k": None, "l": 2.0} and row["b"] == [[None]]


def test_metrics_need_one_pivot(spark):
    """Observed inputs and derived series meet in one aggregation by region and day."""
    import re

    ds = make_dataset(spark, {"s": {"new_cases": [7] * 8}}, {"s": {"population": 100_000}})
    p = FL.metrics(ds)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Aggregate \[location_id#\d+, date#\d+\]", p)) == 1
