"""Quality filters: literal cases, tags, invariants."""
import datetime
import json

import pytest
from pyspark.sql import functions as F

from geotally.functions import tagtext as T
from geotally.operators import quality as Q
from tests.conftest import START, make_dataset, make_obs, near, series

N = None
RISING = [100000 + 1000 * i for i in range(24)]


def tags(ds):
    return sorted((r["location_id"], r["variable"], r["tag_type"], r["content"]) for r in ds.tags.collect())


def run_tail(spark, values):
    out, counts = Q.tail_filter(make_dataset(spark, {"r": {"cases": values}}))
    return series(out.obs, n=len(values)), tags(out), {r["outcome"]: r["n"] for r in counts.collect()}


def test_tail_short(spark):
    values, found, counts = run_tail(spark, RISING + [123000] * 4)
    assert values[:24] == RISING and values[24:] == [N] * 4 and counts == {"truncated": 1}
    day24 = (START + datetime.timedelta(days=23)).isoformat()
    assert found == [("r", "cases", T.CUMULATIVE_TAIL, f'{{"date": "{day24}", "original_observation": 123000.0}}')]


def test_tail_too_short(spark):
    values = RISING[1:] + [123000] * 4
    got, found, counts = run_tail(spark, values)
    assert got == values and not found and counts == {"skipped_too_short": 1}


def test_tail_null_mean(spark):
    values = [100000] + [N] * 14 + [100000 + 1000 * i for i in range(14)]
    got, found, counts = run_tail(spark, values)
    assert got == values and not found and counts == {"skipped_na_mean": 1}


def test_tail_negative(spark):
    values = [100000 + 1000 * i for i in range(28)] + [126000, 127000, 127000]
    got, found, _ = run_tail(spark, values)
    assert got[:-1] == values[:-1] and got[-1] is None and found[0][2] == T.CUMULATIVE_TAIL


@pytest.mark.parametrize("n", [6, 7, 8, 13, 14, 16])
def test_tail_long(spark, n):
    values = [100000 + 1000 * i for i in range(28)] + [127000] * n
    got, found, _ = run_tail(spark, values)
    cut = min(n, 14)
    assert got == values[:-cut] + [N] * cut
    assert found[0][2] == (T.CUMULATIVE_TAIL if n < 8 else T.CUMULATIVE_LONG_TAIL)


def test_tail_scope_is_that_of_the_group(spark):
    """A location whose group ends later counts back from the end of the group."""
    ds = make_dataset(spark, {"r": {"cases": RISING + [123000] * 4}, "other": {"x": [1] * 60}})
    alone = spark.createDataFrame([("r", START, START + datetime.timedelta(days=27))], "location_id string, first date, last date")
    assert Q.tail_filter(ds)[1].collect()[0]["outcome"] == "skipped_na_mean"
    assert Q.tail_filter(ds, scope=alone)[1].collect()[0]["outcome"] == "truncated"


def test_outlier_std_zero(spark):
    ds = make_dataset(spark, {"r": {"new_cases": [10] * 7 + [1000]}})
    out = Q.drop_series_outliers(ds, "new_cases")
    assert series(out.obs) == [10] * 7
    assert json.loads(tags(out)[0][3]) == {"date": "2020-04-08", "original_observation": 1000.0}


@pytest.mark.parametrize("limit,kept", [(30, 8), (29, 7)])
def test_outlier_value_threshold(spark, limit, kept):
    ds = make_dataset(spark, {"r": {"new_cases": [1] * 7 + [30]}})
    assert Q.drop_series_outliers(ds, "new_cases", min_value=limit).obs.count() == kept


def test_outlier_exempt_day(spark):
    start = datetime.date(2021, 6, 28)
    ds = make_dataset(spark, {"r": {"new_cases": [10] * 7 + [1000]}}, start=start)
    assert Q.drop_series_outliers(ds, "new_cases").obs.count() == 8


def test_tail_ratio(spark):
    ds = make_dataset(spark, {"r": {"q": [0.1, 0.11, 0.1, 0.11, 0.1, 0.11, 0.1, 0.9]}, "s": {"q": [0.1, 0.11, 0.1, 0.11, 0.1, 0.11, 0.1, 0.11]}})
    out = Q.drop_tail_ratio_outliers(ds, "q")
    assert len(series(out.obs, "r")) == 7 and len(series(out.obs, "s")) == 8
    assert [t[0] for t in tags(out)] == ["r"]


def geo(spark):
    rows = [("tx", "48", "TX", "state"), ("c1", "48197", "TX", "county"), ("c2", "48201", "TX", "county"), ("az", "04", "AZ", "state")]
    return spark.createDataFrame(rows, "location_id string, fips string, state string, level string")


def test_manual_block_from_date(spark):
    start = datetime.date(2021, 2, 10)
    ds = make_dataset(spark, {"c1": {"cases": [4, 5, 6, 7, 8]}, "az": {"cases": [1, 2, 3, 4, 5]}}, start=start)
    rule = Q.Rule("state = 'TX'", ["cases"], True, "note", start=datetime.date(2021, 2, 12))
    out = Q.manual_filter(ds, geo(spark), [rule])
    assert series(out.obs, "c1", start=start) == [4, 5] and len(series(out.obs, "az", start=start)) == 5
    assert tags(out) == [("c1", "cases", T.KNOWN_ISSUE, '{"public_note":"note","date":"2021-02-12"}')]


def test_manual_rules_apply_in_order(spark):
    """A later rule does not see what an earlier one dropped, and a full block clears old tags."""
    ds = make_dataset(spark, {"c1": {"cases": {"all": [1, 2, 3], "age:0-9": [7, 8, 9]}}}, tags=[("c1", "cases", "all", "provenance", "p")])
    full = Q.Rule("location_id = 'c1'", ["cases"], True, "all")
    late = Q.Rule("state = 'TX'", ["cases"], True, "late", start=START)
    out = Q.manual_filter(ds, geo(spark), [full, late])
    assert series(out.obs, "c1") == [] and series(out.obs, "c1", bucket="age:0-9") == [7, 8, 9]
    assert tags(out) == [("c1", "cases", T.KNOWN_ISSUE_NO_DATE, '{"public_note":"all"}')]
    back = Q.manual_filter(ds, geo(spark), [late, full])
    assert [t[2] for t in tags(back)] == [T.KNOWN_ISSUE, T.PROVENANCE]


def test_manual_bad_rule(spark):
    with pytest.raises(ValueError, match="neither drops"):
        Q.manual_filter(make_dataset(spark, {"c1": {"x": [1]}}), geo(spark), [Q.Rule("true", ["x"], False)])


def test_manual_removed_plus_kept_is_input(spark):
    ds = make_dataset(spark, {"c1": {"cases": [1, 2, 3, 4]}, "c2": {"cases": [5, 6, 7, 8]}})
    rules = [Q.Rule("fips = '48197'", ["cases"], True, "x", end=START + datetime.timedelta(days=1))]
    out = Q.manual_filter(ds, geo(spark), rules)
    touched = Q.touched_subset(ds, out)
    assert out.obs.count() == 6 and {r["location_id"] for r in touched.obs.collect()} == {"c1"}


def test_anomaly_subregions(spark):
    from geotally.operators.combine import explode_subregions

    day2 = START + datetime.timedelta(days=1)
    rules = spark.createDataFrame([("tx", day2, day2, "cases", False, True)], "location_id string, start date, end date, kind string, own boolean, subregions boolean")
    parents = spark.createDataFrame([("c1", "tx")], "location_id string, parent_id string")
    x = explode_subregions(rules, parents).select("location_id", F.concat(F.lit("new_"), "kind").alias("variable"), "start", "end", F.lit("n").alias("note"))
    out = Q.anomaly_filter(make_dataset(spark, {"tx": {"new_cases": [1, 2, 3]}, "c1": {"new_cases": [4, 5, 6]}}), x)
    assert series(out.obs, "tx") == [1, 2, 3] and series(out.obs, "c1") == [4, N, 6]
    assert [t[0] for t in tags(out)] == ["c1"]


def test_zero_filter_keeps_tags(spark):
    ds = make_dataset(spark, {"r": {"a": [0, N, 0], "b": [0, 0, 0]}, "s": {"a": [0, 1, 0]}}, tags=[("r", "a", "all", "provenance", "p")])
    out = Q.drop_all_zero_series(ds, ["a"])
    assert {(r["location_id"], r["variable"]) for r in out.obs.collect()} == {("r", "b"), ("s", "a")} and len(tags(out)) == 1
