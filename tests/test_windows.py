"""Series operators on literal inputs with full expected outputs."""
import datetime

import pytest

from geotally.operators import layout, measures, windows
from tests.conftest import START, make_dataset, make_obs, near, series

N = None


def test_incident(spark):
    """Differences of neighbouring days; a fall is no value, but a fall by one counts as none."""
    obs = make_obs(spark, {"a": {"c": [0, 4, 4]}, "b": {"c": [3, 10]}, "c": {"c": [1]}, "d": {"c": [60, 40, 45, 44]}, "e": {"c": [7, N, 9, 15]}})
    out = windows.incident_from_cumulative(obs, {"c": "new"})
    assert {r["variable"] for r in out.collect()} == {"new"}
    want = {"a": [N, 4, 0], "b": [N, 7], "c": [], "d": [N, N, 5, 0], "e": [N, N, N, 6]}
    for name, values in want.items():
        assert near(series(out, name, n=len(values)), values)


SPREAD = [
    ([N, 3, 0, 0, 9, 1], [N, 3, 3, 3, 3, 1], 14),
    ([0, 0, 8, 0, 4], [0, 0, 8, 2, 2], 14),  # zeros before the first report are no stall
    ([7, 0, 0, 0, 0, 20, 0], [7, 4, 4, 4, 4, 4, 0], 14),  # nor are those at the end
    ([6, 0, 0, 0, 9, 2], [6, 0, 3, 3, 3, 2], 3),
    ([2, 0, 1, 0, 0, 6], [2, 0.5, 0.5, 2, 2, 2], 14),
]


@pytest.mark.parametrize("given,expected,limit", SPREAD)
def test_spread(spark, given, expected, limit):
    out = windows.spread_after_stall(make_obs(spark, {"r": {"x": given}}), limit)
    assert near(series(out, n=len(given)), expected)


def test_smooth(spark):
    obs = make_obs(spark, {"r": {"x": [2, 4, 6, 0]}})
    assert near(series(windows.smooth_rolling_mean(obs, 2)), [2, 3, 5, 3])
    assert near(series(windows.smooth_rolling_mean(obs, 2, include_trailing_zeros=False)), [2, 3, 5])


def test_interpolate(spark):
    """A repeated value becomes a point of the line to the next one, unless nothing follows."""
    obs = make_obs(spark, {"r": {"x": [N, 3, 5, 5, 9, N]}, "s": {"x": [4, 6, 6]}})
    out = windows.interpolate_stalled(obs)
    assert near(series(out, "r"), [N, 3, 5, 7, 9]) and near(series(out, "s"), [4, 6, 6])


def test_rolling_sum_needs_all_days(spark):
    out = windows.rolling_sum(make_obs(spark, {"r": {"x": [2] * 7 + [N] + [2] * 8}}))
    assert near(series(out), [N] * 6 + [14] + [N] * 7 + [14, 14])


def test_fill(spark):
    obs = make_obs(spark, {"r": {"x": [5, N, N, N, 7]}, "s": {"x": [N, 3, N]}, "t": {"x": [N] * 5 + [1]}})
    out = windows.locf_fill(obs)
    assert near(series(out, "r"), [5, 5, 5, 5, 7, 7])
    assert near(series(out, "s"), [N, 3, 3, 3, 3, 3])
    assert near(series(windows.locf_fill_limited(obs, 1), "r"), [5, 5, N, N, 7, 7])


def test_case_density(spark):
    """Means of two days per ten of a hundred people: the stall shares its 60, the last zero is dropped."""
    obs = make_obs(spark, {"r": {"new": [0, 10, 30, 0, N, 60, 0]}})
    pop = spark.createDataFrame([("r", 100.0)], "location_id string, population double")
    assert near(series(measures.case_density(obs, pop, days=2, per=10)), [0, 0.5, 2, 3, N, 3])


def test_case_density_leading_zeros(spark):
    obs = make_obs(spark, {"r": {"new": [N, 21]}})
    pop = spark.createDataFrame([("r", 100000.0)], "location_id string, population double")
    first = spark.createDataFrame([("r", START)], "location_id string, first date")
    assert near(series(measures.case_density(obs, pop, first)), [0, 10.5])


def test_numbers_that_are_none(spark):
    """NaN is a missing observation in layouts and for the latest value."""
    from geotally.operators import rollup

    wide = spark.createDataFrame([("r", "all", START, 1.0, float("nan"))], "location_id string, bucket string, date date, a double, b double")
    assert [r["variable"] for r in layout.to_long(wide, ["a", "b"]).collect()] == ["a"]
    obs = make_obs(spark, {"r": {"x": [4, float("nan")]}})
    assert rollup.latest_values(obs).first()["value"] == 4


def test_densify(spark):
    obs = make_obs(spark, {"r": {"x": [1, N, 3]}, "s": {"x": [N, N, N, 5]}})
    assert layout.densify_calendar(obs).count() == 8
    assert layout.densify_per_series(obs).count() == 4


def test_best_lag(spark):
    base = [0, 1, 5, 2, 8, 3, 9, 1, 7, 4, 6, 2, 11, 3, 5, 8, 1, 4, 9, 2]
    days = [START + datetime.timedelta(days=i) for i in range(len(base))]
    moved = [N, N, N] + base[:-3]
    df = spark.createDataFrame([("r", d, float(m) if m is not None else None, float(b)) for d, m, b in zip(days, moved, base)], "location_id string, date date, a double, b double")
    assert windows.best_lag_xcorr(df).first()["shift"] == 3


def test_vaccine_pct(spark):
    """Counts over population, or the reported share, both held at 95."""
    people = {"population": 2000}
    ds = make_dataset(spark, {"r": {"vaccinations_initiated": [1000, 1980]}, "s": {"vaccinations_initiated_pct": [20, 99]}}, {"r": people, "s": people})
    out = measures.vaccine_pct(ds)
    assert near(series(out, "r", "vaccinations_initiated_pct"), [50, 95])
    assert near(series(out, "s", "vaccinations_initiated_pct"), [20, 95])


def test_vaccine_pct_freshness(spark):
    """The reported share is used unless the counts go further."""
    ds = make_dataset(spark, {"r": {
        "vaccinations_initiated": [40, 50, 60], "vaccinations_initiated_pct": [9, 11, 13],
        "vaccinations_completed": [20, 30, 40], "vaccinations_completed_pct": [5, 7, N]}}, {"r": {"population": 200}})
    out = measures.vaccine_pct(ds)
    assert near(series(out, "r", "vaccinations_initiated_pct"), [9, 11, 13])
    assert near(series(out, "r", "vaccinations_completed_pct"), [10, 15, 20])


def test_ecdf_matches_plain_ranks(spark):
    values = [float((i * i) % 53) for i in range(400)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r["v"]: r["share"] for r in windows.ecdf(df, "v", parts=7).collect()}
    assert got == pytest.approx({v: sum(x <= v for x in values) / len(values) for v in set(values)})


def test_hot_series_is_bounded_by_calendar(spark):
    """One key with a third of all raw records still enters a window with one row per day."""
    from pyspark.sql import functions as F

    raw = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 50).cast("string"))).alias("location_id"), (F.col("id") % 10).cast("int").alias("d"))
    obs = raw.groupBy("location_id", F.date_add(F.lit(START), F.col("d")).alias("date")).agg(F.count("*").cast("double").alias("value")).withColumns({"variable": F.lit("n"), "bucket": F.lit("all")})
    assert obs.filter("location_id = 'hot'").count() <= 10
    assert windows.smooth_rolling_mean(obs).count() == obs.count()
