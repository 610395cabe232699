"""Derived measures: densities, ratios, percentages, positivity and the metrics table."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from itertools import zip_longest

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from geotally.functions import scalars as S, tagtext as T
from geotally.model import POINT, SERIES, TAG, Dataset, day, series_window, whole_series
from geotally.operators import combine as C, filters, windows as WN
from geotally.operators.levels import LOOKBACK, RT_DELAY
from geotally.operators.tags import make_tags

MAX_PERCENT = 95
RECENT_DAYS = 15
TRACERS_PER_CASE = 5
VACCINE_PAIRS = {
    "vaccinations_initiated": "vaccinations_initiated_pct", "vaccinations_completed": "vaccinations_completed_pct",
    "vaccinations_additional_dose": "vaccinations_additional_dose_pct",
    "vaccinations_2022_fall_bivalent_dose": "vaccinations_bivalent_dose_pct",
}
VACCINATION_METRICS = [
    "vaccinationsInitiatedRatio", "vaccinationsCompletedRatio", "vaccinationsAdditionalDoseRatio",
    "vaccinationsFall2022BivalentBoosterRatio",
]
# The observed fields that the ratios of the metrics table read.
METRIC_INPUTS = [
    "contact_tracers_count", "current_icu_total", "icu_beds", "beds_with_covid_patients_ratio_hsa", "current_hospitalized",
    "current_hospitalized_hsa", "staffed_beds", "staffed_beds_hsa", "weekly_new_hospital_admissions_covid",
    "weekly_new_hospital_admissions_covid_hsa", "weekly_new_hospital_admissions_covid_per_100k_hsa", "test_positivity",
    *VACCINE_PAIRS.values(),
]


def population_of(static: DataFrame, attr: str = "population") -> DataFrame:
    return static.filter((F.col("attr") == attr) & F.col("num").isNotNull()).select("location_id", F.col("num").alias(attr))


def rename_variable(obs: DataFrame, names: dict[str, str]) -> DataFrame:
    table = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return obs.filter(F.col("variable").isin(list(names))).withColumn("variable", F.element_at(table, F.col("variable")))


def vaccine_pct(ds: Dataset, pairs: dict[str, str] = VACCINE_PAIRS, top: float | None = MAX_PERCENT) -> DataFrame:
    """People as a percentage of the population, unless the provided series is as fresh.

    The whole series with the later last date wins; on a tie the provided one.
    """
    people = rename_variable(ds.obs, pairs).join(population_of(ds.static), "location_id")
    derived = people.select(*POINT, (F.try_divide("value", "population") * 100.0).alias("value"), F.lit(0).alias("given"))
    given = ds.obs.filter(F.col("variable").isin(list(pairs.values()))).select(*POINT, "value", F.lit(1).alias("given"))
    both = derived.unionByName(given).filter("value is not null")
    best = both.groupBy(*SERIES, "given").agg(F.max("date").alias("last")).groupBy(*SERIES).agg(
        F.max_by("given", F.struct("last", "given")).alias("given")
    )
    value = F.col("value") if top is None else S.cap(F.col("value"), top)
    pct = both.join(best, SERIES + ["given"], "left_semi").select(*POINT, value.alias("value"))
    return ds.obs.filter(~F.col("variable").isin(list(pairs.values()))).select(*POINT, "value").unionByName(pct)


def estimate_from_parent_ratio(
    ds: Dataset, parents: DataFrame, target: str, known: str, as_of: datetime.date, function: str, back: int = RECENT_DAYS,
) -> Dataset:
    """Children with recent ``known`` but no recent ``target``: known x the parent's daily ratio.

    An estimate replaces the value of its day; days without an estimate keep theirs. The series
    gets a derived tag.
    """
    recent = F.col("date").between(F.lit(as_of - datetime.timedelta(days=back)), F.lit(as_of))
    x = ds.obs.filter("bucket = 'all' and value is not null")
    t, k = F.col("variable") == target, F.col("variable") == known
    chosen = (
        x.filter(recent & (t | k)).join(parents.select("location_id"), "location_id", "left_semi").groupBy("location_id")
        .agg(F.bool_or(k).alias("has_known"), F.bool_or(t).alias("has_target")).filter("has_known and not has_target")
        .select("location_id")
    )
    ratio = (
        x.filter(t | k).join(parents.select(F.col("parent_id").alias("location_id")).distinct(), "location_id", "left_semi")
        .groupBy(F.col("location_id").alias("parent_id"), "date")
        .agg(F.try_divide(F.max(F.when(t, F.col("value"))), F.max(F.when(k, F.col("value")))).alias("ratio"))
    )
    est = (
        x.filter(k).join(chosen, "location_id", "left_semi").join(parents.select("location_id", "parent_id"), "location_id")
        .join(ratio, ["parent_id", "date"]).select(
            "location_id", F.lit(target).alias("variable"), "bucket", "date", (F.col("value") * F.col("ratio")).alias("_est"))
        .filter("_est is not null")
    )
    obs = ds.obs.join(est, POINT, "full").select(*POINT, F.coalesce("_est", "value").alias("value"))
    series = chosen.select("location_id", F.lit(target).alias("variable"), F.lit("all").alias("bucket"))
    return ds.with_obs(obs).add_tags(make_tags(series, T.DERIVED, T.derived_content(F.lit(function))))


def estimate_pct_from_parent_ratio(
    ds: Dataset, parents: DataFrame, administered: str, targets: dict[str, str],
) -> DataFrame:
    """Children's administered x the parent's (field / administered), per 100 people.

    ``targets``: parent's field to the name of the estimated percentage. A child that already has
    one of them fails the job.
    """
    x = ds.obs.filter("bucket = 'all' and value is not null")
    children = parents.select("location_id", "parent_id")
    ratios = (
        x.filter(F.col("variable").isin([administered, *targets]))
        .join(children.select(F.col("parent_id").alias("location_id")).distinct(), "location_id", "left_semi")
        .groupBy(F.col("location_id").alias("parent_id"), "date").pivot("variable", [administered, *targets]).agg(F.first("value"))
    )
    own = x.filter(F.col("variable") == administered).join(children, "location_id").join(ratios, ["parent_id", "date"]).join(
        population_of(ds.static), "location_id")
    est = own.select(
        "location_id", "bucket", "date",
        *[(F.col("value") * F.try_divide(f, administered) / F.col("population") * 100).alias(name) for f, name in targets.items()],
    ).unpivot(["location_id", "bucket", "date"], list(targets.values()), "variable", "value").filter("value is not null")
    present = ds.obs.join(children, "location_id", "left_semi").filter(F.col("variable").isin([*targets, *targets.values()]))
    taken = present.agg(F.count("value")).scalar()
    checked = F.when(taken > 0, F.raise_error(F.lit("targets are not empty")).cast("double")).otherwise(F.col("value"))
    return ds.obs.select(*POINT, "value").unionByName(est.withColumn("value", checked).select(*POINT, "value"))


def _leading_zeros(obs: DataFrame, first_days: DataFrame) -> DataFrame:
    """Zero rows from the first day of the location to the first value of the series."""
    start = obs.groupBy(*SERIES).agg(F.min("date").alias("_first")).join(
        first_days.select("location_id", F.col("first").alias("_start")), "location_id"
    ).filter(F.col("_start") < F.col("_first"))
    return start.select(*SERIES, F.explode(F.sequence("_start", F.date_sub("_first", 1))).alias("date"), F.lit(0.0).alias("value"))


def smoothed_daily(new: DataFrame, first_days: DataFrame | None = None, days: int = 7) -> DataFrame:
    """Trailing zeros cut, zeros before the first value, mean of the last days."""
    x = WN.trim_trailing_zeros(new, drop_all_zero=False).select(*POINT, "value")
    if first_days is not None:
        x = x.unionByName(_leading_zeros(x, first_days))
    return WN.smooth_rolling_mean(x, days)


def case_density(
    new: DataFrame, population: DataFrame, first_days: DataFrame | None = None, days: int = 7, per: int = 100_000,
) -> DataFrame:
    """Smoothed new cases, spread after stalls, per ``per`` people."""
    spread = WN.spread_after_stall(new).select(*POINT, "value")
    smooth = smoothed_daily(spread, first_days, days).join(population, "location_id")
    return smooth.select(*POINT, F.try_divide("value", F.col("population") / per).alias("value")).filter("value is not null")


def contact_tracer_ratio(new: DataFrame, tracers: DataFrame, per_case: int = TRACERS_PER_CASE) -> DataFrame:
    smooth = smoothed_daily(new).select("location_id", "date", F.col("value").alias("_cases"))
    return tracers.join(smooth, ["location_id", "date"]).select(
        "location_id", "date", F.try_divide("value", F.col("_cases") * per_case).alias("value")
    ).filter("value is not null")


def icu_capacity_ratio(wide: DataFrame) -> Column:
    return F.try_divide(F.col("current_icu_total"), F.col("icu_beds"))


def _by_area(is_county: Column, area: str, own: str) -> Column:
    return F.when(is_county, F.col(area)).otherwise(F.col(own))


def covid_patient_ratio(is_county: Column) -> Column:
    """External ratio, else patients per staffed bed; counties use the columns of their HSA."""
    return F.coalesce(
        F.col("beds_with_covid_patients_ratio_hsa"),
        F.try_divide(
            _by_area(is_county, "current_hospitalized_hsa", "current_hospitalized"),
            _by_area(is_county, "staffed_beds_hsa", "staffed_beds"),
        ),
    )


def weekly_admissions_per_100k(is_county: Column, per: int = 100_000) -> Column:
    own = F.try_divide(
        _by_area(is_county, "weekly_new_hospital_admissions_covid_hsa", "weekly_new_hospital_admissions_covid"),
        _by_area(is_county, "hsa_population", "population") / per,
    )
    return F.coalesce(F.col("weekly_new_hospital_admissions_covid_per_100k_hsa"), own)


# --- test positivity -------------------------------------------------------------------------


def positivity_smoothed(positive: DataFrame, negative: DataFrame, lookback: int = 7) -> DataFrame:
    """Positive / all tests from two cumulative series of bucket 'all'.

    A location gives nothing if it has recent positives but no recent negatives. Both series run
    through one chain of windows over the series key, so they share a single exchange; a second
    one brings the two values of a day together.
    """
    tagged = lambda df, role: df.withColumn("variable", F.lit(role))
    level = WN.interpolate_stalled(tagged(positive, "p").unionByName(tagged(negative, "n")))
    w = whole_series()
    new = level.withColumns({"_end": F.max("date").over(w), "new": F.col("value") - WN.previous_day()}).filter("new >= 0")
    is_p = F.col("variable") == "p"
    last = F.max(F.when(F.col("new") != 0, F.col("date"))).over(w)
    smooth = new.withColumns({"mean": F.avg("new").over(WN.days_back(lookback - 1)), "_last": last})
    kept = smooth.filter(is_p | F.col("_last").isNull() | (F.col("date") <= F.col("_last")))
    recent = F.datediff("_end", "date") < lookback
    flags = kept.withColumns({
        "zeros": F.count(F.when(recent & is_p & (F.col("mean") == 0), 1)).over(w),
        "negatives": F.count(F.when(recent & ~is_p, 1)).over(w),
    })
    of = lambda role, c: F.max(F.when(F.col("variable") == role, F.col(c)))
    days = flags.groupBy("location_id", "date").agg(
        of("p", "mean").alias("p"), of("n", "mean").alias("n"), of("p", "zeros").alias("zeros"), of("n", "negatives").alias("negatives"))
    skipped = (F.col("zeros") < lookback) & (F.col("negatives") == 0)
    return days.filter("p is not null and n is not null").filter(~skipped).select(
        "location_id", "date", F.try_divide(F.col("p"), F.col("n") + F.col("p")).alias("value")).filter("value is not null")


#: Expressions in stages: those of a stage read the observed values and the columns of the stages before it.
Stages = list[dict[str, Column]]
#: Methods run on a row per location and day, so their windows are those of a location.
HERE = ["location_id"]


def observed(variable: str) -> str:
    """The column of a variable's values in the frame on which methods run."""
    return f"_observed_{variable}"


@dataclass(frozen=True)
class Method:
    """A way to calculate positivity; plug in others by listing them.

    ``calculate`` takes the name of the result's column and gives the stages that lead to it. They read ``observed``
    columns of ``columns``, on every day from the first to the last of a location, null where nothing was reported.
    """

    name: str
    columns: list[str]
    calculate: Callable[[str], Stages]
    recent_days: int = 14
    recent_by_inputs: bool = False


def pass_through(column: str) -> Callable[[str], Stages]:
    return lambda out: [{out: F.col(observed(column))}]


def division(numerator: str, denominator: str, days: int = 7) -> Callable[[str], Stages]:
    def stages(out):
        delta = lambda v: F.col(observed(v)) - WN.previous_day(observed(v), days, HERE)
        top, bottom = f"{out}_top", f"{out}_bottom"
        return [{top: delta(numerator), bottom: delta(denominator)}, {out: F.try_divide(F.col(top), F.col(bottom))}]

    return stages


def smoothed_tests(positive: str, negative: str, lookback: int = 7) -> Callable[[str], Stages]:
    """The expressions of ``positivity_smoothed`` on both series at once."""
    roles = {"p": positive, "n": negative}

    def stages(out):
        w = whole_series(HERE)
        upto = series_window(by=HERE).rowsBetween(W.unboundedPreceding, 0)
        after = W.partitionBy(*HERE).orderBy(day().desc()).rowsBetween(W.unboundedPreceding, -1)
        name = lambda r, what: f"{out}_{r}_{what}"
        at = lambda r, what: F.col(name(r, what))
        both = lambda **make: {name(r, what): f(r) for r in roles for what, f in make.items()}
        real = lambda r: F.col(observed(roles[r]))
        stalled = lambda r: F.coalesce(real(r) == WN.previous_day(observed(roles[r]), by=HERE), F.lit(False))
        step = lambda r: F.datediff("date", at(r, "d0")) * (at(r, "v1") - at(r, "v0")) / F.datediff(at(r, "d1"), at(r, "d0"))
        level = lambda r: F.floor(at(r, "v0") + F.coalesce(step(r), F.lit(0.0))).cast("double")
        new = lambda r: at(r, "level") - WN.previous_day(name(r, "level"), by=HERE)
        recent = lambda r: F.datediff(at(r, "end"), "date") < lookback
        kept = {"p": at("p", "mean").isNotNull(), "n": at("n", "mean").isNotNull() & (at("n", "last").isNull() | (F.col("date") <= at("n", "last")))}
        zeros = F.count(F.when(recent("p") & kept["p"] & (at("p", "mean") == 0), 1)).over(w)
        negatives = F.count(F.when(recent("n") & kept["n"], 1)).over(w)
        skipped = (F.col(f"{out}_zeros") < lookback) & (F.col(f"{out}_negatives") == 0)
        ratio = F.try_divide(at("p", "mean"), at("n", "mean") + at("p", "mean"))
        return [
            both(end=lambda r: F.max(F.when(real(r).isNotNull(), F.col("date"))).over(w), stalled=stalled),
            both(kept=lambda r: F.when(~at(r, "stalled"), real(r)), day=lambda r: F.when(real(r).isNotNull() & ~at(r, "stalled"), F.col("date"))),
            both(**{c + i: (lambda r, c=c, o=o: F.last(at(r, {"v": "kept", "d": "day"}[c]), ignorenulls=True).over(o)) for c in "vd" for i, o in (("0", upto), ("1", after))}),
            both(level=lambda r: F.when(F.col("date") <= at(r, "end"), level(r))),
            both(change=new),
            both(new=lambda r: F.when(at(r, "change") >= 0, at(r, "change"))),
            both(
                mean=lambda r: F.when(at(r, "new").isNotNull(), F.avg(at(r, "new")).over(WN.days_back(lookback - 1, by=HERE))),
                last=lambda r: F.max(F.when(at(r, "new") != 0, F.col("date"))).over(w),
            ),
            {f"{out}_zeros": zeros, f"{out}_negatives": negatives},
            {out: F.when(kept["p"] & kept["n"] & ~skipped, ratio)},
        ]

    return stages


POSITIVITY_METHODS = [
    Method("SmoothedTests", ["positive_tests", "negative_tests"], smoothed_tests("positive_tests", "negative_tests"), 10, True),
    Method("CDCTesting", ["test_positivity_7d"], pass_through("test_positivity_7d")),
    Method("CMSTesting", ["test_positivity_14d"], pass_through("test_positivity_14d")),
    Method("StateProvidedTesting", ["positive_tests_viral_7d", "total_tests_viral_7d"], division("positive_tests_viral_7d", "total_tests_viral_7d")),
    Method("positiveTestsViral_totalTestsViral", ["positive_tests_viral", "total_tests_viral"], division("positive_tests_viral", "total_tests_viral")),
]


def positivity_methods(obs: DataFrame, as_of: datetime.date, methods: list[Method] = POSITIVITY_METHODS) -> DataFrame:
    """Every method on every location: location_id, date, value, method, prio, recent.

    ``as_of`` is the most recent date of the data. A method that has no column in the data gives
    no rows; the smoothed tests count as recent when both inputs are. The series are pivoted once and
    the stages of all methods run side by side, so there is one scan, an exchange by location and day
    and one by location, however many methods are listed.
    """
    names = sorted({c for m in methods for c in m.columns})
    pick = lambda v: F.max(F.when(F.col("variable") == v, F.col("value"))).alias(observed(v))
    wide = obs.filter("bucket = 'all' and value is not null").filter(F.col("variable").isin(names))
    wide = wide.groupBy("location_id", "date").agg(*[pick(v) for v in names])
    following = F.lead("date").over(series_window(by=HERE))
    wide = wide.withColumn("_until", F.coalesce(F.date_sub(following, 1), F.col("date")))
    wide = wide.withColumn("_day", F.explode(F.sequence("date", "_until")))
    reported = lambda v: F.when(F.col("_day") == F.col("date"), F.col(observed(v))).alias(observed(v))
    x = wide.select("location_id", F.col("_day").alias("date"), *[reported(v) for v in names])
    results = [f"_method{i}" for i in range(len(methods))]
    for stage in zip_longest(*[m.calculate(r) for m, r in zip(methods, results)], fillvalue={}):
        x = x.withColumns({name: c for part in stage for name, c in part.items()})
    w, rows = whole_series(HERE), []
    for prio, (m, r) in enumerate(zip(methods, results)):
        if m.recent_by_inputs:
            since = F.col("date") >= F.lit(as_of - datetime.timedelta(days=m.recent_days))
            fresh = [F.coalesce(F.max(since & (F.col(observed(c)) > 0)).over(w), F.lit(False)) for c in m.columns]
            recent = reduce(lambda a, b: a & b, fresh)
        else:
            cutoff = as_of + datetime.timedelta(days=1 - m.recent_days)
            recent = F.coalesce(F.max(F.when(F.col(r).isNotNull(), F.col("date"))).over(w) >= F.lit(cutoff), F.lit(False))
        x = x.withColumn(f"{r}_recent", recent)
        rows.append(F.struct(F.col(r).alias("value"), F.lit(m.name).alias("method"), F.lit(prio).alias("prio"), F.col(f"{r}_recent").alias("recent")))
    return x.select("location_id", "date", F.inline(F.array(*rows))).filter("value is not null")


def positivity_best(results: DataFrame, fallback: str = "SmoothedTests") -> DataFrame:
    """Per location all points of the best recent method, the fallback method whatever its age."""
    last = 2**20
    rank = F.when(F.col("recent"), F.col("prio")).when(F.col("method") == fallback, F.lit(last))
    # A location holds at most one row per method and day, so the window is bounded and spares a
    # second run of all methods.
    best = F.min("rank").over(W.partitionBy("location_id"))
    ranked = results.withColumn("rank", rank).withColumn("best", best)
    return ranked.filter("rank = best").select("location_id", "date", "value", "method")


def positivity_tags(tags: DataFrame, best: DataFrame, methods: list[Method] = POSITIVITY_METHODS) -> DataFrame:
    """Distinct tags of the columns the chosen method used, on the output variable."""
    used = F.broadcast(best.sparkSession.createDataFrame([(m.name, c) for m in methods for c in m.columns], "method string, variable string"))
    chosen = best.select("location_id", "method").distinct().join(used, "method")
    return tags.filter("bucket = 'all'").join(chosen, ["location_id", "variable"]).select(
        "location_id", F.lit("test_positivity").alias("variable"), "bucket", "tag_type", "content"
    ).distinct()


def positivity_provenance(tags: DataFrame, known: list[str]) -> DataFrame:
    """Method named by the only distinct provenance of a location, else 'other'."""
    p = tags.filter("tag_type = 'provenance' and bucket = 'all'").groupBy("location_id").agg(
        F.count_distinct("content").alias("n"), F.max("content").alias("content")
    )
    return p.select("location_id", F.when((F.col("n") == 1) & F.col("content").isin(known), F.col("content")).otherwise("other").alias("source"))


# --- metrics table ---------------------------------------------------------------------------


def metrics_timeseries(
    days: DataFrame, parts: dict[str, DataFrame], ratios: dict[str, Column] | None = None,
    multiples: dict[str, tuple[str, float]] | None = None,
) -> DataFrame:
    """One rounded row per (location, date) of ``days``.

    ``parts``: metric name to a (location_id, date, value) frame; ``ratios``: metric name to an
    expression over the columns of ``days``; ``multiples``: metric name to (metric, factor). The
    parts are stacked and pivoted, so any number of them costs one aggregation and one join.
    """
    tall = C.union_all([p.select("location_id", "date", "value", F.lit(m).alias("metric")) for m, p in parts.items()])
    wide = tall.groupBy("location_id", "date").pivot("metric", list(parts)).agg(F.first("value"))
    if multiples:
        wide = wide.withColumns({m: F.col(of) * factor for m, (of, factor) in multiples.items()})
    base = days.select("location_id", "date", *[c.alias(m) for m, c in (ratios or {}).items()])
    return S.round_metrics(base.join(wide, ["location_id", "date"], "left"))


def all_metrics(
    ds: Dataset, counties: DataFrame | None = None, new_cases: str = "new_cases", rt: DataFrame | None = None,
    positivity: DataFrame | None = None,
) -> DataFrame:
    """All thirteen metrics of every region, a rounded row per day that has a density or an input of a ratio.

    ``counties`` (location_id) take hospital figures of their HSA. ``positivity`` (location_id, date, value) stands
    in for the observed ``test_positivity``. Observed fields and derived series are stacked and pivoted once, and
    the ratios are expressions over that row. A day that only ``rt`` knows gives no row.
    """
    x = ds.obs.filter("bucket = 'all' and value is not null")
    new = x.filter(F.col("variable") == new_cases)
    first = ds.obs.groupBy("location_id").agg(F.min("date").alias("first"))
    inputs = [c for c in METRIC_INPUTS if positivity is None or c != "test_positivity"]
    parts = {"caseDensity": case_density(new, population_of(ds.static), first), "_cases": smoothed_daily(new, first)}
    if positivity is not None:
        parts["test_positivity"] = positivity
    if rt is not None:
        parts["infectionRate"] = rt.withColumn("value", F.col("Rt_MAP_composite"))
        parts["infectionRateCI90"] = rt.withColumn("value", F.col("Rt_ci95_composite") - F.col("Rt_MAP_composite"))
    observed = x.filter(F.col("variable").isin(inputs)).select("location_id", "date", "value", F.col("variable").alias("metric"))
    tall = C.union_all([observed] + [p.select("location_id", "date", "value", F.lit(m).alias("metric")) for m, p in parts.items()])
    columns = ["caseDensity", "_cases", "infectionRate", "infectionRateCI90", *METRIC_INPUTS]
    days = tall.groupBy("location_id", "date").pivot("metric", columns).agg(F.first("value"))
    days = days.filter(F.coalesce("caseDensity", *METRIC_INPUTS).isNotNull())
    people = ds.static.filter(F.col("attr").isin("population", "hsa_population")).groupBy("location_id").pivot(
        "attr", ["population", "hsa_population"]).agg(F.first("num"))
    days = days.join(people, "location_id", "left")
    is_county = F.lit(False)
    if counties is not None:
        days = days.join(counties.select("location_id", F.lit(True).alias("_county")), "location_id", "left")
        is_county = F.coalesce("_county", F.lit(False))
    return S.round_metrics(days.select(
        "location_id", "date", "caseDensity", (F.col("caseDensity") * 7).alias("weeklyNewCasesPer100k"),
        F.col("test_positivity").alias("testPositivityRatio"),
        F.try_divide("contact_tracers_count", F.col("_cases") * TRACERS_PER_CASE).alias("contactTracerCapacityRatio"),
        "infectionRate", "infectionRateCI90", icu_capacity_ratio(days).alias("icuCapacityRatio"),
        covid_patient_ratio(is_county).alias("bedsWithCovidPatientsRatio"),
        weekly_admissions_per_100k(is_county).alias("weeklyCovidAdmissionsPer100k"),
        *[(F.col(c) / 100).alias(m) for c, m in zip(VACCINE_PAIRS.values(), VACCINATION_METRICS)],
    ))


def latest_metrics(metrics: DataFrame, names: list[str], lookback: int = LOOKBACK, rt_delay: int = RT_DELAY) -> DataFrame:
    """Per location the last real value of each metric, NULL when it is too old.

    Vaccination metrics never age. The infection rate is that of ``rt_delay`` days before its
    last date.
    """
    rt = [n for n in ("infectionRate", "infectionRateCI90") if n in names]
    if "infectionRate" in names:
        last_rt = F.max(F.when(F.col("infectionRate").isNotNull(), F.col("date"))).over(whole_series(["location_id"]))
        metrics = metrics.withColumn("_rt", last_rt)
    aggs = [F.max("date").alias("_latest")]
    for n in names:
        real = F.col(n).isNotNull()
        aggs += [F.max_by(n, F.when(real, F.col("date"))).alias(n), F.max(F.when(real, F.col("date"))).alias(f"_last_{n}")]
    for n in rt:
        at = F.col("date") == F.date_sub("_rt", rt_delay)
        aggs.append(F.max(F.when(at, F.col(n))).alias(f"_at_{n}"))
    if rt:
        aggs.append(F.coalesce(F.bool_or(F.col("infectionRate") != 0), F.lit(False)).alias("_any_rt"))
    x = metrics.groupBy("location_id").agg(*aggs)
    out = []
    for n in names:
        stale = F.col(f"_last_{n}") <= F.date_sub("_latest", lookback)
        value = F.col(n) if n in VACCINATION_METRICS else F.when(~stale, F.col(n))
        if n in rt:
            stale_rt = F.col("_last_infectionRate") <= F.date_sub("_latest", lookback)
            value = F.when(F.col("_any_rt"), F.when(~stale_rt, F.col(f"_at_{n}"))).otherwise(value)
        out.append(value.alias(n))
    return x.select("location_id", *out)


def testing_corrected_cases(cases: DataFrame, tests: DataFrame, tau: int = 5, threshold: float = 5) -> DataFrame:
    """New cases less the positives expected from a rise in testing, never below zero.

    ``cases``: location_id, date, value; ``tests``: location_id, date, positive, negative
    (cumulative). Rows of ``tests`` follow each other, as only rows with both counts are used.
    """
    w = W.partitionBy("location_id").orderBy(day())
    x = tests.filter("positive > 0 and negative > 0")
    delta = lambda c: F.coalesce(c - F.lag(c).over(w), F.lit(0.0))
    x = x.withColumns({"rate": F.col("positive") / (F.col("positive") + F.col("negative")), "_all": F.col("positive") + F.col("negative")})
    x = x.withColumns({"new_positive": delta(F.col("positive")), "new_tests": delta(F.col("_all"))})
    x = x.withColumn("raw", delta(F.col("new_tests")) * 0.65 * F.col("rate"))
    numbered = x.select("location_id", "date", "new_positive", "raw", F.lit("raw").alias("variable"), F.lit("all").alias("bucket"))
    smooth = WN.ewma_smooth(numbered, tau, "raw")
    expected = smooth.select(
        "location_id", "date", F.when(F.col("new_positive") < threshold, 0.0).otherwise(F.col("raw")).alias("_expected")
    )
    return cases.join(expected, ["location_id", "date"], "left").select(
        "location_id", "date", F.greatest(F.col("value") - F.coalesce("_expected", F.lit(0.0)), F.lit(0.0)).alias("value")
    )


def select_regions(df: DataFrame, sort: Column | None = None, limit: int | None = None) -> DataFrame:
    if sort is not None:
        df = df.orderBy(sort)
    return df if limit is None else df.limit(limit)
