"""Declared sources: which provider variables feed which field, and what happens after the scan.

A connector is data: rows for ``query_variables`` and a list of steps on the resulting dataset.
The steps are the engine's own operators.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from geotally.functions import tagtext as T
from geotally.model import OBS_SCHEMA, POINT, STATIC_SCHEMA, TAG, TAG_SCHEMA, Dataset, work_dir
from geotally.operators import combine as C, filters, layout as L, rollup, windows as WN
from geotally.sources import provider
from geotally.sources.provider import query_variables

Step = Callable[[Dataset, DataFrame], Dataset]


@dataclass(frozen=True)
class Connector:
    """``variables``: (provider, variable_name, measurement, unit, field); ``ignored``: upstream
    names known and left out."""

    name: str
    variables: list[tuple[str, str, str, str, str]]
    steps: list[Step] = field(default_factory=list)
    ignored: list[tuple[str, str]] = field(default_factory=list)

    def load(self, fact: DataFrame, geo: DataFrame) -> Dataset:
        return self.finish(query_variables(fact, self.variables, self.name), geo)

    def finish(self, ds: Dataset, geo: DataFrame) -> Dataset:
        """The dataset after the connector's own steps."""
        for step in self.steps:
            ds = step(ds, geo)
        return ds


def _rows(provider, *specs):
    return [(provider, *s) for s in specs]


# Steps -------------------------------------------------------------------------------------


def forward_fill(ds: Dataset, geo: DataFrame) -> Dataset:
    return ds.with_obs(WN.locf_fill(ds.obs))


def to_ratio(ds: Dataset, geo: DataFrame) -> Dataset:
    return ds.with_obs(ds.obs.withColumn("value", F.col("value") / 100.0))


CAPITAL_COUNTY = "iso1:us#iso2:us-dc#fips:11001"


def capital_county_as_state(ds: Dataset, geo: DataFrame) -> Dataset:
    """The one county of the capital district also stands for its state."""
    return ds.with_obs(C.copy_region(ds.obs, CAPITAL_COUNTY, CAPITAL_COUNTY.partition("#fips")[0]).select(*POINT, "value"))


def trim_zeros(ds: Dataset, geo: DataFrame) -> Dataset:
    return ds.with_obs(WN.trim_trailing_zeros(ds.obs))


# First day of usable hospital reports, and later first days per state fips.
HOSPITAL_START = datetime.date(2020, 9, 1)
HOSPITAL_STATE_STARTS = {
    "02": datetime.date(2020, 10, 6), "04": datetime.date(2020, 9, 2), "15": datetime.date(2020, 10, 10),
    "16": datetime.date(2020, 10, 17), "19": datetime.date(2020, 9, 5), "21": datetime.date(2020, 10, 15),
    "28": datetime.date(2020, 11, 11), "34": datetime.date(2020, 9, 1), "38": datetime.date(2020, 11, 3),
    "46": datetime.date(2020, 11, 2), "47": datetime.date(2020, 9, 20), "53": datetime.date(2020, 10, 25),
}


def hospital_starts(ds: Dataset, geo: DataFrame) -> Dataset:
    rows = list(HOSPITAL_STATE_STARTS.items())
    starts = F.broadcast(geo.sparkSession.createDataFrame(rows, "fips string, start date"))
    by_location = geo.filter("level = 'state'").join(starts, "fips").select("location_id", "start")
    return ds.with_obs(filters.filter_start_dates(ds.obs, by_location, HOSPITAL_START).select(*POINT, "value"))


def icu_beds_to_static(ds: Dataset, geo: DataFrame) -> Dataset:
    return rollup.latest_to_static(ds, "icu_beds")


def weekly_test_sums(ds: Dataset, geo: DataFrame) -> Dataset:
    names = {"new_positive_tests_viral": "positive_tests_viral_7d", "new_total_tests_viral": "total_tests_viral_7d"}
    sums = WN.rolling_sum(ds.obs.filter(F.col("variable").isin(list(names))))
    table = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return ds.with_obs(
        ds.obs.filter(~F.col("variable").isin(list(names))).select(*POINT, "value")
        .unionByName(sums.withColumn("variable", F.element_at(table, F.col("variable"))))
    )


# The variables each provider publishes ------------------------------------------

CASES_DEATHS = [("cases", "cumulative", "people", "cases"), ("deaths", "cumulative", "people", "deaths")]
VACCINES = [
    ("total_vaccine_allocated", "cumulative", "doses", "vaccines_allocated"),
    ("total_vaccine_distributed", "cumulative", "doses", "vaccines_distributed"),
    ("total_vaccine_doses_administered", "cumulative", "doses", "vaccines_administered"),
    ("total_vaccine_initiated", "cumulative", "people", "vaccinations_initiated"),
    ("total_vaccine_completed", "cumulative", "people", "vaccinations_completed"),
    ("total_vaccine_additional_dose", "cumulative", "people", "vaccinations_additional_dose"),
    ("total_vaccine_bivalent_dose", "cumulative", "people", "vaccinations_2022_fall_bivalent_dose"),
]
HOSPITAL_FIELDS = {
    "adult_icu_beds_capacity": "icu_beds", "adult_icu_beds_in_use": "current_icu_total",
    "adult_icu_beds_in_use_covid": "current_icu", "hospital_beds_capacity": "staffed_beds",
    "hospital_beds_in_use": "hospital_beds_in_use_any", "hospital_beds_in_use_covid": "current_hospitalized",
}
DASHBOARD = [
    *CASES_DEATHS,
    ("hospital_beds_in_use_covid", "current", "beds", "current_hospitalized"),
    ("hospital_beds_capacity", "current", "beds", "staffed_beds"),
    ("icu_beds_capacity", "current", "beds", "icu_beds"),
    ("icu_beds_in_use_covid", "current", "beds", "current_icu"),
    ("pcr_tests_total", "cumulative", "specimens", "total_tests_viral"),
    ("pcr_tests_positive", "cumulative", "specimens", "positive_tests_viral"),
    ("total_vaccine_allocated", "cumulative", "doses", "vaccines_allocated"),
    ("total_vaccine_distributed", "cumulative", "doses", "vaccines_distributed"),
    ("total_vaccine_initiated", "cumulative", "people", "vaccinations_initiated"),
    ("total_vaccine_initiated", "current", "percentage", "vaccinations_initiated_pct"),
    ("total_vaccine_completed", "cumulative", "people", "vaccinations_completed"),
    ("total_vaccine_additional_dose", "cumulative", "people", "vaccinations_additional_dose"),
    ("total_vaccine_completed", "current", "percentage", "vaccinations_completed_pct"),
    ("total_vaccine_doses_administered", "cumulative", "doses", "vaccines_administered"),
]
DASHBOARD_IGNORED = [
    "pcr_tests_negative", "unspecified_tests_total", "unspecified_tests_positive", "icu_beds_available",
    "antibody_tests_total", "antigen_tests_positive", "antigen_tests_negative", "total_vaccine_doses_administered",
    "hospital_beds_in_use", "ventilators_in_use", "ventilators_available", "ventilators_capacity",
    "pediatric_icu_beds_in_use", "adult_icu_beds_available", "pediatric_icu_beds_capacity",
    "unspecified_tests_negative", "antigen_tests_total", "adult_icu_beds_in_use", "hospital_beds_available",
    "pediatric_icu_beds_available", "adult_icu_beds_capacity", "icu_beds_in_use",
]


def _hospital(measurement: str, admissions: tuple) -> list[tuple]:
    return _rows("hhs", *[(name, measurement, "beds", f) for name, f in HOSPITAL_FIELDS.items()], admissions)


def _positivity(provider: str) -> list[tuple]:
    return _rows(provider, ("pcr_tests_positive", "rolling_average_7_day", "percentage", "test_positivity_7d"))


POSITIVITY_STEPS = [to_ratio, capital_county_as_state, trim_zeros]

CONNECTORS = {
    c.name: c
    for c in [
        Connector("NYTimes", _rows("nyt", *CASES_DEATHS)),
        Connector("CDC", _rows("cdc", *CASES_DEATHS), [forward_fill]),
        Connector("USAFacts", _rows("usafacts", *CASES_DEATHS)),
        Connector("CDCCommunityLevels", _rows(
            "cdc_community_level", ("cdc_community", "current", "risk_level", "cdc_community_level"),
            ("hospital_beds_in_use_covid", "rolling_average_7_day", "percentage", "beds_with_covid_patients_ratio_hsa"),
            ("hospital_admissions_covid", "new_7_day", "people_per_100k", "weekly_new_hospital_admissions_covid_per_100k_hsa"))),
        Connector("CDCVaccine", _rows("cdc", *VACCINES)),
        Connector("CDCVaccineCounties", _rows("cdc2", *VACCINES)),
        Connector("CDCHistoricalTesting", _positivity("cdc2"), POSITIVITY_STEPS),
        Connector("CDCOriginallyPostedTesting", _positivity("cdc_originally_posted"), POSITIVITY_STEPS),
        Connector("HHSHospitalState", _hospital("current", ("hospital_admissions_covid", "new", "people", "new_hospital_admissions_covid")),
                  [hospital_starts, icu_beds_to_static]),
        Connector("HHSHospitalCounty", _hospital("rolling_average_7_day", (
            "hospital_admissions_covid", "new_7_day", "people", "weekly_new_hospital_admissions_covid")), [hospital_starts, icu_beds_to_static]),
        Connector("HHSTesting", _rows(
            "hhs", ("pcr_tests_negative", "cumulative", "specimens", "negative_tests"), ("pcr_tests_positive", "cumulative", "specimens", "positive_tests"))),
        Connector("StateDashboards", _rows("state", *DASHBOARD), ignored=[("state", n) for n in DASHBOARD_IGNORED]),
        Connector("CountyDashboards", _rows("county", *DASHBOARD), ignored=[("county", n) for n in DASHBOARD_IGNORED]),
        Connector("StateProvidedTesting", _rows(
            "state", ("pcr_tests_positive", "new", "specimens", "new_positive_tests_viral"),
            ("pcr_tests_total", "new", "specimens", "new_total_tests_viral")), [weekly_test_sums]),
    ]
}

SPLICE_DATE = datetime.date(2023, 3, 23)


Load = Callable[[str], Dataset]


def spliced_cases(load: Load) -> Dataset:
    """Daily cases and deaths before the cutoff, weekly ones of the other provider from it on."""
    daily, weekly = load("NYTimes"), load("CDC")
    obs = C.splice(daily.obs, weekly.obs, SPLICE_DATE)
    return daily.with_obs(obs).with_tags(C.constant_source_tags(obs.filter("bucket = 'all'"), T.source_content(F.lit("CDCNYT"))))


def combined_positivity(load: Load) -> Dataset:
    """Historical positivity, the originally posted one where it lacks a day."""
    a, b = load("CDCHistoricalTesting"), load("CDCOriginallyPostedTesting")
    return b.with_obs(C.coalesce_pointwise(a.obs, b.obs))


# Regions left out of a source, as predicates over the geo dimension; why, in a word, beside.
MASKS = {
    "counties": "level = 'county'",
    "no-cities": "coalesce(fips, '') not in ("
    "'36047', '36081', '36005', '36085', '36061', "  # one city's counties are reported as one
    "'29037', '29047', '29095', '29165', '29097', '29145')",  # two cities report apart from their counties
    "no-boosters": "level = 'country' or (level = 'state' and state <> 'NC')",  # boosters counted wrongly
    "no-fl": "not (level = 'county' and coalesce(state, '') = 'FL')",
    "completed": "coalesce(state, '') not in ('CA', 'NM', 'PA', 'VA', 'VT', 'HI', 'NC') and "  # irregular or incomplete
    "coalesce(fips, '') not in ('30035', '04023', '72013', '02060', '72049', '13053')",  # shares near or above one
}
MASKS["initiated"] = MASKS["completed"] + " and not (level = 'county' and coalesce(state, '') = 'NE')"

# Sources per field, lowest priority first, each with a mask after the colon or without.
VACCINE_DOSES = ["CDCVaccine:counties", "StateDashboards:no-fl", "CountyDashboards", "CDCVaccine:no-boosters"]
HOSPITALS = ["StateDashboards", "HHSHospitalCounty", "HHSHospitalState"]
FEATURES = {
    "cases": ["CDC", "CDCNYT:no-cities"], "deaths": ["CDC", "CDCNYT:no-cities"],
    "contact_tracers_count": ["TestAndTrace"],
    "current_hospitalized": HOSPITALS, "current_icu": HOSPITALS, "icu_beds": HOSPITALS, "staffed_beds": HOSPITALS,
    "current_icu_total": HOSPITALS[1:], "hospital_beds_in_use_any": HOSPITALS[1:],
    "beds_with_covid_patients_ratio_hsa": ["CDCCommunityLevels"],
    "new_hospital_admissions_covid": ["HHSHospitalState"],
    "weekly_new_hospital_admissions_covid": ["HHSHospitalCounty"],
    "weekly_new_hospital_admissions_covid_per_100k_hsa": ["CDCCommunityLevels"],
    "negative_tests": ["HHSTesting"], "positive_tests": ["HHSTesting"],
    "positive_tests_viral": ["StateDashboards"], "total_tests_viral": ["StateDashboards"],
    "test_positivity_7d": ["CDCCombinedTesting"],
    "vaccines_distributed": VACCINE_DOSES, "vaccines_administered": VACCINE_DOSES,
    "vaccinations_initiated": [*VACCINE_DOSES[1:], "CDCVaccineCounties:initiated"],
    "vaccinations_completed": [*VACCINE_DOSES[1:], "CDCVaccineCounties:completed"],
    "vaccinations_additional_dose": [*VACCINE_DOSES[1:], "CDCVaccineCounties:completed"],
    "vaccinations_2022_fall_bivalent_dose": ["CDCVaccine:no-boosters", "CDCVaccineCounties:completed"],
    "vaccinations_initiated_pct": VACCINE_DOSES[1:3], "vaccinations_completed_pct": VACCINE_DOSES[1:3],
    "cdc_community_level": ["CDCCommunityLevels"],
}
STATIC_FEATURES = {
    "population": ["FIPSPopulation"], "hsa_population": ["HSAPopulation"], "hsa": ["HSAPopulation"], "hsa_name": ["HSAPopulation"],
    "location_page_url": ["LocationPages"],
}

#: Sources made of connectors, with the connectors that they read.
COMBINED: dict[str, tuple[Callable[[Load], Dataset], list[str]]] = {
    "CDCNYT": (spliced_cases, ["NYTimes", "CDC"]),
    "CDCCombinedTesting": (combined_positivity, ["CDCHistoricalTesting", "CDCOriginallyPostedTesting"]),
}


def load_source(name: str, fact: DataFrame, geo: DataFrame, files: dict[str, Dataset]) -> Dataset:
    """A source by name: a connector, one combined from connectors, or one that comes from a file."""
    if name in files:
        return files[name]
    if name in COMBINED:
        return COMBINED[name][0](lambda part: CONNECTORS[part].load(fact, geo))
    if name in CONNECTORS:
        return CONNECTORS[name].load(fact, geo)
    raise ValueError(f"unknown source {name}")


def mask_bits(geo: DataFrame, masks: list[str]) -> DataFrame:
    """location_id and one bit for each mask that includes it, the first mask in the lowest bit."""
    bits = sum((F.when(F.expr(MASKS[m]), F.lit(1 << i)).otherwise(0) for i, m in enumerate(masks)), F.lit(0))
    return geo.select("location_id", bits.cast("long").alias("_bits"))


def label_index(spark, features: dict[str, list[str]]) -> tuple[DataFrame, list[str]]:
    """(name, variable) of every source and field with the labels that list it, each with the bit of its mask or 0."""
    masks = sorted({label.partition(":")[2] for names in features.values() for label in names} - {""})
    if unknown := [m for m in masks if m not in MASKS]:
        raise ValueError(f"unknown mask {unknown[0]}")
    index: dict[tuple[str, str], list[tuple[str, int]]] = {}
    for variable, names in features.items():
        for label in names:
            name, _, mask = label.partition(":")
            index.setdefault((name, variable), []).append((label, 1 << masks.index(mask) if mask else 0))
    rows = [(*key, labels) for key, labels in sorted(index.items())]
    return F.broadcast(spark.createDataFrame(rows, "name string, variable string, _labels array<struct<source: string, bit: long>>")), masks


def load_all(names: list[str], fact: DataFrame, geo: DataFrame, files: dict[str, Dataset]) -> tuple[DataFrame, DataFrame]:
    """Observations and tags of many sources by ``name``, from one scan of the fact table.

    The rows that the connectors read are written once, in folders by connector. Those without steps go on together;
    each of the others reads its own folder.
    """
    if unknown := [n for n in names if n not in files and n not in COMBINED and n not in CONNECTORS]:
        raise ValueError(f"unknown source {unknown[0]}")
    names = [n for n in names if n not in files]
    needed = sorted({c for n in names for c in (COMBINED[n][1] if n in COMBINED else [n])})
    spark = fact.sparkSession
    parts = [(ds.obs.select(F.lit(n).alias("name"), *POINT, "value"), ds.tags.select(F.lit(n).alias("name"), *TAG)) for n, ds in files.items()]
    if needed:
        path = work_dir(spark, "matched")
        matched = provider.matched_rows(fact, {c: CONNECTORS[c].variables for c in needed})
        matched.hint("rebalance", "connector").write.partitionBy("connector").parquet(path)
        rows = spark.read.schema(matched.schema).parquet(path)

        def load(connector: str) -> Dataset:
            obs, tags = provider.observations(rows.filter(F.col("connector") == connector))
            ds = Dataset(obs.select(*POINT, "value"), spark.createDataFrame([], STATIC_SCHEMA), tags.select(*TAG))
            return CONNECTORS[connector].finish(ds, geo)

        plain = [n for n in names if n in CONNECTORS and not CONNECTORS[n].steps]
        if plain:
            obs, tags = provider.observations(rows.filter(F.col("connector").isin(plain)))
            parts.append((obs.withColumnRenamed("connector", "name"), tags.withColumnRenamed("connector", "name")))
        for n in [n for n in names if n not in plain]:
            ds = COMBINED[n][0](load) if n in COMBINED else load(n)
            parts.append((ds.obs.select(F.lit(n).alias("name"), *POINT, "value"), ds.tags.select(F.lit(n).alias("name"), *TAG)))
    return C.union_all([p[0] for p in parts]), C.union_all([p[1] for p in parts])


def load_features(fact: DataFrame, geo: DataFrame, files: dict[str, Dataset] | None = None, features: dict[str, list[str]] = FEATURES) -> tuple[DataFrame, DataFrame]:
    """Observations and tags of all listed sources, each with a ``source`` column as listed.

    A name or mask that is not known is an error before anything runs. Every source gives only the
    fields that list it, in the regions of its mask: a location has a bit for each mask, and a row becomes one
    row for each label whose bit is set. The fact table is scanned once, whatever the number of labels.
    """
    index, masks = label_index(fact.sparkSession, features)
    names = sorted({label.partition(":")[0] for names in features.values() for label in names})
    files = {n: ds for n, ds in (files or {}).items() if n in names}
    bits = mask_bits(geo, masks)

    def labelled(df: DataFrame) -> DataFrame:
        columns = [c for c in df.columns if c != "name"]
        located = df.join(index, ["name", "variable"]).join(bits, "location_id", "left")
        fits = lambda x: (x["bit"] == 0) | (x["bit"].bitwiseAND(F.coalesce("_bits", F.lit(0))) != 0)
        return located.select(*columns, F.inline(F.filter("_labels", fits))).drop("bit")

    obs, tags = load_all(names, fact, geo, files)
    return labelled(obs), labelled(tags)


def static_source(wide: DataFrame, numbers: list[str], strings: list[str]) -> Dataset:
    """A source of attributes alone: populations, health areas or page addresses, by location."""
    spark = wide.sparkSession
    return Dataset(spark.createDataFrame([], OBS_SCHEMA), L.static_long(wide, numbers, strings), spark.createDataFrame([], TAG_SCHEMA))


def load_static_features(files: dict[str, Dataset], features: dict[str, list[str]] = STATIC_FEATURES) -> DataFrame:
    """Attributes of all listed sources with a ``source`` column."""
    parts = []
    for attr, names in features.items():
        for name in names:
            if name not in files:
                raise ValueError(f"unknown source {name}")
            parts.append(files[name].static.filter(F.col("attr") == attr).withColumn("source", F.lit(name)))
    return C.union_all(parts)


def unlisted_variables(fact: DataFrame) -> DataFrame:
    """Per provider the names in the fact table that no connector reads or ignores, with their rows."""
    known = {(r[0], r[1]) for c in CONNECTORS.values() for r in c.variables} | {n for c in CONNECTORS.values() for n in c.ignored}
    names = F.broadcast(fact.sparkSession.createDataFrame(sorted(known), "provider string, variable_name string"))
    counts = fact.filter(F.col("provider").isin(sorted({k[0] for k in known}))).groupBy("provider", "variable_name").agg(F.count("*").alias("n"))
    return counts.join(names, ["provider", "variable_name"], "left_anti")


# Field group of each published field.
FIELD_GROUPS = {
    "cases_deaths": ["cases", "deaths", "recovered", "new_cases", "new_deaths", "weekly_new_cases", "weekly_new_deaths"],
    "tests": [
        "positive_tests", "negative_tests", "total_tests", "new_positive_tests_viral", "new_total_tests_viral",
        "positive_tests_viral_7d", "total_tests_viral_7d", "positive_tests_viral", "positive_cases_viral", "total_tests_viral",
        "total_tests_people_viral", "total_test_encounters_viral", "test_positivity", "test_positivity_14d", "test_positivity_7d",
    ],
    "hospitals": [
        "cumulative_hospitalized", "cumulative_icu", "current_icu", "current_hospitalized", "current_ventilated", "staffed_beds",
        "licensed_beds", "icu_beds", "all_beds_occupancy_rate", "icu_occupancy_rate", "max_bed_count", "ventilator_capacity",
        "hospital_beds_in_use_any", "current_hospitalized_total", "current_icu_total", "new_hospital_admissions_covid",
        "weekly_new_hospital_admissions_covid", "staffed_beds_hsa", "hospital_beds_in_use_any_hsa", "current_hospitalized_hsa",
        "icu_beds_hsa", "current_icu_hsa", "current_icu_total_hsa", "weekly_new_hospital_admissions_covid_hsa",
        "beds_with_covid_patients_ratio_hsa", "weekly_new_hospital_admissions_covid_per_100k_hsa", "contact_tracers_count",
    ],
    "vaccines": [
        "vaccines_allocated", "vaccines_distributed", "vaccines_administered", "vaccinations_initiated",
        "vaccinations_initiated_pct", "vaccinations_additional_dose", "vaccinations_additional_dose_pct",
        "vaccinations_2022_fall_bivalent_dose", "vaccinations_bivalent_dose_pct", "vaccinations_completed", "vaccinations_completed_pct",
    ],
}


def field_groups(spark) -> DataFrame:
    rows = [(f, g) for g, names in FIELD_GROUPS.items() for f in names]
    return F.broadcast(spark.createDataFrame(rows, "variable string, field_group string"))
