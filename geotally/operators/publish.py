"""Published rows: nested summaries per region, arrays of daily rows, flat rows."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, functions as F

from geotally.functions import regions as R
from geotally.operators import combine as C

VACCINATION_START = datetime.date(2020, 12, 14)
BIVALENT_START = datetime.date(2022, 9, 1)

# Published name of each field.
ACTUALS = {
    "cases": "cases", "deaths": "deaths", "positiveTests": "positive_tests", "negativeTests": "negative_tests",
    "contactTracers": "contact_tracers_count", "newCases": "new_cases", "newDeaths": "new_deaths",
    "vaccinesDistributed": "vaccines_distributed", "vaccinationsInitiated": "vaccinations_initiated",
    "vaccinationsCompleted": "vaccinations_completed", "vaccinationsAdditionalDose": "vaccinations_additional_dose",
    "vaccinationsFall2022BivalentBooster": "vaccinations_2022_fall_bivalent_dose", "vaccinesAdministered": "vaccines_administered",
}
BEDS = {
    "hospitalBeds": {
        "capacity": "staffed_beds", "currentUsageCovid": "current_hospitalized", "currentUsageTotal": "hospital_beds_in_use_any",
        "weeklyCovidAdmissions": "weekly_new_hospital_admissions_covid",
    },
    "hsaHospitalBeds": {
        "capacity": "staffed_beds_hsa", "currentUsageCovid": "current_hospitalized_hsa", "currentUsageTotal": "hospital_beds_in_use_any_hsa",
        "weeklyCovidAdmissions": "weekly_new_hospital_admissions_covid_hsa",
    },
    "icuBeds": {"capacity": "icu_beds", "currentUsageCovid": "current_icu", "currentUsageTotal": "current_icu_total"},
    "hsaIcuBeds": {"capacity": "icu_beds_hsa", "currentUsageCovid": "current_icu_hsa", "currentUsageTotal": "current_icu_total_hsa"},
}
ACTUAL_FIELDS = list(dict.fromkeys([*ACTUALS.values(), *[v for beds in BEDS.values() for v in beds.values()]]))
FIRST_VACCINES = [
    "vaccinesAdministered", "vaccinesDistributed", "vaccinationsInitiated", "vaccinationsCompleted", "vaccinationsAdditionalDose",
]
BIVALENT = "vaccinationsFall2022BivalentBooster"
METRIC_STARTS = {
    "vaccinationsInitiatedRatio": VACCINATION_START, "vaccinationsCompletedRatio": VACCINATION_START,
    "vaccinationsAdditionalDoseRatio": VACCINATION_START, "vaccinationsFall2022BivalentBoosterRatio": BIVALENT_START,
}
# The field whose tags annotate each published actual and metric.
ANNOTATED = ACTUALS | {
    "hospitalBeds": "hospital_beds_in_use_any", "hsaHospitalBeds": "hospital_beds_in_use_any_hsa", "icuBeds": "icu_beds", "hsaIcuBeds": "icu_beds_hsa",
    "contactTracerCapacityRatio": "contact_tracers_count", "caseDensity": "cases", "weeklyNewCasesPer100k": "cases",
    "infectionRate": "cases", "infectionRateCI90": "cases", "testPositivityRatio": "test_positivity",
    "vaccinationsInitiatedRatio": "vaccinations_initiated_pct", "vaccinationsCompletedRatio": "vaccinations_completed_pct",
    "vaccinationsAdditionalDoseRatio": "vaccinations_additional_dose_pct",
    "vaccinationsFall2022BivalentBoosterRatio": "vaccinations_bivalent_dose_pct", "icuCapacityRatio": "current_icu",
    "bedsWithCovidPatientsRatio": "current_hospitalized", "weeklyCovidAdmissionsPer100k": "weekly_new_hospital_admissions_covid",
}


def actuals_struct(
    columns: list[str], dated: bool = True, vaccines: datetime.date = VACCINATION_START, bivalent: datetime.date = BIVALENT_START,
) -> Column:
    """The nested actuals of a row; fields not in ``columns`` are NULL. In daily rows vaccination
    fields are absent before their first day."""
    get = lambda f: F.col(f).cast("double") if f in columns else F.lit(None).cast("double")
    starts = {n: vaccines for n in FIRST_VACCINES} | {BIVALENT: bivalent}

    def value(name, f):
        c = get(f)
        return F.when(F.col("date") >= F.lit(starts[name]), c) if dated and name in starts else c

    plain = [value(n, f).alias(n) for n, f in ACTUALS.items()]
    beds = [F.struct(*[get(f).alias(k) for k, f in m.items()]).alias(n) for n, m in BEDS.items()]
    return F.struct(*plain, *beds)


def actuals_rows(wide: DataFrame, **starts) -> DataFrame:
    return wide.select("location_id", "date", actuals_struct(wide.columns, **starts).alias("actuals"))


def metric_rows(metrics: DataFrame, starts: dict = METRIC_STARTS) -> DataFrame:
    """Metrics with vaccination ratios absent before their first day."""
    late = {m: F.when(F.col("date") >= F.lit(d), F.col(m)) for m, d in starts.items() if m in metrics.columns}
    return metrics.withColumns(late) if late else metrics


def region_summary(
    geo: DataFrame, latest_wide: DataFrame, metrics: DataFrame, risks: DataFrame, transmission: DataFrame,
    community: DataFrame, annotations: DataFrame | None = None, distributions: DataFrame | None = None,
) -> DataFrame:
    """One nested row per region. All inputs have one row per location; annotations and
    demographic distributions are folded to maps first."""
    pack = lambda df, name: df.select("location_id", F.struct(*[c for c in df.columns if c != "location_id"]).alias(name))
    out = geo.join(latest_wide.select("location_id", *[c for c in latest_wide.columns if c not in geo.columns]), "location_id")
    out = out.withColumn("actuals", actuals_struct(latest_wide.columns, dated=False))
    for df, name in ((metrics, "metrics"), (risks, "riskLevels"), (community, "communityLevels")):
        out = out.join(pack(df, name), "location_id", "left")
    out = out.join(transmission.select("location_id", "cdcTransmissionLevel"), "location_id", "left")
    if annotations is not None:
        entry = F.struct("field", F.struct("sources", "anomalies").alias("a"))
        folded = annotations.groupBy("location_id").agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("annotations"))
        out = out.join(folded, "location_id", "left")
    if distributions is not None:
        entry = F.struct(F.concat_ws("/", "variable", "distribution").alias("k"), "members")
        folded = distributions.groupBy("location_id").agg(F.map_from_entries(F.collect_list(entry)).alias("demographics"))
        out = out.join(folded, "location_id", "left")
    if "hsa" in out.columns:
        out = out.withColumn("hsa", R.hsa_code(F.col("hsa")))
    header = [c for c in (
        "location_id", "fips", "country", "state", "county", "level", "latitude", "longitude", "population", "hsa", "hsa_name",
        "hsa_population", "actuals", "metrics", "riskLevels", "cdcTransmissionLevel", "communityLevels", "annotations", "demographics", "url",
    ) if c in out.columns]
    return out.select(*header)


def region_timeseries(summary: DataFrame, parts: dict[str, DataFrame]) -> DataFrame:
    """The summary with one array of daily rows per part, in date order.

    An array holds one region's days and is bounded by the calendar.
    """
    for name, df in parts.items():
        row = F.struct("date", *[c for c in df.columns if c not in ("location_id", "date")])
        arrays = df.groupBy("location_id").agg(F.array_sort(F.collect_list(row)).alias(name))
        summary = summary.join(arrays, "location_id", "left")
    return summary


def flat_rows(header: DataFrame, parts: dict[str, DataFrame]) -> DataFrame:
    """One row per region and day with the structs of all parts, from days with metrics or actuals."""
    packed = [
        df.select("location_id", "date", F.struct(*[c for c in df.columns if c not in ("location_id", "date")]).alias(name))
        for name, df in parts.items()
    ]
    rows = C.join_day_rows(header, packed)
    present = [F.col(n).isNotNull() for n in ("actuals", "metrics") if n in parts]
    keep = present[0] if len(present) == 1 else (present[0] | present[1] if present else F.lit(True))
    return rows.filter(keep)


def state_case_summary(counties: DataFrame) -> DataFrame:
    """Per state the date, totals and the list of its counties.

    ``counties``: state, fips, cases, deaths, date, one row per county.
    """
    return counties.groupBy("state").agg(
        F.max("date").alias("date"), F.sum("cases").alias("cases"), F.sum("deaths").alias("deaths"),
        F.array_sort(F.collect_list(F.struct("fips", "cases", "deaths", "date"))).alias("counties"),
    )
