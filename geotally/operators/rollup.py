"""Latest values and geography rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from geotally.functions import regions as R
from geotally.model import POINT, SERIES, STATIC, Dataset, assert_declared
from geotally.operators import combine as C, filters

COVERAGE = 0.95

# Fields never summed over regions.
NOT_AGGREGATED = ["cdc_community_level", "hsa", "hsa_population"]

# Fields that are population-weighted means of the children.
WEIGHTED = {
    f: "population"
    for f in (
        "test_positivity", "test_positivity_7d", "test_positivity_14d", "vaccinations_initiated_pct",
        "vaccinations_completed_pct", "vaccinations_additional_dose_pct", "beds_with_covid_patients_ratio_hsa",
        "weekly_new_hospital_admissions_covid_per_100k_hsa",
    )
}

# Hospital fields summed per HSA and written back to each county.
HSA_FIELDS = {
    f: f"{f}_hsa"
    for f in (
        "staffed_beds", "hospital_beds_in_use_any", "current_hospitalized", "icu_beds", "current_icu",
        "current_icu_total", "weekly_new_hospital_admissions_covid",
    )
}


def latest_values(obs: DataFrame, by: list[str] = SERIES) -> DataFrame:
    """Last real value per group: a map-side combinable max_by, no sort."""
    return obs.filter("value is not null and not isnan(value)").groupBy(*by).agg(
        F.max_by("value", "date").alias("value"), F.max("date").alias("date")
    )


def latest_to_static(ds: Dataset, field: str) -> Dataset:
    """Copy the latest value of a field of bucket 'all' to static; fails if static has it already."""
    latest = latest_values(ds.obs.filter((F.col("variable") == field) & (F.col("bucket") == "all")), ["location_id"])
    rows = latest.select(
        "location_id", F.lit(field).alias("attr"), F.col("value").alias("num"), F.lit(None).cast("string").alias("str")
    )
    return ds.with_static(C.add_static_values(ds.static, rows))


def weights(static: DataFrame, region_map: DataFrame, attr: str, parent: str | None = None) -> DataFrame:
    """location_id, parent_id, weight, and the weight of all mapped children of the parent.

    With ``parent`` all locations of the map lie in that one region; its total is then a scalar
    and needs no join.
    """
    w = static.filter((F.col("attr") == attr) & F.col("num").isNotNull()).select("location_id", F.col("num").alias("weight"))
    if parent is not None:
        children = region_map.select("location_id").join(w, "location_id", "left")
        return children.select("location_id", F.lit(parent).alias("parent_id"), "weight", children.agg(F.sum("weight")).scalar().alias("total"))
    children = region_map.select("location_id", "parent_id").join(w, "location_id", "left")
    totals = children.groupBy("parent_id").agg(F.sum("weight").alias("total"))
    return children.join(totals, "parent_id")


def _shares(long: DataFrame, name: str, weighted: dict[str, str], own: str, static: DataFrame, region_map: DataFrame, parent: str | None) -> DataFrame:
    """``long`` with _share, by which a weighted field's value counts in its parent; null for the others.

    Fields weighted by the attribute that the coverage goes by have their weights already; only those
    weighted by another attribute are joined to it.
    """
    attr = F.expr("CAST(NULL AS STRING)")
    for field, by in weighted.items():
        attr = F.when(F.col(name) == field, F.lit(by)).otherwise(attr)
    long = long.withColumn("_attr", attr)
    share = F.when(F.col("_attr") == own, F.col("weight") / F.col("total"))
    others = sorted(set(weighted.values()) - {own})
    if not others:
        return long.withColumn("_share", share)
    parts = [weights(static, region_map, by, parent).select("location_id", F.lit(by).alias("_attr"), "parent_id", (F.col("weight") / F.col("total")).alias("_other")) for by in others]
    table = parts[0]
    for more in parts[1:]:
        table = table.unionByName(more)
    return long.join(table, ["location_id", "parent_id", "_attr"], "left").withColumn("_share", F.coalesce(share, "_other"))


def _sum_children(long: DataFrame, keys: list[str], coverage: float | None) -> DataFrame:
    part = F.when(F.col("_attr").isNotNull(), F.col("value") * F.col("_share")).otherwise(F.col("value"))
    out = long.withColumn("_part", part).filter("_part is not null").groupBy(*keys).agg(
        F.sum("_part").alias("value"), (F.sum("weight") / F.max("total")).alias("reporting")
    )
    if coverage is not None:
        out = out.filter(F.col("reporting") >= coverage)
    return out


def aggregate_regions(
    ds: Dataset, region_map: DataFrame, *, weighted: dict[str, str] | None = None, coverage: float | None = None,
    weight: str = "population", excluded: list[str] = NOT_AGGREGATED, parent: str | None = None,
) -> Dataset:
    """Roll children up to their parents, or all mapped locations up to the one ``parent``.

    Values of bucket 'all' are summed per (parent, variable, date); ``weighted`` variables are
    multiplied by the child's share, by the attribute given for the field, of all mapped children,
    without renormalising for missing ones; by default these are the ratios of WEIGHTED. With ``coverage`` a point survives only if the reporting children hold that
    share of the weight. Sums combine map-side, so a parent of everything stays parallel.
    """
    weighted = WEIGHTED if weighted is None else weighted
    if set(weighted.values()) & set(weighted):
        raise ValueError("a field cannot be both weighted and a weight")
    w = weights(ds.static, region_map, weight, parent)
    shares = lambda long, name: _shares(long.join(w, "location_id"), name, weighted, weight, ds.static, region_map, parent)
    obs = ds.obs.filter((F.col("bucket") == "all") & ~F.col("variable").isin(excluded) & F.col("value").isNotNull())
    agg = _sum_children(shares(obs, "variable"), ["parent_id", "variable", "date"], coverage)
    numbers = ds.static.filter(F.col("num").isNotNull() & ~F.col("attr").isin(excluded)).withColumn("value", F.col("num"))
    static = _sum_children(shares(numbers, "attr"), ["parent_id", "attr"], coverage)
    return Dataset(
        agg.select(F.col("parent_id").alias("location_id"), "variable", F.lit("all").alias("bucket"), "date", "value"),
        static.select(F.col("parent_id").alias("location_id"), "attr", F.col("value").alias("num"), F.lit(None).cast("string").alias("str")),
        ds.tags.limit(0),
    )


def reporting_ratio(ds: Dataset, region_map: DataFrame, weight: str = "population") -> DataFrame:
    """Share of the weight of all mapped children that reports each point."""
    w = weights(ds.static, region_map, weight)
    rows = ds.obs.filter("bucket = 'all' and value is not null").join(w, "location_id")
    return rows.groupBy(F.col("parent_id").alias("location_id"), "variable", "date").agg(
        (F.coalesce(F.sum("weight"), F.lit(0.0)) / F.max("total")).alias("reporting")
    )


def rollup_cbsa(ds: Dataset, cbsa_map: DataFrame, **kwargs) -> Dataset:
    """Aggregate counties to CBSAs; a county mapped twice fails the job."""
    from geotally.model import assert_unique

    return aggregate_regions(ds, assert_unique(cbsa_map, ["location_id"]), **kwargs)


def rollup_hsa_broadcast(ds: Dataset, hsa_map: DataFrame, fields: dict[str, str] = HSA_FIELDS) -> Dataset:
    """Sum fields per HSA and write the sum to every member county under its own name."""
    member = hsa_map.select("location_id", R.hsa_location_id(F.col("hsa")).alias("parent_id"))
    picked = ds.obs.filter(F.col("variable").isin(list(fields)) & (F.col("bucket") == "all") & F.col("value").isNotNull())
    sums = picked.join(member, "location_id").groupBy("parent_id", "variable", "date").agg(F.sum("value").alias("value"))
    renamed = F.element_at(F.create_map(*[F.lit(x) for kv in fields.items() for x in kv]), F.col("variable"))
    back = sums.join(member, "parent_id").select(
        "location_id", renamed.alias("variable"), F.lit("all").alias("bucket"), "date", "value"
    )
    return ds.with_obs(ds.obs.select(*POINT, "value").unionByName(back))


def rollup_country(ds: Dataset, members: DataFrame, country: str = "iso1:us", coverage: float | None = COVERAGE, **kwargs) -> Dataset:
    """Append the country; variables it reports itself win over the aggregated ones."""
    own_obs = ds.obs.filter((F.col("location_id") == country) & F.col("value").isNotNull())
    own_attr = ds.static.filter((F.col("location_id") == country) & (F.col("num").isNotNull() | F.col("str").isNotNull()))
    agg = aggregate_regions(ds, members, coverage=coverage, parent=country, **kwargs)
    # Distinct names are few, so the anti joins broadcast them.
    new_obs = agg.obs.join(own_obs.select("variable").distinct(), "variable", "left_anti")
    new_static = agg.static.join(own_attr.select("attr").distinct(), "attr", "left_anti")
    return Dataset(
        ds.obs.select(*POINT, "value").unionByName(new_obs.select(*POINT, "value")),
        ds.static.select(*STATIC).unionByName(new_static.select(*STATIC)), ds.tags,
    )


def rollup_to_one(ds: Dataset, members: DataFrame, target: str, **kwargs) -> Dataset:
    """Sum chosen regions into one new region that keeps the string attributes it has."""
    one = aggregate_regions(ds, members, parent=target, **kwargs)
    return Dataset(
        ds.obs.select(*POINT, "value").unionByName(one.obs.select(*POINT, "value")),
        ds.static.filter((F.col("location_id") != target) | F.col("str").isNotNull()).select(*STATIC)
        .unionByName(one.static.select(*STATIC)),
        ds.tags,
    )


def replace_region_from_parent(ds: Dataset, parent: str, child: str, keep: list[str] = ("hsa_population",)) -> Dataset:
    """Give a region the data of its parent; strings and the listed numbers stay its own."""
    mine = F.col("location_id") == child
    from_parent = ds.obs.filter((F.col("location_id") == parent) & (F.col("bucket") == "all") & ~F.col("variable").isin(NOT_AGGREGATED))
    own = F.col("str").isNotNull() | F.col("attr").isin(list(keep))
    parent_static = ds.static.filter(
        (F.col("location_id") == parent) & F.col("num").isNotNull() & ~F.col("attr").isin(NOT_AGGREGATED)
    )
    return Dataset(
        ds.obs.filter(~mine).select(*POINT, "value")
        .unionByName(from_parent.withColumn("location_id", F.lit(child)).select(*POINT, "value")),
        ds.static.filter(~mine | own).select(*STATIC)
        .unionByName(parent_static.withColumn("location_id", F.lit(child)).select(*STATIC)),
        ds.tags.filter(~mine),
    )


def fill_static_from_children(static: DataFrame, region_map: DataFrame) -> DataFrame:
    """Numbers a parent lacks become the sum over its children."""
    sums = (
        static.filter("num is not null").join(region_map.select("location_id", "parent_id"), "location_id")
        .groupBy(F.col("parent_id").alias("location_id"), "attr").agg(F.sum("num").alias("_sum"))
    )
    return static.join(sums, ["location_id", "attr"], "full").select(
        "location_id", "attr", F.coalesce("num", "_sum").alias("num"), "str"
    )


def rollup_population(counties: DataFrame, existing_states: DataFrame | None = None) -> DataFrame:
    """County populations, an 'Unknown' county per state, states not yet present, and the country.

    ``counties``: state, fips, county, population.
    """
    cols = ["fips", "state", "county", "level", "population"]
    null = F.lit(None).cast("string")
    base = counties.withColumn("level", F.lit("county"))
    unknown = counties.select("state").distinct().select(
        F.concat(R.state_fips_of_code(F.col("state")), F.lit("999")).alias("fips"), "state", F.lit("Unknown").alias("county"),
        F.lit("county").alias("level"), F.lit(None).cast("double").alias("population"),
    )
    states = counties.groupBy("state").agg(F.sum("population").alias("population"))
    if existing_states is not None:
        states = states.join(existing_states.select("state"), "state", "left_anti")
    states = states.select(
        R.state_fips_of_code(F.col("state")).alias("fips"), "state", null.alias("county"), F.lit("state").alias("level"), "population"
    )
    country = states.agg(F.sum("population").alias("population")).select(
        F.lit("0").alias("fips"), null.alias("state"), null.alias("county"), F.lit("country").alias("level"), "population"
    )
    return C.union_all([x.select(*cols) for x in (base, unknown, states, country)])


def hsa_population(population: DataFrame, hsa_map: DataFrame) -> DataFrame:
    """Population of the HSA of each mapped county."""
    rows = population.join(hsa_map, "location_id")
    sums = rows.groupBy("hsa").agg(F.sum("population").alias("hsa_population"))
    return rows.select("location_id", "hsa", F.coalesce("hsa_name", F.lit("Unknown")).alias("hsa_name")).join(sums, "hsa")


def variables_and_locations(ds: Dataset) -> DataFrame:
    """Distinct location ids and variables that occur in any of the three tables."""
    pair = lambda df, c: df.select("location_id", F.col(c).alias("variable"))
    return pair(ds.obs, "variable").unionByName(pair(ds.static, "attr")).unionByName(pair(ds.tags, "variable")).distinct()


def series_has_value(obs: DataFrame) -> DataFrame:
    from geotally.functions import scalars as S

    return obs.groupBy("location_id", "variable", S.bucket_distribution(F.col("bucket")).alias("distribution")).agg(
        F.bool_or(F.col("value").isNotNull()).alias("has_value")
    )


def provenance_text(tags: DataFrame) -> DataFrame:
    """Distinct sources per (location, variable) joined with ';'."""
    return (
        tags.filter("tag_type = 'provenance'").groupBy("location_id", "variable")
        .agg(F.array_join(F.array_sort(F.collect_set("content")), ";").alias("provenance"))
    )


def dataset_counts(obs: DataFrame, groups: DataFrame, geo: DataFrame) -> DataFrame:
    """Observations of bucket all and not all per level and field group."""
    all_ = F.col("bucket") == "all"
    per_series = obs.filter("value is not null").groupBy("location_id", "variable").agg(
        F.count_if(all_).alias("bucket_all"), F.count_if(~all_).alias("bucket_not_all")
    )
    return (
        per_series.join(groups, "variable", "left").join(geo.select("location_id", "level"), "location_id", "left")
        .groupBy("level", "field_group")
        .agg(F.sum("bucket_all").alias("bucket_all"), F.sum("bucket_not_all").alias("bucket_not_all"))
    )


def summarize_level(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, rows without fips, and keys that occur more than once."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(F.col("fips").isNull()).alias("no_fips"))
    return per_key.agg(
        F.sum("n").alias("rows"), F.coalesce(F.sum("no_fips"), F.lit(0)).alias("missing_fips"), F.count_if(F.col("n") > 1).alias("non_unique_keys")
    )


def pivot_by_source(df: DataFrame, group: str, sources: list[str]) -> DataFrame:
    return assert_declared(df, "source", sources).groupBy(group).pivot("source", sources).agg(F.sum("value")).fillna(0.0)


def rt_weighted_by_population(rt: DataFrame, population: DataFrame, members: DataFrame, columns: list[str]) -> DataFrame:
    """Population-weighted mean per date over the members, assigned to each member."""
    rows = rt.join(members.select("location_id"), "location_id", "left_semi").join(population, "location_id")
    mean = rows.groupBy("date").agg(*[
        (F.sum(F.col(c) * F.col("population")) / F.sum(F.when(F.col(c).isNotNull(), F.col("population")))).alias(c) for c in columns
    ])
    points = rt.join(members.select("location_id"), "location_id", "left_semi").select("location_id", "date")
    return points.join(mean, "date").select("location_id", "date", *columns)


def user_activity(log: DataFrame) -> DataFrame:
    """Per email: first date, latest timestamp, distinct active days and requests.

    Requests are counted per (email, day) first, so a hot email is spread over its days.
    """
    daily = log.groupBy("email", F.to_date("timestamp").alias("day")).agg(
        F.count("*").alias("n"), F.max("timestamp").alias("last")
    )
    return daily.groupBy("email").agg(
        F.min("day").alias("signupDate"), F.max("last").alias("latestDate"), F.count("*").alias("daysActive"),
        F.sum("n").alias("totalRequests"),
    )


def recently_active(activity: DataFrame, as_of, days: int = 2) -> DataFrame:
    return activity.filter(F.col("latestDate") >= F.date_sub(F.lit(as_of), days).cast("timestamp"))
