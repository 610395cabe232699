"""The whole run: merge sources, clean each parent group in a fixed order, roll up, publish.

Steps of one operator stay lazy. Where several later steps read the same result, a table is written,
so building the run already starts jobs.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from geotally.model import POINT, SERIES, STATIC, TAG, Dataset, materialize, materialize_by_series, whole_series
from geotally.operators import (
    combine as C, filters, layout as LY, levels as LV, measures as M, publish as PB, quality as Q, rollup as RU, tags as TG, windows as WN)
from geotally.sources import writers as WR


@dataclass(frozen=True)
class Config:
    """What the cleaning needs to know. Names of fields default to the usual ones."""

    as_of: datetime.date
    rules: list[Q.Rule] = field(default_factory=list)
    cumulative: list[str] = field(default_factory=lambda: list(Q.CUMULATIVE_FIELDS))
    zero_fields: list[str] = field(default_factory=lambda: [
        "vaccines_distributed", "vaccines_administered", "vaccinations_completed", "vaccinations_initiated",
        "vaccinations_additional_dose", "vaccinations_2022_fall_bivalent_dose"])
    ratio: str = "test_positivity_7d"
    incidents: dict[str, str] = field(default_factory=lambda: {"cases": "new_cases", "deaths": "new_deaths"})
    weekly: dict[str, str] = field(default_factory=lambda: {"new_hospital_admissions_covid": "weekly_new_hospital_admissions_covid"})
    weekly_level: str = "state"
    estimate: tuple[str, str] | None = ("vaccinations_initiated", "vaccinations_completed")
    #: predicate over the geo dimension, variable, first and last day
    spread_ranges: list[tuple[str, str, datetime.date, datetime.date]] = field(default_factory=list)
    #: predicate over location_id, variable and date of anomalies that a spread range has dealt with
    anomalies_exempt: str | None = None
    outliers: dict[str, tuple] = field(default_factory=lambda: {"new_cases": Q.HIGHER_AFTER, "new_deaths": None})
    outlier_skip: str = "level = 'county' and state = 'FL'"
    fill_static: str | None = None
    city: tuple[str, str] | None = None
    replace: tuple[str, str] | None = None
    coverage: float = RU.COVERAGE


def stored(ds: Dataset, name: str) -> Dataset:
    """The dataset as tables in buckets by series, so that the steps that read it shuffle nothing by series."""
    return Dataset(materialize_by_series(ds.obs.select(*POINT, "value"), f"{name}-obs"), ds.static, materialize_by_series(ds.tags.select(*TAG), f"{name}-tags"))


def derived(ds: Dataset, obs: DataFrame) -> Dataset:
    """New variables of a dataset's regions; joining them fails if one exists already."""
    return Dataset(obs.select(*POINT, "value"), ds.static.limit(0), ds.tags.limit(0))


def merge(obs: DataFrame, tags: DataFrame, static: DataFrame, features: dict, static_features: dict) -> Dataset:
    """Priority merge of stacked sources (each table with a ``source`` column), written as a table
    because observations, tags and every cleaning step read it."""
    spark = obs.sparkSession
    points, kept = C.combine_by_priority(obs, tags, C.feature_priorities(spark, features))
    attrs = C.combine_static_by_priority(static, C.feature_priorities(spark, static_features))
    ds = stored(Dataset(points, attrs.select(*STATIC), kept), "merged")
    return ds.with_static(materialize(ds.static, "merged-static"))


def calendar_scope(obs: DataFrame, parents: DataFrame) -> DataFrame:
    """location_id, first, last: the calendar of the parent group a location is cleaned with."""
    group = F.coalesce("parent_id", "location_id")
    x = obs.groupBy("location_id").agg(F.min("date").alias("a"), F.max("date").alias("b")).join(
        parents.select("location_id", "parent_id"), "location_id", "left").withColumn("group", group)
    bounds = x.groupBy("group").agg(F.min("a").alias("first"), F.max("b").alias("last"))
    return x.select("location_id", "group").join(bounds, "group").select("location_id", "first", "last")


def by_rules(ds: Dataset, geo: DataFrame, cfg: Config) -> tuple[Dataset, Dataset]:
    """The dataset after the manual rules, and the series that they touched."""
    if not cfg.rules:
        return ds, Dataset(ds.obs.limit(0), ds.static.limit(0), ds.tags.limit(0))
    after = stored(Q.manual_filter(ds, geo, cfg.rules), "manual")
    return after, Q.touched_subset(ds, after)


def clean(ds: Dataset, geo: DataFrame, parents: DataFrame, anomalies: DataFrame | None, cfg: Config) -> tuple[Dataset, Dataset]:
    """Fixed order: manual rules, future values, ratio tails, stalled tails, zeros, estimates,
    incidents, weekly sums, spread ranges, anomalies, outliers, population, then the configured
    special regions: ``fill_static`` (a parent whose missing attributes are sums over its
    children), ``city`` (predicate of its members, id) and ``replace`` (parent, child). Returns the
    cleaned dataset and the series that the manual rules touched."""
    ds, touched = by_rules(ds, geo, cfg)
    ds = filters.drop_future_observations(ds, cfg.as_of)
    ds = Q.drop_tail_ratio_outliers(ds, cfg.ratio, scope=calendar_scope(ds.obs, parents))
    ds = stored(ds, "ratio")
    ds, _ = Q.tail_filter(ds, cfg.cumulative, calendar_scope(ds.obs, parents))
    ds = Q.drop_all_zero_series(ds, cfg.zero_fields)
    if cfg.estimate:
        target, known = cfg.estimate
        ds = M.estimate_from_parent_ratio(ds, parents, target, known, cfg.as_of, f"estimate_{target}")
    ds = stored(ds, "tails")
    ds = C.join_columns(ds, derived(ds, WN.incident_from_cumulative(ds.obs, cfg.incidents)))
    if cfg.weekly:
        level = geo.filter(F.col("level") == cfg.weekly_level).select("location_id")
        daily = ds.obs.filter(F.col("variable").isin(list(cfg.weekly))).join(level, "location_id", "left_semi")
        ds = C.join_columns(ds, derived(ds, M.rename_variable(WN.rolling_sum(daily), cfg.weekly)))
    for where, variable, start, end in cfg.spread_ranges:
        inside = geo.filter(where).select("location_id", F.lit(True).alias("_inside"))
        marked = ds.obs.join(inside, "location_id", "left").withColumn("_inside", F.coalesce("_inside", F.lit(False)))
        patched = WN.patch_date_range_spread(marked, F.col("_inside") & (F.col("variable") == variable), start, end)
        ds = ds.with_obs(patched.select(*POINT, "value"))
    if anomalies is not None:
        ds = Q.anomaly_filter(ds, anomalies, None if cfg.anomalies_exempt is None else F.expr(cfg.anomalies_exempt))
    for variable, later in cfg.outliers.items():
        ds = Q.drop_series_outliers(ds, variable, 8.0, later, skip=geo.filter(cfg.outlier_skip))
    ds = stored(filters.drop_regions_without_population(ds), "clean")
    if cfg.fill_static:
        children = parents.filter(F.col("parent_id") == cfg.fill_static)
        ds = ds.with_static(RU.fill_static_from_children(ds.static, children))
    if cfg.city:
        ds = RU.rollup_to_one(ds, geo.filter(cfg.city[0]), cfg.city[1])
    if cfg.replace:
        ds = RU.replace_region_from_parent(ds, *cfg.replace)
    return ds, touched


def roll_up(ds: Dataset, hsa_map: DataFrame, cbsa_map: DataFrame, members: DataFrame, cfg: Config, weighted: dict | None = None, hsa_fields: dict = RU.HSA_FIELDS) -> Dataset:
    """Write HSA totals to their counties, append CBSAs and the country of all ``members``."""
    ds = RU.rollup_hsa_broadcast(ds, hsa_map, hsa_fields)
    areas = RU.rollup_cbsa(ds, cbsa_map, coverage=cfg.coverage, weighted=weighted)
    country = RU.rollup_country(ds, members, coverage=cfg.coverage, weighted=weighted)
    return Dataset(
        country.obs.unionByName(areas.obs.select(*POINT, "value")), country.static.unionByName(areas.static.select(*STATIC)), ds.tags)


def metrics(
    ds: Dataset, new_cases: str = "new_cases", rt: DataFrame | None = None, positivity: DataFrame | None = None, geo: DataFrame | None = None,
) -> DataFrame:
    """Daily metrics of every region. Counties of ``geo`` take hospital figures of their HSA; the one county that is
    a state of its own keeps its own."""
    counties = None if geo is None else geo.filter("level = 'county' and fips <> '11001'").select("location_id")
    return M.all_metrics(ds, counties, new_cases, rt, positivity)


def summaries(ds: Dataset, geo: DataFrame, daily: DataFrame, external: DataFrame | None = None) -> DataFrame:
    """One nested row per region: latest values and metrics, levels, annotations of its fields, demographic distributions.

    ``daily`` is the metrics table; ``external`` holds community levels from outside (location_id, date, value).
    """
    spark = ds.obs.sparkSession
    latest = RU.latest_values(ds.obs.filter("bucket = 'all'"), ["location_id", "variable"])
    wide = latest.groupBy("location_id").pivot("variable", PB.ACTUAL_FIELDS).agg(F.first("value"))
    now = M.latest_metrics(daily, [c for c in daily.columns if c not in ("location_id", "date")])
    risks = LV.risk_columns(now)
    risks = risks.select("location_id", "overall", *[F.col(c).alias(c.removesuffix("_risk")) for c in risks.columns if c.endswith("_risk")])
    transmission = now.select("location_id", LV.transmission_level(F.col("caseDensity"), F.col("testPositivityRatio")).alias("cdcTransmissionLevel"))
    community = LV.community_latest(LV.community_timeseries(daily, external))
    fields = spark.createDataFrame(list(PB.ANNOTATED.items()), "field string, variable string")
    return PB.region_summary(
        geo, wide, now, risks, transmission, community, TG.field_annotations(ds.tags, F.broadcast(fields)), LY.demographic_distributions(ds.obs))


def daily_parts(ds: Dataset, daily: DataFrame) -> dict[str, DataFrame]:
    """The daily rows that are published beside the summaries: actuals, metrics and levels."""
    wide = LY.to_wide_variables(ds.obs.filter(F.col("bucket") == "all").filter(F.col("variable").isin(PB.ACTUAL_FIELDS)), PB.ACTUAL_FIELDS, ["location_id", "date"])
    return {
        "actuals": PB.actuals_rows(wide).select("location_id", "date", "actuals.*"), "metrics": PB.metric_rows(daily),
        "riskLevels": LV.risk_timeseries(daily), "cdcTransmissionLevel": LV.transmission_timeseries(daily),
    }


# The kinds of published files; each is a folder with one folder per level inside.
PUBLISHED = ("summary_json", "timeseries_json", "summary_csv", "timeseries_csv")


def publish(
    geo: DataFrame, summary: DataFrame, parts: dict[str, DataFrame], path: str, order: dict[str, list[str]] | None = None,
    by_region: bool = False,
) -> None:
    """Write the summary of every region, its daily rows, and flat tables of both.

    JSON holds one record per region under level and state; CSV has nested fields as dotted columns, in the
    declared ``order`` of its kind. Under each kind, a folder named as the published file holds a level's parts.
    The summary is written first and read for the others, so it is made once. ``by_region`` adds files of single
    regions and of the counties of each state (``publish_by_region``).
    """
    summary = materialize(WR.without_nan(summary), "summary")
    order = order or {}
    header = geo.select(*[c for c in geo.columns if c in summary.columns])
    timeseries = WR.without_nan(PB.region_timeseries(summary, {f"{name}Timeseries": part for name, part in parts.items()}))
    daily = PB.flat_rows(header, parts)
    if by_region:
        timeseries, daily = materialize(timeseries, "timeseries"), materialize(daily, "daily")
    tables = {"summary_json": summary, "timeseries_json": timeseries, "summary_csv": _without_lists(summary), "timeseries_csv": daily}

    def level(kind: str) -> Column:
        return WR.bulk_file(F.col("level"), kind.rsplit("_", 1)[1], kind.startswith("timeseries"))

    for kind in PUBLISHED:
        _write(tables[kind].withColumn("_file", level(kind)), kind, f"{path}/{kind}", order)
    if by_region:
        publish_by_region(tables, path, order)


def publish_by_region(tables: dict[str, DataFrame], path: str, order: dict[str, list[str]]) -> None:
    """A file per region and kind under ``regions``, flat daily rows for states and the country only, and under
    ``states`` the counties of each state. Folders are named by level and published file.

    A region is one record (or its days), a state has as many as it has counties; rows are dealt by file before
    they are written, so a file has one part unless it is large.
    """
    c = F.col

    def named(df: DataFrame, file: Column) -> DataFrame:
        return df.withColumns({"_level": c("level"), "_file": F.substring_index(file, "/", -1)})

    for kind, df in tables.items():
        suffix, dated = kind.rsplit("_", 1)[1], kind.startswith("timeseries")
        alone = {"summary_json": df, "timeseries_json": df, "timeseries_csv": df.filter(c("level").isin("state", "country"))}
        if kind in alone:
            single = WR.output_file(c("level"), c("state"), c("fips"), c("country"), suffix, dated)
            _write(named(alone[kind], single), kind, f"{path}/regions/{kind}", order)
        of_state = named(df.filter("level = 'county' and state is not null"), WR.bulk_file(c("level"), suffix, dated, c("state")))
        _write(of_state, kind, f"{path}/states/{kind}", order)


def _without_lists(df: DataFrame) -> DataFrame:
    return df.drop(*[f.name for f in df.schema if f.dataType.typeName() in ("map", "array")])


def _write(df: DataFrame, kind: str, path: str, order: dict[str, list[str]]) -> None:
    """One folder per value of ``_level`` and ``_file``."""
    folders = [c for c in df.columns if c in ("_level", "_file")]
    if kind.endswith("csv"):
        df = WR.flatten_struct(df, order.get(kind) and [*order[kind], *folders])
    out = df.hint("rebalance", *folders).write.partitionBy(*folders)
    out.json(path) if kind.endswith("json") else out.csv(path, header=True)
