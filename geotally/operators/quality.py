"""Data-quality filters. Each removes observations and writes tags from the same flagged rows."""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from geotally.functions import tagtext as T
from geotally.model import POINT, SERIES, TAG, Dataset, whole_series
from geotally.operators import windows as WN
from geotally.operators.combine import union_all
from geotally.operators.intervals import in_intervals
from geotally.operators.tags import make_tags

# Days exempt from outlier removal, and the date after which the higher threshold holds.
EXEMPT_DAYS = [datetime.date(2021, 7, 5), datetime.date(2021, 7, 6), datetime.date(2021, 7, 7)]
HIGHER_AFTER = (datetime.date(2021, 6, 1), 15.0)

# Cumulative fields whose tail is checked.
CUMULATIVE_FIELDS = [
    "cases", "deaths", "positive_tests", "negative_tests", "total_tests", "positive_tests_viral",
    "positive_cases_viral", "total_tests_viral", "total_tests_people_viral", "total_test_encounters_viral",
]


@dataclass(frozen=True)
class Rule:
    """A manual rule. ``include`` and ``exclude`` are SQL predicates on the geo dimension."""

    include: str
    fields: list[str]
    drop: bool
    note: str = ""
    start: datetime.date | None = None
    end: datetime.date | None = None
    exclude: str | None = None

    @property
    def problem(self) -> str | None:
        if not self.drop and not self.note:
            return "neither drops observations nor adds a note"
        if not self.drop and (self.start or self.end):
            return "a date without dropping has no effect"
        if self.start and self.end and self.end < self.start:
            return "ends before it starts"
        return None


def rule_table(spark, rules: list[Rule]) -> DataFrame:
    """Literal rule rows. Their number is that of the rules in the code."""
    rows = [(i, r.fields, r.drop, r.note, r.start, r.end) for i, r in enumerate(rules)]
    return spark.createDataFrame(rows, "no int, fields array<string>, drop boolean, note string, start date, end date")


def invalid_rules(rules: DataFrame) -> DataFrame:
    """Rules that make no sense, with the reason."""
    keep = ~F.col("drop")
    reason = (
        F.when(keep & (F.col("note") == ""), "neither drops observations nor adds a note")
        .when(keep & (F.col("start").isNotNull() | F.col("end").isNotNull()), "a date without dropping has no effect")
        .when(F.col("end") < F.col("start"), "ends before it starts")
    )
    return rules.withColumn("problem", reason).filter("problem is not null")


def rules_by_location(geo: DataFrame, rules: list[Rule]) -> DataFrame:
    """Per location the list of its rules; a list is at most as long as the rule list."""
    bad = [f"rule {i} {r.problem}" for i, r in enumerate(rules) if r.problem]
    if bad:
        raise ValueError("; ".join(bad))
    table = F.broadcast(rule_table(geo.sparkSession, rules))
    numbers = [
        F.when(F.coalesce(F.expr(r.include) & ~F.expr(r.exclude or "false"), F.lit(False)), F.lit(i))
        for i, r in enumerate(rules)
    ]
    hits = geo.select("location_id", F.explode(F.array_compact(F.array(*numbers))).alias("no"))
    return hits.join(table, "no").groupBy("location_id").agg(
        F.array_sort(F.collect_list(F.struct("no", "fields", "drop", "note", "start", "end"))).alias("rules")
    )


def _flag(obs: DataFrame, per_location: DataFrame) -> DataFrame:
    """Adds the rules of each series and ``kill``, the first rule that drops the point.

    Rules apply in order and a later one sees earlier drops; a point belongs to the first rule
    that covers it, so one pass gives the same result as folding rule by rule.
    """
    mine = F.filter("rules", lambda r: F.array_contains(r["fields"], F.col("variable")))
    rows = obs.filter("value is not null").join(per_location, "location_id", "left").withColumn(
        "rules", F.when(F.col("bucket") == "all", mine)
    )
    covers = lambda r: (
        r["drop"] & (r["start"].isNull() | (F.col("date") >= r["start"])) & (r["end"].isNull() | (F.col("date") <= r["end"]))
    )
    return rows.withColumn("kill", F.array_min(F.transform(F.filter("rules", covers), lambda r: r["no"])))


def manual_filter(ds: Dataset, geo: DataFrame, rules: list[Rule]) -> Dataset:
    """Drop or annotate by the rules, in order. Tags only on series that a rule touched."""
    flagged = _flag(ds.obs, rules_by_location(geo, rules))
    last = 2**30
    touched = (
        flagged.filter(F.size("rules") > 0).groupBy(*SERIES)
        .agg(F.first("rules").alias("rules"), F.collect_set("kill").alias("kills"), F.max(F.coalesce("kill", F.lit(last))).alias("alive"))
    )
    applied = F.filter(
        "rules", lambda r: F.when(r["drop"], F.array_contains(F.col("kills"), r["no"])).otherwise(F.col("alive") > r["no"])
    )
    touched = touched.select(*SERIES, applied.alias("rules"))
    whole = F.filter("rules", lambda r: r["drop"] & r["start"].isNull() & r["end"].isNull())
    touched = touched.withColumn("full", F.array_min(F.transform(whole, lambda r: r["no"])))
    rows = touched.select(*SERIES, "full", F.explode("rules").alias("r")).filter(F.col("full").isNull() | (F.col("r.no") >= F.col("full")))
    date = F.coalesce("r.start", "r.end")
    new = rows.select(
        *SERIES, F.when(date.isNull(), T.KNOWN_ISSUE_NO_DATE).otherwise(T.KNOWN_ISSUE).alias("tag_type"),
        F.when(date.isNull(), T.known_issue_content(F.col("r.note"))).otherwise(T.known_issue_content(F.col("r.note"), date)).alias("content"),
    )
    cleared = touched.filter("full is not null").select(*SERIES)
    kept_tags = ds.tags.join(cleared, SERIES, "left_anti").select(*TAG)
    return Dataset(flagged.filter("kill is null").select(*POINT, "value"), ds.static, kept_tags.unionByName(new))


def touched_subset(before: Dataset, after: Dataset) -> Dataset:
    """Series that lost observations: their old data, old tags and the tags the rules wrote."""
    written = F.col("tag_type").isin(T.KNOWN_ISSUE, T.KNOWN_ISSUE_NO_DATE)
    new = after.tags.filter(written)
    n = lambda ds, name: ds.obs.filter("value is not null").groupBy(*SERIES).agg(F.count("*").alias(name))
    lost = (
        n(before, "n_in").join(n(after, "n_out"), SERIES, "left").filter(F.coalesce("n_out", F.lit(0)) < F.col("n_in"))
        .select(*SERIES).join(new.select(*SERIES).distinct(), SERIES, "left_semi")
    )
    semi = lambda df, cols: df.join(lost, SERIES, "left_semi").select(*cols)
    return Dataset(
        semi(before.obs, POINT + ["value"]), before.static.limit(0), semi(before.tags, TAG).unionByName(semi(new, TAG))
    )


def expand_overrides(text: DataFrame, geo: DataFrame, metric_fields: DataFrame, members: DataFrame) -> DataFrame:
    """Override JSON (column ``json``) to one row per (override, location, field).

    ``metric_fields``: metric, field. ``members``: parent_id, location_id of CBSA members. 'region'
    is the region itself, 'region-and-subregions' a state or CBSA with what lies in it,
    'subregions' the counties of a state.
    """
    item = (
        "region: string, include: string, metric: string, context: string, disclaimer: string, blocked: boolean, "
        "start_date: string, end_date: string"
    )
    one = text.select(F.posexplode(F.from_json("json", f"overrides array<struct<{item}>>")["overrides"]).alias("no", "o"))
    date = lambda c: F.to_date(F.nullif(F.col(c), F.lit("")))
    parts = one.select(
        "no", F.explode(F.transform(F.split(F.col("o.region"), ","), lambda x: F.trim(x))).alias("region"), F.col("o.include").alias("include"),
        F.col("o.metric").alias("metric"), F.coalesce("o.disclaimer", F.lit("")).alias("note"), F.col("o.blocked").alias("drop"),
        date("o.start_date").alias("start"), date("o.end_date").alias("end"),
    )
    is_state = F.col("region").rlike("^[A-Z][A-Z]$")
    ok = is_state | F.col("region").rlike(r"^\d{5}$")
    # The check sits in the value itself: a filter could be pushed below the explode and see other rows.
    bad = F.raise_error(F.concat(F.lit("invalid region: "), F.col("region")))
    parts = parts.withColumn("region", F.when(ok, F.col("region")).otherwise(bad))
    code = F.when(F.col("level") == "state", F.col("state")).otherwise(F.col("fips"))
    g = geo.select("location_id", "state", "level", code.alias("region"))
    keep = ["no", "location_id", "metric", "note", "drop", "start", "end"]
    itself = parts.filter(F.col("include").isin("region", "region-and-subregions")).join(g, "region").select("include", *keep)
    inner = g.filter("level <> 'state'").select("location_id", "level", F.col("state").alias("region"))
    in_state = parts.filter(F.col("include").isin("subregions", "region-and-subregions") & is_state).join(inner, "region").filter((F.col("include") == "region-and-subregions") | (F.col("level") == "county")).select(*keep)
    in_area = itself.filter("include = 'region-and-subregions'").join(
        members.select(F.col("parent_id").alias("location_id"), F.col("location_id").alias("_child")), "location_id"
    ).withColumn("location_id", F.col("_child")).select(*keep)
    all_rows = union_all([itself.select(*keep), in_state, in_area]).distinct()
    return all_rows.join(metric_fields, "metric").select("no", "location_id", "field", "note", "drop", "start", "end")


TAIL, TRUSTED = 14, 28


def _tail_flags(obs: DataFrame, last: Column, days: Column) -> DataFrame:
    """Position from the end of the calendar, and the outcome of each cumulative series."""
    w = whole_series()
    pos = F.datediff(last, "date") + 1
    rows = obs.filter("value is not null").withColumns({"pos": pos, "diff": F.col("value") - WN.previous_day()})
    mean = F.avg(F.when(F.col("pos").between(TAIL + 1, TRUSTED), F.col("diff"))).over(w)
    rows = rows.withColumns({"_mean": mean, "_days": days})
    near = (F.col("pos") <= TAIL) & F.col("diff").isNotNull()
    rows = rows.withColumn("stop", F.min(F.when(near & (F.col("diff") >= F.floor(F.col("_mean") / 100)), F.col("pos"))).over(w))
    stop = F.coalesce("stop", F.lit(TAIL + 1))
    rows = rows.withColumn("under", F.count(F.when(near & (F.col("pos") < stop), 1)).over(w))
    outcome = (
        F.when(F.col("_days") < TRUSTED, "skipped_too_short").when(F.col("_mean").isNull(), "skipped_na_mean")
        .when(F.col("under") == 0, "all_good").when(F.col("under") < 8, "truncated").otherwise("long_truncated")
    )
    return rows.withColumns({"outcome": outcome, "cut": stop - 1, "_last": last})


def tail_filter(ds: Dataset, fields: list[str] = CUMULATIVE_FIELDS, scope: DataFrame | None = None):
    """Cut stalled tails off cumulative series; returns the dataset and the counts per outcome.

    Positions count back from the last date of the whole dataset, or per location from
    ``scope`` (location_id, first, last).
    """
    picked = ds.obs.filter(F.col("variable").isin(fields))
    if scope is None:
        lo, last = ds.obs.agg(F.min("date")).scalar(), ds.obs.agg(F.max("date")).scalar()
        flagged = _tail_flags(picked, last, F.datediff(last, lo) + 1)
    else:
        s = scope.select("location_id", F.col("first").alias("_first"), F.col("last").alias("_end"))
        flagged = _tail_flags(picked.join(s, "location_id"), F.col("_end"), F.datediff("_end", "_first") + 1)
    removed = F.col("outcome").endswith("truncated") & (F.col("pos") <= F.col("cut"))
    cut_value = F.max(F.when(F.col("pos") == F.col("cut"), F.col("value")))
    cuts = flagged.filter(F.col("outcome").endswith("truncated")).groupBy(*SERIES, "outcome", "cut", "_last").agg(cut_value.alias("original"))
    tags = cuts.select(
        *SERIES, F.when(F.col("outcome") == "truncated", T.CUMULATIVE_TAIL).otherwise(T.CUMULATIVE_LONG_TAIL).alias("tag_type"),
        T.dated_content(F.date_sub("_last", F.col("cut")), F.col("original")).alias("content"),
    )
    counts = flagged.groupBy(*SERIES).agg(F.first("outcome").alias("outcome")).groupBy("outcome").agg(F.count("*").alias("n"))
    rest = ds.obs.filter(~F.col("variable").isin(fields)).select(*POINT, "value")
    out = ds.with_obs(rest.unionByName(flagged.filter(~removed).select(*POINT, "value"))).add_tags(tags)
    return out, counts


def drop_all_zero_series(ds: Dataset, fields: list[str]) -> Dataset:
    """Drop series of the fields that hold only zeros; their tags stay."""
    nonzero = F.bool_or(F.col("value") != 0).over(whole_series())
    picked = F.col("variable").isin(fields)
    kept = ds.obs.filter(picked & F.col("value").isNotNull()).withColumn("_keep", nonzero).filter("_keep")
    return ds.with_obs(ds.obs.filter(~picked).select(*POINT, "value").unionByName(kept.select(*POINT, "value")))


def exclude_points(ds: Dataset, flagged: DataFrame, others: DataFrame) -> Dataset:
    """Remove the rows with ``outlier`` set, each with a z-score tag. ``others`` pass through."""
    tags = flagged.filter("outlier").select(
        *SERIES, F.lit(T.ZSCORE).alias("tag_type"), T.dated_content(F.col("date"), F.col("value")).alias("content")
    )
    kept = flagged.filter(~F.col("outlier")).select(*POINT, "value")
    return ds.with_obs(others.select(*POINT, "value").unionByName(kept)).add_tags(tags)


def exclude_observations(ds: Dataset, points: DataFrame) -> Dataset:
    """Remove given points and tag them."""
    mark = points.select(*POINT).distinct().withColumn("_hit", F.lit(True))
    flagged = ds.obs.filter("value is not null").join(mark, POINT, "left").withColumn("outlier", F.coalesce("_hit", F.lit(False)))
    return exclude_points(ds, flagged, ds.obs.limit(0))


def drop_series_outliers(
    ds: Dataset, field: str, threshold: float = 8.0, higher_after: tuple[datetime.date, float] | None = None,
    min_value: float = 30, exempt: list[datetime.date] = EXEMPT_DAYS, skip: DataFrame | None = None,
) -> Dataset:
    """Remove values far from those of the previous 10 days. ``skip``: locations left alone."""
    mine = F.col("variable") == field
    picked, others = ds.obs.filter(mine & F.col("value").isNotNull()), ds.obs.filter(~mine)
    if skip is not None:
        ids = skip.select("location_id")
        others = others.select(*POINT, "value").unionByName(picked.join(ids, "location_id", "left_semi").select(*POINT, "value"))
        picked = picked.join(ids, "location_id", "left_anti")
    limit = F.lit(float(threshold))
    if higher_after:
        limit = F.when(F.col("date") > F.lit(higher_after[0]), float(higher_after[1])).otherwise(limit)
    out = WN.exceeds(limit) & (F.col("value") > min_value) & ~F.col("date").isin(exempt)
    return exclude_points(ds, WN.modified_zscore(picked).withColumn("outlier", out), others)


def drop_tail_ratio_outliers(ds: Dataset, field: str, threshold: float = 10.0, min_diff: float = 0.015, scope: DataFrame | None = None) -> Dataset:
    """Remove the last real point of a ratio when it jumps, judged on the last 10 calendar days.

    Days count back from the last date of the whole dataset, or per location from ``scope``
    (location_id, first, last).
    """
    mine = F.col("variable") == field
    rows = ds.obs.filter(mine & F.col("value").isNotNull()).withColumn("diff", F.abs(F.col("value") - WN.previous_day()))
    if scope is None:
        rows = rows.withColumn("_end", ds.obs.agg(F.max("date")).scalar())
    else:
        rows = rows.join(scope.select("location_id", F.col("last").alias("_end")), "location_id")
    recent = F.datediff("_end", "date") < 10
    z = WN.modified_zscore(rows.filter(recent), window=5, ignore_zeros=False)
    defined = F.col("std").isNotNull() & ((F.col("std") > 0) | (F.col("x") != F.col("mean")))
    z = z.withColumn("_at", F.max(F.when(defined, F.col("date"))).over(whole_series()))
    out = F.coalesce((F.col("date") == F.col("_at")) & WN.exceeds(threshold) & (F.col("diff") > min_diff), F.lit(False))
    flagged = z.withColumn("outlier", out).select(*POINT, "value", "outlier")
    others = ds.obs.filter(~mine).select(*POINT, "value").unionByName(rows.filter(~recent).select(*POINT, "value"))
    return exclude_points(ds, flagged, others)


def anomaly_rules(listed: DataFrame, geo: DataFrame, prefix: str = "NYTimes: ") -> DataFrame:
    """An anomaly list as rules: location_id, variable, start, end, note, omit.

    ``listed`` has date, end_date, geoid, type (cases, deaths or both), omit_from_rolling_average,
    omit_from_rolling_average_on_subgeographies and description. A row of a state that is omitted in its counties
    also stands for each of them, omitted; ``both`` is two rows, a missing end is the same day, and a place that
    ``geo`` lacks is left out.
    """
    rows = listed.select(
        F.regexp_replace("geoid", "^USA-", "").alias("fips"), F.col("date").alias("start"), F.coalesce("end_date", "date").alias("end"),
        (F.col("omit_from_rolling_average") == "yes").alias("omit"), (F.col("omit_from_rolling_average_on_subgeographies") == "yes").alias("_below"),
        F.explode(F.when(F.col("type") == "both", F.array(F.lit("cases"), F.lit("deaths"))).otherwise(F.array("type"))).alias("type"),
        F.concat(F.lit(prefix), "description").alias("note"))
    counties = geo.filter("level = 'county'").select(F.substring("fips", 1, 2).alias("fips"), F.col("fips").alias("_county"))
    below = rows.filter(F.col("_below") & (F.length("fips") == 2)).join(counties, "fips")
    every = rows.unionByName(below.withColumns({"fips": F.col("_county"), "omit": F.lit(True)}).drop("_county"))
    names = F.when(F.col("type") == "cases", "new_cases").when(F.col("type") == "deaths", "new_deaths")
    known = F.when(names.isNull(), F.raise_error(F.concat(F.lit("unknown anomaly type "), "type")).cast("string")).otherwise(names)
    return every.join(geo.select("fips", "location_id"), "fips").select(
        "location_id", known.alias("variable"), "start", "end", "note", F.coalesce("omit", F.lit(False)).alias("omit"))


def anomaly_filter(ds: Dataset, rules: DataFrame, exempt: Column | None = None) -> Dataset:
    """Remove known anomalies (location_id, variable, start, end, note) of bucket 'all' and tag them.

    Rules that have a column ``omit`` apply only where it is true. Ranges are matched by bins of days and may be open
    at either end. A day is tagged when the location reports anything on it.
    """
    if "omit" in rules.columns:
        rules = rules.filter("omit").drop("omit")
    rules = rules.withColumn("bucket", F.lit("all"))
    live = lambda df: df if exempt is None else df.filter(~exempt)
    reported = ds.obs.filter("bucket = 'all' and value is not null").select("location_id", "date").distinct()
    hits = live(in_intervals(reported, rules, ["location_id"]))
    tags = hits.select(*SERIES, F.lit(T.KNOWN_ISSUE).alias("tag_type"), T.known_issue_content(F.col("note"), F.col("date")).alias("content"))
    gone = live(in_intervals(ds.obs.select(*POINT), rules.drop("note"), SERIES)).distinct()
    return ds.with_obs(ds.obs.join(gone, POINT, "left_anti").select(*POINT, "value")).add_tags(tags)


def rt_input_gate(series: DataFrame, smoothed: str = "smoothed", value: str = "value", by: str = "location_id") -> DataFrame:
    """Whether each location has enough data for an estimate."""
    return series.groupBy(by).agg(
        F.coalesce(
            (F.count(value) > 20) & (F.sum(value) > 20) & (F.max(value) > 5) & (F.max(smoothed) > 5), F.lit(False)
        ).alias("qualifies")
    )
