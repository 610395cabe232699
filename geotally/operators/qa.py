"""Comparison of snapshots, availability and statistics reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from geotally.functions import scalars as S, tagtext as TT
from geotally.model import POINT, SERIES, TAG, Dataset, day, series_window, whole_series, assert_declared
from geotally.operators import combine as C, layout as L, windows as WN
from geotally.operators.rollup import latest_values
from geotally.sources import versions

PAIR = ["variable", "location_id"]


def diff_prepare(wide: DataFrame) -> DataFrame:
    """Long form of a (location_id, date, …) frame without string columns.

    All copies of a duplicated key are dropped, not all but one. Copies are counted by a map-side
    aggregation, so a key with very many of them is no hot task.
    """
    names = [f.name for f in wide.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in ("location_id", "date")]
    doubles = [F.max(F.col(c).cast("double")).alias(c) for c in names]
    single = wide.groupBy("location_id", "date").agg(F.count("*").alias("_n"), *doubles).filter("_n = 1")
    return single.unpivot(["location_id", "date"], names, "variable", "value").filter("value is not null")


def duplicates_dropped(wide: DataFrame) -> DataFrame:
    return wide.groupBy("location_id", "date").agg(F.count("*").alias("n")).filter("n > 1")


def series_only_in_one(left: DataFrame, right: DataFrame) -> DataFrame:
    a, b = left.select(*PAIR).distinct(), right.select(*PAIR).distinct()
    side = lambda df, s: df.withColumn("side", F.lit(s))
    return side(a.join(b, PAIR, "left_anti"), "left").unionByName(side(b.join(a, PAIR, "left_anti"), "right"))


def series_digests(left: DataFrame, right: DataFrame) -> DataFrame:
    """PAIR, ``same`` and the number of points ``n`` of the series that both sides have.

    Counts and sums of row hashes are compared, one small row per series. A series with a missing value
    on either side does not count as the same, so that its points are looked at.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        whole = versions.digests(df.select(*PAIR, "date", "value"), PAIR, extra=[F.count_if(F.col("value").isNull()).alias("missing")])
        return whole.select(*PAIR, F.struct("n", "low", "high", "missing").alias(name))

    both = side(left, "_a").join(side(right, "_b"), PAIR)
    return both.select(*PAIR, F.col("_a.n").alias("n"), ((F.col("_a") == F.col("_b")) & (F.col("_a.missing") == 0)).alias("same"))


def joined_points(left: DataFrame, right: DataFrame) -> DataFrame:
    """Points side by side of the series that both sides have and that are not the same on both."""
    key = PAIR + ["date"]
    differ = series_digests(left, right).filter("not same").select(*PAIR)
    left, right = left.join(differ, PAIR, "left_semi"), right.join(differ, PAIR, "left_semi")
    both = left.select(*key, F.col("value").alias("l")).join(right.select(*key, F.col("value").alias("r")), key, "full")
    w = W.partitionBy(*PAIR)
    return both.withColumn("_both", (F.count("l").over(w) > 0) & (F.count("r").over(w) > 0)).filter("_both").drop("_both")


def points_only_in_one(left: DataFrame, right: DataFrame) -> DataFrame:
    x = joined_points(left, right)
    return x.filter("l is null or r is null").select(
        *PAIR, "date", F.when(F.col("r").isNull(), "left").otherwise("right").alias("side"), F.coalesce("l", "r").alias("value"))


def _interpolated(c: str) -> Column:
    """Linear in time between real values, the last real value after the end, NULL before the start."""
    known = F.col(c).isNotNull()
    back = W.partitionBy(*PAIR).orderBy(day()).rowsBetween(W.unboundedPreceding, 0)
    ahead = W.partitionBy(*PAIR).orderBy(day().desc()).rowsBetween(W.unboundedPreceding, 0)
    v0, d0 = F.last(c, True).over(back), F.last(F.when(known, day()), True).over(back)
    v1, d1 = F.last(c, True).over(ahead), F.last(F.when(known, day()), True).over(ahead)
    return F.when(known, F.col(c)).when(v1.isNull() | v0.isNull(), v0).otherwise(v0 + (v1 - v0) * (day() - d0) / (d1 - d0))


def diff_smape(left: DataFrame, right: DataFrame) -> DataFrame:
    """Per common series the symmetric mean absolute difference over the overlapping range."""
    w = W.partitionBy(*PAIR)
    span = lambda f, c: f(F.when(F.col(c).isNotNull(), F.col("date"))).over(w)
    x = joined_points(left, right).withColumns({
        "start": F.greatest(span(F.min, "l"), span(F.min, "r")), "end": F.least(span(F.max, "l"), span(F.max, "r")),
    })
    inside = x.filter(F.col("date").between(F.col("start"), F.col("end")))
    both = inside.withColumns({"li": _interpolated("l"), "ri": _interpolated("r")})
    sums = both.groupBy(*PAIR).agg(
        (F.coalesce(F.sum("li"), F.lit(0.0)) + F.coalesce(F.sum("ri"), F.lit(0.0))).alias("total"),
        F.coalesce(F.sum(F.abs(F.col("ri") - F.col("li"))), F.lit(0.0)).alias("delta"), F.count("*").alias("points_overlap"),
    )
    small = F.when(F.abs("delta") < 0.0001, 0.0).otherwise(1.0)
    scored = sums.select(
        *PAIR, F.when(F.abs("total") > 0.0001, F.try_divide("delta", "total")).otherwise(small).alias("diff"), "points_overlap", F.lit(True).alias("has_overlap"))
    apart = x.filter("start > end").select(*PAIR).distinct().select(
        *PAIR, F.lit(1.0).alias("diff"), F.lit(0).cast("bigint").alias("points_overlap"), F.lit(False).alias("has_overlap"))
    equal = series_digests(left, right).filter("same").select(
        *PAIR, F.lit(0.0).alias("diff"), F.col("n").alias("points_overlap"), F.lit(True).alias("has_overlap"))
    return scored.unionByName(apart).unionByName(equal)


def diff_top_series(diffs: DataFrame, k: int = 20) -> DataFrame:
    return diffs.orderBy(F.desc("diff"), *PAIR).limit(k)


def diff_top_variables(diffs: DataFrame, k: int = 20) -> DataFrame:
    means = diffs.groupBy("variable", "has_overlap").agg(F.avg("diff").alias("diff"), F.avg("points_overlap").alias("points_overlap"))
    return means.orderBy(F.desc("diff"), "variable", "has_overlap").limit(k)


def removed(old: Dataset, new: Dataset) -> Dataset:
    """Series, tags and static values of ``old`` that ``new`` lacks altogether."""
    key = SERIES + ["tag_type"]
    return Dataset(
        old.obs.filter("value is not null").join(new.obs.filter("value is not null").select(*SERIES).distinct(), SERIES, "left_anti").select(*POINT, "value"),
        old.static.join(new.static.select("location_id", "attr").distinct(), ["location_id", "attr"], "left_anti").select(old.static.columns),
        old.tags.join(new.tags.select(*key).distinct(), key, "left_anti").select(*TAG),
    )


def field_summary(obs: DataFrame, by: list[str] = SERIES) -> DataFrame:
    """Range, extremes, latest value, count and the largest daily change with its first date."""
    x = obs.filter("value is not null").withColumn("delta", F.abs(F.col("value") - WN.previous_day()))
    best = F.max(F.when(F.col("delta").isNotNull(), F.struct("delta", (-day()).alias("minus"))))
    return x.groupBy(*by).agg(
        F.lit(True).alias("has_value"), F.min("date").alias("min_date"), F.max("date").alias("max_date"), F.max("value").alias("max_value"),
        F.min("value").alias("min_value"), F.max_by("value", "date").alias("latest_value"), F.count("*").alias("num_observations"), best.alias("_b"),
    ).select("*", F.col("_b.delta").alias("largest_delta"), F.date_from_unix_date((-F.col("_b.minus")).cast("int")).alias("largest_delta_date")).drop("_b")


def summary_changes(old: DataFrame, new: DataFrame, keys: list[str] = PAIR) -> DataFrame:
    """New, dropped and changed rows between two summaries, with the names of changed columns."""
    values = [c for c in old.columns if c not in keys]
    a = old.select(*keys, *[F.col(c).alias(f"a_{c}") for c in values], F.lit(1).alias("_a"))
    b = new.select(*keys, *[F.col(c).alias(f"b_{c}") for c in values], F.lit(1).alias("_b"))
    names = F.array_compact(F.array(*[F.when(~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")), F.lit(c)) for c in values]))
    status = F.when(F.col("_a").isNull(), "new").when(F.col("_b").isNull(), "dropped").when(F.size("names") > 0, "changed")
    x = a.join(b, keys, "full").withColumn("names", names).withColumn("status", status).filter("status is not null")
    return x.select(*keys, "status", F.when(F.col("status") == "changed", F.array_join(F.array_sort("names"), ",")).alias("changed"))


def availability_report(latest: DataFrame, fields: list[str]) -> DataFrame:
    """Locations with a value per field and state, ordered by population; states form one group."""
    group = F.when(F.col("level") == "state", "state data").otherwise(F.col("state"))
    counts = latest.groupBy(group.alias("group")).agg(*[F.count(f).alias(f) for f in fields], F.sum("population").alias("_pop"))
    return counts.orderBy(F.desc_nulls_last("_pop"), "group").drop("_pop")


def source_comparison(obs: DataFrame, sources: list[str], diff: bool = False, after=None, before=None) -> DataFrame:
    """One column per source by (location, date), optionally as the change to the row before."""
    x = obs
    if after is not None:
        x = x.filter(F.col("date") > F.lit(after))
    if before is not None:
        x = x.filter(F.col("date") < F.lit(before))
    if diff:
        w = W.partitionBy("location_id", "source").orderBy(day())
        x = x.withColumn("value", F.col("value") - F.lag("value").over(w))
    return assert_declared(x, "source", sources).groupBy("location_id", "date").pivot("source", sources).agg(F.first("value"))


def series_stats(ds: Dataset, geo: DataFrame, groups: DataFrame) -> DataFrame:
    """One row per series: data, annotations, observations, tags per type, source types."""
    obs = ds.obs.filter("value is not null").groupBy(*SERIES).agg(F.count("*").alias("observation_count"))
    of = lambda *types: F.count_if(F.col("tag_type").isin(*types))
    kind = F.when(F.col("tag_type") == TT.SOURCE, F.get_json_object("content", "$.type"))
    tags = ds.tags.groupBy(*SERIES).agg(
        of(*TT.ANNOTATIONS).alias("annotation_count"), *[of(t).alias(t) for t in TT.TYPES],
        F.array_join(F.array_sort(F.collect_set(kind)), ";").alias("source_type_set"),
    )
    counts = ["annotation_count", *TT.TYPES]
    zero = {c: F.coalesce(c, F.lit(0)) for c in counts}
    x = obs.join(tags, SERIES, "left").withColumns(zero | {
        "source_type_set": F.coalesce("source_type_set", F.lit("")), "has_timeseries": F.lit(1), "bucket_all_count": (F.col("bucket") == "all").cast("int"),
        "distribution": S.bucket_distribution(F.col("bucket")),
    })
    x = x.join(geo.select("location_id", "level", "state"), "location_id", "left").join(groups, "variable", "left")
    return x.select(*SERIES, "distribution", "level", "state", "field_group", "has_timeseries", "bucket_all_count", "observation_count", *counts, "source_type_set")


STATS = ["has_timeseries", "bucket_all_count", "observation_count", "annotation_count", *TT.TYPES]


def stats_group_by(stats: DataFrame, *keys: str) -> DataFrame:
    return stats.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in STATS])


def stats_for_locations(stats: DataFrame, locations: DataFrame) -> DataFrame:
    """Per location, zero where it has no series, with the count of series not in bucket 'all'."""
    x = locations.select("location_id").join(stats_group_by(stats, "location_id"), "location_id", "left").fillna(0, STATS)
    return x.withColumn("bucket_not_all", F.col("has_timeseries") - F.col("bucket_all_count"))


def metric_differs(a: Column, b: Column, threshold: float = 10, absolute: bool = False) -> Column:
    """Percent distance from the average above the threshold; averages below 20 are ignored."""
    if absolute:
        return F.round(F.abs(b - a), 4) > threshold
    average = (a + b) / 2
    percent = F.try_divide(F.abs(average - a), a) * 100
    return F.when(average < 20, False).otherwise(F.coalesce(percent > threshold, F.lit(False)))


def nested_differences(old: DataFrame, new: DataFrame, key: str = "location_id") -> DataFrame:
    """Leaves of nested summaries whose values differ: key, path, old and new value as text.

    Whole summaries are compared by a digest first; only those that differ are taken apart and joined leaf by leaf.
    """
    from geotally.sources.writers import flatten_struct

    digest = lambda df, name: df.select(key, F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])), 256).alias(name))
    differ = digest(old, "_a").join(digest(new, "_b"), key, "full").filter(~F.col("_a").eqNullSafe(F.col("_b"))).select(key)
    old, new = old.join(differ, key, "left_semi"), new.join(differ, key, "left_semi")

    def leaves(df, name):
        flat = flatten_struct(df)
        columns = [c for c in flat.columns if c != key]
        text = flat.select(key, *[F.col(f"`{c}`").cast("string").alias(c) for c in columns])
        return text.unpivot([key], [F.col(f"`{c}`") for c in columns], "path", name)

    return leaves(old, "old").join(leaves(new, "new"), [key, "path"], "full").filter(~F.col("old").eqNullSafe(F.col("new")))


def latest_by_source(obs: DataFrame, static: DataFrame) -> DataFrame:
    """Latest values of every source beside the static numbers."""
    latest = latest_values(obs, ["source", "location_id", "variable"]).drop("date")
    sources = obs.select("source", "location_id").distinct()
    s = static.filter("num is not null").select("location_id", F.col("attr").alias("variable"), "num")
    with_static = sources.join(s, "location_id")
    return latest.join(with_static, ["source", "location_id", "variable"], "full").select(
        "source", "location_id", "variable", F.coalesce("num", "value").alias("value"))


def mean_percent_diff(a: DataFrame, b: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    x = a.withColumnRenamed("value", "_a").join(b.withColumnRenamed("value", "_b"), keys)
    share = F.abs(F.try_divide(F.col("_a") - F.col("_b"), F.col("_a") + F.col("_b")) * 100)
    return x.groupBy(*by).agg(F.avg(share).alias("mean_percent_diff"))


def fractional_errors(x: DataFrame, min_count: float) -> DataFrame:
    """``x``: location_id, predicted, observed, predicted_total, observed_total. Errors of the
    locations with enough observed, plain and after scaling to the observed total."""
    rows = x.filter(F.col("observed") >= min_count)
    scaled = F.col("predicted") * F.try_divide("observed_total", "predicted_total")
    error = lambda p: F.try_divide(p - F.col("observed"), F.col("observed"))
    return rows.select("location_id", error(F.col("predicted")).alias("error"), error(scaled).alias("renormalized_error"))


def external_signal(signal: DataFrame, rt: DataFrame) -> DataFrame:
    """External signal averaged per date and state, beside Rt of the same date and state."""
    mean = signal.groupBy("state", "date").agg(F.avg("value").alias("signal"))
    return mean.join(rt, ["state", "date"])


def peak_ratio(new: DataFrame, old: DataFrame, keys: list[str]) -> DataFrame:
    peak = lambda df, n: df.groupBy(*keys).agg(F.max("value").alias(n))
    x = peak(new, "peak_new").join(peak(old, "peak_old"), keys, "full")
    return x.withColumn("ratio", F.try_divide("peak_new", "peak_old"))
