"""Merging datasets: by source priority, point by point, at a cutoff, and as unions."""

from __future__ import annotations

import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from geotally.functions import scalars as S, tagtext as T
from geotally.model import POINT, SERIES, STATIC, TAG, Dataset

GROUP = ["location_id", "variable", "distribution"]


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def feature_priorities(spark, definition: dict[str, list[str]]) -> DataFrame:
    """(variable, source, prio) from lists that name the lowest priority first; 0 is the best."""
    rows = [(v, s, i) for v, names in definition.items() for i, s in enumerate(reversed(names))]
    return F.broadcast(spark.createDataFrame(rows, "variable string, source string, prio int"))


def combine_by_priority(obs: DataFrame, tags: DataFrame, priorities: DataFrame):
    """Take every (location, variable, distribution) whole from its best source that has a value.

    ``obs`` and ``tags`` carry a ``source`` column. The winner per group is a map-side
    aggregation to one small row; points and tags then join on it, and on a join Spark can split
    a hot group, which a window over the group could not.
    """
    dist = S.bucket_distribution(F.col("bucket")).alias("distribution")
    ranked = obs.filter("value is not null").join(priorities, ["variable", "source"]).select("*", dist)
    winner = ranked.groupBy(*GROUP).agg(F.min("prio").alias("prio"))
    points = ranked.join(winner, GROUP + ["prio"], "left_semi").select(*POINT, "value", "source")
    kept = (
        tags.join(priorities, ["variable", "source"]).select("*", dist)
        .join(winner, GROUP + ["prio"], "left_semi").select(*TAG)
    )
    return points, kept


def combine_static_by_priority(static: DataFrame, priorities: DataFrame) -> DataFrame:
    """Per (location, attribute) the value of the best source that has one."""
    value = F.struct("num", "str")
    return (
        static.filter("num is not null or str is not null")
        .join(priorities.withColumnRenamed("variable", "attr"), ["attr", "source"])
        .groupBy("location_id", "attr").agg(F.min_by(value, "prio").alias("v"))
        .select("location_id", "attr", "v.num", "v.str")
    )


def source_with_region_mask(obs: DataFrame, geo: DataFrame, include: Column, exclude: Column | None = None) -> DataFrame:
    """A source restricted to included, not excluded regions."""
    ids = geo.filter(include if exclude is None else include & ~exclude).select("location_id")
    return obs.join(ids, "location_id", "left_semi")


def coalesce_pointwise(first: DataFrame, second: DataFrame) -> DataFrame:
    b = second.withColumnRenamed("value", "_second")
    return first.join(b, POINT, "full").select(*POINT, F.coalesce("value", "_second").alias("value"))


def splice(before: DataFrame, after: DataFrame, cutoff: datetime.date) -> DataFrame:
    """First frame up to the day before the cutoff, second from the cutoff on."""
    return before.filter(F.col("date") < F.lit(cutoff)).unionByName(after.filter(F.col("date") >= F.lit(cutoff)))


def constant_source_tags(obs: DataFrame, content: Column) -> DataFrame:
    return obs.select(*SERIES).distinct().select(*SERIES, F.lit(T.SOURCE).alias("tag_type"), content.alias("content"))


def copy_region(df: DataFrame, from_id: str, to_id: str) -> DataFrame:
    copied = df.filter(F.col("location_id") == from_id).withColumn("location_id", F.lit(to_id))
    return df.unionByName(copied)


def _fail_if_shared(left: DataFrame, right: DataFrame, column: str, what: str) -> DataFrame:
    """``right`` unchanged, or a failing job when a value of the column occurs on both sides."""
    names = right.select(column).distinct().join(left.select(column).distinct(), column, "left_semi")
    shared = names.agg(F.count("*")).scalar() > 0
    return right.filter(F.when(shared, F.raise_error(F.lit(what)).cast("boolean")).otherwise(True))


def join_columns(a: Dataset, b: Dataset) -> Dataset:
    """Datasets with disjoint variables about the same regions."""
    checked = _fail_if_shared(a.obs, b.obs, "variable", "variables are not disjoint")
    return Dataset(
        a.obs.select(*POINT, "value").unionByName(checked.select(*POINT, "value")), a.static, a.tags.unionByName(b.tags)
    )


def append_regions(a: Dataset, b: Dataset) -> Dataset:
    """Disjoint union of regions; a common location id fails the job."""
    checked = _fail_if_shared(a.obs, b.obs, "location_id", "regions are not disjoint")
    return Dataset(
        a.obs.select(*POINT, "value").unionByName(checked.select(*POINT, "value")),
        a.static.unionByName(b.static), a.tags.unionByName(b.tags),
    )


def combine_many(parts: list[Dataset]) -> Dataset:
    return Dataset(*[union_all([getattr(p, n) for p in parts]) for n in ("obs", "static", "tags")])


def merge_attributes(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union of keys; a non-null value of ``b`` overrides ``a``."""
    x = b.select("location_id", "attr", F.col("num").alias("_n"), F.col("str").alias("_s"))
    set_b = F.col("_n").isNotNull() | F.col("_s").isNotNull()
    return a.join(x, ["location_id", "attr"], "full").select(
        "location_id", "attr", F.when(set_b, F.col("_n")).otherwise(F.col("num")).alias("num"),
        F.when(set_b, F.col("_s")).otherwise(F.col("str")).alias("str"),
    )


def add_static_values(static: DataFrame, added: DataFrame) -> DataFrame:
    checked = _fail_if_shared(static, added, "attr", "static columns are not disjoint")
    return static.select(*STATIC).unionByName(checked.select(*STATIC))


def static_with_geo(static_wide: DataFrame, geo: DataFrame) -> DataFrame:
    return static_wide.join(geo, "location_id", "left")


def latest_with_static(latest: DataFrame, static: DataFrame) -> DataFrame:
    """Latest timeseries values beside static numbers; static wins."""
    s = static.filter("num is not null").select("location_id", F.col("attr").alias("variable"), "num")
    return latest.join(s, ["location_id", "variable"], "full").select(
        "location_id", "variable", F.coalesce("num", "value").alias("value")
    )


def county_names(df: DataFrame, names: DataFrame) -> DataFrame:
    return df.join(names.select("fips", "state", F.col("name").alias("county")), ["fips", "state"], "left")


def clear_common_values(df: DataFrame, other: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Set ``column`` to NULL where the key exists in the other source."""
    flag = other.select(*keys).distinct().withColumn("_hit", F.lit(True))
    return df.join(flag, keys, "left").withColumn(column, F.when(F.col("_hit").isNull(), F.col(column))).drop("_hit")


def explode_subregions(rules: DataFrame, parents: DataFrame) -> DataFrame:
    """A rule flagged for subregions applies to each child; type 'both' becomes two variables.

    ``rules``: location_id, start, end, kind ('cases'|'deaths'|'both'), own, subregions.
    """
    own = rules.filter("own").select("location_id", "start", "end", "kind")
    children = rules.filter("subregions").join(
        parents.select(F.col("location_id").alias("child"), F.col("parent_id").alias("location_id")), "location_id"
    ).select(F.col("child").alias("location_id"), "start", "end", "kind")
    kinds = F.when(F.col("kind") == "both", F.array(F.lit("cases"), F.lit("deaths"))).otherwise(F.array("kind"))
    return own.unionByName(children).withColumn("kind", F.explode(kinds))


def join_by_region_date(base: DataFrame, extra: DataFrame) -> DataFrame:
    return base.join(extra, ["location_id", "date"], "left")


def join_day_rows(header: DataFrame, frames: list[DataFrame]) -> DataFrame:
    """Full outer join of per-day frames by (location, date), with the region header prepended."""
    rows = reduce(lambda a, b: a.join(b, ["location_id", "date"], "full"), frames)
    return header.join(rows, "location_id")
