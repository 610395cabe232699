"""Tag algebra: tags are rows, so lineage is built with unions and joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from geotally.functions import tagtext as T
from geotally.model import SERIES, TAG, Dataset

# Public source types that a published annotation may name. Callers add their own.
SOURCE_TYPES = [
    "NYTimes", "CMSTesting", "CDCTesting", "HHSTesting", "HHSHospital", "Valorum", "covid_tracking", "USAFacts",
    "TestAndTrace", "other",
]


def make_tags(series: DataFrame, tag_type: str, content: Column) -> DataFrame:
    return series.select(*SERIES, F.lit(tag_type).alias("tag_type"), content.alias("content"))


def append_tags(ds: Dataset, tags: DataFrame) -> Dataset:
    return ds.add_tags(tags)


def replace_tags(ds: Dataset, tags: DataFrame) -> Dataset:
    return ds.with_tags(tags.select(*TAG))


def tag_all_series(ds: Dataset, tag_type: str, content: Column) -> Dataset:
    """One tag on every series of bucket 'all'."""
    return ds.add_tags(make_tags(ds.obs.filter("bucket = 'all'").select(*SERIES).distinct(), tag_type, content))


def tag_subset(ds: Dataset, series: DataFrame, tag_type: str, content: Column) -> Dataset:
    return ds.add_tags(make_tags(series, tag_type, content))


def untag_subset(ds: Dataset, series: DataFrame) -> Dataset:
    return ds.with_tags(ds.tags.join(series.select(*SERIES).distinct(), SERIES, "left_anti").select(*TAG))


def add_provenance(ds: Dataset, provenance: DataFrame | str) -> Dataset:
    """Provenance per (location, variable) row, or one constant for every series of bucket 'all'."""
    if isinstance(provenance, str):
        return tag_all_series(ds, T.PROVENANCE, F.lit(provenance))
    rows = provenance.withColumn("bucket", F.lit("all"))
    return ds.add_tags(make_tags(rows, T.PROVENANCE, F.col("provenance")))


def make_source_tags(tags: DataFrame) -> DataFrame:
    """Provenance and source_url tags of a series become one source tag; others stay."""
    used = F.col("tag_type").isin(T.PROVENANCE, T.SOURCE_URL)
    pick = lambda t: F.max(F.when(F.col("tag_type") == t, F.col("content")))
    source = tags.filter(used).groupBy(*SERIES).agg(pick(T.PROVENANCE).alias("_p"), pick(T.SOURCE_URL).alias("_u"))
    return tags.filter(~used).select(*TAG).unionByName(
        make_tags(source, T.SOURCE, T.source_content(F.col("_p"), F.col("_u")))
    )


def make_source_url_tags(tags: DataFrame) -> DataFrame:
    url = F.get_json_object("content", "$.url")
    found = tags.filter(F.col("tag_type") == T.SOURCE).withColumn("_url", url).filter("_url is not null")
    return tags.select(*TAG).unionByName(make_tags(found, T.SOURCE_URL, F.col("_url")))


def last_source_tag(dated: DataFrame) -> DataFrame:
    """Per series the tag content of its last date."""
    return dated.groupBy(*SERIES).agg(F.max_by("content", "date").alias("content"))


def tags_of_region(tags: DataFrame) -> DataFrame:
    """Sorted lists per (location, variable) of the tags of bucket 'all'."""
    def listed(*types):
        return F.array_sort(F.collect_list(F.when(F.col("tag_type").isin(*types), F.col("content"))))

    return tags.filter("bucket = 'all'").groupBy("location_id", "variable").agg(
        listed(T.PROVENANCE).alias("provenance"), listed(T.SOURCE_URL).alias("source_url"), listed(T.SOURCE).alias("source"),
        listed(*T.ANNOTATIONS).alias("annotations"),
    )


def known_source_type(c: Column, known: list[str]) -> Column:
    return F.when(c.isin(known), c).when(c.isNotNull(), "other")


def field_annotations(tags: DataFrame, field_names: DataFrame, known: list[str] = SOURCE_TYPES) -> DataFrame:
    """Sources and anomalies per published field.

    ``field_names``: field, variable. Without source tags, provenance and url stand in. The lists
    hold the tags of one series, which grow with its corrections and not with its observations.
    """
    x = tags.filter("bucket = 'all'").withColumn("x", T.decode(F.col("tag_type"), F.col("content")))
    source = F.struct(known_source_type(F.col("x.type"), known).alias("type"), F.col("x.url").alias("url"), F.col("x.name").alias("name"))
    anomaly = F.struct(F.col("x.date").alias("date"), F.col("x.original_observation").alias("original_observation"), F.col("tag_type").alias("type"))
    of = lambda t, v: F.when(F.col("tag_type") == t, v)
    per = x.groupBy("location_id", "variable").agg(
        F.array_sort(F.collect_list(of(T.SOURCE, source))).alias("sources"),
        F.max(of(T.PROVENANCE, known_source_type(F.col("content"), known))).alias("_p"),
        F.max(of(T.SOURCE_URL, F.col("content"))).alias("_u"),
        F.array_sort(F.collect_list(F.when(F.col("tag_type").isin(T.ANNOTATIONS), anomaly))).alias("anomalies"),
    )
    fallback = F.struct(F.col("_p").alias("type"), F.col("_u").alias("url"), F.lit(None).cast("string").alias("name"))
    sources = F.when((F.size("sources") == 0) & (F.col("_p").isNotNull() | F.col("_u").isNotNull()), F.array(fallback)).otherwise(F.col("sources"))
    return (
        per.withColumn("sources", sources).filter((F.size("sources") > 0) | (F.size("anomalies") > 0))
        .join(field_names, "variable").select("location_id", "field", "sources", "anomalies")
    )


def tags_follow_series(tags: DataFrame, obs: DataFrame) -> DataFrame:
    return tags.join(obs.select(*SERIES).distinct(), SERIES, "left_semi").select(*TAG)
