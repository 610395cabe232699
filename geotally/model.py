"""The three-table data model shared by every operator.

``obs``    location_id, variable, bucket, date, value   (one row per real observation)
``static`` location_id, attr, num, str                  (slowly changing attributes)
``tags``   location_id, variable, bucket, tag_type, content

All three are lazy DataFrames. A missing observation is an absent row, so a series never
holds more rows than the calendar has days; that bounds every per-series window.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

SERIES = ["location_id", "variable", "bucket"]
POINT = SERIES + ["date"]
TAG = SERIES + ["tag_type", "content"]
STATIC = ["location_id", "attr", "num", "str"]

OBS_SCHEMA = "location_id string, variable string, bucket string, date date, value double"
STATIC_SCHEMA = "location_id string, attr string, num double, str string"
TAG_SCHEMA = "location_id string, variable string, bucket string, tag_type string, content string"


@dataclass(frozen=True)
class Dataset:
    obs: DataFrame
    static: DataFrame
    tags: DataFrame

    def with_obs(self, obs: DataFrame) -> "Dataset":
        return replace(self, obs=obs)

    def with_tags(self, tags: DataFrame) -> "Dataset":
        return replace(self, tags=tags)

    def with_static(self, static: DataFrame) -> "Dataset":
        return replace(self, static=static)

    def add_tags(self, tags: DataFrame) -> "Dataset":
        return replace(self, tags=self.tags.unionByName(tags.select(*TAG)))


def empty_dataset(spark: SparkSession) -> Dataset:
    return Dataset(
        spark.createDataFrame([], OBS_SCHEMA),
        spark.createDataFrame([], STATIC_SCHEMA),
        spark.createDataFrame([], TAG_SCHEMA),
    )


def day(col: str | Column = "date") -> Column:
    """Day number, so that range frames count calendar days instead of rows."""
    return F.unix_date(F.col(col) if isinstance(col, str) else col)


def series_window(*extra: str, by: list[str] | None = None):
    return W.partitionBy(*(by or SERIES), *extra).orderBy(day())


def days_back(n: int, upto: int = 0, by: list[str] | None = None):
    """Frame over calendar days [-n, upto]; days without a row count as missing."""
    return series_window(by=by).rangeBetween(-n, upto)


def whole_series(by: list[str] | None = None):
    return W.partitionBy(*(by or SERIES))


def flatten(ds: Dataset) -> DataFrame:
    """One frame with all three tables, for sinks and comparisons."""
    n = F.lit(None)
    return (
        ds.obs.select(
            F.lit("obs").alias("kind"), *SERIES, "date", "value", n.cast("string").alias("tag_type"),
            n.cast("string").alias("content"),
        )
        .unionByName(
            ds.static.select(
                F.lit("static").alias("kind"), "location_id", F.col("attr").alias("variable"),
                n.cast("string").alias("bucket"), n.cast("date").alias("date"), F.col("num").alias("value"),
                n.cast("string").alias("tag_type"), F.col("str").alias("content"),
            )
        )
        .unionByName(
            ds.tags.select(
                F.lit("tag").alias("kind"), *SERIES, n.cast("date").alias("date"),
                n.cast("double").alias("value"), "tag_type", "content",
            )
        )
    )


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def assert_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Lazy assertion: the returned frame fails at run time on a duplicate key.

    Copies meet in a map-side aggregation, so that even a key with very many of them is counted
    in parallel before the job fails.
    """
    rest = [c for c in df.columns if c not in keys]
    counted = df.groupBy(*keys).agg(F.count("*").alias("_n"), *[F.any_value(c).alias(c) for c in rest])
    fail = F.raise_error(F.lit(f"duplicate key in {keys}")).cast("boolean")
    return counted.filter(F.when(F.col("_n") > 1, fail).otherwise(True)).select(*df.columns)


def all_dates(obs: DataFrame) -> list:
    """The days of the calendar that have a value, to name columns by."""
    return [r["date"] for r in obs.filter("date is not null").select("date").distinct().orderBy("date").collect()]


def assert_declared(df: DataFrame, column: str, names: list[str]) -> DataFrame:
    """Lazy assertion: the returned frame fails at run time on a name that is not declared."""
    fail = F.raise_error(F.concat(F.lit(f"undeclared {column}: "), F.col(column).cast("string"))).cast("string")
    return df.withColumn(column, F.when(F.col(column).isin(names) | F.col(column).isNull(), F.col(column)).otherwise(fail))


def finite(value: Column) -> Column:
    """A number, or null for what is no number."""
    return F.when(~F.isnan(value), value)


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a session within one process (master ``local`` or ``local[n]``) may do without the setting;
    it gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = os.path.join(tempfile.gettempdir(), "geotally-local")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize_by_series(df: DataFrame, name: str, keys: list[str] | None = None) -> DataFrame:
    """A written table like ``materialize``, in buckets by series and sorted by day within them.

    Windows, aggregations and joins by series read a bucket as one partition and shuffle nothing. There are as
    many buckets as shuffle partitions, one file each, as rows are dealt by series before they are written.
    """
    spark, keys = df.sparkSession, keys or SERIES
    path = work_dir(spark, name)
    table = re.sub(r"\W", "_", path.rsplit("/", 1)[-1])
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [*keys, "date"] if "date" in df.columns else keys
    df.repartition(n, *keys).write.bucketBy(n, *keys).sortBy(*order).option("path", path).saveAsTable(table)
    return spark.table(table)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage with a table written to shared storage, which survives lost executors."""
    path = work_dir(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)
