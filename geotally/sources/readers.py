"""Scans. Every text source has an explicit schema, and column lists reach the file readers."""

from __future__ import annotations

import datetime
import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from geotally.functions import regions as R
from geotally.model import POINT, SERIES, Dataset, finite
from geotally.operators import layout as L
from geotally.sources.provider import FACT_SCHEMA


def parquet_long(spark: SparkSession, path: str) -> DataFrame:
    return real_numbers(spark.read.schema(FACT_SCHEMA).parquet(path))


def csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header; dates parsed, everything else by the schema (fips stays text). NaN is null."""
    return real_numbers(spark.read.schema(schema).csv(path, header=True, dateFormat="yyyy-MM-dd", enforceSchema=True))


def real_numbers(df: DataFrame) -> DataFrame:
    """Columns of doubles with null for NaN; all others as they are."""
    return df.withColumns({f.name: finite(F.col(f"`{f.name}`")) for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))})


def mixed_csv(spark: SparkSession, path: str, variables: list[str]) -> tuple[DataFrame, DataFrame]:
    """(observations, static) of a CSV whose undated rows are static."""
    schema = "location_id string, date date, " + ", ".join(f"{v} double" for v in variables)
    rows = csv(spark, path, schema).withColumn("bucket", F.lit("all"))
    obs = L.to_long(rows.filter("date is not null"), variables).select(*POINT, "value")
    static = L.static_long(rows.filter("date is null"), variables, []) if variables else None
    return obs, static


def _header(spark: SparkSession, path: str) -> list[str]:
    return spark.read.csv(path, header=True).columns


def wide_dates_csv(spark: SparkSession, path: str, all_buckets: bool = True) -> Dataset:
    """One row per series, one column per date, tag columns ``type``, ``type-1``, …

    The bucket filter is applied to rows before they are unpivoted.
    """
    columns = _header(spark, path)
    dates = [c for c in columns if len(c) == 10 and c[:4].isdigit() and c[4] == c[7] == "-"]
    tag_columns = [c for c in columns if c not in dates and c not in SERIES]
    schema = T.StructType([T.StructField(c, T.DoubleType() if c in dates else T.StringType()) for c in columns])
    rows = real_numbers(spark.read.schema(schema).csv(path, header=True, escape='"'))
    if not all_buckets:
        rows = rows.filter("bucket = 'all'")
    obs = rows.unpivot(SERIES, [F.col(f"`{c}`") for c in dates], "date", "value").filter("value is not null").select(
        *SERIES, F.to_date("date").alias("date"), "value")
    if tag_columns:
        tags = rows.unpivot(SERIES, [F.col(f"`{c}`") for c in tag_columns], "tag_type", "content").filter("content is not null").select(
            *SERIES, F.regexp_replace("tag_type", r"-\d+$", "").alias("tag_type"), "content")
    else:
        tags = spark.createDataFrame([], "location_id string, variable string, bucket string, tag_type string, content string")
    return Dataset(obs, spark.createDataFrame([], "location_id string, attr string, num double, str string"), tags)


def static_csv(spark: SparkSession, path: str, numbers: list[str], strings: list[str]) -> DataFrame:
    schema = "location_id string, " + ", ".join([f"{c} double" for c in numbers] + [f"{c} string" for c in strings])
    return L.static_long(csv(spark, path, schema), numbers, strings)


def fips_timeseries(df: DataFrame, geo: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a location id, counts of the fips that match none)."""
    ids = geo.select("fips", "location_id")
    return df.join(ids, "fips"), df.join(ids, "fips", "left_anti").groupBy("fips").agg(F.count("*").alias("dropped"))


def timeseries_wide(df: DataFrame, geo: DataFrame, variables: list[str]) -> tuple[DataFrame, DataFrame]:
    """(observations with numbers coerced, rows whose geo columns differ from the dimension).

    Columns that are neither keys nor variables are dropped.
    """
    numbers = df.select("location_id", "date", F.lit("all").alias("bucket"), *[F.expr(f"try_cast(`{v}` as double)").alias(v) for v in variables])
    shared = [c for c in ("fips", "state", "county", "country") if c in df.columns and c in geo.columns]
    stored = geo.select("location_id", *[F.col(c).alias(f"_{c}") for c in shared])
    differs = F.lit(False)
    for c in shared:
        differs = differs | (F.col(c) != F.col(f"_{c}"))
    wrong = df.select("location_id", *shared).distinct().join(stored, "location_id").filter(differs)
    return L.to_long(numbers, variables).select(*POINT, "value"), wrong


def snapshot(spark: SparkSession, path: str) -> Dataset:
    return Dataset(*[spark.read.parquet(f"{path}/{t}") for t in ("obs", "static", "tags")])


def manifest(spark: SparkSession, path: str, dataset_type: str) -> Dataset:
    """Dataset named by the newest manifest row of its type. Reads one row to learn the path."""
    row = spark.read.json(path, schema=MANIFEST_SCHEMA).filter(F.col("dataset_type") == dataset_type).orderBy(F.desc("saved_at")).first()
    if row is None:
        raise LookupError(f"no {dataset_type} in {path}")
    return snapshot(spark, row["path"])


MANIFEST_SCHEMA = "dataset_type string, path string, git_branch string, git_sha string, git_dirty boolean, saved_at timestamp"


def nested_page_urls(spark: SparkSession, path: str, base_url: str) -> DataFrame:
    """States with nested county lists, flattened; a county's url extends that of its state."""
    schema = "state_dataset array<struct<state_fips_code: string, state_code: string, state_url_name: string>>, " \
        "state_county_map_dataset map<string, struct<county_dataset: array<struct<state_fips_code: string, full_fips_code: string, state_code: string, county_url_name: string>>>>"
    doc = spark.read.schema(schema).json(path, multiLine=True)
    states = doc.select(F.inline("state_dataset")).select(
        F.col("state_code").alias("state"), F.col("state_fips_code").alias("fips"), F.lit("state").alias("level"),
        F.concat(F.lit(base_url), "state_url_name").alias("url"),
    )
    counties = doc.select(F.explode("state_county_map_dataset").alias("k", "v")).select(F.inline("v.county_dataset"))
    county = counties.join(states.select(F.col("fips").alias("state_fips_code"), F.col("url").alias("_state_url")), "state_fips_code").select(
        F.col("state_code").alias("state"), F.col("full_fips_code").alias("fips"), F.lit("county").alias("level"),
        F.concat("_state_url", F.lit("/county/"), "county_url_name").alias("url"),
    )
    return states.unionByName(county)


def json_lines_by_source(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """Part files of ``root/<source>/*.json``; the source is the folder, dates are yyyyMMdd."""
    rows = spark.read.schema(schema).json(f"{root}/*/*.json")
    source = F.regexp_extract(F.input_file_name(), r"/([^/]+)/[^/]+\.json$", 1)
    return rows.withColumns({"source": source, "time_value": F.to_date(F.col("time_value").cast("string"), "yyyyMMdd")})


def historical_state(
    rows: DataFrame, deltas: dict[str, Column], levels: dict[str, Column], corrections: DataFrame,
    start: datetime.date, end: datetime.date,
) -> DataFrame:
    """Daily deltas of cumulative columns (the first row minus 0) and levels, corrected, smoothed.

    ``corrections``: state, date, name, value. Dates are cut last, so smoothing sees the whole series.
    """
    from geotally.operators import windows as WN
    from pyspark.sql import Window as W

    w = W.partitionBy("state").orderBy(F.unix_date("date"))
    cols = {n: c - F.lag(c, 1, 0.0).over(w) for n, c in deltas.items()} | levels
    names = list(cols)
    tall = rows.select("state", "date", *[c.alias(n) for n, c in cols.items()]).unpivot(["state", "date"], names, "name", "value")
    fixed = tall.join(corrections.withColumnRenamed("value", "_fix"), ["state", "date", "name"], "left").select(
        "state", "date", "name", F.coalesce("_fix", "value").alias("value"))
    series = fixed.select(F.col("state").alias("location_id"), F.col("name").alias("variable"), F.lit("all").alias("bucket"), "date", "value")
    smooth = WN.gaussian_smooth(L.densify_per_series(series)).select(
        F.col("location_id").alias("state"), "date", F.col("variable").alias("name"), "value")
    return smooth.filter(F.col("date").between(F.lit(start), F.lit(end)))


def forecast_daily(rows: DataFrame, quantile: float, ref: datetime.date) -> DataFrame:
    """Weekly totals of one quantile as a daily rate at a day number."""
    return rows.filter((F.col("quantile") == quantile) & (F.col("fips") < 100)).select(
        "fips", F.datediff("date", F.lit(ref)).alias("day"), (F.col("weekly_new_cases") / 7.0).alias("nC"), (F.col("weekly_new_deaths") / 7.0).alias("nD"))


def mobility_lists(rows: DataFrame, column: str, admin_level: int = 2) -> DataFrame:
    """Per fips the dates and the values in date order; at most one entry per day."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col("date"), F.col(column).alias("v"))))
    return rows.filter(F.col("admin_level") == admin_level).groupBy("fips").agg(pairs.alias("p")).select(
        "fips", F.col("p.date").alias("date"), F.col("p.v").alias(column))


def clean_orders(rows: DataFrame, date_columns: list[str], year: int = 2020) -> DataFrame:
    """Add the year to dates like '16-Mar', normalise column names, pad the fips."""
    name = lambda c: re.sub(r">|([ /])", lambda m: "_" if m[1] else "", c).lower()
    repaired = [
        F.to_date(F.regexp_replace(F.col(f"`{c}`"), r"^(\d+)-(\w+)$", f"$1-$2-{year}"), "d-MMM-yyyy").alias(name(c)) for c in date_columns
    ]
    others = [F.col(f"`{c}`").alias(name(c)) for c in rows.columns if c not in date_columns and c.lower() != "fips"]
    return rows.select(R.pad(F.col("fips"), 5).alias("fips"), *others, *repaired)
