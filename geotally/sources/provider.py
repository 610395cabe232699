"""Reading named variables out of the long provider fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from geotally.functions import regions as R, scalars as S, tagtext as T
from geotally.model import POINT, SERIES, STATIC_SCHEMA, TAG, Dataset, assert_unique

SPEC_KEYS = ["provider", "variable_name", "measurement", "unit"]
DEMOGRAPHICS = ["age", "race", "ethnicity", "sex"]

# Explicit schema of the fact table, so that a scan never infers one.
FACT_SCHEMA = (
    "provider string, dt date, location int, location_type string, location_id string, variable_name string, "
    "measurement string, unit string, age string, race string, ethnicity string, sex string, value double, "
    "source_url string, source_name string, last_updated timestamp"
)


def spec_table(spark, spec: list[tuple]) -> DataFrame:
    """The declared variables: a literal list, so broadcasting it is bounded by the code."""
    return F.broadcast(spark.createDataFrame(spec, ", ".join(f"{k} string" for k in SPEC_KEYS) + ", field string"))


def matched_rows(fact: DataFrame, specs: dict[str, list[tuple]]) -> DataFrame:
    """Rows of the variables that any connector declares, once for each connector and field, in one scan of ``fact``.

    Every row is looked up once in the index of all specs, whose entry lists the connectors that read it.
    """
    index: dict[tuple, list[tuple]] = {}
    for connector, spec in specs.items():
        for row in spec:
            index.setdefault(tuple(row[:4]), []).append((connector, row[4]))
    schema = ", ".join(f"{k} string" for k in SPEC_KEYS) + ", _readers array<struct<connector: string, variable: string>>"
    rules = F.broadcast(fact.sparkSession.createDataFrame([(*key, readers) for key, readers in index.items()], schema))
    # The literal names also filter the scan, where they prune row groups before the join.
    listed = F.col("provider").isin(sorted({k[0] for k in index})) & F.col("variable_name").isin(sorted({k[1] for k in index}))
    return fact.filter(listed).join(rules, SPEC_KEYS).select(
        F.inline("_readers"), "location_id", S.bucket_name({c: F.col(c) for c in DEMOGRAPHICS}).alias("bucket"),
        F.col("dt").alias("date"), "value", "source_url", "source_name")


def observations(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Observations and source tags of matched rows, by connector.

    A key that occurs twice for a connector fails the job; a tag of bucket 'all' is the one of the latest date.
    """
    content = T.source_content(F.col("connector"), F.col("source_url"), F.col("source_name"))
    tags = (
        rows.filter("bucket = 'all'").groupBy("connector", *SERIES).agg(F.max_by(content, F.col("date")).alias("content"))
        .select("connector", *SERIES, F.lit(T.SOURCE).alias("tag_type"), "content")
    )
    keys = ["connector", *POINT]
    return assert_unique(rows.select(*keys, "value"), keys), tags


def query_variables(fact: DataFrame, spec: list[tuple], source_type: str) -> Dataset:
    """Rows of the declared variables as observations, plus source tags of bucket 'all'."""
    obs, tags = observations(matched_rows(fact, {source_type: spec}))
    return Dataset(obs.select(*POINT, "value"), fact.sparkSession.createDataFrame([], STATIC_SCHEMA), tags.select(*TAG))


def variable_coverage(fact: DataFrame, spec: list[tuple]) -> DataFrame:
    """Upstream variables of the declared providers that the spec does not list."""
    s = spec_table(fact.sparkSession, spec)
    return (
        fact.filter(F.col("provider").isin(sorted({r[0] for r in spec}))).groupBy(*SPEC_KEYS)
        .agg(F.count("*").alias("n")).join(s, SPEC_KEYS, "left_anti").select(*SPEC_KEYS, "n")
    )


def check_location_ids(fact: DataFrame, geo: DataFrame) -> DataFrame:
    """Stored ids that differ from the id computed from the integer fips."""
    pairs = fact.select("location", "location_id").distinct().withColumnRenamed("location_id", "stored")
    both = R.fips_to_location_id(pairs.withColumn("fips", R.fips_from_int(F.col("location"))), geo)
    return both.filter("stored <> location_id").select(
        "location", F.col("stored").alias("location_id"), F.col("location_id").alias("expected")
    )
