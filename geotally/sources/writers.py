"""Sinks. Writes go to folders in shared storage; sorting happens only here."""

from __future__ import annotations

import subprocess

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from geotally.model import SERIES, Dataset, all_dates, assert_declared, finite
from geotally.operators import layout as L

# Plural names of the levels in published paths.
LEVEL_FILES = {"county": "counties", "state": "states", "cbsa": "cbsas", "place": "places", "country": "countries"}


def _declared(df: DataFrame, column: str, names: list[str] | None) -> tuple[DataFrame, list[str]]:
    """The names that a file has as columns: those in the data, or those declared, which then must hold all."""
    if names is None:
        return df, sorted(r[0] for r in df.select(column).distinct().collect())
    return assert_declared(df, column, names), names


def common_csv(ds: Dataset, path: str, variables: list[str] | None = None, attrs: list[str] | None = None, include_static: bool = True) -> None:
    """Dated rows, then static rows without a date, sorted by location and date; provenance beside it.

    A variable or attribute that is not among the declared ones fails the job.
    """
    obs, variables = _declared(ds.obs.filter("bucket = 'all'"), "variable", variables)
    rows = L.to_wide_variables(obs, variables, ["location_id", "date"])
    if include_static:
        static, attrs = _declared(ds.static, "attr", attrs)
        static = static.groupBy("location_id").pivot("attr", attrs).agg(F.first(F.coalesce("str", F.col("num").cast("string"))))
        rows = rows.unionByName(static.withColumn("date", F.lit(None).cast("date")), allowMissingColumns=True)
    declared = L.sort_common_columns(rows, ["location_id", "date"])
    declared.orderBy(F.asc("location_id"), F.asc_nulls_last("date")).write.csv(path, header=True, dateFormat="yyyy-MM-dd")
    provenance = ds.tags.filter("tag_type = 'provenance'").select("location_id", "variable", F.col("content").alias("provenance"))
    provenance.orderBy("location_id", "variable").write.csv(f"{path}-provenance", header=True)


def wide_dates(ds: Dataset) -> DataFrame:
    """One row per series, newest date first; the n-th tag of a type goes to ``type-n``.

    Columns are those that the data need: a small aggregation finds the dates, another the largest
    number of tags of each type on one series.
    """
    names = [x.isoformat() for x in reversed(all_dates(ds.obs))]
    most = ds.tags.groupBy(*SERIES, "tag_type").agg(F.count("*").alias("n")).groupBy("tag_type").agg(F.max("n").alias("n"))
    tag_types = {r["tag_type"]: r["n"] for r in most.orderBy("tag_type").collect()}
    values = ds.obs.withColumn("d", F.date_format("date", "yyyy-MM-dd")).groupBy(*SERIES).pivot("d", names).agg(F.first("value"))
    columns = [t if i == 0 else f"{t}-{i}" for t, n in tag_types.items() for i in range(n)]
    if not columns:
        return values
    n = F.row_number().over(W.partitionBy(*SERIES, "tag_type").orderBy("content")) - 1
    label = F.when(F.col("n") == 0, F.col("tag_type")).otherwise(F.concat("tag_type", F.lit("-"), F.col("n").cast("string")))
    tags = ds.tags.withColumn("n", n).withColumn("label", label).groupBy(*SERIES).pivot("label", columns).agg(F.first("content"))
    wide = values.join(tags, SERIES, "full")
    return wide.select(*SERIES, *[F.col(f"`{c}`") for c in columns], *[F.col(f"`{c}`") for c in names])


def write_wide_dates(ds: Dataset, path: str, compression: str = "gzip") -> None:
    wide_dates(ds).orderBy(*SERIES).write.csv(path, header=True, compression=compression, escape='"')


def snapshot(ds: Dataset, path: str) -> None:
    """Parquet per table; observations in one folder per variable, so a variable filter prunes files.

    The rebalance hint lets AQE split a large variable into files of the advisory size and merge
    small ones, so file sizes follow the data.
    """
    ds.obs.hint("rebalance", "variable").write.partitionBy("variable").parquet(f"{path}/obs")
    ds.static.write.parquet(f"{path}/static")
    ds.tags.write.parquet(f"{path}/tags")


def _git(*args: str) -> str | None:
    try:
        return subprocess.run(["git", *args], capture_output=True, text=True, timeout=10).stdout.strip() or None
    except OSError:
        return None


def with_manifest(ds: Dataset, path: str, dataset_type: str) -> None:
    """Snapshot and one manifest row: type, path, code version and time."""
    target = f"{path}/{dataset_type}"
    snapshot(ds, target)
    spark = ds.obs.sparkSession
    row = spark.range(1).select(
        F.lit(dataset_type).alias("dataset_type"), F.lit(target).alias("path"), F.lit(_git("rev-parse", "--abbrev-ref", "HEAD")).alias("git_branch"),
        F.lit(_git("rev-parse", "HEAD")).alias("git_sha"), F.lit(bool(_git("status", "--porcelain"))).alias("git_dirty"), F.current_timestamp().alias("saved_at"),
    )
    row.write.mode("append").json(f"{path}/manifest")


def output_file(level: Column, state: Column, fips: Column, country: Column, kind: str = "json", timeseries: bool = False) -> Column:
    """Published path of one region."""
    suffix = (".timeseries" if timeseries else "") + f".{kind}"
    key = F.when(level == "state", state).when(level == "country", country).otherwise(fips)
    return F.concat(level, F.lit("/"), key, F.lit(suffix))


def bulk_file(level: Column, kind: str = "json", timeseries: bool = False, state: Column | None = None) -> Column:
    """Published path of a whole level, or of the part of it in one state."""
    suffix = F.lit((".timeseries" if timeseries else "") + f".{kind}")
    if state is not None:
        return F.concat(level, F.lit("/"), state, suffix)
    names = F.create_map(*[F.lit(x) for kv in LEVEL_FILES.items() for x in kv])
    return F.concat(F.try_element_at(names, level), suffix)


def without_nan(df: DataFrame) -> DataFrame:
    """Columns of doubles, also inside structs, arrays and values of maps, with null for NaN."""
    def clean(value: Column, kind: T.DataType) -> Column:
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            return finite(value)
        if isinstance(kind, T.StructType):
            return F.when(value.isNotNull(), F.struct(*[clean(value[f.name], f.dataType).alias(f.name) for f in kind]))
        if isinstance(kind, T.ArrayType):
            return F.transform(value, lambda x: clean(x, kind.elementType))
        if isinstance(kind, T.MapType):
            return F.transform_values(value, lambda _, x: clean(x, kind.valueType))
        return value

    return df.select(*[clean(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema])


def region_json(regions: DataFrame, path: str) -> None:
    """One JSON record per region under level and state folders; unset fields are left out.

    The rebalance hint lets AQE split one large state over several files.
    """
    rows = without_nan(regions).withColumns({"_state": F.coalesce("state", F.lit("all")), "_level": F.col("level")})
    rows.hint("rebalance", "_level", "_state").write.partitionBy("_level", "_state").json(path)


def flatten_struct(df: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Nested fields as dotted columns, in the declared order. Declared names that do not exist
    become empty columns, so that the order only ever grows at its end."""

    def walk(fields, prefix, path):
        for f in fields:
            name, col = f"{prefix}{f.name}", f"{path}`{f.name}`"
            if isinstance(f.dataType, T.StructType):
                yield from walk(f.dataType.fields, name + ".", col + ".")
            else:
                yield name, F.col(col)

    found = dict(walk(df.schema.fields, "", ""))
    names = order or list(found)
    return df.select(*[found.get(n, F.lit(None).cast("string")).alias(n) for n in names])


def nested_csv(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    flatten_struct(df, order).write.csv(path, header=True)


def rt_metric(rt: DataFrame, path: str) -> None:
    rt.write.parquet(path)
