"""Long, wide and densified layouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from geotally.functions import scalars as S
from geotally.model import POINT, SERIES, all_dates, finite


def to_long(wide: DataFrame, variables: list[str], keys: list[str] = ("location_id", "bucket", "date")) -> DataFrame:
    """One row per real value."""
    doubles = wide.select(*keys, *[finite(F.col(f"`{v}`").cast("double")).alias(v) for v in variables])
    return doubles.unpivot(list(keys), variables, "variable", "value").filter("value is not null")


def with_distribution(obs: DataFrame) -> DataFrame:
    return obs.withColumn("distribution", S.bucket_distribution(F.col("bucket")))


def to_wide_variables(obs: DataFrame, variables: list[str], by: list[str] = ("location_id", "bucket", "date")) -> DataFrame:
    """Column per variable. The list is explicit, so no extra job looks for values."""
    by = list(by)
    return obs.groupBy(*by).pivot("variable", variables).agg(F.first("value"))


def field_wide_dates(obs: DataFrame, variable: str, buckets: str | None = "all") -> DataFrame:
    """One variable with a column for each of its dates."""
    rows = obs.filter(F.col("variable") == variable)
    if buckets is not None:
        rows = rows.filter(F.col("bucket") == buckets)
    return rows.groupBy(*SERIES).pivot("date", all_dates(rows)).agg(F.first("value"))


def _days(lo, hi) -> Column:
    return F.explode(F.sequence(lo, hi))


def densify_calendar(obs: DataFrame, scope: list[str] | None = None) -> DataFrame:
    """Every day of the calendar for every series; missing days hold NULL.

    The calendar runs over all observations, or over those sharing the ``scope`` columns. Series
    keys come from a map-side aggregation, days are generated per series, and the one join is on
    the full point key, so no key concentrates more rows than a calendar has days.
    """
    bounds = [F.min("date").alias("_lo"), F.max("date").alias("_hi")]
    if scope:
        keys = SERIES + [c for c in scope if c not in SERIES]
        series = obs.select(*keys).distinct().join(obs.groupBy(*scope).agg(*bounds), scope)
        lo, hi = F.col("_lo"), F.col("_hi")
    else:
        keys = SERIES
        series = obs.select(*SERIES).distinct()
        lo, hi = obs.agg(F.min("date")).scalar(), obs.agg(F.max("date")).scalar()
    days = series.select(*keys, _days(lo, hi).alias("date"))
    return days.join(obs.select(*POINT, "value"), POINT, "left").select(*keys, "date", "value")


def densify_per_series(obs: DataFrame, by: list[str] = SERIES) -> DataFrame:
    """Every day between the first and last date of each group, in every series of the group."""
    bounds = obs.groupBy(*by).agg(F.min("date").alias("_lo"), F.max("date").alias("_hi"))
    series = obs.select(*SERIES).distinct().join(bounds, list(by)) if list(by) != SERIES else bounds
    days = series.select(*SERIES, _days(F.col("_lo"), F.col("_hi")).alias("date"))
    return days.join(obs.select(*POINT, "value"), POINT, "left").select(*POINT, "value")


def static_long(wide: DataFrame, numbers: list[str], strings: list[str]) -> DataFrame:
    columns = ["location_id", "attr", "num", "str"]
    parts = []
    if numbers:
        doubles = wide.select("location_id", *[finite(F.col(c).cast("double")).alias(c) for c in numbers])
        parts.append(doubles.unpivot(["location_id"], numbers, "attr", "num").withColumn("str", F.lit(None).cast("string")))
    if strings:
        texts = wide.select("location_id", *strings).unpivot(["location_id"], strings, "attr", "str")
        parts.append(texts.withColumn("num", F.lit(None).cast("double")))
    out = parts[0].select(*columns) if len(parts) == 1 else parts[0].select(*columns).unionByName(parts[1].select(*columns))
    return out.filter("num is not null or str is not null")


def demographic_distributions(obs: DataFrame) -> DataFrame:
    """Latest value per bucket, as a map name -> value per (location, variable, distribution)."""
    from geotally.operators.rollup import latest_values

    latest = latest_values(obs.filter("bucket <> 'all'"))
    b = F.col("bucket")
    entries = F.array_sort(F.collect_list(F.struct(S.bucket_member(b).alias("name"), F.col("value"))))
    return latest.groupBy("location_id", "variable", S.bucket_distribution(b).alias("distribution")).agg(
        F.map_from_entries(entries).alias("members")
    )


def sort_common_columns(df: DataFrame, declared: list[str]) -> DataFrame:
    """Declared columns first in their order, the others alphabetically."""
    first = [c for c in declared if c in df.columns]
    return df.select(*first, *sorted(c for c in df.columns if c not in first))
