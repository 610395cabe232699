"""Queries for pivots, unpivots and densified calendars."""

from pyspark.sql import functions as F

from geotally.functions import scalars as S
from geotally.model import SERIES, POINT
from geotally.operators import layout as L
from geotally.plans import bindings as B
from geotally.plans.catalog import query

TYPES = ["click", "error", "purchase", "signup", "view"]


def wide_events(spark, d):
    return L.to_wide_variables(B.evt(spark, d), TYPES)


FILTERED = ", ".join(f"SUM(value) FILTER (variable = '{t}') AS {t}" for t in TYPES)


@query("to_wide_variables", f"SELECT location_id, bucket, date, {FILTERED} FROM evt GROUP BY 1, 2, 3")
def _(spark, d):
    return wide_events(spark, d)


@query("to_long", "SELECT location_id, bucket, date, variable, value FROM evt")
def _(spark, d):
    return L.to_long(wide_events(spark, d), TYPES)


@query("to_long_with_distribution", "SELECT location_id, variable, bucket, date, value, split_part(bucket, ':', 1) AS distribution FROM obsb")
def _(spark, d):
    return L.with_distribution(B.obsb(spark, d))


@query("densify_calendar", """
WITH lim AS (SELECT MIN(date) lo, MAX(date) hi FROM evt), days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM lim),
 s AS (SELECT DISTINCT location_id, variable, bucket FROM evt)
SELECT s.*, days.date, evt.value FROM s CROSS JOIN days LEFT JOIN evt USING (location_id, variable, bucket, date)""")
def _(spark, d):
    return L.densify_calendar(B.evt(spark, d))


@query("densify_calendar_scoped", """
WITH o AS (SELECT obs.*, substr(location_id, 1, 15) AS scope FROM obs),
 lim AS (SELECT scope, MIN(date) lo, MAX(date) hi FROM o GROUP BY 1),
 s AS (SELECT DISTINCT location_id, variable, bucket, scope FROM o),
 days AS (SELECT s.*, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM s JOIN lim USING (scope))
SELECT days.*, o.value FROM days LEFT JOIN o USING (location_id, variable, bucket, date)""")
def _(spark, d):
    o = B.obs(spark, d).withColumn("scope", F.substring("location_id", 1, 15))
    return L.densify_calendar(o, scope=["scope"])


@query("densify_per_region", """
WITH lim AS (SELECT location_id, MIN(date) lo, MAX(date) hi FROM evt GROUP BY 1), s AS (SELECT DISTINCT location_id, variable, bucket FROM evt),
 days AS (SELECT s.*, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM s JOIN lim USING (location_id))
SELECT days.*, evt.value FROM days LEFT JOIN evt USING (location_id, variable, bucket, date)""")
def _(spark, d):
    return L.densify_per_series(B.evt(spark, d), by=["location_id"])


def columns_as_rows(wide, keys):
    """The names and cells of all columns but the keys, so that a result can have any number of them."""
    rest = [c for c in wide.columns if c not in keys]
    cells = wide.select(*keys, *[F.col(f"`{c}`").cast("string").alias(c) for c in rest])
    return cells.unpivot(keys, [F.col(f"`{c}`") for c in rest], "name", "cell").filter("cell is not null")


@query("field_wide_dates", "SELECT location_id, variable, bucket, CAST(date AS VARCHAR) AS name, value FROM evt WHERE variable = 'view'")
def _(spark, d):
    rows = columns_as_rows(L.field_wide_dates(B.evt(spark, d), "view"), SERIES)
    return rows.withColumn("value", F.col("cell").cast("double")).drop("cell")


@query("static_long", "SELECT * FROM static WHERE num IS NOT NULL OR str IS NOT NULL")
def _(spark, d):
    wide = B.pop(spark, d).join(B.counties(spark, d).select("location_id", "name"), "location_id", "full")
    return L.static_long(wide, ["population", "balance"], ["name"])


@query("demographic_distributions", """
WITH l AS (SELECT location_id, variable, bucket, arg_max(value, date) AS value FROM obsb WHERE bucket <> 'all' GROUP BY 1, 2, 3)
SELECT location_id, variable, split_part(bucket, ':', 1) AS distribution, string_agg(split_part(bucket, ':', 2) || '=' || CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR), ',' ORDER BY bucket) AS members
FROM l GROUP BY 1, 2, 3""")
def _(spark, d):
    m = L.demographic_distributions(B.obsb(spark, d))
    text = F.transform(
        F.array_sort(F.map_entries("members")),
        lambda e: F.concat(e["key"], F.lit("="), F.round(e["value"] * 100).cast("bigint").cast("string")),
    )
    return m.select("location_id", "variable", "distribution", F.array_join(text, ",").alias("members"))


@query("sort_common_columns", "SELECT location_id, date, bucket, variable, value FROM obs")
def _(spark, d):
    return L.sort_common_columns(B.obs(spark, d), ["location_id", "date"])
