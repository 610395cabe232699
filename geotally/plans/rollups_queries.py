"""Queries for latest values and geography rollups."""

import datetime

from pyspark.sql import functions as F

from geotally.functions import scalars as S
from geotally.model import POINT, SERIES, Dataset, flatten
from geotally.operators import combine as C, rollup as O, windows as WN
from geotally.operators.windows import incident_from_cumulative, locf_fill
from geotally.plans import bindings as B
from geotally.plans.catalog import query
from geotally.plans.windows_queries import P, fill_sql

D = datetime.date
STATIC_ROWS = "SELECT location_id, attr, num, CAST(NULL AS VARCHAR) AS str FROM"


def rounded(df, *cols, n=6):
    return df.withColumns({c: F.round(c, n) for c in (cols or ("value",))})


W_SQL = """wt AS (SELECT p.location_id, p.parent_id, pop.population AS w, SUM(pop.population) OVER (PARTITION BY p.parent_id) AS tot FROM parent p LEFT JOIN pop USING (location_id))"""


@query("aggregate_regions", f"""
WITH {W_SQL} SELECT 'obs' AS kind, parent_id AS location_id, variable, date, round(SUM(value), 6) AS value FROM obs JOIN wt USING (location_id) WHERE bucket = 'all' GROUP BY 2, 3, 4
UNION ALL SELECT 'static', parent_id, attr, NULL, round(SUM(num), 6) FROM static JOIN wt USING (location_id) WHERE num IS NOT NULL GROUP BY 2, 3""")
def _(spark, d):
    out = O.aggregate_regions(B.dataset(spark, d), B.parent(spark, d))
    return rounded(flatten(out)).select("kind", "location_id", "variable", "date", "value")


@query("weighted_average_rollup", f"""
WITH {W_SQL} SELECT parent_id AS location_id, variable, date, round(SUM(CASE WHEN variable = 'revenue' THEN value * w / tot ELSE value END), 6) AS value FROM obs JOIN wt USING (location_id) GROUP BY 1, 2, 3""")
def _(spark, d):
    out = O.aggregate_regions(B.dataset(spark, d), B.parent(spark, d), weighted={"revenue": "population"})
    return rounded(out.obs).select("location_id", "variable", "date", "value")


@query("reporting_ratio_filter", f"""
WITH {W_SQL} SELECT parent_id AS location_id, variable, date, round(SUM(value), 6) AS value FROM obs JOIN wt USING (location_id) GROUP BY 1, 2, 3 HAVING SUM(w) / MAX(tot) >= 0.45""")
def _(spark, d):
    out = O.aggregate_regions(B.dataset(spark, d), B.parent(spark, d), coverage=0.45)
    return rounded(out.obs).select("location_id", "variable", "date", "value")


@query("reporting_ratio", f"WITH {W_SQL} SELECT parent_id AS location_id, variable, date, round(SUM(w) / MAX(tot), 9) AS reporting FROM obs JOIN wt USING (location_id) GROUP BY 1, 2, 3")
def _(spark, d):
    return rounded(O.reporting_ratio(B.dataset(spark, d), B.parent(spark, d)), "reporting", n=9)


FILLED = fill_sql("cum", "(SELECT MAX(date) FROM cum)")


def filled(spark, d):
    """Cumulative orders carried forward, so that coverage reaches 1 once every county has reported."""
    ds = B.dataset(spark, d, B.cum)
    return ds.with_obs(locf_fill(ds.obs))


@query("flagship_region_rollup", f"""
WITH fl AS ({FILLED}), {W_SQL},
 agg AS (SELECT parent_id AS location_id, variable, 'all' AS bucket, date, SUM(value) AS value FROM fl JOIN wt USING (location_id) WHERE variable = 'n_orders' GROUP BY 1, 2, 4 HAVING SUM(w) / MAX(tot) >= 0.95),
 inc AS (SELECT *, value - LAG(value) OVER ({P}) AS diff FROM agg), l AS (SELECT location_id, MAX(date) AS latest_date FROM agg GROUP BY 1)
SELECT location_id, date, diff AS new_orders, value AS total_orders, date = latest_date AS is_latest FROM inc JOIN l USING (location_id) WHERE diff IS NOT NULL""")
def _(spark, d):
    ds = filled(spark, d)
    orders = ds.with_obs(ds.obs.filter("variable = 'n_orders'"))
    agg = O.aggregate_regions(orders, B.parent(spark, d), coverage=O.COVERAGE).obs
    new = agg.select(*POINT, "value", (F.col("value") - WN.previous_day()).alias("new_orders"))
    latest = F.max("date").over(WN.whole_series(["location_id"]))
    return new.select("location_id", "date", "new_orders", F.col("value").alias("total_orders"), (F.col("date") == latest).alias("is_latest")).filter("new_orders is not null")


@query("rollup_cbsa", f"""
WITH fl AS ({FILLED}), wt AS (SELECT m.location_id, m.parent_id, population AS w, SUM(population) OVER (PARTITION BY m.parent_id) AS tot FROM cbsamap m LEFT JOIN pop USING (location_id))
SELECT parent_id AS location_id, variable, bucket, date, round(SUM(value), 4) AS value FROM fl JOIN wt USING (location_id) GROUP BY 1, 2, 3, 4 HAVING SUM(w) / MAX(tot) >= 0.95""")
def _(spark, d):
    return rounded(O.rollup_cbsa(filled(spark, d), B.cbsamap(spark, d), coverage=0.95).obs, n=4)


@query("rollup_hsa_broadcast", """
WITH h AS (SELECT hsa, variable, date, SUM(value) AS value FROM obs JOIN hsamap USING (location_id) WHERE variable = 'n_orders' GROUP BY 1, 2, 3)
SELECT * FROM obs UNION ALL SELECT m.location_id, 'n_orders_hsa', 'all', h.date, h.value FROM h JOIN hsamap m USING (hsa)""")
def _(spark, d):
    return O.rollup_hsa_broadcast(B.dataset(spark, d), B.hsamap(spark, d), {"n_orders": "n_orders_hsa"}).obs


@query("rollup_country", f"""
WITH fl AS ({FILLED}), own AS (SELECT 'iso1:us' AS location_id, 'revenue' AS variable, 'all' AS bucket, CAST(o_orderdate AS DATE) AS date, CAST(COUNT(*) AS DOUBLE) AS value FROM orders GROUP BY 4),
 wt AS (SELECT location_id, population AS w, SUM(population) OVER () AS tot FROM pop)
SELECT location_id, variable, bucket, date, round(value, 4) AS value FROM fl UNION ALL SELECT * FROM own
UNION ALL SELECT 'iso1:us', variable, 'all', date, round(SUM(value), 4) FROM fl JOIN wt USING (location_id) WHERE variable <> 'revenue' GROUP BY 2, 4 HAVING SUM(w) / MAX(tot) >= 0.95""")
def _(spark, d):
    ds = filled(spark, d)
    own = B.table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(F.count("*").cast("double").alias("value")).select(
        F.lit("iso1:us").alias("location_id"), F.lit("revenue").alias("variable"), F.lit("all").alias("bucket"), "date", "value"
    )
    return rounded(O.rollup_country(ds.with_obs(ds.obs.unionByName(own)), B.counties(spark, d)).obs, n=4)


@query("rollup_city", """
SELECT * FROM obs UNION ALL SELECT 'iso1:us#iso2:us-al#fips:0151000', variable, 'all', date, round(SUM(value), 4) FROM obs WHERE location_id LIKE 'iso1:us#iso2:us-al#%' GROUP BY 2, 4""")
def _(spark, d):
    members = B.counties(spark, d).filter("state = 'AL'")
    return rounded(O.rollup_to_one(B.dataset(spark, d), members, "iso1:us#iso2:us-al#fips:0151000").obs, n=4)


CHILD, STATE = "iso1:us#iso2:us-az#fips:04003", "iso1:us#iso2:us-az#fips:04008"


@query("replace_region_from_parent", f"""
SELECT 'obs' AS kind, location_id, variable, date, value, NULL AS content FROM obs WHERE location_id <> '{CHILD}' UNION ALL SELECT 'obs', '{CHILD}', variable, date, value, NULL FROM obs WHERE location_id = '{STATE}'
UNION ALL SELECT 'static', location_id, attr, NULL, num, str FROM static WHERE location_id <> '{CHILD}' OR str IS NOT NULL UNION ALL SELECT 'static', '{CHILD}', attr, NULL, num, NULL FROM static WHERE location_id = '{STATE}' AND num IS NOT NULL""")
def _(spark, d):
    out = O.replace_region_from_parent(B.dataset(spark, d), STATE, CHILD)
    return flatten(out).filter("kind <> 'tag'").select("kind", "location_id", "variable", "date", "value", "content")


@query("fill_static_from_children", """
WITH s AS (SELECT * FROM static UNION ALL SELECT 'iso1:us#iso2:us-al', 'balance', 5.0, NULL), c AS (SELECT parent_id AS location_id, attr, SUM(num) AS total FROM static JOIN parent USING (location_id) WHERE num IS NOT NULL GROUP BY 1, 2)
SELECT location_id, attr, round(COALESCE(num, total), 4) AS num, str FROM s FULL JOIN c USING (location_id, attr)""")
def _(spark, d):
    own = spark.range(1).select(F.lit("iso1:us#iso2:us-al").alias("location_id"), F.lit("balance").alias("attr"), F.lit(5.0).alias("num"), F.lit(None).cast("string").alias("str"))
    return rounded(O.fill_static_from_children(B.static(spark, d).unionByName(own), B.parent(spark, d)), "num", n=4)


POPS = "pp AS (SELECT g.state, g.fips, g.name AS county, p.population FROM pop p JOIN geo g USING (location_id))"


@query("rollup_population", f"""
WITH {POPS}, s AS (SELECT state, SUM(population) AS population FROM pp WHERE state <> 'CA' GROUP BY 1)
SELECT fips, state, county, 'county' AS level, population FROM pp UNION ALL SELECT sfips || '999', state, 'Unknown', 'county', NULL FROM st
UNION ALL SELECT sfips, s.state, NULL, 'state', population FROM s JOIN st USING (state) UNION ALL SELECT '0', NULL, NULL, 'country', SUM(population) FROM s""")
def _(spark, d):
    c = B.pop(spark, d).join(B.counties(spark, d).select("location_id", "state", "fips", F.col("name").alias("county")), "location_id")
    present = B.states(spark, d).filter("state = 'CA'").select("state")
    return O.rollup_population(c.select("state", "fips", "county", "population"), present)


@query("hsa_population", "SELECT location_id, hsa, hsa_name, SUM(population) OVER (PARTITION BY hsa) AS hsa_population FROM hsamap JOIN pop USING (location_id)")
def _(spark, d):
    return O.hsa_population(B.pop(spark, d).select("location_id", "population"), B.hsamap(spark, d))


@query("latest_values", "SELECT location_id, variable, bucket, arg_max(value, date) AS value, MAX(date) AS date FROM obsb GROUP BY 1, 2, 3")
def _(spark, d):
    return O.latest_values(B.obsb(spark, d))


@query("latest_for_column", "SELECT location_id, arg_max(value, date) AS value, MAX(date) AS date FROM evt WHERE variable = 'purchase' GROUP BY 1")
def _(spark, d):
    return O.latest_values(B.evt(spark, d).filter("variable = 'purchase'"), ["location_id"])


@query("latest_to_static", "SELECT * FROM static UNION ALL SELECT location_id, 'n_orders', arg_max(value, date), NULL FROM obs WHERE variable = 'n_orders' GROUP BY 1")
def _(spark, d):
    return O.latest_to_static(B.dataset(spark, d), "n_orders").static


@query("variables_and_locations", "SELECT location_id, variable FROM evt UNION SELECT location_id, attr FROM static UNION SELECT location_id, variable FROM tags")
def _(spark, d):
    return O.variables_and_locations(B.dataset(spark, d, B.evt))


@query("series_has_value", "SELECT location_id, variable, split_part(bucket, ':', 1) AS distribution, bool_or(value > 2) AS has_value FROM obsb GROUP BY 1, 2, 3")
def _(spark, d):
    return O.series_has_value(B.obsb(spark, d).withColumn("value", F.when(F.col("value") > 2, F.col("value"))))


@query("provenance_join_string", "SELECT location_id, variable, string_agg(DISTINCT content, ';' ORDER BY content) AS provenance FROM tags WHERE tag_type = 'provenance' GROUP BY 1, 2")
def _(spark, d):
    return O.provenance_text(B.tags(spark, d))


@query("dataset_counts", """
WITH u AS (SELECT * FROM obsb UNION ALL SELECT * FROM evt), g AS (SELECT * FROM (VALUES ('n_orders', 'orders'), ('revenue', 'orders'), ('click', 'traffic'), ('view', 'traffic')) AS v(variable, field_group))
SELECT level, field_group, COUNT(*) FILTER (bucket = 'all') AS bucket_all, COUNT(*) FILTER (bucket <> 'all') AS bucket_not_all FROM u LEFT JOIN g USING (variable) LEFT JOIN geo USING (location_id) GROUP BY 1, 2""")
def _(spark, d):
    groups = F.broadcast(spark.createDataFrame(
        [("n_orders", "orders"), ("revenue", "orders"), ("click", "traffic"), ("view", "traffic")], "variable string, field_group string"
    ))
    return O.dataset_counts(B.obsb(spark, d).unionByName(B.evt(spark, d)), groups, B.geo(spark, d))


@query("summarize_level", """
WITH x AS (SELECT f.location, f.dt, g.fips FROM fact f LEFT JOIN geo g USING (location_id)), k AS (SELECT location, dt, COUNT(*) AS n, COUNT(*) FILTER (fips IS NULL) AS nf FROM x GROUP BY 1, 2)
SELECT CAST(SUM(n) AS BIGINT) AS rows, CAST(SUM(nf) AS BIGINT) AS missing_fips, COUNT(*) FILTER (n > 1) AS non_unique_keys FROM k""")
def _(spark, d):
    x = B.fact(spark, d).select("location_id", "location", "dt").join(B.geo(spark, d).select("location_id", "fips"), "location_id", "left")
    return O.summarize_level(x, ["location", "dt"])


@query("grouped_pivot_by_source", """
SELECT date, COALESCE(SUM(value) FILTER (source = 'F'), 0) AS "F", COALESCE(SUM(value) FILTER (source = 'O'), 0) AS "O", COALESCE(SUM(value) FILTER (source = 'P'), 0) AS "P" FROM srcall GROUP BY 1""")
def _(spark, d):
    return O.pivot_by_source(B.srcall(spark, d), "date", ["F", "O", "P"])


@query("rt_weighted_by_population", """
WITH m AS (SELECT o.location_id, o.date, o.value AS rt, p.population FROM obs o JOIN pop p USING (location_id) WHERE variable = 'revenue' AND location_id LIKE 'iso1:us#iso2:us-al#%'),
 a AS (SELECT date, SUM(rt * population) / SUM(population) AS rt FROM m GROUP BY 1) SELECT m.location_id, m.date, round(a.rt, 6) AS rt FROM m JOIN a USING (date)""")
def _(spark, d):
    rt = B.obs(spark, d).filter("variable = 'revenue'").select("location_id", "date", F.col("value").alias("rt"))
    members = B.counties(spark, d).filter("state = 'AL'")
    return rounded(O.rt_weighted_by_population(rt, B.pop(spark, d).select("location_id", "population"), members, ["rt"]), "rt")


def access_log(spark, d):
    """Events as API requests."""
    return B.table(spark, d, "events").select(
        F.col("ts").cast("timestamp").alias("timestamp"), F.concat(F.lit("user"), "user_id", F.lit("@example.org")).alias("email"),
        F.concat(F.lit("/v2/"), "event_type").alias("path"),
    )


ACT = """act AS (SELECT 'user' || user_id || '@example.org' AS email, MIN(CAST(ts AS DATE)) AS "signupDate", MAX(ts) AS "latestDate",
 COUNT(DISTINCT CAST(ts AS DATE)) AS "daysActive", COUNT(*) AS "totalRequests" FROM events GROUP BY 1)"""


@query("user_activity_summary", f"WITH {ACT} SELECT * REPLACE (strftime(\"latestDate\", '%Y-%m-%d %H:%M:%S.%f') AS \"latestDate\") FROM act")
def _(spark, d):
    return O.user_activity(access_log(spark, d)).withColumn("latestDate", F.date_format("latestDate", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query("recently_active_users", f"WITH {ACT} SELECT email, \"daysActive\" FROM act WHERE \"latestDate\" >= DATE '2024-01-30' - 2")
def _(spark, d):
    return O.recently_active(O.user_activity(access_log(spark, d)), D(2024, 1, 30)).select("email", "daysActive")
