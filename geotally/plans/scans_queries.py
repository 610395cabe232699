"""Queries for scans. Text sources are first derived from the given tables by Spark."""

import dataclasses
import datetime

from pyspark.sql import functions as F

from geotally.functions import regions as R
from geotally.model import POINT, SERIES, Dataset, flatten, work_dir
from geotally.operators import filters as FL, layout as L
from geotally.plans import bindings as B
from geotally.plans.catalog import query
from geotally.plans.filters_queries import BUCKET, flat_sql
from geotally.plans.sinks_queries import EV_TYPES, NTAGS, event_dataset
from geotally.sources import readers as RD, registry as G, writers as WR
from geotally.sources.files import TEST_AND_TRACE

D = datetime.date


@query("scan_parquet_long", "SELECT provider, dt, location, location_id, variable_name, measurement, value, age, sex FROM fact")
def _(spark, d):
    path = work_dir(spark, "fact")
    f = B.fact(spark, d)
    f.select(*[c for c in f.columns if c not in ("ts", "user_id", "event_id")]).write.parquet(path)
    return RD.parquet_long(spark, path).select("provider", "dt", "location", "location_id", "variable_name", "measurement", "value", "age", "sex")


def county_csv(spark, d, name):
    """Daily orders per county as a CSV with fips."""
    path = work_dir(spark, name)
    wide = L.to_wide_variables(B.obs(spark, d), ["n_orders", "revenue"], ["location_id", "date"])
    wide.join(B.geo(spark, d).select("location_id", "fips", "state", "country"), "location_id").write.csv(path, header=True, dateFormat="yyyy-MM-dd")
    return path


WIDE_O = "wo AS (SELECT location_id, date, SUM(value) FILTER (variable = 'n_orders') AS n_orders, SUM(value) FILTER (variable = 'revenue') AS revenue FROM obs GROUP BY 1, 2)"


@query("scan_common_csv", f"WITH {WIDE_O} SELECT location_id, date, n_orders, revenue, fips, state, country FROM wo JOIN geo USING (location_id)")
def _(spark, d):
    return RD.csv(spark, county_csv(spark, d, "common"), "location_id string, date date, n_orders double, revenue double, fips string, state string, country string")


@query("scan_mixed_csv_split", """
SELECT 'obs' AS kind, location_id, variable, date, value FROM evt UNION ALL SELECT 'static', location_id, 'population', NULL, population FROM upop""")
def _(spark, d):
    path = work_dir(spark, "mixed")
    ds = event_dataset(spark, d)
    # a value that is no number is no observation
    nan = ds.obs.limit(1).select("location_id", "variable", "bucket", F.lit(D(2000, 1, 1)).alias("date"), F.lit(float("nan")).alias("value"))
    WR.common_csv(ds.with_obs(ds.obs.unionByName(nan)), path)
    obs, static = RD.mixed_csv(spark, path, ["click", "error", "population", "purchase", "signup", "view"])
    return obs.select(F.lit("obs").alias("kind"), "location_id", "variable", "date", "value").unionByName(
        static.select(F.lit("static").alias("kind"), "location_id", F.col("attr").alias("variable"), F.lit(None).cast("date").alias("date"), F.col("num").alias("value")))


@query("scan_wide_dates_csv", """
SELECT 'obs' AS kind, location_id, variable, bucket, date, value, CAST(NULL AS VARCHAR) AS content FROM evt
UNION ALL SELECT 'tag', location_id, variable, bucket, NULL, NULL, p || variable FROM """ + NTAGS)
def _(spark, d):
    path = work_dir(spark, "wide")
    WR.write_wide_dates(event_dataset(spark, d), path)
    ds = RD.wide_dates_csv(spark, path, all_buckets=False)
    return flatten(ds).filter("kind <> 'static'").drop("tag_type")


@query("scan_static_csv", "SELECT * FROM static WHERE attr <> 'balance'")
def _(spark, d):
    path = work_dir(spark, "static")
    B.pop(spark, d).select("location_id", "population").join(B.counties(spark, d).select("location_id", "name"), "location_id").write.csv(path, header=True)
    return RD.static_csv(spark, path, ["population"], ["name"])


@query("scan_fips_timeseries", """
WITH x AS (SELECT lpad(CAST(location AS VARCHAR), 5, '0') AS fips, dt, COUNT(*) AS n FROM fact GROUP BY 1, 2)
SELECT 'kept' AS kind, g.location_id AS key, dt, n FROM x JOIN geo g USING (fips) UNION ALL SELECT 'dropped', fips, NULL, COUNT(*) FROM x WHERE fips NOT IN (SELECT fips FROM geo) GROUP BY 2""")
def _(spark, d):
    x = B.fact(spark, d).groupBy(R.fips_from_int(F.col("location")).alias("fips"), "dt").agg(F.count("*").alias("n"))
    kept, dropped = RD.fips_timeseries(x, B.geo(spark, d))
    return kept.select(F.lit("kept").alias("kind"), F.col("location_id").alias("key"), "dt", "n").unionByName(
        dropped.select(F.lit("dropped").alias("kind"), F.col("fips").alias("key"), F.lit(None).cast("date").alias("dt"), F.col("dropped").alias("n")))


@query("scan_timeseries_wide", f"""
WITH {WIDE_O} SELECT 'obs' AS kind, location_id, variable, date, value FROM obs UNION ALL SELECT 'wrong', location_id, state, NULL, NULL FROM geo WHERE level = 'county' AND location_id LIKE '%3'""")
def _(spark, d):
    text = spark.read.csv(county_csv(spark, d, "text"), header=True).withColumn("date", F.to_date("date"))
    wrong_state = F.when(F.col("location_id").endswith("3"), F.lit("XX")).otherwise(F.col("state"))
    obs, wrong = RD.timeseries_wide(text.withColumns({"state": wrong_state, "extra": F.lit("x")}), B.geo(spark, d), ["n_orders", "revenue"])
    return obs.select(F.lit("obs").alias("kind"), "location_id", "variable", "date", "value").unionByName(
        wrong.select(F.lit("wrong").alias("kind"), "location_id", F.col("_state").alias("variable"), F.lit(None).cast("date").alias("date"), F.lit(None).cast("double").alias("value")))


@query("scan_bulk_snapshot", flat_sql("SELECT * FROM obsb"))
def _(spark, d):
    path = work_dir(spark, "bulk")
    WR.snapshot(B.dataset(spark, d, B.obsb), path)
    return flatten(RD.snapshot(spark, path))


@query("scan_pointer", flat_sql("SELECT * FROM obs"))
def _(spark, d):
    path = work_dir(spark, "pointer")
    WR.with_manifest(B.dataset(spark, d), path, "orders")
    return flatten(RD.manifest(spark, f"{path}/manifest", "orders"))


@query("scan_nested_json_urls", """
SELECT x.state, x.fips, x.level, x.url, COALESCE(c.n, 0) AS customers FROM (SELECT state, fips, level, 'https://example.org/us/' || lower(state) || CASE level WHEN 'county' THEN '/county/' || lower(name) ELSE '' END AS url, nationkey FROM geo WHERE level <> 'country') x
LEFT JOIN (SELECT c_nationkey, COUNT(*) AS n FROM customer GROUP BY 1) c ON c.c_nationkey = x.nationkey""")
def _(spark, d):
    g = B.geo(spark, d)
    state = g.filter("level = 'state'").select(F.col("fips").alias("state_fips_code"), F.col("state").alias("state_code"), F.lower("state").alias("state_url_name"))
    county = g.filter("level = 'county'").select(
        R.state_fips_of_code(F.col("state")).alias("state_fips_code"), F.col("fips").alias("full_fips_code"), F.col("state").alias("state_code"),
        F.lower("name").alias("county_url_name"))
    per_state = county.groupBy("state_code").agg(F.collect_list(F.struct(*county.columns)).alias("county_dataset"))
    # One document: it holds the geo dimension, which is a fixed list of regions.
    counties = per_state.agg(F.map_from_entries(F.collect_list(F.struct("state_code", F.struct("county_dataset")))))
    doc = state.agg(F.collect_list(F.struct(*state.columns)).alias("state_dataset")).withColumn("state_county_map_dataset", counties.scalar())
    path = work_dir(spark, "urls")
    doc.write.json(path)
    urls = RD.nested_page_urls(spark, path, "https://example.org/us/")
    n = B.table(spark, d, "customer").groupBy("c_nationkey").agg(F.count("*").alias("customers"))
    by_fips = B.counties(spark, d).join(n, F.col("nationkey") == F.col("c_nationkey")).select("fips", "customers")
    return urls.join(by_fips, "fips", "left").select("state", "fips", "level", "url", F.coalesce("customers", F.lit(0)).alias("customers"))


@query("scan_json_lines_by_source", "SELECT event_type AS source, user_id, CAST(ts AS DATE) AS time_value, value FROM events")
def _(spark, d):
    path = work_dir(spark, "json-lines")
    e = B.table(spark, d, "events").select("event_type", "user_id", F.date_format("ts", "yyyyMMdd").cast("int").alias("time_value"), "value")
    e.withColumn("folder", F.col("event_type")).drop("event_type").write.partitionBy("folder").json(path)
    x = RD.json_lines_by_source(spark, path, "user_id bigint, time_value int, value double")
    return x.select(F.regexp_replace("source", "^folder=", "").alias("source"), "user_id", "time_value", "value")


HIST = """h AS (SELECT location_id AS state, date, SUM(value) FILTER (variable = 'purchase') AS positive, SUM(value) FILTER (variable = 'view') AS deaths FROM evcum GROUP BY 1, 2),
 dl AS (SELECT state, date, positive - LAG(positive, 1, 0.0) OVER (PARTITION BY state ORDER BY date) AS "nC", deaths - LAG(deaths, 1, 0.0) OVER (PARTITION BY state ORDER BY date) AS "nD", positive AS "H" FROM h),
 t AS (SELECT state, date, 'nC' AS name, "nC" AS value FROM dl UNION ALL SELECT state, date, 'nD', "nD" FROM dl UNION ALL SELECT state, date, 'H', "H" FROM dl),
 f AS (SELECT state, date, name, CASE WHEN state LIKE '%003' AND date = DATE '2024-01-12' AND name = 'nC' THEN 100 ELSE value END AS value FROM t)"""


@query("scan_historical_state", f"""
WITH {HIST}, dn AS (SELECT x.state, x.name, CAST(t AS DATE) AS date FROM (SELECT state, name, MIN(date) AS lo, MAX(date) AS hi FROM f GROUP BY 1, 2) x, generate_series(lo, hi, INTERVAL 1 DAY) g(t))
SELECT a.state, a.date, a.name, CASE WHEN COUNT(b.value) >= 5 THEN round(SUM(exp(-0.5 * power((b.date - a.date) / 5.0, 2)) * b.value) / SUM(CASE WHEN b.value IS NOT NULL THEN exp(-0.5 * power((b.date - a.date) / 5.0, 2)) END), 6) END AS value
FROM dn a JOIN f b ON a.state = b.state AND a.name = b.name AND b.date BETWEEN a.date - 9 AND a.date + 9 WHERE a.date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25' GROUP BY 1, 2, 3""")
def _(spark, d):
    wide = L.to_wide_variables(B.evcum(spark, d), ["purchase", "view"], ["location_id", "date"]).withColumnRenamed("location_id", "state")
    fixes = spark.createDataFrame([("iso1:us#hsa:003", D(2024, 1, 12), "nC", 100.0)], "state string, date date, name string, value double")
    out = RD.historical_state(
        wide, {"nC": F.col("purchase"), "nD": F.col("view")}, {"H": F.col("purchase")}, fixes, D(2024, 1, 5), D(2024, 1, 25))
    return out.withColumn("value", F.round("value", 6))


@query("scan_forecast_weekly_to_daily", """
WITH w AS (SELECT c_nationkey AS fips, date_trunc('week', o_orderdate)::DATE AS date, CASE o_orderstatus WHEN 'F' THEN 0.5 WHEN 'O' THEN 0.25 ELSE 0.75 END AS quantile, COUNT(*) AS cases, COUNT(DISTINCT o_custkey) AS deaths
 FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3)
SELECT fips, date - DATE '2020-01-01' AS day, round(cases / 7, 9) AS "nC", round(deaths / 7, 9) AS "nD" FROM w WHERE quantile = 0.5 AND fips < 100""")
def _(spark, d):
    o = B.table(spark, d, "orders").join(B.table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    q = F.when(F.col("o_orderstatus") == "F", 0.5).when(F.col("o_orderstatus") == "O", 0.25).otherwise(0.75)
    w = o.groupBy(F.col("c_nationkey").alias("fips"), F.to_date(F.date_trunc("week", "o_orderdate")).alias("date"), q.alias("quantile")).agg(
        F.count("*").alias("weekly_new_cases"), F.count_distinct("o_custkey").alias("weekly_new_deaths"))
    x = RD.forecast_daily(w, 0.5, D(2020, 1, 1))
    return x.select("fips", F.col("day").cast("bigint").alias("day"), F.round("nC", 9).alias("nC"), F.round("nD", 9).alias("nD"))


@query("scan_mobility_lists", """
SELECT fips, string_agg(CAST(date AS VARCHAR), ',' ORDER BY date) AS dates, string_agg(CAST(CAST(m50 AS INTEGER) AS VARCHAR), ',' ORDER BY date) AS m50 FROM (SELECT location_id AS fips, date, value AS m50, CASE variable WHEN 'click' THEN 2 ELSE 1 END AS admin_level FROM evt) WHERE admin_level = 2 GROUP BY 1""")
def _(spark, d):
    rows = B.evt(spark, d).select(F.col("location_id").alias("fips"), "date", F.col("value").alias("m50"), F.when(F.col("variable") == "click", 2).otherwise(1).alias("admin_level"))
    x = RD.mobility_lists(rows, "m50")
    text = lambda c, t: F.array_join(F.transform(c, lambda v: v.cast(t).cast("string")), ",")
    return x.select("fips", text("date", "date").alias("dates"), text("m50", "int").alias("m50"))


@query("scan_public_orders_clean", """
SELECT lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS fips, c_mktsegment AS market_segment, make_date(2020, 3, CAST(c_custkey % 28 + 1 AS INTEGER)) AS stay_at_home, make_date(2020, 3, CAST(c_custkey % 27 + 2 AS INTEGER)) AS "50_gatherings" FROM customer""")
def _(spark, d):
    k = F.col("c_custkey")
    text = lambda n: F.concat(n.cast("string"), F.lit("-Mar"))
    rows = B.table(spark, d, "customer").select(
        (k % 100000).cast("string").alias("FIPS"), F.col("c_mktsegment").alias("Market Segment"), text(k % 28 + 1).alias("stay at home"), text(k % 27 + 2).alias(">50 gatherings"))
    return RD.clean_orders(rows, ["stay at home", ">50 gatherings"])


# A provider fact table whose names are those the connectors declare.
CONN = f"""cf AS (SELECT CASE event_type WHEN 'click' THEN 'nyt' WHEN 'view' THEN 'cdc' ELSE 'hhs' END AS provider, CASE WHEN event_type IN ('click', 'view') THEN 'cases' WHEN event_type = 'signup' THEN 'adult_icu_beds_capacity' WHEN event_type = 'error' THEN 'hospital_beds_capacity' ELSE 'unlisted' END AS variable_name,
  CASE WHEN event_type IN ('click', 'view') THEN 'cumulative' ELSE 'current' END AS measurement, CASE WHEN event_type IN ('click', 'view') THEN 'people' ELSE 'beds' END AS unit, location_id, CAST(dt AS DATE) + 970 AS dt, CAST(COUNT(*) AS DOUBLE) AS value
  FROM (SELECT *, variable_name AS event_type FROM fact) GROUP BY ALL)"""


def connector_fact(spark, d):
    t = F.col("variable_name")
    case = t.isin("click", "view")
    x = B.fact(spark, d).select(
        F.when(t == "click", "nyt").when(t == "view", "cdc").otherwise("hhs").alias("provider"), F.date_add("dt", 970).alias("dt"), "location_id",
        F.when(case, "cases").when(t == "signup", "adult_icu_beds_capacity").when(t == "error", "hospital_beds_capacity").otherwise("unlisted").alias("variable_name"),
        F.when(case, "cumulative").otherwise("current").alias("measurement"), F.when(case, "people").otherwise("beds").alias("unit"))
    keys = ["provider", "dt", "location_id", "variable_name", "measurement", "unit"]
    out = x.groupBy(*keys).agg(F.count("*").cast("double").alias("value"))
    null = F.lit(None).cast("string")
    return out.withColumns({c: F.lit("all") for c in ("age", "race", "ethnicity", "sex")} | {"source_url": null, "source_name": null})


@query("connector_plain", f"WITH {CONN} SELECT location_id, 'cases' AS variable, 'all' AS bucket, dt AS date, value FROM cf WHERE provider = 'nyt'")
def _(spark, d):
    return G.CONNECTORS["NYTimes"].load(connector_fact(spark, d), B.geo(spark, d)).obs


@query("connector_hospital", f"""
WITH {CONN} SELECT 'obs' AS kind, location_id, CASE variable_name WHEN 'adult_icu_beds_capacity' THEN 'icu_beds' ELSE 'staffed_beds' END AS variable, dt AS date, value FROM cf WHERE provider = 'hhs' AND variable_name <> 'unlisted'
UNION ALL SELECT 'static', location_id, 'icu_beds', NULL, arg_max(value, dt) FROM cf WHERE variable_name = 'adult_icu_beds_capacity' GROUP BY 2""")
def _(spark, d):
    ds = G.CONNECTORS["HHSHospitalState"].load(connector_fact(spark, d), B.geo(spark, d))
    return flatten(ds).filter("kind <> 'tag'").select("kind", "location_id", "variable", "date", "value")


@query("connector_spliced_cases", f"""
WITH {CONN}, w AS (SELECT location_id, dt, value, COALESCE(LEAD(dt) OVER (PARTITION BY location_id ORDER BY dt) - 1, (SELECT MAX(dt) FROM cf WHERE provider = 'cdc')) AS upto FROM cf WHERE provider = 'cdc'),
 k AS (SELECT location_id, CAST(t AS DATE) AS date, value FROM w, generate_series(dt, greatest(dt, upto), INTERVAL 1 DAY) g(t))
SELECT location_id, 'cases' AS variable, date, value FROM k WHERE date >= DATE '2023-03-23' UNION ALL SELECT location_id, 'cases', dt, value FROM cf WHERE provider = 'nyt' AND dt < DATE '2023-03-23'""")
def _(spark, d):
    return G.load_source("CDCNYT", connector_fact(spark, d), B.geo(spark, d), {}).obs.select("location_id", "variable", "date", "value")


@query("connector_priorities", f"""
WITH {CONN} SELECT v.variable, v.source, v.prio, COUNT(*) AS points FROM cf JOIN (VALUES ('nyt', 'cases', 'NYTimes', 0), ('cdc', 'cases', 'CDC', 1)) AS v(provider, variable, source, prio) USING (provider) WHERE variable_name = 'cases' GROUP BY 1, 2, 3""")
def _(spark, d):
    from geotally.operators.combine import feature_priorities

    f = connector_fact(spark, d)
    parts = [G.CONNECTORS[n].load(f, B.geo(spark, d)).obs.withColumn("source", F.lit(n)) for n in ("NYTimes", "USAFacts")]
    plain_cdc = G.Connector("CDC", G.CONNECTORS["CDC"].variables).load(f, B.geo(spark, d)).obs.withColumn("source", F.lit("CDC"))
    all_obs = parts[0].unionByName(parts[1]).unionByName(plain_cdc)
    prio = feature_priorities(spark, {"cases": ["CDC", "NYTimes"]})
    return all_obs.join(prio, ["variable", "source"]).groupBy("variable", "source", "prio").agg(F.count("*").alias("points"))


# A fact table with rows for every declared variable, in states and counties, and some that nothing declares.
SPECS = sorted({(r[0], r[1], r[2], r[3]) for c in G.CONNECTORS.values() for r in c.variables}) + [
    ("state", "ventilators_in_use", "current", "beds"), ("state", "brand_new", "current", "beds"), ("hhs", "brand_new", "new", "people")]
DECLARED = f"""sv AS (SELECT * FROM (VALUES {", ".join(f"({i}, '{a}', '{b}', '{m}', '{u}')" for i, (a, b, m, u) in enumerate(SPECS))}) AS s(no, provider, variable_name, measurement, unit)),
 ev AS (SELECT CASE WHEN user_id % 4 = 0 THEN regexp_replace(location_id, '#fips.*', '') ELSE location_id END AS location_id, dt + CAST((event_id * 7 + user_id) % 23 AS INTEGER) AS dt, (event_id * 31 + user_id) % {len(SPECS)} AS no FROM fact),
 df AS (SELECT provider, variable_name, measurement, unit, location_id, dt, CAST(COUNT(*) AS DOUBLE) AS value FROM ev JOIN sv USING (no) GROUP BY ALL),
 dg AS (SELECT DISTINCT location_id, upper(substr(location_id, 17, 2)) AS state, nullif(regexp_extract(location_id, 'fips:([0-9]+)', 1), '') AS fips, CASE WHEN location_id LIKE '%fips%' THEN 'county' ELSE 'state' END AS level FROM df)"""


def declared_fact(spark, d):
    specs = F.broadcast(spark.createDataFrame([(i, *s) for i, s in enumerate(SPECS)], "no long, provider string, variable_name string, measurement string, unit string"))
    f, u, e = B.fact(spark, d), F.col("user_id"), F.col("event_id")
    place = F.when(u % 4 == 0, F.regexp_replace("location_id", "#fips.*", "")).otherwise(F.col("location_id"))
    x = f.select(place.alias("location_id"), F.date_add("dt", ((e * 7 + u) % 23).cast("int")).alias("dt"), ((e * 31 + u) % len(SPECS)).alias("no")).join(specs, "no")
    out = x.groupBy("provider", "dt", "location_id", "variable_name", "measurement", "unit").agg(F.count("*").cast("double").alias("value"))
    null = F.lit(None).cast("string")
    return out.withColumns({c: F.lit("all") for c in ("age", "race", "ethnicity", "sex")} | {"source_url": null, "source_name": null})


def declared_geo(fact):
    fips = F.nullif(F.regexp_extract("location_id", "fips:([0-9]+)", 1), F.lit(""))
    return fact.select("location_id").distinct().select(
        "location_id", F.upper(F.substring("location_id", 17, 2)).alias("state"), fips.alias("fips"), F.when(fips.isNull(), "state").otherwise("county").alias("level"))


# The whole declared map. Days of cases lie around the day of the splice, all others around the first hospital days; one county
# stands for the capital's, and a third of the values are 0, so that every step has something to do.
MAPPED = DECLARED.replace(" df AS (", f""" df AS (SELECT provider, variable_name, measurement, unit, CASE WHEN n % 5 = 2 AND location_id LIKE '%fips%' THEN '{G.CAPITAL_COUNTY}' ELSE location_id END AS location_id,
  CASE WHEN variable_name IN ('cases', 'deaths') THEN dt + CAST(DATE '2023-03-01' - DATE '2024-01-01' AS INTEGER) ELSE dt + CAST(DATE '2020-08-25' - DATE '2024-01-01' AS INTEGER) END AS dt, CAST(SUM(n) % 3 AS DOUBLE) AS value FROM
  (SELECT provider, variable_name, measurement, unit, location_id, dt, COUNT(*) AS n FROM ev JOIN sv USING (no) GROUP BY ALL) GROUP BY 1, 2, 3, 4, 5, 6), du AS (""") + """,
 tt AS (SELECT location_id, dt AS date, SUM(value) AS value FROM df WHERE location_id LIKE '%fips%' GROUP BY 1, 2),
 cdcw AS (SELECT location_id, variable_name, dt, value, COALESCE(LEAD(dt) OVER (PARTITION BY location_id, variable_name ORDER BY dt) - 1, (SELECT MAX(dt) FROM df WHERE provider = 'cdc' AND variable_name IN ('cases', 'deaths') AND measurement = 'cumulative')) AS upto
   FROM df WHERE provider = 'cdc' AND variable_name IN ('cases', 'deaths') AND measurement = 'cumulative' AND unit = 'people'),
 cdcf AS (SELECT location_id, variable_name AS variable, CAST(t AS DATE) AS date, value FROM cdcw, generate_series(dt, greatest(dt, upto), INTERVAL 1 DAY) g(t)),
 nyt AS (SELECT location_id, variable_name AS variable, dt AS date, value FROM df WHERE provider = 'nyt' AND variable_name IN ('cases', 'deaths')),
 pos AS (SELECT provider, location_id, dt AS date, value / 100 AS value FROM df WHERE variable_name = 'pcr_tests_positive' AND measurement = 'rolling_average_7_day' AND unit = 'percentage' AND provider IN ('cdc2', 'cdc_originally_posted')),
 posc AS (SELECT * FROM pos UNION ALL SELECT provider, 'iso1:us#iso2:us-dc', date, value FROM pos WHERE location_id = '""" + G.CAPITAL_COUNTY + """'),
 post AS (SELECT * FROM posc JOIN (SELECT provider, location_id, MAX(date) AS upto FROM posc WHERE value <> 0 GROUP BY 1, 2) USING (provider, location_id) WHERE date <= upto)"""
HOSPITAL_DAYS = " ".join(f"WHEN '{k}' THEN DATE '{v}'" for k, v in G.HOSPITAL_STATE_STARTS.items())
LISTED = ", ".join(
    f"('{r[0]}', '{r[1]}', '{r[2]}', '{r[3]}', '{f}', '{label}', '{c.name}')"
    for f, names in G.FEATURES.items() for label in names if (c := G.CONNECTORS.get(label.partition(":")[0])) for r in c.variables if r[4] == f)
PRIORITIES = ", ".join(f"('{f}', '{label}', {prio})" for f, names in G.FEATURES.items() for prio, label in enumerate(reversed(names)))
MASKED = " OR ".join([f"(source LIKE '%:{m}' AND ({p}))" for m, p in G.MASKS.items()] + ["source NOT LIKE '%:%'"])
STARTED = f"connector NOT IN ('HHSHospitalState', 'HHSHospitalCounty') OR dt >= CASE WHEN level = 'state' THEN CASE sf {HOSPITAL_DAYS} ELSE DATE '{G.HOSPITAL_START}' END ELSE DATE '{G.HOSPITAL_START}' END"


def mapped_fact(spark, d):
    """Rows of every declared variable, as in ``declared_fact``, moved to the days that matter to the steps."""
    x = declared_fact(spark, d)
    county = (F.col("value") % 5 == 2) & F.col("location_id").contains("fips")
    shift = lambda day: (D(*day) - D(2024, 1, 1)).days
    days = F.when(F.col("variable_name").isin("cases", "deaths"), F.date_add("dt", shift((2023, 3, 1)))).otherwise(F.date_add("dt", shift((2020, 8, 25))))
    moved = x.withColumn("location_id", F.when(county, G.CAPITAL_COUNTY).otherwise(F.col("location_id"))).withColumn("dt", days)
    keys = [c for c in moved.columns if c != "value"]
    return moved.groupBy(*keys).agg((F.sum("value") % 3).alias("value"))


def mapped_geo(fact):
    """The dimension of ``declared_geo``, with the state's fips code for states, and the capital."""
    geo = declared_geo(fact)
    codes = F.create_map(*[F.lit(x) for state, fips in B.STATE_FIPS.items() for x in (state, fips)])
    return geo.withColumn("fips", F.coalesce("fips", F.try_element_at(codes, F.col("state"))))


@query("features_by_declared_sources", f"""
WITH {MAPPED}, li AS (SELECT * FROM (VALUES {LISTED}) AS l(provider, variable_name, measurement, unit, variable, source, connector)),
 pr AS (SELECT * FROM (VALUES {PRIORITIES}) AS p(variable, source, prio)),
 gx AS (SELECT location_id, state, level, COALESCE(fips, CASE state WHEN 'AL' THEN '01' WHEN 'AK' THEN '02' WHEN 'AZ' THEN '04' WHEN 'AR' THEN '05' WHEN 'CA' THEN '06' END) AS fips FROM (SELECT DISTINCT location_id, upper(substr(location_id, 17, 2)) AS state, nullif(regexp_extract(location_id, 'fips:([0-9]+)', 1), '') AS fips, CASE WHEN location_id LIKE '%fips%' THEN 'county' ELSE 'state' END AS level FROM df)),
 pl AS (SELECT df.location_id, variable, dt AS date, value, source FROM df JOIN li USING (provider, variable_name, measurement, unit) JOIN (SELECT *, coalesce(fips, '') AS sf FROM gx) g USING (location_id) WHERE connector <> 'CDC' AND ({STARTED})),
 st AS (SELECT location_id, variable, date, value, 'CDC' AS source FROM cdcf
   UNION ALL SELECT location_id, variable, date, value, 'CDCNYT:no-cities' FROM nyt WHERE date < DATE '{G.SPLICE_DATE}'
   UNION ALL SELECT location_id, variable, date, value, 'CDCNYT:no-cities' FROM cdcf WHERE date >= DATE '{G.SPLICE_DATE}'
   UNION ALL SELECT location_id, 'test_positivity_7d', date, COALESCE(h.value, o.value), 'CDCCombinedTesting' FROM (SELECT * FROM post WHERE provider = 'cdc2') h FULL JOIN (SELECT * FROM post WHERE provider <> 'cdc2') o USING (location_id, date)
   UNION ALL SELECT location_id, 'contact_tracers_count', date, value, 'TestAndTrace' FROM tt WHERE date >= DATE '2020-09-10'),
 al AS (SELECT x.* FROM (SELECT * FROM pl UNION ALL SELECT * FROM st) x LEFT JOIN gx USING (location_id) WHERE {MASKED}),
 ra AS (SELECT * FROM al JOIN pr USING (variable, source)), be AS (SELECT location_id, variable, MIN(prio) AS prio FROM ra GROUP BY 1, 2)
SELECT location_id, variable, date, round(value, 6) AS value, source FROM ra JOIN be USING (location_id, variable, prio)""")
def _(spark, d):
    """Every field of the declared map from every source with its steps; contact tracers come from a CSV."""
    from geotally.operators.combine import combine_by_priority, feature_priorities

    fact = mapped_fact(spark, d)
    geo = mapped_geo(fact)
    path = work_dir(spark, "tracers")
    fips = F.regexp_extract("location_id", "fips:([0-9]+)", 1)
    fact.filter("location_id like '%fips%'").groupBy(fips.alias("fips"), F.col("dt").alias("date")).agg(F.sum("value").alias("contact_tracers_count")).write.csv(path, header=True)
    tracers, _ = dataclasses.replace(TEST_AND_TRACE, first=D(2020, 9, 10)).load(spark, path, geo)
    obs, tags = G.load_features(fact, geo, {"TestAndTrace": tracers})
    points, _ = combine_by_priority(obs, tags, feature_priorities(spark, G.FEATURES))
    return points.select("location_id", "variable", "date", F.round("value", 6).alias("value"), "source")


@query("connector_positivity_combined", f"""
WITH {MAPPED} SELECT location_id, date, round(COALESCE(h.value, o.value), 6) AS value FROM (SELECT * FROM post WHERE provider = 'cdc2') h FULL JOIN (SELECT * FROM post WHERE provider <> 'cdc2') o USING (location_id, date)""")
def _(spark, d):
    fact = mapped_fact(spark, d)
    return G.load_source("CDCCombinedTesting", fact, mapped_geo(fact), {}).obs.select("location_id", "date", F.round("value", 6).alias("value"))


# Daily tests of two groups of events, in states and their counties, so that most weeks are whole.
TESTS = """tf AS (SELECT 'iso1:us#iso2:us-' || lower(list_extract(['AL','AK','AZ','AR','CA'], CAST(user_id % 5 + 1 AS INTEGER))) AS location_id, CAST(ts AS DATE) AS dt,
  CASE WHEN event_id % 2 = 0 THEN 'pcr_tests_positive' ELSE 'pcr_tests_total' END AS variable_name, CAST(COUNT(*) AS DOUBLE) AS value FROM fact GROUP BY 1, 2, 3)"""


@query("connector_weekly_tests", f"""
WITH {TESTS} SELECT a.location_id, CASE a.variable_name WHEN 'pcr_tests_positive' THEN 'positive_tests_viral_7d' ELSE 'total_tests_viral_7d' END AS variable, a.dt AS date, SUM(b.value) AS value
FROM tf a JOIN tf b ON a.location_id = b.location_id AND a.variable_name = b.variable_name AND b.dt BETWEEN a.dt - 6 AND a.dt GROUP BY 1, 2, 3 HAVING COUNT(*) = 7""")
def _(spark, d):
    f, u = B.fact(spark, d), F.col("user_id")
    states = F.array(*[F.lit(s.lower()) for s in B.REGION_STATES])
    rows = f.groupBy(
        F.concat(F.lit("iso1:us#iso2:us-"), states[(u % 5).cast("int")]).alias("location_id"), F.to_date("ts").alias("dt"),
        F.when(F.col("event_id") % 2 == 0, "pcr_tests_positive").otherwise("pcr_tests_total").alias("variable_name")).agg(F.count("*").cast("double").alias("value"))
    null = F.lit(None).cast("string")
    fact = rows.withColumns({"provider": F.lit("state"), "measurement": F.lit("new"), "unit": F.lit("specimens")} | {c: F.lit("all") for c in ("age", "race", "ethnicity", "sex")} | {"source_url": null, "source_name": null})
    return G.CONNECTORS["StateProvidedTesting"].load(fact, B.geo(spark, d)).obs.select("location_id", "variable", "date", "value")


@query("connector_all", f"""
WITH {DECLARED}, li AS (SELECT * FROM (VALUES {", ".join(f"('{n}', '{r[0]}', '{r[1]}', '{r[2]}', '{r[3]}', '{r[4]}')" for n, c in G.CONNECTORS.items() for r in c.variables)}) AS l(connector, provider, variable_name, measurement, unit, variable))
SELECT connector, variable, COUNT(*) AS points, SUM(value) AS total FROM df JOIN li USING (provider, variable_name, measurement, unit) GROUP BY 1, 2""")
def _(spark, d):
    """What each connector reads, before its own steps."""
    fact = declared_fact(spark, d)
    rows = [G.Connector(n, c.variables).load(fact, declared_geo(fact)).obs.groupBy("variable").agg(F.count("*").alias("points"), F.sum("value").alias("total")).select(F.lit(n).alias("connector"), "*") for n, c in G.CONNECTORS.items()]
    out = rows[0]
    for more in rows[1:]:
        out = out.unionByName(more)
    return out


@query("unlisted_variables", f"WITH {DECLARED} SELECT provider, variable_name, COUNT(*) AS n FROM df WHERE variable_name = 'brand_new' GROUP BY 1, 2")
def _(spark, d):
    return G.unlisted_variables(declared_fact(spark, d))


@query("static_by_declared_sources", """
SELECT location_id, attr, num, CAST(NULL AS VARCHAR) AS str, 'FIPSPopulation' AS source FROM (SELECT location_id, 'population' AS attr, population AS num FROM pop WHERE population IS NOT NULL)
UNION ALL SELECT m.location_id, 'hsa_population', t.n, NULL, 'HSAPopulation' FROM pop JOIN hsamap m USING (location_id) JOIN (SELECT hsa, SUM(population) AS n FROM pop JOIN hsamap USING (location_id) GROUP BY 1) t USING (hsa)
UNION ALL SELECT m.location_id, 'hsa', NULL, hsa, 'HSAPopulation' FROM pop JOIN hsamap m USING (location_id)
UNION ALL SELECT location_id, 'location_page_url', NULL, 'https://example.org/us/' || lower(state), 'LocationPages' FROM geo WHERE level = 'county'""")
def _(spark, d):
    from geotally.operators.rollup import hsa_population

    pop = B.pop(spark, d).select("location_id", "population")
    area = hsa_population(pop, B.hsamap(spark, d).withColumn("hsa_name", F.lit(None).cast("string"))).drop("hsa_name")
    url = F.concat(F.lit("https://example.org/us/"), F.lower("state")).alias("location_page_url")
    pages = B.counties(spark, d).select("location_id", url)
    files = {"FIPSPopulation": G.static_source(pop, ["population"], []), "HSAPopulation": G.static_source(area, ["hsa_population"], ["hsa"]), "LocationPages": G.static_source(pages, [], ["location_page_url"])}
    return G.load_static_features(files, {k: v for k, v in G.STATIC_FEATURES.items() if k != "hsa_name"})
