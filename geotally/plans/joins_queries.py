"""Queries for joins and combinations."""

import datetime

from pyspark.sql import functions as F

from geotally.functions import tagtext as T
from geotally.model import POINT, SERIES, STATIC, TAG, Dataset
from geotally.operators import combine as C, filters as O
from geotally.operators.rollup import latest_values
from geotally.plans import bindings as B
from geotally.plans.catalog import query
from geotally.plans.filters_queries import flat_sql
from geotally.model import flatten

D = datetime.date
# Lowest priority first.
DEFINITION = {"n_orders": ["F", "O", "P"]}
PRIO = "(VALUES ('n_orders', 'P', 0), ('n_orders', 'O', 1), ('n_orders', 'F', 2)) AS p(variable, source, prio)"
# Sources miss some counties and some segments, so the merge has something to choose.
MISSING = """SELECT * FROM (SELECT * FROM src UNION ALL SELECT * FROM srcall) WHERE NOT (source = 'P' AND (location_id LIKE '%3' OR location_id LIKE '%7'))
  AND NOT (source = 'O' AND location_id LIKE '%3' AND bucket <> 'all')"""


def sparse_sources(spark, d):
    x = B.src(spark, d).unionByName(B.srcall(spark, d))
    loc, s = F.col("location_id"), F.col("source")
    return x.filter(~((s == "P") & (loc.endswith("3") | loc.endswith("7")))).filter(
        ~((s == "O") & loc.endswith("3") & (F.col("bucket") != "all"))
    )


def source_tags(spark, d):
    return B.source_keys(spark, d).withColumns(
        {"tag_type": F.lit(T.PROVENANCE), "content": F.concat(F.lit("src_"), "source")}
    )


@query("combine_by_priority", f"""
WITH s AS ({MISSING}), r AS (SELECT s.*, split_part(bucket, ':', 1) AS distribution, prio FROM s JOIN {PRIO} USING (variable, source)),
 w AS (SELECT location_id, variable, distribution, MIN(prio) AS prio FROM r GROUP BY 1, 2, 3),
 tg AS (SELECT DISTINCT location_id, variable, bucket, source, 'src_' || source AS content, 'all' AS distribution FROM srcall)
SELECT 'obs' AS kind, r.location_id, r.variable, r.bucket, r.date, r.value, r.source AS content FROM r JOIN w USING (location_id, variable, distribution, prio)
UNION ALL SELECT 'tag', tg.location_id, tg.variable, tg.bucket, NULL, NULL, tg.content FROM tg JOIN {PRIO} USING (variable, source) JOIN w USING (location_id, variable, distribution, prio)""")
def _(spark, d):
    points, tags = C.combine_by_priority(
        sparse_sources(spark, d), source_tags(spark, d), C.feature_priorities(spark, DEFINITION)
    )
    return points.select(F.lit("obs").alias("kind"), *POINT, "value", F.col("source").alias("content")).unionByName(
        tags.select(F.lit("tag").alias("kind"), *SERIES, F.lit(None).cast("date").alias("date"),
                    F.lit(None).cast("double").alias("value"), "content")
    )


STATICS = """sp AS (SELECT 'orders' AS source, location_id, 'population' AS attr, CAST(COUNT(DISTINCT o_custkey) AS DOUBLE) AS num FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN geo g ON g.nationkey = c_nationkey WHERE location_id NOT LIKE '%4' GROUP BY 2 UNION ALL SELECT 'customers', location_id, 'population', population FROM pop
  UNION ALL SELECT 'customers', location_id, 'balance', balance FROM pop)"""


def static_sources(spark, d):
    null = F.lit(None).cast("string").alias("str")
    buyers = (
        B.placed_orders(spark, d).filter(~F.col("location_id").endswith("4")).groupBy("location_id")
        .agg(F.countDistinct("o_custkey").cast("double").alias("num"))
        .select(F.lit("orders").alias("source"), "location_id", F.lit("population").alias("attr"), "num", null)
    )
    everyone = B.pop(spark, d).unpivot(["location_id"], ["population", "balance"], "attr", "num").select(
        F.lit("customers").alias("source"), "location_id", "attr", "num", null
    )
    return buyers.unionByName(everyone)


@query("combine_static_by_priority", f"""
WITH {STATICS}, p AS (SELECT * FROM (VALUES ('population', 'orders', 0), ('population', 'customers', 1), ('balance', 'customers', 0)) AS v(attr, source, prio))
SELECT location_id, attr, arg_min(num, prio) AS num, CAST(NULL AS VARCHAR) AS str FROM sp JOIN p USING (attr, source) GROUP BY 1, 2""")
def _(spark, d):
    prio = C.feature_priorities(spark, {"population": ["customers", "orders"], "balance": ["customers"]})
    return C.combine_static_by_priority(static_sources(spark, d), prio)


@query("feature_definition", f"""
SELECT s.source, p.prio, s.variable, COUNT(*) AS n, SUM(s.value) AS total FROM srcall s JOIN {PRIO} USING (variable, source) GROUP BY 1, 2, 3""")
def _(spark, d):
    prio = C.feature_priorities(spark, DEFINITION)
    return B.srcall(spark, d).join(prio, ["variable", "source"]).groupBy("source", "prio", "variable").agg(
        F.count("*").alias("n"), F.sum("value").alias("total")
    )


@query("source_with_region_mask", """
SELECT o.* FROM obs o JOIN geo g USING (location_id) WHERE state IN ('AL', 'AK', 'CA') AND NOT fips LIKE '06%9'""")
def _(spark, d):
    include = O.region_mask("county", ["AL", "AK", "CA"])
    return C.source_with_region_mask(
        B.obs(spark, d), B.geo(spark, d), include, F.col("fips").startswith("06") & F.col("fips").endswith("9")
    ).select(*POINT, "value")


def one_source(spark, d, name):
    return B.srcall(spark, d).filter(F.col("source") == name).select(*POINT, "value")


@query("coalesce_sources_pointwise", """
SELECT location_id, variable, bucket, date, COALESCE(a.value, b.value) AS value FROM (SELECT * FROM srcall WHERE source = 'P') a
FULL JOIN (SELECT * FROM srcall WHERE source = 'O') b USING (location_id, variable, bucket, date)""")
def _(spark, d):
    return C.coalesce_pointwise(one_source(spark, d, "P"), one_source(spark, d, "O"))


@query("splice_by_cutoff", """
SELECT 'obs' AS kind, location_id, variable, bucket, date, value, CAST(NULL AS VARCHAR) AS content FROM srcall WHERE (source = 'F' AND date < DATE '1998-03-23') OR (source = 'O' AND date >= DATE '1998-03-23')
UNION ALL SELECT DISTINCT 'tag', location_id, variable, bucket, NULL, NULL, '{"type":"spliced"}' FROM srcall WHERE (source = 'F' AND date < DATE '1998-03-23') OR (source = 'O' AND date >= DATE '1998-03-23')""")
def _(spark, d):
    x = C.splice(one_source(spark, d, "F"), one_source(spark, d, "O"), D(1998, 3, 23))
    tags = C.constant_source_tags(x, T.source_content(F.lit("spliced")))
    return x.select(F.lit("obs").alias("kind"), *POINT, "value", F.lit(None).cast("string").alias("content")).unionByName(
        tags.select(F.lit("tag").alias("kind"), *SERIES, F.lit(None).cast("date").alias("date"), F.lit(None).cast("double").alias("value"), "content")
    )


@query("copy_region", """
SELECT * FROM obs UNION ALL SELECT 'iso1:us#iso2:us-ak', variable, bucket, date, value FROM obs WHERE location_id = 'iso1:us#iso2:us-ak#fips:02002'""")
def _(spark, d):
    return C.copy_region(B.obs(spark, d), "iso1:us#iso2:us-ak#fips:02002", "iso1:us#iso2:us-ak")


@query("join_columns", """
SELECT * FROM obs WHERE variable = 'n_orders' UNION ALL SELECT location_id, 'running', bucket, date, value FROM cum WHERE variable = 'n_orders'""")
def _(spark, d):
    ds = B.dataset(spark, d)
    a = ds.with_obs(ds.obs.filter("variable = 'n_orders'"))
    b = ds.with_obs(B.running(a.obs).withColumn("variable", F.lit("running")))
    return C.join_columns(a, b).obs


@query("merge_attributes", f"""
WITH {STATICS}, b AS (SELECT location_id, attr, num FROM sp WHERE source = 'orders' UNION ALL SELECT location_id, 'extra', nationkey FROM geo WHERE level = 'county')
SELECT location_id, attr, COALESCE(b.num, a.num) AS num, a.str FROM static a FULL JOIN b USING (location_id, attr)""")
def _(spark, d):
    b = static_sources(spark, d).filter("source = 'orders'").select(*STATIC).unionByName(
        B.counties(spark, d).select("location_id", F.lit("extra").alias("attr"), F.col("nationkey").cast("double").alias("num"),
                                    F.lit(None).cast("string").alias("str")))
    return C.merge_attributes(B.static(spark, d), b)


@query("add_static_values", """
SELECT * FROM static UNION ALL SELECT location_id, 'hsa', NULL, hsa FROM hsamap""")
def _(spark, d):
    added = B.hsamap(spark, d).select("location_id", F.lit("hsa").alias("attr"), F.lit(None).cast("double").alias("num"), F.col("hsa").alias("str"))
    return C.add_static_values(B.static(spark, d), added)


@query("static_with_geo", "SELECT p.location_id, population, balance, fips, state, level, name FROM pop p LEFT JOIN geo USING (location_id)")
def _(spark, d):
    return C.static_with_geo(B.pop(spark, d), B.geo(spark, d)).select(
        "location_id", "population", "balance", "fips", "state", "level", "name"
    )


@query("latest_with_static", """
WITH l AS (SELECT location_id, variable, arg_max(value, date) AS value FROM obs GROUP BY 1, 2)
SELECT location_id, variable, COALESCE(num, value) AS value FROM l FULL JOIN (SELECT location_id, CASE attr WHEN 'balance' THEN 'revenue' ELSE attr END AS variable, num FROM static WHERE num IS NOT NULL) s USING (location_id, variable)""")
def _(spark, d):
    # The balance attribute takes the name of a timeseries variable, so that static wins there.
    static = B.static(spark, d).withColumn("attr", F.when(F.col("attr") == "balance", "revenue").otherwise(F.col("attr")))
    return C.latest_with_static(latest_values(B.obs(spark, d)), static)


@query("county_name_join", """
SELECT x.fips, x.state, g.name AS county, x.n FROM (SELECT lpad(CAST(location AS VARCHAR), 5, '0') AS fips, upper(substr(location_id, 17, 2)) AS state, COUNT(*) AS n FROM fact GROUP BY 1, 2) x
LEFT JOIN geo g ON g.fips = x.fips AND g.state = x.state""")
def _(spark, d):
    from geotally.functions import regions as R

    f = B.fact(spark, d).groupBy(
        R.fips_from_int(F.col("location")).alias("fips"), F.upper(F.substring("location_id", 17, 2)).alias("state")
    ).agg(F.count("*").alias("n"))
    return C.county_names(f, B.geo(spark, d)).select("fips", "state", "county", "n")


@query("clear_common_values", """
SELECT a.location_id, a.date, CASE WHEN b.location_id IS NULL THEN a.value END AS value FROM (SELECT * FROM srcall WHERE source = 'F') a
LEFT JOIN (SELECT * FROM srcall WHERE source = 'P') b ON a.location_id = b.location_id AND a.date = b.date""")
def _(spark, d):
    a, b = one_source(spark, d, "F"), one_source(spark, d, "P")
    return C.clear_common_values(a.select("location_id", "date", "value"), b, ["location_id", "date"], "value")


RULES = [
    ("iso1:us#iso2:us-al", D(1996, 1, 10), D(1996, 3, 1), "both", True, True),
    ("iso1:us#iso2:us-az", D(1997, 5, 1), D(1997, 5, 1), "cases", False, True),
    ("iso1:us#iso2:us-ak#fips:02002", D(1998, 2, 1), D(1998, 12, 31), "deaths", True, False),
]
RULE_SCHEMA = "location_id string, start date, end date, kind string, own boolean, subregions boolean"
RULES_SQL = """rules AS (SELECT * FROM (VALUES ('iso1:us#iso2:us-al', DATE '1996-01-10', DATE '1996-03-01', 'both', true, true),
 ('iso1:us#iso2:us-az', DATE '1997-05-01', DATE '1997-05-01', 'cases', false, true),
 ('iso1:us#iso2:us-ak#fips:02002', DATE '1998-02-01', DATE '1998-12-31', 'deaths', true, false)) AS v(location_id, start_d, end_d, kind, own, sub)),
 flat AS (SELECT location_id, start_d, end_d, kind FROM rules WHERE own UNION ALL SELECT p.location_id, start_d, end_d, kind FROM rules r JOIN parent p ON p.parent_id = r.location_id WHERE sub),
 rx AS (SELECT location_id, start_d, end_d, unnest(CASE WHEN kind = 'both' THEN ['cases', 'deaths'] ELSE [kind] END) AS kind FROM flat)"""


def anomaly_rules(spark, d):
    return C.explode_subregions(spark.createDataFrame(RULES, RULE_SCHEMA), B.parent(spark, d))


@query("explode_subregions", f"""
WITH {RULES_SQL} SELECT rx.location_id, rx.kind, COUNT(o.date) AS points FROM rx LEFT JOIN obs o ON o.location_id = rx.location_id
 AND o.variable = CASE rx.kind WHEN 'cases' THEN 'n_orders' ELSE 'revenue' END AND o.date BETWEEN start_d AND end_d GROUP BY 1, 2""")
def _(spark, d):
    rules = anomaly_rules(spark, d).withColumn("variable", F.when(F.col("kind") == "cases", "n_orders").otherwise("revenue"))
    days = rules.withColumn("date", F.explode(F.sequence("start", "end")))
    hit = days.join(B.obs(spark, d).select("location_id", "variable", "date", "value"), ["location_id", "variable", "date"], "left")
    return hit.groupBy("location_id", "kind").agg(F.count("value").alias("points"))


@query("join_rt_by_region", """
SELECT o.location_id, o.date, o.value AS n_orders, r.value AS rt FROM (SELECT * FROM obs WHERE variable = 'n_orders') o
LEFT JOIN (SELECT location_id, date, value FROM srcall WHERE source = 'P') r USING (location_id, date)""")
def _(spark, d):
    base = B.obs(spark, d).filter("variable = 'n_orders'").select("location_id", "date", F.col("value").alias("n_orders"))
    rt = one_source(spark, d, "P").select("location_id", "date", F.col("value").alias("rt"))
    return C.join_by_region_date(base, rt)


@query("join_day_rows_flat", """
WITH a AS (SELECT location_id, date, value AS f FROM srcall WHERE source = 'F'), b AS (SELECT location_id, date, value AS o FROM srcall WHERE source = 'O'),
 c AS (SELECT location_id, date, value AS p FROM srcall WHERE source = 'P')
SELECT g.location_id, g.fips, g.state, date, f, o, p FROM geo g JOIN (SELECT * FROM a FULL JOIN b USING (location_id, date) FULL JOIN c USING (location_id, date)) USING (location_id)""")
def _(spark, d):
    frames = [one_source(spark, d, s).select("location_id", "date", F.col("value").alias(s.lower())) for s in "FOP"]
    return C.join_day_rows(B.counties(spark, d).select("location_id", "fips", "state"), frames)


@query("append_regions", "SELECT * FROM obs UNION ALL SELECT * FROM evt")
def _(spark, d):
    a = B.dataset(spark, d)
    return C.append_regions(a, a.with_obs(B.evt(spark, d))).obs


@query("combine_many", flat_sql("SELECT * FROM obs"))
def _(spark, d):
    ds = B.dataset(spark, d)
    geo = B.counties(spark, d)
    parts = [O.keep_locations(ds, geo.filter(F.col("state") == s)) for s in B.REGION_STATES]
    return flatten(C.combine_many(parts))


@query("sort_keys", "SELECT location_id, variable, bucket, date, value FROM obsb ORDER BY ALL")
def _(spark, d):
    return B.obsb(spark, d).orderBy(*POINT)


@query("top_k_desc", """
SELECT l_orderkey, round(SUM(l_extendedprice), 2) AS total FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""")
def _(spark, d):
    x = B.table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.round(F.sum("l_extendedprice"), 2).alias("total"))
    return x.orderBy(F.desc("total"), "l_orderkey").limit(20)


@query("difference", "SELECT location_id, date FROM srcall WHERE source = 'F' EXCEPT SELECT location_id, date FROM srcall WHERE source = 'P'")
def _(spark, d):
    k = ["location_id", "date"]
    return one_source(spark, d, "F").select(*k).distinct().join(one_source(spark, d, "P").select(*k), k, "left_anti")


@query("intersection", "SELECT location_id, date FROM srcall WHERE source = 'F' INTERSECT SELECT location_id, date FROM srcall WHERE source = 'P'")
def _(spark, d):
    k = ["location_id", "date"]
    return one_source(spark, d, "F").select(*k).distinct().join(one_source(spark, d, "P").select(*k), k, "left_semi")


@query("distinct_rows", "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem")
def _(spark, d):
    return B.table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag").distinct()
