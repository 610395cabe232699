"""Queries for filters and subsets."""

import datetime

from pyspark.sql import functions as F

from geotally.functions import regions as R, scalars as S
from geotally.model import POINT, SERIES, Dataset, assert_unique, flatten
from geotally.operators import filters as O
from geotally.plans import bindings as B
from geotally.plans.catalog import query
from geotally.sources import provider as P

D = datetime.date
FLAT = """SELECT 'obs' AS kind, location_id, variable, bucket, date, value, CAST(NULL AS VARCHAR) AS tag_type, CAST(NULL AS VARCHAR) AS content FROM o
 UNION ALL SELECT 'static', location_id, attr, NULL, NULL, num, NULL, str FROM s
 UNION ALL SELECT 'tag', location_id, variable, bucket, NULL, NULL, tag_type, content FROM t"""


def flat_sql(o, s="SELECT * FROM static", t="SELECT * FROM tags"):
    return f"WITH o AS ({o}), s AS ({s}), t AS ({t}) {FLAT}"


def by_location(where):
    return flat_sql(*[f"SELECT * FROM {n} WHERE location_id IN (SELECT location_id FROM geo WHERE {where})" for n in ("obs", "static", "tags")])


@query("filter_rows_key", """
SELECT o.location_id, variable, fips, state, date, value FROM obs o JOIN geo USING (location_id) WHERE level = 'county'
 AND country = 'USA' AND state IN ('AL', 'AZ', 'CA') AND date > DATE '1996-03-01' AND date < DATE '2001-01-01' AND fips NOT LIKE '%999'
 AND fips NOT LIKE '04001%' AND regexp_matches(o.location_id, 'iso2:us-(al|az)')""")
def _(spark, d):
    rows = B.obs(spark, d).join(B.geo(spark, d), "location_id")
    key = O.rows_key(
        level="county", country="USA", states=["AL", "AZ", "CA"], after=D(1996, 3, 1), before=D(2001, 1, 1),
        exclude_unknown=True, exclude_fips_prefix="04001", location_id_matches="iso2:us-(al|az)",
    )
    return rows.filter(key).select("location_id", "variable", "fips", "state", "date", "value")


@query("subset_regions", by_location("level = 'county' AND state IN ('AK', 'CA')"))
def _(spark, d):
    key = O.rows_key(level="county", states=["AK", "CA"])
    return flatten(O.subset_regions(B.dataset(spark, d), B.geo(spark, d), key))


@query("subset_mask_union", by_location("(level = 'county' AND state = 'AL') OR location_id IN ('iso1:us', 'iso1:us#iso2:us-az#fips:04003') OR state = 'AR'"))
def _(spark, d):
    union = O.any_mask(
        [O.region_mask("county", ["AL"]), O.region_mask(states=["AR"])], ["iso1:us", "iso1:us#iso2:us-az#fips:04003"]
    )
    return flatten(O.subset_regions(B.dataset(spark, d), B.geo(spark, d), F.coalesce(union, F.lit(False))))


BIG = "location_id IN (SELECT location_id FROM pop WHERE population > (SELECT AVG(population) FROM pop))"


def _big(spark, d):
    p = B.pop(spark, d)
    return p.filter(F.col("population") > p.agg(F.avg("population")).scalar())


@query("subset_locations", flat_sql(*[f"SELECT * FROM {n} WHERE {BIG}" for n in ("obs", "static", "tags")]))
def _(spark, d):
    return flatten(O.keep_locations(B.dataset(spark, d), _big(spark, d)))


@query("remove_locations", flat_sql(*[f"SELECT * FROM {n} WHERE NOT {BIG}" for n in ("obs", "static", "tags")]))
def _(spark, d):
    return flatten(O.remove_locations(B.dataset(spark, d), _big(spark, d)))


@query("partition_by_region", """
SELECT o.location_id, o.variable, o.date, o.value, (g.state IN ('AL', 'AK') AND NOT g.fips LIKE '%3') AS included
FROM obs o JOIN geo g USING (location_id)""")
def _(spark, d):
    inc, rest = O.partition_by_region(
        B.dataset(spark, d), B.geo(spark, d), F.coalesce(O.region_mask(states=["AL", "AK"]), F.lit(False)), F.col("fips").endswith("3")
    )
    pick = lambda ds, flag: ds.obs.select("location_id", "variable", "date", "value", F.lit(flag).alias("included"))
    return pick(inc, True).unionByName(pick(rest, False))


@query("counties_and_places_after", """
SELECT location_id, variable, bucket, date, value FROM obs JOIN geo USING (location_id) WHERE level IN ('county', 'place') AND date > DATE '2000-06-30'""")
def _(spark, d):
    geo = B.geo(spark, d).filter(F.col("level").isin("county", "place"))
    ds = O.keep_locations(B.dataset(spark, d), geo)
    return O.columns_after(ds.obs, POINT + ["value"], D(2000, 6, 30))


ONE = "iso1:us#iso2:us-ak#fips:02002"


@query("one_region", flat_sql(*[f"SELECT * FROM {n} WHERE location_id = '{ONE}'" for n in ("obs", "static", "tags")]))
def _(spark, d):
    return flatten(O.one_region(B.dataset(spark, d), ONE))


@query("iter_regions", """
SELECT location_id, variable, COUNT(*) AS n_days, MIN(date) AS first_date, MAX(date) AS last_date, SUM(value) AS total FROM evt GROUP BY 1, 2""")
def _(spark, d):
    return B.evt(spark, d).groupBy("location_id", "variable").agg(
        F.count("*").alias("n_days"), F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.sum("value").alias("total")
    )


@query("one_region_after", f"SELECT variable, date, value FROM obs WHERE location_id = '{ONE}' AND date > DATE '1999-12-31'")
def _(spark, d):
    region = O.one_region(B.dataset(spark, d), ONE)
    return O.columns_after(region.obs, ["variable", "date", "value"], D(1999, 12, 31))


WIDE_EV = """wide AS (SELECT location_id, date, SUM(value) FILTER (variable = 'click') AS click, SUM(value) FILTER (variable = 'purchase') AS purchase FROM evt GROUP BY 1, 2)"""


@query("trim_padded_nulls", f"""
WITH {WIDE_EV}, lim AS (SELECT location_id, MIN(date) lo, MAX(date) hi FROM wide WHERE click IS NOT NULL OR purchase IS NOT NULL GROUP BY 1)
SELECT wide.* FROM wide JOIN lim USING (location_id) WHERE date BETWEEN lo AND hi""")
def _(spark, d):
    from geotally.operators.layout import to_wide_variables

    wide = to_wide_variables(B.evt(spark, d), ["click", "purchase"], by=["location_id", "date"])
    return O.trim_padded_nulls(wide, ["click", "purchase"])


@query("drop_variables", flat_sql("SELECT * FROM obs WHERE variable <> 'revenue'", "SELECT * FROM static WHERE attr <> 'balance'",
                                  "SELECT * FROM tags WHERE variable <> 'revenue'"))
def _(spark, d):
    return flatten(O.drop_variables(B.dataset(spark, d), ["revenue", "balance"]))


@query("drop_na_variables", flat_sql("SELECT * FROM obs WHERE variable = 'n_orders'"))
def _(spark, d):
    ds = B.dataset(spark, d)
    value = F.when(F.col("variable") == "n_orders", F.col("value"))
    return flatten(O.drop_na_variables(ds.with_obs(ds.obs.withColumn("value", value))))


@query("drop_stale_series", f"""
WITH fresh AS (SELECT location_id, variable, bucket FROM obs GROUP BY 1, 2, 3 HAVING MAX(date) >= DATE '2001-01-28'),
 o AS (SELECT obs.* FROM obs SEMI JOIN fresh USING (location_id, variable, bucket)), s AS (SELECT * FROM static), t AS (SELECT tags.* FROM tags SEMI JOIN fresh USING (location_id, variable, bucket)) {FLAT}""")
def _(spark, d):
    return flatten(O.drop_stale_series(B.dataset(spark, d), D(2001, 1, 28)))


@query("drop_future_observations", flat_sql("SELECT * FROM obs WHERE date <= DATE '2000-01-01'", t="""SELECT * FROM tags UNION ALL
 SELECT DISTINCT location_id, variable, bucket, 'drop_future_observation', '{"after":"2000-01-01"}' FROM obs WHERE date > DATE '2000-01-01'"""))
def _(spark, d):
    return flatten(O.drop_future_observations(B.dataset(spark, d), D(2000, 1, 1)))


@query("drop_regions_without_population", "SELECT * FROM obs WHERE location_id IN (SELECT location_id FROM pop WHERE population > 0)")
def _(spark, d):
    ds = B.dataset(spark, d)
    users = B.evt(spark, d)
    return O.drop_regions_without_population(ds.with_obs(ds.obs.unionByName(users))).obs


@query("unexpected_population_drops", "SELECT DISTINCT location_id FROM evt WHERE location_id NOT LIKE '%7'")
def _(spark, d):
    ds = B.dataset(spark, d)
    users = B.evt(spark, d)
    known = users.filter(F.col("location_id").endswith("7")).select("location_id").distinct()
    return O.unexpected_drops(ds.with_obs(ds.obs.unionByName(users)), known)


@query("drop_old_dates", "SELECT location_id, variable, date, value FROM obs WHERE date >= DATE '1998-01-01'")
def _(spark, d):
    return O.drop_old_dates(B.obs(spark, d), ["location_id", "variable", "date", "value"], D(1998, 1, 1))


@query("filter_start_dates", """
SELECT o.* FROM obs o JOIN geo USING (location_id) WHERE date >= CASE WHEN state = 'AL' THEN DATE '1999-05-05' WHEN state = 'CA' THEN DATE '2000-02-02' ELSE DATE '1996-06-06' END""")
def _(spark, d):
    late = F.when(F.col("state") == "AL", F.lit(D(1999, 5, 5))).when(F.col("state") == "CA", F.lit(D(2000, 2, 2)))
    starts = B.counties(spark, d).select("location_id", late.alias("start"))
    return O.filter_start_dates(B.obs(spark, d), starts, D(1996, 6, 6)).select(*POINT, "value")


@query("filter_unknown_locations", """
SELECT fips, COUNT(*) AS n FROM (SELECT lpad(CAST(o_custkey * 37 % 99999 AS VARCHAR), 5, '0') AS fips FROM orders)
WHERE fips NOT LIKE '%999' AND fips NOT LIKE '90%' GROUP BY 1""")
def _(spark, d):
    fips = F.lpad((F.col("o_custkey") * 37 % 99999).cast("string"), 5, "0")
    return B.table(spark, d, "orders").select(fips.alias("fips")).filter(O.known_fips(F.col("fips"))).groupBy("fips").agg(F.count("*").alias("n"))


SPEC = """(VALUES ('alpha', 'click', 'cumulative', 'people', 'cases'), ('alpha', 'view', 'current', 'people', 'beds'), ('beta', 'signup', 'cumulative', 'people', 'deaths'))
 AS v(provider, variable_name, measurement, unit, field)"""
FACT_SPEC = [
    ("alpha", "click", "cumulative", "people", "cases"), ("alpha", "view", "current", "people", "beds"),
    ("beta", "signup", "cumulative", "people", "deaths"),
]
BUCKET = """CASE WHEN age = 'all' AND sex = 'all' THEN 'all' WHEN age = 'all' THEN 'sex:' || sex WHEN sex = 'all' THEN 'age:' || age ELSE 'age;sex:' || age || ';' || sex END"""
DAILY = f"""daily AS (SELECT provider, variable_name, measurement, unit, location_id, {BUCKET} AS bucket, dt, age, sex, SUM(CAST(round(value * 100) AS BIGINT)) / 100 AS value,
  MAX(source_url) AS source_url, MAX(source_name) AS source_name FROM fact GROUP BY ALL)"""


def daily_fact(spark, d):
    """One row per provider key and day, as providers publish."""
    keys = ["provider", "dt", "location", "location_id", "variable_name", "measurement", "unit", "age", "race", "ethnicity", "sex"]
    return B.fact(spark, d).groupBy(*keys).agg(
        B.cents("value").alias("value"), F.max("source_url").alias("source_url"), F.max("source_name").alias("source_name")
    )


@query("query_variables", f"""
WITH {DAILY}, m AS (SELECT * FROM daily JOIN {SPEC} USING (provider, variable_name, measurement, unit))
SELECT 'obs' AS kind, location_id, field AS variable, bucket, dt AS date, value, CAST(NULL AS VARCHAR) AS tag_type, CAST(NULL AS VARCHAR) AS content FROM m
UNION ALL SELECT 'tag', location_id, field, bucket, NULL, NULL, 'source', arg_max('{{"type":"Example","url":"' || source_url || '","name":"' || source_name || '"}}', dt)
  FROM m WHERE bucket = 'all' GROUP BY ALL""")
def _(spark, d):
    ds = P.query_variables(daily_fact(spark, d), FACT_SPEC, "Example")
    return flatten(ds)


@query("variable_coverage", f"""
SELECT provider, variable_name, measurement, unit, COUNT(*) AS n FROM fact WHERE provider IN ('alpha', 'beta') AND
 NOT EXISTS (SELECT 1 FROM {SPEC} WHERE v.provider = fact.provider AND v.variable_name = fact.variable_name AND v.measurement = fact.measurement)
GROUP BY 1, 2, 3, 4""")
def _(spark, d):
    return P.variable_coverage(B.fact(spark, d), FACT_SPEC)


@query("check_location_ids", """
SELECT location, f.location_id, g.location_id AS expected FROM (SELECT DISTINCT location, location_id FROM fact) f
LEFT JOIN geo g ON g.fips = lpad(CAST(location AS VARCHAR), 5, '0') WHERE COALESCE(g.location_id, 'iso1:us#fips:' || lpad(CAST(location AS VARCHAR), 5, '0')) <> f.location_id AND g.location_id IS NOT NULL
UNION ALL SELECT location, f.location_id, 'iso1:us#fips:' || lpad(CAST(location AS VARCHAR), 5, '0') FROM (SELECT DISTINCT location, location_id FROM fact) f
WHERE lpad(CAST(location AS VARCHAR), 5, '0') NOT IN (SELECT fips FROM geo)""")
def _(spark, d):
    return P.check_location_ids(B.fact(spark, d), B.geo(spark, d))


@query("assert_unique_keys", """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def _(spark, d):
    return O.rows_not_unique(B.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("static_per_key_unique", """
SELECT DISTINCT c_nationkey, n_name AS name FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def _(spark, d):
    named = B.table(spark, d, "customer").join(B.table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return O.static_per_key(named.withColumnRenamed("n_name", "name"), "c_nationkey", ["name"])
