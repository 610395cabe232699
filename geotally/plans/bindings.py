"""The given star-schema tables seen as regional time series, in Spark and as SQL.

Nations are counties, world regions are their states, users are small places whose parent is
a group of users. Money is summed in whole cents, so totals do not depend on summation order.
"""

from __future__ import annotations

import functools
import re

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from geotally.functions import regions as R
from geotally.model import POINT, SERIES, TAG, Dataset, series_window

# State that stands for each of the five world regions.
REGION_STATES = ["AL", "AK", "AZ", "AR", "CA"]
STATE_FIPS = {"AL": "01", "AK": "02", "AZ": "04", "AR": "05", "CA": "06"}

CTES = {
    "st": """SELECT r_regionkey, r_name, list_extract(['AL','AK','AZ','AR','CA'], r_regionkey + 1) AS state,
        list_extract(['01','02','04','05','06'], r_regionkey + 1) AS sfips FROM region""",
    "geo": """SELECT 'iso1:us#iso2:us-' || lower(state) || '#fips:' || sfips || lpad(CAST(n_nationkey + 1 AS VARCHAR), 3, '0') AS location_id,
        sfips || lpad(CAST(n_nationkey + 1 AS VARCHAR), 3, '0') AS fips, state, 'county' AS level, 'USA' AS country,
        n_name AS name, n_nationkey AS nationkey FROM nation JOIN st ON n_regionkey = r_regionkey
      UNION ALL SELECT 'iso1:us#iso2:us-' || lower(state), sfips, state, 'state', 'USA', r_name, NULL FROM st
      UNION ALL SELECT 'iso1:us', '0', NULL, 'country', 'USA', 'USA', NULL""",
    "parent": """SELECT c.location_id, s.location_id AS parent_id FROM geo c JOIN geo s ON c.state = s.state
        AND s.level = 'state' WHERE c.level = 'county'""",
    "od": """SELECT g.location_id, CAST(o_orderdate AS DATE) AS date, COUNT(*) AS n,
        SUM(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN geo g ON g.nationkey = c_nationkey GROUP BY 1, 2""",
    "obs": """SELECT location_id, 'n_orders' AS variable, 'all' AS bucket, date, CAST(n AS DOUBLE) AS value FROM od
      UNION ALL SELECT location_id, 'revenue', 'all', date, CAST(cents AS DOUBLE) / 100 FROM od""",
    "odb": """SELECT g.location_id, CAST(o_orderdate AS DATE) AS date,
        CASE WHEN GROUPING(c_mktsegment) = 1 THEN 'all' ELSE 'segment:' || c_mktsegment END AS bucket, COUNT(*) AS n,
        SUM(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN geo g ON g.nationkey = c_nationkey
        GROUP BY GROUPING SETS ((1, 2), (1, 2, c_mktsegment))""",
    "obsb": """SELECT location_id, 'n_orders' AS variable, bucket, date, CAST(n AS DOUBLE) AS value FROM odb
      UNION ALL SELECT location_id, 'revenue', bucket, date, CAST(cents AS DOUBLE) / 100 FROM odb""",
    "cum": """SELECT location_id, variable, bucket, date, SUM(value) OVER (PARTITION BY location_id, variable, bucket
        ORDER BY date ROWS UNBOUNDED PRECEDING) AS value FROM obs""",
    "evt": """SELECT 'iso1:us#user:' || user_id AS location_id, event_type AS variable, 'all' AS bucket,
        CAST(ts AS DATE) AS date, CAST(COUNT(*) AS DOUBLE) AS value FROM events GROUP BY 1, 2, 4""",
    "evp": """SELECT 'iso1:us#hsa:' || lpad(CAST(user_id % 10 AS VARCHAR), 3, '0') AS location_id, event_type AS variable,
        'all' AS bucket, CAST(ts AS DATE) AS date, CAST(COUNT(*) AS DOUBLE) AS value FROM events GROUP BY 1, 2, 4""",
    "evcum": """SELECT location_id, variable, bucket, date, SUM(value) OVER (PARTITION BY location_id, variable, bucket
        ORDER BY date ROWS UNBOUNDED PRECEDING) AS value FROM evp""",
    "evtcum": """SELECT location_id, variable, bucket, date, SUM(value) OVER (PARTITION BY location_id, variable, bucket
        ORDER BY date ROWS UNBOUNDED PRECEDING) AS value FROM evt""",
    "upop": """SELECT DISTINCT 'iso1:us#user:' || user_id AS location_id, CAST(1000 + user_id % 500 AS DOUBLE) AS population FROM events""",
    "uparent": """SELECT DISTINCT 'iso1:us#user:' || user_id AS location_id, 'iso1:us#hsa:' || lpad(CAST(user_id % 10 AS VARCHAR), 3, '0') AS parent_id FROM events""",
    "mw": """SELECT location_id, date, SUM(value) FILTER (variable = 'click') * 7.5 AS "caseDensity", SUM(value) FILTER (variable = 'click') * 52.5 AS "weeklyNewCasesPer100k",
        SUM(value) FILTER (variable = 'purchase') / 16 AS "testPositivityRatio", SUM(value) FILTER (variable = 'view') * 0.55 AS "infectionRate",
        SUM(value) FILTER (variable = 'view') * 0.125 AS "infectionRateCI90", SUM(value) FILTER (variable = 'signup') * 0.375 AS "icuCapacityRatio",
        SUM(value) FILTER (variable = 'error') * 0.25 AS "contactTracerCapacityRatio", SUM(value) FILTER (variable = 'signup') * 0.0625 AS "bedsWithCovidPatientsRatio",
        SUM(value) FILTER (variable = 'error') * 6.5 AS "weeklyCovidAdmissionsPer100k", SUM(value) FILTER (variable = 'purchase') * 0.125 AS "vaccinationsInitiatedRatio"
        FROM evt GROUP BY 1, 2""",
    "pop": """SELECT g.location_id, CAST(COUNT(*) AS DOUBLE) AS population,
        CAST(SUM(CAST(round(c_acctbal * 100) AS BIGINT)) AS DOUBLE) / 100 AS balance FROM customer
        JOIN geo g ON g.nationkey = c_nationkey GROUP BY 1""",
    "static": """SELECT location_id, 'population' AS attr, population AS num, CAST(NULL AS VARCHAR) AS str FROM pop
      UNION ALL SELECT location_id, 'balance', balance, NULL FROM pop
      UNION ALL SELECT location_id, 'name', NULL, name FROM geo WHERE level = 'county'""",
    "src": """SELECT o_orderstatus AS source, g.location_id, 'n_orders' AS variable, 'segment:' || c_mktsegment AS bucket,
        CAST(o_orderdate AS DATE) AS date, CAST(COUNT(*) AS DOUBLE) AS value FROM orders
        JOIN customer ON o_custkey = c_custkey JOIN geo g ON g.nationkey = c_nationkey GROUP BY 1, 2, 4, 5""",
    "srcall": """SELECT source, location_id, variable, 'all' AS bucket, date, SUM(value) AS value FROM src GROUP BY 1, 2, 3, 5""",
    "tagp": """SELECT DISTINCT location_id, variable, bucket, 'provenance' AS tag_type, 'src_' || source AS content FROM srcall
      UNION ALL SELECT DISTINCT location_id, variable, bucket, 'source_url', 'http://src/' || lower(source) FROM srcall""",
    "tags": """SELECT * FROM tagp UNION ALL SELECT DISTINCT location_id, variable, bucket, 'source' AS tag_type,
        '{"type":"' || source || '","url":"http://src/' || lower(source) || '","name":"Source ' || source || '"}' AS content FROM srcall""",
    "hsamap": """SELECT location_id, fips, lpad(CAST(nationkey % 7 AS VARCHAR), 3, '0') AS hsa,
        'Area ' || (nationkey % 7) AS hsa_name FROM geo WHERE level = 'county' AND nationkey % 9 <> 8""",
    "cbsamap": """SELECT location_id, 'iso1:us#cbsa:' || (10100 + 20 * (nationkey % 4)) AS parent_id
        FROM geo WHERE level = 'county' AND nationkey % 5 <> 4""",
    "fact": """SELECT CASE user_id % 3 WHEN 0 THEN 'alpha' WHEN 1 THEN 'beta' ELSE 'gamma' END AS provider,
        CAST(ts AS DATE) AS dt, CAST((user_id % 5 + 1) * 1000 + user_id % 97 AS INTEGER) AS location,
        'iso1:us#iso2:us-' || lower(list_extract(['AL','AK','AZ','AR','CA'], CAST(user_id % 5 + 1 AS INTEGER))) || '#fips:' ||
        lpad(CAST((user_id % 5 + 1) * 1000 + user_id % 97 AS VARCHAR), 5, '0') AS location_id, event_type AS variable_name,
        CASE WHEN value < 50 THEN 'cumulative' ELSE 'current' END AS measurement, 'people' AS unit,
        CASE WHEN k < 50 THEN 'all' ELSE (k // 10 * 10) || '-' || (k // 10 * 10 + 9) END AS age, 'all' AS race, 'all' AS ethnicity,
        CASE k % 4 WHEN 0 THEN 'female' WHEN 1 THEN 'male' ELSE 'all' END AS sex, value, 'http://p/' || (user_id % 3) AS source_url,
        'Provider ' || (user_id % 3) AS source_name, ts, user_id, event_id
        FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)""",
}
_DEPS = {n: {m for m in CTES if m != n and re.search(rf"\b(FROM|JOIN)\s+{m}\b", s)} for n, s in CTES.items()}


def expand(sql: str) -> str:
    """Prefix a statement with the shared CTEs it names, in dependency order."""
    need: list[str] = []

    def visit(n):
        for m in sorted(_DEPS[n]):
            visit(m)
        if n not in need:
            need.append(n)

    for n in CTES:
        if re.search(rf"\b(FROM|JOIN|,)\s*{n}\b(?!\s*\()", sql) and not re.search(rf"\b{n}\s+AS\s*\(", sql):
            visit(n)
    head = ", ".join(f"{n} AS ({CTES[n]})" for n in need)
    body = sql.strip()
    if not head:
        return body
    if re.match(r"WITH\s+RECURSIVE\b", body, re.I):
        return f"WITH RECURSIVE {head}, {body[len('WITH RECURSIVE'):]}"
    if re.match(r"WITH\b", body, re.I):
        return f"WITH {head}, {body[4:]}"
    return f"WITH {head} {body}"


_SCHEMAS: dict = {}
_PLANS: dict = {}


def shared(fn):
    """Build each lazy plan once per session and folder. Nothing of the data is kept."""

    @functools.wraps(fn)
    def build(spark, d, *args):
        if _PLANS.get("session") is not spark:
            _PLANS.clear()
            _PLANS["session"] = spark
        key = (fn.__name__, d, *args)
        if key not in _PLANS:
            _PLANS[key] = fn(spark, d, *args)
        return _PLANS[key]

    return build


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    """Scan of a given table. Its schema is read from the footer once and then passed along."""
    path = f"{d}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def cents(col: str):
    return F.sum(F.round(F.col(col) * 100).cast("bigint")).cast("double") / 100


@shared
def states(spark, d):
    code = F.element_at(F.lit(REGION_STATES), F.col("r_regionkey") + 1)
    return table(spark, d, "region").select(
        "r_regionkey", "r_name", code.alias("state"), R.state_fips_of_code(code).alias("sfips")
    )


@shared
def geo(spark, d):
    """location_id, fips, state, level, country, name, nationkey: 25 counties, 5 states, 1 country."""
    st = states(spark, d)
    fips = F.concat("sfips", F.lpad((F.col("n_nationkey") + 1).cast("string"), 3, "0"))
    county = table(spark, d, "nation").join(st, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.concat(R.state_location_id(F.col("state")), F.lit("#fips:"), fips).alias("location_id"),
        fips.alias("fips"), "state", F.lit("county").alias("level"), F.lit("USA").alias("country"),
        F.col("n_name").alias("name"), F.col("n_nationkey").alias("nationkey"),
    )
    state = st.select(
        R.state_location_id(F.col("state")).alias("location_id"), F.col("sfips").alias("fips"), "state",
        F.lit("state").alias("level"), F.lit("USA").alias("country"), F.col("r_name").alias("name"),
        F.lit(None).cast("int").alias("nationkey"),
    )
    top = spark.range(1).select(
        F.lit("iso1:us").alias("location_id"), F.lit("0").alias("fips"), F.lit(None).cast("string").alias("state"),
        F.lit("country").alias("level"), F.lit("USA").alias("country"), F.lit("USA").alias("name"),
        F.lit(None).cast("int").alias("nationkey"),
    )
    return county.unionByName(state).unionByName(top)


@shared
def counties(spark, d):
    return geo(spark, d).filter("level = 'county'")


@shared
def parent(spark, d):
    return counties(spark, d).select(
        "location_id", R.parent_state_location_id(F.col("location_id")).alias("parent_id")
    )


@shared
def placed_orders(spark, d):
    """Orders with the location of their customer, only the columns in use."""
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    g = counties(spark, d).select("location_id", "nationkey")
    o = table(spark, d, "orders").select(
        "o_custkey", "o_orderstatus", "o_totalprice", F.to_date("o_orderdate").alias("date")
    )
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(g, F.col("nationkey") == F.col("c_nationkey"))


def _two_variables(df):
    return df.unpivot(["location_id", "bucket", "date"], ["n_orders", "revenue"], "variable", "value").select(*POINT, "value")


@shared
def obs(spark, d):
    return _two_variables(
        placed_orders(spark, d).groupBy("location_id", "date")
        .agg(F.count("*").cast("double").alias("n_orders"), cents("o_totalprice").alias("revenue"))
        .withColumn("bucket", F.lit("all"))
    )


@shared
def obsb(spark, d):
    """Both variables for bucket 'all' and per market segment, from one aggregation."""
    p = placed_orders(spark, d)
    keys = ["location_id", "date"]
    out = p.groupingSets([keys, keys + ["c_mktsegment"]], *keys, "c_mktsegment").agg(
        F.grouping("c_mktsegment").alias("g"), F.count("*").cast("double").alias("n_orders"),
        cents("o_totalprice").alias("revenue"),
    )
    return _two_variables(
        out.withColumn("bucket", F.when(F.col("g") == 1, "all").otherwise(F.concat(F.lit("segment:"), "c_mktsegment")))
    )


def running(df):
    w = series_window().rowsBetween(W.unboundedPreceding, 0)
    return df.select(*POINT, F.sum("value").over(w).alias("value"))


@shared
def cum(spark, d):
    return running(obs(spark, d))


def _event_counts(spark, d, location):
    return (
        table(spark, d, "events")
        .groupBy(location.alias("location_id"), F.col("event_type").alias("variable"), F.to_date("ts").alias("date"))
        .agg(F.count("*").cast("double").alias("value")).withColumn("bucket", F.lit("all")).select(*POINT, "value")
    )


@shared
def evt(spark, d):
    return _event_counts(spark, d, F.concat(F.lit("iso1:us#user:"), "user_id"))


@shared
def evp(spark, d):
    return _event_counts(spark, d, R.hsa_location_id(R.hsa_code(F.col("user_id") % 10)))


@shared
def evcum(spark, d):
    return running(evp(spark, d))


@shared
def evtcum(spark, d):
    return running(evt(spark, d))


@shared
def users(spark, d):
    u = F.col("user_id")
    return table(spark, d, "events").select("user_id").distinct().select(
        F.concat(F.lit("iso1:us#user:"), u).alias("location_id"), (1000 + u % 500).cast("double").alias("population"),
        R.hsa_location_id(R.hsa_code(u % 10)).alias("parent_id"),
    )


def upop(spark, d):
    return users(spark, d).select("location_id", "population")


def uparent(spark, d):
    return users(spark, d).select("location_id", "parent_id")


def ustatic(spark, d):
    return users(spark, d).select(
        "location_id", F.lit("population").alias("attr"), F.col("population").alias("num"), F.lit(None).cast("string").alias("str")
    )


@shared
def mw(spark, d):
    """A table of daily metrics per user; days without an event of the type hold NULL."""
    of = lambda t: F.sum(F.when(F.col("variable") == t, F.col("value")))
    factors = {
        "caseDensity": ("click", 7.5), "weeklyNewCasesPer100k": ("click", 52.5), "testPositivityRatio": ("purchase", 0.0625),
        "infectionRate": ("view", 0.55), "infectionRateCI90": ("view", 0.125), "icuCapacityRatio": ("signup", 0.375),
        "contactTracerCapacityRatio": ("error", 0.25), "bedsWithCovidPatientsRatio": ("signup", 0.0625),
        "weeklyCovidAdmissionsPer100k": ("error", 6.5), "vaccinationsInitiatedRatio": ("purchase", 0.125),
    }
    return evt(spark, d).groupBy("location_id", "date").agg(*[(of(t) * f).alias(m) for m, (t, f) in factors.items()])


@shared
def pop(spark, d):
    c = table(spark, d, "customer").select("c_nationkey", "c_acctbal")
    return (
        c.join(counties(spark, d).select("location_id", "nationkey"), F.col("c_nationkey") == F.col("nationkey"))
        .groupBy("location_id").agg(F.count("*").cast("double").alias("population"), cents("c_acctbal").alias("balance"))
    )


@shared
def static(spark, d):
    null = F.lit(None).cast("string").alias("str")
    nums = pop(spark, d).unpivot(["location_id"], ["population", "balance"], "attr", "num").withColumn("str", null)
    names = counties(spark, d).select(
        "location_id", F.lit("name").alias("attr"), F.lit(None).cast("double").alias("num"), F.col("name").alias("str")
    )
    return nums.unionByName(names)


@shared
def src(spark, d):
    """Three overlapping providers: one per order status."""
    return (
        placed_orders(spark, d)
        .groupBy(F.col("o_orderstatus").alias("source"), "location_id",
                 F.concat(F.lit("segment:"), "c_mktsegment").alias("bucket"), "date")
        .agg(F.count("*").cast("double").alias("value")).withColumn("variable", F.lit("n_orders"))
        .select("source", *POINT, "value")
    )


@shared
def srcall(spark, d):
    return (
        placed_orders(spark, d).groupBy(F.col("o_orderstatus").alias("source"), "location_id", "date")
        .agg(F.count("*").cast("double").alias("value"))
        .withColumns({"variable": F.lit("n_orders"), "bucket": F.lit("all")}).select("source", *POINT, "value")
    )


@shared
def source_keys(spark, d):
    """Series and the sources that report them, without the daily aggregation."""
    return placed_orders(spark, d).select(
        F.col("o_orderstatus").alias("source"), "location_id", F.lit("n_orders").alias("variable"), F.lit("all").alias("bucket")
    ).distinct()


@shared
def tags(spark, d, types=("provenance", "source_url", "source")):
    """Provenance, url and source tags of every series and source, exploded from one pass."""
    from geotally.functions import tagtext

    url = F.concat(F.lit("http://src/"), F.lower("source"))
    content = {
        "provenance": F.concat(F.lit("src_"), "source"), "source_url": url,
        "source": tagtext.source_content(F.col("source"), url, F.concat(F.lit("Source "), "source")),
    }
    rows = F.array(*[F.struct(F.lit(t).alias("tag_type"), content[t].alias("content")) for t in types])
    return source_keys(spark, d).select(*SERIES, F.inline(rows)).select(*TAG)


def tagp(spark, d):
    return tags(spark, d, ("provenance", "source_url"))


def dataset(spark, d, observations=obs) -> Dataset:
    return Dataset(observations(spark, d), static(spark, d), tags(spark, d))


@shared
def hsamap(spark, d):
    k = F.col("nationkey")
    return counties(spark, d).filter(k % 9 != 8).select(
        "location_id", "fips", R.hsa_code(k % 7).alias("hsa"), F.concat(F.lit("Area "), (k % 7).cast("string")).alias("hsa_name")
    )


@shared
def cbsamap(spark, d):
    k = F.col("nationkey")
    return counties(spark, d).filter(k % 5 != 4).select(
        "location_id", R.cbsa_location_id((10100 + 20 * (k % 4)).cast("string")).alias("parent_id")
    )


@shared
def fact(spark, d):
    """Events in the shape of a provider fact table."""
    u = F.col("user_id")
    k = F.get_json_object("props", "$.k").cast("int")
    decade = F.floor(k / 10) * 10
    location = ((u % 5 + 1) * 1000 + u % 97).cast("int")
    state = F.element_at(F.lit(REGION_STATES), (u % 5 + 1).cast("int"))
    return table(spark, d, "events").select(
        F.when(u % 3 == 0, "alpha").when(u % 3 == 1, "beta").otherwise("gamma").alias("provider"),
        F.to_date("ts").alias("dt"), location.alias("location"),
        F.concat(R.state_location_id(state), F.lit("#fips:"), R.fips_from_int(location)).alias("location_id"),
        F.col("event_type").alias("variable_name"),
        F.when(F.col("value") < 50, "cumulative").otherwise("current").alias("measurement"), F.lit("people").alias("unit"),
        F.when(k < 50, "all").otherwise(F.concat(decade.cast("string"), F.lit("-"), (decade + 9).cast("string"))).alias("age"),
        F.lit("all").alias("race"), F.lit("all").alias("ethnicity"),
        F.when(k % 4 == 0, "female").when(k % 4 == 1, "male").otherwise("all").alias("sex"), "value",
        F.concat(F.lit("http://p/"), (u % 3).cast("string")).alias("source_url"),
        F.concat(F.lit("Provider "), (u % 3).cast("string")).alias("source_name"), "ts", "user_id", "event_id",
    )
