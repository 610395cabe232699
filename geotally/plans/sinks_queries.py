"""Queries for sinks: each writes to shared storage and reads back what it wrote."""

from pyspark.sql import functions as F

from geotally.model import POINT, SERIES, TAG, Dataset, flatten, work_dir
from geotally.plans import bindings as B
from geotally.plans.catalog import query
from geotally.plans.filters_queries import flat_sql
from geotally.plans.layout_queries import columns_as_rows
from geotally.plans.measures_queries import actual_wide
from geotally.plans.rt_queries import ALL, daily
from geotally.operators import rt as RT
from geotally.sources import readers as RD, versions as VS, writers as WR

EV_TYPES = ["click", "error", "purchase", "signup", "view"]


def event_dataset(spark, d):
    """Events per user with two or, for views, three provenance tags per series."""
    obs = B.evt(spark, d)
    s = obs.select(*SERIES).distinct()
    one = lambda p: F.struct(F.lit("provenance").alias("tag_type"), F.concat(F.lit(p), "variable").alias("content"))
    rows = F.when(F.col("variable") == "view", F.array(one("a_"), one("b_"), one("c_"))).otherwise(F.array(one("a_"), one("b_")))
    return Dataset(obs, B.ustatic(spark, d), s.select(*SERIES, F.inline(rows)).select(*TAG))


#: (prefix, number) of the tags of a series
NTAGS = "(SELECT DISTINCT location_id, variable, bucket, p, n FROM evt, (VALUES ('a_', 0), ('b_', 1), ('c_', 2)) AS x(p, n) WHERE p <> 'c_' OR variable = 'view')"


@query("sink_common_csv", f"""
SELECT location_id, CAST(date AS VARCHAR) AS date, variable AS name, value, CAST(NULL AS VARCHAR) AS text FROM evt
UNION ALL SELECT location_id, NULL, 'population', population, NULL FROM upop UNION ALL SELECT location_id, NULL, variable, NULL, p || variable FROM {NTAGS}""")
def _(spark, d):
    path = work_dir(spark, "common-csv")
    WR.common_csv(event_dataset(spark, d), path)
    cells = columns_as_rows(spark.read.csv(path, header=True), ["location_id", "date"])
    sources = spark.read.csv(f"{path}-provenance", header=True)
    return cells.select("location_id", "date", "name", F.col("cell").cast("double").alias("value"), F.lit(None).cast("string").alias("text")).unionByName(
        sources.select("location_id", F.lit(None).cast("string").alias("date"), F.col("variable").alias("name"), F.lit(None).cast("double").alias("value"), F.col("provenance").alias("text")))


@query("sink_wide_dates", f"""
SELECT location_id, variable, bucket, CAST(date AS VARCHAR) AS name, value, CAST(NULL AS VARCHAR) AS tag FROM evt
UNION ALL SELECT location_id, variable, bucket, 'provenance' || CASE n WHEN 0 THEN '' ELSE '-' || n END, NULL, p || variable FROM {NTAGS}""")
def _(spark, d):
    path = work_dir(spark, "wide-dates")
    WR.write_wide_dates(event_dataset(spark, d), path)
    cells = columns_as_rows(spark.read.csv(path, header=True), SERIES)
    tag = F.col("name").startswith("provenance")
    return cells.select(*SERIES, "name", F.when(~tag, F.col("cell").cast("double")).alias("value"), F.when(tag, F.col("cell")).alias("tag"))


@query("sink_snapshot", flat_sql("SELECT * FROM obsb"))
def _(spark, d):
    path = work_dir(spark, "snapshot")
    WR.snapshot(B.dataset(spark, d, B.obsb), path)
    return flatten(Dataset(*[spark.read.parquet(f"{path}/{t}") for t in ("obs", "static", "tags")]))


@query("sink_with_manifest", "SELECT 'orders' AS dataset_type, true AS has_time, (SELECT COUNT(*) FROM obs) AS points, (SELECT COUNT(*) FROM tags) AS tags")
def _(spark, d):
    path = work_dir(spark, "manifest")
    WR.with_manifest(B.dataset(spark, d), path, "orders")
    back = RD.manifest(spark, f"{path}/manifest", "orders")
    m = spark.read.json(f"{path}/manifest", schema=RD.MANIFEST_SCHEMA)
    return m.select("dataset_type", F.col("saved_at").isNotNull().alias("has_time"), back.obs.agg(F.count("*")).scalar().alias("points"),
                    back.tags.agg(F.count("*")).scalar().alias("tags"))


@query("versioned_update", """
SELECT location_id, variable, bucket, date, CASE WHEN variable = 'revenue' THEN value / 100 ELSE value END AS value, 'revenue' AS written FROM obsb""")
def _(spark, d):
    """A dataset saved, then saved again with one variable changed; the second version writes that variable alone."""
    root, ds = work_dir(spark, "versions"), B.dataset(spark, d, B.obsb)
    VS.save(ds, root)
    scaled = F.when(F.col("variable") == "revenue", F.col("value") / 100).otherwise(F.col("value"))
    written = VS.save(ds.with_obs(ds.obs.withColumn("value", scaled)), root)
    return VS.load(spark, root).obs.withColumn("written", F.lit(",".join(written["obs"] + written["static"] + written["tags"])))


def regions(spark, d):
    of = lambda name: F.sum(F.when(F.col("variable") == name, F.col("value")))
    # no order in the first year leaves no number, which the file must not have as text
    early = F.sum(F.when((F.col("variable") == "n_orders") & (F.col("date") < "1993-01-01"), F.col("value")))
    totals = B.obs(spark, d).groupBy("location_id").agg(
        of("n_orders").alias("orders"), (F.sum(F.when(F.col("variable") == "revenue", F.round(F.col("value") * 100).cast("long"))) / 100).alias("revenue"), F.coalesce(early, F.lit(float("nan"))).alias("early"), F.max("date").alias("last"))
    return B.counties(spark, d).select("location_id", "fips", "state", "level", "country").join(totals, "location_id")


@query("sink_region_json", """
SELECT o.location_id, fips, state, level, SUM(value) FILTER (variable = 'n_orders') AS orders, SUM(CAST(round(value * 100) AS BIGINT)) FILTER (variable = 'revenue') / 100 AS revenue,
 CAST(SUM(value) FILTER (variable = 'n_orders' AND date < DATE '1993-01-01') AS VARCHAR) AS early, CAST(MAX(date) AS VARCHAR) AS last, state AS folder FROM obs o JOIN geo USING (location_id) WHERE level = 'county' GROUP BY 1, 2, 3, 4""")
def _(spark, d):
    path = work_dir(spark, "region-json")
    WR.region_json(regions(spark, d), path)
    schema = "location_id string, fips string, state string, level string, orders double, revenue double, early string, last string, _level string, _state string"
    return spark.read.schema(schema).json(path).select("location_id", "fips", "state", "level", "orders", "revenue", "early", "last", F.col("_state").alias("folder"))


@query("output_layout", """
SELECT g.location_id, CASE level WHEN 'county' THEN 'county/' || fips ELSE CASE level WHEN 'state' THEN 'state/' || state ELSE 'country/' || country END END || '.json' AS single,
 CASE level WHEN 'county' THEN 'counties' WHEN 'state' THEN 'states' ELSE 'countries' END || '.timeseries.csv' AS bulk, level || '/' || state || '.json' AS per_state, COALESCE(c.n, 0) AS n
FROM geo g LEFT JOIN (SELECT location_id, COUNT(*) AS n FROM obs GROUP BY 1) c USING (location_id)""")
def _(spark, d):
    c = F.col
    g = B.geo(spark, d).join(B.obs(spark, d).groupBy("location_id").agg(F.count("*").alias("n")), "location_id", "left")
    return g.select(
        "location_id", WR.output_file(c("level"), c("state"), c("fips"), c("country")).alias("single"),
        WR.bulk_file(c("level"), "csv", True).alias("bulk"), WR.bulk_file(c("level"), "json", state=c("state")).alias("per_state"),
        F.coalesce("n", F.lit(0)).alias("n"))


@query("sink_nested_csv", """
SELECT location_id, CAST(date AS VARCHAR) AS date, SUM(value) FILTER (variable = 'click') AS "actuals.cases", SUM(value) FILTER (variable = 'signup') AS "actuals.hospitalBeds.capacity", CAST(NULL AS VARCHAR) AS unused1 FROM evt GROUP BY 1, 2""")
def _(spark, d):
    from geotally.operators import publish as PB

    path = work_dir(spark, "nested-csv")
    order = ["location_id", "date", "actuals.cases", "actuals.hospitalBeds.capacity", "unused1"]
    WR.nested_csv(PB.actuals_rows(actual_wide(spark, d)), path, order)
    schema = "location_id string, date string, `actuals.cases` double, `actuals.hospitalBeds.capacity` double, unused1 string"
    return spark.read.schema(schema).csv(path, header=True)


@query("sink_rt_metric", f"""WITH RECURSIVE {ALL} SELECT location_id, date, round(composite, 6) AS rt, round(ci95, 6) AS ci95 FROM rtc""")
def _(spark, d):
    path = work_dir(spark, "rt")
    rt = RT.rt_all_regions(daily(spark, d))[0]
    WR.rt_metric(rt.select("location_id", "date", F.round("Rt_MAP_composite", 6).alias("rt"), F.round("Rt_ci95_composite", 6).alias("ci95")), path)
    return spark.read.parquet(path)
