"""Queries that run the whole chain on the given tables."""

import datetime

from pyspark.sql import functions as F

from geotally.model import POINT, Dataset, flatten, work_dir
from geotally.operators import combine as C, layout as LY, levels as LV, quality as Q, rt as RT
from geotally.plans import bindings as B, flow as FL
from geotally.plans.catalog import query
from geotally.plans.filters_queries import FLAT
from geotally.plans.joins_queries import DEFINITION, MISSING, PRIO, STATICS, source_tags, sparse_sources, static_sources
from geotally.plans import measures_queries as MS
from geotally.plans.measures_queries import CD, LR, OVERALL, RT as RISK_RT, TC, TOTAL, TP, TT, carry_sql
from geotally.plans.rollups_queries import rounded
from geotally.plans.rt_queries import ALL
from geotally.plans.windows_queries import P, PK, R, spread_ctes, zscore_sql

D = datetime.date

TAG_COLS = "location_id, variable, bucket"
RW = R(5, "INTERVAL 1 DAY PRECEDING")

# The same run as SQL, step by step: merge, running total, rule, future, ratio tail, stalled tail
# with the calendar of the state, incidents, outliers. Tables f1..f6 are the observations after
# each step, t0..t5 the tags it adds.
FLOW = f"""sx AS MATERIALIZED ({MISSING}), pr AS (SELECT * FROM {PRIO}), rk AS (SELECT sx.*, split_part(bucket, ':', 1) AS distribution, pr.prio FROM sx JOIN pr USING (variable, source)),
 wn AS (SELECT location_id, variable, distribution, MIN(prio) AS prio FROM rk GROUP BY 1, 2, 3),
 mo AS MATERIALIZED (SELECT {PK}, value FROM rk JOIN wn USING (location_id, variable, distribution, prio)),
 t0 AS (SELECT DISTINCT a.location_id, a.variable, 'all' AS bucket, 'provenance' AS tag_type, 'src_' || a.source AS content FROM srcall a JOIN pr USING (variable, source) JOIN wn ON wn.location_id = a.location_id AND wn.variable = a.variable AND wn.distribution = 'all' AND wn.prio = pr.prio),
 {STATICS}, sprio AS (SELECT * FROM (VALUES ('population', 'orders', 0), ('population', 'customers', 1), ('balance', 'customers', 0)) AS v(attr, source, prio)),
 mst AS (SELECT location_id, attr, arg_min(num, prio) AS num FROM sp JOIN sprio USING (attr, source) GROUP BY 1, 2),
 m0 AS MATERIALIZED (SELECT * FROM mo UNION ALL SELECT location_id, 'total_orders', 'all', date, SUM(value) OVER ({P} ROWS UNBOUNDED PRECEDING) FROM mo WHERE bucket = 'all'),
 rule AS MATERIALIZED (SELECT * FROM m0 WHERE bucket = 'all' AND variable = 'n_orders' AND location_id LIKE 'iso1:us#iso2:us-al%' AND date BETWEEN DATE '1996-01-01' AND DATE '1996-03-01'),
 f1 AS MATERIALIZED (SELECT * FROM m0 ANTI JOIN rule USING ({PK})),
 t1 AS (SELECT DISTINCT {TAG_COLS}, 'known_issue' AS tag_type, '{{"public_note":"late","date":"1996-01-01"}}' AS content FROM rule),
 f2 AS MATERIALIZED (SELECT * FROM f1 WHERE date <= DATE '2001-01-01'),
 t2 AS (SELECT DISTINCT {TAG_COLS}, 'drop_future_observation' AS tag_type, '{{"after":"2001-01-01"}}' AS content FROM f1 WHERE date > DATE '2001-01-01'),
 pend AS (SELECT parent_id, MAX(date) AS hi FROM f2 JOIN parent USING (location_id) GROUP BY 1),
 rec AS (SELECT {PK}, value FROM f2 JOIN parent USING (location_id) JOIN pend USING (parent_id) WHERE variable = 'n_orders' AND date > hi - 10), {spread_ctes('rec', name='rsp')},
 rdf AS (SELECT {PK}, CASE WHEN LAG(date) OVER ({P}) = date - 1 THEN abs(value - LAG(value) OVER ({P})) END AS diff FROM f2 WHERE variable = 'n_orders'),
 rz AS (SELECT {PK}, raw, value AS x, AVG(value) OVER ({RW}) AS av, MIN(value) OVER ({RW}) AS mn, MAX(value) OVER ({RW}) AS mx, stddev_pop(value) OVER ({RW}) AS sd, COUNT(value) OVER ({RW}) AS n FROM rsp),
 ry AS (SELECT *, CASE WHEN mn = mx THEN mn ELSE av END AS m, CASE WHEN mn = mx THEN 0 ELSE sd END AS s FROM rz),
 rl AS (SELECT *, MAX(date) FILTER (n >= 3 AND (s > 0 OR x <> m)) OVER (PARTITION BY {TAG_COLS}) AS last_d FROM ry),
 hit AS MATERIALIZED (SELECT {PK}, raw FROM rl JOIN rdf USING ({PK}) WHERE date = last_d AND n >= 3 AND abs(x - m) > 10 * s AND diff > 0.015),
 f3 AS MATERIALIZED (SELECT * FROM f2 ANTI JOIN hit USING ({PK})),
 t3 AS (SELECT {TAG_COLS}, 'zscore_outlier' AS tag_type, '{{"date": "' || date || '", "original_observation": ' || raw || '}}' AS content FROM hit),
 cal AS (SELECT parent_id, MIN(date) AS lo, MAX(date) AS hi FROM f3 JOIN parent USING (location_id) GROUP BY 1),
 ta AS (SELECT f3.*, hi, hi - lo + 1 AS n_days, hi - date + 1 AS pos, CASE WHEN LAG(date) OVER ({P}) = date - 1 THEN value - LAG(value) OVER ({P}) END AS diff FROM f3 JOIN parent USING (location_id) JOIN cal USING (parent_id) WHERE variable = 'total_orders'),
 tm AS (SELECT *, AVG(diff) FILTER (pos BETWEEN 15 AND 28) OVER (PARTITION BY {TAG_COLS}) AS mean FROM ta),
 ts AS (SELECT *, MIN(pos) FILTER (pos <= 14 AND diff >= floor(mean / 100)) OVER (PARTITION BY {TAG_COLS}) AS stop FROM tm),
 tu AS (SELECT *, COUNT(*) FILTER (pos <= 14 AND diff IS NOT NULL AND pos < COALESCE(stop, 15)) OVER (PARTITION BY {TAG_COLS}) AS under, COALESCE(stop, 15) - 1 AS cut FROM ts),
 tc AS (SELECT *, n_days >= 28 AND mean IS NOT NULL AND under > 0 AS truncated FROM tu),
 f4 AS MATERIALIZED (SELECT {PK}, value FROM tc WHERE NOT (truncated AND pos <= cut) UNION ALL SELECT * FROM f3 WHERE variable <> 'total_orders'),
 t4 AS (SELECT {TAG_COLS}, CASE WHEN any_value(under) < 8 THEN 'cumulative_tail_truncated' ELSE 'cumulative_long_tail_truncated' END AS tag_type,
   '{{"date": "' || (any_value(hi) - CAST(any_value(cut) AS INTEGER)) || '", "original_observation": ' || COALESCE(CAST(MAX(value) FILTER (pos = cut) AS VARCHAR), 'NaN') || '}}' AS content FROM tc WHERE truncated GROUP BY 1, 2, 3),
 inc AS MATERIALIZED (SELECT location_id, 'new_orders' AS variable, bucket, date, CASE WHEN diff = -1 THEN 0 ELSE diff END AS value FROM (SELECT *, CASE WHEN LAG(date) OVER ({P}) = date - 1 THEN value - LAG(value) OVER ({P}) END AS diff FROM f4 WHERE variable = 'total_orders') WHERE diff >= 0 OR diff = -1),
 {zscore_sql('inc')}, zo AS MATERIALIZED (SELECT {PK}, raw, COALESCE(abs(x - mean) > 8 * std, false) AND raw > 30 AS outlier FROM z),
 f6 AS MATERIALIZED (SELECT * FROM f4 UNION ALL SELECT {PK}, raw FROM zo WHERE NOT outlier),
 t5 AS (SELECT {TAG_COLS}, 'zscore_outlier' AS tag_type, '{{"date": "' || date || '", "original_observation": ' || raw || '}}' AS content FROM zo WHERE outlier)"""

TAGS = " UNION ALL ".join(f"SELECT * FROM t{i}" for i in range(6))


def merged(spark, d):
    return FL.merge(
        sparse_sources(spark, d), source_tags(spark, d), static_sources(spark, d).withColumn("str", F.lit(None).cast("string")), DEFINITION,
        {"population": ["customers", "orders"], "balance": ["customers"]})


def config():
    return FL.Config(
        as_of=D(2001, 1, 1), rules=[Q.Rule("state = 'AL'", ["n_orders"], True, "late", start=D(1996, 1, 1), end=D(1996, 3, 1))],
        cumulative=["total_orders"], zero_fields=["n_orders"], ratio="n_orders", incidents={"total_orders": "new_orders"}, weekly={},
        estimate=None, outliers={"new_orders": None}, coverage=0.5)


def cumulated(spark, d):
    """The merged orders with their running total as a second variable."""
    ds = merged(spark, d)
    total = B.running(ds.obs.filter("bucket = 'all'")).withColumn("variable", F.lit("total_orders"))
    return ds.with_obs(ds.obs.unionByName(total))


@query("merge_clean_flow", f"""
WITH {FLOW}, o AS (SELECT * FROM f6), s AS (SELECT location_id, attr, num, CAST(NULL AS VARCHAR) AS str FROM mst), t AS ({TAGS}) {FLAT}""")
def _(spark, d):
    out, _ = FL.clean(cumulated(spark, d), B.geo(spark, d), B.parent(spark, d), None, config())
    return flatten(out)


@query("clean_touched_flow", f"""
WITH {FLOW}, tk AS (SELECT DISTINCT {TAG_COLS} FROM rule), o AS (SELECT m0.* FROM m0 SEMI JOIN tk USING ({TAG_COLS})), s AS (SELECT location_id, attr, num, CAST(NULL AS VARCHAR) AS str FROM mst WHERE false),
 t AS (SELECT t0.* FROM t0 SEMI JOIN tk USING ({TAG_COLS}) UNION ALL SELECT * FROM t1) {FLAT}""")
def _(spark, d):
    _, touched = FL.by_rules(cumulated(spark, d), B.geo(spark, d), config())
    return flatten(touched)


@query("update_flow", f"""
WITH {FLOW}, hs AS (SELECT m.location_id, 'n_orders_hsa' AS variable, 'all' AS bucket, h.date, h.value FROM (SELECT hsa, date, SUM(value) AS value FROM f6 JOIN hsamap USING (location_id) WHERE variable = 'n_orders' AND bucket = 'all' GROUP BY 1, 2) h JOIN hsamap m USING (hsa)),
 f7 AS MATERIALIZED (SELECT * FROM f6 UNION ALL SELECT * FROM hs), wgt AS (SELECT location_id, num AS w FROM mst WHERE attr = 'population'),
 cw AS (SELECT m.location_id, m.parent_id, w, SUM(w) OVER (PARTITION BY m.parent_id) AS tot FROM cbsamap m LEFT JOIN wgt USING (location_id)), uw AS (SELECT g.location_id, w, SUM(w) OVER () AS tot FROM geo g LEFT JOIN wgt USING (location_id) WHERE level = 'county')
SELECT {PK}, round(value, 6) AS value FROM f7
UNION ALL SELECT parent_id, variable, 'all', date, round(SUM(value), 6) FROM f7 JOIN cw USING (location_id) WHERE bucket = 'all' GROUP BY 1, 2, 4 HAVING SUM(w) / MAX(tot) >= 0.5
UNION ALL SELECT 'iso1:us', variable, 'all', date, round(SUM(value), 6) FROM f7 JOIN uw USING (location_id) WHERE bucket = 'all' GROUP BY 2, 4 HAVING SUM(w) / MAX(tot) >= 0.5""")
def _(spark, d):
    out, _ = FL.clean(cumulated(spark, d), B.geo(spark, d), B.parent(spark, d), None, config())
    all_ = FL.roll_up(out, B.hsamap(spark, d), B.cbsamap(spark, d), B.counties(spark, d), config(), hsa_fields={"n_orders": "n_orders_hsa"})
    return rounded(all_.obs)


METRICS = f"""{ALL}, {spread_ctes('gd')}, gp AS (SELECT parent_id AS location_id, SUM(population) AS population FROM upop JOIN uparent USING (location_id) GROUP BY 1),
 den AS (SELECT x.location_id, x.date, AVG(x.value) OVER (PARTITION BY x.location_id ORDER BY x.date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) / (population / 100000) AS v FROM spread x JOIN gp USING (location_id)),
 mt AS MATERIALIZED (SELECT location_id, date, round_even(v, 1) AS "caseDensity", round_even(v * 7, 1) AS "weeklyNewCasesPer100k", CAST(NULL AS DOUBLE) AS "testPositivityRatio", round_even(composite, 2) AS "infectionRate", round_even(ci95 - composite, 2) AS "infectionRateCI90" FROM den LEFT JOIN rtc USING (location_id, date)),
 late AS (SELECT location_id, date, "caseDensity", "testPositivityRatio", FIRST_VALUE("infectionRate") OVER ({LR(7, 'INTERVAL 7 DAYS PRECEDING')}) AS "infectionRate" FROM mt),
 rc AS (SELECT location_id, date, {carry_sql('caseDensity', 'testPositivityRatio', 'infectionRate')} FROM late), rv AS (SELECT location_id, date, {CD} AS cd, {TP} AS tp, {RISK_RT} AS rt FROM rc),
 tr AS (SELECT location_id, date, {carry_sql('caseDensity', 'testPositivityRatio')} FROM mt), tl AS (SELECT location_id, date, {TC} AS a, {TT} AS b FROM tr)"""


@query("metrics_flow", f"""
WITH RECURSIVE {METRICS} SELECT mt.*, {OVERALL} AS overall, cd AS "caseDensityLevel", {TOTAL} AS "cdcTransmissionLevel" FROM mt JOIN rv USING (location_id, date) JOIN tl USING (location_id, date)""")
def _(spark, d):
    """Events per group to Rt, metrics, risk and transmission levels, one row per day."""
    new = B.evp(spark, d).groupBy("location_id", "date").agg(F.sum("value").alias("value")).select(
        "location_id", F.lit("new_cases").alias("variable"), F.lit("all").alias("bucket"), "date", "value")
    pop = B.users(spark, d).groupBy(F.col("parent_id").alias("location_id")).agg(F.sum("population").alias("num")).select(
        "location_id", F.lit("population").alias("attr"), "num", F.lit(None).cast("string").alias("str"))
    ds = Dataset(new, pop, B.tags(spark, d).limit(0))
    rt, _ = RT.rt_all_regions(new)
    names = ["caseDensity", "weeklyNewCasesPer100k", "testPositivityRatio", "infectionRate", "infectionRateCI90"]
    m = FL.materialize(FL.metrics(ds, rt=rt).select("location_id", "date", *names), "metrics")
    return m.join(LV.risk_timeseries(m).withColumnRenamed("caseDensity", "caseDensityLevel"), ["location_id", "date"]).join(
        LV.transmission_timeseries(m), ["location_id", "date"])


@query("publish_flow", f"""
WITH {MS.SUMMARY}, {MS.WIDE} SELECT 'summary_json' AS kind, 'places.json' AS file, location_id, cases AS value, 1 AS n FROM upop JOIN lw USING (location_id)
UNION ALL SELECT 'summary_csv', 'places.csv', location_id, cases, 1 FROM upop JOIN lw USING (location_id)
UNION ALL SELECT 'timeseries_json', 'places.timeseries.json', location_id, SUM(click), COUNT(*) FROM upop JOIN w USING (location_id) GROUP BY 3
UNION ALL SELECT 'timeseries_csv', 'places.timeseries.csv', location_id, SUM(click), COUNT(*) FROM upop JOIN w USING (location_id) GROUP BY 3""")
def _(spark, d):
    """Summaries, daily rows and flat tables of all regions, written and read back."""
    path = work_dir(spark, "published")
    FL.publish(MS.user_geo(spark, d), MS.summary(spark, d), MS.day_parts(spark, d), path)
    cases = "actuals struct<cases: double>"
    read = {
        "summary_json": spark.read.schema(f"location_id string, {cases}, _file string").json(f"{path}/summary_json").select("_file", "location_id", F.col("actuals.cases").alias("value"), F.lit(1).alias("n")),
        "summary_csv": spark.read.csv(f"{path}/summary_csv", header=True).select("_file", "location_id", F.col("`actuals.cases`").cast("double").alias("value"), F.lit(1).alias("n")),
        "timeseries_json": spark.read.schema("location_id string, actualsTimeseries array<struct<date: string, cases: double>>, _file string").json(f"{path}/timeseries_json").select(
            "_file", "location_id", F.aggregate("actualsTimeseries", F.lit(None).cast("double"), lambda s, x: F.coalesce(s + x["cases"], x["cases"], s)).alias("value"), F.size("actualsTimeseries").alias("n")),
        "timeseries_csv": spark.read.csv(f"{path}/timeseries_csv", header=True).groupBy("_file", "location_id").agg(F.sum(F.col("`actuals.cases`").cast("double")).alias("value"), F.count("*").alias("n")),
    }
    parts = [df.select(F.lit(kind).alias("kind"), F.col("_file").alias("file"), "location_id", "value", F.col("n").cast("long").alias("n")) for kind, df in read.items()]
    return C.union_all(parts)


RATIO_FLOW = """ro AS (SELECT location_id, date, SUM(value) FILTER (variable = 'revenue') / SUM(value) FILTER (variable = 'n_orders') / 1000000 AS value FROM obs GROUP BY 1, 2),
 ra AS (SELECT location_id, 'test_positivity_7d' AS variable, date, value FROM ro WHERE value IS NOT NULL UNION ALL SELECT location_id, variable, date, value FROM obs WHERE variable = 'n_orders'),
 pw AS (SELECT location_id, population AS w FROM pop), cw AS (SELECT m.location_id, m.parent_id, w, SUM(w) OVER (PARTITION BY m.parent_id) AS tot FROM cbsamap m LEFT JOIN pw USING (location_id)),
 uw AS (SELECT g.location_id, 'iso1:us' AS parent_id, w, SUM(w) OVER () AS tot FROM geo g LEFT JOIN pw USING (location_id) WHERE level = 'county')"""


@query("roll_up_ratios_flow", f"""
WITH {RATIO_FLOW}, sh AS (SELECT * FROM cw UNION ALL SELECT * FROM uw)
SELECT parent_id AS location_id, variable, date, round(SUM(CASE variable WHEN 'n_orders' THEN value ELSE value * w / tot END), 6) AS value FROM ra JOIN sh USING (location_id) GROUP BY 1, 2, 3 HAVING SUM(w) / MAX(tot) >= 0.2""")
def _(spark, d):
    """Counts are added up and ratios are means by population, without being asked to."""
    wide = B.obs(spark, d).groupBy("location_id", "bucket", "date").pivot("variable", ["n_orders", "revenue"]).agg(F.first("value"))
    ratio = wide.select("location_id", F.lit("test_positivity_7d").alias("variable"), "bucket", "date", F.try_divide(F.col("revenue"), F.col("n_orders") * 1000000).alias("value"))
    obs = ratio.filter("value is not null").unionByName(B.obs(spark, d).filter("variable = 'n_orders'").select(*POINT, "value"))
    cfg = FL.Config(as_of=D(2002, 1, 1), coverage=0.2)
    out = FL.roll_up(B.dataset(spark, d).with_obs(obs), B.hsamap(spark, d), B.cbsamap(spark, d), B.counties(spark, d), cfg, hsa_fields={})
    areas = B.cbsamap(spark, d).select(F.col("parent_id").alias("location_id")).distinct()
    parents = areas.unionByName(spark.range(1).select(F.lit("iso1:us").alias("location_id")))
    return out.obs.join(parents, "location_id", "left_semi").select("location_id", "variable", "date", F.round("value", 6).alias("value"))


#: Events of a user as the inputs of all metrics; users whose id ends in 1 are the counties.
INPUTS = {
    "contact_tracers_count": "error", "current_icu_total": "view", "icu_beds": "signup", "beds_with_covid_patients_ratio_hsa": "error / 8",
    "current_hospitalized": "click", "current_hospitalized_hsa": "purchase", "staffed_beds": "view", "staffed_beds_hsa": "signup",
    "weekly_new_hospital_admissions_covid": "click", "weekly_new_hospital_admissions_covid_hsa": "view",
    "weekly_new_hospital_admissions_covid_per_100k_hsa": "error * 6.5", "test_positivity": "purchase / 7",
    "vaccinations_initiated_pct": "purchase", "vaccinations_completed_pct": "view", "vaccinations_additional_dose_pct": "signup",
    "vaccinations_bivalent_dose_pct": "error",
}


@query("all_metrics_flow", f"""
WITH {MS.ZEROS}, {MS.density_sql()}, {MS.WIDE}, lz2 AS (SELECT *, MAX(date) FILTER (value <> 0) OVER (PARTITION BY location_id) AS lz FROM cz),
 cut2 AS (SELECT location_id, date, value FROM lz2 WHERE lz IS NULL OR date <= lz),
 lead2 AS (SELECT x.location_id, CAST(t AS DATE) AS date, 0 AS value FROM (SELECT location_id, MIN(date) AS fv FROM cut2 GROUP BY 1) x JOIN fd USING (location_id), generate_series(first, fv - 1, INTERVAL 1 DAY) g(t)),
 sm AS (SELECT location_id, date, AVG(value) OVER ({LR(6)}) AS s FROM (SELECT * FROM cut2 UNION ALL SELECT * FROM lead2)),
 dy AS (SELECT location_id, date FROM w UNION SELECT location_id, date FROM cden), x AS (SELECT dy.*, location_id LIKE '%1' AS county FROM dy)
SELECT location_id, date, round_even(cden.value, 1) AS "caseDensity", round_even(cden.value * 7, 1) AS "weeklyNewCasesPer100k", round_even(purchase / 7, 3) AS "testPositivityRatio",
 round_even(CASE WHEN s <> 0 THEN error / (s * 5) END, 2) AS "contactTracerCapacityRatio", round_even(view * 0.55, 2) AS "infectionRate", round_even(view * 0.675 - view * 0.55, 2) AS "infectionRateCI90",
 round_even(CASE WHEN signup <> 0 THEN view / signup END, 2) AS "icuCapacityRatio", round_even(COALESCE(error / 8, CASE WHEN county THEN purchase / signup ELSE click / view END), 3) AS "bedsWithCovidPatientsRatio",
 round_even(COALESCE(error * 6.5, CASE WHEN county THEN view / (population * 10 / 100000) ELSE click / (population / 100000) END), 1) AS "weeklyCovidAdmissionsPer100k",
 round_even(purchase / 100, 3) AS "vaccinationsInitiatedRatio", round_even(view / 100, 3) AS "vaccinationsCompletedRatio", round_even(signup / 100, 3) AS "vaccinationsAdditionalDoseRatio",
 round_even(error / 100, 3) AS "vaccinationsFall2022BivalentBoosterRatio"
FROM x LEFT JOIN cden USING (location_id, date) LEFT JOIN sm USING (location_id, date) LEFT JOIN w USING (location_id, date) JOIN upop USING (location_id)""")
def _(spark, d):
    """All thirteen metrics of every user and day, from one stacked table."""
    return FL.metrics(user_inputs(spark, d), rt=user_rt(spark, d), geo=B.users(spark, d).filter("location_id like '%1'").select(
        "location_id", F.lit("county").alias("level"), F.lit("0").alias("fips")))


def user_rt(spark, d):
    views = B.evt(spark, d).filter("variable = 'view'")
    return views.select("location_id", "date", (F.col("value") * 0.55).alias("Rt_MAP_composite"), (F.col("value") * 0.675).alias("Rt_ci95_composite"))


def user_inputs(spark, d):
    """Clicks as new cases and the other inputs of the metrics, made from counts of events."""
    new = MS.zeros(spark, d).filter("variable = 'click'").withColumn("variable", F.lit("new_cases"))
    wide = MS.wide_with(spark, d, INPUTS).withColumn("bucket", F.lit("all"))
    obs = new.select(*POINT, "value").unionByName(LY.to_long(wide, list(INPUTS)).select(*POINT, "value"))
    hsa = B.ustatic(spark, d).filter("attr = 'population'").withColumns({"attr": F.lit("hsa_population"), "num": F.col("num") * 10})
    return Dataset(obs, B.ustatic(spark, d).unionByName(hsa), B.tags(spark, d).limit(0))


REGION_FLOW = """so AS (SELECT location_id, bucket, date, value FROM obsb WHERE variable = 'n_orders' UNION ALL SELECT parent_id, bucket, date, SUM(value) FROM obsb JOIN parent USING (location_id) WHERE variable = 'n_orders' GROUP BY 1, 2, 3),
 ta AS (SELECT location_id, COUNT(*) AS sources FROM tags WHERE variable = 'n_orders' AND bucket = 'all' AND tag_type = 'source' GROUP BY 1),
 la AS (SELECT location_id, bucket, arg_max(value, date) AS value FROM so GROUP BY 1, 2), dm AS (SELECT location_id, SUM(value) AS demo FROM la WHERE bucket <> 'all' GROUP BY 1),
 sr AS (SELECT g.location_id, g.fips, g.state, g.level, la.value AS latest, COALESCE(ta.sources, 0) AS sources, demo FROM geo g JOIN la USING (location_id) LEFT JOIN ta USING (location_id) JOIN dm USING (location_id) WHERE la.bucket = 'all'),
 dc AS (SELECT location_id, COUNT(DISTINCT date) AS days, SUM(value) AS total FROM so WHERE bucket = 'all' GROUP BY 1), rg AS (SELECT *, CASE level WHEN 'county' THEN fips ELSE state END AS key FROM sr JOIN dc USING (location_id))"""


@query("publish_by_region_flow", f"""
WITH {REGION_FLOW}
SELECT 'regions/summary_json' AS kind, level, key || '.json' AS file, location_id, latest AS value, sources, demo FROM rg
UNION ALL SELECT 'regions/timeseries_json', level, key || '.timeseries.json', location_id, total, sources, demo FROM rg
UNION ALL SELECT 'regions/timeseries_csv', level, key || '.timeseries.csv', location_id, total, NULL, NULL FROM rg WHERE level = 'state'
UNION ALL SELECT 'states/summary_json', level, state || '.json', location_id, latest, sources, demo FROM rg WHERE level = 'county'
UNION ALL SELECT 'states/timeseries_json', level, state || '.timeseries.json', location_id, total, sources, demo FROM rg WHERE level = 'county'
UNION ALL SELECT 'states/summary_csv', level, state || '.csv', location_id, latest, NULL, NULL FROM rg WHERE level = 'county'
UNION ALL SELECT 'states/timeseries_csv', level, state || '.timeseries.csv', location_id, total, NULL, NULL FROM rg WHERE level = 'county'""")
def _(spark, d):
    """Orders of counties and states as new cases, published with annotations and distributions and read back by file."""
    own = B.obsb(spark, d).filter("variable = 'n_orders'").select(*POINT, "value")
    above = own.join(B.parent(spark, d), "location_id").groupBy(F.col("parent_id").alias("location_id"), "variable", "bucket", "date").agg(F.sum("value").alias("value"))
    obs = own.unionByName(above.select(*POINT, "value")).withColumn("variable", F.lit("new_cases"))
    tags = B.tags(spark, d).filter("variable = 'n_orders'").withColumn("variable", F.lit("new_cases"))
    ds = Dataset(obs, B.static(spark, d), tags)
    daily = FL.materialize(FL.metrics(ds, geo=B.geo(spark, d)), "metrics")
    path = work_dir(spark, "published")
    FL.publish(B.geo(spark, d), FL.summaries(ds, B.geo(spark, d), daily), FL.daily_parts(ds, daily), path, by_region=True)
    folders = "_level string, _file string"
    record = ("location_id string, actuals struct<newCases: double>, actualsTimeseries array<struct<newCases: double>>, "
              "annotations map<string, struct<sources: array<struct<name: string>>>>, demographics map<string, map<string, double>>, ")
    sources = F.coalesce(F.size(F.try_element_at("annotations", F.lit("newCases"))["sources"]), F.lit(0)).cast("long")
    members = F.aggregate(F.map_values(F.try_element_at("demographics", F.lit("new_cases/segment"))), F.lit(0.0), lambda s, x: s + x)
    total = F.aggregate("actualsTimeseries", F.lit(0.0), lambda s, x: s + F.coalesce(x["newCases"], F.lit(0.0)))

    def listed(kind):
        if kind.endswith("json"):
            value = total if "timeseries" in kind else F.col("actuals.newCases")
            df = spark.read.schema(record + folders).json(f"{path}/{kind}").withColumns({"value": value, "sources": sources, "demo": members})
        else:
            df = spark.read.csv(f"{path}/{kind}", header=True).groupBy("_level", "_file", "location_id").agg(F.sum(F.col("`actuals.newCases`").cast("double")).alias("value"))
            df = df.withColumns({"sources": F.lit(None).cast("long"), "demo": F.lit(None).cast("double")})
        return df.select(F.lit(kind).alias("kind"), F.col("_level").alias("level"), F.col("_file").alias("file"), "location_id", "value", "sources", "demo")

    single = [f"regions/{k}" for k in ("summary_json", "timeseries_json", "timeseries_csv")]
    return C.union_all([listed(kind) for kind in [*single, *[f"states/{k}" for k in FL.PUBLISHED]]])
