"""Queries for data-quality filters."""

import datetime

from pyspark.sql import functions as F

from geotally.functions import tagtext as T
from geotally.model import POINT, SERIES, Dataset, flatten
from geotally.operators import combine as C, filters as FL, layout as L, quality as O, windows as WN
from geotally.operators.intervals import in_intervals
from geotally.plans import bindings as B
from geotally.plans.catalog import query
from geotally.plans.flow import stored
from geotally.plans.filters_queries import FLAT
from geotally.plans.joins_queries import RULES_SQL, anomaly_rules
from geotally.plans.windows_queries import P, PK, R, ZEROS, gauss_sql, spread_ctes, zeros, zscore_sql

D = datetime.date
RULES = [
    O.Rule("state = 'AL'", ["n_orders"], True, "late start", start=D(1996, 6, 1), end=D(1997, 2, 1)),
    O.Rule("state in ('AL', 'AK')", ["n_orders", "revenue"], True, "blocked", start=D(2000, 1, 1)),
    O.Rule("fips = '01001'", ["n_orders"], True, "all bad"),
    O.Rule("level = 'county'", ["revenue"], False, "estimated", exclude="state = 'CA'"),
    O.Rule("fips = '01001'", ["n_orders"], True, "too late", start=D(1995, 1, 1), end=D(1995, 12, 31)),
    O.Rule("state = 'AZ'", ["n_orders", "revenue"], True, "early", end=D(1995, 6, 30)),
]
# The same rules folded one after the other: the expected result does not use the one-pass rule.
RULE_SQL = [
    ("state = 'AL'", "'n_orders'", "drop", "1996-06-01", "1997-02-01", "late start"),
    ("state IN ('AL', 'AK')", "'n_orders', 'revenue'", "drop", "2000-01-01", None, "blocked"),
    ("fips = '01001'", "'n_orders'", "drop", None, None, "all bad"),
    ("level = 'county' AND state <> 'CA'", "'revenue'", "note", None, None, "estimated"),
    ("fips = '01001'", "'n_orders'", "drop", "1995-01-01", "1995-12-31", "too late"),
    ("state = 'AZ'", "'n_orders', 'revenue'", "drop", None, "1995-06-30", "early"),
]


def fold_rules():
    parts, o, t = [], "obs0", "tags0"
    parts.append("obs0 AS MATERIALIZED (SELECT location_id, variable, bucket, date, value FROM obsb)")
    parts.append("tags0 AS (SELECT * FROM tags)")
    for i, (where, fields, kind, start, end, note) in enumerate(RULE_SQL):
        sel = f"bucket = 'all' AND variable IN ({fields}) AND location_id IN (SELECT location_id FROM geo WHERE {where})"
        rng = " AND ".join([x for x in (start and f"date >= DATE '{start}'", end and f"date <= DATE '{end}'") if x]) or "true"
        date = start or end
        typ = "known_issue" if date else "known_issue_no_date"
        content = f'{{"public_note":"{note}"' + (f',"date":"{date}"' if date else "") + "}"
        hit = rng if kind == "drop" else "true"
        parts.append(f"hit{i} AS MATERIALIZED (SELECT DISTINCT location_id, variable, bucket FROM {o} WHERE {sel} AND {hit})")
        keep_tags = t if (date or kind == "note") else f"(SELECT * FROM {t} ANTI JOIN hit{i} USING (location_id, variable, bucket))"
        parts.append(f"tg{i} AS (SELECT * FROM {keep_tags} UNION ALL SELECT location_id, variable, bucket, '{typ}', '{content}' FROM hit{i})")
        t = f"tg{i}"
        if kind == "drop":
            parts.append(f"ob{i} AS MATERIALIZED (SELECT * FROM {o} WHERE NOT ({sel} AND {rng}))")
            o = f"ob{i}"
    return ", ".join(parts), o, t


FOLD, FO, FT = fold_rules()


@query("manual_filter", f"""
WITH {FOLD}, o AS (SELECT * FROM {FO}), s AS (SELECT * FROM static), t AS (SELECT * FROM {FT}) {FLAT}""")
def _(spark, d):
    return flatten(O.manual_filter(B.dataset(spark, d, B.obsb), B.geo(spark, d), RULES))


@query("manual_filter_touched", f"""
WITH {FOLD}, n0 AS (SELECT location_id, variable, bucket, COUNT(*) n FROM obs0 GROUP BY 1, 2, 3), n1 AS (SELECT location_id, variable, bucket, COUNT(*) n FROM {FO} GROUP BY 1, 2, 3),
 lost AS (SELECT n0.location_id, n0.variable, n0.bucket FROM n0 LEFT JOIN n1 USING (location_id, variable, bucket) WHERE COALESCE(n1.n, 0) < n0.n),
 o AS (SELECT obs0.* FROM obs0 SEMI JOIN lost USING (location_id, variable, bucket)), s AS (SELECT * FROM static WHERE false),
 t AS (SELECT * FROM (SELECT * FROM tags0 UNION ALL SELECT * FROM {FT} WHERE tag_type LIKE 'known_issue%') SEMI JOIN lost USING (location_id, variable, bucket)) {FLAT}""")
def _(spark, d):
    ds = B.dataset(spark, d, B.obsb)
    filtered = stored(O.manual_filter(ds, B.geo(spark, d), RULES), "manual")
    return flatten(O.touched_subset(ds, filtered))


@query("manual_filter_validate", """
SELECT user_id, CASE WHEN NOT d AND note = '' THEN 'neither drops observations nor adds a note' WHEN NOT d AND s IS NOT NULL THEN 'a date without dropping has no effect'
  WHEN e < s THEN 'ends before it starts' END AS problem
FROM (SELECT user_id, event_id, value > 40 AS d, CASE WHEN user_id % 3 = 0 THEN '' ELSE 'n' END AS note, CASE WHEN user_id % 2 = 0 THEN CAST(ts AS DATE) END AS s, DATE '2024-01-15' AS e FROM events)
WHERE problem IS NOT NULL""")
def _(spark, d):
    u = F.col("user_id")
    rules = B.table(spark, d, "events").select(
        "user_id", (F.col("value") > 40).alias("drop"), F.when(u % 3 == 0, "").otherwise("n").alias("note"),
        F.when(u % 2 == 0, F.to_date("ts")).alias("start"), F.when(F.col("value") > 40, F.lit(D(2024, 1, 15))).alias("end"),
    )
    return O.invalid_rules(rules).select("user_id", "problem")


OVERRIDES = """{"overrides": [
 {"region": "AL, 02002", "include": "region", "metric": "metrics.orders", "context": "x", "disclaimer": "note one", "blocked": true, "start_date": "1996-01-01", "end_date": ""},
 {"region": "AZ", "include": "subregions", "metric": "metrics.money", "context": "x", "blocked": false, "start_date": "", "end_date": ""},
 {"region": "CA", "include": "region-and-subregions", "metric": "metrics.both", "context": "x", "disclaimer": "note three", "blocked": true},
 {"region": "10100", "include": "region-and-subregions", "metric": "metrics.orders", "context": "x", "blocked": true, "end_date": "1999-01-01"}]}"""


@query("region_override_expand", """
WITH mf AS (SELECT * FROM (VALUES ('metrics.orders', 'n_orders'), ('metrics.money', 'revenue'), ('metrics.both', 'n_orders'), ('metrics.both', 'revenue')) AS v(metric, field)),
 r AS (SELECT 0 AS no, location_id, 'metrics.orders' AS metric, 'note one' AS note, true AS drop, DATE '1996-01-01' AS start, CAST(NULL AS DATE) AS "end" FROM geo WHERE (state = 'AL' AND level = 'state') OR fips = '02002'
  UNION ALL SELECT 1, location_id, 'metrics.money', '', false, NULL, NULL FROM geo WHERE state = 'AZ' AND level = 'county'
  UNION ALL SELECT 2, location_id, 'metrics.both', 'note three', true, NULL, NULL FROM geo WHERE state = 'CA'
  UNION ALL SELECT 3, 'iso1:us#cbsa:10100', 'metrics.orders', '', true, NULL, DATE '1999-01-01' UNION ALL SELECT 3, location_id, 'metrics.orders', '', true, NULL, DATE '1999-01-01' FROM cbsamap WHERE parent_id = 'iso1:us#cbsa:10100')
SELECT r.no, r.location_id, mf.field, r.note, r.drop, r.start, r."end", COUNT(o.date) AS points FROM r JOIN mf USING (metric)
 LEFT JOIN obs o ON o.location_id = r.location_id AND o.variable = mf.field AND o.date >= COALESCE(r.start, o.date) AND o.date <= COALESCE(r."end", o.date) GROUP BY ALL""")
def _(spark, d):
    geo = B.geo(spark, d).select("location_id", "fips", "state", "level")
    areas = B.cbsamap(spark, d).select(F.col("parent_id").alias("location_id")).distinct().select(
        "location_id", F.substring("location_id", 14, 5).alias("fips"), F.lit(None).cast("string").alias("state"), F.lit("cbsa").alias("level")
    )
    fields = spark.createDataFrame(
        [("metrics.orders", "n_orders"), ("metrics.money", "revenue"), ("metrics.both", "n_orders"), ("metrics.both", "revenue")], "metric string, field string"
    )
    text = spark.createDataFrame([(OVERRIDES,)], "json string")
    rules = O.expand_overrides(text, geo.unionByName(areas), fields, B.cbsamap(spark, d))
    hits = rules.join(B.obs(spark, d).select("location_id", F.col("variable").alias("field"), "date"), ["location_id", "field"], "left")
    inside = (F.col("start").isNull() | (F.col("date") >= F.col("start"))) & (F.col("end").isNull() | (F.col("date") <= F.col("end")))
    return hits.groupBy("no", "location_id", "field", "note", "drop", "start", "end").agg(F.count(F.when(inside, F.col("date"))).alias("points"))


# Cumulative events that fall at the end for some groups, so that the tail filter has work.
TAILED = """tl AS (SELECT location_id, variable, bucket, date, CASE WHEN (location_id LIKE '%3' OR location_id LIKE '%7') AND dayofmonth(date) >= 25 THEN value - 1000 * (dayofmonth(date) - 24)
  WHEN location_id LIKE '%5' AND variable = 'click' AND dayofmonth(date) >= 18 THEN value - 1000 * (dayofmonth(date) - 17)
  WHEN location_id LIKE '%8' AND variable = 'view' AND dayofmonth(date) >= 10 THEN value - 1000 * (dayofmonth(date) - 9) ELSE value END AS value
  FROM evcum WHERE NOT (location_id LIKE '%2' AND dayofmonth(date) BETWEEN 3 AND 16))"""


def tailed(spark, d):
    loc, v, day = F.col("location_id"), F.col("value"), F.dayofmonth("date")
    value = (
        F.when((loc.endswith("3") | loc.endswith("7")) & (day >= 25), v - 1000 * (day - 24))
        .when(loc.endswith("5") & (F.col("variable") == "click") & (day >= 18), v - 1000 * (day - 17))
        .when(loc.endswith("8") & (F.col("variable") == "view") & (day >= 10), v - 1000 * (day - 9)).otherwise(v)
    )
    return B.evcum(spark, d).filter(~(loc.endswith("2") & day.between(3, 16))).withColumn("value", value)


TAIL_SQL = f"""{TAILED}, cal AS (SELECT MIN(date) AS lo, MAX(date) AS hi FROM tl),
 a AS (SELECT tl.*, hi, hi - lo + 1 AS n_days, hi - date + 1 AS pos, CASE WHEN LAG(date) OVER ({P}) = date - 1 THEN value - LAG(value) OVER ({P}) END AS diff FROM tl, cal WHERE variable <> 'error'),
 m AS (SELECT *, AVG(diff) FILTER (pos BETWEEN 15 AND 28) OVER (PARTITION BY location_id, variable, bucket) AS mean FROM a),
 sp AS (SELECT *, MIN(pos) FILTER (pos <= 14 AND diff >= floor(mean / 100)) OVER (PARTITION BY location_id, variable, bucket) AS stop FROM m),
 u AS (SELECT *, COUNT(*) FILTER (pos <= 14 AND diff IS NOT NULL AND pos < COALESCE(stop, 15)) OVER (PARTITION BY location_id, variable, bucket) AS under, COALESCE(stop, 15) - 1 AS cut FROM sp),
 oc AS (SELECT *, CASE WHEN n_days < 28 THEN 'skipped_too_short' WHEN mean IS NULL THEN 'skipped_na_mean' WHEN under = 0 THEN 'all_good' WHEN under < 8 THEN 'truncated' ELSE 'long_truncated' END AS outcome FROM u)"""


@query("tail_filter", f"""
WITH {TAIL_SQL}
, o AS (SELECT {PK}, value FROM oc WHERE NOT (outcome LIKE '%truncated' AND pos <= cut) UNION ALL SELECT {PK}, value FROM tl WHERE variable = 'error'), s AS (SELECT * FROM static),
 t AS (SELECT * FROM tags UNION ALL SELECT location_id, variable, bucket, CASE outcome WHEN 'truncated' THEN 'cumulative_tail_truncated' ELSE 'cumulative_long_tail_truncated' END,
  '{{"date": "' || (any_value(hi) - CAST(any_value(cut) AS INTEGER)) || '", "original_observation": ' || COALESCE(CAST(MAX(value) FILTER (pos = cut) AS VARCHAR), 'NaN') || '}}' FROM oc WHERE outcome LIKE '%truncated' GROUP BY location_id, variable, bucket, outcome) {FLAT}""")
def _(spark, d):
    out, _ = O.tail_filter(B.dataset(spark, d).with_obs(tailed(spark, d)), ["click", "purchase", "signup", "view"])
    return flatten(out)


@query("tail_filter_counts", f"WITH {TAIL_SQL} SELECT outcome, COUNT(DISTINCT (location_id, variable)) AS n FROM oc GROUP BY 1")
def _(spark, d):
    return O.tail_filter(B.dataset(spark, d).with_obs(tailed(spark, d)), ["click", "purchase", "signup", "view"])[1]


@query("drop_all_zero_series", """
WITH z AS (SELECT location_id, variable, bucket, date, CASE WHEN location_id LIKE '%4' THEN 0 ELSE value END AS value FROM evt),
 k AS (SELECT location_id, variable, bucket FROM z GROUP BY 1, 2, 3 HAVING bool_or(value <> 0)), o AS (SELECT z.* FROM z SEMI JOIN k USING (location_id, variable, bucket) WHERE variable IN ('click', 'view') UNION ALL SELECT * FROM z WHERE variable NOT IN ('click', 'view')),
 s AS (SELECT * FROM static), t AS (SELECT * FROM tags) """ + FLAT)
def _(spark, d):
    x = B.evt(spark, d).withColumn("value", F.when(F.col("location_id").endswith("4"), 0.0).otherwise(F.col("value")))
    return flatten(O.drop_all_zero_series(B.dataset(spark, d).with_obs(x), ["click", "view"]))


# Daily order counts with a few planted jumps.
SPIKES = """sp AS (SELECT location_id, variable, bucket, date, CASE WHEN dayofmonth(date) = 17 AND month(date) IN (3, 9) THEN value * 400 ELSE value END AS value FROM obs WHERE variable = 'n_orders')"""


def spikes(spark, d):
    planted = (F.dayofmonth("date") == 17) & F.month("date").isin(3, 9)
    return B.obs(spark, d).filter("variable = 'n_orders'").withColumn("value", F.when(planted, F.col("value") * 400).otherwise(F.col("value")))


Z_TAG = """'{"date": "' || date || '", "original_observation": ' || raw || '}'"""


@query("drop_series_outliers", f"""
WITH {SPIKES}, {zscore_sql('sp')}, f AS (SELECT *, COALESCE(abs(x - mean) > CASE WHEN date > DATE '1998-06-01' THEN 15.0 ELSE 8.0 END * std, false) AND raw > 30 AND date <> DATE '1999-03-17'
   AND location_id NOT IN (SELECT location_id FROM geo WHERE state = 'AL') AS outlier FROM z)
, o AS (SELECT {PK}, raw AS value FROM f WHERE NOT outlier), s AS (SELECT * FROM static),
 t AS (SELECT * FROM tags UNION ALL SELECT location_id, variable, bucket, 'zscore_outlier', {Z_TAG} FROM f WHERE outlier) {FLAT}""")
def _(spark, d):
    out = O.drop_series_outliers(
        B.dataset(spark, d).with_obs(spikes(spark, d)), "n_orders", 8.0, (D(1998, 6, 1), 15.0), 30, exempt=[D(1999, 3, 17)], skip=B.counties(spark, d).filter("state = 'AL'")
    )
    return flatten(out)


# A ratio per group and day whose last value jumps for some groups.
RATIO = """ra AS (SELECT location_id, 'ratio' AS variable, 'all' AS bucket, date, CASE WHEN date = DATE '2024-01-30' AND location_id < 'iso1:us#hsa:006' THEN 9.5 + v ELSE v END AS value
 FROM (SELECT location_id, date, SUM(value) FILTER (variable = 'purchase') / SUM(value) AS v FROM evp GROUP BY 1, 2) WHERE v IS NOT NULL)"""


def ratios(spark, d):
    v = F.sum(F.when(F.col("variable") == "purchase", F.col("value"))) / F.sum("value")
    x = B.evp(spark, d).groupBy("location_id", "date").agg(v.alias("v")).filter("v is not null")
    jump = (F.col("date") == F.lit(D(2024, 1, 30))) & (F.col("location_id") < "iso1:us#hsa:006")
    return x.select("location_id", F.lit("ratio").alias("variable"), F.lit("all").alias("bucket"), "date", F.when(jump, F.col("v") + 9.5).otherwise(F.col("v")).alias("value"))


@query("drop_tail_ratio_outliers", f"""
WITH {RATIO}, df AS (SELECT *, CASE WHEN LAG(date) OVER ({P}) = date - 1 THEN abs(value - LAG(value) OVER ({P})) END AS diff FROM ra),
 rec AS (SELECT {PK}, value FROM ra WHERE date > (SELECT MAX(date) FROM ra) - 10), {spread_ctes('rec')},
 zm AS (SELECT *, value AS x, AVG(value) OVER ({R(5, 'INTERVAL 1 DAY PRECEDING')}) AS m, stddev_pop(value) OVER ({R(5, 'INTERVAL 1 DAY PRECEDING')}) AS s, COUNT(value) OVER ({R(5, 'INTERVAL 1 DAY PRECEDING')}) AS n FROM spread),
 lz AS (SELECT *, MAX(date) FILTER (n >= 3 AND (s > 0 OR x <> m)) OVER (PARTITION BY location_id) AS last_d FROM zm),
 hit AS (SELECT lz.location_id, lz.date FROM lz JOIN df USING (location_id, date) WHERE lz.date = last_d AND abs(x - m) > 10 * s AND diff > 0.015)
, o AS (SELECT {PK}, round(value, 9) AS value FROM ra ANTI JOIN hit USING (location_id, date)), s AS (SELECT * FROM static),
 t AS (SELECT * FROM tags UNION ALL SELECT location_id, 'ratio', 'all', 'zscore_outlier', CAST(date AS VARCHAR) FROM hit) {FLAT}""")
def _(spark, d):
    out = O.drop_tail_ratio_outliers(B.dataset(spark, d).with_obs(ratios(spark, d)), "ratio")
    obs = F.when(F.col("kind") == "obs", F.round("value", 9)).otherwise(F.col("value"))
    # of the new tags the date is compared; the two engines write the ratio with other digits
    at = T.decode(F.col("tag_type"), F.col("content"))["date"].cast("string")
    new = (F.col("tag_type") == "zscore_outlier") & (F.col("variable") == "ratio")
    return flatten(out).withColumns({"value": obs, "content": F.when(new, at).otherwise(F.col("content"))})


@query("exclude_observations", f"""
WITH p AS (SELECT DISTINCT location_id, variable, bucket, date FROM obs WHERE variable = 'revenue' AND value > 450000)
SELECT 'obs' AS kind, {PK}, value, CAST(NULL AS DATE) AS tag_date, CAST(NULL AS DOUBLE) AS original, CAST(NULL AS VARCHAR) AS content FROM obs ANTI JOIN p USING ({PK})
UNION ALL SELECT 'tag', location_id, variable, bucket, NULL, NULL, date, value, NULL FROM obs SEMI JOIN p USING ({PK})
UNION ALL SELECT 'tag', location_id, variable, bucket, NULL, NULL, NULL, NULL, content FROM tags UNION ALL SELECT 'static', location_id, attr, NULL, NULL, num, NULL, NULL, str FROM static""")
def _(spark, d):
    ds = B.dataset(spark, d)
    points = ds.obs.filter("variable = 'revenue' and value > 450000")
    out = O.exclude_observations(ds, points)
    new = F.col("tag_type") == "zscore_outlier"
    x = F.when(new, T.decode(F.col("tag_type"), F.col("content")))
    return flatten(out).withColumn("x", x).select(
        "kind", *POINT, "value", F.col("x.date").alias("tag_date"), F.col("x.original_observation").alias("original"), F.when(F.coalesce(~new, F.lit(True)), F.col("content")).alias("content"))


ANOM = f"""{RULES_SQL}, days AS (SELECT rx.location_id, CASE kind WHEN 'cases' THEN 'n_orders' ELSE 'revenue' END AS variable, 'all' AS bucket, CAST(t AS DATE) AS date
  FROM rx, generate_series(start_d, end_d, INTERVAL 1 DAY) g(t)
  UNION ALL SELECT DISTINCT location_id, 'n_orders', 'all', date FROM obs WHERE location_id = 'iso1:us#iso2:us-al#fips:01001' AND date >= DATE '1998-06-01'
  UNION ALL SELECT DISTINCT location_id, 'revenue', 'all', date FROM obs WHERE location_id LIKE 'iso1:us#iso2:us-ar#%' AND date <= DATE '1992-03-31')"""


def named_rules(spark, d):
    """Rules with both ends, one without an end, some without a start, and some that are listed but not to be omitted."""
    name = F.when(F.col("kind") == "cases", "n_orders").otherwise("revenue").alias("variable")
    both = anomaly_rules(spark, d).select("location_id", name, "start", "end", F.concat(F.lit("Known: "), "kind").alias("note"), F.lit(True).alias("omit"))
    day = lambda x: F.lit(x).cast("date")
    more = lambda where, variable, start, end, kind, omit: B.counties(spark, d).filter(where).select(
        "location_id", F.lit(variable).alias("variable"), day(start).alias("start"), day(end).alias("end"), F.lit(f"Known: {kind}").alias("note"), F.lit(omit).alias("omit"))
    return both.unionByName(more("fips = '01001'", "n_orders", D(1998, 6, 1), None, "cases", True)).unionByName(
        more("state = 'AR'", "revenue", None, D(1992, 3, 31), "deaths", True)).unionByName(more("state = 'CA'", "n_orders", None, None, "cases", False))


@query("anomaly_range_join", f"WITH {ANOM} SELECT o.* FROM obs o SEMI JOIN days USING ({PK})")
def _(spark, d):
    rules = named_rules(spark, d).filter("omit").select("location_id", "variable", F.lit("all").alias("bucket"), "start", "end")
    return in_intervals(B.obs(spark, d), rules, SERIES).select(*POINT, "value").distinct()


LISTED = """(1, 'USA-01', DATE '1995-01-01', DATE '1995-02-10', 'both', 'no', 'yes', 'state, omitted in its counties'), (2, 'USA-02002', DATE '1996-03-01', NULL, 'cases', 'yes', 'no', 'one day'),
 (3, 'USA-36998', DATE '1996-03-01', NULL, 'cases', 'yes', 'no', 'no such place'), (4, 'USA-03', DATE '1997-01-01', DATE '1997-12-31', 'deaths', NULL, NULL, 'listed only')"""


@query("anomaly_list", f"""
WITH li AS (SELECT * FROM (VALUES {LISTED}) AS l(no, geoid, date, end_date, type, omit, below, description)), ow AS (SELECT replace(geoid, 'USA-', '') AS fips, * FROM li),
 al AS (SELECT fips, date, end_date, type, COALESCE(omit = 'yes', false) AS omit, description FROM ow
  UNION ALL SELECT g.fips, date, end_date, type, true, description FROM ow JOIN geo g ON g.level = 'county' AND substr(g.fips, 1, 2) = ow.fips WHERE below = 'yes'),
 ty AS (SELECT * FROM al JOIN (VALUES ('cases', 'cases', 'new_cases'), ('deaths', 'deaths', 'new_deaths'), ('both', 'cases', 'new_cases'), ('both', 'deaths', 'new_deaths')) AS v(type, one, variable) USING (type))
SELECT g.location_id, ty.variable, ty.date AS start, COALESCE(end_date, ty.date) AS "end", 'NYTimes: ' || description AS note, omit, COUNT(o.date) AS points FROM ty JOIN geo g USING (fips)
 LEFT JOIN obs o ON o.location_id = g.location_id AND o.variable = 'n_orders' AND o.date BETWEEN ty.date AND COALESCE(end_date, ty.date) GROUP BY ALL""")
def _(spark, d):
    """A list of anomalies as rules for each place, and the observations in the range of each."""
    rows = [
        ("USA-01", D(1995, 1, 1), D(1995, 2, 10), "both", "no", "yes", "state, omitted in its counties"), ("USA-02002", D(1996, 3, 1), None, "cases", "yes", "no", "one day"),
        ("USA-36998", D(1996, 3, 1), None, "cases", "yes", "no", "no such place"), ("USA-03", D(1997, 1, 1), D(1997, 12, 31), "deaths", None, None, "listed only")]
    listed = spark.createDataFrame(rows, "geoid string, date date, end_date date, type string, omit_from_rolling_average string, omit_from_rolling_average_on_subgeographies string, description string")
    rules = O.anomaly_rules(listed, B.geo(spark, d))
    orders = B.obs(spark, d).filter("variable = 'n_orders'").select("location_id", "date")
    keys = ["location_id", "variable", "start", "end", "note", "omit"]
    hits = in_intervals(orders, rules.withColumns({"first": F.col("start"), "last": F.col("end")}), ["location_id"])
    counts = hits.groupBy("location_id", "variable", F.col("first").alias("start"), F.col("last").alias("end"), "note", "omit").agg(F.count("*").alias("points"))
    return rules.join(counts, keys, "left").withColumn("points", F.coalesce("points", F.lit(0)))


@query("anomaly_filter", f"""
WITH {ANOM}, live AS (SELECT * FROM days WHERE NOT (location_id LIKE 'iso1:us#iso2:us-ak%' AND date >= DATE '1998-12-01' AND date < DATE '1999-01-01'))
, o AS (SELECT * FROM obs ANTI JOIN live USING ({PK})), s AS (SELECT * FROM static),
 t AS (SELECT * FROM tags UNION ALL SELECT location_id, variable, bucket, 'known_issue', '{{"public_note":"Known: ' || CASE variable WHEN 'n_orders' THEN 'cases' ELSE 'deaths' END || '","date":"' || date || '"}}' FROM live WHERE (location_id, date) IN (SELECT (location_id, date) FROM obs)) {FLAT}""")
def _(spark, d):
    ds = B.dataset(spark, d)
    exempt = F.col("location_id").startswith("iso1:us#iso2:us-ak") & (F.col("date") >= F.lit(D(1998, 12, 1))) & (F.col("date") < F.lit(D(1999, 1, 1)))
    return flatten(O.anomaly_filter(ds, named_rules(spark, d), exempt))


@query("rt_input_gate", f"""
WITH all_ev AS (SELECT location_id, 'all' AS variable, 'all' AS bucket, date, SUM(value) AS value FROM evt GROUP BY 1, 4), sm AS ({gauss_sql('all_ev')})
SELECT location_id, COALESCE(COUNT(e.value) > 20 AND SUM(e.value) > 20 AND MAX(e.value) > 5 AND MAX(sm.value) > 5, false) AS qualifies
FROM sm LEFT JOIN all_ev e USING (location_id, date) GROUP BY 1""")
def _(spark, d):
    x = B.evt(spark, d).groupBy("location_id", "date").agg(F.sum("value").alias("value")).withColumns({"variable": F.lit("all"), "bucket": F.lit("all")})
    dense = L.densify_per_series(x.select(*POINT, "value")).withColumn("smoothed", F.col("value"))
    return O.rt_input_gate(WN.gaussian_smooth(dense, col="smoothed"))
