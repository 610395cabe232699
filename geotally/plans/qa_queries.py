"""Queries for comparison and reporting."""

import datetime

from pyspark.sql import functions as F

from geotally.functions import tagtext as T
from geotally.model import POINT, SERIES, Dataset, flatten
from geotally.operators import layout as L, qa as O
from geotally.plans import bindings as B
from geotally.plans.catalog import query
from geotally.plans.filters_queries import FLAT
from geotally.plans.rollups_queries import rounded
from geotally.plans.windows_queries import P

D = datetime.date

# Two snapshots of daily orders: the old one lacks the counties ending in 7, the new one lacks
# those ending in 5 and the orders of one status.
SNAP = """ob AS (SELECT * FROM obs WHERE location_id NOT LIKE '%7'), nb AS (SELECT location_id, v.variable, 'all' AS bucket, date, v.value FROM (SELECT g.location_id, CAST(o_orderdate AS DATE) AS date,
  CAST(COUNT(*) AS DOUBLE) AS n, CAST(SUM(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS r FROM orders JOIN customer ON o_custkey = c_custkey JOIN geo g ON g.nationkey = c_nationkey WHERE o_orderstatus <> 'F' AND location_id NOT LIKE '%5' GROUP BY 1, 2) x,
  LATERAL (VALUES ('n_orders', n), ('revenue', r)) AS v(variable, value))"""


def old_obs(spark, d):
    return B.obs(spark, d).filter(~F.col("location_id").endswith("7"))


def new_obs(spark, d):
    p = B.placed_orders(spark, d).filter("o_orderstatus <> 'F'").filter(~F.col("location_id").endswith("5"))
    x = p.groupBy("location_id", "date").agg(F.count("*").cast("double").alias("n_orders"), B.cents("o_totalprice").alias("revenue"))
    return x.withColumn("bucket", F.lit("all")).unpivot(["location_id", "bucket", "date"], ["n_orders", "revenue"], "variable", "value").select(*POINT, "value")


@query("diff_prepare", """
WITH k AS (SELECT l_orderkey, CAST(l_shipdate AS DATE) AS d FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) = 1)
SELECT 'o' || k.l_orderkey AS location_id, k.d AS date, v.variable, v.value FROM lineitem JOIN k ON k.l_orderkey = lineitem.l_orderkey AND k.d = CAST(l_shipdate AS DATE), LATERAL (VALUES ('l_quantity', l_quantity), ('l_tax', l_tax)) AS v(variable, value)""")
def _(spark, d):
    x = B.table(spark, d, "lineitem").select(
        F.concat(F.lit("o"), "l_orderkey").alias("location_id"), F.to_date("l_shipdate").alias("date"), "l_quantity", "l_tax", "l_returnflag")
    return O.diff_prepare(x)


@query("diff_duplicates", "SELECT 'o' || l_orderkey AS location_id, CAST(l_shipdate AS DATE) AS date, COUNT(*) AS n FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1")
def _(spark, d):
    return O.duplicates_dropped(B.table(spark, d, "lineitem").select(F.concat(F.lit("o"), "l_orderkey").alias("location_id"), F.to_date("l_shipdate").alias("date")))


@query("diff_series_only_in_one", f"""
WITH {SNAP}, a AS (SELECT DISTINCT variable, location_id FROM ob), b AS (SELECT DISTINCT variable, location_id FROM nb) (SELECT *, 'left' AS side FROM a ANTI JOIN b USING (variable, location_id)) UNION ALL (SELECT *, 'right' FROM b ANTI JOIN a USING (variable, location_id))""")
def _(spark, d):
    return O.series_only_in_one(old_obs(spark, d), new_obs(spark, d))


JOINED = f"""{SNAP}, c AS (SELECT DISTINCT variable, location_id FROM ob INTERSECT SELECT DISTINCT variable, location_id FROM nb),
 jn AS (SELECT variable, location_id, date, ob.value AS l, nb.value AS r FROM ob FULL JOIN nb USING (variable, location_id, date) SEMI JOIN c USING (variable, location_id))"""


@query("diff_points_only_in_one", f"WITH {JOINED} SELECT variable, location_id, date, CASE WHEN r IS NULL THEN 'left' ELSE 'right' END AS side, COALESCE(l, r) AS value FROM jn WHERE l IS NULL OR r IS NULL")
def _(spark, d):
    return O.points_only_in_one(old_obs(spark, d), new_obs(spark, d))


PW = "PARTITION BY variable, location_id ORDER BY date"


def interp_sql(c):
    back, ahead = f"({PW} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)", f"({PW} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    dv = f"CASE WHEN {c} IS NOT NULL THEN date END"
    return f"""LAST_VALUE({c} IGNORE NULLS) OVER {back} AS {c}0, LAST_VALUE({dv} IGNORE NULLS) OVER {back} AS {c}d0, FIRST_VALUE({c} IGNORE NULLS) OVER {ahead} AS {c}1, FIRST_VALUE({dv} IGNORE NULLS) OVER {ahead} AS {c}d1"""


def filled_sql(c):
    return f"CASE WHEN {c} IS NOT NULL THEN {c} WHEN {c}0 IS NULL THEN NULL WHEN {c}1 IS NULL THEN {c}0 ELSE {c}0 + ({c}1 - {c}0) * (date - {c}d0) / ({c}d1 - {c}d0) END"


SMAPE = f"""{JOINED}, rg AS (SELECT variable, location_id, greatest(MIN(date) FILTER (l IS NOT NULL), MIN(date) FILTER (r IS NOT NULL)) AS s, least(MAX(date) FILTER (l IS NOT NULL), MAX(date) FILTER (r IS NOT NULL)) AS e FROM jn GROUP BY 1, 2),
 sl AS (SELECT jn.* FROM jn JOIN rg USING (variable, location_id) WHERE date BETWEEN s AND e), iv AS (SELECT *, {interp_sql('l')}, {interp_sql('r')} FROM sl), fv AS (SELECT *, {filled_sql('l')} AS li, {filled_sql('r')} AS ri FROM iv),
 sc AS (SELECT variable, location_id, SUM(li) + SUM(ri) AS total, SUM(abs(ri - li)) AS delta, COUNT(*) AS points_overlap FROM fv GROUP BY 1, 2),
 df AS (SELECT variable, location_id, CASE WHEN abs(total) > 0.0001 THEN delta / total WHEN abs(delta) < 0.0001 THEN 0 ELSE 1 END AS diff, points_overlap, true AS has_overlap FROM sc)"""


@query("diff_smape", f"WITH {SMAPE} SELECT variable, location_id, round(diff, 9) AS diff, points_overlap, has_overlap FROM df")
def _(spark, d):
    return rounded(O.diff_smape(old_obs(spark, d), new_obs(spark, d)), "diff", n=9)


@query("diff_top_k", f"WITH {SMAPE} SELECT variable, location_id, round(diff, 9) AS diff FROM df ORDER BY round(diff, 9) DESC, variable, location_id LIMIT 20")
def _(spark, d):
    x = rounded(O.diff_smape(old_obs(spark, d), new_obs(spark, d)), "diff", n=9)
    return O.diff_top_series(x).select("variable", "location_id", "diff")


@query("diff_top_variables", f"WITH {SMAPE} SELECT variable, has_overlap, round(AVG(diff), 8) AS diff, round(AVG(points_overlap), 6) AS points_overlap FROM df GROUP BY 1, 2 ORDER BY 3 DESC LIMIT 20")
def _(spark, d):
    x = O.diff_top_variables(O.diff_smape(old_obs(spark, d), new_obs(spark, d)))
    return x.withColumns({"diff": F.round("diff", 8), "points_overlap": F.round("points_overlap", 6)})


@query("timeseries_removed", f"""
WITH {SNAP}, o AS (SELECT ob.* FROM ob ANTI JOIN nb USING (location_id, variable, bucket)), s AS (SELECT * FROM static WHERE attr = 'balance'),
 t AS (SELECT * FROM tags WHERE tag_type = 'source_url' OR location_id LIKE '%5') {FLAT}""")
def _(spark, d):
    ds = B.dataset(spark, d)
    new = Dataset(new_obs(spark, d), ds.static.filter("attr <> 'balance'"), ds.tags.filter((F.col("tag_type") != "source_url") & ~F.col("location_id").endswith("5")))
    return flatten(O.removed(ds.with_obs(old_obs(spark, d)), new))


def summary_sql(src):
    return f"""SELECT location_id, variable, bucket, true AS has_value, MIN(date) AS min_date, MAX(date) AS max_date, MAX(value) AS max_value, MIN(value) AS min_value, arg_max(value, date) AS latest_value, COUNT(*) AS num_observations,
 MAX(delta) AS largest_delta, arg_max(date, (delta, DATE '2100-01-01' - date)) FILTER (delta IS NOT NULL) AS largest_delta_date FROM (SELECT *, CASE WHEN LAG(date) OVER ({P}) = date - 1 THEN abs(value - LAG(value) OVER ({P})) END AS delta FROM {src}) GROUP BY 1, 2, 3"""


@query("field_summary", summary_sql("evt"))
def _(spark, d):
    return O.field_summary(B.evt(spark, d))


@query("summary_snapshot_compare", f"""
WITH {SNAP}, a AS ({summary_sql('ob')}), b AS ({summary_sql('nb')}), j AS (SELECT variable, location_id, a.has_value AS ha, b.has_value AS hb, concat_ws(',', CASE WHEN a.latest_value IS DISTINCT FROM b.latest_value THEN 'latest_value' END,
 CASE WHEN a.max_date IS DISTINCT FROM b.max_date THEN 'max_date' END, CASE WHEN a.min_date IS DISTINCT FROM b.min_date THEN 'min_date' END, CASE WHEN a.num_observations IS DISTINCT FROM b.num_observations THEN 'num_observations' END) AS ch FROM a FULL JOIN b USING (variable, location_id))
SELECT variable, location_id, CASE WHEN ha IS NULL THEN 'new' WHEN hb IS NULL THEN 'dropped' ELSE 'changed' END AS status, CASE WHEN ha AND hb THEN ch END AS changed FROM j WHERE ha IS NULL OR hb IS NULL OR ch <> ''""")
def _(spark, d):
    cut = lambda x: O.field_summary(x).select("variable", "location_id", "latest_value", "max_date", "min_date", "num_observations")
    return O.summary_changes(cut(old_obs(spark, d)), cut(new_obs(spark, d)))


@query("availability_report", """
WITH l AS (SELECT location_id, bool_or(variable = 'n_orders') AS a, bool_or(variable = 'revenue' AND value > 300000) AS b FROM (SELECT location_id, variable, arg_max(value, date) AS value FROM obs GROUP BY 1, 2) GROUP BY 1)
SELECT CASE level WHEN 'state' THEN 'state data' ELSE state END AS "group", COUNT(*) FILTER (a) AS n_orders, COUNT(*) FILTER (b) AS revenue, COUNT(p.population) AS population FROM geo LEFT JOIN l USING (location_id) LEFT JOIN pop p USING (location_id) WHERE level <> 'country' GROUP BY 1""")
def _(spark, d):
    from geotally.operators.rollup import latest_values

    latest = latest_values(B.obs(spark, d), ["location_id", "variable"]).filter("variable = 'n_orders' or value > 300000")
    wide = L.to_wide_variables(latest, ["n_orders", "revenue"], ["location_id"])
    x = B.geo(spark, d).filter("level <> 'country'").join(wide, "location_id", "left").join(B.pop(spark, d).select("location_id", "population"), "location_id", "left")
    return O.availability_report(x, ["n_orders", "revenue", "population"])


@query("source_comparison", """
WITH x AS (SELECT source, location_id, date, value - LAG(value) OVER (PARTITION BY location_id, source ORDER BY date) AS value FROM srcall WHERE date > DATE '1996-01-01' AND date < DATE '2001-01-01')
SELECT location_id, date, MAX(value) FILTER (source = 'F') AS "F", MAX(value) FILTER (source = 'O') AS "O", MAX(value) FILTER (source = 'P') AS "P" FROM x GROUP BY 1, 2""")
def _(spark, d):
    return O.source_comparison(B.srcall(spark, d), ["F", "O", "P"], True, D(1996, 1, 1), D(2001, 1, 1))


STAT = """ss AS (SELECT o.location_id, o.variable, o.bucket, split_part(o.bucket, ':', 1) AS distribution, g.level, g.state, CASE o.variable WHEN 'n_orders' THEN 'orders' END AS field_group, 1 AS has_timeseries,
 CAST(o.bucket = 'all' AS INTEGER) AS bucket_all_count, o.n AS observation_count, 0 AS annotation_count, COALESCE(t.p, 0) AS provenance, COALESCE(t.u, 0) AS source_url, COALESCE(t.s, 0) AS source, COALESCE(t.st, '') AS source_type_set
 FROM (SELECT location_id, variable, bucket, COUNT(*) AS n FROM obsb GROUP BY 1, 2, 3) o LEFT JOIN geo g USING (location_id) LEFT JOIN (SELECT location_id, variable, bucket, COUNT(*) FILTER (tag_type = 'provenance') AS p, COUNT(*) FILTER (tag_type = 'source_url') AS u,
  COUNT(*) FILTER (tag_type = 'source') AS s, string_agg(DISTINCT json_extract_string(CASE WHEN tag_type = 'source' THEN content ELSE '{}' END, '$.type'), ';' ORDER BY json_extract_string(CASE WHEN tag_type = 'source' THEN content ELSE '{}' END, '$.type')) AS st FROM tags GROUP BY 1, 2, 3) t USING (location_id, variable, bucket))"""


def stats(spark, d):
    groups = F.broadcast(spark.createDataFrame([("n_orders", "orders")], "variable string, field_group string"))
    return O.series_stats(B.dataset(spark, d, B.obsb), B.geo(spark, d), groups)


@query("series_stats", f"WITH {STAT} SELECT * FROM ss")
def _(spark, d):
    return stats(spark, d).select(
        *SERIES, "distribution", "level", "state", "field_group", "has_timeseries", "bucket_all_count", "observation_count", "annotation_count", "provenance", "source_url", "source", "source_type_set")


@query("stats_group_by", f"WITH {STAT} SELECT state, distribution, CAST(SUM(has_timeseries) AS BIGINT) AS has_timeseries, CAST(SUM(observation_count) AS BIGINT) AS observation_count, CAST(SUM(provenance) AS BIGINT) AS provenance FROM ss GROUP BY 1, 2")
def _(spark, d):
    return O.stats_group_by(stats(spark, d), "state", "distribution").select("state", "distribution", "has_timeseries", "observation_count", "provenance")


@query("stats_for_locations", f"WITH {STAT} SELECT g.location_id, CAST(COALESCE(SUM(has_timeseries), 0) AS BIGINT) AS has_timeseries, CAST(COALESCE(SUM(has_timeseries) - SUM(bucket_all_count), 0) AS BIGINT) AS bucket_not_all FROM geo g LEFT JOIN ss USING (location_id) GROUP BY 1")
def _(spark, d):
    return O.stats_for_locations(stats(spark, d), B.geo(spark, d)).select("location_id", "has_timeseries", "bucket_not_all")


AB = """ab AS (SELECT location_id, date, a.value AS x, b.value AS y FROM (SELECT * FROM srcall WHERE source = 'O') a JOIN (SELECT * FROM srcall WHERE source = 'P') b USING (location_id, date))"""


def two_sources(spark, d):
    pick = lambda s: B.srcall(spark, d).filter(F.col("source") == s).select("location_id", "date", "value")
    return pick("O"), pick("P")


@query("qa_metric_threshold", """
SELECT l_orderkey, l_linenumber, CASE WHEN (l_quantity + l_tax * 500) / 2 < 20 THEN false ELSE abs((l_quantity + l_tax * 500) / 2 - l_quantity) / l_quantity * 100 > 10.0001 END AS over, round(abs(l_tax - l_discount), 4) > 0.0451 AS over_absolute FROM lineitem""")
def _(spark, d):
    q, t, s = F.col("l_quantity"), F.col("l_tax"), F.col("l_discount")
    return B.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", O.metric_differs(q, t * 500, 10.0001).alias("over"), O.metric_differs(s, t, 0.0451, absolute=True).alias("over_absolute"))


@query("snapshot_walk_diff", f"""
WITH {SNAP}, a AS (SELECT location_id, COUNT(*) AS n, MAX(date) AS last FROM ob GROUP BY 1), b AS (SELECT location_id, COUNT(*) AS n, MAX(date) AS last FROM nb GROUP BY 1), j AS (SELECT location_id, a.n AS an, b.n AS bn, a.last AS al, b.last AS bl FROM a FULL JOIN b USING (location_id))
SELECT location_id, 'counts.points' AS path, CAST(an AS VARCHAR) AS old, CAST(bn AS VARCHAR) AS new FROM j WHERE an IS DISTINCT FROM bn UNION ALL SELECT location_id, 'latest.date', CAST(al AS VARCHAR), CAST(bl AS VARCHAR) FROM j WHERE al IS DISTINCT FROM bl""")
def _(spark, d):
    nest = lambda x: x.groupBy("location_id").agg(F.struct(F.count("*").alias("points")).alias("counts"), F.struct(F.max("date").alias("date")).alias("latest"))
    return O.nested_differences(nest(old_obs(spark, d)), nest(new_obs(spark, d)))


@query("latest_by_source", """
WITH l AS (SELECT source, location_id, variable, arg_max(value, date) AS value FROM srcall GROUP BY 1, 2, 3)
SELECT * FROM l UNION ALL SELECT source, location_id, attr, num FROM (SELECT DISTINCT source, location_id FROM srcall) JOIN static USING (location_id) WHERE num IS NOT NULL""")
def _(spark, d):
    return O.latest_by_source(B.srcall(spark, d), B.static(spark, d))


@query("mean_percent_diff", f"WITH {AB} SELECT location_id, round(AVG(abs((x - y) / (x + y) * 100)), 8) AS mean_percent_diff FROM ab GROUP BY 1")
def _(spark, d):
    a, b = two_sources(spark, d)
    return rounded(O.mean_percent_diff(a, b, ["location_id", "date"], ["location_id"]), "mean_percent_diff", n=8)


@query("fractional_error_report", """
WITH t AS (SELECT location_id, SUM(value) FILTER (variable = 'click') AS p, SUM(value) FILTER (variable = 'view') AS o, SUM(value) AS pt, SUM(value) FILTER (variable <> 'error') AS ot FROM evt GROUP BY 1)
SELECT location_id, round((p - o) / o, 9) AS error, round((p * (ot / pt) - o) / o, 9) AS renormalized_error FROM t WHERE o >= 5""")
def _(spark, d):
    of = lambda c: F.sum(F.when(c, F.col("value")))
    v = F.col("variable")
    t = B.evt(spark, d).groupBy("location_id").agg(
        of(v == "click").alias("predicted"), of(v == "view").alias("observed"), F.sum("value").alias("predicted_total"), of(v != "error").alias("observed_total"))
    return rounded(O.fractional_errors(t, 5), "error", "renormalized_error", n=9)


@query("external_signal_join", """
SELECT s.state, s.date, s.signal, r.value AS rt FROM (SELECT parent_id AS state, date, round(AVG(value), 9) AS signal FROM evt JOIN uparent USING (location_id) WHERE variable = 'view' GROUP BY 1, 2) s
JOIN (SELECT location_id AS state, date, value FROM evp WHERE variable = 'click') r USING (state, date)""")
def _(spark, d):
    s = B.evt(spark, d).filter("variable = 'view'").join(B.uparent(spark, d), "location_id").select(F.col("parent_id").alias("state"), "date", "value")
    rt = B.evp(spark, d).filter("variable = 'click'").select(F.col("location_id").alias("state"), "date", F.col("value").alias("rt"))
    return rounded(O.external_signal(s, rt), "signal", n=9)


@query("peak_ratio_compare", f"""
WITH {SNAP}, a AS (SELECT location_id, variable, MAX(value) AS v FROM nb GROUP BY 1, 2), b AS (SELECT location_id, variable, MAX(value) AS v FROM ob GROUP BY 1, 2)
SELECT location_id, variable, a.v AS peak_new, b.v AS peak_old, round(a.v / b.v, 9) AS ratio FROM a FULL JOIN b USING (location_id, variable)""")
def _(spark, d):
    return rounded(O.peak_ratio(new_obs(spark, d), old_obs(spark, d), ["location_id", "variable"]), "ratio", n=9)
