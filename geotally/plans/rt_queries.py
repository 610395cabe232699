"""Queries for the reproduction rate, on daily events per group of users."""

from pyspark.sql import functions as F

from geotally.model import POINT
from geotally.operators import layout as L, rollup, rt as O, windows as WN
from geotally.plans import bindings as B
from geotally.plans.catalog import query
from geotally.plans.rollups_queries import rounded
from geotally.plans.windows_queries import DENSE0, P, gauss_sql

GROUPS = "gd AS (SELECT location_id, 'new_cases' AS variable, 'all' AS bucket, date, SUM(value) AS value FROM evp GROUP BY 1, 4)"


def daily(spark, d):
    return B.evp(spark, d).groupBy("location_id", "date").agg(F.sum("value").alias("value")).select(
        "location_id", F.lit("new_cases").alias("variable"), F.lit("all").alias("bucket"), "date", "value"
    )


@query("rt_input", f"""
WITH {DENSE0.format(src='evt')} SELECT d0.*, e.value FROM d0 LEFT JOIN evt e USING (location_id, variable, bucket, date) WHERE (d0.location_id, d0.variable, d0.date) NOT IN (SELECT (location_id, variable, MIN(date)) FROM evt GROUP BY location_id, variable)""")
def _(spark, d):
    return O.rt_input(B.evt(spark, d))


@query("rt_smoothed_input", f"""
WITH {GROUPS}, cut AS (SELECT * FROM gd QUALIFY date > MIN(date) OVER (PARTITION BY location_id)), sm AS ({gauss_sql('cut')}),
 ok AS (SELECT location_id FROM sm LEFT JOIN cut c USING (location_id, date) GROUP BY 1 HAVING COUNT(c.value) > 20 AND SUM(c.value) > 20 AND MAX(c.value) > 5 AND MAX(sm.value) > 5)
SELECT location_id, date, value AS smoothed FROM sm SEMI JOIN ok USING (location_id)""")
def _(spark, d):
    return rounded(O.gated_smooth(O.rt_input(daily(spark, d))), "smoothed")


INPUT = f"""{GROUPS}, cut AS (SELECT * FROM gd QUALIFY date > MIN(date) OVER (PARTITION BY location_id)), smo AS ({gauss_sql('cut', digits=15)}),
 okl AS (SELECT location_id FROM smo LEFT JOIN cut c USING (location_id, date) GROUP BY 1 HAVING COUNT(c.value) > 20 AND SUM(c.value) > 20 AND MAX(c.value) > 5 AND MAX(smo.value) > 5)"""


def bayes_sql(*caps):
    """The daily update as a recursive statement: one row per region and day, with the posterior
    as a list of 501 numbers. A row of the process matrix is a slice of one symmetric kernel."""
    lo, hi = "(CASE WHEN r > 250 THEN 2 * r - 501 ELSE 0 END)", "(CASE WHEN r < 250 THEN 2 * r ELSE 500 END)"
    kernel = f"ker[{lo} - r + 501:{hi} - r + 501]"
    lam = "(cp * exp((r * 0.02 - 1) / (1 / 0.333 + 0.5 / 0.25)))"
    pmf = lambda k: f"(CASE WHEN {lam} = 0 THEN CASE WHEN {k} = 0 THEN 1.0 ELSE 0.0 END ELSE exp({k} * ln(CASE WHEN {lam} = 0 THEN 1 ELSE {lam} END) - {lam} - lgamma({k} + 1)) END)"
    like = f"(c - floor(c)) * {pmf('ceil(c)')} + (1 - (c - floor(c))) * {pmf('floor(c)')}"
    peak = lambda x: f"list_position({x}, list_max({x}))"
    return f"""{INPUT}, caps AS (SELECT * FROM (VALUES {', '.join(f'({c}.0)' for c in caps)}) AS v(cap)),
 inp AS MATERIALIZED (SELECT location_id, cap, date, value AS c, ROW_NUMBER() OVER (PARTITION BY location_id, cap ORDER BY date) - 1 AS i FROM smo SEMI JOIN okl USING (location_id) CROSS JOIN caps),
 pr AS (SELECT list_transform(raw, lambda x: x / list_sum(raw)) AS p0 FROM (SELECT list_transform(range(0, 501), lambda r: (r * 0.02) * exp(-r * 0.02)) AS raw)),
 f AS (SELECT location_id, cap, date, i, c AS scale, c, p0 AS post, p0, CAST(0 AS BIGINT) AS prior_at, CAST(0 AS BIGINT) AS like_at, CAST(0 AS BIGINT) AS post_at FROM inp, pr WHERE i = 0
  UNION ALL SELECT location_id, cap, date, i, scale, c, CASE WHEN ev = 0 OR c <= 0.4 THEN p0 ELSE list_transform(joint, lambda x: x / ev) END, p0, {peak('prior')}, {peak('likes')}, {peak('joint')}
  FROM (SELECT *, list_sum(joint) AS ev FROM (SELECT *, list_transform(range(0, 501), lambda r: prior[r + 1] * likes[r + 1]) AS joint FROM (
   SELECT *, list_transform(range(0, 501), lambda r: list_inner_product({kernel}, post[{lo} + 1:{hi} + 1]) / list_sum({kernel})) AS prior, list_transform(range(0, 501), lambda r: {like}) AS likes FROM (
    SELECT *, list_transform(range(-500, 501), lambda k: exp(-0.5 * power(k * 0.02 / sigma, 2))) AS ker FROM (
     SELECT n.location_id, n.cap, n.date, n.i, 0.9 * f.scale + 0.1 * n.c AS scale, n.c, f.c AS cp, f.post, f.p0, 0.03 * least(n.cap, greatest(1.0, sqrt(5000 / (0.9 * f.scale + 0.1 * n.c)))) AS sigma
     FROM f JOIN inp n ON n.location_id = f.location_id AND n.cap = f.cap AND n.i = f.i + 1))))))"""


def closest_sql(share):
    return f"round((list_position(list_transform(cdf, lambda x: abs(x - {share})), list_min(list_transform(cdf, lambda x: abs(x - {share})))) - 1) * CAST(0.02 AS DOUBLE), 2)"


MAP_SQL = "round((list_position(post, list_max(post)) - 1) * CAST(0.02 AS DOUBLE), 2)"
INTERVALS = f"""SELECT location_id, date, m AS "Rt_MAP__new_cases", {closest_sql('(1 - 0.95)')} AS "Rt_ci5__new_cases", {closest_sql('0.95')} AS "Rt_ci95__new_cases", {closest_sql('(1 - 0.68)')} AS "Rt_ci31__new_cases", {closest_sql('0.68')} AS "Rt_ci68__new_cases"
 FROM (SELECT location_id, date, {MAP_SQL} AS m, list_transform(range(1, 502), lambda i: list_sum(post[1:i])) AS cdf FROM f)"""


def posterior(spark, d):
    return O.rt_posterior(O.gated_smooth(O.rt_input(daily(spark, d))))


def two_places(df):
    """Bins are multiples of 0.02."""
    return df.withColumns({c: F.round(c, 2) for c in df.columns if c.startswith("Rt_")})


@query("rt_posterior", f"WITH RECURSIVE {bayes_sql(30)} SELECT location_id, date, {MAP_SQL} AS \"Rt_MAP__new_cases\" FROM f")
def _(spark, d):
    return two_places(posterior(spark, d).select("location_id", "date", "Rt_MAP__new_cases"))


@query("rt_intervals", f"WITH RECURSIVE {bayes_sql(30)} {INTERVALS}")
def _(spark, d):
    return two_places(posterior(spark, d).drop("prior_peak", "likelihood_peak", "posterior_peak", "error"))


def slopes_sql():
    ramp = "SELECT t, x, exp(-0.5 * power((x - t) / 5.0, 2)) AS w FROM range(0, 38) a(t), range(0, 38) b(x) WHERE abs(x - t) <= 9"
    return f"""sl AS (SELECT t, m - LAG(m) OVER (ORDER BY t) AS slope FROM (SELECT t, SUM(w * x) / SUM(w) AS m FROM ({ramp}) GROUP BY 1)),
 sup AS (SELECT 38 - t AS rn, slope FROM sl WHERE t >= 29)"""


# The tail correction and the composite smoothing are checked on daily counts in place of an
# estimate, as both are plain expressions over any daily series.
AS_RT = "rt AS (SELECT location_id, date, value / 10 AS m, value / 5 AS hi FROM gd)"
CORR = f"""{GROUPS}, {AS_RT}, {slopes_sql()}, num AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY location_id ORDER BY date DESC) AS rn FROM rt),
 co AS (SELECT location_id, date, COALESCE(slope, 1) AS s, (m - 1) / power(COALESCE(slope, 1), 0.75) + 1 AS m, hi FROM num LEFT JOIN sup USING (rn))"""


def as_rt(spark, d):
    return daily(spark, d).select(
        "location_id", "date", (F.col("value") / 10).alias("Rt_MAP__new_cases"), (F.col("value") / 5).alias("Rt_ci95__new_cases")
    )


@query("rt_tail_correction", f"WITH {CORR} SELECT location_id, date, round(s, 6) AS suppression, round(m, 6) AS composite FROM co")
def _(spark, d):
    x = O.tail_correction(as_rt(spark, d))
    return x.select("location_id", "date", F.round("suppression", 6).alias("suppression"), F.round("Rt_MAP_composite", 6).alias("composite"))


@query("rt_composite_smooth", f"""
WITH {CORR}, sm AS (SELECT a.location_id, a.date, any_value(a.s) AS s, any_value(a.hi) AS hi, CASE WHEN COUNT(*) >= 6 THEN SUM(exp(-0.5 * power((b.date - a.date) / 6.0, 2)) * b.m) / SUM(exp(-0.5 * power((b.date - a.date) / 6.0, 2))) END AS m
  FROM co a JOIN co b ON a.location_id = b.location_id AND b.date BETWEEN a.date - 12 AND a.date + 12 GROUP BY 1, 2)
SELECT location_id, date, round(m, 6) AS composite, round(greatest((hi - m) / sqrt(12) / power(s, 0.375), 0.1) + m, 6) AS ci95 FROM sm""")
def _(spark, d):
    x = O.composite_smooth(O.tail_correction(as_rt(spark, d)))
    return x.select("location_id", "date", F.round("Rt_MAP_composite", 6).alias("composite"), F.round("Rt_ci95_composite", 6).alias("ci95"))


@query("rt_lag_diagnostics", f"""
WITH RECURSIVE {bayes_sql(30)}, lg AS (SELECT location_id, i, like_at - prior_at AS drive, CASE WHEN i = 0 THEN 0 ELSE like_at - post_at END AS lag FROM f),
 lp AS (SELECT *, COALESCE(LAG(lag) OVER (PARTITION BY location_id ORDER BY i), 0) AS last FROM lg WHERE i > 0),
 fl AS (SELECT *, i - 1 < 12 OR abs(lag) < 5 OR abs(lag) < round_even(0.8 * abs(drive), 0) OR last * lag < 0 AS fine FROM lp),
 sg AS (SELECT *, COUNT(*) FILTER (fine) OVER (PARTITION BY location_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS seg FROM fl),
 rn AS (SELECT *, COUNT(*) FILTER (abs(lag) >= 4) OVER (PARTITION BY location_id, seg ORDER BY i ROWS UNBOUNDED PRECEDING) AS run FROM sg),
 wr AS (SELECT *, fine AND COALESCE(LAG(run) OVER (PARTITION BY location_id ORDER BY i), 0) >= 4 AS warn FROM rn)
SELECT location_id, COUNT(*) FILTER (NOT fine) AS days_lagging, COUNT(*) FILTER (warn) AS warnings, CAST(MAX(abs(lag)) AS INTEGER) AS max_lag FROM wr GROUP BY 1""")
def _(spark, d):
    return O.lag_report(posterior(spark, d))


@query("rt_parameter_sweep", f"""
WITH RECURSIVE {bayes_sql(10, 20, 30)} SELECT location_id, date, MAX({MAP_SQL}) FILTER (cap = 10) AS cap_10, MAX({MAP_SQL}) FILTER (cap = 20) AS cap_20, MAX({MAP_SQL}) FILTER (cap = 30) AS cap_30 FROM f GROUP BY 1, 2""")
def _(spark, d):
    x = O.parameter_sweep(O.gated_smooth(O.rt_input(daily(spark, d))), [10.0, 20.0, 30.0])
    return x.withColumns({c: F.round(c, 2) for c in ("cap_10", "cap_20", "cap_30")})


ALL = f"""{bayes_sql(30)}, iv AS MATERIALIZED ({INTERVALS}), {slopes_sql()}, nr AS (SELECT location_id, date, "Rt_MAP__new_cases" AS m0, "Rt_ci95__new_cases" AS hi, ROW_NUMBER() OVER (PARTITION BY location_id ORDER BY date DESC) AS rn FROM iv),
 co AS (SELECT location_id, date, COALESCE(slope, 1) AS s, (m0 - 1) / power(COALESCE(slope, 1), 0.75) + 1 AS m, m0, hi FROM nr LEFT JOIN sup USING (rn)),
 cm AS (SELECT a.location_id, a.date, any_value(a.s) AS s, any_value(a.m0) AS m0, any_value(a.hi) AS hi, CASE WHEN COUNT(*) >= 6 THEN SUM(exp(-0.5 * power((b.date - a.date) / 6.0, 2)) * b.m) / SUM(exp(-0.5 * power((b.date - a.date) / 6.0, 2))) END AS m
  FROM co a JOIN co b ON a.location_id = b.location_id AND b.date BETWEEN a.date - 12 AND a.date + 12 GROUP BY 1, 2),
 rtc AS (SELECT location_id, date, m0, m AS composite, greatest((hi - m) / sqrt(12) / power(s, 0.375), 0.1) + m AS ci95 FROM cm)"""


@query("rt_all_regions", f"""WITH RECURSIVE {ALL} SELECT location_id, date, m0 AS "Rt_MAP__new_cases", round(composite, 6) AS "Rt_MAP_composite", round(ci95, 6) AS "Rt_ci95_composite" FROM rtc""")
def _(spark, d):
    x = O.rt_all_regions(daily(spark, d))[0]
    return x.select("location_id", "date", F.round("Rt_MAP__new_cases", 2).alias("Rt_MAP__new_cases"), F.round("Rt_MAP_composite", 6).alias("Rt_MAP_composite"), F.round("Rt_ci95_composite", 6).alias("Rt_ci95_composite"))


REVENUE = f"""rv AS (SELECT * FROM obs WHERE variable = 'revenue' QUALIFY date > MIN(date) OVER (PARTITION BY location_id)), rs AS ({gauss_sql('rv')})"""


@query("rt_failed_regions", f"""
WITH {REVENUE} SELECT location_id, 'ValueError: smoothed series has gaps' AS error FROM rs LEFT JOIN rv USING (location_id, date) GROUP BY 1
HAVING COUNT(rv.value) > 20 AND SUM(rv.value) > 20 AND MAX(rv.value) > 5 AND MAX(rs.value) > 5 AND COUNT(*) > COUNT(rs.value)""")
def _(spark, d):
    """Daily revenue of counties has long gaps where orders are sparse; such a region is reported."""
    return O.rt_all_regions(B.obs(spark, d).filter("variable = 'revenue'"))[1]
