"""Queries for window and time-series operators."""

import datetime

from pyspark.sql import functions as F

from geotally.model import POINT, SERIES
from geotally.operators import layout as L, windows as O
from geotally.plans import bindings as B
from geotally.plans.catalog import query

D = datetime.date
P = "PARTITION BY location_id, variable, bucket ORDER BY date"
PK = "location_id, variable, bucket, date"


def spread_ctes(src, limit=14, name="spread"):
    """CTE ``name``: spread_after_stall over CTE ``src``."""
    return f"""{name}_a AS (SELECT *, ROW_NUMBER() OVER ({P}) AS rn FROM {src}),
 {name}_b AS (SELECT *, MAX(CASE WHEN value <> 0 THEN rn END) OVER ({P} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prv,
   MIN(CASE WHEN value <> 0 THEN rn END) OVER ({P} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nxt,
   FIRST_VALUE(CASE WHEN value <> 0 THEN value END IGNORE NULLS) OVER ({P} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rep,
   MIN(CASE WHEN value > 0 THEN rn END) OVER (PARTITION BY location_id, variable, bucket) AS lo,
   MAX(CASE WHEN value > 0 THEN rn END) OVER (PARTITION BY location_id, variable, bucket) AS hi FROM {name}_a),
 {name} AS (SELECT {PK}, CASE WHEN rn > lo AND rn <= hi AND rn > nxt - least(nxt - COALESCE(prv, 0), {limit})
   THEN rep / least(nxt - COALESCE(prv, 0), {limit}) ELSE value END AS value, value AS raw FROM {name}_b)"""


DENSE0 = """d0 AS (SELECT s.location_id, s.variable, s.bucket, CAST(t AS DATE) AS date FROM (SELECT location_id, variable, bucket, MIN(date) lo, MAX(date) hi FROM {src} GROUP BY 1, 2, 3) s,
  generate_series(lo, hi, INTERVAL 1 DAY) g(t))"""


@query("incident_from_cumulative", f"""
WITH x AS (SELECT *, LAG(date) OVER ({P}) AS pd, value - LAG(value) OVER ({P}) AS diff FROM evcum)
SELECT {PK}, CASE WHEN diff = -1 THEN 0 ELSE diff END AS value FROM x WHERE pd = date - 1 AND (diff >= 0 OR diff = -1)""")
def _(spark, d):
    return O.incident_from_cumulative(B.evcum(spark, d))


# A daily series with zeros: users on the days between their first and last event, missing days count as zero.
ZEROS = f"""zer AS (SELECT d0.*, COALESCE(e.value, 0) AS value FROM (SELECT s.location_id, s.variable, s.bucket, CAST(t AS DATE) AS date FROM
 (SELECT location_id, variable, bucket, MIN(date) lo, MAX(date) hi FROM evt GROUP BY 1, 2, 3) s, generate_series(lo, hi, INTERVAL 1 DAY) g(t)) d0 LEFT JOIN evt e USING ({PK}))"""


def zeros(spark, d):
    return L.densify_per_series(B.evt(spark, d)).withColumn("value", F.coalesce("value", F.lit(0.0)))


@query("spread_after_stall", f"WITH {ZEROS}, {spread_ctes('zer')} SELECT {PK}, round(value, 9) AS value FROM spread")
def _(spark, d):
    return O.spread_after_stall(zeros(spark, d)).select(*POINT, F.round("value", 9).alias("value"))


@query("spread_after_stall_max3", f"WITH {ZEROS}, {spread_ctes('zer', 3)} SELECT {PK}, round(value, 9) AS value FROM spread")
def _(spark, d):
    return O.spread_after_stall(zeros(spark, d), 3).select(*POINT, F.round("value", 9).alias("value"))


@query("patch_date_range_spread", f"""
WITH {ZEROS}, part AS (SELECT * FROM zer WHERE variable = 'click' AND date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'), {spread_ctes('part', 10)}
SELECT {PK}, round(value, 9) AS value FROM spread UNION ALL SELECT * FROM zer WHERE NOT (variable = 'click' AND date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20')""")
def _(spark, d):
    out = O.patch_date_range_spread(zeros(spark, d), F.col("variable") == "click", D(2024, 1, 10), D(2024, 1, 20))
    return out.withColumn("value", F.round("value", 9))


R = lambda n, to="CURRENT ROW": f"{P} RANGE BETWEEN INTERVAL {n} DAYS PRECEDING AND {to}"


@query("rolling_sum_7d", f"""
SELECT * FROM (SELECT {PK}, CASE WHEN COUNT(*) OVER ({R(6)}) = 7 THEN SUM(value) OVER ({R(6)}) END AS value FROM evt) WHERE value IS NOT NULL""")
def _(spark, d):
    return O.rolling_sum(B.evt(spark, d))


def fill_sql(src, until, limit=None):
    last = f"COALESCE(LEAD(date) OVER ({P}) - 1, {until})"
    if limit:
        last = f"least({last}, date + {limit})"
    return f"""WITH f AS (SELECT *, {last} AS upto FROM {src}) SELECT location_id, variable, bucket, CAST(t AS DATE) AS date, value FROM f, generate_series(date, greatest(date, upto), INTERVAL 1 DAY) g(t)"""


@query("locf_fill", fill_sql("evt", "(SELECT MAX(date) FROM evt)"))
def _(spark, d):
    return O.locf_fill(B.evt(spark, d))


@query("locf_fill_limited", fill_sql("obs", "(SELECT MAX(date) FROM obs)", 14))
def _(spark, d):
    return O.locf_fill_limited(B.obs(spark, d))


@query("smooth_rolling_mean", f"SELECT {PK}, round(AVG(value) OVER ({R(6)}), 9) AS value FROM obs")
def _(spark, d):
    return O.smooth_rolling_mean(B.obs(spark, d)).withColumn("value", F.round("value", 9))


@query("smooth_without_trailing_zeros", f"""
WITH {ZEROS}, neg AS (SELECT {PK}, CASE WHEN dayofmonth(date) > 24 THEN 0 ELSE value - 1 END AS value FROM zer), pos AS (SELECT * FROM neg WHERE value >= 0),
 l AS (SELECT *, MAX(CASE WHEN value <> 0 THEN date END) OVER (PARTITION BY location_id, variable, bucket) AS last_nz FROM pos)
SELECT {PK}, round(AVG(value) OVER ({R(6)}), 9) AS value FROM l QUALIFY last_nz IS NULL OR date <= last_nz""")
def _(spark, d):
    x = zeros(spark, d).withColumn("value", F.when(F.dayofmonth("date") > 24, 0.0).otherwise(F.col("value") - 1))
    return O.smooth_rolling_mean(x, include_trailing_zeros=False).withColumn("value", F.round("value", 9))


INTERP = f"""ia AS (SELECT *, LAG(date) OVER ({P}) = date - 1 AND LAG(value) OVER ({P}) = value AS stalled, MAX(date) OVER (PARTITION BY location_id, variable, bucket) AS last_d FROM {{src}}),
 ib AS (SELECT *, LEAD(date) OVER ({P}) AS d1, LEAD(value) OVER ({P}) AS v1 FROM ia WHERE NOT COALESCE(stalled, false)),
 interp AS (SELECT location_id, variable, bucket, CAST(t AS DATE) AS date, floor(value + COALESCE((CAST(t AS DATE) - date) * (v1 - value) / (d1 - date), 0)) AS value
  FROM ib, generate_series(date, COALESCE(d1 - 1, last_d), INTERVAL 1 DAY) g(t))"""


@query("interpolate_stalled", f"WITH {INTERP.format(src='evtcum')} SELECT * FROM interp")
def _(spark, d):
    return O.interpolate_stalled(B.evtcum(spark, d))


@query("interpolate_daily_levels", f"WITH {INTERP.format(src='evp')} SELECT * FROM interp")
def _(spark, d):
    return O.interpolate_stalled(B.evp(spark, d))


@query("has_recent_data", """
SELECT location_id, variable, bucket, COUNT(*) FILTER (date >= DATE '2024-01-16') >= 7 AND COALESCE(bool_or(date >= DATE '2024-01-16' AND value > 0), false) AS has_recent FROM evt GROUP BY 1, 2, 3""")
def _(spark, d):
    return O.recent_data(B.evt(spark, d), D(2024, 1, 30))


TZ = f"""tz AS (SELECT *, MAX(CASE WHEN value <> 0 THEN date END) OVER (PARTITION BY location_id, variable, bucket) AS last_nz FROM
  (SELECT {PK}, CASE WHEN variable = 'error' AND location_id LIKE '%3' THEN 0 WHEN dayofmonth(date) > 20 AND value < 2 THEN 0 ELSE value END AS value FROM evt))"""


def trailing(spark, d):
    zero = ((F.col("variable") == "error") & F.col("location_id").endswith("3")) | ((F.dayofmonth("date") > 20) & (F.col("value") < 2))
    return B.evt(spark, d).withColumn("value", F.when(zero, 0.0).otherwise(F.col("value")))


@query("trim_trailing_zeros", f"WITH {TZ} SELECT {PK}, value FROM tz WHERE date <= last_nz")
def _(spark, d):
    return O.trim_trailing_zeros(trailing(spark, d))


@query("trim_trailing_zeros_keep_all_zero", f"WITH {TZ} SELECT {PK}, value FROM tz WHERE last_nz IS NULL OR date <= last_nz")
def _(spark, d):
    return O.trim_trailing_zeros(trailing(spark, d), drop_all_zero=False)


def gauss_sql(src, half=9, sigma=5.0, n=5, digits=6):
    return f"""WITH {DENSE0.format(src=src)}
SELECT d0.location_id, d0.variable, d0.bucket, d0.date, CASE WHEN COUNT(e.value) >= {n} THEN round(SUM(exp(-0.5 * power((e.date - d0.date) / {sigma}, 2)) * e.value) / SUM(exp(-0.5 * power((e.date - d0.date) / {sigma}, 2))), {digits}) END AS value
FROM d0 LEFT JOIN {src} e ON e.location_id = d0.location_id AND e.variable = d0.variable AND e.bucket = d0.bucket AND e.date BETWEEN d0.date - {half} AND d0.date + {half} GROUP BY 1, 2, 3, 4"""


@query("gaussian_smooth", gauss_sql("evt"))
def _(spark, d):
    return O.gaussian_smooth(L.densify_per_series(B.evt(spark, d))).withColumn("value", F.round("value", 6))


@query("gaussian_smooth_25", gauss_sql("evp", 12, 6.0, 6))
def _(spark, d):
    return O.gaussian_smooth(L.densify_per_series(B.evp(spark, d)), 12, 6.0, 6).withColumn("value", F.round("value", 6))


@query("ewma_smooth", f"""
WITH {DENSE0.format(src='evt')}, k AS (SELECT d, exp(-(5 + d) / 5.0) / SUM(exp(-(5 + d) / 5.0)) OVER () AS w FROM range(-5, 5) r(d))
SELECT location_id, variable, bucket, x.date, round(COALESCE(SUM(k.w * e.value), 0), 8) AS value FROM (SELECT d0.*, k.w, k.d, d0.date + CAST(k.d AS INTEGER) AS src_date FROM d0, k) x
 LEFT JOIN (SELECT location_id AS l, variable AS v, date AS dt, value FROM evt) e ON e.l = x.location_id AND e.v = x.variable AND e.dt = x.src_date, (SELECT 1) AS one(z)
 CROSS JOIN LATERAL (SELECT x.w AS w) AS k GROUP BY 1, 2, 3, 4""")
def _(spark, d):
    return O.ewma_smooth(L.densify_per_series(B.evt(spark, d))).withColumn("value", F.round("value", 8))


@query("best_lag_xcorr", """
WITH w AS (SELECT location_id, date, SUM(value) FILTER (variable = 'view') AS a, SUM(value) FILTER (variable = 'purchase') AS b FROM evp GROUP BY 1, 2),
 lim AS (SELECT location_id, MIN(date) lo, MAX(date) hi FROM evp GROUP BY 1),
 dn AS (SELECT lim.location_id, CAST(t AS DATE) AS date, a, b FROM lim CROSS JOIN generate_series(lo, hi, INTERVAL 1 DAY) g(t) LEFT JOIN w ON w.location_id = lim.location_id AND w.date = CAST(t AS DATE)),
 df AS (SELECT location_id, date, a - LAG(a) OVER (PARTITION BY location_id ORDER BY date) AS da, b - LAG(b) OVER (PARTITION BY location_id ORDER BY date) AS db FROM dn),
 sc AS (SELECT x.location_id, k.lag, SUM(x.da * y.db) / (2 * COUNT(*) - 1) AS score FROM range(-21, 5) k(lag), df x, df y
   WHERE x.location_id = y.location_id AND y.date = x.date - CAST(k.lag AS INTEGER) AND x.da IS NOT NULL AND y.db IS NOT NULL GROUP BY 1, 2)
SELECT location_id, CAST(lag AS INTEGER) AS shift, round(score, 6) AS score FROM sc QUALIFY ROW_NUMBER() OVER (PARTITION BY location_id ORDER BY score DESC, lag) = 1""")
def _(spark, d):
    w = L.to_wide_variables(L.densify_per_series(B.evp(spark, d), by=["location_id"]), ["view", "purchase"], by=["location_id", "date"])
    pairs = w.withColumnsRenamed({"view": "a", "purchase": "b"})
    return O.best_lag_xcorr(pairs).withColumn("score", F.round("score", 6))


def zscore_sql(src="evt", window=10, n=3):
    w = f"OVER ({R(window, 'INTERVAL 1 DAY PRECEDING')})"
    return f"""{spread_ctes(src)}, zx AS (SELECT {PK}, raw, CASE WHEN value <> 0 THEN value END AS x FROM spread),
 zm AS (SELECT *, CASE WHEN MIN(x) {w} = MAX(x) {w} THEN MIN(x) {w} ELSE AVG(x) {w} END AS m, CASE WHEN MIN(x) {w} = MAX(x) {w} THEN 0 ELSE stddev_pop(x) {w} END AS s, COUNT(x) {w} AS n FROM zx),
 z AS (SELECT {PK}, raw, x, CASE WHEN n >= {n} THEN m END AS mean, CASE WHEN n >= {n} THEN s END AS std FROM zm)"""


@query("zscore_modified", f"""
WITH {ZEROS}, {zscore_sql('zer')} SELECT {PK}, round(x, 8) AS x, round(mean, 8) AS mean, round(std, 8) AS std, round(CASE WHEN std > 0 THEN abs(x - mean) / std END, 6) AS score, COALESCE(std = 0 AND x <> mean, false) AS infinite FROM z""")
def _(spark, d):
    z = O.modified_zscore(zeros(spark, d))
    score = F.when(F.col("std") > 0, F.abs(F.col("x") - F.col("mean")) / F.col("std"))
    infinite = F.coalesce((F.col("std") == 0) & (F.col("x") != F.col("mean")), F.lit(False))
    return z.select(*POINT, *[F.round(c, 8).alias(c) for c in ("x", "mean", "std")], F.round(score, 6).alias("score"), infinite.alias("infinite"))


@query("shift_rows", "SELECT location_id, variable, bucket, date + 7 AS date, value FROM obs")
def _(spark, d):
    return O.shift_days(B.obs(spark, d), 7)


@query("diff_n", f"SELECT a.location_id, a.variable, a.bucket, a.date, a.value - b.value AS value FROM evtcum a JOIN evtcum b ON a.location_id = b.location_id AND a.variable = b.variable AND b.date = a.date - 7")
def _(spark, d):
    return O.diff_days(B.evtcum(spark, d), 7)


@query("second_difference", "SELECT a.location_id, a.variable, a.bucket, a.date, a.value - 2 * b.value + c.value AS value FROM evp a JOIN evp b ON a.location_id = b.location_id AND a.variable = b.variable AND b.date = a.date - 1 JOIN evp c ON a.location_id = c.location_id AND a.variable = c.variable AND c.date = a.date - 2")
def _(spark, d):
    return O.second_difference(B.evp(spark, d))


@query("keep_last_per_key", "SELECT user_id, event_type, arg_max(value, ts) AS value, arg_max(event_id, ts) AS event_id FROM events GROUP BY 1, 2")
def _(spark, d):
    e = B.table(spark, d, "events").select("user_id", "event_type", "ts", "value", "event_id")
    return O.keep_last(e, ["user_id", "event_type"], "ts").drop("ts")


@query("keep_first_per_key", "SELECT user_id, event_type, arg_min(value, ts) AS value, arg_min(event_id, ts) AS event_id FROM events GROUP BY 1, 2")
def _(spark, d):
    e = B.table(spark, d, "events").select("user_id", "event_type", "ts", "value", "event_id")
    return O.keep_last(e, ["user_id", "event_type"], "ts", first=True).drop("ts")


@query("most_recent_date", "SELECT location_id, variable, bucket, MAX(date) AS most_recent FROM evt GROUP BY 1, 2, 3")
def _(spark, d):
    return O.most_recent_date(B.evt(spark, d))


@query("ecdf_by_total", """
WITH t AS (SELECT o_custkey, SUM(CAST(round(o_totalprice * 100) AS BIGINT)) AS total FROM orders GROUP BY 1)
SELECT DISTINCT total, round(cume_dist() OVER (ORDER BY total), 9) AS share FROM t""")
def _(spark, d):
    t = B.table(spark, d, "orders").groupBy("o_custkey").agg(F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("total"))
    return O.ecdf(t, "total").withColumn("share", F.round("share", 9))
