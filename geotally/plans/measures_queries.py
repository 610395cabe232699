"""Queries for derived measures and levels."""

import datetime

from pyspark.sql import functions as F

from geotally.functions import tagtext as T
from geotally.model import POINT, SERIES, Dataset
from geotally.operators import levels as LV, measures as O
from geotally.operators.tags import make_tags
from geotally.plans import bindings as B
from geotally.plans.catalog import query
from geotally.plans.rollups_queries import rounded
from geotally.plans.windows_queries import INTERP, P, PK, R, ZEROS, spread_ctes, zeros

D = datetime.date
AS_OF = D(2024, 1, 30)
LD = "PARTITION BY location_id ORDER BY date"
LR = lambda n, to="CURRENT ROW": f"{LD} RANGE BETWEEN INTERVAL {n} DAYS PRECEDING AND {to}"


def user_dataset(spark, d, obs):
    return Dataset(obs, B.ustatic(spark, d), B.tags(spark, d).limit(0))


NAMES = {
    "click": "vaccinations_initiated", "purchase": "vaccinations_initiated_pct", "view": "vaccinations_completed",
    "signup": "vaccinations_completed_pct",
}
VACC = "va AS (SELECT location_id, CASE variable " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in NAMES.items()) + " END AS variable, bucket, date, value FROM evtcum WHERE variable <> 'error')"


@query("vaccine_pct", f"""
WITH {VACC}, b AS (SELECT location_id, variable || '_pct' AS variable, bucket, date, value / population * 100 AS value, 0 AS given FROM va JOIN upop USING (location_id) WHERE variable NOT LIKE '%pct'
  UNION ALL SELECT *, 1 FROM va WHERE variable LIKE '%pct'), l AS (SELECT location_id, variable, given, MAX(date) AS last FROM b GROUP BY 1, 2, 3),
 w AS (SELECT location_id, variable, arg_max(given, (last, given)) AS given FROM l GROUP BY 1, 2)
SELECT * FROM va WHERE variable NOT LIKE '%pct' UNION ALL SELECT location_id, variable, bucket, date, round(least(value, 95), 9) FROM b SEMI JOIN w USING (location_id, variable, given)""")
def _(spark, d):
    obs = O.rename_variable(B.evtcum(spark, d), NAMES)
    return rounded(O.vaccine_pct(user_dataset(spark, d, obs)), n=9)


@query("estimate_from_parent_ratio", f"""
WITH a AS (SELECT * FROM evtcum WHERE variable IN ('click', 'view') UNION ALL SELECT * FROM evcum WHERE variable IN ('click', 'view')),
 r AS (SELECT location_id FROM evtcum WHERE date BETWEEN DATE '2024-01-25' AND DATE '2024-01-30' GROUP BY 1 HAVING bool_or(variable = 'view') AND NOT bool_or(variable = 'click')),
 q AS (SELECT c.location_id AS parent_id, c.date, c.value / k.value AS ratio FROM evcum c JOIN evcum k ON c.location_id = k.location_id AND c.date = k.date WHERE c.variable = 'click' AND k.variable = 'view'),
 e AS (SELECT x.location_id, 'click' AS variable, 'all' AS bucket, x.date, x.value * q.ratio AS est FROM evtcum x JOIN r USING (location_id) JOIN uparent USING (location_id) JOIN q USING (parent_id, date) WHERE variable = 'view')
SELECT 'obs' AS kind, {PK}, round(COALESCE(est, value), 9) AS value FROM a FULL JOIN e USING ({PK}) UNION ALL SELECT 'tag', location_id, 'click', 'all', NULL, NULL FROM r""")
def _(spark, d):
    keep = F.col("variable").isin("click", "view")
    obs = B.evtcum(spark, d).unionByName(B.evcum(spark, d)).filter(keep)
    out = O.estimate_from_parent_ratio(user_dataset(spark, d, obs), B.uparent(spark, d), "click", "view", AS_OF, "estimate", 5)
    tags = out.tags.select(F.lit("tag").alias("kind"), *SERIES, F.lit(None).cast("date").alias("date"), F.lit(None).cast("double").alias("value"))
    return rounded(out.obs.select(F.lit("obs").alias("kind"), *POINT, "value").unionByName(tags), n=9)


@query("estimate_pct_from_parent_ratio", f"""
WITH a AS (SELECT * FROM evtcum WHERE variable = 'view' UNION ALL SELECT * FROM evcum WHERE variable IN ('click', 'purchase', 'view')),
 w AS (SELECT location_id AS parent_id, date, MAX(value) FILTER (variable = 'view') AS adm, MAX(value) FILTER (variable = 'click') AS c, MAX(value) FILTER (variable = 'purchase') AS p FROM evcum GROUP BY 1, 2),
 e AS (SELECT x.location_id, x.bucket, x.date, x.value * (c / adm) / population * 100 AS ec, x.value * (p / adm) / population * 100 AS ep FROM evtcum x JOIN uparent USING (location_id) JOIN w USING (parent_id, date) JOIN upop USING (location_id) WHERE variable = 'view')
SELECT {PK}, round(value, 9) AS value FROM (SELECT * FROM a UNION ALL SELECT location_id, 'click_pct', bucket, date, ec FROM e WHERE ec IS NOT NULL UNION ALL SELECT location_id, 'purchase_pct', bucket, date, ep FROM e WHERE ep IS NOT NULL)""")
def _(spark, d):
    obs = B.evtcum(spark, d).filter("variable = 'view'").unionByName(B.evcum(spark, d).filter(F.col("variable").isin("click", "purchase", "view")))
    ds = user_dataset(spark, d, obs)
    return rounded(O.estimate_pct_from_parent_ratio(ds, B.uparent(spark, d), "view", {"click": "click_pct", "purchase": "purchase_pct"}), n=9)


POS = f"""pv AS (SELECT * FROM evtcum WHERE variable IN ('purchase', 'view')), {INTERP.format(src='pv')}, dd AS (SELECT *, value - LAG(value) OVER ({P}) AS v FROM interp),
 nz AS (SELECT *, MAX(date) FILTER (v <> 0) OVER (PARTITION BY location_id, variable) AS last_nz FROM dd WHERE v >= 0),
 sm AS (SELECT location_id, variable, date, last_nz, AVG(v) OVER ({R(6)}) AS value FROM nz),
 en AS (SELECT location_id, variable, MAX(date) AS e FROM interp GROUP BY 1, 2), ps AS (SELECT * FROM sm WHERE variable = 'purchase'), ns AS (SELECT * FROM sm WHERE variable = 'view' AND (last_nz IS NULL OR date <= last_nz)),
 sk AS (SELECT location_id FROM (SELECT ps.location_id, COUNT(*) FILTER (e - date < 7 AND value = 0) AS zeros FROM ps JOIN en USING (location_id, variable) GROUP BY 1) LEFT JOIN
   (SELECT ns.location_id, COUNT(*) FILTER (e - date < 7) AS n FROM ns JOIN en USING (location_id, variable) GROUP BY 1) USING (location_id) WHERE zeros < 7 AND COALESCE(n, 0) = 0),
 pos AS (SELECT ps.location_id, ps.date, ps.value / (ns.value + ps.value) AS value FROM ps JOIN ns USING (location_id, date) WHERE ns.value + ps.value <> 0 AND ps.location_id NOT IN (SELECT location_id FROM sk))"""


@query("positivity_smoothed", f"WITH {POS} SELECT location_id, date, round(value, 9) AS value FROM pos")
def _(spark, d):
    x = B.evtcum(spark, d)
    return rounded(O.positivity_smoothed(x.filter("variable = 'purchase'"), x.filter("variable = 'view'")), n=9)


METHODS_SQL = f"""{POS}, dl AS (SELECT a.location_id, a.date, MAX(a.value - b.value) FILTER (a.variable = 'click') / NULLIF(MAX(a.value - b.value) FILTER (a.variable = 'error'), 0) AS value FROM evtcum a
  JOIN evtcum b ON a.location_id = b.location_id AND a.variable = b.variable AND b.date = a.date - 7 GROUP BY 1, 2),
 ri AS (SELECT location_id FROM evtcum WHERE variable IN ('purchase', 'view') AND date >= DATE '2024-01-20' AND value > 0 GROUP BY 1 HAVING COUNT(DISTINCT variable) = 2),
 pt AS (SELECT location_id, date, value FROM evtcum WHERE variable = 'signup'),
 m AS (SELECT location_id, date, value, 'SmoothedTests' AS method, 0 AS prio, location_id IN (SELECT location_id FROM ri) AS recent FROM pos
  UNION ALL SELECT location_id, date, value, 'Given', 1, MAX(date) OVER (PARTITION BY location_id) >= DATE '2024-01-28' FROM pt
  UNION ALL SELECT location_id, date, value, 'Delta', 2, MAX(date) OVER (PARTITION BY location_id) >= DATE '2024-01-17' FROM dl WHERE value IS NOT NULL)"""


def methods():
    return [
        O.Method("SmoothedTests", ["purchase", "view"], O.smoothed_tests("purchase", "view"), 10, True),
        O.Method("Given", ["signup"], O.pass_through("signup"), 3),
        O.Method("Delta", ["click", "error"], O.division("click", "error")),
    ]


@query("test_positivity_methods", f"WITH {METHODS_SQL} SELECT location_id, date, round(value, 9) AS value, method, prio, recent FROM m")
def _(spark, d):
    return rounded(O.positivity_methods(B.evtcum(spark, d), AS_OF, methods()), n=9)


@query("test_positivity_best", f"""
WITH {METHODS_SQL}, r AS (SELECT *, CASE WHEN recent THEN prio WHEN method = 'SmoothedTests' THEN 99 END AS rk FROM m), b AS (SELECT location_id, MIN(rk) AS rk FROM r GROUP BY 1)
SELECT location_id, date, round(value, 9) AS value, method FROM r JOIN b USING (location_id, rk)""")
def _(spark, d):
    return rounded(O.positivity_best(O.positivity_methods(B.evtcum(spark, d), AS_OF, methods())), n=9)


@query("test_positivity_tags", f"""
WITH {METHODS_SQL}, r AS (SELECT *, CASE WHEN recent THEN prio WHEN method = 'SmoothedTests' THEN 99 END AS rk FROM m), b AS (SELECT DISTINCT location_id, arg_min(method, rk) AS method FROM r WHERE rk IS NOT NULL GROUP BY 1),
 cols AS (SELECT * FROM (VALUES ('SmoothedTests', 'purchase'), ('SmoothedTests', 'view'), ('Given', 'signup'), ('Delta', 'click'), ('Delta', 'error')) AS v(method, variable))
SELECT DISTINCT location_id, 'test_positivity' AS variable, 'all' AS bucket, 'provenance' AS tag_type, CASE WHEN t.variable IN ('click', 'error') THEN 'both' ELSE t.variable END AS content
FROM b JOIN cols USING (method) JOIN (SELECT DISTINCT location_id, variable FROM evt) t USING (location_id, variable)""")
def _(spark, d):
    x = B.evt(spark, d).select(*SERIES).distinct()
    tags = make_tags(x, T.PROVENANCE, F.when(F.col("variable").isin("click", "error"), "both").otherwise(F.col("variable")))
    return O.positivity_tags(tags, O.positivity_best(O.positivity_methods(B.evtcum(spark, d), AS_OF, methods())), methods())


@query("test_positivity_provenance", """
SELECT location_id, CASE WHEN COUNT(DISTINCT content) = 1 AND MAX(content) IN ('src_P', 'src_O') THEN MAX(content) ELSE 'other' END AS source
FROM tags WHERE tag_type = 'provenance' AND (location_id NOT LIKE '%7' OR content = 'src_P') AND (location_id NOT LIKE '%8' OR content = 'src_F') GROUP BY 1""")
def _(spark, d):
    loc, c = F.col("location_id"), F.col("content")
    t = B.tags(spark, d).filter(
        "tag_type = 'provenance'").filter((~loc.endswith("7") | (c == "src_P")) & (~loc.endswith("8") | (c == "src_F")))
    return O.positivity_provenance(t, ["src_P", "src_O"])


def density_sql(name="cden", var="click"):
    return f"""cz AS (SELECT * FROM zer WHERE variable = '{var}'), {spread_ctes('cz')}, fd AS (SELECT location_id, MIN(date) AS first FROM evt GROUP BY 1),
 tr AS (SELECT *, MAX(date) FILTER (value <> 0) OVER (PARTITION BY location_id) AS lz, MIN(date) OVER (PARTITION BY location_id) AS fv FROM spread),
 cut AS (SELECT {PK}, value FROM tr WHERE lz IS NULL OR date <= lz),
 lead0 AS (SELECT x.location_id, '{var}' AS variable, 'all' AS bucket, CAST(t AS DATE) AS date, 0 AS value FROM (SELECT location_id, MIN(date) AS fv FROM cut GROUP BY 1) x JOIN fd USING (location_id), generate_series(first, fv - 1, INTERVAL 1 DAY) g(t)),
 {name} AS (SELECT c.location_id, c.variable, c.bucket, c.date, AVG(c.value) OVER (PARTITION BY c.location_id ORDER BY c.date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) / (population / 100000) AS value
   FROM (SELECT * FROM cut UNION ALL SELECT * FROM lead0) c JOIN upop USING (location_id))"""


def first_days(spark, d):
    return B.evt(spark, d).groupBy("location_id").agg(F.min("date").alias("first"))


def density(spark, d):
    return O.case_density(zeros(spark, d).filter("variable = 'click'"), B.upop(spark, d), first_days(spark, d))


@query("case_density", f"WITH {ZEROS}, {density_sql()} SELECT {PK}, round(value, 6) AS value FROM cden")
def _(spark, d):
    return rounded(density(spark, d))


@query("contact_tracer_ratio", f"""
WITH cz AS (SELECT * FROM evp WHERE variable = 'click'), sm AS (SELECT location_id, date, AVG(value) OVER ({R(6)}) AS s FROM cz)
SELECT location_id, date, round(t.value / (s * 5), 9) AS value FROM (SELECT * FROM evp WHERE variable = 'error') t JOIN sm USING (location_id, date)""")
def _(spark, d):
    x = B.evp(spark, d)
    return rounded(O.contact_tracer_ratio(x.filter("variable = 'click'"), x.filter("variable = 'error'")), n=9)


WIDE = "w AS (SELECT location_id, date, " + ", ".join(f"SUM(value) FILTER (variable = '{v}') AS {v}" for v in ("click", "error", "purchase", "signup", "view")) + " FROM evt GROUP BY 1, 2)"


def wide_with(spark, d, names):
    from geotally.operators.layout import to_wide_variables

    w = to_wide_variables(B.evt(spark, d), ["click", "error", "purchase", "signup", "view"], ["location_id", "date"])
    return w.select("location_id", "date", *[F.expr(e).cast("double").alias(n) for n, e in names.items()])


@query("icu_capacity_ratio", f"WITH {WIDE} SELECT location_id, date, round(click / (view - 1), 9) AS value FROM w WHERE view <> 1 AND click IS NOT NULL")
def _(spark, d):
    x = wide_with(spark, d, {"current_icu_total": "click", "icu_beds": "view - 1"})
    return rounded(x.select("location_id", "date", O.icu_capacity_ratio(x).alias("value")).filter("value is not null"), n=9)


COUNTY = "location_id LIKE '%1'"


@query("covid_patient_ratio", f"WITH {WIDE} SELECT location_id, date, round(COALESCE(error, CASE WHEN {COUNTY} THEN click / view ELSE purchase / signup END), 9) AS value FROM w")
def _(spark, d):
    x = wide_with(spark, d, {
        "beds_with_covid_patients_ratio_hsa": "error", "current_hospitalized_hsa": "click", "staffed_beds_hsa": "view",
        "current_hospitalized": "purchase", "staffed_beds": "signup",
    })
    return rounded(x.select("location_id", "date", O.covid_patient_ratio(F.col("location_id").endswith("1")).alias("value")), n=9)


@query("weekly_admissions_per_100k", f"WITH {WIDE} SELECT location_id, date, round(COALESCE(error, CASE WHEN {COUNTY} THEN click / (population * 10 / 100000) ELSE purchase / (population / 100000) END), 6) AS value FROM w JOIN upop USING (location_id)")
def _(spark, d):
    x = wide_with(spark, d, {
        "weekly_new_hospital_admissions_covid_per_100k_hsa": "error", "weekly_new_hospital_admissions_covid_hsa": "click",
        "weekly_new_hospital_admissions_covid": "purchase",
    }).join(B.upop(spark, d), "location_id").withColumn("hsa_population", F.col("population") * 10)
    return rounded(x.select("location_id", "date", O.weekly_admissions_per_100k(F.col("location_id").endswith("1")).alias("value")))


@query("metrics_timeseries", f"""
WITH {ZEROS}, {density_sql()}, {WIDE}, {POS}
SELECT w.location_id, w.date, round_even(cden.value, 1) AS "caseDensity", round_even(cden.value * 7, 1) AS "weeklyNewCasesPer100k", round_even(pos.value, 3) AS "testPositivityRatio",
 round_even(CASE WHEN signup <> 0 THEN view / signup END, 2) AS "icuCapacityRatio" FROM w LEFT JOIN cden USING (location_id, date) LEFT JOIN pos USING (location_id, date)""")
def _(spark, d):
    x = wide_with(spark, d, {"current_icu_total": "view", "icu_beds": "signup"})
    den = density(spark, d)
    ev = B.evtcum(spark, d)
    pos = O.positivity_smoothed(ev.filter("variable = 'purchase'"), ev.filter("variable = 'view'"))
    return O.metrics_timeseries(
        x, {"caseDensity": den, "testPositivityRatio": pos}, {"icuCapacityRatio": O.icu_capacity_ratio(x)}, {"weeklyNewCasesPer100k": ("caseDensity", 7)})


LM = ["caseDensity", "testPositivityRatio", "infectionRate", "infectionRateCI90", "vaccinationsInitiatedRatio"]


def latest_sql():
    cols, sel = [], []
    for m in LM:
        cols += [f'arg_max("{m}", date) FILTER ("{m}" IS NOT NULL) AS v_{m}', f'MAX(date) FILTER ("{m}" IS NOT NULL) AS d_{m}']
    for m in LM:
        if m == "vaccinationsInitiatedRatio":
            sel.append(f'v_{m} AS "{m}"')
        elif m.startswith("infection"):
            sel.append(f'CASE WHEN d_infectionRate IS NULL THEN NULL WHEN d_infectionRate <= hi - 15 THEN NULL ELSE r."{m}" END AS "{m}"')
        else:
            sel.append(f'CASE WHEN d_{m} > hi - 15 THEN v_{m} END AS "{m}"')
    return f"""WITH a AS (SELECT location_id, MAX(date) AS hi, {', '.join(cols)} FROM mw GROUP BY 1) SELECT a.location_id, {', '.join(sel)} FROM a LEFT JOIN mw r ON r.location_id = a.location_id AND r.date = d_infectionRate - 7"""


@query("latest_metrics", latest_sql())
def _(spark, d):
    return O.latest_metrics(B.mw(spark, d), LM)


def risk_sql(col, limits):
    return f"CASE WHEN {col} IS NULL THEN 4 " + " ".join(f"WHEN {col} <= {x} THEN {i}" for i, x in enumerate(limits)) + (" ELSE 3 END" if len(limits) == 3 else " ELSE 5 END")


CD, TP, RT = risk_sql('"caseDensity"', [1, 10, 25, 75]), risk_sql('"testPositivityRatio"', [0.03, 0.1, 0.2]), risk_sql('"infectionRate"', [0.9, 1.1, 1.4])
OVERALL = "CASE WHEN cd IN (0, 4) THEN cd WHEN 5 IN (cd, tp, rt) THEN 5 WHEN 3 IN (cd, tp, rt) THEN 3 WHEN 2 IN (cd, tp, rt) THEN 2 WHEN 1 IN (cd, tp, rt) THEN 1 WHEN 4 IN (cd, tp, rt) THEN 4 ELSE 0 END"


@query("risk_levels", f"""
SELECT location_id, date, {CD} AS cd, {TP} AS tp, {RT} AS rt, {risk_sql('"icuCapacityRatio"', [0.7, 0.8, 0.85])} AS icu,
 CASE WHEN "contactTracerCapacityRatio" > 0.9 THEN 0 WHEN "contactTracerCapacityRatio" > 0.1 THEN 1 WHEN "contactTracerCapacityRatio" >= 0 THEN 2 ELSE 4 END AS ct FROM mw""")
def _(spark, d):
    x = LV.risk_columns(B.mw(spark, d))
    names = {"cd": "caseDensity", "tp": "testPositivityRatio", "rt": "infectionRate", "icu": "icuCapacityRatio", "ct": "contactTracerCapacityRatio"}
    return x.select("location_id", "date", *[F.col(f"{m}_risk").alias(n) for n, m in names.items()])


@query("risk_overall", f"SELECT location_id, date, {OVERALL} AS overall FROM (SELECT location_id, date, {CD} AS cd, {TP} AS tp, {RT} AS rt FROM mw)")
def _(spark, d):
    return LV.risk_columns(B.mw(spark, d)).select("location_id", "date", "overall")


def carry_sql(*cols, src="mw"):
    return ", ".join(f'last_value("{c}" IGNORE NULLS) OVER ({LR(14)}) AS "{c}"' for c in cols)


@query("risk_timeseries", f"""
WITH s AS (SELECT location_id, date, "caseDensity", "testPositivityRatio", FIRST_VALUE("infectionRate") OVER ({LR(7, 'INTERVAL 7 DAYS PRECEDING')}) AS "infectionRate" FROM mw),
 c AS (SELECT location_id, date, {carry_sql('caseDensity', 'testPositivityRatio', 'infectionRate')} FROM s), l AS (SELECT location_id, date, {CD} AS cd, {TP} AS tp, {RT} AS rt FROM c)
SELECT location_id, date, {OVERALL} AS overall, cd AS "caseDensity" FROM l""")
def _(spark, d):
    return LV.risk_timeseries(B.mw(spark, d))


def trans_sql(col, limits):
    return f"CASE WHEN {col} IS NULL THEN 4 " + " ".join(f"WHEN {col} < {x} THEN {i}" for i, x in enumerate(limits)) + " ELSE 3 END"


TC, TT = trans_sql('"caseDensity"', ["10 / 7.0", "50 / 7.0", "100 / 7.0"]), trans_sql('"testPositivityRatio"', [0.05, 0.08, 0.1])
TOTAL = "CASE WHEN 3 IN (a, b) THEN 3 WHEN 2 IN (a, b) THEN 2 WHEN 1 IN (a, b) THEN 1 WHEN 0 IN (a, b) THEN 0 ELSE 4 END"


@query("transmission_level", f"SELECT location_id, date, {TOTAL} AS level FROM (SELECT location_id, date, {TC} AS a, {TT} AS b FROM mw)")
def _(spark, d):
    return B.mw(spark, d).select("location_id", "date", LV.transmission_level(F.col("caseDensity"), F.col("testPositivityRatio")).alias("level"))


@query("transmission_level_timeseries", f"""
WITH c AS (SELECT location_id, date, {carry_sql('caseDensity', 'testPositivityRatio')} FROM mw) SELECT location_id, date, {TOTAL} AS "cdcTransmissionLevel" FROM (SELECT location_id, date, {TC} AS a, {TT} AS b FROM c)""")
def _(spark, d):
    return LV.transmission_timeseries(B.mw(spark, d))


COMM = """CASE WHEN "bedsWithCovidPatientsRatio" IS NULL AND "weeklyCovidAdmissionsPer100k" IS NULL THEN NULL WHEN COALESCE("weeklyNewCasesPer100k", 0) < 200 THEN
  CASE WHEN COALESCE("weeklyCovidAdmissionsPer100k", 0) < 10 AND COALESCE("bedsWithCovidPatientsRatio", 0) < 0.1 THEN 0 WHEN COALESCE("weeklyCovidAdmissionsPer100k", 0) >= 20 OR COALESCE("bedsWithCovidPatientsRatio", 0) >= 0.15 THEN 2 ELSE 1 END
  WHEN COALESCE("weeklyCovidAdmissionsPer100k", 0) < 10 AND COALESCE("bedsWithCovidPatientsRatio", 0) < 0.1 THEN 1 ELSE 2 END"""
CNAMES = ["weeklyNewCasesPer100k", "bedsWithCovidPatientsRatio", "weeklyCovidAdmissionsPer100k"]


@query("community_level", f"SELECT location_id, date, {COMM} AS level FROM mw")
def _(spark, d):
    return B.mw(spark, d).select("location_id", "date", LV.community_level(*[F.col(c) for c in CNAMES]).alias("level"))


CTS = f"""c AS (SELECT location_id, date, {carry_sql(*CNAMES)} FROM mw), ct AS (SELECT location_id, date, {COMM} AS "ownCommunityLevel", e."cdcCommunityLevel" FROM c
  FULL JOIN (SELECT location_id, date, CAST(value AS INTEGER) % 3 AS "cdcCommunityLevel" FROM evt WHERE variable = 'error') e USING (location_id, date))"""


def community(spark, d):
    ext = B.evt(spark, d).filter("variable = 'error'").withColumn("value", F.col("value") % 3)
    return LV.community_timeseries(B.mw(spark, d), ext)


@query("community_level_timeseries", f"WITH {CTS} SELECT * FROM ct")
def _(spark, d):
    return community(spark, d)


@query("community_level_latest", f"""
WITH {CTS}, l AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY location_id ORDER BY date DESC) AS rn FROM ct)
SELECT location_id, MAX("ownCommunityLevel") FILTER (rn = 1) AS "ownCommunityLevel", arg_max("cdcCommunityLevel", date) FILTER ("cdcCommunityLevel" IS NOT NULL) AS "cdcCommunityLevel" FROM l GROUP BY 1""")
def _(spark, d):
    return LV.community_latest(community(spark, d))


@query("testing_corrected_cases", f"""
WITH t AS (SELECT p.location_id, p.date, p.value AS positive, n.value AS negative FROM (SELECT * FROM evcum WHERE variable = 'purchase') p JOIN (SELECT * FROM evcum WHERE variable = 'view') n USING (location_id, date)),
 a AS (SELECT *, positive / (positive + negative) AS rate, COALESCE(positive - LAG(positive) OVER ({LD}), 0) AS np, COALESCE(positive + negative - LAG(positive + negative) OVER ({LD}), 0) AS nt, ROW_NUMBER() OVER ({LD}) AS rn FROM t),
 b AS (SELECT *, COALESCE(nt - LAG(nt) OVER ({LD}), 0) * 0.65 * rate AS raw FROM a), k AS (SELECT d, exp(-(5 + d) / 5.0) / SUM(exp(-(5 + d) / 5.0)) OVER () AS wt FROM range(-5, 5) r(d)),
 e AS (SELECT b.location_id, b.date, CASE WHEN any_value(b.np) < 5 THEN 0 ELSE SUM(k.wt * x.raw) END AS expected FROM b CROSS JOIN k JOIN b x ON x.location_id = b.location_id AND x.rn = b.rn + k.d GROUP BY 1, 2)
SELECT c.location_id, c.date, round(greatest(c.value - COALESCE(expected, 0), 0), 6) AS value FROM (SELECT * FROM evp WHERE variable = 'click') c LEFT JOIN e USING (location_id, date)""")
def _(spark, d):
    x = B.evcum(spark, d)
    pick = lambda v, n: x.filter(F.col("variable") == v).select("location_id", "date", F.col("value").alias(n))
    tests = pick("purchase", "positive").join(pick("view", "negative"), ["location_id", "date"])
    cases = B.evp(spark, d).filter("variable = 'click'").select("location_id", "date", "value")
    return rounded(O.testing_corrected_cases(cases, tests))


@query("select_limit_regions", "SELECT location_id, population FROM pop ORDER BY population DESC, location_id LIMIT 10")
def _(spark, d):
    return O.select_regions(B.pop(spark, d).select("location_id", "population"), F.struct(-F.col("population"), "location_id"), 10)


# --- published rows --------------------------------------------------------------------------

from geotally.operators import publish as PB, rollup as RU  # noqa: E402
from geotally.sources import writers as WR  # noqa: E402

FIELDS = {"cases": "click", "deaths": "error", "positive_tests": "purchase", "staffed_beds": "signup", "vaccinations_initiated": "view"}


def actual_wide(spark, d):
    return wide_with(spark, d, FIELDS)


def dotted(df, *names):
    return WR.flatten_struct(df, list(names))


@query("actuals_rows", f"""
WITH {WIDE} SELECT location_id, date, click AS "actuals.cases", error AS "actuals.deaths", purchase AS "actuals.positiveTests", signup AS "actuals.hospitalBeds.capacity",
 CASE WHEN date >= DATE '2024-01-10' THEN view END AS "actuals.vaccinationsInitiated" FROM w""")
def _(spark, d):
    rows = PB.actuals_rows(actual_wide(spark, d), vaccines=D(2024, 1, 10))
    return dotted(rows, "location_id", "date", "actuals.cases", "actuals.deaths", "actuals.positiveTests", "actuals.hospitalBeds.capacity", "actuals.vaccinationsInitiated")


LW = "lw AS (SELECT location_id, " + ", ".join(f"arg_max(value, date) FILTER (variable = '{v}') AS {n}" for n, v in FIELDS.items()) + " FROM evt GROUP BY 1)"


def user_geo(spark, d):
    return B.users(spark, d).select("location_id", F.lit("USA").alias("country"), F.lit("place").alias("level"), "population")


def summary(spark, d):
    latest = RU.latest_values(B.evt(spark, d), ["location_id", "variable"])
    pick = [F.max(F.when(F.col("variable") == v, F.col("value"))).alias(n) for n, v in FIELDS.items()]
    metrics = O.latest_metrics(B.mw(spark, d), LM)
    risks = LV.risk_columns(metrics).select(
        "location_id", "overall", F.col("caseDensity_risk").alias("caseDensity"), F.col("infectionRate_risk").alias("infectionRate"))
    trans = metrics.select("location_id", LV.transmission_level(F.col("caseDensity"), F.col("testPositivityRatio")).alias("cdcTransmissionLevel"))
    return PB.region_summary(user_geo(spark, d), latest.groupBy("location_id").agg(*pick), metrics, risks, trans, LV.community_latest(community(spark, d)))


SUMMARY = f"""lm AS ({latest_sql()}), {LW}, {CTS}, cl AS (SELECT location_id, MAX("ownCommunityLevel") FILTER (rn = 1) AS own, arg_max("cdcCommunityLevel", date) FILTER ("cdcCommunityLevel" IS NOT NULL) AS ext
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY location_id ORDER BY date DESC) AS rn FROM ct) GROUP BY 1), r AS (SELECT *, {CD} AS cd, {TP} AS tp, {RT} AS rt, {TC} AS a, {TT} AS b FROM lm)"""


@query("region_summary", f"""
WITH {SUMMARY} SELECT location_id, population, 'place' AS level, cases AS "actuals.cases", staffed_beds AS "actuals.hospitalBeds.capacity", vaccinations_initiated AS "actuals.vaccinationsInitiated",
 "caseDensity" AS "metrics.caseDensity", "infectionRate" AS "metrics.infectionRate", {OVERALL} AS "riskLevels.overall", cd AS "riskLevels.caseDensity", {TOTAL} AS "cdcTransmissionLevel", own AS "communityLevels.ownCommunityLevel", ext AS "communityLevels.cdcCommunityLevel"
FROM upop JOIN lw USING (location_id) LEFT JOIN r USING (location_id) LEFT JOIN cl USING (location_id)""")
def _(spark, d):
    return dotted(
        summary(spark, d), "location_id", "population", "level", "actuals.cases", "actuals.hospitalBeds.capacity", "actuals.vaccinationsInitiated",
        "metrics.caseDensity", "metrics.infectionRate", "riskLevels.overall", "riskLevels.caseDensity", "cdcTransmissionLevel",
        "communityLevels.ownCommunityLevel", "communityLevels.cdcCommunityLevel")


def day_parts(spark, d):
    return {
        "actuals": PB.actuals_rows(actual_wide(spark, d)).select("location_id", "date", "actuals.*"),
        "metrics": PB.metric_rows(B.mw(spark, d), {"vaccinationsInitiatedRatio": D(2024, 1, 15)}),
        "riskLevels": LV.risk_timeseries(B.mw(spark, d)), "cdcTransmissionLevel": LV.transmission_timeseries(B.mw(spark, d)),
    }


RTS = f"""rs AS (WITH s AS (SELECT location_id, date, "caseDensity", "testPositivityRatio", FIRST_VALUE("infectionRate") OVER ({LR(7, 'INTERVAL 7 DAYS PRECEDING')}) AS "infectionRate" FROM mw),
 c AS (SELECT location_id, date, {carry_sql('caseDensity', 'testPositivityRatio', 'infectionRate')} FROM s) SELECT location_id, date, {OVERALL} AS overall FROM (SELECT location_id, date, {CD} AS cd, {TP} AS tp, {RT} AS rt FROM c))"""


@query("region_timeseries", f"""
WITH {WIDE}, {RTS} SELECT location_id, string_agg(w.date || '=' || COALESCE(CAST(CAST(click AS INTEGER) AS VARCHAR), '-'), ',' ORDER BY w.date) AS cases, string_agg(CAST(overall AS VARCHAR), ',' ORDER BY w.date) AS risks,
 COUNT(m."vaccinationsInitiatedRatio") FILTER (w.date >= DATE '2024-01-15') AS ratios FROM w JOIN rs USING (location_id, date) JOIN mw m USING (location_id, date) GROUP BY 1""")
def _(spark, d):
    x = PB.region_timeseries(user_geo(spark, d), day_parts(spark, d))
    cases = F.transform("actuals", lambda r: F.concat(r["date"].cast("string"), F.lit("="), F.coalesce(r["cases"].cast("int").cast("string"), F.lit("-"))))
    risks = F.transform("riskLevels", lambda r: r["overall"].cast("string"))
    known = F.filter("metrics", lambda r: r["vaccinationsInitiatedRatio"].isNotNull())
    return x.select("location_id", F.array_join(cases, ",").alias("cases"), F.array_join(risks, ",").alias("risks"), F.size(known).cast("bigint").alias("ratios"))


@query("flat_timeseries_rows", f"""
WITH {WIDE}, {RTS} SELECT location_id, population, date, click AS "actuals.cases", m."caseDensity" AS "metrics.caseDensity", overall AS "riskLevels.overall" FROM upop JOIN w USING (location_id) JOIN rs USING (location_id, date) JOIN mw m USING (location_id, date)""")
def _(spark, d):
    rows = PB.flat_rows(user_geo(spark, d), day_parts(spark, d))
    return dotted(rows, "location_id", "population", "date", "actuals.cases", "metrics.caseDensity", "riskLevels.overall")


@query("state_case_summary", """
WITH c AS (SELECT parent_id, location_id, SUM(value) FILTER (variable = 'click') AS cases, SUM(value) FILTER (variable = 'error') AS deaths, MAX(date) AS date FROM evt JOIN uparent USING (location_id) GROUP BY 1, 2)
SELECT parent_id AS state, MAX(date) AS date, SUM(cases) AS cases, SUM(deaths) AS deaths, string_agg(location_id || ':' || CAST(CAST(cases AS INTEGER) AS VARCHAR), ',' ORDER BY location_id) AS counties FROM c GROUP BY 1""")
def _(spark, d):
    of = lambda t: F.sum(F.when(F.col("variable") == t, F.col("value")))
    c = B.evt(spark, d).join(B.uparent(spark, d), "location_id").groupBy(F.col("parent_id").alias("state"), F.col("location_id").alias("fips")).agg(
        of("click").alias("cases"), of("error").alias("deaths"), F.max("date").alias("date"))
    x = PB.state_case_summary(c)
    text = F.transform("counties", lambda r: F.concat(r["fips"], F.lit(":"), r["cases"].cast("int").cast("string")))
    return x.select("state", "date", "cases", "deaths", F.array_join(text, ",").alias("counties"))
