"""Queries for column functions."""

import datetime

from pyspark.sql import functions as F

from geotally.functions import regions as R, scalars as S, tagtext as T
from geotally.model import SERIES
from geotally.plans import bindings as B
from geotally.plans.catalog import query


@query("fips_to_location_id", """
SELECT fx.fips, COALESCE(g.location_id, 'iso1:us#fips:' || fx.fips) AS location_id, fx.n
FROM (SELECT lpad(CAST(location AS VARCHAR), 5, '0') AS fips, COUNT(*) AS n FROM fact GROUP BY 1) fx
LEFT JOIN geo g ON g.fips = fx.fips""")
def _(spark, d):
    per_fips = B.fact(spark, d).groupBy(R.fips_from_int(F.col("location")).alias("fips")).agg(F.count("*").alias("n"))
    return R.fips_to_location_id(per_fips, B.geo(spark, d)).select("fips", "location_id", "n")


@query("location_id_to_fips", """
SELECT o.location_id, g.fips, o.n FROM (SELECT location_id, COUNT(*) AS n FROM (SELECT location_id FROM obs UNION ALL SELECT location_id FROM evt) GROUP BY 1) o
LEFT JOIN geo g USING (location_id)""")
def _(spark, d):
    ids = B.obs(spark, d).select("location_id").unionByName(B.evt(spark, d).select("location_id"))
    return R.location_id_to_fips(ids.groupBy("location_id").agg(F.count("*").alias("n")), B.geo(spark, d)).select(
        "location_id", "fips", "n"
    )


@query("location_level", r"""
SELECT level, COUNT(*) AS n FROM (SELECT CASE
   WHEN length(regexp_extract(location_id, '^iso1:us#.*fips:(\d+)$', 1)) = 2 THEN 'state'
   WHEN length(regexp_extract(location_id, '^iso1:us#.*fips:(\d+)$', 1)) = 3 THEN 'hsa'
   WHEN length(regexp_extract(location_id, '^iso1:us#.*fips:(\d+)$', 1)) = 5 THEN 'county'
   WHEN length(regexp_extract(location_id, '^iso1:us#.*fips:(\d+)$', 1)) = 7 THEN 'place'
   WHEN regexp_full_match(location_id, 'iso1:us#iso2:us-..') THEN 'state'
   WHEN regexp_full_match(location_id, 'iso1:us#cbsa:\d+') THEN 'cbsa'
   WHEN regexp_full_match(location_id, 'iso1:\w\w') THEN 'country'
   WHEN regexp_full_match(location_id, 'iso1:us#hsa:\d+') THEN 'hsa' END AS level
 FROM (SELECT location_id FROM evt UNION ALL SELECT location_id FROM evp UNION ALL SELECT location_id FROM obs
       UNION ALL SELECT location_id FROM geo UNION ALL SELECT parent_id FROM cbsamap)) GROUP BY 1""")
def _(spark, d):
    ids = None
    for part in (B.evt, B.evp, B.obs, B.geo):
        part = part(spark, d).select("location_id")
        ids = part if ids is None else ids.unionByName(part)
    ids = ids.unionByName(B.cbsamap(spark, d).select(F.col("parent_id").alias("location_id")))
    return ids.groupBy(R.location_level(F.col("location_id")).alias("level")).agg(F.count("*").alias("n"))


@query("cbsa_hsa_location_id", """
SELECT location AS code, 'iso1:us#cbsa:' || location AS cbsa_id, 'iso1:us#hsa:' || lpad(CAST(location % 997 AS VARCHAR), 3, '0') AS hsa_id,
  COUNT(*) AS n FROM fact GROUP BY 1, 2, 3""")
def _(spark, d):
    code = F.col("location")
    return B.fact(spark, d).groupBy(
        code.alias("code"), R.cbsa_location_id(code.cast("string")).alias("cbsa_id"),
        R.hsa_location_id(R.hsa_code(code % 997)).alias("hsa_id"),
    ).agg(F.count("*").alias("n"))


@query("region_state", """
SELECT fips, list_extract(['AL','AK',NULL,'AZ','AR'], CAST(substr(fips, 1, 2) AS INTEGER)) AS state,
  CASE WHEN substr(fips, 1, 2) <> '03' THEN 'iso1:us#iso2:us-' || lower(list_extract(['AL','AK',NULL,'AZ','AR'], CAST(substr(fips, 1, 2) AS INTEGER))) END AS state_id, n
FROM (SELECT lpad(CAST(location AS VARCHAR), 5, '0') AS fips, COUNT(*) AS n FROM fact GROUP BY 1)""")
def _(spark, d):
    f = B.fact(spark, d).groupBy(R.fips_from_int(F.col("location")).alias("fips")).agg(F.count("*").alias("n"))
    code = R.state_code_of_fips(F.col("fips"))
    return f.select("fips", code.alias("state"), R.state_location_id(code).alias("state_id"), "n")


@query("state_of_region", """
SELECT c.location_id, c.parent_id, COUNT(*) AS points FROM obs o JOIN parent c USING (location_id) GROUP BY 1, 2""")
def _(spark, d):
    return B.obs(spark, d).groupBy(
        "location_id", R.parent_state_location_id(F.col("location_id")).alias("parent_id")
    ).agg(F.count("*").alias("points"))


@query("state_code_maps", """
SELECT state, CASE state WHEN 'AL' THEN 'Alabama' WHEN 'AK' THEN 'Alaska' WHEN 'AZ' THEN 'Arizona' WHEN 'AR' THEN 'Arkansas'
  ELSE 'California' END AS state_name, sfips, fips LIKE '%999' AS unknown_county, COUNT(*) AS n
FROM (SELECT *, list_extract(['AL','AK','AZ','AR','CA'], CAST(user_id % 5 + 1 AS INTEGER)) AS state,
  list_extract(['01','02','04','05','06'], CAST(user_id % 5 + 1 AS INTEGER)) AS sfips, lpad(CAST(user_id % 5 + 1 AS VARCHAR), 2, '0') || lpad(CAST(990 + user_id % 10 AS VARCHAR), 3, '0') AS fips
  FROM events) GROUP BY 1, 2, 3, 4""")
def _(spark, d):
    u = F.col("user_id")
    state = F.element_at(F.lit(B.REGION_STATES), (u % 5 + 1).cast("int"))
    name = R.state_name_of_code(state)
    fips = R.fips_from_int(((u % 5 + 1) * 1000 + 990 + u % 10).cast("int"))
    return B.table(spark, d, "events").groupBy(
        R.state_code_of_name(name).alias("state"), name.alias("state_name"), R.state_fips_of_code(state).alias("sfips"),
        R.is_unknown_county(fips).alias("unknown_county"),
    ).agg(F.count("*").alias("n"))


@query("fips_from_int", """
SELECT o_orderkey % 60000 AS number, CASE WHEN o_orderkey % 60000 = 0 THEN '0' WHEN o_orderkey % 60000 < 100 THEN lpad(CAST(o_orderkey % 60000 AS VARCHAR), 2, '0')
  ELSE lpad(CAST(o_orderkey % 60000 AS VARCHAR), 5, '0') END AS fips, COUNT(*) AS n FROM orders GROUP BY 1, 2""")
def _(spark, d):
    number = F.col("o_orderkey") % 60000
    return B.table(spark, d, "orders").groupBy(number.alias("number"), R.fips_from_int(number).alias("fips")).agg(
        F.count("*").alias("n")
    )


@query("bucket_short_name", """
SELECT bucket, COUNT(*) AS n FROM (SELECT CASE WHEN age = 'all' AND sex = 'all' THEN 'all'
  WHEN age = 'all' THEN 'sex:' || sex WHEN sex = 'all' THEN 'age:' || age ELSE 'age;sex:' || age || ';' || sex END AS bucket FROM fact) GROUP BY 1""")
def _(spark, d):
    name = S.bucket_name({c: F.col(c) for c in ("age", "race", "ethnicity", "sex")})
    return B.fact(spark, d).groupBy(name.alias("bucket")).agg(F.count("*").alias("n"))


@query("bucket_distribution", """
SELECT split_part(bucket, ':', 1) AS distribution, CASE WHEN contains(bucket, ':') THEN split_part(bucket, ':', 2) ELSE 'all' END AS name,
  COUNT(*) AS n, round(SUM(value), 2) AS total FROM obsb GROUP BY 1, 2""")
def _(spark, d):
    b = F.col("bucket")
    return B.obsb(spark, d).groupBy(S.bucket_distribution(b).alias("distribution"), S.bucket_member(b).alias("name")).agg(
        F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total")
    )


@query("strip_whitespace", """
SELECT c_custkey, trim('  ' || c_name || ' ') AS c_name, trim(c_mktsegment || '   ') AS c_mktsegment, c_acctbal FROM customer""")
def _(spark, d):
    c = B.table(spark, d, "customer")
    padded = c.select(
        "c_custkey", F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("c_name"),
        F.concat("c_mktsegment", F.lit("   ")).alias("c_mktsegment"), "c_acctbal",
    )
    return S.strip_whitespace(padded)


@query("parse_county_state", """
SELECT c_custkey, n_name AS county, st.state FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN st ON n_regionkey = r_regionkey""")
def _(spark, d):
    c = B.table(spark, d, "customer").join(
        B.counties(spark, d).select("nationkey", "name", "state"), F.col("c_nationkey") == F.col("nationkey")
    )
    text = F.concat("name", F.lit(" , "), R.state_name_of_code(F.col("state")), F.lit(" "))
    county, state = S.split_county_state(text)
    return c.select("c_custkey", county.alias("county"), R.state_code_of_name(state).alias("state"))


@query("tag_json_encode", """
WITH x AS (SELECT event_type AS t, CAST(ts AS DATE) AS dt, value, event_id FROM events)
SELECT event_id, '{"type":"' || t || '","url":"http://e/' || t || '"}' AS source,
  '{"date": "' || dt || '", "original_observation": ' || value || '}' AS dated,
  '{"public_note":"late ' || t || '","date":"' || dt || '"}' AS issue, '{"public_note":"late ' || t || '"}' AS issue_no_date,
  '{"f":"' || t || '"}' AS derived, '{"after":"' || dt || '"}' AS future FROM x""")
def _(spark, d):
    t, dt = F.col("event_type"), F.to_date("ts")
    note = F.concat(F.lit("late "), t)
    return B.table(spark, d, "events").select(
        "event_id", T.source_content(t, F.concat(F.lit("http://e/"), t), F.lit("")).alias("source"),
        T.dated_content(dt, F.col("value")).alias("dated"), T.known_issue_content(note, dt).alias("issue"),
        T.known_issue_content(note).alias("issue_no_date"), T.derived_content(t).alias("derived"),
        T.drop_future_content(dt).alias("future"),
    )


@query("tag_json_decode", """
SELECT event_id, kind AS tag_type, CASE kind WHEN 'source' THEN event_type END AS type, CASE WHEN kind = 'source' THEN 'http://e/' || event_type END AS url,
  CASE WHEN kind = 'provenance' THEN event_type END AS name,
  CASE WHEN kind IN ('zscore_outlier', 'known_issue') THEN CAST(ts AS DATE) END AS date,
  CASE WHEN kind = 'zscore_outlier' THEN value END AS original_observation,
  CASE WHEN kind = 'known_issue' THEN 'old ' || event_type END AS public_note
FROM (SELECT *, CASE user_id % 4 WHEN 0 THEN 'source' WHEN 1 THEN 'provenance' WHEN 2 THEN 'zscore_outlier' ELSE 'known_issue' END AS kind FROM events)""")
def _(spark, d):
    t, dt, u = F.col("event_type"), F.to_date("ts"), F.col("user_id") % 4
    kind = F.when(u == 0, T.SOURCE).when(u == 1, T.PROVENANCE).when(u == 2, T.ZSCORE).otherwise(T.KNOWN_ISSUE)
    legacy = F.to_json(F.struct(F.concat(F.lit("old "), t).alias("disclaimer"), dt.cast("string").alias("date")))
    content = (
        F.when(u == 0, T.source_content(t, F.concat(F.lit("http://e/"), t))).when(u == 1, t)
        .when(u == 2, T.dated_content(dt, F.col("value"))).otherwise(legacy)
    )
    tagged = B.table(spark, d, "events").select("event_id", kind.alias("tag_type"), content.alias("content"))
    x = tagged.withColumn("x", T.decode(F.col("tag_type"), F.col("content")))
    return x.select("event_id", "tag_type", "x.type", "x.url", "x.name", "x.date", "x.original_observation", "x.public_note")


@query("days_since_ref", """
SELECT o_orderkey, date_diff('day', DATE '2020-01-01', CAST(o_orderdate AS DATE)) AS day_number FROM orders""")
def _(spark, d):
    return B.table(spark, d, "orders").select("o_orderkey", S.days_since_ref(F.to_date("o_orderdate")).cast("bigint").alias("day_number"))


@query("round_metrics", """
SELECT l_orderkey, l_linenumber, round_even(l_extendedprice / 700, 1) AS "caseDensity", round_even(l_quantity / 51, 3) AS "testPositivityRatio",
  round_even(l_quantity / 7, 2) AS "infectionRate" FROM lineitem""")
def _(spark, d):
    return S.round_metrics(B.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_extendedprice") / 700).alias("caseDensity"),
        (F.col("l_quantity") / 51).alias("testPositivityRatio"), (F.col("l_quantity") / 7).alias("infectionRate"),
    ))


@query("clip_nonneg", """SELECT c_custkey, greatest(c_acctbal, 0) AS balance FROM customer""")
def _(spark, d):
    return B.table(spark, d, "customer").select("c_custkey", S.clip_nonneg(F.col("c_acctbal")).alias("balance"))


@query("cap_value", """SELECT event_id, least(value, 95) AS value FROM events""")
def _(spark, d):
    return B.table(spark, d, "events").select("event_id", S.cap(F.col("value"), 95).alias("value"))


@query("inf_to_null", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_discount <> 0 THEN round(l_tax / l_discount, 6) END AS ratio,
  CASE WHEN l_discount <> 0 THEN round(l_quantity / l_discount, 6) END AS inverse FROM lineitem""")
def _(spark, d):
    inf = F.when(F.col("l_discount") == 0, float("inf")).otherwise(F.try_divide("l_quantity", "l_discount"))
    return B.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(S.ratio(F.col("l_tax"), F.col("l_discount")), 6).alias("ratio"),
        F.round(S.finite(inf), 6).alias("inverse"),
    )


@query("hsa_code_format", """
SELECT s_suppkey, lpad(CAST(CAST(s_suppkey % 1000 AS INTEGER) AS VARCHAR), 3, '0') AS hsa FROM supplier""")
def _(spark, d):
    return B.table(spark, d, "supplier").select("s_suppkey", R.hsa_code(F.col("s_suppkey") % 1000).alias("hsa"))
