"""Queries for tag algebra."""

import datetime

from pyspark.sql import functions as F

from geotally.functions import tagtext as T
from geotally.model import POINT, SERIES, TAG, Dataset
from geotally.operators import tags as O
from geotally.plans import bindings as B
from geotally.plans.catalog import query

D = datetime.date
KEYS = "location_id, variable, bucket"


def note_tags(spark, d):
    """One known-issue tag per market segment of a county."""
    s = B.obsb(spark, d).filter("bucket <> 'all' and variable = 'revenue'").select(*SERIES).distinct()
    return O.make_tags(s, T.KNOWN_ISSUE, T.known_issue_content(F.col("bucket"), F.lit(D(2000, 1, 1))))


NOTES = """SELECT DISTINCT location_id, variable, bucket, 'known_issue' AS tag_type, '{"public_note":"' || bucket || '","date":"2000-01-01"}' AS content FROM obsb WHERE bucket <> 'all' AND variable = 'revenue'"""


@query("append_tags", f"SELECT * FROM tags UNION ALL ({NOTES})")
def _(spark, d):
    return O.append_tags(B.dataset(spark, d), note_tags(spark, d)).tags


@query("replace_tags", NOTES)
def _(spark, d):
    return O.replace_tags(B.dataset(spark, d), note_tags(spark, d)).tags


@query("tag_all_series", f"""SELECT * FROM tags UNION ALL SELECT DISTINCT {KEYS}, 'derived', '{{"f":"test"}}' FROM obsb WHERE bucket = 'all'""")
def _(spark, d):
    return O.tag_all_series(B.dataset(spark, d, B.obsb), T.DERIVED, T.derived_content(F.lit("test"))).tags


BIGS = f"(SELECT {KEYS} FROM obsb GROUP BY ALL HAVING COUNT(*) > 100)"


def long_series(spark, d):
    return B.obsb(spark, d).groupBy(*SERIES).agg(F.count("*").alias("n")).filter("n > 100").select(*SERIES)


@query("tag_subset", f"""SELECT * FROM tags UNION ALL SELECT {KEYS}, 'known_issue_no_date', '{{"public_note":"long"}}' FROM {BIGS}""")
def _(spark, d):
    return O.tag_subset(B.dataset(spark, d), long_series(spark, d), T.KNOWN_ISSUE_NO_DATE, T.known_issue_content(F.lit("long"))).tags


@query("untag_subset", f"SELECT * FROM tags WHERE ({KEYS}) NOT IN (SELECT ({KEYS}) FROM obs WHERE variable = 'n_orders' GROUP BY ALL HAVING SUM(value) > (SELECT COUNT(*) / 25 FROM orders))")
def _(spark, d):
    per = B.table(spark, d, "orders").agg(F.count("*") / 25).scalar()
    s = B.obs(spark, d).filter("variable = 'n_orders'").groupBy(*SERIES).agg(F.sum("value").alias("v")).filter(F.col("v") > per)
    return O.untag_subset(B.dataset(spark, d), s).tags


@query("add_provenance", f"""SELECT * FROM tags UNION ALL SELECT DISTINCT {KEYS}, 'provenance', 'constant' FROM obs UNION ALL SELECT DISTINCT location_id, variable, 'all', 'provenance', 'of ' || location_id FROM obs WHERE variable = 'revenue'""")
def _(spark, d):
    ds = O.add_provenance(B.dataset(spark, d), "constant")
    rows = B.obs(spark, d).filter("variable = 'revenue'").select("location_id", "variable", F.concat(F.lit("of "), "location_id").alias("provenance")).distinct()
    return O.add_provenance(ds, rows).tags


ONE_SRC = "(SELECT * FROM tags WHERE tag_type = 'source' OR content IN ('src_P', 'http://src/p'))"


def one_source_tags(spark, d):
    return B.tags(spark, d).filter((F.col("tag_type") == "source") | F.col("content").isin("src_P", "http://src/p"))


@query("make_source_tags", f"""SELECT * FROM tags WHERE tag_type = 'source' UNION ALL SELECT {KEYS}, 'source', '{{"type":"src_P","url":"http://src/p"}}' FROM tags WHERE content = 'src_P'""")
def _(spark, d):
    return O.make_source_tags(one_source_tags(spark, d))


@query("make_source_url_tags", f"SELECT * FROM tags WHERE tag_type = 'source' UNION ALL SELECT {KEYS}, 'source_url', json_extract_string(content, '$.url') FROM tags WHERE tag_type = 'source'")
def _(spark, d):
    return O.make_source_url_tags(B.tags(spark, d).filter("tag_type = 'source'"))


@query("source_tag_last_date", """
SELECT location_id, variable, bucket, arg_max(content, date) AS content FROM (SELECT location_id, variable, bucket, date, '{"type":"' || MAX(source) || '"}' AS content FROM srcall GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3""")
def _(spark, d):
    dated = B.srcall(spark, d).groupBy(*POINT).agg(T.source_content(F.max("source")).alias("content"))
    return O.last_source_tag(dated)


@query("tags_of_region", f"""
SELECT location_id, variable, string_agg(content, '|' ORDER BY content) FILTER (tag_type = 'provenance') AS provenance, string_agg(content, '|' ORDER BY content) FILTER (tag_type = 'source_url') AS source_url,
 COUNT(*) FILTER (tag_type = 'source') AS n_source FROM tags WHERE bucket = 'all' GROUP BY 1, 2""")
def _(spark, d):
    x = O.tags_of_region(B.tags(spark, d))
    return x.select("location_id", "variable", F.array_join("provenance", "|").alias("provenance"), F.array_join("source_url", "|").alias("source_url"), F.size("source").cast("bigint").alias("n_source"))


@query("field_annotations", f"""
WITH kt AS (SELECT * FROM tags WHERE NOT (tag_type = 'source' AND location_id LIKE '%5') AND (content NOT LIKE 'src_%' OR content = 'src_P') AND (content NOT LIKE 'http%' OR content = 'http://src/p')),
 an AS (SELECT location_id, COUNT(*) AS n FROM obs WHERE variable = 'n_orders' AND value > 2 GROUP BY 1),
 s AS (SELECT location_id, CASE WHEN COUNT(*) FILTER (tag_type = 'source') > 0 THEN string_agg(CASE json_extract_string(CASE WHEN tag_type = 'source' THEN content ELSE '{{}}' END, '$.type') WHEN 'P' THEN 'P' WHEN 'O' THEN 'O' ELSE 'other' END || '@' || json_extract_string(CASE WHEN tag_type = 'source' THEN content ELSE '{{}}' END, '$.url'), ',' ORDER BY CASE json_extract_string(CASE WHEN tag_type = 'source' THEN content ELSE '{{}}' END, '$.type') WHEN 'P' THEN 'P' WHEN 'O' THEN 'O' ELSE 'other' END) FILTER (tag_type = 'source')
   ELSE 'other@http://src/p' END AS sources FROM kt GROUP BY 1)
SELECT s.location_id, f.field, s.sources, COALESCE(an.n, 0) AS n_anomalies FROM s LEFT JOIN an USING (location_id), (VALUES ('cases'), ('caseDensity')) AS f(field)""")
def _(spark, d):
    content, typ = F.col("content"), F.col("tag_type")
    kept = B.tags(spark, d).filter(~((typ == "source") & F.col("location_id").endswith("5"))).filter(
        (~content.startswith("src_") | (content == "src_P")) & (~content.startswith("http") | (content == "http://src/p"))
    )
    # One outlier tag per large value stands for the corrections of a series.
    found = B.obs(spark, d).filter("variable = 'n_orders' and value > 2").select(
        *SERIES, F.lit(T.ZSCORE).alias("tag_type"), T.dated_content(F.col("date"), F.col("value")).alias("content")
    )
    names = spark.createDataFrame([("cases", "n_orders"), ("caseDensity", "n_orders")], "field string, variable string")
    x = O.field_annotations(kept.unionByName(found), F.broadcast(names), ["P", "O"])
    text = F.array_join(F.transform("sources", lambda s: F.concat(s["type"], F.lit("@"), s["url"])), ",")
    return x.select("location_id", "field", text.alias("sources"), F.size("anomalies").cast("bigint").alias("n_anomalies"))


@query("tags_follow_series", f"SELECT * FROM tags WHERE ({KEYS}) IN (SELECT ({KEYS}) FROM obs WHERE value > 4 AND variable = 'n_orders')")
def _(spark, d):
    return O.tags_follow_series(B.tags(spark, d), B.obs(spark, d).filter("value > 4 and variable = 'n_orders'"))
