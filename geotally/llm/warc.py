"""Not-modified revisits of a web archive: which earlier response each one stands for.

A revisit record says that a server answered "not modified" and has no body. It is joined as of its time
to the latest earlier full response of the same canonical URL, its validators are checked, and its
headers update those of the response, as far as a 304 may.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from geotally.llm.common import materialize

#: Rows of one URL from which its time line is cut into parts.
PART = 4096

# fixed values: header fields that describe the stored content or the connection, which a 304 doesn't update
KEPT_HEADERS = [
    "connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive", "proxy-authenticate",
    "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade",
]
# fixed values: query fields that name a referrer or a visitor, not a resource
TRACKING = r"^(utm_[a-z_]+|ref|fbclid|gclid|sid|sessionid|phpsessionid|jsessionid)(=|$)"


def canonical_url(url: str | Column) -> Column:
    """Host, path and query by which captures of one resource agree; null for what is no absolute URL.

    Scheme, user, default port, a leading www. or m., the fragment, trailing slashes and query fields that
    track visitors are left out; the host is in lower case and the query's fields are sorted.
    """
    url = F.trim(F.col(url) if isinstance(url, str) else url)
    parts = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)([^?#]*)(?:\?([^#]*))?"
    host = F.regexp_replace(F.lower(F.regexp_extract(url, parts, 1)), r"^(www[0-9]?|m)\.|:(80|443)?$", "")
    path = F.regexp_replace(F.regexp_extract(url, parts, 2), r"/+$", "")
    fields = F.array_sort(F.filter(F.split(F.regexp_extract(url, parts, 3), "&"), lambda f: (f != "") & ~F.lower(f).rlike(TRACKING)))
    query = F.when(F.size(fields) > 0, F.concat(F.lit("?"), F.array_join(fields, "&"))).otherwise("")
    return F.when(url.rlike(parts), F.concat(host, path, query))


def _same_tag(a: Column, b: Column) -> Column:
    weak = lambda c: F.regexp_replace(c, r"^W/", "")
    return weak(a) == weak(b)


def latest_earlier(rows: DataFrame, key: str, at: str, given: Column, out: str) -> DataFrame:
    """``out``: the greatest ``given`` (a struct that starts with ``at``) among rows of the key at an earlier time.

    A key's time line is cut into parts of about PART rows, by its own first and last time. The greatest
    value of each part, combined before the shuffle, is carried to the later parts; rows are compared within
    their part only. So a key with a third of all rows is spread. Rows without key or time find nothing.
    """
    rows = rows.withColumn("__given", given)
    spread = rows.filter(F.col(key).isNotNull() & F.col(at).isNotNull()).groupBy(key).agg(F.count("*").alias("__n"), F.min(at).alias("__first"), F.max(at).alias("__last"))
    share = (F.col(at) - F.col("__first")) / (F.col("__last") - F.col("__first") + F.lit(1))
    part = F.coalesce(F.floor(share * F.ceil(F.col("__n") / PART)), F.lit(0))
    cut = rows.join(spread, key).filter(F.col(at).isNotNull()).withColumn("__part", part).drop("__n", "__first", "__last")
    tops = cut.groupBy(key, "__part").agg(F.max("__given").alias("__top"))
    carried = tops.select(key, "__part", F.max("__top").over(W.partitionBy(key).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)).alias("__before"))
    inner = W.partitionBy(key, "__part").orderBy(at).rangeBetween(W.unboundedPreceding, -1)
    found = cut.join(carried, [key, "__part"]).withColumn(out, F.coalesce(F.max("__given").over(inner), F.col("__before")))
    rest = rows.filter(F.col(key).isNull() | F.col(at).isNull()).withColumn(out, F.lit(None).cast(found.schema[out].dataType))
    names = [*[c for c in rows.columns if c != "__given"], out]
    return found.select(*names).unionByName(rest.select(*names))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per revisit: record_id, canonical_url, at, refers_to, status, headers, body.

    ``records``: record_id, kind (``response`` or ``revisit``), url, at (whole number of any unit of time),
    http_status, headers (a map with names in lower case), body. A full response has status 200 and a body.
    Of responses at one time the one with the greatest id counts. ``status`` is

    * ``unresolved``: there is no earlier full response, or the URL or time is null;
    * ``mismatch``: entity tags differ (compared weakly), or, where not both have one, the times of
      last modification do; ``refers_to`` names the response, without headers and body;
    * ``resolved``: a validator agrees, or there is none to compare. Headers are those of the response,
      updated by the revisit's other than KEPT_HEADERS; null headers are an empty map.

    Repeated rows of a revisit are resolved alike, repeated responses count once. Rows of other kinds and extra
    columns are ignored. An empty table gives no rows. Bodies are moved once, for resolved revisits.
    """
    rows = records.select(
        "record_id", "kind", canonical_url("url").alias("canonical_url"), F.col("at").cast("long").alias("at"),
        ((F.col("kind") == "response") & (F.col("http_status") == 200) & F.col("body").isNotNull()).alias("full"),
        F.coalesce("headers", F.create_map().cast("map<string,string>")).alias("headers"),
    ).filter((F.col("kind") == "revisit") | F.col("full"))
    rows = materialize(rows.withColumns({"etag": F.col("headers")["etag"], "modified": F.col("headers")["last-modified"]}), "warc-records")
    given = F.when(F.col("full"), F.struct("at", "record_id", "etag", "modified"))
    found = latest_earlier(rows.drop("headers"), "canonical_url", "at", given, "earlier").filter("kind = 'revisit'")
    e = F.col("earlier")
    tags, times = F.col("etag").isNotNull() & e["etag"].isNotNull(), F.col("modified").isNotNull() & e["modified"].isNotNull()
    agrees = F.when(tags, _same_tag(F.col("etag"), e["etag"])).when(times, F.col("modified") == e["modified"]).otherwise(True)
    found = found.select("record_id", "canonical_url", "at", e["record_id"].alias("refers_to"), F.when(e.isNull(), "unresolved").when(agrees, "resolved").otherwise("mismatch").alias("status"))
    own = rows.filter("kind = 'revisit'").groupBy("record_id").agg(F.any_value("headers").alias("new_headers"))
    full = (F.col("kind") == "response") & (F.col("http_status") == 200) & F.col("body").isNotNull()
    bodies = records.filter(full).select(F.col("record_id").alias("refers_to"), F.coalesce("headers", F.create_map().cast("map<string,string>")).alias("old_headers"), "body").dropDuplicates(["refers_to"])
    resolved = found.filter("status = 'resolved'").join(own, "record_id").join(bodies, "refers_to")
    allowed = F.map_filter("new_headers", lambda k, _: ~k.isin(KEPT_HEADERS))
    merged = F.map_concat(F.map_filter("old_headers", lambda k, _: ~F.array_contains(F.map_keys(allowed), k)), allowed)
    columns = ["record_id", "canonical_url", "at", "refers_to", "status"]
    nothing = [F.lit(None).cast("map<string,string>").alias("headers"), F.lit(None).cast(records.schema["body"].dataType).alias("body")]
    return resolved.select(*columns, merged.alias("headers"), "body").unionByName(found.filter("status != 'resolved'").select(*columns, *nothing))


def records_of_pages(pages: DataFrame) -> DataFrame:
    """An archive of the given pages: each is captured at its number, and visited again later.

    The revisit comes after half the range of numbers, so other captures of the same resource may lie between.
    Captures by URLs whose length divides by three have a time of last modification instead of an entity
    tag, and tags of revisits are weak.
    """
    span = pages.agg(F.coalesce(F.floor(F.max("page_id") / 2), F.lit(0)).alias("later"))
    body = F.coalesce("html", F.lit(""))
    tagged, tag = F.length(F.coalesce("url", F.lit(""))) % 3 != 0, F.concat(F.lit('"'), F.md5(body), F.lit('"'))
    stamp = F.concat(F.lit("day "), F.length(body).cast("string"))

    def headers(weak: bool, kind: str):
        value = F.concat(F.lit("W/"), tag) if weak else tag
        common = [F.lit("content-type"), F.lit("text/html" if not weak else "text/plain"), F.lit("date"), F.concat(F.lit(f"{kind} "), F.col("page_id").cast("string"))]
        return F.when(tagged, F.create_map(*common, F.lit("etag"), value)).otherwise(F.create_map(*common, F.lit("last-modified"), stamp))

    first = pages.select(F.concat(F.lit("response-"), F.col("page_id").cast("string")).alias("record_id"), F.lit("response").alias("kind"), "url", F.col("page_id").alias("at"), F.lit(200).alias("http_status"), headers(False, "first").alias("headers"), F.col("html").alias("body"))
    # the later time is one number, so this join adds a column
    again = pages.join(F.broadcast(span), F.lit(True)).select(F.concat(F.lit("revisit-"), F.col("page_id").cast("string")).alias("record_id"), F.lit("revisit").alias("kind"), "url", (F.col("page_id") + F.col("later") + 1).alias("at"), F.lit(304).alias("http_status"), headers(True, "again").alias("headers"), F.lit(None).cast("string").alias("body"))
    return first.unionByName(again)
