"""One query per operator, over the whole of its table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from geotally.llm import collocations, exact_dedup, language, licenses, mixing, near_dedup, packing, periodic_runs, quality, substring_dedup, token_counts, toxicity, warc
from geotally.llm.common import documents
from geotally.llm.registry import ORACLE, QUERIES, pipeline, query

__all__ = ["ORACLE", "QUERIES"]

NORM = "regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g')"
WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"


@query("op1_mix_sources")
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights 1, 2, 3 in turn, rising, level and falling over training; all documents are shared out."""
    return mixing.mix_plan(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "copies", "positions")


@query("op5_quality_rules")
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rated(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


@query("op9_exact_dedup", f"""
    with t as (select doc_id, length(coalesce(text, '')) as points, sha256({NORM}) as text_sha256 from documents)
    select doc_id, first_value(doc_id) over w as keep_id, count(*) over (partition by text_sha256) as group_size,
           doc_id = first_value(doc_id) over w as kept, text_sha256
    from t window w as (partition by text_sha256 order by points desc, doc_id)""")
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir), hash_all=True)


@query("op6_minhash_dedup")
def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(documents(spark, sf_dir), width=2)


@query("op2_pack_sequences")
def op2_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), documents(spark, sf_dir, "labels")
    held_out = language.fold("doc_id", 5) == 0
    fitted = toxicity.fit(docs.filter(~held_out), labels.filter(~held_out))
    return toxicity.rated(docs, fitted).select("doc_id", held_out.alias("held_out"), "score", "predicted", "threshold", "flagged")


@query("op10_language_id")
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = language.fold("doc_id", 3) == 1
    model = language.fit(docs.filter(~held_out))
    return language.identified(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op8_substring_dedup")
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(documents(spark, sf_dir))


@query("op3_warc_revisits", r"""
    with page as (
        select page_id, html, coalesce(html, '') as body, url, trim(url) as u,
               '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)([^?#]*)(?:[?]([^#]*))?' as parts,
               page_id + (select floor(max(page_id) / 2) from pages) + 1 as again
        from pages),
    split as (
        select *, regexp_replace(lower(regexp_extract(u, parts, 1)), '^(www[0-9]?|m)[.]|:(80|443)?$', '', 'g') as host,
               regexp_replace(regexp_extract(u, parts, 2), '/+$', '') as path,
               list_sort(list_filter(string_split(regexp_extract(u, parts, 3), '&'), lambda f: f <> '' and not regexp_matches(lower(f), '^(utm_[a-z_]+|ref|fbclid|gclid|sid|sessionid|phpsessionid|jsessionid)(=|$)'))) as fields
        from page),
    named as (
        select *, case when regexp_matches(u, parts) then host || path || case when len(fields) > 0 then '?' || array_to_string(fields, '&') else '' end end as canonical_url,
               length(body) as modified, md5(body) as tag
        from split),
    latest as (
        select r.page_id, r.canonical_url, r.again, r.tag, r.modified, r.url, f.page_id as found, f.tag as old_tag, f.modified as old_modified, f.url as old_url, f.body as old_body,
               row_number() over (partition by r.page_id order by f.page_id desc) as nth
        from named r left join named f on f.canonical_url = r.canonical_url and f.page_id < r.again and f.html is not null),
    judged as (
        select *, length(coalesce(url, '')) % 3 <> 0 as tagged, length(coalesce(old_url, '')) % 3 <> 0 as old_tagged,
               case when found is null then 'unresolved' when tagged and old_tagged and tag <> old_tag then 'mismatch'
                    when not tagged and not old_tagged and modified <> old_modified then 'mismatch' else 'resolved' end as status
        from latest where nth = 1)
    select 'revisit-' || page_id as record_id, canonical_url, again::bigint as at, 'response-' || found as refers_to, status,
           case when status = 'resolved' then sha256(old_body) end as body_sha256,
           case when status = 'resolved' then 'text/html' end as content_type,
           case when status = 'resolved' then 'again ' || page_id end as date
    from judged""")
def op3_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = warc.resolve_revisits(warc.records_of_pages(documents(spark, sf_dir, "pages")))
    return resolved.select("record_id", "canonical_url", "at", "refers_to", "status", F.sha2("body", 256).alias("body_sha256"), F.col("headers")["content-type"].alias("content_type"), F.col("headers")["date"].alias("date"))


@query("op4_license_scan", licenses.oracle_sql())
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


@query("op11_token_counts")
def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


@query("op12_phrase_collocations")
def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


@query("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(periodic_runs.periodic_runs(documents(spark, sf_dir), tails=True))
