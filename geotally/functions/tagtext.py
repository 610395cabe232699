"""Encode and decode the content of each tag type with Spark's JSON functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Tag type names.
CUMULATIVE_TAIL = "cumulative_tail_truncated"
CUMULATIVE_LONG_TAIL = "cumulative_long_tail_truncated"
ZSCORE = "zscore_outlier"
PROVENANCE = "provenance"
SOURCE_URL = "source_url"
SOURCE = "source"
KNOWN_ISSUE = "known_issue"
KNOWN_ISSUE_NO_DATE = "known_issue_no_date"
DERIVED = "derived"
DROP_FUTURE = "drop_future_observation"

TYPES = [
    CUMULATIVE_TAIL, CUMULATIVE_LONG_TAIL, ZSCORE, PROVENANCE, SOURCE_URL, SOURCE, KNOWN_ISSUE, KNOWN_ISSUE_NO_DATE,
    DERIVED, DROP_FUTURE,
]
ANNOTATIONS = [CUMULATIVE_TAIL, CUMULATIVE_LONG_TAIL, ZSCORE, KNOWN_ISSUE, KNOWN_ISSUE_NO_DATE, DERIVED, DROP_FUTURE]

DECODED = (
    "type string, url string, name string, date date, original_observation double, public_note string, "
    "disclaimer string, f string, after date"
)


def _blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def source_content(type_: Column, url: Column | None = None, name: Column | None = None) -> Column:
    null = F.lit(None).cast("string")
    return F.to_json(
        F.struct(
            type_.alias("type"), _blank_to_null(url if url is not None else null).alias("url"),
            _blank_to_null(name if name is not None else null).alias("name"),
        )
    )


def dated_content(date: Column, original: Column) -> Column:
    """Date and original value, with the spacing that annotation tags use."""
    number = F.when(original.isNull(), "NaN").otherwise(original.cast("string"))
    return F.concat(
        F.lit('{"date": "'), date.cast("string"), F.lit('", "original_observation": '), number, F.lit("}")
    )


def known_issue_content(note: Column, date: Column | None = None) -> Column:
    fields = [note.alias("public_note")] + ([date.cast("string").alias("date")] if date is not None else [])
    return F.to_json(F.struct(*fields))


def derived_content(function: Column) -> Column:
    return F.to_json(F.struct(function.alias("f")))


def drop_future_content(after: Column) -> Column:
    return F.to_json(F.struct(after.cast("string").alias("after")))


def decode(tag_type: Column, content: Column) -> Column:
    """One struct for all tag types; bare-text types fill ``name`` or ``url`` directly."""
    j = F.from_json(content, DECODED, {"allowNonNumericNumbers": "true"})
    bare = tag_type.isin(PROVENANCE, SOURCE_URL)
    return F.struct(
        F.when(~bare, j["type"]).alias("type"),
        F.when(tag_type == SOURCE_URL, content).when(~bare, j["url"]).alias("url"),
        F.when(tag_type == PROVENANCE, content).when(~bare, j["name"]).alias("name"),
        F.when(~bare, j["date"]).alias("date"),
        F.when(~bare & ~F.isnan(j["original_observation"]), j["original_observation"]).alias("original_observation"),
        F.when(~bare, F.coalesce(j["disclaimer"], j["public_note"])).alias("public_note"),
        F.when(~bare, j["f"]).alias("function"),
        F.when(~bare, j["after"]).alias("after"),
    )
