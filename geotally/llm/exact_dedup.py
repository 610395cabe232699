"""Exact duplicates by progressive refinement: length, then hash of a prefix, then hash of the whole text.

Only DataFrame functions. Texts are equal when they are identical after white space is deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from geotally.llm.common import SPACE, empty_if_null, materialize, row_key, without_rows, written

KEYS = ["norm_len", "prefix_hash"]


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = 64, hash_all: bool = False) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    The row with the most code points in its original text stays, then the smallest id. The first
    scan takes length and prefix hash of the normalised text. Counts by length, then by length and
    prefix hash, are combined before the shuffle; only texts of groups that survive both are hashed
    in full. ``hash_all`` also fills in the digest of the others, which without it is null.

    Null texts count as empty, and all empty texts are one group. A repeated row (same id and text)
    counts in group_size, and all its repetitions have the same ``kept``. A null id stays only if no
    row of the group with as many code points has one. Other columns of ``docs`` are not read. An
    empty table gives no rows. A group with a third of all rows is one row of counts per task, and
    the join of its rows to those counts is one that Spark splits.
    """
    norm = docs.select(F.col(id_col).alias("id"), empty_if_null(text_col).alias("text")).withColumn("norm", F.regexp_replace("text", SPACE, ""))
    rows = norm.select("id", "norm", F.length("text").alias("n_points"), F.length("norm").alias("norm_len"), F.xxhash64(F.substring("norm", 1, prefix)).alias("prefix_hash"))
    keys = materialize(rows.drop("norm"), "exact-keys")
    lengths = keys.groupBy("norm_len").count().filter("count > 1").select("norm_len")
    # rows of a length meet as counts by prefix hash, so a length that many rows have is no burden
    survivors = keys.groupBy(*KEYS).count().join(lengths, "norm_len", "left_semi").filter("count > 1").select(*KEYS, F.lit(True).alias("survives"))
    # whole texts: only those of surviving groups are hashed
    whole = F.sha2("norm", 256)
    read = rows.join(survivors, KEYS, "left").select(
        "id", "n_points", *KEYS, F.coalesce("survives", F.lit(False)).alias("survives"),
        (whole if hash_all else F.when(F.col("survives"), whole)).alias("text_sha256"),
    )
    n = keys.count()
    read = written(read, "exact-digests", n)
    first = F.struct((-F.col("n_points")).alias("points"), F.col("id").isNull().alias("none"), "id")
    groups = read.filter("survives").groupBy("text_sha256").agg(F.count("*").alias("group_size"), F.min(first)["id"].alias("keep_id"))
    # as a table, so that Spark can split the join of a large group's rows to its one row
    groups = written(groups, "exact-groups", n)
    return read.filter("survives").join(groups, "text_sha256").unionByName(
        read.filter("not survives").withColumns({"group_size": F.lit(1).cast("long"), "keep_id": F.col("id")})
    ).select(F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that ``exact_groups`` does not keep; of a repeated row one stays.

    Rows go by id and text, so another text under the same id stays, and a row without an id is treated
    like any other.
    """
    gone = exact_groups(docs, id_col, text_col).filter("not kept").select(row_key(id_col, F.col("text_sha256")))
    same = F.sha2(F.regexp_replace(empty_if_null(text_col), SPACE, ""), 256)
    return without_rows(docs, row_key(id_col, same), gone, repeated=True)
