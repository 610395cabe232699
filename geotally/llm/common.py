"""Helpers of the subpackage: words, hashes, two-level running totals, tables in the shared folder."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from geotally.model import materialize

__all__ = ["WORD", "SPACE", "documents", "empty_if_null", "materialize", "written", "files_for", "row_key", "fresh", "without_rows", "order_hash", "bucket_bits", "hash_bucket", "with_running_total", "flat_words", "word_hashes", "mix", "batches_of", "packed", "unpacked", "unpacked_texts"]

#: A word is a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def empty_if_null(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def written(df: DataFrame, name: str, rows: int, per_file: int = 200_000) -> DataFrame:
    """``df`` of at most about ``rows`` narrow rows as a table of so many files that each is worth opening.

    The rows are dealt anew before they are written, so what makes them keeps its tasks.
    """
    return materialize(df.repartition(max(1, -(-rows // per_file))), name)


def files_for(docs: DataFrame, text_col: str = "text") -> int:
    """Files that a table made of ``docs`` merits: one for 2,000 documents or 4 MB of text, and as many as there are cores.

    A small table else gets a file per shuffle partition, and an executor starts a process for each file in a local
    folder. ``coalesce`` to this number puts partitions together without a shuffle, but not those of a large table.
    """
    n, size = docs.agg(F.count("*"), F.sum(F.octet_length(text_col))).first()
    return max(docs.sparkSession.sparkContext.defaultParallelism, -(-n // 2_000), -(-(size or 0) // 4_000_000))


def row_key(id_col: str, digest: Column) -> Column:
    """One text for the id, null included, and a digest: what tells the rows of ``docs`` apart when some go."""
    return F.concat_ws("/", F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit("")), digest.cast("string"))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or the first longer one that is no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without_rows(df: DataFrame, key: Column, gone: DataFrame, repeated: bool = False) -> DataFrame:
    """``df`` without the rows whose ``key`` is in the one column of ``gone``; ``repeated`` leaves one row a key.

    Both steps are by the key, so that texts move once.
    """
    name = fresh(df, "__row")
    keyed = df.withColumn(name, key)
    left = keyed.join(gone.toDF(name).distinct(), name, "left_anti")
    return (left.dropDuplicates([name]) if repeated else left).drop(name)


def order_hash(col: str, seed: int = 0) -> Column:
    """A 64-bit value by which rows are put in an order that does not depend on how they are stored."""
    return F.xxhash64(F.lit(seed), F.col(col))


def bucket_bits(rows: int, per_bucket: int = 2048) -> int:
    """Bits of the order hash that cut a key's rows into 256 buckets, or more of about ``per_bucket`` rows."""
    return max(8, int(np.ceil(np.log2(max(rows, 1) / per_bucket + 1))))


def hash_bucket(hashed: str, bits: int) -> Column:
    """The rows of a key in buckets, in the order of the hash."""
    return F.shiftright(F.col(hashed), 64 - bits)


def with_running_total(df: DataFrame, keys: list[str], hashed: str, ties: list[str], value: Column, out: str, bits: int) -> DataFrame:
    """``out``: the sum of ``value`` over the rows of the same key before this one, by ``hashed`` and ``ties``.

    Two levels, so that a key with a third of all rows is still spread: sums of hash buckets are
    added up per key (a few rows each), and the rows of one bucket among themselves. Keys are not null.
    """
    cut = df.withColumn("__bucket", hash_bucket(hashed, bits)).withColumn("__value", value)
    sums = cut.groupBy(*keys, "__bucket").agg(F.sum("__value").alias("__sum"))
    before = W.partitionBy(*keys).orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    base = sums.select(*keys, "__bucket", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__base"))
    inner = W.partitionBy(*keys, "__bucket").orderBy(hashed, *ties).rowsBetween(W.unboundedPreceding, -1)
    joined = cut.join(base, [*keys, "__bucket"])
    return joined.withColumn(out, F.col("__base") + F.coalesce(F.sum("__value").over(inner), F.lit(0))).drop("__bucket", "__value", "__base")


# ---------------------------------------------------------------- inside Arrow batches


def _with_column(df: DataFrame, name: str, kind: T.DataType, change) -> DataFrame:
    """``df`` with each batch's column replaced; all other columns pass through."""
    place = df.columns.index(name)

    def run(batches):
        for batch in batches:
            yield batch.set_column(place, name, change(batch.column(place)))

    return df.mapInArrow(run, T.StructType([T.StructField(f.name, kind if f.name == name else f.dataType) for f in df.schema]))


def packed(df: DataFrame, name: str = "text", level: int = 1) -> DataFrame:
    """The texts compressed one by one, for joins that have to move them; null stays null."""
    def change(texts: pa.Array) -> pa.Array:
        press = zstandard.ZstdCompressor(level=level).compress
        return pa.array([None if x is None else press(x) for x in texts.cast(pa.binary()).to_pylist()], pa.binary())

    return _with_column(df, name, T.BinaryType(), change)


def unpacked_texts(texts: pa.Array) -> pa.Array:
    expand = zstandard.ZstdDecompressor().decompress
    return pa.array([None if x is None else expand(x) for x in texts.to_pylist()], pa.binary()).cast(pa.string())


def unpacked(df: DataFrame, name: str = "text") -> DataFrame:
    return _with_column(df, name, T.StringType(), unpacked_texts)


def flat_words(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, pa.Array]:
    """The words of all texts in one array, and the offsets of each text's words in it (null: none)."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    texts = pc.fill_null(texts, "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    words = lists.flatten()
    full = pc.greater(pc.binary_length(words), 0)
    bounds = np.asarray(lists.offsets, dtype=np.int64)
    bounds = bounds - bounds[0]
    seen = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    return seen[bounds], words.filter(full)


def mix(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    """A 64-bit hash of two 64-bit values, the order of which matters."""
    with np.errstate(over="ignore"):
        x = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b + np.uint64(0x7F4A7C15F39CC060) + (a << np.uint64(6)))
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word; each distinct word is hashed once."""
    coded = words.dictionary_encode()
    digest = xxhash.xxh64_intdigest
    distinct = np.fromiter((digest(w) for w in coded.dictionary.cast(pa.binary()).to_pylist()), dtype=np.uint64, count=len(coded.dictionary))
    return distinct[coded.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, np.uint64)


def batches_of(batch: pa.RecordBatch, text: str, chars: int = 16_000_000):
    """The batch in slices of about so many bytes of text; a longer text is a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends, start, held = np.cumsum(sizes), 0, 0
    while start < len(sizes):
        stop = max(start + 1, int(np.searchsorted(ends, held + chars, side="right")))
        yield batch.slice(start, stop - start)
        held, start = int(ends[stop - 1]), stop
