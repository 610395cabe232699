"""Duplicate passages by an index of content-defined blocks, in place of greedy Lempel-Ziv factoring.

Texts are cut into overlapping blocks at content-defined anchors: an anchor is the k-gram with the least
hash of a window of words, and a block is the text of all consecutive windows with one anchor. Equal
passages are cut alike wherever they stand, so the whole corpus is its own reference, and the index
that a block is looked up in is the shuffle by its anchor. Where an anchor has several blocks, which
agree in part only, the windows themselves are compared.

Nothing is factored greedily: a span joins what is covered, which may occur earlier in several
documents, and it has no source. Factoring would need each document beside all its references;
blocks need a shuffle by hash, and the words that some earlier window covers are the same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window as W, functions as F

from geotally.llm.common import WORD, SPACE, batches_of, empty_if_null, flat_words, materialize, mix, word_hashes

WINDOW, ANCHOR = 20, 8
#: Blocks of one anchor that a batch sends to the index; those of commoner anchors are compared by windows.
MANY = 16
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
BLOCK, COPY, WINDOWS, MARK = 0, 1, 2, 3


class Passages:
    """Hashes of any range of the words of a batch, whose order matters."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        step = lambda base: np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, base, np.uint64)]), dtype=np.uint64)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * step(_BASE)[:n], dtype=np.uint64)])
        self.back = step(_INVERSE)

    def hash(self, start: np.ndarray, stop: np.ndarray, more: np.ndarray | np.uint64) -> np.ndarray:
        return mix((self.sums[stop] - self.sums[start]) * self.back[start], more)


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the first least value of each stretch of ``width`` values."""
    value, place, have = values, np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        left = value[:-step] <= value[step:]
        value, place = np.where(left, value[:-step], value[step:]), np.where(left, place[:-step], place[step:])
        have += step
    return place


def blocks(bounds: np.ndarray, passages: Passages, window: int, anchor: int):
    """Of all texts of a batch: document, first window, windows, anchor hash and hash of each block."""
    n = len(passages.sums) - 1
    counts = np.maximum(np.diff(bounds) - window + 1, 0)
    if n < window or not counts.any():
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    at = np.arange(n - anchor + 1)
    grams = passages.hash(at, at + anchor, np.uint64(anchor))
    windows = _ranges(bounds[:-1], counts)
    least = _least(grams, window - anchor + 1)[windows]
    new = np.concatenate([[True], least[1:] != least[:-1]])
    first = windows[new]
    size = np.diff(np.append(np.flatnonzero(new), len(windows)))
    least = least[new]
    whole = passages.hash(first, first + size - 1 + window, ((least - first) * 256 + size).astype(np.uint64))
    doc = np.searchsorted(bounds, first, side="right") - 1
    return doc, first - bounds[doc], size, grams[least], whole


def _firsts(key: np.ndarray, rank: np.ndarray, start: np.ndarray) -> np.ndarray:
    """True where no other row of the key is earlier, by rank of the document and start."""
    order = np.lexsort((start, rank, key))
    k, r, s = key[order], rank[order], start[order]
    group = np.concatenate([[0], np.cumsum(k[1:] != k[:-1])]) if len(k) else np.zeros(0, np.int64)
    head = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    out = np.zeros(len(key), bool)
    out[order] = (r == r[head][group]) & (s == s[head][group])
    return out


def _ranks(ids: pa.Array) -> np.ndarray:
    return pc.rank(ids, null_placement="at_start", tiebreaker="dense").to_numpy(zero_copy_only=False).astype(np.int64)


def _index_rows(texts: DataFrame, window: int, anchor: int) -> DataFrame:
    """(anchor, block, id, digest, place): place packs first window, windows and kind.

    Of the copies of a block within a batch only the first needs the index; the others are known to be copies.
    """
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in batches_of(batch, "text"):
                bounds, words = flat_words(part.column("text"))
                doc, start, size, key, whole = blocks(bounds, Passages(word_hashes(words)), window, anchor)
                first = _firsts(whole, _ranks(part.column("id"))[doc], start)
                kind = np.where(first, BLOCK, COPY)
                common, times = np.unique(key[first], return_counts=True)
                common = common[times > MANY]
                kind[first & np.isin(key, common)] = WINDOWS
                key = np.where(kind == BLOCK, key, mix(whole, start.astype(np.uint64)))
                ids = part.column("id").take(pa.array(np.concatenate([doc, np.zeros(2 * len(common), np.int64)])))
                # two marks tell other batches that an anchor has several blocks
                key = np.concatenate([key, common, common])
                whole = np.concatenate([whole, np.zeros(len(common), np.uint64), np.ones(len(common), np.uint64)])
                place = np.concatenate([(start << 16) | (size << 2) | kind, np.full(2 * len(common), MARK)])
                digests = part.column("digest").take(pa.array(np.concatenate([doc, np.zeros(2 * len(common), np.int64)])))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(whole.view(np.int64)), ids, digests, pa.array(place)], ["anchor", "block", "id", "digest", "place"])

    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(run, f"anchor long, block long, id {kind}, digest long, place long")


def _questions(index: DataFrame) -> DataFrame:
    """(id, digest, places): the blocks of a document that are copies (kind COPY) or to be compared by windows."""
    kind, start = F.col("place").bitwiseAND(F.lit(3)), F.shiftright("place", 16)
    by_block, by_anchor = W.partitionBy("anchor", "block").orderBy("id", start), W.partitionBy("anchor")
    seen = index.withColumn("nth", F.rank().over(by_block)).withColumn("several", F.min("block").over(by_anchor) != F.max("block").over(by_anchor))
    verdict = F.when(kind != BLOCK, kind).when(F.col("nth") > 1, COPY).when(F.col("several"), WINDOWS)
    asked = seen.withColumn("verdict", verdict).filter(F.col("verdict").isin(COPY, WINDOWS))
    place = F.col("place") - kind + F.col("verdict")
    return asked.groupBy("id", "digest").agg(F.collect_list(place).alias("places"))


def _unpacked(batch: pa.RecordBatch, budget: int = 4_000_000):
    """Slices of a batch by packed size, with their texts."""
    unpack = zstandard.ZstdDecompressor().decompress
    for part in batches_of(batch, "packed", budget):
        yield part, pa.array([unpack(x) for x in part.column("packed").to_pylist()], pa.binary()).cast(pa.string())


def _listed(part: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """The values of a column of lists, and the row of each."""
    lists = part.column(name)
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(part.num_rows), sizes), lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def _window_rows(asked: DataFrame, window: int) -> DataFrame:
    """(hash, id, start, copy) of the windows to be compared; again, a batch sends the first of each."""
    def run(batches):
        for batch in batches:
            for part, texts in _unpacked(batch):
                bounds, words = flat_words(texts)
                doc, place = _listed(part, "places")
                compared = (place & 3) == WINDOWS
                doc, place = doc[compared], place[compared]
                size = (place >> 2) & 0x3FFF
                doc, start = np.repeat(doc, size), _ranges(place >> 16, size)
                at = bounds[doc] + start
                key = Passages(word_hashes(words)).hash(at, at + window, np.uint64(window))
                first = _firsts(key, _ranks(part.column("id"))[doc], start)
                key = np.where(first, key, mix(key, start.astype(np.uint64)))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), *[part.column(c).take(pa.array(doc)) for c in ("id", "digest")], pa.array(start), pa.array(~first)], ["hash", "id", "digest", "start", "copy"])

    kind = asked.schema["id"].dataType.simpleString()
    return asked.select("id", "digest", "packed", "places").mapInArrow(run, f"hash long, id {kind}, digest long, start long, copy boolean")


def _parsed(asked: DataFrame, window: int) -> DataFrame:
    """(id, digest, n_words, spans, kept): spans of words [start, end) that are removed, and the words left."""
    def run(batches):
        for batch in batches:
            for part, texts in _unpacked(batch):
                bounds, words = flat_words(texts)
                gone = np.zeros(len(words) + 1, np.int64)
                doc, place = _listed(part, "places")
                copies = (place & 3) == COPY
                doc, place = doc[copies], place[copies]
                np.add.at(gone, bounds[doc] + (place >> 16), 1)
                np.add.at(gone, bounds[doc] + (place >> 16) + ((place >> 2) & 0x3FFF) - 1 + window, -1)
                doc, start = _listed(part, "starts")
                np.add.at(gone, bounds[doc] + start, 1)
                np.add.at(gone, bounds[doc] + start + window, -1)
                covered = np.cumsum(gone)[:-1] > 0
                spans, kept = [], []
                for a, b in zip(bounds, bounds[1:]):
                    edges = np.flatnonzero(np.diff(np.concatenate([[False], covered[a:b], [False]]).astype(np.int8)))
                    spans.append([{"start": int(s), "end": int(e)} for s, e in edges.reshape(-1, 2)])
                    kept.append(" ".join(words.slice(a, b - a).filter(pa.array(~covered[a:b])).to_pylist()))
                span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("digest"), pa.array(np.diff(bounds)), pa.array(spans, span), pa.array(kept, pa.string())], ["id", "digest", "n_words", "spans", "kept"])

    kind = asked.schema["id"].dataType.simpleString()
    return asked.select("id", "digest", "packed", "places", "starts").mapInArrow(run, f"id {kind}, digest long, n_words long, spans array<struct<start: long, end: long>>, kept string")


def parsed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(id, digest, n_words, spans, kept) for the documents with a block that occurs elsewhere.

    A span is a series of words each of which some window of ``window`` words covers that occurs earlier:
    in a document with a smaller id, or in the same at an earlier word. ``kept`` is the text without
    the spans, its words joined by a space. Windows are judged on the input. Hashes have 64 bits.

    Null and short texts have no window. Rows that repeat an id are one document: windows at the same word of it
    are no copies of each other, and ``digest`` (xxhash64 of the text) tells its texts apart, each of which loses
    its own windows. A null id is one id, before all others.
    Other columns are not read. An empty table gives no rows. A batch sends one row for each block it has,
    so a passage in a third of all documents is one row per batch, and an anchor in very many
    different blocks is sent as windows, which spread.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("digest"), F.col(text_col).alias("text"))
    questions = materialize(_questions(_index_rows(texts, window, anchor)), "parse-questions")

    def pack(batches):
        for batch in batches:
            press = zstandard.ZstdCompressor(level=3).compress
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("digest"), pa.array([press(x) for x in batch.column("text").cast(pa.binary()).to_pylist()], pa.binary())], ["id", "digest", "packed"])

    kind = texts.schema["id"].dataType.simpleString()
    packed = texts.filter("text is not null").mapInArrow(pack, f"id {kind}, digest long, packed binary")

    def beside(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        """Joined by id, null too, and digest."""
        right = right.withColumnsRenamed({"id": "right_id", "digest": "right_digest"})
        same = F.col("id").eqNullSafe(F.col("right_id")) & (F.col("digest") == F.col("right_digest"))
        return left.join(right, same, how).drop("right_id", "right_digest")

    asked = materialize(beside(packed, questions, "inner"), "parse-texts")
    by_hash = W.partitionBy("hash").orderBy("id", "start")
    copied = _window_rows(asked, window).withColumn("nth", F.rank().over(by_hash)).filter("copy or nth > 1")
    starts = copied.groupBy("id", "digest").agg(F.collect_list("start").alias("starts"))
    return _parsed(beside(asked, starts, "left"), window).withColumnRenamed("id", id_col)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row per input row: id, n_words, n_removed, kept_sha256 of the words that are left."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    cut = parsed_documents(docs, id_col, text_col, **how).select(F.col(id_col).alias("__id"), F.col("digest").alias("__digest"), removed.alias("n_removed"), F.sha2("kept", 256).alias("cut_sha256")).filter("n_removed > 0")
    cut = cut.groupBy("__id", "__digest").agg(F.max("n_removed").alias("n_removed"), F.max_by("cut_sha256", "n_removed").alias("cut_sha256"))
    text = empty_if_null(text_col)
    whole = docs.select(
        F.col(id_col), F.xxhash64(text_col).alias("__own"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_words"),
        F.sha2(F.trim(F.regexp_replace(text, SPACE, " ")), 256).alias("whole_sha256"),
    )
    same = F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__digest"))
    return whole.join(cut, same, "left").select(id_col, "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce("cut_sha256", "whole_sha256").alias("kept_sha256"))
