"""Best-fit packing of tokenised documents into sequences, planned on counts of lengths.

Documents longer than a sequence are cut. The histogram of piece lengths, one count for each length up
to the capacity, is all that the driver gets: it packs counts, longest first, each into the
tightest open sequences, and notes for runs of equal pieces which slots they take. Pieces then find their
slot by a join on their rank within their length.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from geotally.llm.common import batches_of, bucket_bits, materialize, order_hash, with_running_total

#: Bytes of text that a worker encodes at once.
CHARS = 8_000_000
#: White space as the tokenizer's pattern sees it.
_SPACE = r"[\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
#: Cutting before a space is safe unless the space belongs to a longer run, or ends the text.
_UNSAFE = rf" {_SPACE}|{_SPACE} | $"
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def _encoder(path: str):
    """The byte-level BPE of a tokenizers file, by the faster of the two libraries that read it."""
    import tiktoken

    given = json.loads(open(path, encoding="utf-8").read())
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    special = {t["content"]: t["id"] for t in given["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in given["model"]["vocab"].items() if token not in special}
    sizes = np.zeros(1 + max([*ranks.values(), *special.values()]), np.int64)
    for token, i in [*ranks.items(), *((s.encode(), i) for s, i in special.items())]:
        sizes[i] = len(token)
    coding = tiktoken.Encoding("byte_bpe", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return (lambda text: np.asarray(coding.encode(text, allowed_special="all"), np.uint32)), sizes


def _gather(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The ranges of ``values`` that start at ``starts``, one after the other."""
    ends = np.cumsum(counts)
    return values[np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)]


def encode_texts(texts: pa.Array, path: str) -> list[np.ndarray]:
    """Token ids of each text, as the tokenizer gives them for the whole text.

    The tokenizer never joins what stands on two sides of a single space, except that the space goes
    with what follows. So texts are cut before their spaces, each distinct part is encoded once, all in
    one call, and the parts' ids are told apart by the bytes that they stand for. Texts with
    longer runs of white space around a space are encoded as they are.
    """
    encode, sizes = _encoder(path)
    texts = pc.fill_null(texts, "")
    unsafe = pc.match_substring_regex(texts, _UNSAFE).to_numpy(zero_copy_only=False)
    lists = pc.split_pattern(texts, " ")
    bounds = np.asarray(lists.offsets, np.int64)
    parts = lists.flatten()
    bounds = bounds - bounds[0]
    coded = parts.dictionary_encode()
    codes, distinct = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
    used = np.zeros(len(distinct), bool)
    first = np.zeros(len(codes), bool)
    first[bounds[:-1]] = True
    skip = first | np.repeat(unsafe, np.diff(bounds))
    used[codes[~skip]] = True
    place = np.cumsum(used) - 1
    known = distinct.filter(pa.array(used))
    ids = encode("".join([" " + x for x in known.to_pylist()]))
    ends = np.searchsorted(np.cumsum(sizes[ids]), np.cumsum(pc.binary_length(known).to_numpy(zero_copy_only=False).astype(np.int64) + 1)) + 1 if len(known) else np.zeros(0, np.int64)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    out = []
    for i in range(len(texts)):
        if unsafe[i]:
            out.append(encode(texts[i].as_py()))
            continue
        own = place[codes[bounds[i] + 1 : bounds[i + 1]]]
        out.append(np.concatenate([encode(parts[int(bounds[i])].as_py()), _gather(ids, starts[own], ends[own] - starts[own])]))
    return out


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 1024, end: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, piece, start, length, ids (unsigned little-endian 32-bit numbers).

    A document's ids are those of its text and ``end``. Only documents of more than ``capacity`` ids are
    cut; all pieces but the first are full. A null or empty text is ``end`` alone. Repeated rows are
    documents of their own. Other columns are not read. No documents give no pieces.
    """
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in batches_of(batch, "text", CHARS):
                row, number, start, length, ids = [], [], [], [], []
                for i, own in enumerate(encode_texts(part.column("text"), tokenizer)):
                    own = np.append(own, np.uint32(end))
                    cuts = [0, *range(len(own) % capacity or min(capacity, len(own)), len(own), capacity), len(own)]
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        row.append(i), number.append(k), start.append(a), length.append(b - a), ids.append(own[a:b].tobytes())
                yield pa.RecordBatch.from_arrays([part.column("id").take(pa.array(row, pa.int64())), pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())], ["id", "piece", "start", "length", "ids"])

    kind = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(run, f"id {kind}, piece int, start long, length long, ids binary").withColumnRenamed("id", id_col)


def plan_slots(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing on counts: (length, first rank, pieces, pieces a sequence, first sequence, offset).

    Open sequences of equal content are one group, so a step works on counts. Every length splits at
    most one group and opens at most two, hence the number of rows depends on the capacity alone.
    """
    plan: list[tuple[int, int, int, int, int, int]] = []
    free: dict[int, list[tuple[int, int]]] = {}  # room left: groups of (first sequence, sequences)
    opened = 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        for room in [*sorted(r for r in free if r >= length), capacity]:
            each = room // length
            groups = free.pop(room, []) if room < capacity else []
            while left and (groups or room == capacity):
                if room == capacity:
                    first, count = opened, -(-left // each)
                    opened += count
                else:
                    first, count = groups.pop()
                filled = min(count, left // each)
                if filled:
                    plan.append((length, rank, filled * each, each, first, capacity - room))
                    free.setdefault(room - each * length, []).append((first, filled))
                    left, rank = left - filled * each, rank + filled * each
                if filled < count and left:  # fewer than a sequence's worth remain
                    plan.append((length, rank, left, left, first + filled, capacity - room))
                    free.setdefault(room - left * length, []).append((first + filled, 1))
                    rank, filled, left = rank + left, filled + 1, 0
                if filled < count:
                    groups.append((first + filled, count - filled))
            if groups:
                free.setdefault(room, []).extend(groups)
    return plan


def with_slots(pieces: DataFrame, capacity: int = 1024, id_col: str = "doc_id") -> DataFrame:
    """``pieces`` (with columns piece and length) with sequence_id and offset.

    Ranks within a length have two levels, so a length that most pieces have is spread over hash
    buckets; they depend on ids and piece numbers only. The plan that is broadcast has a bounded
    number of rows for a capacity, whatever the number of pieces.
    """
    spark = pieces.sparkSession
    rows = materialize(pieces.withColumn("__ordered", order_hash(id_col)), "pack-pieces")
    histogram = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}  # at most `capacity` rows
    plan = spark.createDataFrame(plan_slots(histogram, capacity), "__length long, __first long, __pieces long, __each long, __sequence long, __offset long")
    ranked = with_running_total(rows, ["length"], "__ordered", [id_col, "piece"], F.lit(1), "__rank", bucket_bits(sum(histogram.values())))
    run = F.col("__rank") - F.col("__first")
    slot = (F.col("length") == F.col("__length")) & (run >= 0) & (run < F.col("__pieces"))
    placed = ranked.join(F.broadcast(plan), slot)
    return placed.select(*pieces.columns, (F.col("__sequence") + F.floor(run / F.col("__each"))).alias("sequence_id"), (F.col("__offset") + run % F.col("__each") * F.col("length")).alias("offset"))


def pack(docs: DataFrame, tokenizer: str, capacity: int = 1024, end: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of ``token_pieces`` with their sequence and place in it."""
    return with_slots(token_pieces(docs, tokenizer, capacity, end, id_col, text_col), capacity, id_col)


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: sequence_id, length, ids; its pieces, at most the capacity, are joined."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    rows = packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts"))
    return rows.select("sequence_id", "length", F.aggregate("parts", F.lit(b""), lambda s, p: F.concat(s, p["ids"])).alias("ids"))


def digests(docs: DataFrame, tokenizer: str, capacity: int = 1024, end: int = 2) -> DataFrame:
    """``pack`` with a checksum in the place of the ids."""
    pieces = token_pieces(docs, tokenizer, capacity, end)
    return with_slots(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), capacity)
