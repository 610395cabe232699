"""Token counts by a two-tier lookup of pre-token lengths inside the tasks.

A pre-token is a stretch of text that the tokenizer never joins with what stands beside it, so the counts
of a text's pre-tokens add up to its own. The lengths of frequent pre-tokens are broadcast as a compact hash
table; what it lacks is looked up in a cache of the worker, and only what that lacks is encoded. No pre-token is
shuffled. Which pre-tokens are in the table or in a cache changes the speed and never a count.
"""

from __future__ import annotations

from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from geotally.llm.common import batches_of

#: Documents from which the frequent pre-tokens are taken, and entries of the table at most (18 bytes a slot).
SAMPLE, FREQUENT = 8_192, 65_536
#: Entries of a worker's cache at most, and bytes of a pre-token that is worth keeping.
CACHED, LONGEST = 500_000, 64

_SPACE, _LINE, _MARK = 0x20, 0x0A, "▁"


class Lengths:
    """Hash table of pre-token lengths: open addressing over 128-bit digests, looked up for whole arrays."""

    def __init__(self, digests: np.ndarray, lengths: np.ndarray):
        size = 1 << max(4, int(2 * len(digests)).bit_length())
        self.low, self.high, self.length = np.zeros(size, np.uint64), np.zeros(size, np.uint64), np.full(size, -1, np.int32)
        left = np.arange(len(digests))
        place = self._first(digests)
        while len(left):  # each round settles one entry per free slot; the others try the next slot
            free = left[self.length[place[left]] < 0]
            _, one = np.unique(place[free], return_index=True)
            won = free[one]
            self.low[place[won]], self.high[place[won]], self.length[place[won]] = digests[won, 0], digests[won, 1], lengths[won]
            left = np.setdiff1d(left, won, assume_unique=True)
            place[left] = (place[left] + 1) & (size - 1)

    def _first(self, digests: np.ndarray) -> np.ndarray:
        return (digests[:, 0] & np.uint64(len(self.low) - 1)).astype(np.int64)

    def find(self, digests: np.ndarray) -> np.ndarray:
        """The length for each digest, -1 where the table has none."""
        out, place, left = np.full(len(digests), -1, np.int32), self._first(digests), np.arange(len(digests))
        while len(left):
            at = place[left]
            out[left] = np.where((self.low[at] == digests[left, 0]) & (self.high[at] == digests[left, 1]), self.length[at], out[left])
            left = left[(out[left] < 0) & (self.length[at] >= 0)]
            place[left] = (place[left] + 1) & (len(self.low) - 1)
        return out


class _Encoder:
    """A sentencepiece model, and where its texts may be cut."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        joined = any(a != _MARK and b == _MARK for p in pieces for a, b in zip(p, p[1:]))
        as_given = "".join(self.model.encode("a  ﬁ x ", out_type=str)) == "_a__ﬁ_x_".replace("_", _MARK)
        alone = len(self.model.encode("\n")) + 1 == len(self.model.encode("\n\n")) and not any("\n" in p for p in pieces)
        #: tokens of a space that stands alone
        self.mark = len(self.model.encode("\n")) - 1 if alone else len(self.model.encode("x ")) - len(self.model.encode("x"))
        self.spaces, self.lines = as_given and not joined, as_given and not joined and alone
        self.cache: dict[bytes, int] = {}

    def count(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.model.encode(texts, num_threads=1)]

    def lengths(self, keys: list[bytes]) -> list[int]:
        """Tokens of each key, one space before it included; no key stands for that space alone."""
        cache, out = self.cache, [self.cache.get(k, -1) for k in keys]
        missing = [i for i, n in enumerate(out) if n < 0]
        for i, n in zip(missing, self.count([keys[i].decode("utf-8", "replace") for i in missing]), strict=True):
            out[i] = n if keys[i] else self.mark
            if len(keys[i]) <= LONGEST:
                if len(cache) >= CACHED:
                    cache.clear()
                cache[keys[i]] = out[i]
        return out


@lru_cache(maxsize=2)
def _encoder(path: str) -> _Encoder:
    return _Encoder(path)


def pre_tokens(texts: pa.Array, encoder: _Encoder) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """For all texts: the document of each pre-token, the keys, and what to take off each length.

    A text is cut before a space or line feed that follows something else than a space (line feed) or its
    sign. The space that the tokenizer puts before every text stands for the one that a key leaves out.
    """
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    cut = np.zeros(len(data), bool)
    if encoder.spaces and len(data):
        space = data == _SPACE
        cut[1:] = space[1:] & ~space[:-1]
        sign = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)) + 3 if len(data) > 2 else np.zeros(0, np.int64)
        cut[sign[sign < len(data)]] = False
    if encoder.lines and len(data):
        line = data == _LINE
        cut[1:] |= line[1:] & ~line[:-1]
    first = bounds[:-1][np.diff(bounds) > 0]
    cut[first] = True
    starts = np.flatnonzero(cut)
    at_start = np.zeros(len(data), bool)
    at_start[first] = True
    inner = ~at_start[starts]
    spaced = inner & (data[starts] == _SPACE)
    # keys are the bytes without the one space that the tokenizer adds again
    kept = np.ones(len(data), bool)
    kept[starts[spaced]] = False
    sizes = np.diff(np.append(starts, len(data))) - spaced
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    keys = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[kept])])
    owner = np.searchsorted(bounds, starts, side="right") - 1
    return owner, keys, np.where(inner & ~spaced, encoder.mark, 0)


def _digests(keys: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh3_128_digest
    return np.frombuffer(b"".join(map(digest, keys)), np.uint64).reshape(-1, 2)


def frequent_lengths(docs: DataFrame, path: str, text: str = "text", sample: int = SAMPLE, most: int = FREQUENT) -> Lengths:
    """The table for the most frequent pre-tokens of about ``sample`` documents (all, where there are fewer).

    Eight tasks count those of an eighth of the sample each; a row of at most ``most`` entries comes from each.
    """
    rows = docs.count()
    drawn = docs.select(F.col(text).alias("text"))
    drawn = drawn if rows <= sample else drawn.sample(sample / rows, seed=11)

    def tops(batches):
        counts, encoder = Counter(), _encoder(path)
        for batch in batches:
            for part in batches_of(batch, "text", 4_000_000):
                coded = pre_tokens(part.column(0), encoder)[1].dictionary_encode()
                for key, n in zip(coded.dictionary.to_pylist(), np.bincount(coded.indices.to_numpy(zero_copy_only=False), minlength=len(coded.dictionary)).tolist()):
                    if len(key) <= LONGEST:
                        counts[key] += n
        top = counts.most_common(most)
        keys = [k for k, _ in top]
        yield pa.RecordBatch.from_pydict({"keys": pa.array([keys], pa.list_(pa.binary())), "n": pa.array([[n for _, n in top]], pa.list_(pa.int64())), "lengths": pa.array([_encoder(path).lengths(keys)], pa.list_(pa.int32()))})

    counts, lengths = Counter(), {}
    for row in drawn.repartition(8).mapInArrow(tops, "keys array<binary>, n array<long>, lengths array<int>").collect():
        keys = [bytes(k) for k in row["keys"]]
        counts.update(dict(zip(keys, row["n"])))
        lengths.update(zip(keys, row["lengths"]))
    chosen = [k for k, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:most]]
    return Lengths(_digests(chosen), np.fromiter((lengths[k] for k in chosen), np.int32, len(chosen)))


def token_counts(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", limit: int = 4096, sample: int = SAMPLE, most: int = FREQUENT) -> DataFrame:
    """``id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more tokens than ``limit``) of each row of ``docs``.

    ``path`` names a sentencepiece model that every executor finds there; counts are those of the library for
    the whole text, without begin or end. A null text counts as empty: no bytes, no tokens. Null and
    repeated ids are counted row by row; other columns are not read. A model whose pieces run over a space, or that
    rewrites texts, has texts encoded whole. An empty table gives no rows.
    """
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(frequent_lengths(docs, path, text, sample, most))

    def count(batches):
        encoder, lengths = _encoder(path), table.value
        for batch in batches:
            for part in batches_of(batch, "text", 4_000_000):
                owner, keys, less = pre_tokens(part.column(1), encoder)
                coded = keys.dictionary_encode()
                distinct = coded.dictionary.to_pylist()
                found = lengths.find(_digests(distinct))
                misses = np.flatnonzero(found < 0)
                found[misses] = encoder.lengths([distinct[i] for i in misses])
                tokens = found[coded.indices.to_numpy(zero_copy_only=False)] - less if len(keys) else np.zeros(0, np.int64)
                total = np.bincount(owner, weights=tokens, minlength=len(part)).astype(np.int64)
                sizes = pc.fill_null(pc.binary_length(part.column(1)), 0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), sizes, pa.array(total), pa.array(total > limit)], ["id", "n_bytes", "n_tokens", "over_limit"])

    given = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    schema = T.StructType([T.StructField("id", given.schema["id"].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])
    return given.mapInArrow(count, schema).withColumnRenamed("id", id)
