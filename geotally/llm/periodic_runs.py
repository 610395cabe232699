"""Runs of words that repeat with a period, by maximal pairs over a tree of LCP intervals.

A pair of equal stretches that no word before or after both extends is maximal. A run of period q and length L is
a maximal pair of stretches of L - q words, q words apart, and every maximal pair that is at least three times as long
as its distance is a run of at least four periods (its smallest period is the smallest distance found for it).

Each document is worked on by itself. Only words in a five-word window that comes again in the
document can lie in a run, and of these only stretches that are long against the distance to the next copy of the
window; suffixes that begin elsewhere are left out of the tree, which changes no result.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from geotally.llm.common import batches_of, flat_words, mix

#: A run has at least so many words and so many periods; the shortest pair that makes one has five words.
LEAST, PERIODS, PAIR = 6, 4, 5


def _starts(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Positions at which a pair that makes a run may begin, in ascending order."""
    if len(codes) < PAIR:
        return np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    key = owner.astype(np.uint64)
    windows = len(codes) - PAIR + 1
    key = key[:windows].copy()
    for step in range(PAIR):
        key = mix(key, codes[step : step + windows].astype(np.uint64))
    whole = owner[:windows] == owner[PAIR - 1 :]
    order = np.argsort(key, kind="stable")
    order = order[whole[order]]
    gap = np.full(windows, -1, np.int64)  # to the next copy of the window
    again = key[order[1:]] == key[order[:-1]]
    gap[order[:-1][again]] = (order[1:] - order[:-1])[again]
    held = np.flatnonzero(gap > 0)
    if not len(held):
        return held
    # a pair of distance q covers 3q - 4 windows in a row whose next copies are at most q away
    new = np.concatenate([[True], (held[1:] != held[:-1] + 1) | (owner[held[1:]] != owner[held[:-1]])])
    stretch = np.cumsum(new) - 1
    least = np.minimum.reduceat(gap[held], np.flatnonzero(new))
    good = np.bincount(stretch) >= np.maximum((PERIODS - 1) * least - PAIR + 1, 1)
    held = held[good[stretch]]
    copies = np.unique(np.concatenate([held, held + gap[held]]))  # each first stretch, and the last copy's
    return copies


def _ranks(codes: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Ranks of the stretches of 1, 2, 4, ... words from each position; a document's end sorts first."""
    owner = np.repeat(np.arange(len(bounds) - 1, dtype=np.int64), np.diff(bounds))
    ranks = [np.unique(owner * (int(codes.max()) + 2) + codes, return_inverse=True)[1].astype(np.int64) + 1]
    ends, width, longest = bounds[1:][owner], 1, int(np.diff(bounds).max())
    at = np.arange(len(codes))
    while width < longest and ranks[-1].max() < len(codes):
        rank = ranks[-1]
        second = np.where(at + width < ends, rank[np.minimum(at + width, len(codes) - 1)], 0)
        ranks.append(np.unique(rank * (len(codes) + 1) + second, return_inverse=True)[1].astype(np.int64) + 1)
        width *= 2
    return ranks


def _common(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Words that the suffixes at ``a`` and ``b`` have in common at their beginning."""
    length, n = np.zeros(len(a), np.int64), len(ranks[0])
    for k in range(len(ranks) - 1, -1, -1):
        x, y = a + length, b + length
        same = (x < n) & (y < n)
        same[same] = ranks[k][x[same]] == ranks[k][y[same]]
        length += same.astype(np.int64) << k
    return length


class _Node:
    """Positions below an LCP interval, sorted, in a list for each word that stands on their left."""

    __slots__ = ("depth", "size", "classes")

    def __init__(self, depth: int, size: int, classes: dict[int, list[int]]):
        self.depth, self.size, self.classes = depth, size, classes


def _join(into: _Node, other: _Node, depth: int, found: list[tuple[int, int, int]]) -> _Node:
    """Both nodes as one; pairs between them of unlike left words and a short distance are maximal pairs."""
    if into.size < other.size:
        into, other = other, into
    far = depth // (PERIODS - 1)
    for left, places in other.classes.items():
        for there, others in into.classes.items():
            if there != left:
                for x in places:
                    for y in others[bisect_left(others, x - far) : bisect_right(others, x + far)]:
                        if abs(x - y) + depth >= LEAST:
                            found.append((min(x, y), abs(x - y), depth))
    for left, places in other.classes.items():
        mine = into.classes.setdefault(left, [])
        if len(places) > 8:
            mine.extend(places)
            mine.sort()
        else:
            for x in places:
                insort(mine, x)
    into.size += other.size
    return into


def maximal_pairs(codes: np.ndarray, bounds: np.ndarray, starts: np.ndarray) -> list[tuple[int, int, int]]:
    """Start, distance and length of the maximal pairs at ``starts`` that are three times as long as their distance.

    The stack holds the open intervals from the shallowest to the deepest; an interval ends when a suffix
    comes that has less in common with the one before it, and is then a child of the interval around it.
    """
    ranks = _ranks(codes, bounds)
    order = starts[np.argsort(ranks[-1][starts], kind="stable")]
    shared = [0, *_common(ranks, order[:-1], order[1:]).tolist()]
    left = np.where(np.isin(order, bounds[:-1]), -1, codes[np.maximum(order - 1, 0)]).tolist()
    found: list[tuple[int, int, int]] = []
    stack: list[_Node] = []
    now = None  # the subtree that holds the last suffix
    for place, word, common in zip(order.tolist(), left, shared):
        while stack and stack[-1].depth > common:
            top = stack.pop()
            now = _join(top, now, top.depth, found)
        if common >= PAIR:  # a shorter common beginning makes no run
            if stack and stack[-1].depth == common:
                stack[-1] = _join(stack[-1], now, common, found)
            else:
                stack.append(now)
            stack[-1].depth = common
        now = _Node(0, 1, {word: [place]})
    while stack:
        top = stack.pop()
        now = _join(top, now, top.depth, found)
    return found


def runs_of(codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, start, length and smallest period of every run, in this order; documents end at ``bounds``."""
    starts, none = _starts(codes, bounds), np.zeros(0, np.int64)
    if not len(starts):
        return none, none, none, none
    docs = np.unique(np.searchsorted(bounds, starts, side="right") - 1)  # the others have no run
    sizes = bounds[docs + 1] - bounds[docs]
    inner = np.concatenate([[0], np.cumsum(sizes)])
    moved = np.repeat(bounds[docs] - inner[:-1], sizes)
    of = np.searchsorted(docs, np.searchsorted(bounds, starts, side="right") - 1)
    pairs = maximal_pairs(codes[np.arange(inner[-1]) + moved], inner, starts - (bounds[docs] - inner[:-1])[of])
    if not pairs:
        return none, none, none, none
    start, period, length = np.asarray(pairs, np.int64).T
    length = length + period
    order = np.lexsort((period, length, start))
    start, period, length = start[order], period[order], length[order]
    new = np.concatenate([[True], (start[1:] != start[:-1]) | (length[1:] != length[:-1])])  # the first has the smallest period
    start, period, length = start[new], period[new], length[new]
    at = np.searchsorted(inner, start, side="right") - 1
    order = np.lexsort((period, start, at))
    return docs[at[order]], (start - inner[at])[order], length[order], period[order]


def periodic_tails(bounds: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Which word stands at each place once some documents' ends are made periodic.

    ``chosen`` has a hash for each document, -1 for none. One in ten is changed: with g the hash without its last
    digit and n words, the words from a = g mod n on repeat with period 1 + floor((n - a) / (3 + g mod 8)).
    """
    at = np.arange(bounds[-1])
    for doc in np.flatnonzero((chosen >= 0) & (chosen % 10 == 0) & (np.diff(bounds) > 0)):
        n, g = int(bounds[doc + 1] - bounds[doc]), int(chosen[doc]) // 10
        a = g % n
        period = 1 + (n - a) // (3 + g % 8)
        first = bounds[doc] + a
        at[first : bounds[doc + 1]] = first + np.arange(n - a) % period
    return at


def periodic_runs(docs: DataFrame, id: str = "doc_id", text: str = "text", tails: bool = False) -> DataFrame:
    """Per row of ``docs``: ``id``, ``runs`` (array of start, length, period) by start and period, and ``collapsed``.

    A run is a stretch of at least 6 words and 4 periods with smallest period ``period`` that no neighbouring word
    extends; words count from 0. ``collapsed`` has the words, joined by one space, without those that a run
    covers after its first period. Null and empty texts have no words: no runs, an empty ``collapsed``. Rows are taken
    one by one, so repeated and null ids are kept; other columns are not read. ``tails`` first makes the ends of a
    tenth of the documents periodic, by a hash of their id (a null id: unchanged).
    """
    hashed = F.crc32(F.col(id).cast("string").cast("binary")) if tails else F.lit(None).cast("long")
    given = docs.select(F.col(id).alias("id"), F.coalesce(hashed, F.lit(-1)).cast("long").alias("hash"), F.col(text).alias("text"))
    record = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batches_of(batch, "text", 4_000_000):
                bounds, words = flat_words(part.column(2))
                bounds = np.asarray(bounds, np.int64)
                at = periodic_tails(bounds, part.column(1).to_numpy(zero_copy_only=False))
                codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)[at]
                doc, start, length, period = runs_of(codes, bounds)
                dropped = np.zeros(len(codes) + 1, np.int64)
                first = bounds[doc] + start
                np.add.at(dropped, first + period, 1)
                np.add.at(dropped, first + length, -1)
                kept = np.cumsum(dropped)[:-1] == 0
                ends = np.concatenate([[0], np.cumsum(kept)])[bounds].astype(np.int32)
                collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), words.take(pa.array(at[kept]))), " ")
                columns = pa.StructArray.from_arrays([pa.array(start), pa.array(length), pa.array(period)], fields=list(record))
                of = np.searchsorted(doc, np.arange(len(bounds))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(of), columns), collapsed], ["id", "runs", "collapsed"])

    kind = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))
    schema = T.StructType([T.StructField("id", given.schema["id"].dataType), T.StructField("runs", kind), T.StructField("collapsed", T.StringType())])
    return given.mapInArrow(run, schema).withColumnRenamed("id", id)


def digests(runs: DataFrame, id: str = "doc_id") -> DataFrame:
    """What identifies a document's runs: their number, the longest one, and hashes of all runs and of what is left."""
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    frame = runs.withColumn("__longest", longest)
    length = -F.col("__longest.less")
    return frame.select(
        id, F.size("runs").cast("long").alias("n_runs"), F.col("__longest.start").alias("start"), length.alias("length"), F.col("__longest.period").alias("period"),
        F.expr("(1000 * -__longest.less) div __longest.period").alias("exponent_milli"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
