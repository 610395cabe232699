"""Language of text: scripts narrow the candidates of a word, Viterbi labels spans of mixed text.

Per-word scores come from counts of byte n-grams over all documents to learn from. The most
probable sequence of labels pays a penalty for each switch, so stray words stay with their span.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from geotally.llm.common import batches_of, flat_words

# fixed values: first and last code point of the letters of each script (Unicode blocks)
SCRIPTS = {
    "latin": (0x0041, 0x024F), "greek": (0x0370, 0x03FF), "cyrillic": (0x0400, 0x052F), "armenian": (0x0530, 0x058F),
    "hebrew": (0x0590, 0x05FF), "arabic": (0x0600, 0x06FF), "devanagari": (0x0900, 0x097F), "bengali": (0x0980, 0x09FF),
    "tamil": (0x0B80, 0x0BFF), "thai": (0x0E00, 0x0E7F), "georgian": (0x10A0, 0x10FF), "ethiopic": (0x1200, 0x137F),
    "kana": (0x3040, 0x30FF), "han": (0x4E00, 0x9FFF), "hangul": (0xAC00, 0xD7AF),
}
ORDERS = (3, 4)
SLOTS = 1 << 13
#: Counts of a language: n-grams of each order, then words of each script (0: another one).
WIDTH = SLOTS * len(ORDERS) + len(SCRIPTS) + 1
#: A script is a candidate's if at least this share of its words has it.
SCRIPT_SHARE = 0.01


@dataclass(frozen=True)
class Model:
    languages: list[str]
    log_share: np.ndarray  # slot, language
    scripts: np.ndarray  # script, language: bool

    def word_scores(self, slots: np.ndarray, starts: np.ndarray, scripts: np.ndarray, floor: float = 12.0) -> np.ndarray:
        """Per distinct word and language the log probability of its n-grams, less the best of the word."""
        out = np.zeros((len(scripts), len(self.languages)), np.float32)
        full = starts[1:] > starts[:-1]
        if full.any():
            out[full] = np.add.reduceat(self.log_share[slots], starts[:-1][full], axis=0) / np.float32(len(ORDERS))
        allowed = self.scripts[scripts]
        allowed |= ~allowed.any(axis=1, keepdims=True)
        out[~allowed] = -np.inf
        out -= out.max(axis=1, keepdims=True)
        out[~full] = 0
        return np.maximum(out, -np.float32(floor))


def word_slots(distinct: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The n-gram slots of each distinct word, their offsets, and each word's script.

    Words are lower-cased and lose everything but letters; n-grams are of the bytes between two
    marks. A word without letters has no slots.
    """
    letters = pc.replace_substring_regex(pc.utf8_lower(distinct), r"[^\p{L}]+", "")
    sizes = pc.binary_length(letters).to_numpy(zero_copy_only=False).astype(np.int64)
    heads = np.array([ord(c) if c else 0 for c in pc.utf8_slice_codeunits(letters, 0, 1).to_pylist()], np.int64)
    scripts = np.zeros(len(heads), np.int64)
    for k, (a, b) in enumerate(SCRIPTS.values()):
        scripts[(heads >= a) & (heads <= b)] = k + 1
    marked = pc.binary_join_element_wise(pa.scalar(b"\x01"), letters.cast(pa.binary()), pa.scalar(b"\x02"), pa.scalar(b""))
    raw = np.frombuffer(b"".join(marked.to_pylist()), np.uint8).astype(np.uint64)
    begins = np.concatenate([[0], np.cumsum(sizes + 2)])
    pieces, owners = [], []
    for k, order in enumerate(ORDERS):
        n = np.where(sizes > 0, np.maximum(sizes + 2 - order + 1, 0), 0)
        owner = np.repeat(np.arange(len(sizes)), n)
        at = begins[:-1][owner] + np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        h = np.zeros(len(at), np.uint64)
        for j in range(order):
            h = h * np.uint64(257) + raw[at + j]
        h = (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 13)
        pieces.append(h.astype(np.int64) + k * SLOTS)
        owners.append(owner)
    owner, slots = np.concatenate(owners), np.concatenate(pieces)
    order = np.argsort(owner, kind="stable")
    starts = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(sizes)))])
    return slots[order], starts, scripts


def language_counts(docs: DataFrame) -> DataFrame:
    """(lang, slot, n) over all rows of ``docs`` (text, lang); summed in the task before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]):
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in batches_of(batch, "text"):
                bounds, words = flat_words(part.column("text"))
                if not len(words):
                    continue
                coded = words.dictionary_encode()
                codes = coded.indices.to_numpy(zero_copy_only=False)
                slots, starts, scripts = word_slots(coded.dictionary)
                owner = np.repeat(np.arange(len(scripts)), np.diff(starts))
                langs = part.column("lang").dictionary_encode()
                of_word = np.repeat(langs.indices.to_numpy(zero_copy_only=False), np.diff(bounds))
                for k, lang in enumerate(langs.dictionary.to_pylist()):
                    times = np.bincount(codes[of_word == k], minlength=len(scripts)).astype(np.float64)
                    counts = np.bincount(slots, weights=times[owner], minlength=WIDTH)
                    lettered = np.where(np.diff(starts) > 0, times, 0)
                    counts += np.bincount(SLOTS * len(ORDERS) + scripts, weights=lettered, minlength=WIDTH)
                    held[lang] = held[lang] + counts if lang in held else counts
        for lang, counts in held.items():
            found = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(found, pa.int32()), pa.array(counts[found].astype(np.int64))], ["lang", "slot", "n"])

    return docs.select("text", "lang").mapInArrow(run, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame) -> Model:
    """The model of all rows of ``docs`` (text, lang) whose lang is not null.

    The driver gets at most WIDTH counts a language, however many documents there are.
    """
    counts = language_counts(docs.filter("lang is not null")).toPandas()
    languages = sorted(counts["lang"].unique())
    table = np.zeros((WIDTH, len(languages)))
    table[counts["slot"], np.searchsorted(languages, counts["lang"])] = counts["n"]
    grams = SLOTS * len(ORDERS)
    shares = table[:grams].reshape(len(ORDERS), SLOTS, -1) + 0.5
    log_share = np.log(shares / shares.sum(axis=1, keepdims=True)).reshape(grams, -1).astype(np.float32)
    scripts = table[grams:] / np.maximum(table[grams:].sum(axis=0), 1) >= SCRIPT_SHARE
    return Model(languages, log_share, scripts)


def viterbi(scores: np.ndarray, bounds: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of every word: texts side by side, the longest first, word by word."""
    sizes = np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = bounds[:-1][order], sizes[order]
    active = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0), side="left")
    kind = np.min_scalar_type(max(scores.shape[1] - 1, 0))  # a byte a label, and more only for over 256 languages
    labels = np.arange(scores.shape[1], dtype=kind)
    best, back = np.zeros((len(order), scores.shape[1]), np.float32), np.zeros(scores.shape, kind)
    for t, m in enumerate(active):
        at, v = starts[:m] + t, best[:m]
        top = v.argmax(axis=1)
        least = v[np.arange(m), top][:, None] - penalty
        back[at] = np.where(v >= least, labels, top[:, None])
        best[:m] = np.maximum(v, least) + scores[at]
    path, state = np.zeros(len(scores), kind), best.argmax(axis=1)
    for t in range(len(active) - 1, -1, -1):
        m = active[t]
        at = starts[:m] + t
        path[at] = state[:m]
        state[:m] = back[at, state[:m]]
    return path


def _labelled(part: pa.RecordBatch, model: Model, penalty: float):
    bounds, words = flat_words(part.column("text"))
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    slots, starts, scripts = word_slots(coded.dictionary)
    lettered = (np.diff(starts) > 0)[codes] if len(codes) else np.zeros(0, bool)
    scores = model.word_scores(slots, starts, scripts)[codes] if len(codes) else np.zeros((0, len(model.languages)), np.float32)
    return bounds, lettered, scores, viterbi(scores, bounds, penalty)


def identified(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", penalty: float = 8.0) -> DataFrame:
    """One row per input row: id, lang_pred, score.

    lang_pred is the language of most words with letters, by the label of their spans; score is its
    share of these words. Ties go to the better total of word scores, then to the first name. A text that
    is null or has no letter is ``und`` with score 0, as is every text if there is nothing to learn
    from. Repeated rows are rated alike. Other columns are not read. An empty table gives no rows.
    """
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in batches_of(batch, "text"):
                n, k = part.num_rows, len(model.languages)
                if k == 0:
                    pred, share = np.full(n, -1), np.zeros(n)
                else:
                    bounds, lettered, scores, path = _labelled(part, model, penalty)
                    doc = np.repeat(np.arange(n), np.diff(bounds))
                    votes = np.bincount((doc * k + path.astype(np.int64))[lettered], minlength=n * k).reshape(n, k)
                    total = np.zeros((n, k))
                    full = np.diff(bounds) > 0
                    if full.any():
                        total[full] = np.add.reduceat(scores, bounds[:-1][full], axis=0)
                    pred = np.lexsort((np.broadcast_to(-np.arange(k), (n, k)), total, votes), axis=1)[:, -1]
                    words = votes.sum(axis=1)
                    share = votes[np.arange(n), pred] / np.maximum(words, 1)
                    pred = np.where(words > 0, pred, -1)
                names = pa.array([*model.languages, "und"], pa.string()).take(pa.array(np.where(pred < 0, k, pred)))
                yield pa.RecordBatch.from_arrays([part.column("id"), names, pa.array(share, pa.float64())], ["id", "lang_pred", "score"])

    kind = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def spans(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", penalty: float = 8.0) -> DataFrame:
    """One row per run of words with one label: id, start, words, lang (start counts words from 0)."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in batches_of(batch, "text") if model.languages else ():
                bounds, _, _, path = _labelled(part, model, penalty)
                doc = np.repeat(np.arange(part.num_rows), np.diff(bounds))
                new = np.concatenate([[True], (path[1:] != path[:-1]) | (doc[1:] != doc[:-1])]) if len(path) else np.zeros(0, bool)
                at = np.flatnonzero(new)
                yield pa.RecordBatch.from_arrays([part.column("id").take(pa.array(doc[at])), pa.array(at - bounds[doc[at]]), pa.array(np.diff(np.append(at, len(path)))), pa.array(model.languages, pa.string()).take(pa.array(path[at]))], ["id", "start", "words", "lang"])

    kind = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(run, f"id {kind}, start long, words long, lang string").withColumnRenamed("id", id_col)


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, by which documents are held out; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds
