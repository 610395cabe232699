"""Toxicity by a convolutional classifier: hashed word embeddings, several filter widths, max pooling.

Trained in numpy on a bounded sample of labelled documents; applied to every whole text in its task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from geotally.llm.common import WORD, batches_of, empty_if_null, flat_words, order_hash

BUCKETS, DIM, FILTERS, WIDTHS = 1 << 15, 12, 12, (1, 2, 3)
#: A word has one hashed feature for itself and one for each of its beginnings of so many letters.
STEMS = (4, 6, 8)
FEATURES = 1 + len(STEMS)
#: Documents of each label that training may take, and words that such a document may have.
SAMPLE, LONGEST = 4000, 20_000
#: Ranges of the logit, by which labels are counted, to a unit.
STEPS = 100


@dataclass
class Network:
    embed: np.ndarray  # feature, dim
    kernels: list[np.ndarray]  # per width: width * dim, filters
    bias: np.ndarray  # all filters
    out: np.ndarray
    out_bias: float
    scale: float = 1.0
    shift: float = 0.0

    def pooled(self, x: np.ndarray, bounds: np.ndarray, places: bool = False):
        """Per text the greatest response of each filter, at least 0, and where it is."""
        n, full = len(bounds) - 1, np.diff(bounds) > 0
        value, place = np.zeros((n, len(self.bias)), np.float32), np.full((n, len(self.bias)), -1, np.int64)
        for k, (width, kernel) in enumerate(zip(WIDTHS, self.kernels)):
            cols = slice(k * FILTERS, (k + 1) * FILTERS)
            y = np.broadcast_to(self.bias[cols], (len(x), FILTERS)).copy()
            for j in range(width):  # words beyond a text's end count as zero
                shifted = x[j:] @ kernel[j * DIM : (j + 1) * DIM]
                if j:
                    own = np.repeat(np.arange(n), np.diff(bounds))
                    shifted[own[j:] != own[: len(own) - j]] = 0
                y[: len(x) - j] += shifted
            if full.any():
                value[full, cols] = np.maximum.reduceat(y, bounds[:-1][full], axis=0)
            if places:
                for i in np.flatnonzero(full):
                    place[i, cols] = bounds[i] + y[bounds[i] : bounds[i + 1]].argmax(axis=0)
        return np.maximum(value, 0), place

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        return (pooled @ self.out + self.out_bias - self.shift) * self.scale


def features(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashed features of each distinct word, and the words as places among these.

    A word's embedding is the sum of one for the word in lower case without the marks around it and
    one for each of its beginnings, which words of one stem share.
    """
    coded = words.dictionary_encode()
    plain = pc.replace_substring_regex(pc.utf8_lower(coded.dictionary), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")
    digest = xxhash.xxh32_intdigest
    parts = [plain, *[pc.utf8_slice_codeunits(plain, 0, n) for n in STEMS]]
    hashed = [np.fromiter((k * BUCKETS + digest(w) % BUCKETS for w in part.cast(pa.binary()).to_pylist()), np.int64, len(plain)) for k, part in enumerate(parts)]
    return np.stack(hashed, axis=1), coded.indices.to_numpy(zero_copy_only=False)


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, per_label: int, longest: int, seed: int):
    """Texts of at most ``per_label`` labelled documents of each class, those with the least hash of their id."""
    marked = labels.filter("toxic in (0, 1)").groupBy(F.col(id_col).alias("__id")).agg(F.max("toxic").alias("toxic"))
    # only documents that there are; the narrow join, and texts are read for the drawn ones alone
    marked = marked.join(docs.select(F.col(id_col).alias("__id")).distinct(), "__id", "left_semi").withColumn("by", order_hash("__id", seed))
    drawn = [marked.filter(F.col("toxic") == k).orderBy("by", "__id").limit(per_label) for k in (0, 1)]
    # at most 2 * per_label ids, which is why they are broadcast
    drawn = F.broadcast(drawn[0].unionByName(drawn[1]))
    slim = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"), "lang").join(drawn, "__id").select("__id", "by", "text", "lang", "toxic")

    size = F.regexp_count(empty_if_null("text"), F.lit(WORD))
    rows = slim.filter(size <= longest).select("by", "toxic", "lang", empty_if_null("text").alias("text")).toPandas()
    return rows.sort_values(["by", "text"], ignore_index=True)


def train(feats: np.ndarray, texts: list[np.ndarray], toxic: np.ndarray, epochs: int = 6, rate: float = 0.02, seed: int = 0) -> Network:
    """Fit by Adam on the logistic loss. ``texts`` are places in ``feats``, the features of words.

    The first dimension of a feature's embedding starts at its log odds among the documents, and the first
    filter of every width looks at it; without that, pooling seldom picks the words that matter.
    """
    rng = np.random.default_rng(seed)
    seen = np.zeros((2, FEATURES * BUCKETS))
    for x, t in zip(texts, toxic):
        seen[int(t), np.unique(feats[np.unique(x)])] += 1
    sizes = np.array([max((toxic == 0).sum(), 1), max((toxic == 1).sum(), 1)])[:, None]
    odds = np.log((seen[1] + 0.5) / (sizes[1] + 1)) - np.log((seen[0] + 0.5) / (sizes[0] + 1))
    # features of few documents tell little
    odds *= (seen.sum(axis=0) >= 5) / np.sqrt(1 + 4 / np.maximum(seen.sum(axis=0), 1))
    net = Network(
        rng.normal(0, 0.05, (FEATURES * BUCKETS, DIM)).astype(np.float32),
        [rng.normal(0, 0.15, (w * DIM, FILTERS)).astype(np.float32) for w in WIDTHS],
        np.zeros(FILTERS * len(WIDTHS), np.float32), rng.normal(0, 0.1, FILTERS * len(WIDTHS)).astype(np.float32), 0.0,
    )
    net.embed[:, 0] = odds
    for k, width in enumerate(WIDTHS):
        net.kernels[k][:: DIM, 0], net.bias[k * FILTERS], net.out[k * FILTERS] = 1.0 / width, -1.5, 0.8
    net.out_bias = -1.0
    state: dict[str, list[np.ndarray]] = {}

    def adam(name, value, grad, t):
        m, v = state.setdefault(name, [np.zeros_like(value), np.zeros_like(value)])
        m += 0.1 * (grad - m)
        v += 0.01 * (grad * grad - v)
        value -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-6)

    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for start in range(0, len(order), 256):
            rows = order[start : start + 256]
            ids = feats[np.concatenate([texts[i] for i in rows])]
            bounds = np.concatenate([[0], np.cumsum([len(texts[i]) for i in rows])])
            x = net.embed[ids].sum(axis=1)
            value, place = net.pooled(x, bounds, places=True)
            z = value @ net.out + net.out_bias
            d = (1 / (1 + np.exp(-z)) - toxic[rows]) / len(rows)
            step += 1
            g = (d[:, None] * net.out) * (value > 0)
            grad_e = np.zeros_like(net.embed)
            ends = bounds[1:]
            for k, width in enumerate(WIDTHS):
                cols = slice(k * FILTERS, (k + 1) * FILTERS)
                gk, pk = g[:, cols], place[:, cols]
                grad_k = np.zeros_like(net.kernels[k])
                for j in range(width):
                    ok = (gk != 0) & (pk >= 0) & (pk + j < ends[:, None])
                    i, f = np.nonzero(ok)
                    at = pk[i, f] + j
                    np.add.at(grad_k[j * DIM : (j + 1) * DIM].T, f, gk[i, f][:, None] * x[at])
                    into = gk[i, f][:, None] * net.kernels[k][j * DIM : (j + 1) * DIM].T[f]
                    for side in range(FEATURES):
                        np.add.at(grad_e, ids[at, side], into)
                adam(f"kernel{k}", net.kernels[k], grad_k + 1e-4 * net.kernels[k], step)
            adam("bias", net.bias, g.sum(axis=0), step)
            adam("out", net.out, value.T @ d + 1e-4 * net.out, step)
            net.out_bias -= rate * float(d.sum())
            touched = np.flatnonzero(grad_e.any(axis=1))
            net.embed[touched] -= rate * 10 * grad_e[touched]
    return net


def _best_cut(bins: np.ndarray, clean: np.ndarray, toxic: np.ndarray) -> float:
    """The logit that separates the labels with the highest F1; midway between two bins that hold documents.

    ``clean`` and ``toxic`` are the weights of the labels in each of the distinct ``bins``.
    """
    order = np.argsort(-bins)
    bins, hits, taken = bins[order], np.cumsum(toxic[order]), np.cumsum((clean + toxic)[order])
    k = int((2 * hits / (taken + hits[-1])).argmax())
    lower = bins[k + 1] + 1 if k + 1 < len(bins) else bins[k] - STEPS
    return float((bins[k] + lower) / 2 / STEPS)


def _label_counts(docs: DataFrame, labels: DataFrame, net: Network, trained: list[int], id_col: str, text_col: str, seed: int):
    """(lang, toxic, trained, bin, n) over all labelled documents; a bin is a range of 1 / STEPS of the logit."""
    marked = labels.filter("toxic in (0, 1)").groupBy(F.col(id_col).alias("id")).agg(F.max("toxic").alias("toxic"))
    # at most 2 * per_label hashes, which is why they are broadcast
    known = F.broadcast(docs.sparkSession.createDataFrame([(int(x),) for x in trained], "by long")).withColumn("trained", F.lit(True))
    # logits are made where the texts are; only these move
    found = _logits(docs, net, id_col, text_col).join(marked, "id").withColumn("by", order_hash("id", seed)).join(known, "by", "left")
    bin_ = F.floor(F.greatest(F.lit(-40.0), F.least(F.lit(40.0), F.col("logit"))) * STEPS).cast("long")
    return found.groupBy("lang", "toxic", F.col("trained").isNotNull().alias("trained"), bin_.alias("bin")).agg(F.count("*").alias("n")).toPandas()


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_label: int = SAMPLE, longest: int = LONGEST, seed: int = 0) -> tuple[Network | None, float, dict[str | None, float]]:
    """The network, the share of toxic labels, and the score from which each language's texts are flagged.

    Training takes at most ``per_label`` documents of each label, none of more than ``longest`` words, less
    a quarter that is left out. All labelled documents that were not trained on place the cut that becomes
    score 0.5 and the thresholds by language, from counts by language, label and range of the logit. As
    training takes a larger share of the rarer label, those left of a label weigh as much as all that have
    it. A language with fewer than 20 of either label left gets 0.5. The language is no input of the network.
    The share is that of the sample. Without documents of both labels there is no network.
    """
    rows = _sample(docs, labels, id_col, text_col, per_label, longest, seed)
    toxic = rows["toxic"].to_numpy(np.float32)
    share = float(toxic.mean()) if len(toxic) else 0.0
    if len(rows) < 8 or share in (0.0, 1.0):
        return None, share, {}
    bounds, words = flat_words(pa.array(rows["text"], pa.string()))
    feats, codes = features(words)
    texts = [codes[a:b] for a, b in zip(bounds, bounds[1:])]
    kept = rows["by"].to_numpy() % 4 == 0
    if len({*toxic[kept]}) < 2 or len({*toxic[~kept]}) < 2:
        kept = np.zeros(len(rows), bool)
    net = train(feats, [t for t, k in zip(texts, kept) if not k], toxic[~kept], seed=seed)
    counts = _label_counts(docs, labels, net, sorted({*rows["by"][~kept]}), id_col, text_col, seed)
    judged = counts[~counts["trained"]]
    judged = judged if judged["toxic"].nunique() == 2 else counts
    weight = counts.groupby("toxic")["n"].sum() / judged.groupby("toxic")["n"].sum()

    def cut_of(some) -> float:
        table = some.groupby(["bin", "toxic"])["n"].sum().unstack(fill_value=0).reindex(columns=[0, 1], fill_value=0)
        return _best_cut(table.index.to_numpy(), table[0].to_numpy() * weight[0], table[1].to_numpy() * weight[1])

    net.shift, cuts = cut_of(judged), {}
    for lang, own in judged.groupby("lang", dropna=False):
        lang = lang if isinstance(lang, str) else None
        both = own.groupby("toxic")["n"].sum()
        cuts[lang] = float(1 / (1 + np.exp(net.shift - cut_of(own)))) if both.get(0, 0) >= 20 and both.get(1, 0) >= 20 else 0.5
    return net, share, cuts


def _logits(docs: DataFrame, net: Network, id_col: str, text_col: str) -> DataFrame:
    """(id, lang, logit) of every row, from the whole text."""
    slim = docs.select(F.col(id_col).alias("id"), F.col("lang"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in batches_of(batch, "text", 8_000_000):
                bounds, words = flat_words(part.column("text"))
                feats, codes = features(words)
                x = net.embed[feats].sum(axis=1)[codes] if len(codes) else np.zeros((0, DIM), np.float32)
                logit = net.logits(net.pooled(x, bounds)[0]).astype(np.float64)
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("lang"), pa.array(logit)], ["id", "lang", "logit"])

    kind = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(run, f"id {kind}, lang string, logit double")


def rated(docs: DataFrame, fitted: tuple[Network | None, float, dict[str | None, float]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, score, predicted, threshold, flagged.

    ``score`` comes from the whole text alone; ``predicted`` is 1 from 0.5 on. ``flagged`` compares it to the
    threshold of the row's language (0.5 where none was learned). A null or empty text has the score
    of no response. Without a network all scores are the share of toxic labels. Repeated rows are rated alike.
    An empty table gives no rows. Other columns are not read.
    """
    net, share, cuts = fitted
    if net is None:
        scored = docs.select(F.col(id_col).alias("id"), "lang", F.lit(share).alias("score"))
    else:
        scored = _logits(docs, net, id_col, text_col).withColumn("score", 1 / (1 + F.exp(-F.col("logit"))))
    limit = F.lit(0.5)
    for lang, cut in sorted(cuts.items(), key=str):
        limit = F.when(F.col("lang").eqNullSafe(F.lit(lang)), F.lit(cut)).otherwise(limit)
    out = scored.withColumn("threshold", limit)
    return out.select(F.col("id").alias(id_col), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "threshold", (F.col("score") >= F.col("threshold")).alias("flagged"))
