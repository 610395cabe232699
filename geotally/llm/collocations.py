"""Phrases of two to five words that stand together more often than their parts would by chance, per language.

Words become 64-bit codes once, in a table of binary rows that every level reads again. A level broadcasts the
frequent phrases of the level before as a double-array trie. All text positions walk down it at once, one numpy
step for each word; where a position and the next one both end in an accepting state, the phrase that is one word
longer has only frequent parts (Apriori), so it is a candidate. The task counts its candidates with one bincount,
and Spark adds up the counts of the tasks. Candidates are not listed before they are seen: of a vocabulary of V words,
the pairs alone would be V squared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window as W, functions as F

from geotally.llm.common import batches_of, materialize, mix, word_hashes, written
from geotally.model import work_dir

#: Phrases in one broadcast trie at most; where a level has more, the corpus is read once for each part of them.
PHRASES = 1 << 20
#: Positions that walk the trie together.
BLOCK = 1 << 18
#: Bytes of text that are cut into words together.
SLICE = 2_000_000
LEVELS = 5

_BREAKS = np.isin(np.arange(256), [ord(c) for c in ".,;:!?"] + [10, 11, 12, 13])
_BLANKS = np.isin(np.arange(256), [32, 9])


def pieces_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The lower-cased words of all texts, the text of each, and whether a word begins a piece."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    breaks = _BREAKS[data]
    inside = ~(breaks | _BLANKS[data])
    first = np.zeros(len(data) + 1, bool)
    first[bounds] = True
    starts = np.flatnonzero(inside & np.concatenate([[True], ~inside[:-1]])[: len(data)] | inside & first[:-1])
    offsets = np.append(np.concatenate([[0], np.cumsum(inside)])[starts], inside.sum()).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
    owner = np.searchsorted(bounds, starts, side="right") - 1
    piece = np.cumsum(breaks)[starts] if len(data) else starts
    begins = np.ones(len(starts), bool)
    begins[1:] = (piece[1:] != piece[:-1]) | (owner[1:] != owner[:-1])
    return words, owner, begins


def _languages(langs: pa.Array, owner: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The languages of a batch, and each word's."""
    coded = pc.fill_null(langs, "und").dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)[owner]


def _codes(words: pa.Array, names: list[str], of: np.ndarray) -> np.ndarray:
    """A code above 0 for each word and its language."""
    seeds = np.fromiter((xxhash.xxh64_intdigest(x.encode()) for x in names), np.uint64, len(names))
    return np.maximum(mix(word_hashes(words), seeds[of] if len(names) else np.zeros(0, np.uint64)), np.uint64(1)).view(np.int64)


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, phrase (the word) and f; each task counts its own words first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batches_of(batch, "text", SLICE):
                words, owner, _ = pieces_of(part.column(1))
                names, of = _languages(part.column(0), owner)
                coded = words.dictionary_encode()
                key = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * max(1, len(names)) + of
                distinct, n = np.unique(key, return_counts=True)
                at, lang = distinct // max(1, len(names)), distinct % max(1, len(names))
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()).take(pa.array(lang)), coded.dictionary.take(pa.array(at)).cast(pa.string()), pa.array(n)], ["lang", "phrase", "f"])

    found = docs.select("lang", "text").mapInArrow(run, "lang string, phrase string, f long")
    return found.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def with_codes(words: DataFrame) -> DataFrame:
    """lang, phrase, f and the code of each word as an array of one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, of = _languages(batch.column(0), np.arange(len(batch)))
            codes = _codes(batch.column(1), names, of)
            yield pa.RecordBatch.from_arrays([*batch.columns, _rows(np.zeros((len(batch), 0), np.int64), codes)], ["lang", "phrase", "f", "codes"])

    return words.select("lang", "phrase", "f").mapInArrow(run, "lang string, phrase string, f long, codes array<long>")


def coded_corpus(docs: DataFrame, known: Broadcast | None = None, words_a_row: int = 512) -> DataFrame:
    """Rows of word codes in order of the texts, 0 before each piece; a row ends with the piece that fills it.

    Where the sorted codes of all frequent words are ``known``, the others become 0 too: no candidate runs over them.
    Rows are about as long as a text, so that as many of them as Spark hands over at once fit in memory.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batches_of(batch, "text", SLICE):
                words, owner, begins = pieces_of(part.column(1))
                names, of = _languages(part.column(0), owner)
                if not len(words):
                    continue
                codes = _codes(words, names, of)
                if known is not None:
                    place = np.minimum(np.searchsorted(known.value, codes), len(known.value) - 1)
                    codes = np.where(known.value[place] == codes, codes, 0) if len(known.value) else np.zeros_like(codes)
                codes = np.insert(codes, np.flatnonzero(begins), 0)
                codes = codes[np.concatenate([[True], (codes[1:] != 0) | (codes[:-1] != 0)])]  # breaks in a row are one
                zeros = np.flatnonzero(codes == 0)
                first = np.unique(zeros // words_a_row, return_index=True)[1]
                ends = np.append(zeros[first], len(codes)) * 8
                rows = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(codes)])
                yield pa.RecordBatch.from_arrays([rows], ["codes"])

    return docs.select("lang", "text").mapInArrow(run, "codes binary")


class Trie:
    """A double-array trie over sequences of one length; a state's child by letter c is at ``base[state] + c``.

    Letters are the ranks of the codes that occur, from 1. State 0 is the root, -1 is none.
    """

    def __init__(self, phrases: np.ndarray):
        """``phrases``: distinct rows of codes, all of one width."""
        self.letters, coded = np.unique(phrases, return_inverse=True)
        coded = (coded.reshape(phrases.shape) + 1).astype(np.int64)
        order = np.lexsort(coded.T[::-1])
        coded = coded[order]
        size = len(self.letters) + 2
        self.base, self.check = np.zeros(size, np.int64), np.full(size, -1, np.int64)
        self.taken, self.low = np.zeros(size, bool), 1
        self.taken[0] = True
        state = np.zeros(len(coded), np.int64)
        for column in coded.T:
            new = np.ones(len(column), bool)
            new[1:] = (state[1:] != state[:-1]) | (column[1:] != column[:-1])
            parents, letters = state[new], column[new]
            children = self._place(parents, letters)
            state = children[np.cumsum(new) - 1]
        self.end = np.full(len(self.base), -1, np.int64)
        self.end[state] = order
        del self.taken

    def _grow(self, size: int) -> None:
        if size > len(self.base):
            more = max(size, len(self.base) * 2) - len(self.base)
            self.base, self.check = np.append(self.base, np.zeros(more, np.int64)), np.append(self.check, np.full(more, -1, np.int64))
            self.taken = np.append(self.taken, np.zeros(more, bool))

    def _place(self, parents: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """Slots for the children of one level; ``parents`` comes in groups, letters ascend within each."""
        cuts = np.flatnonzero(np.concatenate([[True], parents[1:] != parents[:-1]]))
        sizes = np.diff(np.append(cuts, len(parents)))
        base = np.zeros(len(cuts), np.int64)
        for g in np.flatnonzero(sizes > 1)[np.argsort(-sizes[sizes > 1], kind="stable")]:
            base[g] = self._fit(letters[cuts[g] : cuts[g] + sizes[g]])
        single = np.flatnonzero(sizes == 1)  # each fits into any free slot at or after its letter
        if len(single):
            single = single[np.argsort(letters[cuts[single]], kind="stable")]
            self._grow(len(self.base) + len(single) + int(letters.max()) + 1)
            free = np.flatnonzero(~self.taken)
            free = free[free >= int(letters[cuts[single]].max())][: len(single)]
            base[single] = free - letters[cuts[single]]
            self.taken[free] = True
        children = np.repeat(base, sizes) + letters
        self.base[parents[cuts]] = base
        self.check[children] = parents
        return children

    def _fit(self, letters: np.ndarray, block: int = 64) -> int:
        """The first base, from the lowest free slot on, at which all slots of the letters are free."""
        while self.low < len(self.taken) and self.taken[self.low]:
            self.low += 1
        at, tries = max(0, self.low - int(letters[0])), 0
        while True:
            self._grow(at + block + int(letters[-1]) + 1)
            good = ~self.taken[(at + np.arange(block))[:, None] + letters[None, :]].any(1)
            if good.any():
                at += int(np.argmax(good))
                self.taken[at + letters] = True
                if tries > 32:  # holes too small for this row are left to single children
                    self.low = at + int(letters[0])
                return at
            at, tries = at + block, tries + 1

    def walk(self, codes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions from which ``depth`` words lead to an accepting state, and which phrase that is."""
        place = np.minimum(np.searchsorted(self.letters, codes), len(self.letters) - 1)
        letter = np.where(self.letters[place] == codes, place + 1, 0)
        at = np.arange(len(codes) - depth + 1 if len(codes) >= depth else 0)
        state = np.zeros(len(at), np.int64)
        for step in range(depth):
            c = letter[at + step]
            slot = self.base[state] + c
            good = (c > 0) & (slot < len(self.check)) & (self.check[np.minimum(slot, len(self.check) - 1)] == state)
            at, state = at[good], slot[good]
        return at, self.end[state]


def _extended(codes: np.ndarray, trie: Trie, depth: int, whole: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Candidates of a block: the phrase that ends in an accepting state, the word after it, and how often.

    Where the trie is ``whole`` the word is given by its letter, which is a small number, and else by its code.
    """
    at, phrase = trie.walk(codes, depth)
    accepted = np.zeros(len(codes) + 1, bool)
    accepted[at] = True
    inner = at + depth < len(codes)
    at, phrase = at[inner], phrase[inner]
    following = codes[at + depth]
    good = (following != 0) & (accepted[at + 1] | (not whole))  # not whole: the last words may be in another trie
    phrase, following = phrase[good], following[good]
    words, letter = np.unique(following, return_inverse=True)
    key, which = np.unique(phrase * max(1, len(words)) + letter, return_inverse=True)
    word = words[key % max(1, len(words))] if len(words) else words
    return key // max(1, len(words)), np.searchsorted(trie.letters, word) if whole else word, np.bincount(which, minlength=len(key))


def next_level(corpus: DataFrame, frequent: DataFrame, depth: int, least: int, most: int = PHRASES) -> DataFrame:
    """codes (array) and f of every phrase of ``depth + 1`` words with f of ``least`` or more.

    ``frequent`` has the codes of all such phrases of ``depth`` words. A trie holds about ``most`` of them, dealt by hash;
    every phrase has its first words in one trie only, so each trie's counts are whole. Counts are shuffled under the
    numbers of phrase and word, and only what is frequent gets its codes back.
    """
    spark, parts = corpus.sparkSession, -(-frequent.count() // most)
    found = spark.createDataFrame([], "codes array<long>, f long")
    for part in range(parts):
        mine = frequent.filter(F.pmod(F.xxhash64("codes"), F.lit(parts)) == part) if parts > 1 else frequent
        table = mine.select("codes").toArrow().column("codes").combine_chunks()
        if not len(table):
            continue
        phrases = table.flatten().to_numpy(zero_copy_only=False).reshape(-1, depth)
        shared = spark.sparkContext.broadcast((Trie(phrases), phrases))

        def count(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            trie = shared.value[0]
            for batch in batches:
                column = batch.column(0)
                ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
                codes = np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]].view(np.int64)
                for start in range(0, len(codes), BLOCK):
                    found = _extended(codes[start : start + BLOCK + depth], trie, depth, parts == 1)
                    yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in found], ["phrase", "word", "f"])

        def decode(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            trie, phrases = shared.value
            for batch in batches:
                phrase, word = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                yield pa.RecordBatch.from_arrays([_rows(phrases[phrase], trie.letters[word] if parts == 1 else word), batch.column(2)], ["codes", "f"])

        counted = corpus.mapInArrow(count, "phrase long, word long, f long").groupBy("phrase", "word").agg(F.sum("f").alias("f"))
        found = found.unionByName(counted.filter(F.col("f") >= least).mapInArrow(decode, "codes array<long>, f long"))
    return found


def _rows(phrases: np.ndarray, word: np.ndarray) -> pa.Array:
    both = np.concatenate([phrases, word[:, None]], axis=1) if len(word) else np.zeros((0, phrases.shape[1] + 1), np.int64)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(both) + 1, dtype=np.int32) * both.shape[1]), pa.array(both.ravel()))


def phrase_counts(docs: DataFrame, least: int = 100, most: int = PHRASES) -> tuple[DataFrame, DataFrame]:
    """lang, k, phrase and f of every phrase of 1 to 5 words with f of ``least`` or more; lang and n of each language."""
    words = materialize(word_counts(docs), "phrase-words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = words.filter(F.col("f") >= least)
    n = frequent.count()
    level = written(with_codes(frequent).select("lang", "phrase", "codes", "f"), "phrases-1", n)
    vocabulary, levels = level.select("lang", "phrase", F.col("codes")[0].alias("__code")), [level.withColumn("k", F.lit(1))]
    known = None
    if n <= most:  # else words are not told apart here, and the tries do it alone
        codes = level.select(F.col("codes")[0].alias("code")).toArrow().column("code").to_numpy()
        known = docs.sparkSession.sparkContext.broadcast(np.sort(codes))
    path = work_dir(docs.sparkSession, "phrase-corpus")
    coded_corpus(docs, known).write.option("compression", "zstd").parquet(path)  # codes repeat like words
    corpus = docs.sparkSession.read.schema("codes binary").parquet(path)
    for k in range(2, LEVELS + 1):
        counted = next_level(corpus, level, k - 1, least, most)
        before = level.select("lang", F.col("phrase").alias("__before"), F.col("codes").alias("__codes"))
        last = vocabulary.select(F.col("phrase").alias("__word"), "__code")
        named = counted.withColumns({"__codes": F.slice("codes", 1, k - 1), "__code": F.col("codes")[k - 1]}).join(before, "__codes").join(last, "__code")
        level = written(named.select("lang", F.concat_ws(" ", "__before", "__word").alias("phrase"), "codes", "f"), f"phrases-{k}", 2 * level.count())
        levels.append(level.withColumn("k", F.lit(k)))
    frame = levels[0]
    for other in levels[1:]:
        frame = frame.unionByName(other)
    return frame.select("lang", "k", "phrase", "codes", "f"), totals


def scored(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """Each phrase of two words or more with its lowest-scoring cut (ties: the first) and the counts of its two parts.

    The score is floor(1000 a n / (l r)) in decimals of 38 digits.
    """
    parts = counts.select(F.col("codes").alias("part"), F.col("f").alias("p"))
    cuts = counts.filter("k > 1").select("lang", "k", "phrase", "codes", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.withColumns({"head": F.slice("codes", F.lit(1), F.col("cut")), "tail": F.slice("codes", F.col("cut") + 1, F.col("k") - F.col("cut"))})
    both = cuts.join(parts.select(F.col("part").alias("head"), F.col("p").alias("l")), "head").join(parts.select(F.col("part").alias("tail"), F.col("p").alias("r")), "tail")
    both = both.join(F.broadcast(totals), "lang")  # a row for each language
    score = F.expr("(cast(a as decimal(19,0)) * cast(n as decimal(19,0)) * 1000) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    best = both.withColumn("score", score).groupBy("lang", "k", "phrase", "codes", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    return best.select("lang", "k", "phrase", "codes", "a", "best.l", "best.r", "n", "best.score", "best.cut")


def within_longer(counts: DataFrame, share: int = 100) -> DataFrame:
    """The codes of phrases inside a longer one with ``share`` percent of their count.

    What a longer phrase contains is contained in one that is one word longer and at least as frequent, so only
    first and last words are taken off.
    """
    longer = counts.filter("k > 2").select("k", "codes", F.col("f").alias("longer"))
    inner = longer.select(F.explode(F.array(F.slice("codes", F.lit(1), F.col("k") - 1), F.slice("codes", F.lit(2), F.col("k") - 1))).alias("codes"), "longer")
    most = inner.groupBy("codes").agg(F.max("longer").alias("longer"))
    return counts.join(most, "codes").filter(100 * F.col("longer") >= share * F.col("f")).select("codes")


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, share: int = 100, salts: int = 256, most: int = PHRASES) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    ``docs`` has lang (null: ``und``) and text (null: empty); other columns are not read. Words are lower-cased (A-Z) and
    counted within pieces, overlaps included; repeated rows count each time. Order: score and a descending, then
    the phrase's bytes. A language's candidates are ranked in ``salts`` parts first, and only the first of each part meet.
    An empty table, or a language without a phrase of ``least`` occurrences, gives no rows.
    """
    counts, totals = phrase_counts(docs, least, most)
    rated = scored(counts, totals).join(within_longer(counts, share), "codes", "left_anti")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rated = rated.withColumn("__salt", F.pmod(F.xxhash64("codes"), F.lit(salts)))
    rated = rated.withColumn("rank", F.row_number().over(W.partitionBy("lang", "__salt").orderBy(*order))).filter(F.col("rank") <= top)
    rated = rated.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return rated.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
