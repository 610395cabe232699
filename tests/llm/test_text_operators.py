"""Token counts, collocations and periodic runs beside plain loops."""
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from geotally.llm import collocations, periodic_runs, token_counts
from tests.llm.test_operators import words_of

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


# ------------------------------------------------------------------ token counts
ODD = ["a", "b", " ", "  ", "\n", "\r", "\t", "▁", "é", "日本", "the", "ing", ";", "}", "<s>", "</s>", "\x00", "\xa0", "ﬁ", "😀", "x" * 70]


def odd_texts(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choices(ODD, k=rng.randrange(14))) for _ in range(n)] + [None, "", " ", "\n", " \n", "▁ ▁"]


def test_pre_tokens_add_up(model):
    encoder, texts = token_counts._encoder(MODEL), odd_texts(5000)
    owner, keys, less = token_counts.pre_tokens(pa.array(texts, pa.string()), encoder)
    got = np.bincount(owner, weights=np.array(encoder.lengths(keys.to_pylist())) - less, minlength=len(texts))
    assert encoder.spaces and encoder.lines and got.tolist() == [len(model.encode(t or "")) for t in texts]


def test_hash_table():
    names = [str(i).encode() for i in range(6000)]
    table = token_counts.Lengths(token_counts._digests(names[:4000]), np.arange(4000, dtype=np.int32))
    assert table.find(token_counts._digests(names)).tolist() == [*range(4000), *[-1] * 2000]
    assert token_counts.Lengths(token_counts._digests([]), np.zeros(0, np.int32)).find(token_counts._digests([b"x"])).tolist() == [-1]


@pytest.mark.parametrize("sample,most", [(8192, 65536), (10, 5), (1, 1)])
def test_token_counts(spark, rows, model, sample, most):
    """Whatever the table holds, the counts are the library's; odd, long, null and repeated texts included."""
    texts = [(i, t, 1, "n", True) for i, t in [*((r[0], r[1]) for r in rows), *enumerate(odd_texts(200), 1000), (None, "no id at all"), (1000, "again")]]
    df = spark.createDataFrame(texts, "doc_id long, text string, n_tokens long, id string, over_limit boolean").repartition(3)
    got = collections.Counter(tuple(r) for r in token_counts.token_counts(df, MODEL, limit=50, sample=sample, most=most).collect())
    size = [len(model.encode(t or "")) for _, t, *_ in texts]
    assert got == collections.Counter((i, len((t or "").encode()), n, n > 50) for (i, t, *_), n in zip(texts, size))


def test_token_counts_of_nothing(nothing):
    out = token_counts.token_counts(nothing, MODEL)
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"] and out.count() == 0


# ------------------------------------------------------------------ collocations
def mined(rows, least, top):
    n, f, out, inside = collections.Counter(), collections.Counter(), collections.defaultdict(list), set()
    for lang, text in rows:
        lang = lang or "und"
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    found = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    for (lang, p), a in found.items():
        for i in range(len(p)):
            for j in range(i + 2, len(p) + 1):
                if j - i < len(p) and 100 * a >= 100 * f[lang, p[i:j]]:
                    inside.add((lang, p[i:j]))
    for (lang, p), a in found.items():
        if (lang, p) not in inside:
            score, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            out[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]], n[lang]))
    return sorted((lang, rank, p.decode(), -a, l, r, m, -s) for lang, x in out.items() for rank, (s, a, p, l, r, m) in enumerate(sorted(x)[:top], 1))


def phrase_rows(seed, n):
    rng = random.Random(seed)
    blanks = [" "] * 12 + ["  ", "\t", ". ", ",", "\n", "\x0b", "!? "]
    text = lambda: "".join(rng.choice(["a", "b", "C", "c", "the", "é", "É", "xx"]) + rng.choice(blanks) for _ in range(rng.randrange(120)))
    made = [(rng.choice(["en", "fr", None]), text()) for _ in range(n)]
    return [*made, *made[:3], (None, None), ("en", ""), ("en", " \n"), ("de", "one two"), ("fr", " ".join(["same"] * 50)), ("en", "x" * 9000)]


@pytest.mark.parametrize("least,top,most", [(3, 2000, 1 << 20), (6, 7, 29)])
def test_collocations(spark, least, top, most):
    """Also with levels dealt over several tries, and with ties at the rank that is kept last."""
    rows = phrase_rows(least, 40)
    df = spark.createDataFrame([(*r, 0, 0, "k") for r in rows], "lang string, text string, f long, codes long, k string").repartition(3)
    assert sorted(tuple(r) for r in collocations.collocations(df, least=least, top=top, most=most, salts=4).collect()) == mined(rows, least, top)


def test_collocations_of_nothing(nothing, docs):
    assert collocations.collocations(nothing).count() == 0
    assert collocations.collocations(docs.filter("length(text) < 20")).count() == 0


def test_trie_and_blocks(monkeypatch):
    rng = np.random.default_rng(2)
    phrases = np.unique(rng.integers(1, 40, (900, 3)), axis=0)
    codes = rng.integers(0, 45, 5000)
    trie, known = collocations.Trie(phrases), {tuple(p): i for i, p in enumerate(phrases.tolist())}
    want = [(i, known[tuple(codes[i : i + 3])]) for i in range(len(codes) - 2) if tuple(codes[i : i + 3].tolist()) in known]
    assert list(zip(*(x.tolist() for x in trie.walk(codes, 3)))) == want
    assert len(trie.walk(codes[:2], 3)[0]) == 0


def test_scores_pass_64_bits(spark):
    big = 4 * 10**15
    counts = spark.createDataFrame([("en", 1, "a", [1], big), ("en", 1, "b", [2], big), ("en", 2, "a b", [1, 2], big)], "lang string, k int, phrase string, codes array<long>, f long")
    row = collocations.scored(counts, spark.createDataFrame([("en", 3 * big)], "lang string, n long")).first()
    assert row["score"] == 1000 * big * 3 * big // (big * big)


# ------------------------------------------------------------------ periodic runs
def runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q) and j > i:
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def with_tail(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a, out = g % n, list(words)
    p = 1 + (n - a) // (3 + g % 8)
    for i in range(a, n):
        out[i] = words[a + (i - a) % p]
    return out


def expected(doc_id, text, tails=True):
    words = with_tail(doc_id, words_of(text)) if tails else words_of(text)
    found = sorted(runs(words), key=lambda r: (r[0], r[2]))
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    s, n, q = min(((s, n, q) for s, n, q in found), key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(found), s, n, q, n and 1000 * n // q, digest("".join(f"{a},{b},{c}\n" for a, b, c in found)), digest(" ".join(w for i, w in enumerate(words) if i not in gone)))


def repetitive(seed, n):
    rng = random.Random(seed)
    for i in range(n):
        words = [rng.choice("abcdef"[: rng.choice([1, 2, 3, 6])]) for _ in range(rng.randrange(60))]
        for _ in range(rng.randrange(3)):
            if words:
                at = rng.randrange(len(words))
                words = words[:at] + words[at : at + rng.randrange(1, 12)] * rng.randrange(1, 8) + words[at + rng.randrange(5) :]
        yield i, rng.choice([" ", "\n", "\t "]).join(words)


def test_periodic_runs(spark, rows):
    """Literal repetitions, planted tails, nulls, long texts, repeated and null ids, clashing columns."""
    texts = [*repetitive(7, 500), *((r[0] + 1000, r[1]) for r in rows), (3, "again " * 9), (3, "again " * 9), (None, "x " * 50), (2000, "one two " * 4000)]
    df = spark.createDataFrame([(i, t, "s", [1], 1) for i, t in texts], "doc_id long, text string, collapsed string, runs array<int>, hash int").repartition(3)
    got = collections.Counter(tuple(r) for r in periodic_runs.digests(periodic_runs.periodic_runs(df, tails=True)).collect())
    assert got == collections.Counter(expected(i, t) for i, t in texts)
    plain = {r["doc_id"]: r for r in periodic_runs.periodic_runs(df.filter("doc_id < 500 and doc_id <> 3")).collect()}
    for i, t in texts[:500]:
        if i != 3:
            assert [tuple(r) for r in plain[i]["runs"]] == sorted(runs(words_of(t)), key=lambda r: (r[0], r[2]))


def test_periodic_runs_of_nothing(nothing):
    assert periodic_runs.digests(periodic_runs.periodic_runs(nothing, tails=True)).count() == 0
