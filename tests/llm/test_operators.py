"""Operators beside plain loops over the same rows."""
import collections
import hashlib
import itertools
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from geotally.llm import common, exact_dedup, language, licenses, mixing, near_dedup, packing, quality, substring_dedup, toxicity, warc
from geotally.llm.components import connected_components

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# ------------------------------------------------------------------ exact copies
def test_exact_groups(docs, rows):
    norm = {r[0]: re.sub(r"[\x20\x09-\x0D]", "", r[1] or "") for r in rows}
    groups = collections.defaultdict(list)
    for r in rows:
        groups[norm[r[0]]].append((-len(r[1] or ""), r[0]))
    for full in (True, False):
        got = by_id(exact_dedup.exact_groups(docs, hash_all=full))
        assert len(got) == len(rows)
        for i, text in norm.items():
            g = got[i]
            assert (g["keep_id"], g["group_size"], g["kept"]) == (min(groups[text])[1], len(groups[text]), i == min(groups[text])[1])
            # without hash_all, texts that differ in length or prefix from all others are not read in full
            assert g["text_sha256"] == hashlib.sha256(text.encode()).hexdigest() or (g["text_sha256"] is None and not full and len(groups[text]) == 1)


def test_exact_drop(docs, twice, nothing, rows):
    left = exact_dedup.drop_exact_copies(docs)
    assert left.columns == docs.columns
    norm = [re.sub(r"[\x20\x09-\x0D]", "", r["text"] or "") for r in left.collect()]
    assert len(norm) == len(set(norm)) == len({re.sub(r"[\x20\x09-\x0D]", "", r[1] or "") for r in rows})
    ids = [r["doc_id"] for r in exact_dedup.drop_exact_copies(twice).collect()]
    assert len(ids) == len(set(ids)) and None in ids
    assert exact_dedup.exact_groups(nothing).count() == 0


# ------------------------------------------------------------------ mixing
def filled(sizes, weights, most=3):
    """Targets by handing out the excess again and again."""
    targets, free, budget = {}, set(sizes), sum(sizes.values())
    while free:
        rest = budget - sum(targets.values())
        over = {s for s in free if rest * weights[s] / sum(weights[x] for x in free) > most * sizes[s] + 1e-9}
        if not over:
            return targets | {s: rest * weights[s] / sum(weights[x] for x in free) for s in free}
        targets |= {s: most * sizes[s] for s in over}
        free -= over
    return targets


def test_mix_plan(docs, rows):
    plan = mixing.mix_plan(docs).collect()
    assert sorted(map(str, plan)) == sorted(map(str, mixing.mix_plan(docs.repartition(5)).collect()))
    sizes = collections.Counter()
    for r in rows:
        sizes[r[3]] += len(words_of(r[1]))
    weights = {s: 1 + k % 3 for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    want, took, largest = filled(sizes, weights), collections.Counter(), collections.Counter()
    assert len(plan) == len(rows)
    for r in plan:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] == r["size"] * r["copies"] <= 3 * r["size"] and len(r["positions"]) == r["copies"]
        assert all(0 <= p <= 1 for p in r["positions"]) and r["positions"] == sorted(r["positions"])
        took[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s in sizes:
        assert abs(took[s] - want[s]) <= largest[s] / 2


def test_mix_cap(spark):
    """A small source of great weight stops at three times its size."""
    small = [(1, "a b", "x")] + [(k, "w " * 50, "y") for k in range(2, 12)]
    plan = by_id(mixing.mix_plan(spark.createDataFrame(small, "doc_id long, text string, source string"), knots=lambda s: mixing.cycling_weights(s, (50, 1))))
    assert plan[1]["target"] == 6 and plan[1]["taken"] == 6 and plan[2]["target"] == 496


def test_positions_follow_the_schedule(spark):
    """With weights 1 + t and 2 - 2t, half of a source's tokens are placed where its integral is half."""
    texts = [(k, "w " * 10, "ab"[k % 2]) for k in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, source string")
    knot = lambda w0, w1: F.array(F.struct(F.lit(0.0).alias("t"), F.lit(float(w0)).alias("w")), F.struct(F.lit(1.0).alias("t"), F.lit(float(w1)).alias("w")))
    knots = lambda s: s.select(*mixing.SOURCE).distinct().withColumn("knots", F.when(F.col("source") == "a", knot(1, 2)).otherwise(knot(2, 0)))
    got = collections.defaultdict(list)
    for r in mixing.mix_plan(docs, knots=knots, budget=0.9).collect():
        got[r["source"]] += r["positions"]
    for source, (w0, w1) in {"a": (1, 2), "b": (2, 0)}.items():
        area = lambda t: (w0 * t + (w1 - w0) * t * t / 2) / ((w0 + w1) / 2)
        at = sorted(got[source])
        assert all(area(p) == pytest.approx(k / len(at), abs=0.02) for k, p in enumerate(at))


def test_default_schedule_changes_the_mixture(spark):
    """Sources rise, stay and fall in turn, so half of their tokens are placed late, midway and early."""
    docs = spark.createDataFrame([(k, "w " * 10, "abc"[k % 3]) for k in range(900)], "doc_id long, text string, source string")
    got = collections.defaultdict(list)
    for r in mixing.mix_plan(docs).collect():
        got[r["source"]] += r["positions"]
    middle = {s: float(np.median(p)) for s, p in got.items()}
    late = (math.sqrt(5) - 1) / 2
    assert middle == {"a": pytest.approx(late, abs=0.03), "b": pytest.approx(0.5, abs=0.03), "c": pytest.approx(1 - late, abs=0.03)}


def test_mixed_documents(docs, twice, nothing):
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_plan(docs).collect() if r["copies"]}
    assert collections.Counter(r["doc_id"] for r in mixed.collect()) == copies
    assert mixing.mix_plan(nothing).count() == mixing.mixed_documents(nothing).count() == 0
    assert mixing.mix_plan(twice).count() == twice.count()
    assert {r["doc_id"] for r in mixing.mixed_documents(twice).collect()} <= {r["doc_id"] for r in twice.collect()}


# ------------------------------------------------------------------ packing
def test_encode_texts(rows):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(TOKENIZER)
    odd = ["a <|endoftext|> b  c\n\n d   e \n f ", " x", "x ", "  ", "a\x1c b!\x1f\x1c c", "a  b  c", "it's we'll 12 345", "word " * 60_000]
    texts = [r[1] for r in rows] + odd
    for text, got in zip(texts, packing.encode_texts(pa.array(texts, pa.string()), TOKENIZER)):
        assert got.tolist() == plain.encode(text or "", add_special_tokens=False).ids


def test_pack(docs, rows, nothing, twice):
    packed = packing.pack(docs, TOKENIZER, 256).collect()
    encoded = dict(zip([r[0] for r in rows], packing.encode_texts(pa.array([r[1] for r in rows], pa.string()), TOKENIZER)))
    pieces, bins = collections.defaultdict(list), collections.defaultdict(list)
    for r in packed:
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"], bytes(r["ids"])))
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, ids in encoded.items():
        whole = np.append(ids, np.uint32(2)).astype("<u4").tobytes()
        own = sorted(pieces[i])
        assert [p[0] for p in own] == list(range(len(own))) and b"".join(p[3] for p in own) == whole
        assert [p[1] for p in own] == [0, *itertools.accumulate(p[2] for p in own)][:-1] and all(p[2] == 256 for p in own[1:])
    for held in bins.values():
        held.sort()
        assert [h[0] for h in held] == [0, *itertools.accumulate(h[1] for h in held)][:-1] and sum(h[1] for h in held) <= 256
    joined = {r["sequence_id"]: r for r in packing.sequences(packing.pack(docs, TOKENIZER, 256)).collect()}
    assert sum(len(r["ids"]) for r in joined.values()) == 4 * sum(len(x) + 1 for x in encoded.values())
    assert packing.pack(nothing, TOKENIZER).count() == 0 and packing.digests(twice, TOKENIZER).count() >= twice.count()


def best_fit(lengths, capacity):
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [k for k, r in enumerate(room) if r >= n]
        if fits:
            room[min(fits, key=lambda k: room[k])] -= n
        else:
            room.append(capacity - n)
    return len(room)


@pytest.mark.parametrize("seed", range(5))
def test_plan_slots(seed):
    rng = np.random.default_rng(seed)
    lengths = np.minimum(rng.geometric(0.01 + 0.03 * seed, 3000), 100).tolist()
    plan = packing.plan_slots(collections.Counter(lengths), 100)
    used = collections.defaultdict(list)
    for length, rank, count, each, first, offset in plan:
        for k in range(count):
            used[first + k // each].append((offset + k % each * length, length))
    assert sum(len(u) for u in used.values()) == len(lengths)
    for u in used.values():
        u.sort()
        assert [x[0] for x in u] == [0, *itertools.accumulate(x[1] for x in u)][:-1] and sum(x[1] for x in u) <= 100
    assert len(used) <= best_fit(lengths, 100) + 1
    ranks = collections.defaultdict(list)
    for length, rank, count, *_ in plan:
        ranks[length] += range(rank, rank + count)
    assert all(r == list(range(len(r))) for r in ranks.values())


# ------------------------------------------------------------------ web archive
def records(spark, rows):
    return spark.createDataFrame(rows, "record_id string, kind string, url string, at long, http_status int, headers map<string,string>, body string, status string")


def test_revisits(spark):
    rows = [
        ("r1", "response", "http://www.A.org/x/", 10, 200, {"etag": '"1"', "content-type": "text/html", "age": "5"}, "one", "z"),
        ("r2", "response", "https://a.org/x#top", 20, 200, {"etag": '"2"', "last-modified": "m"}, "two", "z"),
        ("r3", "response", "https://a.org/x", 25, 404, {"etag": '"3"'}, "gone", "z"),
        ("r4", "response", "https://a.org/x", 30, 200, None, "plain", "z"),
        ("v0", "revisit", "https://a.org/x", 10, 304, {}, None, "z"),  # not earlier
        ("v1", "revisit", "https://m.a.org:443/x?utm_source=q", 15, 304, {"etag": 'W/"1"', "content-type": "no", "age": "9", "date": "d"}, None, "z"),
        ("v2", "revisit", "https://a.org/x", 28, 304, {"etag": '"1"'}, None, "z"),
        ("v3", "revisit", "https://a.org/x", 29, 304, {"last-modified": "m"}, None, "z"),
        ("v4", "revisit", "https://a.org/x", 40, 304, {"etag": '"9"'}, None, "z"),
        ("v5", "revisit", None, 40, 304, None, None, "z"),
        ("v6", "revisit", "https://a.org/x", None, 304, None, None, "z"),
        ("v7", "revisit", "https://a.org/y", 50, 304, None, None, "z"),
    ]
    got = {r["record_id"]: r for r in warc.resolve_revisits(records(spark, rows)).collect()}
    assert {k: (r["refers_to"], r["status"], r["body"]) for k, r in got.items()} == {
        "v0": (None, "unresolved", None), "v1": ("r1", "resolved", "one"), "v2": ("r2", "mismatch", None), "v3": ("r2", "resolved", "two"),
        "v4": ("r4", "resolved", "plain"), "v5": (None, "unresolved", None), "v6": (None, "unresolved", None), "v7": (None, "unresolved", None),
    }
    assert got["v1"]["headers"] == {"etag": 'W/"1"', "content-type": "text/html", "age": "9", "date": "d"}
    assert warc.resolve_revisits(records(spark, [])).count() == 0
    assert warc.resolve_revisits(records(spark, [*rows, *rows])).count() == 16


def test_latest_earlier_of_a_hot_key(spark, monkeypatch):
    monkeypatch.setattr(warc, "PART", 8)
    rows = [("k" if i % 3 else "q", (i * 37) % 211, i) for i in range(400)]
    given = F.when(F.col("n") % 2 == 0, F.struct("at", "n"))
    found = warc.latest_earlier(spark.createDataFrame(rows, "key string, at long, n long"), "key", "at", given, "last")
    for r in found.collect():
        earlier = [(a, n) for k, a, n in rows if k == r["key"] and n % 2 == 0 and a < r["at"]]
        assert (tuple(r["last"]) if r["last"] else None) == max(earlier, default=None)


def test_canonical_url(spark):
    same = ["http://www.x.org", "https://X.org/", "https://user@m.x.org:443/?ref=1#a", " http://x.org:80//"]
    other = [None, "", "x.org/a", "http://x.org/a?b=1&a=2", "http://x.org/a/?a=2&utm_id=3&b=1"]
    got = [r[0] for r in spark.createDataFrame([(u,) for u in same + other], "url string").select(warc.canonical_url("url")).collect()]
    assert got == ["x.org"] * 4 + [None, None, None] + ["x.org/a?a=2&b=1"] * 2


# ------------------------------------------------------------------ licences
def scanned(rows, templates=licenses.TEMPLATES):
    out = {}
    for i, text in rows:
        words = re.findall(r"[^\W_]+(?:[.\-][^\W_]+)*", (text or "").lower())
        grams = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
        for t, (name, template) in enumerate(templates):
            own = re.findall(r"[^\W_]+(?:[.\-][^\W_]+)*", template.lower())
            own = {tuple(own[k : k + 5]) for k in range(len(own) - 4)}
            half = licenses.half_window(len(own))
            shares = [(len(own & set(grams[s : s + 2 * half])) / len(own), -s) for s in range(0, len(grams), half)]
            if shares and max(shares)[0] >= 0.8:
                out[i, t] = (name, max(shares)[0], -max(shares)[1])
    return out


def test_license_scan(spark, docs, nothing):
    filler = "the archive holds many pages of plain text that mean nothing at all ".split()
    texts = [(k, " ".join(filler * (k % 4) + t.upper().split() + filler * 3)) for k, (_, t) in enumerate(licenses.TEMPLATES)]
    long = licenses.TEMPLATES[1][1].split()
    texts += [(100, " ".join(long[:30] + ["changed"] + long[31:])), (101, " ".join(long[:40])), (102, None), (103, ""), (104, "Released under the MIT"), (105, " ".join(filler * 900) + " Released under the MIT License. " + " ".join(t for _, t in licenses.TEMPLATES))]
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in texts], "doc_id long, text string, license string, id int")
    got = {(r["doc_id"], r["template"]): (r["license"], r["containment"], r["start"]) for r in licenses.scan(frame).collect()}
    assert got == scanned(texts) and len(got) > 20
    assert licenses.scan(docs).count() == licenses.scan(nothing).count() == 0
    assert licenses.scan(frame.union(frame)).count() == len(got)
    with pytest.raises(ValueError):
        licenses.scan(frame, [("X", "too short")])


def test_bands_guarantee():
    for half in (1, 2, 4, 16, 128):
        n = licenses.bands_needed(half)
        for t in range(half // 2 + 1, half + 1):
            shared = math.ceil(0.8 * t)
            assert (1 - shared / (2 * half + t - shared)) ** n <= 1e-6


# ------------------------------------------------------------------ quality rules
def base(text):
    words, lines = words_of(text), [x for x in (text or "").split("\n") if words_of(x)]
    grams = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    times = collections.Counter(grams)
    covered = {k + j for k, g in enumerate(grams) if times[g] > 1 for j in range(5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def test_features(docs, rows, nothing):
    got = quality.with_features(docs)
    for r in got.collect():
        text = next(x[1] for x in rows if x[0] == r["doc_id"])
        assert tuple(r[c] for c in quality.BASE) == base(text), r["doc_id"]
        assert r["n_capitals"] == sum(c.isupper() for c in text or "")
    assert quality.with_features(nothing).count() == 0


def test_binomial_tail(spark):
    cases = [(k, n) for n in (1, 5, 40, 900) for k in (0, 1, 3, 8) if k <= n]
    got = spark.createDataFrame(cases, "k long, n long").select("k", "n", quality.binomial_tail(F.col("k"), F.col("n"), 0.02).alias("p")).collect()
    for r in got:
        exact = sum(math.comb(r["n"], i) * 0.02**i * 0.98 ** (r["n"] - i) for i in range(r["k"] + 1))
        assert r["p"] == pytest.approx(exact if r["k"] < 0.02 * r["n"] else 1.0, rel=1e-9)
    assert spark.range(1).select(quality.binomial_tail(F.lit(9000).cast("long"), F.lit(1_000_000).cast("long"), 0.01)).first()[0] < 1e-20


def test_certified(spark):
    """Bad documents are cut off where labels suffice; elsewhere nothing is, and good ones stay."""
    rows, labels = [], []
    for i in range(3000):
        bad, lang = i % 5 == 0, "en" if i < 2800 else None
        words = [f"w{i}x{k}" for k in range(20)]
        rows.append((i, " ".join(w + ("#$%" if bad else "") for w in words) + ("#" if i % 7 == 0 else ""), lang))
        labels.append((i, 0 if bad else 1))
    rows += [(5000, None, "en"), (5001, " ".join(["a b c d e"] * 9), "en"), (5002, "few words", None)]
    labels += [(5000, 1), (1, None), (2, 1), (77777, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = by_id(quality.rated(docs, spark.createDataFrame(labels, "doc_id long, quality int")))
    assert len(got) == len(rows)
    for i in range(3000):
        assert got[i]["kept"] == (i % 5 != 0 or i >= 2800) and not got[i]["base_failed"]
    assert [got[i]["base_failed"] for i in (5000, 5001, 5002)] == [True] * 3
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert all(r["kept"] != r["base_failed"] for r in quality.rated(docs, none).collect())
    assert quality.rated(docs.limit(0), none).count() == 0
    kept = quality.keep_good(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert kept.columns == docs.columns and kept.count() == sum(g["kept"] for g in got.values())


# ------------------------------------------------------------------ near copies
def shingles(text, width):
    words = words_of("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[k : k + width]) for k in range(len(words) - width + 1)} or ({tuple(words)} if words else set())


@pytest.mark.parametrize("width", [2, 5])
def test_near_groups(docs, rows, width):
    sets = {r[0]: shingles(r[1], width) for r in rows}
    label = {i: i for i in sets}

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * len(sets[a] | sets[b]):
            x, y = top(a), top(b)
            label[max(x, y)] = min(x, y)
    got = by_id(near_dedup.near_groups(docs, width=width))
    assert {i: (r["n_shingles"], r["component_id"], r["kept"]) for i, r in got.items()} == {i: (len(s), top(i), top(i) == i) for i, s in sets.items()}


def test_near_drop(docs, twice, nothing):
    left = near_dedup.drop_near_copies(docs)
    assert left.columns == docs.columns
    assert left.count() == len({r["component_id"] for r in near_dedup.near_groups(docs).collect()})
    assert near_dedup.near_groups(nothing).count() == 0 and near_dedup.near_groups(twice).count() == twice.count()


def test_near_tables_of_few_documents_have_few_files(spark, docs, monkeypatch):
    files, keep = {}, near_dedup.materialize

    def counted(df, name):
        out = keep(df, name)
        files[name] = max(files.get(name, 0), len(out.inputFiles()))
        return out

    monkeypatch.setattr(near_dedup, "materialize", counted)
    held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        got = near_dedup.near_groups(docs.repartition(64)).count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == docs.count()
    assert {"near-sketches", "near-buckets", "near-texts", "near-again", "near-left"} <= set(files)
    assert max(files.values()) <= spark.sparkContext.defaultParallelism, files


def test_files_for(spark):
    cores = spark.sparkContext.defaultParallelism
    docs = spark.range(100_000).select(F.lit("one").alias("text"))
    assert common.files_for(docs) == 50 and common.files_for(docs.limit(10)) == cores and common.files_for(docs.limit(0)) == cores
    # few long texts count by their bytes, and a null text has none
    assert common.files_for(spark.range(100).select(F.repeat(F.lit("é"), 1_000_000).alias("text"))) == 50
    assert common.files_for(spark.range(5).select(F.lit(None).cast("string").alias("text"))) == cores


def test_later_rounds_link_members_of_a_bucket(spark):
    """b and c are alike, and both share a bucket with a, which is like neither."""
    words = [f"w{k}" for k in range(100)]
    texts = [(1, " ".join(words[:70] + [f"x{k}" for k in range(30)])), (2, " ".join(words)), (3, " ".join(words[:95]))]
    # buckets of one bin put all three together
    got = by_id(near_dedup.near_groups(spark.createDataFrame(texts, "doc_id long, text string"), width=2, bands=16, rows=1))
    assert [got[i]["component_id"] for i in (1, 2, 3)] == [1, 2, 2]


def test_pairs_of_a_large_bucket_that_no_hub_is_in(spark):
    """Documents with a long passage in common share all buckets; only some pairs among them are links."""
    passage, texts = [f"w{k}" for k in range(85)], []
    for i in range(120):
        # 85 words of 100 are not enough for a link, 95 are; documents 3 * k + 100 and 3 * k + 101 have 95
        own = [f"x{i - (i % 3 == 1)}y{k}" for k in range(10)] + [f"z{i}y{k}" for k in range(5)]
        texts.append((100 + i, " ".join(passage + own)))
    want = {100 + i: 100 + i - (i % 3 == 1) for i in range(120)}
    got = by_id(near_dedup.near_groups(spark.createDataFrame(texts, "doc_id long, text string"), width=1, bands=2, rows=1))
    assert {i: r["component_id"] for i, r in got.items()} == want


def test_links_that_no_bucket_shows(spark):
    """Pairs of 12 words of 15 at least: one bucket of six bins rarely has both of a pair, and later rounds never see the others."""
    texts = [(2 * k + side, " ".join([f"p{k}w{j}" for j in range(12 + k % 20)] + [f"s{side}p{k}"] * (k % 3 > 0))) for k in range(60) for side in (0, 1)]
    texts += [(1000, "one two three four"), (1001, "one two three four five"), (1002, "one two three"), (1003, "alone"), (1004, " "), (1005, None)]
    sets = {i: shingles(t, 1) for i, t in texts}
    for percent in (80, 95):
        want = {i: i for i in sets}
        for a, b in itertools.combinations(sets, 2):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                want[b] = min(want[b], want[a])
        got = by_id(near_dedup.near_groups(spark.createDataFrame(texts, "doc_id long, text string"), width=1, percent=percent, bands=1, rows=6))
        assert {i: r["component_id"] for i, r in got.items()} == want


def test_links_in_a_large_family_of_unlike_texts(spark):
    """900 documents with 60 words of 70 in common are no links; the first two of each hundred have 64 and are one."""
    passage, texts = [f"w{k}" for k in range(60)], []
    for i in range(900):
        own = [f"x{i - (i % 100 == 1)}y{k}" for k in range(4)] + [f"z{i}y{k}" for k in range(6)]
        texts.append((i, " ".join(passage + own)))
    got = by_id(near_dedup.near_groups(spark.createDataFrame(texts, "doc_id long, text string"), width=1))
    assert {i: r["component_id"] for i, r in got.items()} == {i: i - (i % 100 == 1) for i in range(900)}


@pytest.mark.parametrize("percent", [80, 90])
def test_longer_bands_lose_no_link(spark, percent):
    """Chains of changed sets in one large bucket: the longer bands find every component that brute force finds."""
    rng = np.random.default_rng(percent)
    sets = {}
    for i in range(150):
        near = list(sets[int(rng.integers(0, i))]) if i and rng.random() < 0.6 else [f"c{k}" for k in range(40)]
        words = {w for w in near if rng.random() < 0.93} | {f"o{rng.integers(0, 10**9)}" for _ in range(int(rng.integers(0, 12)))}
        sets[i] = words or {"one"}
    texts = spark.createDataFrame([(i, " ".join(sorted(s))) for i, s in sets.items()], "doc_id long, text string")
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    want = {i: i for i in sets}
    for _ in sets:
        for a, b in links:
            want[a] = want[b] = min(want[a], want[b])
    got = by_id(near_dedup.near_groups(texts, width=1, percent=percent, bands=2, rows=1))
    assert links and {i: r["component_id"] for i, r in got.items()} == want


def test_densified_sketch_estimates_similarity():
    rng = np.random.default_rng(3)
    for n in (4, 30, 400):
        same = []
        for _ in range(60):
            pool = rng.integers(0, 2**63, int(n * 1.25), dtype=np.uint64)
            a, b = np.unique(pool[:n]), np.unique(pool[len(pool) - n :])
            v = near_dedup.sketches(np.array([0, len(a), len(a) + len(b)]), np.concatenate([a, b]), 192)
            same.append((v[0] == v[1]).mean() - len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
        assert abs(np.mean(same)) < 0.06


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (5, 5), (None, 4), (3, 1), (7, 20), (20, 21)] + [(k, k + 1) for k in range(100, 160)]
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {1: 1, 2: 1, 3: 1, 7: 7, 8: 7, 9: 7, 20: 7, 21: 7, **{k: 100 for k in range(100, 161)}}
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


# ------------------------------------------------------------------ passages
def cut(rows):
    seen, out = set(), {}
    for i, text in sorted((r[0], r[1]) for r in rows):
        words = words_of(text)
        gone = [False] * len(words)
        for k in range(len(words) - 19):
            if (g := tuple(words[k : k + 20])) in seen:
                gone[k : k + 20] = [True] * 20
            seen.add(g)
        kept = " ".join(w for w, x in zip(words, gone) if not x)
        out[i] = (len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def test_substring_dedup(docs, rows, nothing, monkeypatch):
    want = cut(rows)
    assert sum(w[1] for w in want.values()) > 500
    for many in (substring_dedup.MANY, 1):  # 1: nearly all blocks go by windows
        monkeypatch.setattr(substring_dedup, "MANY", many)
        got = by_id(substring_dedup.digests(docs))
        assert {i: (r["n_words"], r["n_removed"], r["kept_sha256"]) for i, r in got.items()} == want
    assert substring_dedup.digests(nothing).count() == 0


def test_substring_spans(spark):
    a, b = [f"a{k}" for k in range(60)], [f"b{k}" for k in range(60)]
    texts = [(2, " ".join(b[:10] + a[5:45] + b[10:30])), (1, " ".join(a)), (3, " ".join(a[:19])), (4, " ".join(a[30:50] + b))]
    frame = spark.createDataFrame([*texts, texts[1]], "doc_id long, text string")
    got = by_id(substring_dedup.parsed_documents(frame))
    spans = {i: [(s["start"], s["end"]) for s in r["spans"]] for i, r in got.items() if r["spans"]}
    assert spans == {2: [(10, 50)], 4: [(0, 20), (30, 50)]}
    assert got[2]["kept"] == " ".join(b[:30])


def test_repeated_rows_are_not_copies_of_each_other(twice):
    got = substring_dedup.digests(twice).collect()
    assert len(got) == twice.count()
    alone = by_id(substring_dedup.digests(twice.dropDuplicates(["doc_id", "text"])))
    assert all(r["n_removed"] == alone[r["doc_id"]]["n_removed"] for r in got)


# ------------------------------------------------------------------ toxicity and language
def labelled(spark, n=900):
    import random

    rng = random.Random(7)
    plain = {"en": "the of and to in is was for that with".split(), "fr": "le la les des et un une que dans pour".split()}
    rude = {"en": ["scumbag", "moronic"], "fr": ["vejuaire", "vejuais", "vejuto"]}
    rows, labels = [], []
    for i in range(n):
        lang = rng.choice(["en", "fr"])
        words = rng.choices(plain[lang], k=rng.choice([5, 20, 80])) + [f"x{rng.randrange(3000)}" for _ in range(5)]
        toxic = int(rng.random() < 0.3)
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(rude[lang]) + rng.choice(["", ".", ","]))
        rows.append((i, " ".join(words), lang, "s", None))
        labels.append((i, toxic))
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, id long"), spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels)


def test_toxicity_on_held_out(spark):
    rows, docs, marks, toxic = labelled(spark)
    learn = F.col("doc_id") % 4 != 0
    fitted = toxicity.fit(docs.filter(learn), marks.filter(learn))
    got = by_id(toxicity.rated(docs, fitted))
    held = [i for i in toxic if i % 4 == 0]
    assert sum(got[i]["predicted"] == toxic[i] for i in held) >= 0.97 * len(held)
    # the language changes thresholds, never scores
    other = by_id(toxicity.rated(docs.withColumn("lang", F.lit("xx")), fitted))
    assert all(other[i]["score"] == got[i]["score"] and 0 <= got[i]["score"] <= 1 for i in got)
    again = toxicity.fit(docs.repartition(4).filter(learn), marks.filter(learn))
    assert by_id(toxicity.rated(docs, again))[0]["score"] == pytest.approx(got[0]["score"], abs=1e-6)


def test_toxicity_cut_suits_the_true_shares(spark):
    """A word that is toxic in 40 of 340 documents is not predicted, though it is in most of an even sample."""
    import random

    rng, texts = random.Random(5), []
    for i in range(2000):
        kind = "rude" if i < 80 else "meh" if i < 420 else "plain"
        words = rng.choices("the of and to in is was for that with".split(), k=20) + [kind] * (kind != "plain")
        texts.append((i, " ".join(words), "en", int(i < 120), kind))
    docs = spark.createDataFrame([t[:3] for t in texts], "doc_id long, text string, lang string")
    marks = spark.createDataFrame([(t[0], t[3]) for t in texts], "doc_id long, toxic int")
    got = by_id(toxicity.rated(docs, toxicity.fit(docs, marks, per_label=80)))
    for kind, want in (("rude", 1), ("meh", 0), ("plain", 0)):
        own = [got[t[0]] for t in texts if t[4] == kind]
        assert sum(r["predicted"] == r["flagged"] == want for r in own) >= 0.9 * len(own), kind


def test_toxicity_of_odd_texts(spark, docs, nothing, twice):
    _, learn, marks, _ = labelled(spark, 200)
    fitted = toxicity.fit(learn, marks)
    got = toxicity.rated(docs, fitted)
    assert all(0 <= r["score"] <= 1 for r in got.collect()) and got.count() == docs.count()
    assert toxicity.rated(nothing, fitted).count() == 0 and toxicity.rated(twice, fitted).count() == twice.count()
    none = toxicity.fit(learn, marks.limit(0))
    assert {r["score"] for r in toxicity.rated(docs, none).collect()} == {0.0}
    assert toxicity.fit(nothing, marks)[0] is None


def test_language_on_held_out(spark):
    rows, docs, _, _ = labelled(spark)
    model = language.fit(docs.filter("doc_id % 3 != 1").union(docs.limit(1).withColumn("lang", F.lit(None).cast("string"))))
    got = by_id(language.identified(docs, model))
    held = [r for r in rows if r[0] % 3 == 1]
    assert sum(got[r[0]]["lang_pred"] == r[2] for r in held) >= 0.98 * len(held)


def test_language_spans_and_scripts(spark, docs, nothing, twice):
    texts = [("the of and to in is was for that with " * 5, "en"), ("le la les des et un une que dans pour " * 5, "fr"), ("это не тот мир который был здесь " * 5, "ru")]
    learn = spark.createDataFrame([(k, t, lang) for k, (t, lang) in enumerate(texts * 5)], "doc_id long, text string, lang string")
    model = language.fit(learn)
    mixed = spark.createDataFrame([(1, texts[0][0] + texts[1][0] + " 12 " + texts[2][0]), (2, "Мир"), (3, "123 !!"), (4, None), (5, "")], "doc_id long, text string")
    spans = [(r["start"], r["words"], r["lang"]) for r in language.spans(mixed.filter("doc_id = 1"), model).orderBy("start").collect()]
    assert [s[2] for s in spans] == ["en", "fr", "ru"] and sum(s[1] for s in spans) == 136 and abs(spans[1][0] - 50) <= 1
    got = by_id(language.identified(mixed, model))
    assert [got[i]["lang_pred"] for i in (2, 3, 4, 5)] == ["ru", "und", "und", "und"] and got[3]["score"] == 0
    assert language.identified(nothing, model).count() == 0 and language.identified(twice, model).count() == twice.count()
    assert {r["lang_pred"] for r in language.identified(docs, language.fit(nothing)).collect()} == {"und"}


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(5)
    sizes = [3, 0, 6, 1, 5]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    scores = rng.normal(0, 2, (bounds[-1], 3)).astype(np.float32)
    path = language.viterbi(scores, bounds, 1.5)
    total = lambda s, p: sum(s[k, x] for k, x in enumerate(p)) - 1.5 * sum(x != y for x, y in zip(p, p[1:]))
    for a, b in zip(bounds, bounds[1:]):
        best = max((total(scores[a:b], p) for p in itertools.product(range(3), repeat=int(b - a))), default=0)
        assert total(scores[a:b], path[a:b]) == pytest.approx(best, abs=1e-4)
