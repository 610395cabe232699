"""Registered queries over the given tables, beside their SQL or a plain loop."""
import pathlib
import re
import sys
import zlib

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.test_operators import base, cut, shingles, words_of
from tests.llm.test_text_operators import expected, mined

sys.path.insert(0, str(pathlib.Path(__file__).parents[2] / "tools"))
import check  # noqa: E402

DATA = "/root/testdata/sf0.001"
NAMES = [n for n in entry.queries() if re.match(r"op\d+_|pipeline", n)]
pytestmark = pytest.mark.skipif(not pathlib.Path(DATA).exists(), reason="given tables are absent")


@pytest.fixture(scope="module")
def given():
    return duckdb.sql(f"select doc_id, text from '{DATA}/documents.parquet'").fetchall()


def test_thirteen_operators_and_the_pipeline():
    assert sorted(NAMES) == sorted(["pipeline", *[next(n for n in NAMES if n.startswith(f"op{k}_")) for k in range(1, 14)]])


@pytest.mark.parametrize("name", [n for n in NAMES if n in entry.oracle_sql()])
def test_sql(spark, name):
    status, _, _, message = check.compare(spark, DATA, name, entry.queries()[name], entry.oracle_sql()[name])
    assert status == "OK", message


def by_id(spark, name):
    return {r["doc_id"]: r for r in entry.queries()[name](spark, DATA).collect()}


def test_op5(spark, given):
    got = by_id(spark, "op5_quality_rules")
    for i, text in given:
        n, chars, symbols, lines, repeats = base(text)
        assert (got[i]["n_words"], got[i]["word_chars"], got[i]["n_symbols"], got[i]["n_dup_lines"], got[i]["n_repeat_words"]) == (n, chars, symbols, lines, repeats)
        assert got[i]["base_failed"] == (n < 10 or 100 * repeats > 20 * n) and not (got[i]["base_failed"] and got[i]["kept"])


def test_op8(spark, given):
    assert {i: (r["n_words"], r["n_removed"], r["kept_sha256"]) for i, r in by_id(spark, "op8_substring_dedup").items()} == cut(given)


def test_op7_and_op10_folds(spark, given):
    toxic, lang = by_id(spark, "op7_toxicity"), by_id(spark, "op10_language_id")
    for i, text in given:
        assert toxic[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and lang[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert toxic[i]["predicted"] == (toxic[i]["score"] >= 0.5) and 0 <= lang[i]["score"] <= 1
    known = dict(duckdb.sql(f"select doc_id, lang from '{DATA}/documents.parquet'").fetchall())
    held = [i for i in lang if lang[i]["held_out"]]
    assert sum(lang[i]["lang_pred"] == known[i] for i in held) >= 0.95 * len(held)


def test_pipeline_stages(spark, given):
    docs, texts = spark.read.parquet(f"{DATA}/documents.parquet"), dict(given)
    left = {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, DATA)
        assert out.columns == docs.columns
        docs = corpus_pipeline.materialize(out, "test-stage")
        left[name] = [r["doc_id"] for r in docs.collect()]
    quality, exact, near, mixed = (left[n] for n, _ in corpus_pipeline.STAGES[:4])
    rated = by_id(spark, "op5_quality_rules")
    assert sorted(quality) == sorted(i for i in texts if rated[i]["kept"])
    norm = {i: re.sub(r"[\x20\x09-\x0D]", "", texts[i] or "") for i in texts}
    assert len(exact) == len({norm[i] for i in quality}) == len({norm[i] for i in exact})
    sets = {i: shingles(texts[i], 5) for i in exact}
    label = {i: i for i in exact}
    for a in sorted(exact):
        for b in sorted(exact):
            if a < b and (both := len(sets[a] & sets[b])) and 100 * both >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((label[a], label[b]))
                label = {k: low if v == high else v for k, v in label.items()}
    assert sorted(near) == sorted(set(label.values()))
    words = sum(len(words_of(texts[i])) for i in near)
    assert set(mixed) <= set(near) and abs(sum(len(words_of(texts[i])) for i in mixed) - words) <= 0.1 * words
    packed = corpus_pipeline.STAGES[4][1](spark, docs, DATA).toPandas()
    assert packed.groupby("sequence_id")["length"].sum().max() <= 1024
    assert sorted(packed.loc[packed["piece"] == 0, "doc_id"]) == sorted(mixed)


def test_op11(spark, given):
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = by_id(spark, "op11_token_counts")
    for i, text in given:
        size = len(model.encode(text or ""))
        assert (got[i]["n_bytes"], got[i]["n_tokens"], got[i]["over_limit"]) == (len((text or "").encode()), size, size > 4096)


def test_op12(spark):
    rows = duckdb.sql(f"select lang, text from '{DATA}/documents.parquet'").fetchall()
    assert sorted(tuple(r) for r in entry.queries()["op12_phrase_collocations"](spark, DATA).collect()) == mined(rows, 100, 2000)


def test_op13(spark, given):
    got = entry.queries()["op13_periodic_runs"](spark, DATA).collect()
    assert sorted(tuple(r) for r in got) == sorted(expected(i, t) for i, t in given)


def test_run_is_the_stages(spark):
    assert corpus_pipeline.run(spark, DATA).count() > 0
