"""Repeated and null ids, many labels, clashing columns: what goes is a row, not all rows of an id."""
import numpy as np
import pytest

from geotally.llm import exact_dedup, language, mixing, near_dedup, quality, substring_dedup
from tests.llm.test_operators import cut

TEXTS = [(1, "same text here"), (5, "same text here"), (5, "quite unique words"), (None, "same text here"), (None, "other words alone"), (None, "other words alone"), (7, None), (8, " ")]


@pytest.fixture(scope="module")
def mixed(spark):
    return spark.createDataFrame([(i, t, "en", "x", 0) for i, t in TEXTS], "doc_id long, text string, lang string, __row string, __at int")


def rows_of(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def test_exact_copies_go_by_row(mixed):
    left = exact_dedup.drop_exact_copies(mixed)
    assert left.columns == mixed.columns
    assert rows_of(left) == sorted([(1, "same text here"), (5, "quite unique words"), (None, "other words alone"), (8, " ")], key=str)


def test_near_copies_go_by_row(spark):
    words = [f"w{k}" for k in range(60)]
    text, near = " ".join(words), " ".join([*words[:59], "changed"])
    df = spark.createDataFrame([(1, text), (5, near), (5, "quite unique words of five"), (None, near), (None, "nothing like the others at all")], "doc_id long, text string")
    assert rows_of(near_dedup.drop_near_copies(df)) == sorted([(1, text), (5, "quite unique words of five"), (None, "nothing like the others at all")], key=str)


def test_rejected_rows_go_by_row(spark):
    good = " ".join(f"word{k} of this plain text" for k in range(20))
    df = spark.createDataFrame([(1, good, "en"), (1, "too short", "en"), (None, good, "en"), (None, "short", "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert rows_of(quality.keep_good(df, labels)) == sorted([(1, good), (None, good)], key=str)


def test_mixing_beside_columns_of_its_own_names(spark):
    df = spark.createDataFrame([(i, f"some words of text {i}", s, 1.0, 2, "p") for i, s in enumerate("aabbbc")], "doc_id long, text string, source string, __id double, __at int, __positions string")
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns and {r["__positions"] for r in out.collect()} == {"p"}


def test_more_labels_than_a_byte_holds():
    rng = np.random.default_rng(3)
    wanted = rng.integers(0, 300, 40)
    scores = np.zeros((40, 300), np.float32)
    scores[np.arange(40), wanted] = 50
    assert language.viterbi(scores, np.array([0, 25, 40]), 8.0).tolist() == wanted.tolist() and wanted.max() > 255


def test_many_languages_are_told_apart(spark):
    rows = [(i, " ".join(f"{chr(0x4E00 + 3 * i)}{chr(0x4E01 + 3 * i)}" for _ in range(12)), f"l{i:03d}") for i in range(270)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in language.identified(df, language.fit(df)).collect()}
    assert sum(got[i] == lang for i, _, lang in rows if i >= 256) >= 12


def test_rows_without_an_id_lose_their_copies(spark):
    """A null id is one id, before all others."""
    passage, other = " ".join(f"p{k}" for k in range(30)), " ".join(f"q{k}" for k in range(30))
    rows = [(1, passage + " end"), (None, "start " + passage + " " + other), (2, other), (None, other + " " + other)]
    got = {(r["doc_id"], r["n_words"]): r["n_removed"] for r in substring_dedup.digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1, 31] == 30 and got[2, 30] == 30 and got[None, 61] > 0
    plain = [(i, t) for i, t in rows if i is not None]
    want = cut(plain)
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring_dedup.digests(spark.createDataFrame(plain, "doc_id long, text string")).collect()} == want
