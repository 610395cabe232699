import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, size long, start long, kept boolean, bucket long"
SYLLABLES = "an er th on re he in ed nd ha at en of or nt ea ti to it st".split()


def prose(rng, words, common=12):
    vocabulary = ["".join(rng.choices(SYLLABLES, k=k)) for k in (1, 1, 2, 2, 3) for _ in range(40)]
    return [rng.choice(vocabulary[:common] if rng.random() < 0.3 else vocabulary) for _ in range(words)]


def corpus(seed=1, n=60):
    """Prose with exact and near copies, shared passages and repetitions; then odd rows."""
    rng = random.Random(seed)
    rows, passage = [], prose(rng, 40)
    for i in range(n):
        words = prose(rng, rng.choice([3, 8, 12, 30, 60, 200]))
        kind = rng.random()
        if rows and kind < 0.2:
            words = rng.choice(rows)[1].split()
        elif rows and kind < 0.45:
            words = rng.choice(rows)[1].split()
            words[rng.randrange(len(words))] = "changed"
        elif kind < 0.65:
            words = words[: len(words) // 2] + passage + words[len(words) // 2 :]
        elif kind < 0.75:
            words = words + words[:25] + words
        rows.append((i, rng.choice([" ", "\n", "  "]).join(words)))
    odd = [None, "", " \t\n", "one", "One", "two words", "a\x0bb\x0cc\r\nd", "x" * 5000, "é ñ ß 日本 語", "#$% && !!", " ".join(["same"] * 300), " ".join(prose(rng, 6000))]
    rows += [(n + k, t) for k, t in enumerate(odd)]
    langs, sources = ["en", "fr", None], ["a", "b", "c", None]
    return [(i, t, langs[i % 3], sources[(i * i) % 4], None, -i, i % 7, None, True, 1) for i, t in rows]


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def twice(spark, rows):
    """Some rows repeated, and a row without an id."""
    return spark.createDataFrame([*rows[:30], *rows[:30:3], (None, "no id at all", *rows[0][2:])], SCHEMA)
