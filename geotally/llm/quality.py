"""Quality rules with cutoffs that hold a limit on false rejections in every stratum.

Only DataFrame functions. Rules are text features of which a high value is bad. A ladder of cutoffs
begins with the most telling one. On held-out documents labelled good, each step of a stratum's ladder is
tested with the exact binomial distribution, until one fails; the steps before it are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from geotally.llm.common import empty_if_null, materialize, order_hash, row_key, without_rows, WORD, written

WINDOW = 5
MORE = ["n_lines", "n_marks", "n_capitals"]
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Features that the ladder bounds; each is a share, so that its value does not depend on length.
RULES = {
    "symbols": "n_symbols / greatest(word_chars, 1)",
    "repeats": "n_repeat_words / greatest(n_words, 1)",
    "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
    "marks": "n_marks / greatest(word_chars, 1)",
    "capitals": "n_capitals / greatest(word_chars, 1)",
}
#: Shares of the good fitting documents that a cutoff may lie below.
LEVELS = (0.0005, 0.001, 0.002, 0.003, 0.005, 0.007, 0.01, 0.02)


def _removed(text: str, characters: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, f"[{characters}]+", ""))


def with_features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts of BASE and n_lines, n_marks, n_capitals (long) of each whole text.

    Existing columns of these names are replaced. A null text has only zeros. Windows of five words
    that occur twice are found by sorting hashes of the text's windows with their places; the words
    they cover are counted from the gaps between those places. It is done only for texts whose
    windows are not all different, and no row leaves its task.
    """
    names = [c for c in docs.columns if c not in {*BASE, *MORE}]
    x = docs.select(*names).withColumn("__text", empty_if_null(text_col))
    x = x.withColumns({
        "__words": F.regexp_extract_all("__text", F.lit(WORD), F.lit(0)),
        "__lines": F.filter(F.split("__text", "\n", -1), lambda s: s.rlike(WORD)),
        "word_chars": F.length(F.regexp_replace("__text", r"[\x20\x09-\x0D]+", "")).cast("long"),
        "n_symbols": _removed("__text", "#*$%&|<>").cast("long"),
        "n_marks": _removed("__text", "!?|#*$%&<>{}=\\\\").cast("long"),
        "n_capitals": _removed("__text", r"\\p{Lu}".replace("\\\\", "\\")).cast("long"),
    })
    x = x.withColumns({
        "n_words": F.size("__words").cast("long"),
        "n_lines": F.size("__lines").cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "__hashes": F.transform("__words", lambda w: F.xxhash64(w)),
    }).drop("__words", "__lines", "__text")
    gram = lambda i: F.xxhash64(*[F.get("__hashes", i + k) for k in range(WINDOW)])
    x = x.withColumn("__grams", F.when(F.col("n_words") >= WINDOW, F.transform(F.sequence(F.lit(0), F.col("n_words").cast("int") - WINDOW), gram)))
    repeated = F.size("__grams") > F.size(F.array_distinct("__grams"))
    placed = F.array_sort(F.transform("__grams", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    x = x.withColumn("__sorted", F.when(repeated, placed)).drop("__grams", "__hashes")
    twice = lambda s, i: F.when((F.get("__sorted", i - 1)["h"] == s["h"]) | (F.get("__sorted", i + 1)["h"] == s["h"]), s["i"])
    x = x.withColumn("__places", F.sort_array(F.array_compact(F.transform("__sorted", twice)))).drop("__sorted")
    steps = F.transform("__places", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("__places", i + 1) - p, F.lit(WINDOW))))
    covered = F.when(F.col("__places").isNull(), 0).otherwise(F.aggregate(steps, F.lit(0), lambda s, v: s + v))
    return x.withColumn("n_repeat_words", covered.cast("long")).drop("__places")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (F.lit(100) * F.col("n_repeat_words") > F.lit(20) * F.col("n_words"))


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(at most k of n) for the rate p, exactly: the sum of its terms, each from the one before in logs.

    The probability is taken to be 1 where k is p times n or more; it is over a third there, and no
    test at a small level can hold.
    """
    odds = F.log(F.lit(p)) - F.log1p(F.lit(-p))
    first = n * F.log1p(F.lit(-p))
    summed = F.aggregate(
        F.sequence(F.lit(0).cast("long"), k), F.struct(first.alias("term"), F.lit(0.0).alias("sum")),
        lambda s, i: F.struct((s["term"] + F.log((n - i) / (i + 1)) + odds).alias("term"), (s["sum"] + F.exp(s["term"])).alias("sum")),
    )
    return F.when(k < n * p, summed["sum"]).otherwise(F.lit(1.0))


BY = ["no_stratum", "stratum"]
#: Parts of a stratum's rows in joins to its cutoffs, so that one of most rows is spread.
SALTS = 256


def _stratum(df: DataFrame, stratum: str, id_col: str) -> DataFrame:
    """``df`` with the columns BY and salt."""
    return df.withColumns({"no_stratum": F.col(stratum).isNull(), "stratum": empty_if_null(F.col(stratum).cast("string")), "salt": F.pmod(order_hash(id_col, 78), F.lit(SALTS))})


def _per_salt(few: DataFrame) -> DataFrame:
    return few.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))


def _first_hit(ladder: str) -> Column:
    """The place, from 1, of the first step of the ladder that the row exceeds; 0 if there is none."""
    values = F.array(*[F.expr(e).cast("double") for e in RULES.values()])
    return F.array_position(F.transform(ladder, lambda c: F.get(values, c["rule"]) > c["cutoff"]), True)


def certified_ladders(features: DataFrame, labels: DataFrame, stratum: str = "lang", alpha: float = 0.01, delta: float = 0.05, levels: tuple[float, ...] = LEVELS, useful: float = 10.0, id_col: str = "doc_id") -> DataFrame:
    """Per stratum: n, lost and ladder, the cutoffs (rule, cutoff) in force.

    Labelled documents that pass the base rules are split in halves by a hash of the id. In the fitting
    half, quantiles of the good documents (quality 1) give cutoffs for every rule; each is moved up, midway
    to the lower tenth of the bad documents (quality 0) above it. A cutoff is a step if its share of bad ones is ``useful`` times its share of good ones; the ladder takes steps
    by this ratio, and each step rejects what it and all before it exceed. The held-out half tests
    the ladder: a step holds if, at a rate ``alpha`` of false rejections, so few of the good would be
    lost with a chance of at most ``delta`` over the number of strata (Bonferroni). Steps are tested in
    turn up to the first failure, which needs no further correction. So with confidence 1 - delta no
    stratum loses more than alpha of its good documents. A stratum without a step that holds, as
    with too few labels, has no row: nothing is rejected there beyond the base rules.

    Other labels, and rows without one, are not used. Repeated labels of a document count once (the greatest).
    A table of features or labels without rows gives no rows.
    """
    rated_ids = labels.filter("quality in (0, 1)").groupBy(F.col(id_col).alias("__id")).agg(F.max("quality").alias("good"))
    rows = _stratum(features.filter(~base_failed()), stratum, id_col).join(rated_ids, F.col(id_col) == F.col("__id"))
    rows = rows.select(*BY, "salt", "good", (F.pmod(order_hash(id_col, 77), F.lit(2)) == 0).alias("fits"), *BASE, *MORE)
    rows = written(rows, "quality-labelled", labels.count())
    # the fitting half: cutoffs, what each rejects, and their order
    fitting, shares = rows.filter("fits"), F.array(*[F.lit(1 - s) for s in levels])
    good = fitting.filter("good = 1").groupBy(*BY).agg(*[F.percentile_approx(F.expr(e), shares, 100_000).alias(r) for r, e in RULES.items()])
    step = lambda k: lambda c: F.struct(F.lit(k).alias("rule"), c.cast("double").alias("cutoff"))
    cutoffs = good.select(*BY, F.array_distinct(F.concat(*[F.transform(r, step(k)) for k, r in enumerate(RULES)])).alias("cutoffs"))
    values = F.array(*[F.expr(e).cast("double") for e in RULES.values()])
    exceeded = F.filter("cutoffs", lambda c: F.get(values, c["rule"]) > c["cutoff"])
    valued = F.transform(exceeded, lambda c: F.struct(c.alias("step"), F.get(values, c["rule"]).alias("value")))
    hits = fitting.join(_per_salt(cutoffs), [*BY, "salt"]).select(*BY, "good", F.explode(valued).alias("hit"))
    low = F.percentile_approx(F.when(F.col("good") == 0, F.col("hit.value")), F.lit(0.1), F.lit(10_000))
    hits = hits.groupBy(*BY, "hit.step").agg(F.sum("good").alias("lost"), F.sum(1 - F.col("good")).alias("caught"), low.alias("low"))
    # midway to the least tenth of the bad that exceed it, so that one mark too many does no harm
    hits = hits.withColumn("step", F.struct("step.rule", ((F.col("step.cutoff") + F.col("low")) / 2).alias("cutoff")))
    totals = fitting.groupBy(*BY).agg(F.sum("good").alias("n_good"), F.sum(1 - F.col("good")).alias("n_bad"))
    gain = F.try_divide(F.col("caught") * F.col("n_good"), F.col("n_bad") * (F.col("lost") + 1))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("gain")).alias("by"), "step")))
    ladders = hits.join(totals, BY).withColumn("gain", gain).filter((F.col("gain") >= useful) & (F.col("caught") >= 3))
    ladders = ladders.groupBy(*BY).agg(F.transform(ordered, lambda x: x["step"]).alias("ladder"))
    # the held-out half: how many good documents each step loses
    judged_by = rows.filter("not fits and good = 1").join(_per_salt(ladders), [*BY, "salt"]).withColumn("first", _first_hit("ladder"))
    lost = judged_by.groupBy(*BY, "first").agg(F.count("*").alias("k"))
    lost = lost.groupBy(*BY).agg(F.sum("k").alias("n"), F.map_from_entries(F.collect_list(F.struct("first", "k"))).alias("by_step")).join(ladders, BY)
    upto = lambda j: F.aggregate(F.sequence(F.lit(1), j), F.lit(0).cast("long"), lambda s, i: s + F.coalesce(F.try_element_at("by_step", i.cast("long")), F.lit(0).cast("long")))
    lost = lost.withColumn("lost", F.transform("ladder", lambda _, i: upto(i + 1)))
    # the number of strata is one number, so this join adds a column
    lost = lost.join(F.broadcast(ladders.agg(F.count("*").alias("strata"))), F.lit(True))
    holds = F.transform("lost", lambda k: binomial_tail(k, F.col("n"), alpha) <= F.lit(delta) / F.col("strata"))
    failed = F.array_position(holds, False)
    steps = F.when(failed > 0, failed - 1).otherwise(F.size("ladder")).cast("int")
    return lost.withColumn("steps", steps).filter("steps > 0").select(*BY, "n", F.get("lost", F.col("steps") - 1).alias("lost"), F.slice("ladder", F.lit(1), F.col("steps")).alias("ladder"))


def judged(features: DataFrame, labels: DataFrame, stratum: str = "lang", id_col: str = "doc_id", **how) -> DataFrame:
    """``features`` with base_failed and kept.

    Kept are rows that pass the base rules and exceed no cutoff of their stratum; a null stratum is
    a stratum. ``features`` is read several times; write it first.
    """
    ladders = certified_ladders(features, labels, stratum, id_col=id_col, **how).select(*BY, "ladder")
    x = _stratum(features, stratum, id_col).join(_per_salt(ladders), [*BY, "salt"], "left").withColumn("base_failed", base_failed())
    over = F.coalesce(_first_hit("ladder"), F.lit(0)) > 0
    return x.withColumn("kept", ~F.col("base_failed") & ~over).drop(*BY, "salt", "ladder")


def rated(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum: str = "lang", digest: bool = False, **how) -> DataFrame:
    """One row per input row: id, the counts of BASE, base_failed, kept; with ``digest`` a hash of the text too."""
    slim = docs.select(F.col(id_col), F.col(stratum), F.col(text_col), *([F.xxhash64(text_col).alias("__digest")] if digest else []))
    features = materialize(with_features(slim, text_col).drop(text_col), "quality-features")
    return judged(features, labels, stratum, id_col=id_col, **how).select(id_col, *BASE, "base_failed", "kept", *(["__digest"] if digest else []))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` without the rows that the rules reject. They go by id and text: another text under the same id stays."""
    bad = rated(docs, labels, id_col, text_col, digest=True, **how).filter("not kept")
    return without_rows(docs, row_key(id_col, F.xxhash64(text_col)), bad.select(row_key(id_col, F.col("__digest"))))
