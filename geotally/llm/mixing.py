"""Mixing sources to target weights that change over training.

Each source has a schedule of weights over training time 0 to 1, linear between its knots. The
integral of the schedule is the source's weight; targets follow from it. Within a source, documents
stand in a hashed order, and each copy that the target takes starts at some number of the source's
tokens. The curve of tokens that the schedule has asked for by a time, inverted there, is the copy's
training position. Copies are then range-sorted by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from geotally.llm.common import bucket_bits, empty_if_null, fresh, hash_bucket, materialize, order_hash, packed, unpacked, with_running_total, WORD, written

SOURCE = ["no_source", "source"]


def word_count(text: str = "text") -> Column:
    return F.regexp_count(empty_if_null(text), F.lit(WORD)).cast("long")


def _source_key(source: str) -> list[Column]:
    return [F.col(source).isNull().alias("no_source"), empty_if_null(F.col(source).cast("string")).alias("source")]


def ramp(weight: Column, first: float = 0.5) -> Column:
    """Knots of a weight that goes from ``first`` times its mean to ``2 - first`` times, linearly."""
    knot = lambda t, w: F.struct(F.lit(float(t)).alias("t"), (weight * w).cast("double").alias("w"))
    return F.array(knot(0, first), knot(1, 2 - first))


def _segments(knots: Column) -> Column:
    """Per stretch between two knots: start, weight there, slope, and the integrals up to its ends."""
    def one(i):
        a, b = F.get(knots, i), F.get(knots, i + 1)
        return F.struct(a["t"].alias("t"), a["w"].alias("w"), ((b["w"] - a["w"]) / (b["t"] - a["t"])).alias("slope"), ((a["w"] + b["w"]) * (b["t"] - a["t"]) / 2).alias("area"))

    return F.transform(F.sequence(F.lit(0), F.size(knots) - 2), one)


def source_targets(sizes: DataFrame, knots: DataFrame, budget: float = 1.0, most: float = 3.0) -> DataFrame:
    """Per source: source_size, its knots' segments, integrated weight and target in tokens.

    ``knots`` has no_source, source and knots. The budget is a share of all tokens. No target
    exceeds ``most`` times its source; what is over goes to the others by weight, and so on:
    sources sorted by size over weight fill up in that order, so running sums over the table of
    sources give the level at which the rest settles. This table has one row per source of the mix,
    which a schedule names, not per document.
    """
    full = sizes.groupBy(*SOURCE).agg(F.sum("size").alias("source_size")).join(knots, SOURCE)
    full = full.withColumn("segments", _segments(F.col("knots"))).drop("knots")
    full = full.withColumn("weight", F.aggregate("segments", F.lit(0.0), lambda s, x: s + x["area"])).withColumn("most", F.col("source_size") * F.lit(float(most)))
    order, everything = W.orderBy(F.col("most") / F.col("weight"), *SOURCE), W.partitionBy()
    full = full.withColumns({
        "budget": F.sum("source_size").over(everything) * F.lit(float(budget)),
        "filled": F.coalesce(F.sum("most").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)),
        "rest": F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing)),
    }).withColumn("level", (F.col("budget") - F.col("filled")) / F.col("rest"))
    # the first source that the level does not fill sets the level of all that follow
    open_ = F.when(F.col("level") * F.col("weight") <= F.col("most"), F.col("level"))
    full = full.withColumn("settled", F.first(open_, ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, 0)))
    target = F.when(F.col("settled").isNull(), F.col("most")).otherwise(F.least("most", F.col("settled") * F.col("weight")))
    return full.select(*SOURCE, "source_size", "segments", "weight", target.alias("target"))


def position(done: Column, target: Column, segments: Column, weight: Column) -> Column:
    """The time by which the schedule has asked for ``done`` of ``target`` tokens."""
    asked = F.when(target > 0, done / target).otherwise(F.lit(0.0)) * weight
    walked = F.aggregate(
        segments, F.struct(F.lit(0.0).alias("upto"), F.lit(None).cast("double").alias("at")),
        lambda s, x: F.struct(
            (s["upto"] + x["area"]).alias("upto"),
            F.coalesce(
                s["at"],
                F.when(
                    asked <= s["upto"] + x["area"],
                    x["t"] + F.coalesce(
                        F.try_divide(F.lit(2.0) * (asked - s["upto"]), x["w"] + F.sqrt(F.greatest(F.lit(0.0), x["w"] * x["w"] + F.lit(2.0) * x["slope"] * (asked - s["upto"])))),
                        F.lit(0.0),
                    ),
                ),
            ).alias("at"),
        ),
    )
    return F.least(F.coalesce(walked["at"], F.lit(1.0)), F.lit(1.0))


def cycling_weights(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Knots for each source: the weights in turn by code point of the name, null last.

    The first rises over training, the next stays, the next falls, and so on, each with the weight as its mean.
    """
    rank = F.row_number().over(W.orderBy("no_source", "source")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights)) + 1)
    knots = F.when(F.col("turn") == 0, ramp(F.col("weight"))).when(F.col("turn") == 1, ramp(F.col("weight"), 1.0)).otherwise(ramp(F.col("weight"), 1.5))
    return sources.select(*SOURCE).distinct().withColumns({"weight": weight, "turn": rank % 3}).select(*SOURCE, knots.alias("knots"))


def mix_plan(docs: DataFrame, knots=cycling_weights, budget: float = 1.0, most: float = 3.0, id_col: str = "doc_id", source_col: str = "source", size: Column | None = None, passes: int = 3, seed: int = 0) -> DataFrame:
    """One row per input row: id, source, size, source_size, target, copies, taken, positions.

    ``knots``: a function of the frame of sources. A source's target of T tokens takes every document
    T // source_size times whole and, of the next round, the documents in hashed order as far as they
    fit. The gap before the first that does not fit is filled in the same way by documents no larger
    than it, and in the last pass by the one document of the nearest size, if that comes nearer to T.
    So a document is never cut, the miss is at most half of the smallest document left, and nothing
    exceeds ``most`` copies.

    A null text has size 0; a document of size 0 takes no tokens and one copy when its place is
    within the target. A null source is a source. Rows that repeat an id are documents of their own.
    Other columns are not read. An empty table gives no rows. Running totals have two levels, so a
    source with a third of all rows is spread over hash buckets. Reruns agree: order and ties
    depend on the id only.
    """
    rows = docs.select(F.col(id_col).alias("id"), *_source_key(source_col), (word_count() if size is None else size).alias("size"))
    rows = materialize(rows.withColumn("ordered", order_hash("id", seed)), "mix-sizes")
    n = rows.count()
    bits = bucket_bits(n)
    rows = rows.withColumn("bucket", hash_bucket("ordered", bits))
    # what holds for a source reaches its rows by hash buckets, never all of them in one task
    spread = [*SOURCE, "bucket"]
    buckets = rows.select(*spread).distinct()
    targets = written(buckets.join(source_targets(rows, knots(rows), budget, most), SOURCE), "mix-targets", n >> 8)
    placed = with_running_total(rows, SOURCE, "ordered", ["id"], F.col("size"), "start", bits).join(targets, spread)
    rounds = F.when(F.col("source_size") > 0, F.floor(F.least(F.col("target") / F.col("source_size"), F.lit(float(most))))).otherwise(0).cast("int")
    placed = placed.withColumn("rounds", rounds).withColumn("room", F.when(F.col("rounds") >= most, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.col("target") - F.col("rounds") * F.col("source_size"))))
    placed = placed.withColumn("at", F.when((F.col("rounds") < most) & (F.col("start") + F.col("size") <= F.col("room")), F.col("start")))
    for k in range(passes):
        placed = written(placed, f"mix-places-{k}", n)
        room = placed.groupBy(*SOURCE).agg(F.max("room").alias("room"), F.coalesce(F.sum(F.when(F.col("at").isNotNull(), F.col("size"))), F.lit(0)).alias("fitted"))
        room = buckets.join(room.select(*SOURCE, "fitted", (F.col("room") - F.col("fitted")).alias("gap")), SOURCE)
        open_ = placed.filter("at is null and rounds < %d" % most).join(room, spread).filter("size > 0")
        if k < passes - 1:  # the gap is filled again by those that are no larger than it
            again = with_running_total(open_.filter("size <= gap"), SOURCE, "ordered", ["id", "start"], F.col("size"), "again", bits)
            filled = again.filter(F.col("again") + F.col("size") <= F.col("gap"))
        else:  # and last by the one that comes nearest
            far = F.abs(F.col("size") - F.col("gap"))
            best = open_.filter(far < F.col("gap")).groupBy(*SOURCE).agg(F.min(F.struct(far.alias("far"), "ordered", "id", "start", "fitted")).alias("best"))
            filled = best.select(*SOURCE, "best.ordered", "best.id", "best.start", "best.fitted", F.lit(0).alias("again"))
        filled = filled.select(*SOURCE, "ordered", "start", F.col("id").alias("same_id"), (F.col("fitted") + F.col("again")).alias("next"))
        placed = placed.join(filled, [*SOURCE, "ordered", "start"], "left").withColumn("at", F.coalesce("at", F.when(F.col("id").eqNullSafe(F.col("same_id")) & (F.col("size") > 0), F.col("next")))).drop("same_id", "next")
    chosen = placed.withColumn("copies", F.col("rounds") + F.col("at").isNotNull().cast("int"))

    def at(k):
        done = k * F.col("source_size") + F.when(k == F.col("rounds"), F.col("at")).otherwise(F.col("start"))
        return position(done, F.col("target"), F.col("segments"), F.col("weight"))

    positions = F.when(F.col("copies") > 0, F.transform(F.sequence(F.lit(0), F.col("copies") - 1), at)).otherwise(F.array().cast("array<double>"))
    return chosen.select(F.col("id").alias(id_col), F.when(~F.col("no_source"), F.col("source")).alias("source"), "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"), positions.alias("positions"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` in training order: a row per copy that the mix takes, range-sorted by position.

    Rows that repeat an id share the copies of one of them. Texts move twice, to their positions and into
    order, so they are packed in between.
    """
    plan = mix_plan(docs, id_col=id_col, **how).filter("copies > 0")
    id_, positions, at = (fresh(docs, n) for n in ("__id", "__positions", "__at"))
    plan = plan.groupBy(F.col(id_col).alias(id_)).agg(F.min("positions").alias(positions))
    copies = packed(docs, text_col).join(plan, F.col(id_col).eqNullSafe(F.col(id_))).withColumn(at, F.explode(positions))
    ordered = copies.drop(positions, id_).repartitionByRange(at, id_col).sortWithinPartitions(at, id_col).drop(at)
    return unpacked(ordered, text_col)
