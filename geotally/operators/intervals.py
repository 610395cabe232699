"""Matching dated rows with date ranges by an index of bins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from geotally.model import day

#: Days in a bin: a range becomes a row for each bin that it touches, and a dated row lies in one.
BIN = 32


def in_intervals(points: DataFrame, ranges: DataFrame, keys: list[str], width: int = BIN) -> DataFrame:
    """Each row of ``points`` with every range of the same keys that its date lies in.

    ``ranges``: keys, ``start``, ``end`` (both included) and any other columns, which must not occur in ``points``. A
    range without a start or end is open there; one that ends before it starts matches nothing. Rows and ranges meet
    in an equi-join by keys and bin, so a key with many ranges is spread over time, and only rows of the same bin
    are tested. Open ends reach as far as the dates of ``points``.
    """
    first, last = points.agg(F.min("date")).scalar(), points.agg(F.max("date")).scalar()
    number = lambda d: F.floor(day(d) / width)
    closed = ranges.withColumns({"_from": F.greatest(F.coalesce("start", first), first), "_to": F.least(F.coalesce("end", last), last)})
    bins = closed.filter("_from <= _to").withColumn("_bin", F.explode(F.sequence(number("_from"), number("_to"))))
    found = points.withColumn("_bin", number("date")).join(bins.drop("start", "end"), [*keys, "_bin"])
    return found.filter(F.col("date").between(F.col("_from"), F.col("_to"))).drop("_bin", "_from", "_to")
