"""Time-series operators on sparse series.

A frame over day numbers counts calendar days, so most operators need no densified rows. Where
missing days must appear in the output, each row generates the days up to its successor, which
costs no join. A series has at most one row per day, so a window partition is bounded by the
length of the calendar, whatever share of the raw records one key holds.
"""

from __future__ import annotations

import datetime
import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from geotally.model import POINT, SERIES, day, days_back, materialize, series_window, whole_series
from geotally.operators.layout import densify_calendar, densify_per_series


def _keep(df: DataFrame, value: Column, *extra: str) -> DataFrame:
    return df.select(*POINT, value.alias("value"), *extra).filter("value is not null")


def previous_day(col: str = "value", n: int = 1, by: list[str] | None = None) -> Column:
    """Value n calendar days earlier, NULL if that day has no row."""
    return F.first(col).over(days_back(n, -n, by))


def incident_from_cumulative(obs: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Difference to the previous calendar day; -1 counts as 0, other drops as missing."""
    if names:
        obs = obs.filter(F.col("variable").isin(list(names)))
    diff = F.col("value") - previous_day()
    out = _keep(obs.filter("value is not null"), F.when(diff == -1, 0.0).when(diff >= 0, diff))
    if not names:
        return out
    renamed = F.element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), F.col("variable"))
    return out.withColumn("variable", renamed)


def spread_after_stall(obs: DataFrame, max_days: int | Column = 14, by: list[str] | None = None, col: str = "value") -> DataFrame:
    """Divide the first report after a run of zeros evenly over the run.

    A run ends at a non-zero value. Of a run of n rows the last min(n, max_days) share the report.
    Rows up to the first positive and after the last positive value stay as they are.
    """
    by = by or SERIES
    v = F.col(col)
    fwd = series_window(by=by)
    upto = fwd.rowsBetween(W.unboundedPreceding, -1)
    back = W.partitionBy(*by).orderBy(day().desc()).rowsBetween(W.unboundedPreceding, 0)
    whole = whole_series(by)
    rows = obs.filter(v.isNotNull()).withColumn("_rn", F.row_number().over(fwd))
    rows = rows.withColumns({
        "_prev": F.max(F.when(v != 0, F.col("_rn"))).over(upto),
        "_lo": F.min(F.when(v > 0, F.col("_rn"))).over(whole),
        "_hi": F.max(F.when(v > 0, F.col("_rn"))).over(whole),
        "_next": F.min(F.when(v != 0, F.col("_rn"))).over(back),
        "_report": F.last(F.when(v != 0, v), ignorenulls=True).over(back),
    })
    limit = max_days if isinstance(max_days, Column) else F.lit(max_days)
    share = F.least(F.col("_next") - F.coalesce("_prev", F.lit(0)), limit)
    inside = (F.col("_rn") > F.col("_lo")) & (F.col("_rn") <= F.col("_hi"))
    value = F.when(inside & (F.col("_rn") > F.col("_next") - share), F.col("_report") / share).otherwise(v)
    return rows.withColumn(col, value).drop("_rn", "_prev", "_lo", "_hi", "_next", "_report")


def patch_date_range_spread(obs: DataFrame, chosen: Column, start: datetime.date, end: datetime.date) -> DataFrame:
    """Spread inside one date range, over at most the days from its start to its end."""
    inside = chosen & F.col("date").between(F.lit(start), F.lit(end))
    patched = spread_after_stall(obs.filter(inside), (end - start).days)
    return obs.filter(~inside).select(*POINT, "value").unionByName(patched.select(*POINT, "value"))


def rolling_sum(obs: DataFrame, days: int = 7) -> DataFrame:
    """Sum of the last n days, only where all n are present."""
    w = days_back(days - 1)
    return _keep(obs, F.when(F.count("value").over(w) == days, F.sum("value").over(w)))


def fill_forward(obs: DataFrame, until: Column, limit: int | None = None) -> DataFrame:
    """Repeat each value on the days up to the next one, at the end up to ``until``."""
    following = F.lead("date").over(series_window())
    last = F.coalesce(F.date_sub(following, 1), until)
    if limit is not None:
        last = F.least(last, F.date_add("date", limit))
    real = obs.filter("value is not null").withColumn("_last", last)
    return real.select(*SERIES, F.explode(F.sequence("date", F.greatest("date", "_last"))).alias("date"), "value")


def locf_fill(obs: DataFrame) -> DataFrame:
    """Forward fill to the end of the calendar of the whole frame."""
    return fill_forward(obs, obs.agg(F.max("date")).scalar())


def locf_fill_limited(obs: DataFrame, limit: int = 14) -> DataFrame:
    return fill_forward(obs, obs.agg(F.max("date")).scalar(), limit)


def last_nonzero(by: list[str] | None = None) -> Column:
    return F.max(F.when(F.col("value") != 0, F.col("date"))).over(whole_series(by))


def smooth_rolling_mean(
    obs: DataFrame, days: int = 7, include_trailing_zeros: bool = True, exclude_negatives: bool = True,
) -> DataFrame:
    """Trailing mean over the real values of the last n days, at days with a real value."""
    rows = obs.filter("value is not null")
    if exclude_negatives:
        rows = rows.filter("value >= 0")
    mean = F.avg("value").over(days_back(days - 1))
    if not include_trailing_zeros:
        mean = F.when(F.col("date") <= F.coalesce(last_nonzero(), F.lit(datetime.date(9999, 12, 31))), mean)
    return _keep(rows, mean)


def interpolate_stalled(obs: DataFrame) -> DataFrame:
    """Linear interpolation over gaps and repeated values, rounded down.

    A value equal to that of the day before counts as missing. Days after the last kept value
    repeat it, up to the last real observation.
    """
    rows = obs.filter("value is not null").withColumns(
        {"_end": F.max("date").over(whole_series()), "_stalled": F.col("value") == previous_day()}
    )
    w = series_window()
    kept = rows.filter(~F.coalesce("_stalled", F.lit(False))).withColumns(
        {"_d1": F.lead("date").over(w), "_v1": F.lead("value").over(w)}
    )
    days = kept.withColumn("t", F.explode(F.sequence("date", F.coalesce(F.date_sub("_d1", 1), F.col("_end")))))
    step = F.datediff("t", "date") * (F.col("_v1") - F.col("value")) / F.datediff("_d1", "date")
    return days.select(*SERIES, F.col("t").alias("date"), F.floor(F.col("value") + F.coalesce(step, F.lit(0.0))).cast("double").alias("value"))


def recent_data(obs: DataFrame, as_of: datetime.date, back: int = 14, required: int = 7) -> DataFrame:
    """Per series whether enough recent real values exist and one is positive."""
    recent = (F.col("date") >= F.lit(as_of - datetime.timedelta(days=back))) & F.col("value").isNotNull()
    n = F.count(F.when(recent, 1))
    positive = F.coalesce(F.max(recent & (F.col("value") > 0)), F.lit(False))
    return obs.groupBy(*SERIES).agg(((n >= required) & positive).alias("has_recent"))


def trim_trailing_zeros(obs: DataFrame, drop_all_zero: bool = True) -> DataFrame:
    """Remove what follows the last non-zero value; an all-zero series is dropped or left alone."""
    last = last_nonzero()
    keep = F.col("date") <= (last if drop_all_zero else F.coalesce(last, F.col("date")))
    return obs.filter("value is not null").withColumn("_keep", keep).filter("_keep").drop("_keep")


def gaussian_smooth(dense: DataFrame, half: int = 9, sigma: float = 5.0, min_count: int = 5, by: list[str] | None = None,
                    col: str = "value") -> DataFrame:
    """Centred Gaussian mean over the real values of 2*half+1 days.

    Needs a row for every day that should get a value. The collected frame never holds more than
    2*half+1 numbers; weights are looked up by distance in a literal array.
    """
    frame = series_window(by=by).rangeBetween(-half, half)
    near = F.collect_list(F.when(F.col(col).isNotNull(), F.struct(day().alias("t"), F.col(col).alias("x")))).over(frame)
    weights = F.lit([math.exp(-0.5 * (k / sigma) ** 2) for k in range(half + 1)])
    weight = lambda p: F.get(weights, F.abs(p["t"] - day()))
    total = F.aggregate("_near", F.lit(0.0), lambda a, p: a + weight(p) * p["x"])
    norm = F.aggregate("_near", F.lit(0.0), lambda a, p: a + weight(p))
    return dense.withColumn("_near", near).withColumn(col, F.when(F.size("_near") >= min_count, total / norm)).drop("_near")


def ewma_smooth(dense: DataFrame, tau: int = 5, col: str = "value") -> DataFrame:
    """Ten-tap exponential kernel over offsets -5..+4 days; a missing day counts as zero."""
    taps = {d: math.exp(-(tau + d) / tau) for d in range(-tau, tau)}
    norm = sum(taps.values())
    w = series_window()
    terms = [F.lit(c / norm) * F.coalesce(F.lead(col, d).over(w), F.lit(0.0)) for d, c in taps.items()]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return dense.withColumn(col, out)


def best_lag_xcorr(pairs: DataFrame, by: str = "location_id", lags: range = range(-21, 5)) -> DataFrame:
    """Shift of ``b`` that maximises the mean cross-correlation of the daily changes of a and b.

    ``pairs`` has one row per day with columns a and b. All lags come from one window pass; the
    sums combine map-side.
    """
    w = W.partitionBy(by).orderBy(day())
    d = pairs.select(by, "date", (F.col("a") - F.lag("a").over(w)).alias("da"), (F.col("b") - F.lag("b").over(w)).alias("db"))
    shifted = d.select(by, *[(F.col("da") * F.lag("db", k).over(w)).alias(f"p{i}") for i, k in enumerate(lags)])
    sums = shifted.groupBy(by).agg(
        *[F.sum(f"p{i}").alias(f"s{i}") for i in range(len(lags))], *[F.count(f"p{i}").alias(f"n{i}") for i in range(len(lags))]
    )
    scores = F.array(*[
        F.struct((F.col(f"s{i}") / (2 * F.col(f"n{i}") - 1)).alias("score"), F.lit(-k).alias("minus"))
        for i, k in enumerate(lags)
    ])
    best = F.array_max(F.filter(scores, lambda s: s["score"].isNotNull()))
    return sums.select(by, F.coalesce(-best["minus"], F.lit(0)).alias("shift"), best["score"].alias("score"))


def modified_zscore(
    obs: DataFrame, window: int = 10, min_count: int = 3, ignore_zeros: bool = True, spread: bool = True,
) -> DataFrame:
    """Adds mean, std, n of the previous days and x, the spread value that is compared to them."""
    rows = obs.withColumn("x", F.col("value"))
    if spread:
        rows = spread_after_stall(rows, col="x")
    if ignore_zeros:
        rows = rows.withColumn("x", F.when(F.col("x") != 0, F.col("x")))
    w = days_back(window, -1)
    # Equal values have exactly their mean and no spread; a floating-point sum could miss both.
    low, high = F.min("x").over(w), F.max("x").over(w)
    rows = rows.withColumns({
        "mean": F.when(low == high, low).otherwise(F.avg("x").over(w)),
        "std": F.when(low == high, 0.0).otherwise(F.stddev_pop("x").over(w)), "n": F.count("x").over(w),
    })
    enough = F.col("n") >= min_count
    return rows.withColumns({"mean": F.when(enough, F.col("mean")), "std": F.when(enough, F.col("std"))})


def exceeds(threshold: float | Column) -> Column:
    """|x - mean| / std above a threshold without dividing: std 0 is an outlier when x differs."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return F.coalesce(F.abs(F.col("x") - F.col("mean")) > t * F.col("std"), F.lit(False))


def shift_days(obs: DataFrame, n: int) -> DataFrame:
    """Each value moves n days later; no window is needed."""
    return obs.withColumn("date", F.date_add("date", n))


def diff_days(obs: DataFrame, n: int = 7) -> DataFrame:
    return _keep(obs, F.col("value") - previous_day(n=n))


def second_difference(obs: DataFrame) -> DataFrame:
    """Change of the daily change; needs three consecutive days."""
    return _keep(obs, F.col("value") - 2 * previous_day() + previous_day(n=2))


def keep_last(df: DataFrame, keys: list[str], order: str, first: bool = False) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    # equal orders are told apart by the other columns
    pick = (F.min_by if first else F.max_by)(F.struct(*rest), F.struct(order, *[c for c in rest if c != order]))
    return df.groupBy(*keys).agg(pick.alias("_r")).select(*keys, *[f"_r.{c}" for c in rest])


def most_recent_date(obs: DataFrame) -> DataFrame:
    return obs.groupBy(*SERIES).agg(F.max(F.when(F.col("value").isNotNull(), F.col("date"))).alias("most_recent"))


def ecdf(df: DataFrame, value: str, parts: int | None = None) -> DataFrame:
    """Share of rows at or below each distinct value.

    Distinct values with their counts are dealt into ranges and written with the number of their range. Running counts
    are taken inside each range, and added to the total of the ranges before it; only that small table of totals, one
    row a range, goes through a window without a key.
    """
    parts = parts or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    counts = df.groupBy(value).agg(F.count("*").alias("_n"))
    ranged = materialize(counts.repartitionByRange(parts, value).withColumn("_part", F.spark_partition_id()), "ecdf")
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    totals = ranged.groupBy("_part").agg(F.sum("_n").alias("_size"))
    offsets = totals.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"), F.sum("_size").over(W.partitionBy()).alias("_total"))
    inside = W.partitionBy("_part").orderBy(value).rowsBetween(W.unboundedPreceding, 0)
    return ranged.withColumn("_upto", F.sum("_n").over(inside)).join(offsets, "_part").select(
        value, ((F.col("_offset") + F.col("_upto")) / F.col("_total")).alias("share")
    )
