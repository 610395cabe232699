"""Row and region selection. Region predicates are evaluated once on the geo dimension and
reach the three tables as semi or anti joins, so Spark can prune before heavier work."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window as W, functions as F

from geotally.model import POINT, SERIES, TAG, Dataset, duplicate_keys


def rows_key(
    *, level=None, country=None, state=None, states=None, fips=None, on=None, after=None, before=None,
    exclude_unknown=False, exclude_fips_prefix=None, location_id_matches=None,
) -> Column:
    """Conjunction of the predicates that are given."""
    c = F.col
    tests = [
        level is not None and (c("level") == level),
        country is not None and (c("country") == country),
        state is not None and (c("state") == state),
        states is not None and c("state").isin(list(states)),
        fips is not None and (c("fips") == fips),
        on is not None and (c("date") == F.lit(on)),
        after is not None and (c("date") > F.lit(after)),
        before is not None and (c("date") < F.lit(before)),
        exclude_unknown and ~c("fips").endswith("999"),
        exclude_fips_prefix is not None and ~c("fips").startswith(exclude_fips_prefix or ""),
        location_id_matches is not None and c("location_id").rlike(location_id_matches or ""),
    ]
    chosen = [t for t in tests if isinstance(t, Column)]
    return reduce(lambda a, b: a & b, chosen, F.lit(True))


def region_mask(level: str | None = None, states: Iterable[str] | None = None) -> Column:
    return rows_key(level=level, states=states)


def any_mask(masks: list[Column], location_ids: list[str] = ()) -> Column:
    """Union of masks and single regions as one predicate on the geo dimension."""
    parts = list(masks) + ([F.col("location_id").isin(list(location_ids))] if location_ids else [])
    return reduce(lambda a, b: a | b, parts, F.lit(False))


def _apply(ds: Dataset, ids: DataFrame, how: str) -> Dataset:
    ids = ids.select("location_id").distinct()
    return Dataset(*[t.join(ids, "location_id", how) for t in (ds.obs, ds.static, ds.tags)])


def keep_locations(ds: Dataset, ids: DataFrame) -> Dataset:
    return _apply(ds, ids, "left_semi")


def remove_locations(ds: Dataset, ids: DataFrame) -> Dataset:
    return _apply(ds, ids, "left_anti")


def subset_regions(ds: Dataset, geo: DataFrame, predicate: Column) -> Dataset:
    return keep_locations(ds, geo.filter(predicate))


def partition_by_region(ds: Dataset, geo: DataFrame, include: Column, exclude: Column | None = None):
    """(included and not excluded, everything else)."""
    chosen = geo.filter(include & ~exclude if exclude is not None else include)
    return keep_locations(ds, chosen), remove_locations(ds, chosen)


def one_region(ds: Dataset, location_id: str) -> Dataset:
    return Dataset(*[t.filter(F.col("location_id") == location_id) for t in (ds.obs, ds.static, ds.tags)])


def columns_after(df: DataFrame, columns: list[str], after: datetime.date) -> DataFrame:
    return df.filter(F.col("date") > F.lit(after)).select(*columns)


def trim_padded_nulls(wide: DataFrame, columns: list[str], by: str = "location_id") -> DataFrame:
    """Drop leading and trailing rows where all chosen columns are NULL."""
    seen = F.when(F.coalesce(*[F.col(c).cast("string") for c in columns]).isNotNull(), F.col("date"))
    w = W.partitionBy(by)
    return (
        wide.withColumns({"_lo": F.min(seen).over(w), "_hi": F.max(seen).over(w)})
        .filter(F.col("date").between(F.col("_lo"), F.col("_hi"))).drop("_lo", "_hi")
    )


def drop_variables(ds: Dataset, names: list[str]) -> Dataset:
    return Dataset(
        ds.obs.filter(~F.col("variable").isin(names)),
        ds.static.filter(~F.col("attr").isin(names)),
        ds.tags.filter(~F.col("variable").isin(names)),
    )


def drop_na_variables(ds: Dataset) -> Dataset:
    """Drop variables without any real value, and their tags."""
    real = ds.obs.filter("value is not null")
    return Dataset(real, ds.static, ds.tags.join(real.select("variable").distinct(), "variable", "left_semi").select(*TAG))


def drop_stale_series(ds: Dataset, cutoff: datetime.date) -> Dataset:
    """Keep series with a real value on or after the cutoff; tags follow their series."""
    fresh = (
        ds.obs.filter("value is not null").groupBy(*SERIES).agg(F.max("date").alias("last"))
        .filter(F.col("last") >= F.lit(cutoff)).select(*SERIES)
    )
    return Dataset(
        ds.obs.join(fresh, SERIES, "left_semi").select(*POINT, "value"), ds.static,
        ds.tags.join(fresh, SERIES, "left_semi").select(ds.tags.columns),
    )


def drop_future_observations(ds: Dataset, after: datetime.date) -> Dataset:
    """Drop values after a date and tag every series that lost one."""
    from geotally.functions import tagtext as T

    late = (F.col("date") > F.lit(after)) & F.col("value").isNotNull()
    touched = ds.obs.filter(late).select(*SERIES).distinct().select(
        *SERIES, F.lit(T.DROP_FUTURE).alias("tag_type"), T.drop_future_content(F.lit(after)).alias("content")
    )
    return ds.with_obs(ds.obs.filter(F.col("date") <= F.lit(after))).add_tags(touched)


def with_population(ds: Dataset) -> DataFrame:
    return ds.static.filter("attr = 'population' and num is not null").select("location_id").distinct()


def drop_regions_without_population(ds: Dataset) -> Dataset:
    return keep_locations(ds, with_population(ds))


def unexpected_drops(ds: Dataset, known: DataFrame) -> DataFrame:
    """Locations lost for lack of population that are not on the known list."""
    return (
        ds.obs.select("location_id").distinct().join(with_population(ds), "location_id", "left_anti")
        .join(known, "location_id", "left_anti")
    )


def drop_old_dates(df: DataFrame, expected: list[str], first: datetime.date = datetime.date(2020, 1, 1)) -> DataFrame:
    return df.filter(F.col("date") >= F.lit(first)).select(*[c for c in df.columns if c in expected])


@dataclass(frozen=True)
class Report:
    """What one pass over a frame has dropped; filled by the first action that runs the whole frame."""

    observed: Observation
    extra: list[str] = field(default_factory=list)
    missing: list[str] = field(default_factory=list)

    def get(self) -> dict:
        """rows, dropped, and up to three dropped rows as JSON."""
        seen = self.observed.get
        return {"rows": seen["rows"], "dropped": seen["dropped"], "sample": sorted({x for k, x in seen.items() if k.startswith("sample") and x is not None})}


def keep_reported(df: DataFrame, keep: Column, name: str, samples: int = 3) -> tuple[DataFrame, Report]:
    """Rows for which ``keep`` holds, and a report of the others from the same pass.

    The sample is drawn by hash, a bounded aggregate like the counts, so nothing is scanned or shuffled for it.
    """
    gone = ~F.coalesce(keep, F.lit(False))
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    drawn = [F.min_by(F.when(gone, row), F.when(gone, F.xxhash64(F.lit(i), row))).alias(f"sample{i}") for i in range(samples)]
    observed = Observation(f"{name}-{uuid.uuid4().hex}")
    return df.observe(observed, F.count("*").alias("rows"), F.count_if(gone).alias("dropped"), *drawn).filter(~gone), Report(observed)


def drop_old_dates_reported(
    df: DataFrame, expected: list[str], ignored: list[str] = (), first: datetime.date = datetime.date(2020, 1, 1), name: str = "old-dates",
) -> tuple[DataFrame, Report]:
    """Like ``drop_old_dates``, with a report of dropped rows, unexpected columns and expected ones that are absent."""
    kept, report = keep_reported(df, F.col("date") >= F.lit(first), name)
    extra, missing = field_mismatch(df, expected)
    report = Report(report.observed, [c for c in extra if c not in ignored], missing)
    return kept.select(*[c for c in df.columns if c in expected]), report


def with_ids_reported(df: DataFrame, ids: DataFrame, key: str, name: str = "unknown-ids") -> tuple[DataFrame, Report]:
    """Rows joined to the dimension ``ids`` by ``key``, and a report of those that it lacks."""
    found = df.join(ids.withColumn("_known", F.lit(True)), key, "left")
    kept, report = keep_reported(found, F.col("_known"), name)
    return kept.drop("_known"), report


def drop_regions_without_population_reported(ds: Dataset, name: str = "no-population") -> tuple[Dataset, Report]:
    """Like ``drop_regions_without_population``, with a report of the observations dropped."""
    obs, report = with_ids_reported(ds.obs, with_population(ds).select("location_id").distinct(), "location_id", name)
    kept = keep_locations(ds, with_population(ds))
    return kept.with_obs(obs.select(*ds.obs.columns)), report


def field_mismatch(df: DataFrame, expected: list[str]) -> tuple[list[str], list[str]]:
    """(extra, missing) column names."""
    return [c for c in df.columns if c not in expected], [c for c in expected if c not in df.columns]


def filter_start_dates(df: DataFrame, starts: DataFrame, default: datetime.date) -> DataFrame:
    """Keep rows from the start of their location, or from the default start."""
    return (
        df.join(starts.select("location_id", "start"), "location_id", "left")
        .filter(F.col("date") >= F.coalesce("start", F.lit(default))).drop("start")
    )


def known_fips(fips: Column) -> Column:
    return ~fips.endswith("999") & ~fips.startswith("90")


def rows_not_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    return duplicate_keys(df, keys)


def static_per_key(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Distinct attribute rows; fails at run time if a key has two different ones."""
    from geotally.model import assert_unique

    return assert_unique(df.select(key, *columns).distinct(), [key])
