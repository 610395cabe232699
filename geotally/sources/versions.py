"""A dataset kept as versions: parts under a digest of their content, a list that names them, and one pointer.

Observations and tags have a part per variable, attributes one per name. A new version writes only parts whose digest is
not in the version before, then publishes its list; a run that fails before that leaves the old version as it was, and
what it wrote is named by no version.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from geotally.model import OBS_SCHEMA, STATIC_SCHEMA, TAG_SCHEMA, Dataset
from geotally.sources import pointers

#: Table, the column that names its parts, and its schema.
TABLES = {"obs": ("variable", OBS_SCHEMA), "static": ("attr", STATIC_SCHEMA), "tags": ("variable", TAG_SCHEMA)}


def digests(df: DataFrame, by: list[str], columns: list[str] | None = None, extra: list[Column] = ()) -> DataFrame:
    """``by`` with the number of rows and two sums of row hashes, which do not depend on the order of rows.

    The sums are exact decimals, added up map-side; rows that differ in any of ``columns`` differ in both hashes. ``extra``
    are aggregates to take in the same pass.
    """
    columns = columns or [c for c in df.columns if c not in by]
    total = lambda seed, name: F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(20,0)")).alias(name)
    return df.groupBy(*by).agg(F.count("*").alias("n"), total(1, "low"), total(2, "high"), *extra)


def _parts(ds: Dataset) -> dict[str, dict[str, str]]:
    """Table and part name with the part's digest; a row for each variable or attribute comes to the driver."""
    found = {}
    for table, (key, schema) in TABLES.items():
        df = getattr(ds, table).select(*[c.split()[0] for c in schema.split(", ")])
        found[table] = {r[key]: f"{r['n']}.{r['low']}.{r['high']}" for r in digests(df, [key], df.columns).collect()}
    return found


def save(ds: Dataset, root: str, note: dict | None = None) -> dict[str, list[str]]:
    """Publish ``ds`` as the next version; returns the names of the parts that were written, by table.

    ``ds`` is read for its digests and again for the parts that changed, so it should be written already. Another
    writer that publishes first is a ``Conflict``; nothing of it is lost.
    """
    spark = ds.obs.sparkSession
    number, before = pointers.latest(spark, root)
    wanted, listed, written = _parts(ds), {}, {}
    for table, (key, _) in TABLES.items():
        old = before.get("parts", {}).get(table, {})
        changed = sorted(k for k, digest in wanted[table].items() if old.get(k, {}).get("digest") != digest)
        listed[table] = {k: old[k] for k in wanted[table] if k not in changed}
        if changed:
            folder = f"{root}/{table}/{uuid.uuid4().hex}"
            names = F.broadcast(spark.createDataFrame([(k, f"p{i}") for i, k in enumerate(changed)], f"{key} string, _part string"))
            rows = getattr(ds, table).join(names, key).hint("rebalance", "_part")
            rows.write.partitionBy("_part").parquet(folder)
            listed[table] |= {k: {"digest": wanted[table][k], "path": f"{folder}/_part=p{i}"} for i, k in enumerate(changed)}
        written[table] = changed
    pointers.publish(spark, root, {"parts": listed, "note": note or {}}, number)
    return written


def load(spark: SparkSession, root: str, variables: list[str] | None = None) -> Dataset:
    """The current version, or of its observations and tags only the named variables; other parts are not opened."""
    number, content = pointers.latest(spark, root)
    if not number:
        raise LookupError(f"no version in {root}")
    frames = []
    for table, (key, schema) in TABLES.items():
        parts = content["parts"][table]
        paths = [p["path"] for k, p in sorted(parts.items()) if variables is None or key == "attr" or k in variables]
        frames.append(spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema))
    return Dataset(*frames)
