"""Registry of queries over the given tables and the SQL that states the expected result."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

_MODULES = [
    "scans", "sinks", "scalars", "filters", "layout", "joins", "rollups", "windows", "quality", "tags",
    "measures", "rt", "qa", "streams", "flows",
]


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            from geotally.plans.bindings import expand

            ORACLE[name] = expand(sql)
        return fn

    return register


for _m in _MODULES:
    importlib.import_module(f"geotally.plans.{_m}_queries")
