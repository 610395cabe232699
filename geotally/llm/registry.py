"""Queries of the subpackage and the SQL that states their results."""

from __future__ import annotations

import importlib
import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of corpus_pipeline.py over documents."""
    top = str(Path(__file__).resolve().parents[2])
    if top not in sys.path:
        sys.path.insert(0, top)
    return importlib.import_module("corpus_pipeline").run(spark, sf_dir)
