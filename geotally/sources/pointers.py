"""Numbered pointers to the folders that make up the current version of a table.

A pointer is a small file that appears under its number whole or not at all, by a rename that fails if the number is
taken. Readers follow the highest number, so folders can be written beside those in use and be
swapped in at once; a write that fails leaves the version before it readable.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class Conflict(RuntimeError):
    """Another writer has published the same number."""


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def latest(spark: SparkSession, root: str) -> tuple[int, dict]:
    """Number and content of the newest pointer; 0 and nothing where there is none."""
    fs, folder = _files(spark, f"{root}/pointers")
    if not fs.exists(folder):
        return 0, {}
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    numbers = sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))
    if not numbers:
        return 0, {}
    stream = fs.open(_files(spark, f"{root}/pointers/{numbers[-1]:012d}.json")[1])
    try:
        return numbers[-1], json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def publish(spark: SparkSession, root: str, content: dict, after: int) -> int:
    """Make ``content`` the version after number ``after``; ``Conflict`` if there is one already."""
    fs, folder = _files(spark, f"{root}/pointers")
    fs.mkdirs(folder)
    draft = _files(spark, f"{root}/pointers/.draft-{uuid.uuid4().hex}")[1]
    stream = fs.create(draft, True)
    stream.write(bytearray(json.dumps(content).encode()))
    stream.close()
    sc = spark.sparkContext
    context = sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), sc._jsc.hadoopConfiguration())
    none = sc._gateway.new_array(getattr(sc._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(draft, _files(spark, f"{root}/pointers/{after + 1:012d}.json")[1], none)
    except Exception as error:
        fs.delete(draft, False)
        if "FileAlreadyExists" in str(error):
            raise Conflict(f"version {after + 1} of {root} was published by another writer") from None
        raise
    return after + 1


def remove(spark: SparkSession, path: str) -> None:
    fs, place = _files(spark, path)
    fs.delete(place, True)


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _files(spark, path)
    return fs.exists(place)
