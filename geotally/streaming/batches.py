"""A table fed by a stream, a folder per batch, whose folders are merged and swapped behind a pointer."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from geotally.sources import pointers


@dataclass(frozen=True)
class BatchTable:
    """``merge`` combines the rows of many batches into fewer with the same meaning; it may run again on its result.

    Every ``every`` batches, all folders become one. The pointer names it and the last batch inside it, so a batch that
    runs again after a failure either overwrites its own folder or is already in the merged one. Readers that
    hold the version before keep its folders until the next merge.
    """

    root: str
    schema: str
    merge: Callable[[DataFrame], DataFrame]
    every: int = 16

    def save(self, rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        version, state = pointers.latest(spark, self.root)
        if number <= state.get("upto", -1):
            return
        rows.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(self._folder(number))
        if number - state.get("upto", -1) >= self.every:
            self._compact(spark, version, state, number)

    def _folder(self, number: int) -> str:
        return f"{self.root}/batches/{number:012d}"

    def _paths(self, spark: SparkSession, state: dict, upto: int | None = None) -> list[str]:
        first = state.get("upto", -1) + 1
        last, loose = first, []
        while (upto is None or last <= upto) and pointers.exists(spark, f"{self._folder(last)}/_SUCCESS"):
            loose.append(self._folder(last))
            last += 1
        return [*([state["merged"]] if "merged" in state else []), *loose]

    def read(self, spark: SparkSession) -> DataFrame:
        """All rows that are written, of the merged folder and of the batches after it."""
        paths = self._paths(spark, pointers.latest(spark, self.root)[1])
        schema = f"{self.schema}, batch int"
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def files(self, spark: SparkSession) -> int:
        return len(self.read(spark).inputFiles())

    def _compact(self, spark: SparkSession, version: int, state: dict, upto: int) -> None:
        paths = self._paths(spark, state, upto)
        merged = f"{self.root}/merged/{uuid.uuid4().hex}"
        self.merge(spark.read.schema(f"{self.schema}, batch int").parquet(*paths)).hint("rebalance").write.parquet(merged)
        pointers.publish(spark, self.root, {"merged": merged, "upto": upto, "replaced": paths}, version)
        for old in state.get("replaced", []):  # of the version before the one just replaced
            pointers.remove(spark, old)
