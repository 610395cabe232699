"""The stream of access records: JSON in, typed table, user activity and recent users out."""

from __future__ import annotations

import datetime
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from geotally.streaming.batches import BatchTable

RECORD = "timestamp string, email string, path string, ip string, is_simulator_user boolean"


def read_records(spark: SparkSession, path: str, files_per_batch: int = 64) -> DataFrame:
    """Typed stream of JSON records in a folder; files arriving later are later batches."""
    raw = spark.readStream.schema(RECORD).option("maxFilesPerTrigger", files_per_batch).json(path)
    return raw.withColumn("timestamp", F.to_timestamp("timestamp"))


def ingest(records: DataFrame, out: str, checkpoint: str, delay: str = "2 days") -> StreamingQuery:
    """Append the records to a table partitioned by day, each once, however often it is delivered.

    A record that comes again within ``delay`` of event time is dropped by its whole content; state older than
    that expires. A record later than ``delay`` behind the newest one cannot be told from a repeated one: it is
    dropped and counted (``dropped_records``). The file sink commits each batch once.
    """
    once = records.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(records.columns)
    typed = once.withColumn("day", F.to_date("timestamp"))
    return (
        typed.writeStream.format("parquet").partitionBy("day").option("path", out).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )


def dropped_records(spark: SparkSession, query: StreamingQuery) -> dict[str, int]:
    """Records that a finished run of ``ingest`` has dropped: ``late`` and ``repeated``.

    Spark keeps the progress of the last batches only; a run that may have had more is an error, not a smaller count.
    """
    progress = query.recentProgress
    if len(progress) >= int(spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")):
        raise RuntimeError("progress of earlier batches is gone; raise spark.sql.streaming.numRecentProgressUpdates")
    states = [s for p in progress for s in p["stateOperators"]]
    return {
        "late": sum(s["numRowsDroppedByWatermark"] for s in states),
        "repeated": sum(s["customMetrics"].get("numDroppedDuplicateRows", 0) for s in states),
    }


# User activity -----------------------------------------------------------------------------------

#: Days whose bits share a row: as many as a long has.
BLOCK = 64
ACTIVITY = "email string, block int, days bigint, n bigint, last timestamp"


def _bits(day: Column) -> Column:
    return F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(day, F.lit(BLOCK))))


def daily_bits(records: DataFrame) -> DataFrame:
    """Per email and block of days: a bit for each active day, requests and the last one, combined map-side."""
    day = F.unix_date(F.to_date("timestamp"))
    block = F.floor(day / BLOCK).cast("int")
    return records.groupBy("email", block.alias("block")).agg(_bits(day).alias("days"), F.count("*").alias("n"), F.max("timestamp").alias("last"))


def merge_bits(parts: DataFrame) -> DataFrame:
    """One row per email and block; batches overlap in any way, as bits of a day are merged and not counted."""
    return parts.groupBy("email", "block").agg(
        F.bit_or("days").alias("days"), F.sum("n").alias("n"), F.max("last").alias("last"), F.max("batch").alias("batch"))


def activity_table(root: str, every: int = 16) -> BatchTable:
    return BatchTable(root, ACTIVITY, merge_bits, every)


def write_activity(records: DataFrame, table: BatchTable, checkpoint: str) -> StreamingQuery:
    """Write each batch's day bits into the table.

    No state is kept between batches and late records just set bits, so results are exact without a watermark.
    """
    def save(batch: DataFrame, number: int) -> None:
        table.save(daily_bits(batch), number)

    return (
        records.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def activity_summary(parts: DataFrame) -> DataFrame:
    """Per email first date, last request, distinct active days and requests over all batches."""
    blocks = merge_bits(parts)
    lowest = F.expr("length(regexp_extract(reverse(bin(days)), '^0*', 0))")
    return blocks.groupBy("email").agg(
        F.min(F.date_from_unix_date((F.col("block") * BLOCK + lowest).cast("int"))).alias("signupDate"), F.max("last").alias("latestDate"),
        F.coalesce(F.sum(F.bit_count("days")), F.lit(0)).cast("bigint").alias("daysActive"), F.sum("n").alias("totalRequests"),
    )


# Recent users ------------------------------------------------------------------------------------

SPELL = "email string, spell bigint, since bigint, n bigint, last bigint, open boolean"


class Spell(StatefulProcessor):
    """The requests of a user between two long silences; a timer ends it and clears the user's state.

    State and timers exist for users seen within ``silence`` of the watermark only. Times are microseconds.
    """

    def __init__(self, silence: datetime.timedelta):
        self.silence = int(silence.total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.user = handle.getValueState("user", "spell bigint, since bigint, n bigint, last bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        spell, since, n, last = self.user.get() or (None, None, 0, None)
        for row in rows:
            since = row["since"] if since is None else min(since, row["since"])
            last = row["until"] if last is None else max(last, row["until"])
            n += row["n"]
        spell = since if spell is None else spell  # names the spell, even if a late record moves its start
        self.user.update((spell, since, n, last))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(last // 1000 + self.silence)
        yield Row(email=key[0], spell=spell, since=since, n=n, last=last, open=True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.user.exists():
            spell, since, n, last = self.user.get()
            yield Row(email=key[0], spell=spell, since=since, n=n, last=last, open=False)
            self.user.clear()

    def close(self) -> None:
        pass


def _partial(records: DataFrame) -> DataFrame:
    """Requests, first and last time per email, added up within each Arrow batch, so that a busy user moves few rows."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = pa.Table.from_batches([batch]).group_by("email").aggregate([([], "count_all"), ("at", "min"), ("at", "max")])
            yield from sums.select(["email", "count_all", "at_min", "at_max"]).rename_columns(["email", "n", "since", "until"]).combine_chunks().to_batches()

    rows = records.filter("timestamp is not null").select("email", F.unix_micros("timestamp").alias("at"))
    return rows.mapInArrow(add, "email string, n bigint, since bigint, until bigint")


@contextmanager
def _state_in_rocksdb(spark: SparkSession):
    """A query started inside keeps its state in RocksDB, which timers need; other queries keep their setting."""
    key, value = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def newest_spells(parts: DataFrame) -> DataFrame:
    """The newest row of every spell; of one batch, the row that ends it."""
    rest = ["since", "n", "last", "open", "batch"]
    newest = F.max_by(F.struct(*rest), F.struct("batch", (~F.col("open")).alias("ended"), "n"))
    return parts.groupBy("email", "spell").agg(newest.alias("r")).select("email", "spell", *[f"r.{c}" for c in rest])


def recent_table(root: str, every: int = 16) -> BatchTable:
    return BatchTable(root, SPELL, newest_spells, every)


def write_spells(records: DataFrame, table: BatchTable, checkpoint: str, delay: str = "1 day", silence: datetime.timedelta = datetime.timedelta(days=7)) -> StreamingQuery:
    """Write, per batch, the spells that it has changed or ended.

    Records later than ``delay`` behind the newest one are dropped, as their spell may have ended.
    """
    timed = _partial(records).withColumn("at", F.timestamp_micros("until")).withWatermark("at", delay)
    spells = timed.groupBy("email").transformWithState(Spell(silence), SPELL, outputMode="Update", timeMode="EventTime")

    def save(batch: DataFrame, number: int) -> None:
        table.save(batch, number)

    with _state_in_rocksdb(records.sparkSession):
        return (
            spells.writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )


def recent_users(parts: DataFrame, as_of: datetime.date, days: int = 2) -> DataFrame:
    """Users of the last days with all their requests: those of the spell that is open and of earlier ones."""
    users = newest_spells(parts).groupBy("email").agg(
        F.sum("n").alias("totalRequests"), F.to_date(F.timestamp_micros(F.min("since"))).alias("signupDate"), F.timestamp_micros(F.max("last")).alias("latestDate"))
    return users.filter(F.col("latestDate") >= F.lit(as_of - datetime.timedelta(days=days)))


def finish(query: StreamingQuery) -> None:
    """Wait for a query that ends by itself, and pass on its failure."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
