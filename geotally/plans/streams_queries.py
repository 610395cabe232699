"""Queries that run the streams over the events, written as JSON access records first."""

import datetime

from pyspark.sql import functions as F

from geotally.model import work_dir
from geotally.plans import bindings as B
from geotally.plans.catalog import query
from geotally.plans.rollups_queries import ACT
from geotally.streaming import access_log as S

#: First days of the files in which the records of a month arrive, one file after the other.
DELIVERIES = [datetime.date(2024, 1, 1 + 6 * k) for k in range(5)]


def record_files(spark, d, again=()):
    """Access records as JSON files, in the order of their time; the files at the places ``again`` come twice."""
    path = work_dir(spark, "access-json")
    u = F.col("user_id")
    records = B.table(spark, d, "events").select(
        F.date_format("ts", STAMP).alias("timestamp"), F.concat(F.lit("user"), u, F.lit("@example.org")).alias("email"),
        F.concat(F.lit("/v2/"), "event_type").alias("path"), F.concat(F.lit("10.0.0."), (u % 250).cast("string")).alias("ip"),
        (u % 2 == 0).alias("is_simulator_user"), F.to_date("ts").alias("day"),
    )
    for k, first in enumerate(DELIVERIES):
        after = k == 0 or F.col("day") >= first  # the first and last file take what lies before and after
        before = k == len(DELIVERIES) - 1 or F.col("day") < DELIVERIES[k + 1]
        part = records.filter(F.lit(after) if isinstance(after, bool) else after).filter(F.lit(before) if isinstance(before, bool) else before).drop("day")
        for _ in range(1 + (k in again)):
            part.coalesce(1).write.mode("append").json(path)
    return path


def stream(spark, d, again=()):
    return S.read_records(spark, record_files(spark, d, again), files_per_batch=1)


STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"


@query("stream_access_log_ingest", """
SELECT strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS timestamp, 'user' || user_id || '@example.org' AS email, '/v2/' || event_type AS path, '10.0.0.' || (user_id % 250) AS ip, user_id % 2 = 0 AS flag, CAST(ts AS DATE) AS day FROM events""")
def _(spark, d):
    """One file is delivered twice; its records are written once."""
    out = work_dir(spark, "access-table")
    S.finish(S.ingest(stream(spark, d, again=[1]), out, work_dir(spark, "access-checkpoint"), delay="7 days"))
    return spark.read.parquet(out).select(
        F.date_format("timestamp", STAMP).alias("timestamp"), "email", "path", "ip", F.col("is_simulator_user").alias("flag"), "day")


@query("stream_user_activity", f"WITH {ACT} SELECT * REPLACE (strftime(\"latestDate\", '%Y-%m-%d %H:%M:%S.%f') AS \"latestDate\") FROM act")
def _(spark, d):
    table = S.activity_table(work_dir(spark, "activity"), every=3)
    S.finish(S.write_activity(stream(spark, d), table, work_dir(spark, "activity-checkpoint")))
    return S.activity_summary(table.read(spark)).withColumn("latestDate", F.date_format("latestDate", STAMP))


@query("stream_recent_users", f"WITH {ACT} SELECT email, \"totalRequests\", \"signupDate\", strftime(\"latestDate\", '%Y-%m-%d %H:%M:%S.%f') AS \"latestDate\" FROM act WHERE \"latestDate\" >= DATE '2024-01-30' - 2")
def _(spark, d):
    """A user who is silent for four days loses the state; the rows of ended spells keep the totals whole."""
    table = S.recent_table(work_dir(spark, "recent"), every=3)
    S.finish(S.write_spells(stream(spark, d), table, work_dir(spark, "recent-checkpoint"), silence=datetime.timedelta(days=4)))
    return S.recent_users(table.read(spark), datetime.date(2024, 1, 30)).withColumn("latestDate", F.date_format("latestDate", STAMP))
