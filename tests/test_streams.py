"""Streams over hand-made access records: what is delivered again, late, silent or in many batches."""
import datetime
import json

import pytest
from pyspark.sql import functions as F

from geotally.sources import pointers
from geotally.streaming import access_log as S


def deliver(folder, name, *requests):
    """requests: (email, day of January, hour)."""
    folder.mkdir(exist_ok=True)
    lines = [{"timestamp": f"2024-01-{d:02d} {h:02d}:00:00", "email": e, "path": "/", "ip": "1", "is_simulator_user": False} for e, d, h in requests]
    (folder / f"{name}.json").write_text("".join(json.dumps(x) + "\n" for x in lines))


def run(spark, folder, start):
    S.finish(query := start(S.read_records(spark, str(folder), files_per_batch=1)))
    return query


def test_ingest_writes_a_record_once(spark, tmp_path):
    folder, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    go = lambda records: S.ingest(records, out, checkpoint, "2 days")
    deliver(folder, "a", ("x", 5, 1), ("y", 5, 2))
    run(spark, folder, go)
    before = sorted(map(str, spark.read.parquet(out).collect()))
    deliver(folder, "b", ("x", 5, 1), ("y", 5, 2))
    seen = S.dropped_records(spark, run(spark, folder, go))
    assert sorted(map(str, spark.read.parquet(out).collect())) == before and seen["repeated"] == 2
    deliver(folder, "c", ("x", 20, 1))
    run(spark, folder, go)
    deliver(folder, "d", ("z", 6, 1), ("z", 19, 1))  # the first is two weeks behind
    seen = S.dropped_records(spark, run(spark, folder, go))
    assert seen["late"] == 1 and {(r["email"], r["day"].day) for r in spark.read.parquet(out).collect()} == {("x", 5), ("y", 5), ("x", 20), ("z", 19)}


def test_activity_of_many_batches_in_few_files(spark, tmp_path):
    folder, requests = tmp_path / "in", []
    table = S.activity_table(str(tmp_path / "table"), every=3)
    most = 0
    for k in range(7):
        part = [("x", 1 + k % 4, k), ("y", 1, 0), ("x", 1 + k % 4, k)]
        requests += part
        deliver(folder, f"f{k}", *part)
        run(spark, folder, lambda records: S.write_activity(records, table, str(tmp_path / "cp")))
        most = max(most, len(table._paths(spark, pointers.latest(spark, table.root)[1])))
    rows = {r["email"]: r for r in S.activity_summary(table.read(spark)).collect()}
    for e in "xy":
        mine = [(d, h) for who, d, h in requests if who == e]
        assert (rows[e]["daysActive"], rows[e]["totalRequests"], rows[e]["signupDate"].day) == (len({d for d, _ in mine}), len(mine), min(mine)[0])
        assert rows[e]["latestDate"] == datetime.datetime(2024, 1, max(mine)[0], max(mine)[1])
    assert most <= 3 and pointers.latest(spark, table.root)[0] == 2


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    table = S.activity_table(str(tmp_path / "t"), every=2)
    batch = S.daily_bits(spark.createDataFrame([("x", datetime.datetime(1969, 12, 31, 5)), ("x", datetime.datetime(2024, 3, 5)), (None, datetime.datetime(2024, 3, 4))], "email string, timestamp timestamp"))
    for number in (0, 0, 1, 1, 0):
        table.save(batch, number)
    got = {r["email"]: (r["daysActive"], r["totalRequests"], r["signupDate"]) for r in S.activity_summary(table.read(spark)).collect()}
    assert got == {"x": (2, 4, datetime.date(1969, 12, 31)), None: (1, 2, datetime.date(2024, 3, 4))}


def test_silent_users_have_no_state(spark, tmp_path):
    folder, checkpoint = tmp_path / "in", str(tmp_path / "cp")
    table = S.recent_table(str(tmp_path / "t"), every=3)
    go = lambda records: S.write_spells(records, table, checkpoint, "1 day", datetime.timedelta(days=3))
    for name, requests in {
        "a": [("gone", 1, 1), ("back", 1, 1), ("busy", 1, 1)], "b": [("busy", 4, 1), ("busy", 4, 1)], "c": [("busy", 9, 1)], "d": [("back", 12, 1), ("back", 12, 3), ("busy", 13, 0)],
    }.items():
        deliver(folder, name, *requests)
        run(spark, folder, go)
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "user").load()
    assert {r["email"] for r in state.select("key.email").collect()} == {"back", "busy"}
    users = {r["email"]: (r["totalRequests"], r["signupDate"].day, r["latestDate"].day) for r in S.recent_users(table.read(spark), datetime.date(2024, 1, 13)).collect()}
    assert users == {"back": (3, 1, 12), "busy": (5, 1, 13)}
    everyone = S.recent_users(table.read(spark), datetime.date(2024, 1, 13), days=30)
    assert {(r["email"], r["totalRequests"]) for r in everyone.collect()} == {("back", 3), ("busy", 5), ("gone", 1)}


def test_requests_are_added_up_before_the_shuffle(spark):
    records = spark.createDataFrame([("hot", datetime.datetime(2024, 1, 1, h % 24)) for h in range(900)], "email string, timestamp timestamp").coalesce(1)
    assert [tuple(r)[:2] for r in S._partial(records).collect()] == [("hot", 900)]


def test_pointers(spark, tmp_path):
    root = str(tmp_path)
    assert pointers.latest(spark, root) == (0, {})
    assert pointers.publish(spark, root, {"a": 1}, 0) == 1 and pointers.publish(spark, root, {"a": "é"}, 1) == 2
    with pytest.raises(pointers.Conflict):
        pointers.publish(spark, root, {"a": 3}, 1)
    assert pointers.latest(spark, root) == (2, {"a": "é"})
    assert len(list((tmp_path / "pointers").glob("*.json"))) == 2
