"""A stream gives what the batch gives, and a restart adds nothing."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidegate.session import scratch_dir
from tidegate.streaming import jobs
from workload import control, registry

FOLDER = "/root/testdata/sf0.001"

EVENTS = "id int, ts timestamp, kind string"
T0 = dt.datetime(2024, 1, 1)


@pytest.fixture
def feed(spark):
    """A folder that grows by one file per call."""
    path = scratch_dir(spark, "feed")

    def add(*data):
        spark.createDataFrame([(i, T0 + dt.timedelta(minutes=m), k) for i, m, k in data], EVENTS).coalesce(1).write.mode("append").parquet(path)
        return path

    return add


def stream(spark, path):
    return jobs.read_events(spark, "parquet", {"path": path, "maxFilesPerTrigger": "1"}, EVENTS)


def test_hourly_equals_batch_and_restart_adds_nothing(spark, feed):
    path = feed((1, 5, "a"), (2, 50, "b"))
    out, check = scratch_dir(spark, "out"), scratch_dir(spark, "check")

    def run():
        hourly = jobs.hourly_stream(stream(spark, path), "ts", ["kind"], [F.count("*").alias("n")], "1 day")
        jobs.drain(hourly, jobs.upsert_sink(out, ["kind", "hour_label"], "kind", ["n"]), check, mode="update")
        return sorted((r["kind"], r["hour_label"], r["n"]) for r in spark.read.parquet(out).collect())

    assert run() == [("a", T0, 1), ("b", T0, 1)]
    assert run() == [("a", T0, 1), ("b", T0, 1)]
    feed((3, 10, "a"), (4, 70, "a"))
    assert run() == [("a", T0, 2), ("a", T0 + dt.timedelta(hours=1), 1), ("b", T0, 1)]


def test_append_mode_holds_the_open_hour(spark, feed):
    path = feed((1, 5, "a"))
    feed((2, 65, "a"))
    feed((3, 300, "a"))
    out = scratch_dir(spark, "out")
    hourly = jobs.hourly_stream(stream(spark, path), "ts", ["kind"], [F.count("*").alias("n")], "10 minutes")
    jobs.drain(hourly, lambda b, i: jobs._write_batch(b, out, i))
    hours = {r["hour_label"] for r in spark.read.parquet(out).collect()}
    assert T0 + dt.timedelta(hours=5) not in hours and T0 in hours


def test_dead_letter_replay_overwrites(spark, rows):
    batch = rows("body string", ('{"order_id": 1}',), ("{",))
    good, dead = scratch_dir(spark, "good"), scratch_dir(spark, "dead")
    sink = jobs.deadletter_sink("order_id string", "body", good, dead)
    sink(batch, 0)
    sink(batch, 0)
    assert spark.read.parquet(good).count() == 1 and spark.read.parquet(dead).count() == 1


def test_late_rows_go_aside(spark, rows):
    batch = rows("id int, ts timestamp_ntz", (1, T0), (2, T0 + dt.timedelta(hours=3)))
    on_time, late = scratch_dir(spark, "ok"), scratch_dir(spark, "late")
    jobs.late_sink("ts", T0 + dt.timedelta(hours=2), lambda b, i: jobs._write_batch(b, on_time, i), late)(batch, 0)
    assert [r["id"] for r in spark.read.parquet(on_time).collect()] == [2]
    assert [r["id"] for r in spark.read.parquet(late).collect()] == [1]


def test_stream_dedupe(spark, feed):
    path = feed((1, 5, "a"), (1, 5, "a"))
    feed((1, 5, "a"), (2, 6, "a"))
    out = scratch_dir(spark, "out")
    jobs.drain(jobs.dedupe_stream(stream(spark, path), ["id"], "ts"), lambda b, i: jobs._write_batch(b, out, i))
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [1, 2]


def test_closed_hour_of_a_topic(rows):
    options = jobs.closed_hour_options(dt.datetime(2024, 1, 1, 5), dt.datetime(2024, 1, 1, 6))
    assert int(options["endingTimestamp"]) - int(options["startingTimestamp"]) == 3_600_000
    assert options["startingTimestamp"] == "1704085200000"
    raw = rows("value binary, timestamp timestamp_ntz, key binary", (b'{"k": 1}', None, b""), (b"{broken", None, b""))
    assert [r.body for r in jobs.messages(raw).collect()] == ['{"k": 1}', "{broken"]


STREAMS = [("stream_dead_letters", 100, 4, 2), ("stream_dead_letters", 10, 4, 5), ("stream_upsert", 100, 6, 2), ("drops_once", 100, 6, 4)]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")
@pytest.mark.parametrize("name, size, least, triggers", STREAMS)
def test_larger_tables_are_dealt_to_more_files(spark, tmp_path, monkeypatch, name, size, least, triggers):
    monkeypatch.setattr(control, "ROWS_PER_FILE", size, raising=False)
    made, drained, batches = [], [], []
    monkeypatch.setattr(control.Tables, "scratch", lambda self, label: made.append(str(tmp_path / label)) or made[-1])
    plain = jobs.drain

    def drain(df, handle, *args, **kwargs):
        def count(batch, batch_id):
            # Files of the stream that this trigger takes, with their rows; drops are archived before the end.
            files = batch.groupBy(F.input_file_name()).count().collect()
            drained.extend(r["count"] for r in files)
            batches.append(batch_id)
            handle(batch, batch_id)

        return plain(df, count, *args, **kwargs)

    monkeypatch.setattr(jobs, "drain", drain)
    got = registry.QUERIES[name](spark, FOLDER)
    rows = spark.read.parquet(f"{FOLDER}/events.parquet").count()
    assert sum(drained) == rows and len(batches) == triggers
    assert len(drained) > least and max(drained) <= 1.5 * size
    if name != "stream_upsert":
        assert got.count() == rows
