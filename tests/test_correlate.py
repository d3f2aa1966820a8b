"""Session windows and interval joins: a stream gives what the batch gives."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidegate.operators.keys import sustained
from tidegate.session import scratch_dir
from tidegate.sinks import storage
from tidegate.streaming import correlate, jobs

T0 = dt.datetime(2024, 1, 1)


def hour(n, minutes=0):
    return T0 + dt.timedelta(hours=n, minutes=minutes)


@pytest.fixture
def feed(spark):
    """A folder with one more file per call."""

    def make(schema, *files):
        path = scratch_dir(spark, "feed")
        for rows in files:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        return jobs.read_events(spark, "parquet", {"path": path, "maxFilesPerTrigger": "1"}, schema), path

    return make


def test_runs_of_hours(spark, feed):
    flags = "k string, ts timestamp, flag boolean"
    files = (
        [("a", hour(0, 5), True), ("a", hour(1), True), ("a", hour(1, 30), True), ("b", hour(0), True), ("b", hour(2), True)],
        [("a", hour(3), True), ("b", hour(1), False), ("c", hour(9), True), ("b", hour(1), None)],
        [("a", hour(2, 59), True), ("c", hour(10), True), ("c", hour(11), True), (None, hour(1), True)],  # hour 2 of a comes late and joins its runs
        [("z", hour(900), True)],
    )
    stream, path = feed(flags, *files)
    out = scratch_dir(spark, "runs")
    jobs.drain(correlate.sustained_stream(stream, "k", "ts", "flag", 3, "24 hours"), jobs.append_sink(out))
    got = sorted((r.k, r.run_start, r.run_end, r.hours) for r in spark.read.parquet(out).collect())
    assert got == [("a", hour(0), hour(3), 4), ("c", hour(9), hour(11), 3)]
    rows = spark.read.parquet(path).filter("k is not null").withColumn("h", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    assert got == sorted((r.k, r.run_start, r.run_end, r.hours) for r in sustained(rows, "k", "h", "flag", 3).collect())


def test_a_run_waits_for_its_watermark(spark, feed):
    stream, _ = feed("k string, ts timestamp, flag boolean", [("a", hour(n), True) for n in range(3)], [("b", hour(5), True)])
    out = scratch_dir(spark, "runs")
    jobs.drain(correlate.sustained_stream(stream, "k", "ts", "flag", 3, "24 hours"), jobs.append_sink(out))
    assert not storage.any_file(spark, f"{out}/*/*.parquet") or spark.read.parquet(out).count() == 0


def test_pairs_within_an_interval(spark, feed):
    later = ([(1, 7, hour(10)), (2, 7, hour(60)), (3, None, hour(1))], [(4, 8, hour(5)), (5, 7, hour(10))], [(99, -1, hour(2000))])
    earlier = ([(11, 7, hour(10)), (12, 7, hour(9, 59))], [(13, 8, hour(5, 1)), (14, 7, hour(0)), (15, None, hour(1))], [(98, -2, hour(2000))])
    a, a_path = feed("id int, k int, at timestamp", *later)
    b, b_path = feed("fault int, k int, opened timestamp", *earlier)
    out = scratch_dir(spark, "pairs")
    jobs.drain(correlate.preceded_by(a, b, ["k"], "at", "opened", "10 HOURS", "3 days"), jobs.append_sink(out))
    got = sorted(((r.id, r.k, r.fault) for r in spark.read.parquet(out).collect() if r.id < 90), key=str)
    assert got == sorted([(1, 7, 11), (1, 7, 12), (1, 7, 14), (5, 7, 11), (5, 7, 12), (5, 7, 14), (2, 7, None), (3, None, None), (4, 8, None)], key=str)
    batch = correlate.preceded_by(spark.read.parquet(a_path), spark.read.parquet(b_path), ["k"], "at", "opened", "10 HOURS")
    assert got == sorted(((r.id, r.k, r.fault) for r in batch.collect() if r.id < 90), key=str)
