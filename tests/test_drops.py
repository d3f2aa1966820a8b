"""Dropped files are loaded once and leave their folder."""

from tidegate.session import scratch_dir
from tidegate.sinks import storage
from tidegate.streaming import jobs


def names(spark, path):
    files = storage._fs(spark, path)
    found = files[0].globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/part-*"))
    return {s.getPath().getName() for s in (found or [])}


def test_files_are_taken_once_and_archived(spark):
    folder, archive, checkpoint, out = (scratch_dir(spark, x) for x in ("drops", "archive", "check", "out"))
    schema = "k int, v string"

    def drop(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").json(folder)

    def drain():
        jobs.drain(jobs.read_drops(spark, folder, "json", schema, archive, 1), jobs.append_sink(out), checkpoint)
        return sorted((r.k, r.v) for r in spark.read.parquet(out).collect())

    drop((1, "a"))
    first = names(spark, folder)
    assert drain() == [(1, "a")] and drain() == [(1, "a")]
    drop((2, None), (1, "a"))
    drop((3, "c"))
    assert drain() == [(1, "a"), (1, "a"), (2, None), (3, "c")]
    assert spark.read.parquet(out).count() == 4
    assert not first & names(spark, folder) and len(names(spark, folder)) < 3
    assert spark.read.option("recursiveFileLookup", True).json(archive).count() >= 1
