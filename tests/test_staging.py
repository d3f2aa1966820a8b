"""Batches are computed once, judged by what their write observed, and merged null-safe."""

import datetime as dt
import pathlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.operators.quality import CheckFailed, Gate
from tidegate.plans import publish
from tidegate.session import scratch_dir
from tidegate.sinks import staging, storage, tables

T0 = dt.datetime(2024, 1, 31, 23)
MONTH = T.StructField(publish.MONTH, T.StringType())


@pytest.fixture
def path(spark):
    return scratch_dir(spark, "staging-test")


@pytest.fixture
def counted(spark):
    """A frame whose rows are counted each time a task computes them."""

    def make(df):
        seen = spark.sparkContext.accumulator(0)

        def work(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        return df.mapInArrow(work, df.schema), seen

    return make


def test_one_scan_for_gate_watermark_and_merge(spark, rows, path, counted):
    shape = "sys_id int, sys_updated_on timestamp_ntz, opened_at timestamp_ntz, resolved_at timestamp_ntz, affected_poi_id int, premises_count string"
    source, seen = counted(rows(shape, (1, T0, T0, None, 1, "10"), (2, T0 + dt.timedelta(hours=1), None, None, 1, None)))
    poi = rows("poi_id int, poi_name string, state_territory string, technology_type string", (1, "one", "s", "t"))
    assert publish.outage_poll(source, poi, path, None, least=1) == T0 + dt.timedelta(hours=1)
    assert seen.value == 2


def test_checks_of_every_kind(spark, rows, counted):
    df, seen = counted(rows("k int, v double", (1, 1.0), (2, -1.0), (2, None)))
    gate = lambda d: Gate(d, "t").min_rows(3).value("v", F.col("v") >= 0).unique(["k"], severity="warn")
    with staging.checked_batch(df, gate, top=F.max("v")) as (staged, values):
        assert values["top"] == 1.0 and staged.count() == 3 and seen.value == 3
        where = staged.inputFiles()[0].rsplit("/", 1)[0]
    assert not storage.exists(spark, where)
    one = staging.write_observed(df, scratch_dir(spark, "w"), {"_c0": F.count("*"), "_c1": F.count(F.when(F.col("v") < 0, 1))})
    want = Gate(df, "t").min_rows(3).value("v", F.col("v") >= 0).report().collect()
    assert Gate(df, "t").min_rows(3).value("v", F.col("v") >= 0).report(observed=one).collect() == want


def test_nothing_is_published_when_a_gate_fails(spark, rows, path):
    df = rows("credit decimal(18,4), debit decimal(18,4)", (10, 9))
    gate = lambda d: Gate(d, "j").balance("credit", "debit")
    with pytest.raises(CheckFailed, match="balance"):
        staging.refresh_checked(df, path, gate)
    assert not storage.exists(spark, path)
    staging.refresh_checked(df.withColumn("debit", F.col("credit")), path, gate)
    with pytest.raises(CheckFailed):
        staging.refresh_checked(df, path, gate)
    assert spark.read.parquet(path).first().debit == 10


def test_an_empty_source(spark, rows, path):
    none = rows("k int, v double", (1, 1.0)).filter("k > 5")
    with staging.checked_batch(none, lambda d: Gate(d, "t").min_rows(0), top=F.max("v")) as (staged, values):
        assert staged.count() == 0 and values["top"] is None
    with pytest.raises(CheckFailed, match="min_rows"), staging.checked_batch(spark.createDataFrame([], "k int"), lambda d: Gate(d, "t").min_rows(1)):
        pass
    arrivals = staging.Arrivals(none, "samples")
    arrivals.df.write.parquet(path)
    with pytest.raises(CheckFailed, match="samples.min_rows: 0"):
        arrivals.enforce()


def read(spark, path):
    return sorted(((r.k, r.p, r.n) for r in tables.read_partitioned(spark, path, T.StructField("p", T.StringType())).collect()), key=str)


def test_rows_without_a_partition_value_move_when_it_appears(spark, rows, path):
    shape = "k int, p string, n int"
    for _ in range(3):
        tables.merge_into(rows(shape, (1, None, 1), (2, "a", 1), (3, None, 1)), path, ["k"], "p", ["n"])
        assert read(spark, path) == [(1, None, 1), (2, "a", 1), (3, None, 1)]
    for _ in range(2):
        tables.merge_into(rows(shape, (1, "b", 2), (2, None, 2)), path, ["k"], "p", ["n"])
        assert read(spark, path) == [(1, "b", 2), (2, None, 2), (3, None, 1)]
    assert not storage.exists(spark, f"{path}/p=a")


def test_null_safe_keys(spark, rows, path):
    shape = "k int, p string, n int"
    for n in (1, 2, 3):
        tables.merge_into(rows(shape, (1, None, n), (1, "a", n), (2, None, n)), path, ["k", "p"], "p", ["n"], null_safe=["p"])
    assert read(spark, path) == [(1, "a", 3), (1, None, 3), (2, None, 3)]
    tables.merge_into(rows(shape, (1, None, 0), (4, None, 0)), path, ["k", "p"], "p", ["n"], newest_wins=True, null_safe=["p"])
    assert read(spark, path) == [(1, "a", 3), (1, None, 3), (2, None, 3), (4, None, 0)]


def test_alerts_without_an_hour(spark, rows, path):
    shape = "node_id int, node_type string, poi_id string, state_territory string, is_up boolean, interface_errors double, cpu_pct double, mem_pct double, sample_ts timestamp_ntz"
    samples = rows(shape, (1, "x", "P", "S", False, 900.0, 99.0, 99.0, None), (1, "x", "P", "S", False, 900.0, 99.0, 99.0, T0))
    for _ in range(3):
        publish.node_alerts(samples, path)
    got = tables.read_partitioned(spark, path, MONTH).select("node_id", publish.MONTH).collect()
    assert sorted(map(tuple, got), key=str) == [(1, "2024-01"), (1, None)]
    with pytest.raises(CheckFailed, match="node_samples"):
        publish.node_alerts(samples.filter("node_id > 9"), path)


def files(path):
    return sorted(str(f) for f in pathlib.Path(path).rglob("*.parquet"))


def test_a_batch_merged_before_rewrites_nothing(spark, rows, path):
    shape = "k int, p string, n int, m int"
    first = rows(shape, (1, None, 1, None), (2, "a", 1, None), (3, "b", 1, 5))
    tables.merge_into(first, path, ["k"], "p", ["n"])
    before = files(path)
    tables.merge_into(first, path, ["k"], "p", ["n"])
    assert files(path) == before
    # One value moves to another column, one row to another partition: b stays as it is.
    tables.merge_into(rows(shape, (1, "a", 1, None), (2, "a", None, 1), (3, "b", 1, 5)), path, ["k"], "p", ["n"])
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("k", "p", "n", "m").collect())
    assert got == [(1, "a", 1, None), (2, "a", None, 1), (3, "b", 1, 5)]
    assert [f for f in files(path) if "p=b" in f] == [f for f in before if "p=b" in f]
    assert not storage.exists(spark, f"{path}/p=__HIVE_DEFAULT_PARTITION__")


def test_a_stamped_batch_moves_rows(spark, rows, path):
    shape = "k int, p string, n int"
    tables.merge_into(rows(shape, (1, None, 1), (2, "a", 1), (3, "c", 1), (None, "c", 1)), path, ["k"], "p", ["n"], staged=True, stamped=True)
    for _ in range(2):
        tables.merge_into(rows(shape, (1, "b", 2), (1, "b", 1), (2, None, 2)), path, ["k"], "p", ["n"], staged=True, stamped=True)
        assert read(spark, path) == sorted([(1, "b", 2), (2, None, 2), (3, "c", 1), (None, "c", 1)], key=str)
    assert not storage.exists(spark, f"{path}/p=a")
