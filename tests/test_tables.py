"""Upserts, replacements, gates and watermarks: reruns change nothing."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidegate.operators import incremental as inc
from tidegate.operators import merge
from tidegate.operators.quality import CheckFailed, Gate, enforce
from tidegate.plans import network, replication
from tidegate.session import SHUFFLE_TARGET_BYTES, fit_shuffles, scratch_dir, shared_dir
from tidegate.sinks import control, exports, storage, tables
from tidegate.sources.files import EmptyInput

T0 = dt.datetime(2024, 1, 1)


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def path(spark):
    return scratch_dir(spark, "test")


def test_upsert(rows):
    schema = "k int, v string, n int"
    target = rows(schema, (1, "a", 1), (2, "b", 1), (None, "t", 1))
    source = rows(schema, (2, "old", 1), (2, "new", 2), (3, "c", 1), (None, "s", 1))
    once = merge.upsert(target, source, ["k"], order_by=["n"])
    want = [(1, "a", 1), (2, "new", 2), (3, "c", 1), (None, "s", 1), (None, "t", 1)]
    assert content(once) == sorted(want, key=str)
    keyed = source.filter("k is not null")
    assert content(merge.upsert(merge.upsert(target, keyed, ["k"], ["n"]), keyed, ["k"], ["n"])) == content(merge.upsert(target, keyed, ["k"], ["n"]))
    assert content(merge.upsert(target, source.limit(0), ["k"], ["n"])) == content(target)


def test_upsert_some_columns(rows):
    target = rows("k int, a string, b string", (1, "a1", "b1"), (2, "a2", "b2"))
    source = rows("k int, a string, b string", (2, None, "new"), (3, "a3", "b3"))
    got = merge.upsert(target, source, ["k"], order_by=["b"], update_cols=["a"])
    assert content(got) == [(1, "a1", "b1"), (2, None, "b2"), (3, "a3", "b3")]


def test_replace_range_and_date(rows):
    t = rows("id int, ts timestamp_ntz", (1, T0), (2, T0 + dt.timedelta(hours=1)), (3, None))
    b = rows("id int, ts timestamp_ntz", (9, T0))
    once = merge.replace_range(t, b, "ts", T0, T0 + dt.timedelta(hours=1))
    assert [r[0] for r in content(once)] == [2, 3, 9]
    assert content(merge.replace_range(once, b, "ts", T0, T0 + dt.timedelta(hours=1))) == content(once)
    d = rows("id int, d date", (1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2)))
    assert [r[0] for r in content(merge.replace_date(d, d.limit(0), "d", "2024-01-01"))] == [2]


def test_soft_delete_retention_tail(rows):
    t = rows("k int, s string", (1, "Active"), (2, "Active"))
    gone = rows("k int", (2,), (2,), (5,))
    assert content(merge.soft_delete(t, gone, "k", {"s": "Decommissioned"})) == [(1, "Active"), (2, "Decommissioned")]
    d = rows("d date", (dt.date(2021, 1, 31),), (dt.date(2021, 1, 30),))
    assert content(merge.apply_retention(d, "d", "2024-01-31")) == [(dt.date(2021, 1, 31),)]
    facts = rows("d date, v int", (dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 9), 2), (dt.date(2024, 1, 9), 3))
    mart = rows("d date, total long", (dt.date(2024, 1, 1), 77), (dt.date(2024, 1, 9), 2))
    out = merge.recompute_tail(mart, facts, "d", "2024-01-10", lambda f: f.groupBy("d").agg(F.sum("v").alias("total")))
    assert content(out) == [(dt.date(2024, 1, 1), 77), (dt.date(2024, 1, 9), 5)]


def test_replace_partition_paths(spark, rows, path):
    schema = "id int, d date"
    df = rows(schema, (1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2)))
    tables.overwrite_partitions(df, path, ["d"])
    one = rows(schema, (5, dt.date(2024, 1, 1)), (6, dt.date(2024, 1, 3)))
    for _ in range(2):
        tables.replace_partition(one, path, "d", "2024-01-01")
        assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [2, 5]
    tables.replace_partition(df.limit(0), path, "d", "2024-01-01")
    assert [r["id"] for r in spark.read.parquet(path).collect()] == [2]


def test_replace_hour_paths(spark, rows, path):
    df = rows("id int, ts timestamp_ntz", *[(n, T0 + dt.timedelta(hours=n)) for n in range(4)])
    tables.replace_hour(df, path, "ts", "2024-01-01 00:00:00", "2024-01-01 04:00:00")
    again = rows("id int, ts timestamp_ntz", (9, T0 + dt.timedelta(hours=1)))
    for _ in range(2):
        tables.replace_hour(again, path, "ts", "2024-01-01 01:00:00", "2024-01-01 03:00:00")
        assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [0, 3, 9]


def test_merge_into_moves_rows_and_clears_empty_partitions(spark, rows, path):
    schema = "k int, part string, n int"
    tables.merge_into(rows(schema, (1, "a", 1), (2, "b", 1), (3, "b", 1)), path, ["k"], "part", ["n"])
    batch = rows(schema, (1, "b", 1), (1, "b", 2), (4, "c", 1))
    for _ in range(2):
        tables.merge_into(batch, path, ["k"], "part", ["n"])
        got = sorted((r["k"], r["part"], r["n"]) for r in spark.read.parquet(path).collect())
        assert got == [(1, "b", 2), (2, "b", 1), (3, "b", 1), (4, "c", 1)]
    assert not storage.exists(spark, path + "/part=a")
    tables.merge_into(rows(schema, (1, "b", 0), (2, "b", 9)), path, ["k"], "part", ["n"], newest_wins=True)
    assert sorted((r["k"], r["n"]) for r in spark.read.parquet(path).collect()) == [(1, 2), (2, 9), (3, 1), (4, 1)]


def test_full_refresh_reads_its_own_table(spark, rows, path):
    tables.full_refresh(rows("v int", (1,), (2,)), path)
    tables.full_refresh(spark.read.parquet(path).withColumn("v", F.col("v") + 10), path)
    assert content(spark.read.parquet(path)) == [(11,), (12,)]


def test_paths_and_exports(spark, rows, path):
    assert tables.partition_path("s3a://lake/", "network", "links", "2024-01-01") == "s3a://lake/network/links/run_date=2024-01-01/"
    df = rows("a int, b string", (1, "x"), (2, None))
    exports.unload_csv_gz(df, path + "/gz", single=True)
    assert storage.newest_file(spark, path + "/gz/*.csv.gz") is not None
    assert content(spark.read.option("header", True).csv(path + "/gz")) == [("1", "x"), ("2", None)]
    out = exports.write_submission(df, path + "/sub", "2024-12-30")
    assert "/2025-W01/" in out and spark.read.schema("a int, b string").json(out).count() == 2
    assert content(exports.as_string_items(df)) == [("1", "x"), ("2", "")]
    row = control.audit_row(spark, "p", "r", "t", "2024-01-01").first()
    assert (row["dag_id"], row["run_date"]) == ("p", dt.date(2024, 1, 1)) and row["loaded_at"] is not None


def test_write_keyed_calls_the_writer_in_batches(spark, rows, tmp_path):
    target = str(tmp_path)

    def writer(chunk):
        import os
        import uuid

        assert len(chunk) <= 3
        with open(os.path.join(target, uuid.uuid4().hex), "w") as f:
            f.writelines(f"{key}\n" for key, _ in chunk)

    exports.write_keyed(rows("k int", *[(n,) for n in range(20)]), writer, "k", batch=3)
    keys = sorted(int(x) for f in tmp_path.iterdir() for x in f.read_text().split())
    assert keys == list(range(20))


def test_gate_levels(rows):
    df = rows("k int, v double, ok int, errors string", (1, 1.0, 1, None), (2, -1.0, 0, None), (2, None, 1, None), (None, 5.0, None, "boom"))
    dim = rows("k int", (1,))
    report = (
        Gate(df, "t").min_rows(4).min_rows(5).not_null("k").value("v", F.col("v") >= 0).rate("ok").no_errors()
        .match_rate("v", F.col("v").isNotNull(), 0.7).tolerance("sum", F.sum("v"), 5, 0.5).threshold("neg", F.col("v") < 0, 1)
        .unique(["k"]).foreign_key("k", dim).report()
    )
    got = [(r["check"], r["observed"], r["passed"], r["severity"]) for r in report.collect()]
    assert got == [
        ("t.min_rows", 4.0, True, "fail"), ("t.min_rows", 4.0, False, "fail"), ("t.not_null.k", 1.0, False, "fail"), ("t.value.v", 1.0, False, "warn"),
        ("t.rate.ok", 0.6667, True, "warn"), ("t.no_errors", 1.0, False, "fail"), ("t.match_rate.v", 0.75, True, "warn"), ("t.tolerance.sum", 0.0, True, "warn"),
        ("t.neg", 1.0, True, "warn"), ("t.unique.k", 1.0, False, "fail"), ("t.foreign_key.k", 2.0, False, "warn"),
    ]
    with pytest.raises(CheckFailed, match="not_null.k"):
        enforce(report)
    enforce(report.filter("severity = 'warn'"))


def test_rate_gate(rows):
    def level(*data):
        r = Gate(rows("ok int", *[(x,) for x in data]), "t").rate("ok").report().first()
        return r["passed"], r["severity"]

    assert level(1, 0) == (True, "warn")
    assert level(0, 0) == (False, "warn")
    assert level(2, 2) == (False, "fail")
    assert level(None) == (True, "warn")


def test_balance_gate(rows):
    df = rows("c decimal(18,4), d decimal(18,4)", (10, 0), (0, 9.99))
    assert Gate(df, "j").balance("c", "d").report().first()["passed"]
    assert not Gate(rows("c decimal(18,4), d decimal(18,4)", (10, 9.98)), "j").balance("c", "d").report().first()["passed"]


def test_watermarks(spark, rows):
    table = rows(inc.WATERMARK_SCHEMA, ("p", "GL", T0))
    assert inc.read_watermark(table, "p", "GL") == T0
    assert inc.read_watermark(table, "p", "AR", default=T0) == T0
    moved = inc.set_watermark(table, "p", T0 + dt.timedelta(days=1), "GL")
    assert inc.read_watermark(moved, "p", "GL") == T0 + dt.timedelta(days=1) and moved.count() == 1
    assert inc.set_watermark(table, "p", None, "GL") is table
    assert inc.next_watermark(rows("ts timestamp_ntz"), "ts") is None


def test_load_strategy(rows):
    target, extract = rows("k int, ts int", (1, 1), (2, 1)), rows("k int, ts int", (2, 5), (3, 2))
    assert content(inc.load_table("sf_accounts", target, extract, ["k"], "ts")) == [(2, 5), (3, 2)]
    assert content(inc.load_table("sf_cases", target, extract, ["k"], "ts", 2)) == [(1, 1), (2, 5)]


def test_outage_polls_lose_no_row_of_a_shared_time(rows):
    src = rows("sys_id int, sys_updated_on timestamp_ntz, resolved_at timestamp_ntz, affected_poi_id int, premises_count string",
               *[(n, T0 + dt.timedelta(minutes=n // 5), None, n, "3000") for n in range(15)])
    poi = rows("poi_id int, poi_name string, state_territory string, technology_type string", (1, "one", "s", "t"))
    seen, mark, target = [], T0 - dt.timedelta(minutes=1), None
    for poll in range(3):
        visible = src.filter(F.col("sys_updated_on") <= T0 + dt.timedelta(minutes=poll))
        out = network.outage_incidents(visible, poi, target, mark)
        seen += [r["sys_id"] for r in out["batch"].collect()]
        target, mark = out["incidents"], out["watermark"]()
    assert sorted(seen) == list(range(15)) and target.count() == 15
    assert network.outage_incidents(src, poi, target, mark)["watermark"]() == mark


def test_copies_enforce_their_gates(spark, rows, path):
    df = rows("id int, report_date date", (1, dt.date(2024, 1, 1)))
    with pytest.raises(CheckFailed):
        replication.network_performance_copy(spark, df, path, "2024-01-01", "r")
    lines = rows("rsp_id int, billing_date date", (None, dt.date(2024, 1, 1)))
    with pytest.raises(CheckFailed, match="rsp_id"):
        replication.cvc_billing_copy(spark, lines, path + "b", "2024-01-01")
    with pytest.raises(EmptyInput):
        replication.churn_scores(rows("service_id string, churn_score double, churn_risk_band string, predicted_at timestamp_ntz, prediction_date date"), "2024-01-01")


def test_watermark_predicate_reaches_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = inc.read_incremental(df, "o_orderdate", T0)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan


def test_scratch_needs_a_shared_folder(spark):
    class Elsewhere:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master, applicationId = "local-cluster[2,1,1024]", "x"

    with pytest.raises(RuntimeError, match="checkpoint"):
        shared_dir(Elsewhere)
    assert shared_dir(spark) == shared_dir(spark)


def test_upsert_takes_one_row_of_a_repeated_key(rows):
    target, source = rows("k int, v int", (1, 1)), rows("k int, v int", (1, 2), (1, 3), (None, 4), (None, 4))
    assert content(merge.upsert(target, source, ["k"])) == [(1, 3), (None, 4), (None, 4)]


def test_shuffles_follow_the_input(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert fit_shuffles(spark, 1) == int(before)
        assert fit_shuffles(spark, 1_000_000 * SHUFFLE_TARGET_BYTES) == 1_000_000
        assert fit_shuffles(spark, 1) == int(before)
        spark.conf.set("spark.sql.shuffle.partitions", "9")
        assert fit_shuffles(spark, 1) == 9
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
