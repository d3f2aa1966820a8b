"""Loads that write: gates stop them, reruns change nothing."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from tidegate.operators.quality import CheckFailed, Gate
from tidegate.plans import publish
from tidegate.session import scratch_dir
from tidegate.sinks import storage, tables

MONTH = T.StructField(publish.MONTH, T.StringType())


@pytest.fixture
def path(spark):
    return scratch_dir(spark, "publish-test")


def test_a_failed_gate_writes_nothing(spark, rows, path):
    source = scratch_dir(spark, "publish-files")
    lines = rows("rsp_id string, billing_date string, service_id string, plan_code string, charge_amount string, currency string",
                 ("r", "2024-01-02", "s", "p", "1.50", "AUD"))
    lines.write.option("header", True).csv(source)
    with pytest.raises(CheckFailed, match="min_rows"):
        publish.billing_files(spark, f"{source}/*.csv", path, "2024-01-03")
    assert not storage.exists(spark, path)
    for _ in range(2):
        publish.billing_files(spark, f"{source}/*.csv", path, "2024-01-02")
    got = tables.read_partitioned(spark, path, MONTH).collect()
    assert [(r.rsp_id, str(r.billing_date), r[publish.MONTH]) for r in got] == [("r", "2024-01-02", "2024-01")]


def test_checked_outputs(spark, rows, path):
    df = rows("k int", (1,), (None,))
    outputs = {"rows": df, "gate": Gate(df, "t").not_null("k").report()}
    with pytest.raises(CheckFailed, match="t.not_null.k"):
        publish.checked(outputs, {"rows": path})
    assert not storage.exists(spark, path)
    publish.checked(outputs | {"gate": Gate(df, "t").min_rows(1).report()}, {"rows": path})
    assert spark.read.parquet(path).count() == 2


def test_polls_merge_by_month(spark, rows, path):
    poi = rows("poi_id int, poi_name string, state_territory string, technology_type string", (1, "one", "s", "t"))
    at = dt.datetime(2024, 1, 31, 23)
    shape = "sys_id int, sys_updated_on timestamp_ntz, opened_at timestamp_ntz, resolved_at timestamp_ntz, affected_poi_id int, premises_count string"
    first = rows(shape, (1, at, at, None, 1, "10"), (2, at, None, None, 1, None))
    mark = publish.outage_poll(first, poi, path, None)
    later = rows(shape, (1, at + dt.timedelta(hours=2), at, at, 1, "10"), (3, at + dt.timedelta(hours=2), at + dt.timedelta(hours=2), None, 2, "3000"))
    for _ in range(2):
        assert publish.outage_poll(later, poi, path, mark) == at + dt.timedelta(hours=2)
    got = sorted((r.sys_id, r.resolved_at is None, r[publish.MONTH]) for r in tables.read_partitioned(spark, path, MONTH).collect())
    assert got == [(1, False, "2024-01"), (2, True, None), (3, True, "2024-02")]
