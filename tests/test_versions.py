"""Tables behind one name: refreshed in one step, and merged bucket by bucket."""

import uuid

import pytest

from tidegate.operators.quality import CheckFailed, Gate
from tidegate.session import scratch_dir
from tidegate.sinks import versions


@pytest.fixture
def name(spark):
    name = f"t_{uuid.uuid4().hex}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_refresh(spark, rows, name):
    root = scratch_dir(spark, "versions")
    shape = "k int, v string"
    versions.refresh(rows(shape, (1, "a")), name, root)
    old = spark.table(name)
    assert content(old) == [(1, "a")]
    second = versions.refresh(rows(shape, (2, "b"), (3, None)), name, root)
    assert content(spark.table(name)) == [(2, "b"), (3, None)] and content(old) == [(1, "a")]
    with pytest.raises(CheckFailed):
        versions.refresh(rows(shape, (9, "x")), name, root, lambda df: Gate(df, "t").min_rows(5))
    assert versions.location(spark, name).endswith(second.rsplit("/", 1)[1])
    assert content(spark.table(name)) == [(2, "b"), (3, None)] and len(versions.versions(spark, root)) == 2
    # A table may be rebuilt from itself.
    versions.refresh(spark.table(name).filter("k = 3"), name, root, lambda df: Gate(df, "t").min_rows(1))
    assert content(spark.table(name)) == [(3, None)] and len(versions.versions(spark, root)) == 2
    versions.refresh(rows(shape).limit(0), name, root)
    assert content(spark.table(name)) == []


def test_bucketed_merge(spark, rows, name):
    shape = "k int, j string, v string"
    versions.write_bucketed(rows(shape, (1, "a", "old"), (2, "a", "old"), (None, "a", "none")), name, scratch_dir(spark, "b"), ["k", "j"], 4)
    batch = rows(shape, (2, "a", "new"), (2, "a", "newest"), (3, "b", "in"), (3, None, "x"))
    versions.merge_bucketed(batch, name, scratch_dir(spark, "b"), ["k", "j"], 4, ["v"])
    want = [(1, "a", "old"), (2, "a", "newest"), (3, "b", "in"), (3, None, "x"), (None, "a", "none")]
    assert content(spark.table(name)) == sorted(want, key=str)


def test_only_the_batch_is_shuffled(spark, rows, name):
    shape = "k int, v string"
    versions.write_bucketed(rows(shape, *[(n, "old") for n in range(100)]), name, scratch_dir(spark, "b"), ["k"], 4)
    for _ in range(2):  # the merged table is bucketed like the first
        out = versions.merged_bucketed(spark.table(name), rows(shape, (5, "new")), ["k"], ["v"], 4)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "REPARTITION_BY_NUM" in plan and "SortMergeJoin" in plan
        versions.merge_bucketed(rows(shape, (5, "new")), name, scratch_dir(spark, "b"), ["k"], 4)
    assert spark.table(name).filter("v = 'new'").count() == 1 and spark.table(name).count() == 100
