"""Every registered query against its SQL twin on the smallest test tables."""

import os

import pytest

from __spark_entry__ import TRAINING_QUERIES, entry, oracle_sql, queries
from tools.parity import TABLES, canonical

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", [n for n in queries() if n not in TRAINING_QUERIES])
def test_same_rows(spark, duck, name):
    df = queries()[name](spark, FOLDER)
    got, names = canonical(df.columns, [tuple(r) for r in df.collect()])
    if name not in oracle_sql():
        assert got
        return
    rel = duck.execute(oracle_sql()[name])
    columns = [d[0] for d in rel.description]
    want, want_names = canonical(columns, rel.fetchall())
    assert names == want_names
    assert got == want


def test_entry(spark):
    df = entry(spark)
    assert "sla_compliance_pct" in df.columns and df.count() >= 0


def test_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())
