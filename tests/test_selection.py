"""Percentiles by rank and as of every day against plain Python."""

import datetime as dt
import random

import numpy as np
from pyspark.sql import functions as F

from tidegate.operators import selection

D0 = dt.date(2024, 1, 1)


def test_percentiles_by_rank(spark, rows):
    rng = random.Random(3)
    data = [(rng.choice(["a", "a", "a", "b", None]), rng.choice([rng.random(), 0.25, None])) for _ in range(400)] + [("one", 7.0), ("none", None)]
    df = rows("g string, v double", *data).repartition(5)
    shares = {"p0": 0.0, "p37": 0.37, "p95": 0.95, "p100": 1.0}
    got = {r.g: tuple(r)[1:] for r in selection.percentiles_by_rank(df, ["g"], "v", shares).collect()}
    groups = {g for g, v in data if v is not None}
    assert set(got) == groups
    for g in groups:
        values = [v for k, v in data if k == g and v is not None]
        assert np.allclose(got[g], [np.quantile(values, p) for p in shares.values()], atol=1e-4)
    assert selection.percentiles_by_rank(df.filter(F.lit(False)), ["g"], "v", shares).count() == 0


def test_one_group_lies_in_many_partitions(spark):
    df = spark.range(0, 5000, 1, 8).select(F.lit("x").alias("g"), ((F.col("id") * 7919) % 5000).cast("double").alias("v"))
    row = selection.percentiles_by_rank(df, ["g"], "v", {"m": 0.5, "p": 0.999}).first()
    assert (row.m, row.p) == (2499.5, round(4999 * 0.999, 4))


def test_percentile_as_of(rows):
    data = [(1, D0 + dt.timedelta(days=n % 9), float(n % 5)) for n in range(40)] + [(2, D0, 3.0), (2, None, 9.0), (1, D0, None)]
    last = D0 + dt.timedelta(days=10)
    got = {(r.k, r.as_of): (r.rows, r.p) for r in selection.percentile_as_of(rows("k int, d date, v double", *data), ["k"], "d", "v", 0.9, 3, last, "p").collect()}
    want = {}
    for k in (1, 2):
        for n in range(11):
            day = D0 + dt.timedelta(days=n)
            values = [v for key, d, v in data if key == k and d and v is not None and day - dt.timedelta(days=3) <= d <= day]
            if values:
                want[k, day] = (len(values), round(float(np.quantile(values, 0.9)), 4))
    assert got == want
