"""Distinct counts from stored bitmaps equal counts of the facts."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tidegate.operators import bitmaps

D0 = dt.date(2024, 1, 1)


def test_counts(rows):
    rng = random.Random(2)
    data = [(rng.choice(["a", "b", None]), D0 + dt.timedelta(days=rng.randrange(9)), rng.choice([rng.randrange(50), 32_767, 32_768, 10**9, None])) for _ in range(400)]
    df = rows("g string, d date, id long", *data).repartition(4)
    stored = bitmaps.daily_bitmaps(df.filter("d < '2024-01-05'"), ["g"], "d", "id").unionByName(bitmaps.daily_bitmaps(df.filter("d >= '2024-01-05'"), ["g"], "d", "id"))
    got = {r.g: r.n for r in bitmaps.distinct_counts(stored, ["g"], "n").collect()}
    assert got == {g: len({i for k, _, i in data if k == g and i is not None}) for g in ("a", "b", None)}
    assert bitmaps.distinct_counts(stored, [], "n").first().n == len({i for _, _, i in data if i is not None})
    last = D0 + dt.timedelta(days=8)
    week = {(r.g, r.as_of): r.n for r in bitmaps.trailing_counts(stored, ["g"], "d", 3, last, "n").collect()}
    want = {}
    for g in ("a", "b", None):
        for n in range(9):
            day = D0 + dt.timedelta(days=n)
            ids = {i for k, d, i in data if k == g and i is not None and day - dt.timedelta(days=2) <= d <= day}
            if ids:
                want[g, day] = len(ids)
    assert week == want
    assert bitmaps.distinct_counts(stored.filter(F.lit(False)), ["g"], "n").count() == 0
