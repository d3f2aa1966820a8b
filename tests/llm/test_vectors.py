"""Embedding operators against brute force."""

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegate.llm import embedding_dedup, neighbours

KIND = "vec_id long, embedding array<float>, label int"


def vectors(seed=0, groups=40, size=16):
    rng = np.random.default_rng(seed)
    out, i = {}, 0
    for _ in range(groups):
        centre = rng.normal(size=size)
        for _ in range(rng.integers(1, 6)):
            out[i] = (centre + rng.normal(size=size) * rng.choice([0, 0.1, 0.3])).astype(np.float32).tolist()
            i += rng.integers(1, 4)
    return {int(k): v for k, v in out.items()}


ODD = {9001: None, 9002: [], 9003: [0.0] * 16, 9004: [1.0] * 15 + [None], 9005: [float("nan")] * 16,
       9006: [float("inf")] + [1.0] * 15, 9007: [1.0, 2.0], 9008: [2.0, 4.0], 9009: [-0.0, 1.0], 9010: [0.0, 1.0]}


def frame(spark, table, clash=("node", "cell", "n", "key", "side", "asks", "size", "shard")):
    df = spark.createDataFrame([(i, v, 1) for i, v in table.items()], KIND).repartition(3)
    return df.select("*", *[F.lit("x").alias(c) for c in clash])


@pytest.mark.parametrize("chunk", [1024, 4])
def test_near_vectors(spark, monkeypatch, chunk):
    monkeypatch.setattr(embedding_dedup, "CHUNK", chunk)
    table = vectors() | ODD
    got = embedding_dedup.near_vectors(frame(spark, table), 0.95).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == brute.near_vectors(table, 0.95)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


@pytest.mark.parametrize("within", [0.8, 0.97])
def test_links_inside_a_large_group(spark, within):
    """A third of over 5,000 distinct vectors lies around one direction; some are near copies, at 0.97 all."""
    rng = np.random.default_rng(5)

    def unit(v):
        return v / np.sqrt((v * v).sum(-1, keepdims=True))

    far, centre = unit(rng.normal(size=(4000, 64))), unit(rng.normal(size=64))
    members = unit(np.sqrt(within) * centre + np.sqrt(1 - within) * unit(rng.normal(size=(1000, 64))))
    copies = unit(members + np.sqrt(0.06) * unit(rng.normal(size=members.shape)))
    x = np.concatenate([far, members, copies]).astype(np.float32)[rng.permutation(6000)]
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], KIND)
    got = {r.vec_id: r for r in embedding_dedup.near_vectors(df, 0.95).collect()}
    y = unit(x.astype(float))
    linked = y @ y.T >= 0.95
    np.fill_diagonal(linked, False)
    assert linked.sum() > 1500
    assert sum(r.n_links for r in got.values()) >= 0.99 * linked.sum()
    named = brute.least_reachable(range(len(x)), np.argwhere(np.triu(linked)).tolist())
    assert sum(got[i].component_id == c for i, c in named.items()) >= 0.995 * len(x)


def test_near_vectors_odd_rows(spark):
    v = [1.0, 2.0]
    df = spark.createDataFrame([(1, v, 0), (1, v, 0), (2, v, 0), (None, v, 0)], KIND)
    got = sorted((r.vec_id or 0, r.n_links, r.component_id or 0) for r in embedding_dedup.near_vectors(df).collect())
    assert got == [(0, 0, 0), (1, 1, 1), (1, 1, 1), (2, 1, 1)]
    assert embedding_dedup.near_vectors(df.limit(0)).count() == 0


def exact(table, every, k):
    good = {i: np.array(v, float) for i, v in table.items() if v and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)}
    out = {}
    for q in good:
        if q % every == 0:
            s = sorted((-sum(a * b for a, b in zip(good[q], v, strict=True)), i) for i, v in good.items() if i != q and len(v) == len(good[q]))
            out[q] = [(i, -x) for x, i in s[:k]]
    return out


def test_small_search(spark):
    """Scores and order are exact; up to k + 1 rows all are returned, beyond that nearly all of the best."""
    table = vectors(3) | ODD
    got, want = {}, {q: x for q, x in exact(table, 3, 7).items() if x}
    for r in neighbours.nearest(frame(spark, table), F.col("vec_id") % 3 == 0, 7).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    every = {q: dict(x) for q, x in exact(table, 3, 10**6).items()}
    assert set(got) == set(want)
    for q, found in got.items():
        assert len(found) == len(want[q]) and found == sorted(found, key=lambda x: (-x[1], x[0]))
        assert all(every[q][i] == score for i, score in found)
    assert sum(len(set(found) & set(want[q])) for q, found in got.items()) >= 0.9 * sum(map(len, want.values()))
    few = dict(list(vectors(3).items())[:8])
    got = neighbours.nearest(frame(spark, few), F.lit(True), 7).collect()
    assert sorted((r.query_id, r.vec_id, r.score) for r in got) == sorted((q, i, s) for q, x in exact(few, 1, 7).items() for i, s in x)
    assert neighbours.nearest(frame(spark, {}), F.lit(True)).count() == 0


def test_ties_go_to_the_smaller_id(spark):
    table = {i: [1.0, 0.5] for i in range(30)}
    rows = neighbours.nearest(frame(spark, table), F.col("vec_id") == 4, 5).orderBy("rank").collect()
    assert [r.vec_id for r in rows] == [0, 1, 2, 3, 5]


def recall(spark, x, every):
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], KIND)
    rows = neighbours.nearest(df, F.col("vec_id") % every == 0, 20).collect()
    assert len(rows) == -(-len(x) // every) * 20
    found = {}
    for r in rows:
        found.setdefault(r.query_id, set()).add(r.vec_id)
    x, hit = x.astype(float), 0
    for q, ids in found.items():
        s = x @ x[q]
        s[q] = -np.inf
        hit += len(set(np.argsort(-s)[:20].tolist()) & ids)
    return hit / len(rows)


def test_recall_over_shards(spark):
    """Production constants, three shards, vectors without structure: the hardest case."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(20_000, 64)).astype(np.float32) * rng.uniform(0.5, 2, size=(20_000, 1)).astype(np.float32)
    assert recall(spark, x, 100) >= 0.9


def test_equal_vectors_over_shards(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD", 500)
    df = spark.createDataFrame([(i, [1.0, 0.5, 2.0], 0) for i in range(2100)], KIND)
    rows = neighbours.nearest(df, F.col("vec_id") % 700 == 0, 20).collect()
    assert {q: [r.vec_id for r in sorted(rows, key=lambda r: r["rank"]) if r.query_id == q] for q in (0, 700, 1400)} == {
        0: list(range(1, 21)), 700: list(range(20)), 1400: list(range(20))}


def test_margins_only_drop_what_cannot_be_best():
    """On clustered vectors few candidates are left, and the best are among them."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(60, 32))
    x = centres[rng.integers(0, 60, 4000)] + 0.1 * rng.normal(size=(4000, 32))
    forest = neighbours.Forest(x, float(np.sqrt((x * x).sum(1)).max()))
    leaf, trees, left = forest.leaves(x), np.arange(neighbours.TREES)[:, None], []
    places, margins = forest.order(x[:50])
    for i, (place, margin) in enumerate(zip(places, margins, strict=True)):
        same = np.arange(len(x)) == i
        met = place[trees, leaf].min(0)
        rows = neighbours.promising(x, x[i], met, same, margin[trees, leaf], len(x), 20, forest.norm)
        score = np.where(same, -np.inf, x @ x[i])
        assert set(np.argsort(-score)[:20].tolist()) <= set(rows.tolist())
        left.append(len(rows) / len(x))
    assert np.mean(left) < 0.5


def test_places_and_margins_over_all_trees():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(700, 8))
    forest = neighbours.Forest(x, float(np.sqrt((x * x).sum(1)).max()))
    leaf, trees = forest.leaves(x), np.arange(neighbours.TREES)[:, None]
    places, margins = forest.order(x[:20])
    first, last, along = forest.passed(places, margins, leaf)
    for i in range(20):
        assert (first[i] == places[i][trees, leaf].min(0)).all()
        assert (along[i][last[i]] == margins[i][trees, leaf].max(0)).all()
