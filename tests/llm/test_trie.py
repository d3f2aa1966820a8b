"""The conversation trie against a plain one."""

import hashlib
import random
import zlib
from collections import defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegate.llm import conversation_trie as ct

SCHEMA = "conv_id long, turn long, role string, text string"
CLASH = ["p", "q", "depth", "segment", "many", "words", "n", "last", "place", "at"]


def brute_trie(rows):
    """{(conv_id, depth): (parent, members, children, leaves, saved, hash of ends)}."""
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append(((t is not None, t or 0), role or "", text or ""))
    own = {c: [x[1:] for x in sorted(v, key=lambda x: x[0])] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        built[c] = tuple(own.get(base, [])[:h]) + tuple(turns[h:])
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    below = defaultdict(list)
    for node in members:
        if node:
            below[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[x] for x in below[node]) or 1
        words = len(brute.words(node[-1][1])) if node else 0
        saved[node] = (len(members[node]) - 1) * words + sum(saved[x] for x in below[node])
    out = {}
    for node, of in members.items():
        ends = ",".join(str(c) for c in sorted(of) if built[c] == node)
        parent = min(members[node[:-1]]) if node else None
        out[min(of), len(node)] = (parent, len(of), len(below[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest())
    return out


def talks(seed, count=120, copies=40):
    rng = random.Random(seed)
    line = lambda: (rng.choice(["user", "assistant", None, ""]), rng.choice(["a b", "hello there you", "", None, f"x {rng.randrange(30)}"]))
    rows, made = [], []
    for c in rng.sample(range(-60, 400), count):
        if made and rng.random() < 0.5:
            turns = rng.choice(made)[: rng.randint(0, 6)] + [line() for _ in range(rng.randint(0, 3))]
        else:
            turns = [line() for _ in range(rng.randint(1, 9))]
        made.append(turns)
        start = rng.choice([None, 0, 5])
        rows += [(c, start if k == 0 else 10 + 2 * k, *turn) for k, turn in enumerate(turns)]
    one = [line() for _ in range(7)]
    rows += [(1000 + c, k, *turn) for c in range(copies) for k, turn in enumerate(one)]
    rows += [(2000, k, "user", f"turn {k}") for k in range(90)] + [(2001, k, "user", f"turn {k}") for k in range(80)]
    return rows + [(None, 0, "user", "nobody"), (3000, 1, "user", "same"), (3000, 1, "user", "same")]


def result(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).select("*", *[F.lit("x").alias(c) for c in CLASH])
    got = ct.trie(df).collect()
    out = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in got}
    assert len(out) == len(got)
    return out


def test_trie(spark):
    rows = talks(1)
    assert result(spark, rows) == brute_trie(rows)


@pytest.mark.parametrize("seed", [2, 3])
def test_small_parts(spark, monkeypatch, seed):
    """Short segments, few heavy nodes, ends in many texts, and a sketch that proves next to nothing."""
    monkeypatch.setattr(ct, "SEGMENT", 8)
    monkeypatch.setattr(ct, "HEAVY", 5)
    monkeypatch.setattr(ct, "ENDS_BYTES", 12)
    if seed == 3:
        monkeypatch.setattr(ct, "_slots", lambda p, q, bits: [(p.astype(np.uint64) % np.uint64(7)).astype(np.int64)] * ct.ROWS)
    rows = talks(seed)
    assert result(spark, rows) == brute_trie(rows)


def test_one_and_none(spark):
    assert result(spark, [(3, 0, "user", "a b"), (3, 1, None, None)]) == brute_trie([(3, 0, "user", "a b"), (3, 1, None, None)])
    short = [(c, 0, "user", "x") for c in range(1, 20)]  # without a base most of these are rebuilt to nothing
    assert result(spark, short) == brute_trie(short)
    assert result(spark, [(None, 0, "user", "x")]) == {}
    assert ct.trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sketch_counts(spark):
    rng = np.random.default_rng(5)
    keys = [(int(p), int(q)) for p, q in rng.integers(-(2**62), 2**62, (3000, 2))]
    df = spark.createDataFrame(keys + keys[:500] + keys[:1], "p long, q long").repartition(7)
    table, bits = ct.sketch(df, 3501)
    p, q = np.array(keys).T
    many = np.ones(len(p), bool)
    for r, slot in enumerate(ct._slots(p.copy(), q.copy(), bits)):
        at = slot + (r << bits)
        many &= (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
    assert many[:500].all() and many[500:].mean() < 0.05
