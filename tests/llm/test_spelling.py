"""Spelling variants against a plain form."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidegate.llm import spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASH = ["word", "n", "m", "window", "key", "cell", "side", "form", "root", "best"]


def edits(word, letters):
    yield from (word[:i] + word[i + 1 :] for i in range(len(word)))
    yield from (word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters)
    yield from (word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in letters)


def brute_variants(rows, rare=97, length=5, least=3, ratio=2):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % rare == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= length and k >= least}
    letters = sorted(set("".join(n)))
    form, near = {}, {}
    for w in n:
        others = {e for e in edits(w, letters) if e in n and e != w}
        near[w] = len(others)
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], near[w], n[form[w]] if form[w] else None)
    return out


def texts(seed, count=80):
    rng = random.Random(seed)
    letters = "abcéÿÀ"
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(3, 9))) for _ in range(60)]
    words += ["".join(rng.choice("ab") for _ in range(rng.randint(17, 40))) for _ in range(10)]
    rows = []
    for i in range(count):
        out = []
        for _ in range(rng.randint(0, 60)):
            w = rng.choice(words[: rng.randint(1, len(words))])
            if rng.random() < 0.4:
                p = rng.randrange(len(w))
                w = rng.choice([w[:p] + w[p + 1 :], w[:p] + rng.choice(letters) + w[p:], w[:p] + rng.choice(letters) + w[p + 1 :]])
            out.append(w.upper().replace("É", "é") if rng.random() < 0.1 else w)
        rows.append((i * 5, rng.choice([" ", "\n", "-", "1", "字"]).join(out)))
    return rows + [(None, "aaaaa aaaab aaaab"), (3, None), (4, ""), (6, "12 字 ¿"), (7, rows[0][1]), (7, rows[0][1])]


def result(spark, rows, **kind):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).select("*", *[F.lit("x").alias(c) for c in CLASH])
    got = spelling.variants(df, **kind).collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got}
    assert len(out) == len(got)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_variants(spark, seed):
    rows = texts(seed)
    got = result(spark, rows, rare=7)
    assert got == brute_variants(rows, rare=7) and sum(r[3] for r in got.values()) > 50
    assert result(spark, rows, least_count=1, ratio=1.5) == brute_variants(rows, least=1, ratio=1.5)


def test_small_tiles_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(spelling, "CHUNK", 4)
    monkeypatch.setattr(spelling, "TILE", 60)
    monkeypatch.setattr(spelling, "SLICE", 16)
    monkeypatch.setattr(spelling, "HELD_WORDS", 9)
    base = "abcdefghijklmnopqrstuvwxyz"
    many = [(i, f"{base[:9]}{a}{b}{base[11:]} {base[:5]}{a}{b}") for i, (a, b) in enumerate((a, b) for a in base[:8] for b in base[:8])]
    rows = texts(5, 40) + many * 3
    assert result(spark, rows, least_count=2) == brute_variants(rows, least=2)


def test_long_words_and_long_texts(spark):
    long = "ab" * 20_000
    rows = [(1, f"{long} " * 3), (2, f"{long}a " * 7), (3, "xylophone " * 300_000 + "xylophon " * 4), (5, long[1:] * 2)]
    assert result(spark, rows) == {
        long: (f"{long}a", f"{long}a", 3, 1, 7), f"{long}a": (None, f"{long}a", 7, 1, None),
        "xylophone": (None, "xylophone", 300_000, 1, None), "xylophon": ("xylophone", "xylophone", 4, 1, 300_000),
    }


def test_chain_and_nothing(spark):
    rows = [(1, " ".join(w for k, w in enumerate("abcde abcdf abcgf abhgf aihgf jihgf".split()) for _ in range(3 * 2**k)))]
    got = result(spark, rows, rare=10**9)
    assert got["abcde"] == ("abcdf", "jihgf", 3, 1, 6) and {r[1] for r in got.values()} == {"jihgf"}
    assert result(spark, [(1, None), (2, "ab cd")]) == {}
    assert spelling.variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
