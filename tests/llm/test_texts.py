"""Text operators against their plain forms."""

import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidegate.llm import language, near_dedup, quality, substring_dedup
from tidegate.llm.shared import Words, bounds, whole_groups, windows

CLASH = ["cell", "node", "cluster", "n", "key", "size", "bucket", "turn", "side", "at", "score", "sha", "kept"]


def texts_with_copies(seed, count=60, vocabulary=400, longest=80):
    rng = random.Random(seed)
    out = {}
    for i in range(count):
        pick = rng.random()
        old = list(out.values())
        if old and pick < 0.25:
            w = brute.words(rng.choice(old))
            for _ in range(rng.randint(0, 3)):
                if w:
                    w[rng.randrange(len(w))] = f"new{rng.randrange(99)}"
        elif old and pick < 0.4:
            w = brute.words(rng.choice(old))[: rng.randint(0, 40)] + [f"v{rng.randrange(vocabulary)}" for _ in range(rng.randint(0, 30))]
        else:
            w = [f"v{rng.randrange(vocabulary)}" for _ in range(rng.randint(0, longest))]
        out[i * 3] = rng.choice([" ", "\n", "\t ", "  "]).join(w)
    return out


def frame(spark, docs, clash=True):
    df = spark.createDataFrame([(i, t) for i, t in docs.items()], "doc_id long, text string").repartition(3)
    return df.select("*", *[F.lit("x").alias(c) for c in CLASH]) if clash else df


ODD = {1: None, 2: "", 3: " \n\t ", 4: "one", 5: "one", 7: "Ünï cödé 字", 9: "a\x0bb\x0cc\rd", 11: "a\xa0b\x1cc"}


def test_words():
    rng = random.Random(5)
    texts = ["".join(rng.choice("aB é字\t\n\x0b\xa0\x1c ") for _ in range(rng.randint(0, 30))) for _ in range(200)] + [None]
    for column in (pa.array(texts), pa.array([*texts[:3], *texts]).slice(3)):
        w = Words(column)
        got = [[bytes(w.raw[a:b]).decode() for a, b in zip(w.start[x:y], w.end[x:y], strict=True)]
               for x, y in zip(w.first[:-1], w.first[1:], strict=True)]
        assert got == [brute.words(t) for t in texts]
    h = w.hashes()
    flat = [x for t in texts for x in brute.words(t)]
    assert len(set(h.tolist())) == len(set(flat)) and len({(a, b) for a, b in zip(flat, h.tolist(), strict=True)}) == len(set(flat))
    assert len(Words(pa.array([None, "", " "], pa.string())).hashes()) == 0


def test_windows():
    h = np.array([1, 2, 3, 1, 2, 3, 4], np.uint64)
    for length in (1, 2, 3, 5):
        got = windows(h, length)
        want = [tuple(h[i : i + length]) for i in range(len(h) - length + 1)]
        assert len(got) == len(want)
        assert [got[0] == x for x in got] == [want[0] == x for x in want]
    assert not len(windows(h, 8))


def test_whole_groups():
    keys = np.repeat(np.arange(40), np.random.default_rng(1).integers(1, 30, 40))
    batches = pa.table({"k": keys}).to_batches(max_chunksize=7)
    tables = list(whole_groups(batches, "k", rows=50))
    assert np.concatenate([t["k"].to_numpy() for t in tables]).tolist() == keys.tolist()
    assert sum(len(bounds(t["k"].to_numpy())) - 1 for t in tables) == 40
    assert list(whole_groups([], "k")) == []


@pytest.mark.parametrize("seed", range(2))
def test_near_duplicates(spark, seed):
    docs = texts_with_copies(seed) | ODD | {100_000: texts_with_copies(seed)[0].upper()}
    for size in (4, 5):
        got = near_dedup.near_duplicates(frame(spark, docs), size).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.near_duplicates(docs, size)
        assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(docs)


def test_near_duplicates_odd_rows(spark):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (6, "A B c d e f"), (None, "a b c d e f"), (None, None), (8, "zz")]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()
    assert sorted(((r.doc_id or 0), r.component_id, r.kept) for r in got if r.doc_id) == [
        (5, 5, True), (5, 5, True), (6, 5, False), (8, 8, True)]
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)] * 2
    assert near_dedup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_large_group_is_dealt_over_cells(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "LIST_CHUNK", 8)
    monkeypatch.setattr(near_dedup, "GROUP_CHUNK", 8)
    base = [f"w{i}" for i in range(120)]
    docs = {i: " ".join([*base[:i], f"x{i}", *base[i:]]) for i in range(50)}
    got = near_dedup.near_duplicates(frame(spark, docs, False), 4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.near_duplicates(docs, 4)


@pytest.mark.parametrize("seed", range(2))
def test_substring(spark, seed):
    docs = texts_with_copies(seed, vocabulary=60) | ODD | {90_001: texts_with_copies(seed, vocabulary=60)[9]}
    for length in (6, 9):
        got = substring_dedup.remove_repeated(frame(spark, docs), length).collect()
        assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == brute.remove_repeated(docs, length)
        for r in got:
            assert (r.kept is None) == (r.n_removed == 0)


def test_substring_odd_rows(spark):
    text, long = "a b c d e f g h", "x " + "q " * 5000 + "y"
    rows = [(1, text), (2, text), (2, text), (2, "z " + text), (None, text), (3, long), (4, long + " w")]
    got = substring_dedup.remove_repeated(spark.createDataFrame(rows, "doc_id long, text string"), 6).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in got) == [
        (0, 8, 0), (1, 8, 0), (2, 8, 8), (2, 8, 8), (2, 9, 8), (3, 5002, 0), (4, 5003, 5002)]
    assert substring_dedup.remove_repeated(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def sentences(rng, letters, n):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


def test_language(spark):
    rng = random.Random(3)
    kinds = {"aa": "aeiomnrst", "bb": "bcdfgkluy", "cc": "äöüvwxzhj"}
    rows = [(i, sentences(rng, kinds[k], rng.randint(3, 40)), k, "s") for i, k in enumerate(list(kinds) * 40)]
    both = sentences(rng, kinds["aa"], 30) + " " + sentences(rng, kinds["bb"], 60)
    rows += [(900, both, None, "s"), (901, None, "aa", "s"), (902, "12 !? \n", "bb", None), (903, "", None, None), (904, "ÄÖ", None, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in language.identify(docs, language.fold(3) != 1).collect()}
    assert len(got) == len(rows)
    assert all(got[i].lang_pred == k for i, _, k, _ in rows[:120])
    assert got[900].lang_pred == "bb" and 0.5 < got[900].score < 0.8
    assert [(got[i].lang_pred, got[i].score) for i in (901, 902, 903)] == [("und", 0.0)] * 3
    assert got[904].lang_pred == "cc" and all(0 <= r.score <= 1 for r in got.values())
    untaught = language.identify(docs.withColumn("lang", F.lit(None).cast("string")), F.lit(True)).collect()
    assert {(r.lang_pred, r.score) for r in untaught} == {("und", 0.0)}
    assert language.identify(docs.limit(0), F.lit(True)).count() == 0


def test_expectation_maximisation_finds_shares():
    p = np.array([[0.9, 0.1], [0.1, 0.9]])
    share, likely = language._fit(p, np.array([70.0, 30.0]), np.array([0]), np.array([[0.5, 0.5]]))
    # Likelihood of a mixture q: 0.7 log(.1 + .8 q) + 0.3 log(.9 - .8 q), highest at q = 0.75.
    assert abs(share[0, 0] - 0.75) < 0.02 and likely[0] < 0


def test_language_sets(spark):
    """The set found is the best of all sets by penalised likelihood, also where it holds four languages."""
    rng = random.Random(8)
    kinds = {"aa": "aeiomnrst", "bb": "bcdfgkluy", "cc": "äöüvwxzhj", "dd": "pqñçåøéèß", "ee": "abcdeåøzz"}
    taught = [(i, sentences(rng, kinds[k], 60), k) for i, k in enumerate(list(kinds) * 12)]
    model = language.learn(spark.createDataFrame(taught, "doc_id long, text string, lang string"))
    mixed = [["aa"], ["aa", "bb"], ["aa", "bb", "cc"], ["aa", "bb", "cc", "dd"], ["dd", "ee"], ["ee"]]
    texts = [" ".join(sentences(rng, kinds[k], 60) for k in m) for m in mixed]
    there, chosen, _ = language.mixtures(model, [*texts, "", None, "12"])
    assert there.tolist() == list(range(len(texts)))
    for text, want, got in zip(texts, mixed, chosen, strict=True):
        gram, _ = language.trigrams([text])
        gram, count = np.unique(gram, return_counts=True)
        best = {}
        for bits in range(1, 32):
            names = [i for i in range(5) if bits >> i & 1]
            start = np.zeros((1, 5))
            start[0, names] = 1 / len(names)
            _, likely = language._fit(model.p[gram], count.astype(float), np.array([0]), start)
            best[bits] = likely[0] - language.PENALTY / 2 * (len(names) - 1) * np.log(count.sum())
        top = max(best, key=best.get)
        found = {model.names[i] for i in np.flatnonzero(got)}
        assert found == {model.names[i] for i in range(5) if top >> i & 1} == set(want)
        assert np.isclose(got.sum(), 1)


def brute_marginals(unary, step):
    total, good = 0.0, np.zeros(len(unary))
    for bits in range(2 ** len(unary)):
        y = [(bits >> i) & 1 for i in range(len(unary))]
        w = np.exp(sum(u for u, b in zip(unary, y, strict=True) if b) + sum(step[a, b] for a, b in zip(y, y[1:], strict=False)))
        total += w
        good += w * np.array(y)
    return good / total


def test_forward_backward():
    rng = np.random.default_rng(2)
    first = np.array([0, 4, 4, 5, 11])
    unary, step = rng.normal(size=11), rng.normal(size=(2, 2))
    got, moves = quality.forward_backward(unary, step, first)
    for a, b in zip(first[:-1], first[1:], strict=True):
        assert np.allclose(got[a:b], brute_marginals(unary[a:b], step))
    assert np.isclose(moves.sum(), 3 + 0 + 5)


def test_quality(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(200):
        good = i % 3 > 0
        lines = [sentences(rng, "aeionrst", rng.randint(4, 12)) + ("." if good else " ### $$$ %%%") for _ in range(rng.randint(1, 6))]
        rows.append((i, "\n".join(lines)))
        labels.append((i, int(good)))
    rows += [(900, None), (901, ""), (902, " \n \n"), (903, "x"), (0, rows[0][1])]
    labels += [(0, 0), (900, None), (None, 1), (901, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("good", F.lit("clash"))
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    got = quality.score(docs, marks, language.fold(5) != 0).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r.score for r in got}
    held = [i for i in range(200)]
    assert np.mean([(by[i] >= 0.3) == (i % 3 > 0) for i in held]) > 0.97
    assert [by[i] for i in (900, 901, 902)] == [0, 0, 0]
    alone = {r.doc_id: r.score for r in quality.score(docs, marks.limit(0), F.lit(True)).collect()}
    assert alone[5] == 0.5 and alone[901] == 0
    assert quality.score(docs.limit(0), marks, F.lit(True)).count() == 0


def test_links_that_few_least_values_show(spark):
    """Pairs at 0.8 whose six least shingles have less than two in common are linked all the same."""
    rng = random.Random(12)
    long = [" ".join(f"w{rng.randrange(10**9)}" for _ in range(104)) for _ in range(12_000)]
    short = [" ".join(t.split()[:84]) for t in long]
    least = []
    for texts in (long, short):
        value, first = near_dedup.shingle_sets(pa.array(texts), 5)
        least.append([set(value[a : a + 6].tolist()) for a in first[:-1]])
    hard = [k for k, (a, b) in enumerate(zip(*least, strict=True)) if len(a & b) < 2]
    assert len(hard) >= 5
    texts = {2 * i + j: t[k] for i, k in enumerate(hard) for j, t in enumerate((long, short))}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(df, 5).collect()}
    assert got == {i: i // 2 * 2 for i in texts}


def test_a_cell_of_one_group_is_compared_with_its_first_member_alone(monkeypatch):
    rng = np.random.default_rng(3)

    def cell(shared, size):
        base = rng.integers(0, 2**31, shared)
        return [np.sort(np.r_[base, rng.integers(2**31, 2**32, 64 - shared)]).astype(np.uint32).tobytes() for _ in range(size)]

    def edges(sketches, cells):
        batch = pa.RecordBatch.from_pydict({
            "cell": pa.array(cells, pa.int64()), "node": pa.array(range(len(cells)), pa.int64()),
            "n_shingles": pa.array([64] * len(cells), pa.int64()), "sketch": pa.array(sketches, pa.binary()),
        })
        return [(r["a"], r["b"]) for out in near_dedup._list_cells(0.8)(iter([batch])) for r in out.to_pylist()]

    # Two groups and strangers in one cell: members of both are found, whichever comes first.
    mixed = [x for three in zip(cell(60, 40), cell(58, 40), cell(12, 40), strict=True) for x in three]
    got = edges(mixed, [1] * 120)
    assert {a % 3 for a, _ in got} == {0, 1} and all(a % 3 == b % 3 for a, b in got) and len(got) == 78
    assert edges([], []) == []
    # One group, and one without any link, need no table of all pairs.
    monkeypatch.setattr(near_dedup, "common", None)
    assert len(edges(cell(60, 200), [1] * 200)) == 199
    assert edges(cell(20, 200), [1] * 200) == []
