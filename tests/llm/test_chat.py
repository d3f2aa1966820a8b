"""Reply trees and chat formatting against plain forms."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidegate.llm import chat

CLASH = ["place", "branch", "up", "above", "number", "head", "body", "path_id", "turns", "loss", "count"]
LINK = "tree_id long, message_id string, parent_id string, role string, text string, score double"
ODD = ["", "\\", "\\b", "\\\\e", "###", "####", "\\###", "</turn>", "<</turn>turn>", "\n</turn>\n", "### user:\n", "a\n", None, "é字\U0001f600", "\\n"]


def brute_paths(rows, keep):
    """{tree: [path of message ids from the root, best first]}."""
    trees = defaultdict(dict)
    for tree, i, parent, _, _, score in rows:
        if i is not None:
            key = (score is None, -(score or 0), parent is not None, parent or "")
            if i not in trees[tree] or key < trees[tree][i]:
                trees[tree][i] = key
    out = {}
    for tree, nodes in trees.items():
        below = defaultdict(list)
        for i, (no, s, has, parent) in nodes.items():
            below[parent if has and parent in nodes else None].append((no, s, i))
        found = []

        def walk(path, below=below, found=found):
            replies = [i for _, _, i in sorted(below[path[-1] if path else None])]
            if not replies and path:
                found.append(path)
            for i in replies:
                walk([*path, i])

        walk([])
        if found:
            out[tree] = found[:keep]
    return out


def random_trees(seed, trees=6, messages=25):
    rng = random.Random(seed)
    rows = []
    for t in range(trees):
        for i in range(rng.randint(1, messages)):
            parent = None if i == 0 or rng.random() < 0.08 else f"m{rng.randrange(i):02d}"
            rows.append((t, f"m{i:02d}", parent, rng.choice(["user", "assistant", "", None, "a:\nb"]), rng.choice(ODD), rng.choice([None, 0.0, 1.0, 1.0, 2.5])))
    chain = [(50, f"c{i:03d}", f"c{i - 1:03d}" if i else None, "user", str(i), None) for i in range(70)]
    circle = [(60, "a", "b", "user", "x", 1.0), (60, "b", "a", "user", "y", 1.0), (60, "c", "b", "user", "z", 1.0), (60, "d", "d", "user", "z", None)]
    other = [(70, "a", "gone", "user", "root", 1.0), (70, None, "a", "user", "none", 1.0), (70, "b", "a", "assistant", "one", 1.0), (70, "b", "a", "assistant", "two", 0.5), (None, "q", None, "assistant", "w", None)]
    return rows + chain + circle + other


def found_paths(df):
    out = defaultdict(dict)
    for r in df.collect():
        out[r.tree_id].setdefault((r.path_rank, r.path_id), {})[r.place] = r.message_id
    return {t: [[m for _, m in sorted(p.items())] for _, p in sorted(paths.items())] for t, paths in out.items()}


@pytest.mark.parametrize("keep", [1, 2, None])
def test_paths(spark, keep):
    rows = random_trees(keep or 9)
    df = spark.createDataFrame(rows, LINK).repartition(3).select("*", *[F.lit("x").alias(c) for c in CLASH])
    assert found_paths(chat.best_paths(df, keep)) == brute_paths(rows, keep)


def test_no_messages(spark):
    none = spark.createDataFrame([], LINK)
    assert chat.best_paths(none).count() == 0 and chat.format_trees(none, None).count() == 0
    assert chat.digests(chat.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0


def test_trees_become_texts(spark):
    rows = random_trees(4)
    texts = defaultdict(list)
    for tree, i, _, role, text, _ in rows:
        texts[tree, i].append((role or "", text or ""))
    got = chat.format_trees(spark.createDataFrame(rows, LINK), 2)
    got = got.select("tree_id", "path_rank", chat.read_turns(F.col("text")).alias("turns"), chat.read_loss(F.col("text"), F.col("loss")).alias("masked"), "text")
    want = {(t, k + 1): [x for i in p for x in sorted(texts[t, i])] for t, paths in brute_paths(rows, 2).items() for k, p in enumerate(paths)}
    seen = {(r.tree_id, r.path_rank): r for r in got.collect()}
    assert set(seen) == set(want)
    for key, turns in want.items():
        assert [tuple(x) for x in seen[key].turns] == turns
        assert seen[key].masked == "".join(t for role, t in turns if role == "assistant")
        assert seen[key].text.count("</turn>") == seen[key].text.count("###") == len(turns)


def test_any_text_comes_back(spark):
    rng = random.Random(7)
    rows = [(c, t, rng.choice(["user", "assistant", "\n", "x:\n"]), "".join(rng.choice(["\\", "#", "<", "</turn>", "\n", ":", "h", "e", "b", "é"]) for _ in range(rng.randint(0, 12))))
            for c in range(60) for t in range(rng.randint(1, 9))]
    rows += [(90, None, "user", "first"), (90, 1, None, None), (90, 1, "assistant", "same"), (90, 1, "assistant", "same"), (None, 3, "assistant", "no id")]
    rows += [(91, 0, "user", "é" * 2_000_000), (91, 1, "assistant", "ab " * 700_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    got = {r.conv_id: r for r in chat.digests(chat.format_conversations(df.withColumn("place", F.lit(1)))).collect()}
    by = defaultdict(list)
    for c, t, role, text in rows:
        by[c].append(((t is not None, t or 0, role or "", text or ""), role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns = [(role, text) for _, role, text in sorted(turns)]
        masked = "".join(x for role, x in turns if role == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(masked), hashlib.sha256(masked.encode()).hexdigest())


def test_no_python_on_the_path(spark):
    df = spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    plan = chat.digests(chat.format_conversations(df))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
