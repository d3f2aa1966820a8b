"""Near-duplicate documents by bottom-k sketches of one hash function.

1. A document is the set of its distinct word shingles, each one 64-bit hash.
   Documents with equal sets form a class (128-bit digest of the set); only the
   class goes on, so exact copies cost nothing further, however many there are.
2. The RETAINED least hashes of a set are its sketch. Inverted lists are keyed by
   pairs of the first PROBED retained values, so a list already means an overlap
   of two; a list is dealt over cells of bounded size in which each pair meets.
3. In a cell, the share of common values among the least of the united sketches
   estimates the Jaccard similarity. Pairs estimated at ESTIMATE_SLACK below the
   threshold or better are candidates. Only a spanning forest of them leaves the
   cell, so a list of g members yields fewer than g rows.
4. Components of the candidates are the groups inside which every true link lies.
   Their members' full sets are fetched once, dealt over cells again, and links are
   confirmed on the full sets; again only a forest leaves each cell.
5. Components of the confirmed links give the result.

At similarity 0.8 a pair shares fewer than two of the twelve probed values with
probability 2e-7 at most (when one set contains the other), and fails the estimate
with 2e-8; both fall quickly with similarity.

Defined cases: a null, empty or word-less text has an empty set and is linked with
nothing; a text with fewer words than a shingle has its whole sequence as its only
shingle; repeated rows are copies of each other; rows of one id with different texts
are judged each by its own text; a row without id is linked with nothing and kept;
other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.components import components
from tidegate.llm.shared import (
    Words, among, bounds, by_cell, chunked, joined, mix, only, pieces, stored, whole_groups, windows,
)

RETAINED = 64
PROBED = 12
ESTIMATE_SLACK = 0.3
LIST_CHUNK = 512
GROUP_CHUNK = 256
PIVOTED = 32
_PAIRS = np.array(list(combinations(range(PROBED), 2)))


def shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of every text, ascending, in one array; text d has ``[first[d]:first[d + 1]]``."""
    words = Words(column, lower=True)
    h = words.hashes()
    counts = np.diff(words.first)
    parts, docs = [], []
    for length in range(1, size + 1):
        # Texts with exactly ``length`` words below the shingle size, and all longer ones at the size itself.
        who = np.flatnonzero(counts == length) if length < size else np.flatnonzero(counts >= size)
        if not len(who):
            continue
        number = counts[who] - length + 1
        ends = np.cumsum(number)
        at = np.arange(ends[-1]) - np.repeat(ends - number, number) + np.repeat(words.first[who], number)
        parts.append(windows(h, length)[at])
        docs.append(np.repeat(who, number))
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(len(counts) + 1, np.int64)
    value, doc = np.concatenate(parts), np.concatenate(docs)
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    value, doc = value[new], doc[new]
    return value, np.searchsorted(doc, np.arange(len(counts) + 1))


def _sketches(size: int):
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            value, first = shingle_sets(batch["text"], size)
            some = np.flatnonzero(np.diff(first))
            sums = np.zeros((2, batch.num_rows), np.uint64)
            if len(some):
                for k, seed in enumerate((11, 29)):
                    sums[k, some] = np.add.reduceat(mix(value + np.uint64(seed)), first[some])
            sketch = [(value[a : min(b, a + RETAINED)] >> np.uint64(32)).astype(np.uint32).tobytes()
                      for a, b in zip(first[:-1], first[1:], strict=True)]
            keys = []
            for a, b in zip(first[:-1], first[1:], strict=True):
                pairs = _PAIRS[_PAIRS[:, 1] < b - a] + a
                keys.append(joined(value[pairs[:, 0]], value[pairs[:, 1]]).view(np.int64))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch["doc_id"].cast(pa.int64()),
                **{name: batch[name] for name in batch.schema.names[2:]},
                "n_shingles": pa.array(np.diff(first), pa.int64()),
                "set_a": pa.array(sums[0].view(np.int64)),
                "set_b": pa.array(sums[1].view(np.int64)),
                "sketch": pa.array(sketch, pa.binary()),
                "keys": pa.array(keys, pa.list_(pa.int64())),
            })

    return work


def forest(
    count: int, linked: Callable[[int, np.ndarray], np.ndarray], start: tuple[np.ndarray, np.ndarray] | None = None
) -> list[tuple[int, int]]:
    """Edges of a spanning forest; ``linked(i, others)`` says which of the others are linked with i.

    ``start`` are members that are known to be linked with each other, and the rest.
    """
    todo, edges, stack = np.arange(count), [], []
    if start is not None:
        stack, todo = list(start[0]), start[1]
    while len(todo):
        if not stack:
            stack, todo = [todo[0]], todo[1:]
        while stack and len(todo):
            i = stack.pop()
            hit = linked(i, todo)
            found = todo[hit]
            edges += [(i, j) for j in found]
            todo = todo[~hit]
            stack.extend(found)
    return edges


def estimates(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Jaccard similarity of padded sketches (padding above 2**32), by the least values of the united sketch."""
    both = np.sort(np.concatenate([np.broadcast_to(one, others.shape), others], axis=1), axis=1)
    same = both[:, 1:] == both[:, :-1]
    rank = np.arange(1, both.shape[1])[None, :] - np.cumsum(same, axis=1) + 1  # of the distinct value at its second place
    real = (both < 2**32).sum(1) - same.sum(1)
    k = np.minimum(RETAINED, np.maximum(real, 1))
    return (same & (rank <= k[:, None])).sum(1) / k


def padded(sketches: list[bytes]) -> np.ndarray:
    """One row per sketch; the filling differs everywhere, so that it is never common."""
    out = 2**32 + np.arange(len(sketches) * RETAINED, dtype=np.int64).reshape(-1, RETAINED)
    for row, s in zip(out, sketches, strict=True):
        row[: len(s) // 4] = np.frombuffer(s, np.uint32)
    return out


def common(sketches: np.ndarray, of: np.ndarray | None = None) -> np.ndarray:
    """Numbers of common values of a cell's sketches, each with each, or with those ``of`` the given rows."""
    m, of = len(sketches), slice(None) if of is None else of
    value, row = sketches.ravel(), np.repeat(np.arange(m), sketches.shape[1])
    order = np.argsort(value, kind="stable")
    value, row = value[order], row[order]
    cut = bounds(value)
    often = np.flatnonzero(np.diff(cut) > 1)
    total = np.zeros((m, len(sketches[of])), np.float32)
    for a in range(0, len(often), 4096):
        part = often[a : a + 4096]
        size = np.diff(cut)[part]
        ends = np.cumsum(size)
        at = np.arange(ends[-1]) - np.repeat(ends - size, size) + np.repeat(cut[part], size)
        has = np.zeros((len(part), m), np.float32)
        has[np.repeat(np.arange(len(part)), size), row[at]] = 1
        total += has.T @ has[:, of]
    return total


def _candidates(sketches: np.ndarray, n: np.ndarray, threshold: float, of: np.ndarray | None = None) -> np.ndarray:
    """Pairs that sizes and common values leave possible, of each with each or with those ``of`` the given rows."""
    other = n if of is None else n[of]
    most, least = np.maximum.outer(n, other), np.minimum.outer(n, other)
    enough = common(sketches, of) >= (threshold - ESTIMATE_SLACK) * np.minimum(RETAINED, most) - 1e-6
    return enough & (least >= threshold * most - 1e-6)


EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def sociable(sketches: np.ndarray, n: np.ndarray, threshold: float) -> np.ndarray:
    """Rows of a cell with as many values that some other row has as a candidate must share with one; the rest have no pair."""
    value = np.unique(sketches, return_inverse=True)[1].reshape(sketches.shape)
    least = (threshold - ESTIMATE_SLACK) * np.minimum(RETAINED, n) - 1e-6
    rows = np.arange(len(sketches))
    while True:
        often = np.bincount(value[rows].ravel(), minlength=1) > 1
        enough = often[value[rows]].sum(1) >= least[rows]
        if enough.all():
            return rows
        rows = rows[enough]


def _list_forest(own: np.ndarray, n: np.ndarray, near: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """What a forest of a cell's pairs needs besides the links of its first member, which ``near`` marks.

    Members linked with the first need no comparison among each other, so a cell of one group costs its size, not the square of it.
    """
    rows = sociable(own, n, threshold) if len(own) > PIVOTED else np.arange(len(own))
    rest = rows[~near[rows] & (rows > 0)]
    if not len(rest):
        return []
    found = rows[near[rows]]
    rows = np.concatenate([found, rest])
    columns = np.arange(len(found), len(rows))
    able, own = _candidates(own[rows], n[rows], threshold, columns), own[rows]

    def linked(i: int, others: np.ndarray) -> np.ndarray:
        hit = able[i, others - len(found)]
        if hit.any():
            hit[hit] = estimates(own[i], own[others[hit]]) >= threshold - ESTIMATE_SLACK
        return hit

    return [(rows[i], rows[j]) for i, j in forest(len(rows), linked, (np.arange(len(found)), columns))]


def _similar(sketches: np.ndarray, n: np.ndarray, one: np.ndarray, other: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the pairs of rows fit in size and reach the threshold less its slack by their estimate."""
    fit = np.minimum(n[one], n[other]) >= threshold * np.maximum(n[one], n[other]) - 1e-6
    at = np.flatnonzero(fit)
    for begin in range(0, len(at), 4096):
        part = at[begin : begin + 4096]
        fit[part] = estimates(sketches[one[part]], sketches[other[part]]) >= threshold - ESTIMATE_SLACK
    return fit


def _list_cells(threshold: float):
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "cell"):
            node, n = table["node"].to_numpy(), table["n_shingles"].to_numpy()
            sketches = padded(table["sketch"].to_pylist())
            cut = bounds(table["cell"].to_numpy())
            # Every member is first compared with the first one of its cell, all cells at once.
            first = np.repeat(cut[:-1], np.diff(cut))
            others = np.flatnonzero(np.arange(len(node)) > first)
            near = np.zeros(len(node), bool)
            near[others] = _similar(sketches, n, first[others], others, threshold)
            edges = [np.stack([node[first[near]], node[near]], 1)]
            apart = np.add.reduceat(np.r_[~near, False].astype(np.int64), cut[:-1]) if len(node) else np.zeros(0)
            for c in np.flatnonzero((apart > 1) & (np.diff(cut) > 2)):
                a, b = cut[c], cut[c + 1]
                found = np.array(_list_forest(sketches[a:b], n[a:b], near[a:b], threshold), np.int64).reshape(-1, 2)
                edges.append(node[a:b][found])
            if edges:
                e = np.concatenate(edges)
                yield pa.RecordBatch.from_arrays([pa.array(e[:, 0]), pa.array(e[:, 1])], schema=EDGE)

    return work


def _full_sets(size: int):
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            value, first = shingle_sets(batch["text"], size)
            yield pa.RecordBatch.from_pydict({
                "node": batch["doc_id"],
                "cluster": batch["cluster"],
                "shingles": pa.array([value[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary()),
            })

    return work


def _group_cells(percent: int):
    threshold = percent / 100

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "cell", rows=512):
            node = table["node"].to_numpy()
            sets = [np.frombuffer(s, np.uint64) for s in table["shingles"].to_pylist()]
            n = np.array([len(s) for s in sets])
            sketches = padded([(s[:RETAINED] >> np.uint64(32)).astype(np.uint32).tobytes() for s in sets])
            cut = bounds(table["cell"].to_numpy())
            edges = []
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                able, own, size = _candidates(sketches[a:b], n[a:b], threshold), sets[a:b], n[a:b]

                def linked(i: int, others: np.ndarray, able=able, own=own, size=size) -> np.ndarray:
                    hit = able[i, others]
                    who = others[hit]
                    if len(who):
                        rest = np.concatenate([own[j] for j in who])
                        at = np.minimum(np.searchsorted(own[i], rest), len(own[i]) - 1)
                        begin = np.cumsum(size[who]) - size[who]
                        shared = np.add.reduceat((own[i][at] == rest).astype(np.int64), begin)
                        hit[hit] = 100 * shared >= percent * (size[i] + size[who] - shared)
                    return hit

                found = np.array(forest(b - a, linked), np.int64).reshape(-1, 2)
                edges.append(node[a:b][found])
            e = np.concatenate(edges)
            yield pa.RecordBatch.from_arrays([pa.array(e[:, 0]), pa.array(e[:, 1])], schema=EDGE)

    return work


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, mark: str | None = None) -> DataFrame:
    """``docs`` (doc_id, text): doc_id, n_shingles, component_id and kept, one row per row of ``docs``.

    ``mark`` names a text column of ``docs`` that each row carries along, to tell rows of one id apart.
    """
    carried = [mark] if mark else []
    base = only(docs, "doc_id", "text")
    whole = stored(
        only(docs, "doc_id", "text", *carried).mapInArrow(
            _sketches(shingle),
            "doc_id long, " + "".join(f"`{c}` string, " for c in carried) + "n_shingles long, set_a long, set_b long, sketch binary, keys array<long>",
        ),
        "near-sketches",
    )
    same = ["n_shingles", "set_a", "set_b"]
    able = whole.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = stored(able.groupBy(*same).agg(F.min("doc_id").alias("node")), "near-classes")
    heads = (
        able.withColumnRenamed("doc_id", "node").dropDuplicates(["node", *same])
        .join(classes, [*same, "node"], "left_semi")
    )
    lists = heads.select("node", F.explode("keys").alias("key"))
    long_lists = lists.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    cells = chunked(lists, "key", "node", long_lists, LIST_CHUNK).select("cell", "node")
    candidates = by_cell(cells.join(heads.select("node", "n_shingles", "sketch"), "node")).mapInArrow(
        _list_cells(percent / 100), "a long, b long"
    )
    groups = stored(components(candidates, "near-groups").withColumnRenamed("component", "cluster"), "near-members")
    members = groups.withColumnRenamed("node", "doc_id")
    sets = stored(
        among(base, members, "doc_id").join(members.hint("merge"), "doc_id")
        .select("doc_id", "cluster", "text")
        .mapInArrow(_full_sets(shingle), "node long, cluster long, shingles binary"),
        "near-sets",
    )
    sizes = groups.groupBy("cluster").agg(F.count("*").alias("n"))
    links = by_cell(
        chunked(sets, "cluster", "node", sizes, GROUP_CHUNK).select("cell", "node", "shingles")
    ).mapInArrow(_group_cells(percent), "a long, b long")
    found = components(links, "near-links")
    named = classes.join(found, "node", "left").select(*same, F.coalesce("component", "node").alias("component"))
    return (
        whole.select("doc_id", *carried, *same)
        .join(named, same, "left")
        .select(
            "doc_id",
            *carried,
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
