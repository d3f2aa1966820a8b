"""Near-duplicate vectors through a pivot-permutation index.

A vector is described by its NEAREST nearest of PIVOTS reference points. Inverted
lists are keyed by sets of SHARED pivots, so the members of a list already share that
many; each list is dealt over cells of bounded size in which every pair meets. In a
cell, pairs are verified by cosine in double precision, and counted in one list only:
the one whose pivots are the first that the two have in common. What leaves a cell
is, per vector, its number of links, and a spanning forest of the links.

The reference points come from a bounded, documented sample (the WALKED vectors with
the least hash of their id); every vector is indexed. The sample is walked in the order
of the hash, and a vector too close to a chosen one is skipped: else a large group of
near copies would own so many points that its members' nearest ones differ by noise
alone. Too close is the least of the cosines in APART that leaves PIVOTS points, one of
eight of those walked. At cosine 0.95 in 64 dimensions a pair shares three of eight
pivots out of 512 with probability 0.99, inside a large group with 0.998 or more, and
the probability rises quickly with the cosine.

Bit-equal vectors form a class, which is indexed once: its members are linked with
each other, and with all members of the classes it is linked with.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components link with nothing; vectors of different lengths link with nothing either;
repeated rows of one id and vector count as one vector and each get its result; rows
without id get no links and component null; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.components import components
from tidegate.llm.near_dedup import forest
from tidegate.llm.shared import (
    bounds, by_cell, chunked, joined, list_matrix, list_rows, mix, only, stored, whole_groups,
)

PIVOTS = 512
WALKED = 8 * PIVOTS
APART = (0.6, 0.7, 0.8)
NEAREST = 8
SHARED = 3
CHUNK = 1024


def usable(vector: Column) -> Column:
    """Whether a vector takes part: some components, all finite, not all zero."""
    doubles = vector.cast("array<double>")
    finite = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(doubles, lambda x: x != 0), F.lit(False))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Directions as rows of doubles; shorter vectors are filled up with zeros."""
    x = list_matrix(column).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def spread_out(x: np.ndarray) -> np.ndarray:
    """The pivots among the directions ``x``: in order, without those too close to one before."""
    for cosine in APART:
        chosen, n = np.empty((PIVOTS, x.shape[1])), 0
        for row in x:
            if n == PIVOTS:
                break
            if not n or (chosen[:n] @ row).max() < cosine:
                chosen[n] = row
                n += 1
        if n * WALKED >= PIVOTS * len(x):
            break
    return chosen[:n]


def _describe(pivots: dict[int, np.ndarray]):
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch["embedding"].value_lengths().to_numpy(zero_copy_only=False)
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                if not part.num_rows:
                    continue
                near = matrix(part["embedding"]) @ pivots[int(size)].T
                take = min(NEAREST, near.shape[1])
                top = np.sort(np.argsort(-near, axis=1, kind="stable")[:, :take], axis=1)
                sets = list(combinations(range(take), min(SHARED, take)))
                keys = np.full((part.num_rows, len(sets)), size, np.uint64)
                for k in range(min(SHARED, take)):
                    keys = joined(keys, top[:, [s[k] for s in sets]].astype(np.uint64))
                last = top[:, [v[-1] for v in sets]]
                yield pa.RecordBatch.from_pydict({
                    "node": part["node"],
                    "members": part["members"],
                    "embedding": part["embedding"],
                    "nearest": list_rows(top, pa.int32()),
                    "keys": list_rows(mix(keys).view(np.int64), pa.int64()),
                    "lasts": list_rows(last, pa.int32()),
                })

    return work


def _verify(cosine: float):
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "cell"):
            node, members = table["node"].to_numpy(), table["members"].to_numpy()
            side, last = table["side"].to_numpy(), table["last"].to_numpy()
            x, near = matrix(table["embedding"]), list_matrix(table["nearest"], -1)
            diagonal = table["diagonal"].to_numpy()
            cut = bounds(table["cell"].to_numpy())
            out = []
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                if b - a < 2:
                    continue
                linked = x[a:b] @ x[a:b].T >= cosine
                if not diagonal[a]:
                    linked &= side[a:b, None] != side[None, a:b]
                np.fill_diagonal(linked, False)
                if not linked.any():
                    continue
                # Pivots up to the last of this list that both have: no more than the list's own, or it is not the first.
                own = near[a:b]
                low = own[:, :, None] == np.unique(own[(own >= 0) & (own <= last[a])])
                has = low.any(1).astype(np.float32)
                mine = linked & (has @ has.T == min(SHARED, int((near[a] >= 0).sum())))
                links = mine @ members[a:b]
                edges = forest(b - a, lambda i, others, linked=linked: linked[i, others])
                out += [(node[a + i], node[a + j], 0) for i, j in edges]
                out += [(k, k, c) for k, c in zip(node[a:b], links.tolist(), strict=True) if c]
            if out:
                one, two, count = zip(*out, strict=True)
                yield pa.RecordBatch.from_pydict({
                    "a": pa.array(one, pa.int64()), "b": pa.array(two, pa.int64()), "links": pa.array(count, pa.int64()),
                })

    return work


def near_vectors(vectors: DataFrame, cosine: float = 0.95) -> DataFrame:
    """``vectors`` (vec_id, embedding): vec_id, n_links, component_id, kept, one row per row."""
    base = only(vectors, "vec_id", "embedding")
    kind = base.schema["embedding"].dataType.simpleString()
    one_zero = F.transform("embedding", lambda x: F.when(x == 0, F.abs(x)).otherwise(x)).cast(kind)
    able = base.filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    classes = stored(
        able.select("vec_id", one_zero.alias("embedding"))
        .distinct()
        .groupBy("embedding")
        .agg(F.min("vec_id").alias("node"), F.count("*").alias("members")),
        "vector-classes",
    )
    sizes = [size for (size,) in classes.select(F.size("embedding")).distinct().collect()]
    pivots = {}
    for size in sizes:
        rows = (
            classes.filter(F.size("embedding") == size)
            .orderBy(F.xxhash64("node", F.lit("pivot")), "node").limit(WALKED).select("embedding").toArrow()
        )
        pivots[size] = spread_out(matrix(rows["embedding"]))
    index = stored(
        classes.mapInArrow(
            _describe(pivots),
            f"node long, members long, embedding {kind}, nearest array<int>, keys array<long>, lasts array<int>",
        ),
        "vector-index",
    )
    lists = index.select("node", F.explode(F.arrays_zip("keys", "lasts")).alias("k")).select(
        "node", F.col("k.keys").alias("key"), F.col("k.lasts").alias("last")
    )
    several = lists.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    cells = chunked(lists, "key", "node", several, CHUNK).select("cell", "node", "side", "diagonal", "last")
    found = stored(
        by_cell(cells.join(index.select("node", "members", "embedding", "nearest"), "node")).mapInArrow(
            _verify(cosine), "a long, b long, links long"
        ),
        "vector-links",
    )
    links = found.filter("links > 0").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    named = components(found.filter("links = 0").select("a", "b"), "vector-components")
    judged = (
        classes.join(links, "node", "left")
        .join(named, "node", "left")
        .select(
            "embedding",
            (F.coalesce("links", F.lit(0)) + F.col("members") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component"),
        )
    )
    return (
        base.select("vec_id", F.when(
            usable(F.col("embedding")) & F.col("vec_id").isNotNull(), one_zero).alias("_vector"))
        .join(judged.withColumnRenamed("embedding", "_vector"), "_vector", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )
