"""Approximate nearest neighbours by inner product: a forest of random-projection trees.

Largest inner product becomes nearness by one more component, sqrt(M^2 - |x|^2), with M
the largest norm; queries have 0 there. TREES complete binary trees of DEPTH levels are
fitted on a bounded sample (the SAMPLE vectors with the least hash of their id): every
node splits its part of the sample at the median of the projection on the difference of
two of its vectors. Every vector is put into a leaf of every tree.

The vectors are dealt by hash over shards of about SHARD rows, the queries over blocks;
a cell is one shard with one block, so memory is bounded and any cell can be redone
alone. In a cell, one priority queue holds the nodes of all trees; a leaf's place in it
is the worst margin by which its path leaves the query's side. Leaves are taken in that
order until SHARE of the shard (k + 1 rows at least) has been met. A margin is also a bound:
behind it the distance is at least the margin, so the inner product is at most
(|q|^2 + M^2 - margin^2) / 2. Once the first FIRST of the queue have given k scores, candidates whose
margin in any tree leaves them no better score are dropped; these are never among the best. The
rest alone is reranked by inner product in double precision. The best of all shards are
merged per query.

Structureless vectors need so large a share: at 64 independent dimensions the twentieth
neighbour is hardly nearer than the rest. With the values here recall at 20 is about
0.95; clustered vectors need far less.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components
take no part; vectors of another length are no candidates of a query; a row with the
query's own id is no candidate; repeated rows of one id and vector count once; rows
without id take no part; with fewer candidates than ``k`` all are returned; equal scores
go by the smaller id; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.embedding_dedup import usable
from tidegate.llm.shared import bounds, by_cell, list_matrix, only, whole_groups

TREES = 16
DEPTH = 8
SAMPLE = 16_384
SHARD = 8192
QUERY_BLOCK = 1024
SHARE = 0.6
FIRST = 0.05


class Forest:
    """Complete trees: node i of a level has the children 2 i and 2 i + 1 of the next."""

    def __init__(self, sample: np.ndarray, norm: float, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.norm = norm
        x = self.raised(sample)
        self.planes = [np.zeros((TREES, 2**d, x.shape[1])) for d in range(DEPTH)]
        self.cuts = [np.zeros((TREES, 2**d)) for d in range(DEPTH)]
        for t in range(TREES):
            parts = [np.arange(len(x))]
            for d in range(DEPTH):
                below = []
                for i, part in enumerate(parts):
                    pick = rng.choice(part, 2) if len(part) else rng.choice(len(x), 2)
                    plane = x[pick[0]] - x[pick[1]]
                    if not plane.any():
                        plane = rng.normal(size=x.shape[1])
                    plane /= np.sqrt((plane * plane).sum())
                    along = x[part] @ plane
                    cut = float(np.median(along)) if len(part) else 0.0
                    self.planes[d][t, i], self.cuts[d][t, i] = plane, cut
                    below += [part[along <= cut], part[along > cut]]
                parts = below

    def raised(self, x: np.ndarray) -> np.ndarray:
        """With the component that makes all vectors equally long."""
        rest = np.sqrt(np.maximum(self.norm**2 - (x * x).sum(1), 0))
        return np.concatenate([x, rest[:, None]], axis=1)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every vector in every tree."""
        x = self.raised(x)
        out = np.zeros((TREES, len(x)), np.int64)
        for t in range(TREES):
            node = out[t]
            for d in range(DEPTH):
                along = np.einsum("ij,ij->i", x, self.planes[d][t][node])
                node *= 2
                node += along > self.cuts[d][t][node // 2]
        return out

    def order(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every query the place of every tree's leaves in the shared queue, and their margins."""
        q = np.concatenate([q, np.zeros((len(q), 1))], axis=1)
        far = np.zeros((len(q), TREES, 1))
        for d in range(DEPTH):
            margin = np.einsum("qj,tij->qti", q, self.planes[d], optimize=True) - self.cuts[d]
            below = np.stack([np.maximum(far, margin), np.maximum(far, -margin)], axis=3)
            far = below.reshape(len(q), TREES, -1)
        flat = far.reshape(len(q), -1)
        place = np.empty(flat.shape, np.int32)
        np.put_along_axis(place, np.argsort(flat, axis=1, kind="stable"), np.arange(flat.shape[1], dtype=np.int32)[None], 1)
        return place.reshape(far.shape), far

    def passed(self, places: np.ndarray, margins: np.ndarray, leaf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every query the first and the last place at which the queue comes to each vector, and the margin at every place."""
        flat = places.reshape(len(places), -1)
        along = np.empty(flat.shape)
        np.put_along_axis(along, flat, margins.reshape(flat.shape), 1)
        # Places fit two bytes and the queries lie side by side, so all trees are passed over cheaply.
        place = np.ascontiguousarray(places.transpose(1, 2, 0).astype(np.min_scalar_type(flat.shape[1] - 1)))
        first = place[0].take(leaf[0], axis=0)
        last = first.copy()
        for t in range(1, TREES):
            at = place[t].take(leaf[t], axis=0)
            np.minimum(first, at, out=first)
            np.maximum(last, at, out=last)
        return np.ascontiguousarray(first.T), np.ascontiguousarray(last.T), along


def best(x: np.ndarray, ids: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and scores of the k largest inner products; the sum runs from the first component to the last."""
    rough = x @ q
    if len(rough) > k:
        least = np.partition(rough, len(rough) - k)[len(rough) - k]
        rows = np.flatnonzero(rough >= least - 1e-9 * (1 + np.abs(rough).max()))
    else:
        rows = np.arange(len(rough))
    score = np.cumsum(x[rows] * q, axis=1)[:, -1]
    order = np.lexsort((ids[rows], -score))[:k]
    return rows[order], score[order]


def promising(
    x: np.ndarray, q: np.ndarray, met: np.ndarray, same: np.ndarray, margins: np.ndarray, budget: int, k: int, norm: float
) -> np.ndarray:
    """Rows among the ``budget`` first met that may be among the k best; ``margins`` has one row per tree."""
    taken = np.flatnonzero((met <= np.partition(met, budget - 1)[budget - 1]) & ~same)
    first = min(len(taken), max(4 * k, int(FIRST * len(x))))
    if first <= k or first == len(taken):
        return taken
    early = taken[np.argpartition(met[taken], first - 1)[:first]]
    known = np.partition(x[early] @ q, first - k)[first - k]
    most = (q @ q + norm**2 - margins[:, taken].max(0) ** 2) / 2
    return taken[most >= known - 1e-9 * (1 + abs(known) + norm**2)]


def _search(forests: dict[int, Forest], k: int):
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "cell", rows=1):
            cut = bounds(table["cell"].to_numpy())
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                cell = table.slice(a, b - a)
                asks = cell["asks"].to_numpy()
                sides = [cell.filter(pa.array(asks == s)) for s in (False, True)]
                if not sides[0].num_rows or not sides[1].num_rows:
                    continue
                (x, ids), (q, own) = [(list_matrix(s["embedding"]).astype(np.float64), s["vec_id"].to_numpy()) for s in sides]
                forest = forests[x.shape[1]]
                leaf = forest.leaves(x)
                budget = min(len(x), max(k + 1, int(np.ceil(SHARE * len(x)))))
                out: list[tuple] = []
                for begin in range(0, len(q), 64):
                    met, last, along = forest.passed(*forest.order(q[begin : begin + 64]), leaf)
                    for j, i in enumerate(range(begin, begin + len(met))):
                        # A vector's widest margin is the one at its last place.
                        widest = along[j][last[j]][None]
                        taken = promising(x, q[i], met[j], own[i] == ids, widest, budget, k, forest.norm)
                        rows, score = best(x[taken], ids[taken], q[i], k)
                        out.append((np.full(len(rows), own[i]), ids[taken][rows], score))
                one, two, score = (np.concatenate(c) for c in zip(*out, strict=True))
                yield pa.RecordBatch.from_pydict({"query_id": one, "vec_id": two, "score": score})

    return work


def nearest(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for the rows of ``vectors`` where ``is_query`` holds."""
    named = vectors.select("vec_id", "embedding", F.coalesce(is_query, F.lit(False)).alias("asks"))
    able = named.filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).distinct()
    size = F.size("embedding")
    doubles = F.col("embedding").cast("array<double>")
    norm = F.sqrt(F.aggregate(doubles, F.lit(0.0), lambda s, x: s + x * x))
    # One row per vector length.
    facts = able.groupBy(size.alias("size")).agg(
        F.count("*").alias("n"), F.sum(F.col("asks").cast("long")).alias("asking"), F.max(norm).alias("norm")
    ).collect()
    forests, shards, blocks = {}, F.lit(1), F.lit(1)
    for f in facts:
        sample = able.filter(size == f["size"]).orderBy(F.xxhash64("vec_id", F.lit("sample")), "vec_id").limit(SAMPLE)
        forests[f["size"]] = Forest(list_matrix(only(sample, "embedding").toArrow()["embedding"]).astype(np.float64), f["norm"])
        shards = F.when(size == f["size"], F.lit(-(-f["n"] // SHARD))).otherwise(shards)
        blocks = F.when(size == f["size"], F.lit(max(1, -(-f["asking"] // QUERY_BLOCK)))).otherwise(blocks)
    dealt = able.withColumn("shards", shards.cast("long")).withColumn("blocks", blocks.cast("long"))
    shard = F.pmod(F.xxhash64("vec_id", F.lit("shard")), F.col("shards"))
    block = F.pmod(F.xxhash64("vec_id", F.lit("block")), F.col("blocks"))
    zero = F.lit(0).cast("long")
    rows = dealt.withColumn("asks", F.lit(False)).withColumn("shard", shard).withColumn(
        "block", F.explode(F.sequence(zero, F.col("blocks") - 1))
    )
    asks = dealt.filter("asks").withColumn("block", block).withColumn(
        "shard", F.explode(F.sequence(zero, F.col("shards") - 1))
    ).select(rows.columns)
    cells = rows.union(asks).select(F.xxhash64(size, "shard", "block").alias("cell"), "vec_id", "embedding", "asks")
    found = by_cell(cells).mapInArrow(_search(forests, k), "query_id long, vec_id long, score double")
    first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
