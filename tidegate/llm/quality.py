"""Quality by a linear-chain conditional random field over the lines of a text.

Every line gets features of its own (kinds of characters, words, repetition in the line
and of the line) and those of its two neighbours. The field has two states, good and
bad; weights and transitions are fitted by maximum likelihood with a quadratic penalty,
every line of a labelled document carrying its document's label. For a document,
forward and backward passes give each line's marginal probability of being good, and
the average over the lines, weighted by their lengths, is the score.

The fit takes a bounded sample: the SAMPLE labelled documents with the least hash of
their id. Features and scores are computed for every whole text.

Defined cases: a null text or one without anything but white space scores 0; blank lines
have no weight; without any labelled row, or with one label only, every other text gets
the share of good labels (0.5 without labels); null labels teach nothing, of several
labels of one id the least counts; repeated rows are scored each; other columns are not
looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.shared import SPACE, Words, mix, offsets, pieces, windows

SAMPLE = 3000
PENALTY = 1e-3
STEPS = 250
_CLASS = np.zeros(256, np.int8)  # 0 other punctuation
_CLASS[list(b"abcdefghijklmnopqrstuvwxyz")] = 1
_CLASS[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")] = 2
_CLASS[list(b"0123456789")] = 3
_CLASS[128:] = 4
_CLASS[list(b".,;:?'\"-()")] = 5
_CLASS[SPACE] = 6
OWN = 16


def line_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features and lengths of all lines of the texts, and each text's first line."""
    words = Words(column, lower=True)
    raw, at = offsets(column)  # with its capitals, unlike the words
    docs = len(column)
    cuts = np.unique(np.concatenate([at[:-1][np.diff(at) > 0], np.flatnonzero(raw == 10) + 1]))
    cuts = cuts[cuts < len(raw)]
    if not len(cuts):
        return np.zeros((0, 3 * OWN)), np.zeros(0), np.zeros(docs + 1, np.int64)
    ends = np.append(cuts[1:], len(raw))
    first = np.searchsorted(cuts, at)
    doc = np.repeat(np.arange(docs), np.diff(first))
    kind = _CLASS[raw]
    solid = np.stack([np.add.reduceat((kind == k).astype(np.float64), cuts) for k in range(7)])
    length = ends - cuts - solid[6]
    part = solid[:6] / np.maximum(length, 1)
    # Words and their repetition.
    begin = np.searchsorted(words.start, cuts)
    number = np.diff(np.append(begin, len(words.start))).astype(np.float64)
    h = words.hashes()
    line_of = np.repeat(np.arange(len(cuts)), number.astype(np.int64))
    word_length = (words.end - words.start).astype(np.float64)
    long_words = np.bincount(line_of, word_length > 12, len(cuts))
    odd_ends = np.bincount(line_of, _CLASS[words.raw[words.end - 1]] == 0, len(cuts))
    lone = np.bincount(line_of, (word_length == 1) & (_CLASS[words.raw[words.start]] == 0), len(cuts))
    sequence = mix(np.bincount(line_of, minlength=len(cuts)).astype(np.uint64))
    if len(h):
        some = np.flatnonzero(number)
        sequence[some] += np.add.reduceat(mix(h), begin[some])
    repeated = _seen_before(sequence, doc)
    again = np.bincount(line_of, _seen_before(h, doc[line_of]), len(cuts))
    twice = np.zeros(len(h), bool)
    twice[1:] = (h[1:] == h[:-1]) & (line_of[1:] == line_of[:-1])
    runs = windows(h, 4) if len(h) >= 4 else h[:0]
    again_runs = np.zeros(len(cuts))
    if len(runs):
        inside = doc[line_of[: len(runs)]] == doc[line_of[3:]]
        again_runs = np.bincount(line_of[: len(runs)][inside], _seen_before(runs[inside], doc[line_of[: len(runs)][inside]]), len(cuts))
    per = np.maximum(number, 1)
    own = np.stack([
        *part, np.log1p(length), np.log1p(number), length / per / 10, long_words / per, odd_ends / per, lone / per,
        repeated.astype(np.float64), again / per, again_runs / per,
        np.bincount(line_of, twice, len(cuts)) / per,
    ], axis=1)
    before, behind = np.zeros_like(own), np.zeros_like(own)
    same = doc[1:] == doc[:-1]
    before[1:][same] = own[:-1][same]
    behind[:-1][same] = own[1:][same]
    return np.concatenate([own, before, behind], axis=1), length, first


def _seen_before(value: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether the same value stands earlier in the same text."""
    order = np.lexsort((np.arange(len(value)), value, doc))
    out = np.zeros(len(value), bool)
    same = (value[order][1:] == value[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    out[order[1:]] = same
    return out


@dataclass
class Field:
    """Weights of a fitted field; ``step[a, b]`` belongs to state a before state b."""

    mean: np.ndarray
    spread: np.ndarray
    weight: np.ndarray
    step: np.ndarray
    share: float

    def marginals(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        if not len(self.weight):
            return np.full(len(x), self.share)
        z = (x - self.mean) / self.spread
        return forward_backward(z @ self.weight[:-1] + self.weight[-1], self.step, first)[0]


def forward_backward(unary: np.ndarray, step: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of "good" for all lines, and the expected numbers of the four transitions.

    All chains go forward together, the longest first, so that step t concerns the
    chains that still have a line t.
    """
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    start, size = first[:-1][order], size[order]
    local = np.empty((len(unary), 2))
    good = 1 / (1 + np.exp(-np.clip(unary, -30, 30)))
    local[:, 0], local[:, 1] = 1 - good, good
    move = np.exp(step - step.max())
    ahead, back = local.copy(), np.full(local.shape, 0.5)
    most = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(most), side="left")  # chains with more than t lines
    if most:
        ahead[start[: active[0]]] /= ahead[start[: active[0]]].sum(1, keepdims=True)
    for t in range(1, most):
        here = start[: active[t]] + t
        now = ahead[here - 1] @ move * local[here]
        ahead[here] = now / now.sum(1, keepdims=True)
    for t in range(most - 2, -1, -1):
        here = start[: active[t + 1]] + t
        now = (back[here + 1] * local[here + 1]) @ move.T
        back[here] = now / now.sum(1, keepdims=True)
    both = ahead * back
    pairs = np.ones(len(unary), bool)
    pairs[first[1:][np.diff(first) > 0] - 1] = False
    i = np.flatnonzero(pairs)
    joint = ahead[i][:, :, None] * move * (local[i + 1] * back[i + 1])[:, None, :]
    joint /= joint.sum((1, 2), keepdims=True)
    return both[:, 1] / both.sum(1), joint.sum(0)


def fit(x: np.ndarray, first: np.ndarray, label: np.ndarray) -> Field:
    """``label`` by text; every line carries its text's label."""
    share = float(label.mean()) if len(label) else 0.5
    if not len(x) or share in (0.0, 1.0):
        return Field(np.zeros(0), np.zeros(0), np.zeros(0), np.zeros((2, 2)), share)
    mean, spread = x.mean(0), x.std(0) + 1e-6
    z = np.concatenate([(x - mean) / spread, np.ones((len(x), 1))], axis=1)
    y = np.repeat(label, np.diff(first)).astype(np.float64)
    stay = np.diff(first)[np.diff(first) > 0] - 1
    of = label[np.diff(first) > 0]
    seen = np.diag([float(stay[of == 0].sum()), float(stay[of == 1].sum())])
    at = np.zeros(z.shape[1] + 4)
    m, v = np.zeros_like(at), np.zeros_like(at)
    for t in range(1, STEPS + 1):
        p, moves = forward_backward(z @ at[:-4], at[-4:].reshape(2, 2), first)
        slope = np.concatenate([z.T @ (y - p), (seen - moves).ravel()]) / len(z) - PENALTY * at
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope * slope
        at = at + 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return Field(mean, spread, at[:-4], at[-4:].reshape(2, 2), share)


def _sampled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        x, _, first = line_features(batch["text"])
        yield pa.RecordBatch.from_pydict({
            "turn": batch["turn"], "good": batch["good"],
            "lines": pa.array([x[a:b].astype(np.float32).tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]),
        })


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Field:
    """From ``docs`` (doc_id, text) with a ``labels`` row (doc_id, quality)."""
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        (F.min("quality") > 0).cast("int").alias("good")
    )
    turn = F.xxhash64("doc_id", F.lit("quality"))
    chosen = (
        known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
        .withColumn("turn", turn).orderBy("turn", "doc_id").limit(sample)
    )
    rows = (
        docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
        .select("turn", "good", "text").mapInArrow(_sampled, "turn long, good int, lines binary")
        .toArrow().sort_by("turn")
    )
    parts = [np.frombuffer(b, np.float32).reshape(-1, 3 * OWN) for b in rows["lines"].to_pylist()]
    first = np.cumsum([0, *[len(p) for p in parts]])
    x = np.concatenate(parts).astype(np.float64) if parts else np.zeros((0, 3 * OWN))
    return fit(x, first, rows["good"].to_numpy())


def score(docs: DataFrame, labels: DataFrame, training: Column, sample: int = SAMPLE) -> DataFrame:
    """``docs`` (doc_id, text) with score: doc_id, score, one row per row."""
    field = learn(docs.filter(training), labels, sample)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            x, length, first = line_features(batch["text"])
            out = np.zeros(batch.num_rows)
            if len(x):
                good = field.marginals(x, first)
                some = np.flatnonzero(np.diff(first))
                total = np.add.reduceat(length, first[some])
                out[some] = np.where(total > 0, np.add.reduceat(good * length, first[some]) / np.maximum(total, 1), 0)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(np.clip(out, 0, 1))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, "doc_id long, score double")
