"""Language identification as inference of a multilingual mixture.

Model: for every language the probabilities of letter trigrams (a letter with its two
neighbours, where anything but a letter counts as one mark), hashed to GRAMS buckets and
counted over all training texts.

Inference: a document is a mixture of languages. Expectation-maximisation estimates the
proportions from the trigrams' likelihoods, first over all languages. Then nested sets,
in the order of those proportions, are fitted again, and the set with the best
likelihood less PENALTY / 2 * log(n) for every further language is taken. No set is likelier
than the mixture of all, so a text's sets grow until that likelihood less the penalty of
the next size no longer exceeds the best found; there is no other limit to them. The language with the largest proportion in it is the
prediction; the score is that proportion times the posterior of the language among all
when only one is allowed (likelihoods taken per letter, as trigrams overlap threefold).

Defined cases: a text that is null or has no letter is ``und`` with score 0, and so is
every text when nothing can be learned; rows with null text or null language teach
nothing; ties go to the first language by name; repeated rows count each; other columns
are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.shared import bounds, mix, pieces

GRAMS = 1 << 16
SMOOTHING = 0.5
PENALTY = 8.0
ROUNDS = 8
UNKNOWN = "und"
_LETTER: list[np.ndarray] = []


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigram around every letter, and the text it is from."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    lower = [(t or "").lower() for t in texts]
    codes = np.frombuffer(("\0" + "\0".join(lower) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(_LETTER[0][codes], codes, 0).astype(np.uint64)
    at = np.flatnonzero(codes)
    k = codes[at - 1] + (codes[at] << np.uint64(21)) + (codes[at + 1] << np.uint64(42))
    ends = np.cumsum([len(t) + 1 for t in lower])
    return (mix(k) >> np.uint64(48)).astype(np.int64), np.searchsorted(ends, at - 1, side="right")


def _counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in pieces(batches):
        gram, doc = trigrams(batch["text"].to_pylist())
        names = batch["lang"].to_pylist()
        index = {n: i for i, n in enumerate(dict.fromkeys(names))}
        lang = np.array([index[n] for n in names])[doc]
        both = np.bincount(lang * GRAMS + gram, minlength=len(index) * GRAMS).reshape(len(index), GRAMS)
        for n, i in index.items():
            totals[n] = totals.get(n, 0) + both[i]
    for n, c in totals.items():
        some = np.flatnonzero(c)
        yield pa.RecordBatch.from_pydict({"lang": [n] * len(some), "gram": some, "n": c[some]})


class Languages:
    """Trigram probabilities by language."""

    def __init__(self, names: list[str], counts: np.ndarray):
        self.names = names
        counts = counts + SMOOTHING
        self.p = (counts / counts.sum(1, keepdims=True)).T.copy()  # by gram, then language


def learn(docs: DataFrame) -> Languages | None:
    """From all rows of ``docs`` (text, lang). The table of counts has at most GRAMS rows per language."""
    rows = (
        docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang")
        .mapInArrow(_counts, "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
        .toArrow()
    )
    if not rows.num_rows:
        return None
    names = sorted(set(rows["lang"].to_pylist()))
    table = np.zeros((len(names), GRAMS))
    table[np.searchsorted(names, rows["lang"].to_pylist()), rows["gram"].to_numpy()] = rows["n"].to_numpy()
    return Languages(names, table)


def _fit(p: np.ndarray, count: np.ndarray, starts: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions after ROUNDS of expectation-maximisation, and their log-likelihoods, per document."""
    sizes = np.diff(np.append(starts, len(count)))
    n = np.add.reduceat(count, starts)[:, None]
    for _ in range(ROUNDS):
        part = p * np.repeat(shares, sizes, axis=0)
        part *= (count / part.sum(1))[:, None]
        shares = np.add.reduceat(part, starts, axis=0) / n
    whole = np.log((p * np.repeat(shares, sizes, axis=0)).sum(1))
    return shares, np.add.reduceat(count * whole, starts)


def mixtures(model: Languages, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the texts that have letters: their places, the proportions of their language sets, and the posterior of one language."""
    gram, doc = trigrams(texts)
    languages = len(model.names)
    if not len(gram):
        return np.zeros(0, np.int64), np.zeros((0, languages)), np.zeros(0)
    key = np.sort(doc * GRAMS + gram)
    cut = bounds(key)
    key, count = key[cut[:-1]], np.diff(cut).astype(np.float64)
    who, gram = key // GRAMS, key % GRAMS
    cut = bounds(who)
    starts, there = cut[:-1], who[cut[:-1]]
    p = model.p[gram]
    price = PENALTY / 2 * np.log(np.add.reduceat(count, starts))
    alone = np.add.reduceat(np.log(p) * count[:, None], starts, axis=0)
    top = alone.argmax(1)
    chosen = np.zeros(alone.shape)
    chosen[np.arange(len(top)), top] = 1
    value = alone.max(1)
    shares, most = _fit(p, count, starts, np.full(alone.shape, 1 / languages))
    order = np.argsort(-shares, axis=1, kind="stable")
    for k in range(2, languages + 1):
        some = np.flatnonzero(most - (k - 1) * price > value)
        if not len(some):
            break
        allowed = np.zeros((len(some), languages))
        np.put_along_axis(allowed, order[some, :k], np.take_along_axis(shares[some], order[some, :k], 1), 1)
        rows = np.concatenate([np.arange(cut[i], cut[i + 1]) for i in some])
        sizes = np.diff(cut)[some]
        again, likely = _fit(p[rows], count[rows], np.cumsum(sizes) - sizes, allowed / allowed.sum(1, keepdims=True))
        gain = likely - (k - 1) * price[some]
        better = gain > value[some]
        value[some[better]], chosen[some[better]] = gain[better], again[better]
    posterior = np.exp((alone - alone.max(1, keepdims=True)) / 3)
    return there, chosen, posterior.max(1) / posterior.sum(1)


def infer(model: Languages, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and score of every text."""
    out, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
    there, chosen, posterior = mixtures(model, texts)
    for d, best in zip(there, chosen.argmax(1), strict=True):
        out[d] = model.names[best]
    score[there] = np.minimum(chosen.max(1, initial=0) * posterior, 1)
    return out, score


def identify(docs: DataFrame, training: Column) -> DataFrame:
    """``docs`` with lang_pred and score; learned from the rows of ``docs`` where ``training`` holds."""
    model = learn(docs.filter(training))
    named = docs.drop("lang_pred", "score")
    names = named.columns

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts = batch["text"].to_pylist()
            lang, score = infer(model, texts) if model else ([UNKNOWN] * len(texts), np.zeros(len(texts)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang), pa.array(score)], [*names, "lang_pred", "score"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in named.schema.fields)
    return named.mapInArrow(work, f"{kinds}, lang_pred string, score double")


def fold(folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(F.col("doc_id").cast("string")) % folds
