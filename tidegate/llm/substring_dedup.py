"""Substring dedup by level-wise doubling of repeated windows.

Level one looks at windows of half the length. Of these only local minima of a
hash are taken (a window is an anchor if its hash is the least of some run of
``length / 2 + 1`` neighbouring starts), so every full window contains an anchor,
equal full windows contain equal anchors, and a small share of all positions is
shuffled. Anchors that occur in one document alone are dropped. Level two extends
the survivors: full windows are hashed only where they contain a surviving anchor,
and those that also start in a document with a smaller id mark their words for
removal. Doubling further finds no new word, since every longer repeated window is
covered by repeated windows of the full length.

Documents with one and the same sequence of words are handled first by the digest
of the whole: only the first of them takes part in the levels, the others are
removed as a whole if they have a window at all.

Defined cases: a null or empty text has no words; a document shorter than a window
keeps everything; repetition inside one document (or between rows of one id) removes
nothing; a row without id keeps its words and is nobody's source; repeated rows each
get the same result; other columns are not looked at. Windows are compared by 96 bits
of hash, whole documents by SHA-256.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.shared import Words, among, only, pieces, stored, windows

EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def sha_of_words(text: Column) -> Column:
    """The hash of a text's words that ``remove_repeated`` gives as ``sha``."""
    return F.sha2(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")), 256)


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every run of ``width`` values."""
    have = 1
    while have < width:
        add = min(have, width - have)
        x = pick(x[:-add], x[add:])
        have += add
    return x


def _texts(column: pa.Array) -> list[bytes]:
    return column.fill_null("").cast(pa.binary()).to_pylist()


def _lists(values: np.ndarray, doc: np.ndarray, docs: int, kind: pa.DataType) -> pa.Array:
    """One list per document; ``doc`` is sorted."""
    ends = np.searchsorted(doc, np.arange(docs + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values).cast(kind))


def _doc_of(words: Words, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The starts whose window of ``length`` words stays inside its document, and their documents."""
    doc = np.searchsorted(words.first, starts, side="right") - 1
    inside = starts + length <= words.first[doc + 1]
    return starts[inside], doc[inside]


def _first_level(length: int):
    half = length // 2
    spread = length - half + 1

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            words = Words(batch["text"])
            n = batch.num_rows
            h = windows(words.hashes(), half)
            starts = doc = np.zeros(0, np.int64)
            if len(h) >= spread:
                lows = _slide(h, spread, np.minimum)
                # A run of starts belongs to one document if its last window does.
                run, _ = _doc_of(words, np.arange(len(lows)), length)
                own = np.zeros(len(lows), bool)
                own[run] = True
                floor = np.where(own, lows, 0)
                edge = np.zeros(spread - 1, np.uint64)
                best = _slide(np.concatenate([edge, floor, edge]), spread, np.maximum)
                starts, doc = _doc_of(words, np.flatnonzero((best == h) & (best > 0)), half)
                # One place of each anchor in a document will do.
                order = np.lexsort((starts, h[starts], doc))
                new = np.ones(len(order), bool)
                new[1:] = (h[starts][order][1:] != h[starts][order][:-1]) | (doc[order][1:] != doc[order][:-1])
                keep = np.sort(order[new])
                starts, doc = starts[keep], doc[keep]
            local = starts - words.first[doc] if len(doc) else starts
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch["doc_id"].cast(pa.int64()),
                "n_words": pa.array(np.diff(words.first), pa.int64()),
                "sha": pa.array([hashlib.sha256(b" ".join(t.split())).hexdigest() for t in _texts(batch["text"])]),
                "anchor": _lists(h[starts].view(np.int64) if len(starts) else local, doc, n, pa.int64()),
                "at": _lists(local, doc, n, pa.int32()),
            })

    return work


def _second_level(length: int):
    half = length // 2
    spread = length - half + 1

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            words = Words(batch["text"])
            n = batch.num_rows
            at = batch["at"]
            anchors = at.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            anchors += words.first[np.repeat(np.arange(n), at.value_lengths().to_numpy(zero_copy_only=False))]
            one = words.hashes()
            h = windows(one, half)
            ha, hb = windows(one, length), windows(words.hashes(1), length)
            starts, doc = _doc_of(words, np.arange(len(ha)), length)
            # Only windows whose own least half-length window survived.
            lows = _slide(h, spread, np.minimum) if len(ha) else h
            alive = np.isin(lows[starts], h[anchors[anchors < len(h)]])
            starts, doc = starts[alive], doc[alive]
            # One row per document and distinct window; "which" leads from a start to its window.
            order = np.lexsort((hb[starts], ha[starts], doc))
            a, b, d = ha[starts][order], hb[starts][order], doc[order]
            new = np.ones(len(a), bool)
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (d[1:] != d[:-1])
            number = np.cumsum(new) - 1
            first_of = np.searchsorted(d[new], np.arange(n))
            which = np.empty(len(a), np.int64)
            which[order] = number - first_of[d]
            sha = [hashlib.sha256(b" ".join(t.split())) for t in _texts(batch["text"])]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch["doc_id"],
                "tag": pa.array([int.from_bytes(x.digest()[:4]) >> 1 for x in sha], pa.int64()),
                "sha": pa.array([x.hexdigest() for x in sha]),
                "text": batch["text"],
                "window_a": _lists(a[new].view(np.int64), d[new], n, pa.int64()),
                "window_b": _lists((b[new] >> np.uint64(33)).astype(np.int32), d[new], n, pa.int32()),
                "start": _lists(starts - words.first[doc], doc, n, pa.int32()),
                "which": _lists(which, doc, n, pa.int32()),
            })

    return work


def _remove(length: int):
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"doc_id": [], "sha": [], "n_removed": [], "kept": [], "kept_sha256": []}
            texts = _texts(batch["text"])
            for i, text in enumerate(texts):
                words = text.split()
                start = np.asarray(batch["start"][i].values)
                which = np.asarray(batch["which"][i].values)
                start = start[np.isin(which, np.asarray(batch["hit"][i].values))]
                marks = np.zeros(len(words) + length + 1, np.int64)
                np.add.at(marks, start, 1)
                np.add.at(marks, start + length, -1)
                gone = np.cumsum(marks)[: len(words)] > 0
                kept = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])
                out["doc_id"].append(batch["doc_id"][i].as_py())
                out["sha"].append(batch["sha"][i].as_py())
                out["n_removed"].append(int(gone.sum()))
                out["kept"].append(kept.decode())
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("doc_id", pa.int64()), ("sha", pa.string()), ("n_removed", pa.int64()), ("kept", pa.string()),
                ("kept_sha256", pa.string())]))

    return work


def remove_repeated(docs: DataFrame, length: int = 50) -> DataFrame:
    """``docs`` (doc_id, text): doc_id, sha (of the words), n_words, n_removed, kept_sha256, and kept (null where nothing was removed)."""
    base = only(docs, "doc_id", "text")
    whole = stored(
        base.mapInArrow(
            _first_level(length),
            "doc_id long, n_words long, sha string, anchor array<long>, at array<int>",
        ),
        "substring-anchors",
    )
    able = whole.filter((F.col("n_words") >= length) & F.col("doc_id").isNotNull())
    firsts = able.groupBy("sha").agg(F.min("doc_id").alias("first_id"))
    copies = stored(
        able.select("doc_id", "sha").join(firsts, "sha").filter(F.col("doc_id") > F.col("first_id"))
        .select("doc_id", "sha").distinct(),
        "substring-copies",
    )
    # Copies go before their anchors are dealt out, so a text with very many copies has each anchor once.
    originals = able.join(copies, ["doc_id", "sha"], "left_anti")
    anchors = originals.select("doc_id", F.explode(F.arrays_zip("anchor", "at")).alias("a")).select("doc_id", "a.*")
    several = (
        anchors.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        .filter("low < high").select("anchor")
    )
    survivors = stored(
        anchors.join(several, "anchor").groupBy("doc_id").agg(F.collect_list("at").alias("at")),
        "substring-survivors",
    )
    suspects = stored(
        among(base, survivors, "doc_id").join(survivors.hint("merge"), "doc_id").mapInArrow(
            _second_level(length),
            "doc_id long, tag long, sha string, text string, window_a array<long>, window_b array<int>,"
            " start array<int>, which array<int>",
        ),
        "substring-windows",
    )
    # The place of a window among its document's, and in the upper half a mark of the document's text.
    place = (F.shiftleft("tag", 32) + F.col("i")).alias("place")
    full = suspects.select(
        "doc_id", "tag", F.posexplode(F.arrays_zip("window_a", "window_b")).alias("i", "w")
    ).select("doc_id", place, "w.window_a", "w.window_b")
    repeated = (
        full.groupBy("window_a", "window_b")
        .agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
        .filter("first_id < last_id")
        .drop("last_id")
    )
    hits = (
        full.join(repeated, ["window_a", "window_b"])
        .filter(F.col("doc_id") > F.col("first_id"))
        .groupBy("doc_id", F.shiftright("place", 32).cast("int").alias("mark"))
        .agg(F.collect_set(F.col("place").bitwiseAND(F.lit(2**32 - 1)).cast("int")).alias("hit"))
    )
    cut = (
        suspects.select("doc_id", F.col("tag").cast("int").alias("mark"), "sha", "text", "start", "which")
        .join(hits, ["doc_id", "mark"])
        .mapInArrow(_remove(length), "doc_id long, sha string, n_removed long, kept string, kept_sha256 string")
        .dropDuplicates(["doc_id", "sha"])
    )
    return (
        whole.select("doc_id", "n_words", "sha")
        .join(copies.withColumn("copy", F.lit(True)), ["doc_id", "sha"], "left")
        .join(cut, ["doc_id", "sha"], "left")
        .select(
            "doc_id",
            "sha",
            "n_words",
            F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
            F.when(F.col("copy"), F.lit(EMPTY_SHA)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
            F.when(F.col("copy"), F.lit("")).otherwise(F.col("kept")).alias("kept"),
        )
    )
