r"""Spelling variants: words one edit apart, found by dense comparison of tiles of padded code-point matrices.

1. Words. Maximal runs ``[A-Za-zÀ-ÿ]+`` of every whole text, A-Z lower-cased, are counted in the
   task that reads them (dropping a code point from one run in ``rare`` is the contract's rule of planted errors),
   then over the cluster. Words of at least ``least_length`` code points and ``least_count`` occurrences form the vocabulary.
2. Blocks. Of two words one edit apart, the longer of length m, all code points outside one window of
   ceil(m / WINDOWS) code points (two at least) agree. So a word joins, for m its own length and its length
   plus one, the block of each window: the words with the same code points before and after it. Every
   pair at one edit shares a block; nothing is compared across the vocabulary. A window of two code points bounds its
   block by the alphabet: at most 90 * 90 + 90 words. Blocks of wider windows (words over 16 long) are counted and cut
   into chunks, each pair of which is a cell.
3. Tiles. A block's words are a matrix of code points, padded at the end for the common prefixes and at the start for
   the common suffixes, and every row of a tile is compared with every row of another at once. Prefix plus suffix
   reaching m - 1 is a single edit. A pair that several windows show counts in the one where its words first differ.
   A tile holds at most TILE code-point comparisons. Only per-word counts and the best neighbour leave it, never pairs.
4. Forms. A word's form is its neighbour of largest count (ties: the smallest word) if that is at least
   ``ratio`` times its own. Counts grow along the forms, so they end; roots are found by doubling the steps.

Defined cases: a null, empty or letterless text has no words; a null doc_id reads as an empty one in the rule
of planted errors; repeated rows count each time; words of any length are handled, whole; without words of the
required length and count there are no rows; other columns are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.shared import bounds, chunked, only, shuffle_count, stored, whole_groups

WINDOWS = 8
NARROW = 16  # longest m whose windows are two code points wide
CHUNK = 512
TILE = 1 << 22
HELD_WORDS = 1 << 18
SLICE = 1 << 22

# In UTF-8 the letters U+00C0 to U+00FF are C3 80 to C3 BF, and C3 begins no other character's rest.
RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
LETTER = re.compile(rb"[a-z]|\xc3")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def runs_of(raw: bytes) -> Iterator[list[bytes]]:
    """The runs of a lower-cased text, in lists of about SLICE bytes of text (a run is never cut)."""
    at = 0
    while at < len(raw):
        end = at + SLICE
        while end < len(raw) and (LETTER.match(raw, end) or raw[end - 1] == 0xC3):
            end += 1
        yield RUN.findall(raw, at, end)
        at = end


def _counts(rare: int, least_length: int):
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def flush() -> pa.RecordBatch:
            words = [w.decode() for w in total]
            out = pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(total.values()), pa.int64())], schema=schema)
            total.clear()
            return out

        for batch in batches:
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                if not text.is_valid:
                    continue
                start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for runs in runs_of(text.as_buffer().to_pybytes().translate(LOWER)):
                    for run, n in Counter(runs).items():
                        if len(run) < least_length:
                            continue
                        h = zlib.crc32(run, start)
                        if h % rare == 0:
                            letters = run.decode()
                            cut = h % len(letters)
                            run = (letters[:cut] + letters[cut + 1 :]).encode()
                        if len(run) >= 2 * least_length or len(run.decode()) >= least_length:
                            total[run] += n
                    if len(total) >= HELD_WORDS:
                        yield flush()
        yield flush()

    return work


def vocabulary(docs: DataFrame, rare: int = 97, least_length: int = 5, least_count: int = 3) -> DataFrame:
    """(word, n) of the ``docs`` (doc_id, text)."""
    texts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return (
        texts.mapInArrow(_counts(rare, least_length), "word string, n long")
        .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)
    )


def _blocks(words: DataFrame) -> DataFrame:
    """Every word in its blocks: (m, window, key, word, n)."""
    length = F.length("word")
    rows = words.withColumn("m", F.explode(F.array(length, length + 1)))
    width = F.greatest(F.lit(2), F.ceil(F.col("m") / F.lit(WINDOWS)).cast("int"))
    rows = rows.withColumn("window", F.explode(F.sequence(F.lit(0), F.floor((F.col("m") - 1) / width).cast("int"))))
    start = F.col("window") * width
    behind = F.greatest(F.col("m") - start - width, F.lit(0))  # code points after the window
    head = F.substr("word", F.lit(1), start)
    tail = F.substr("word", F.length("word") - behind + 1, behind)
    return rows.select("m", "window", F.xxhash64("m", "window", head, F.lit("*"), tail).alias("key"), "word", "n")


def matrices(words: list[str], m: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of words of length m or m - 1, filled up at the end and at the start."""
    left, right = np.zeros((2, len(words), m), np.uint32)
    for row, word in enumerate(words):
        points = np.frombuffer(word.encode("utf-32-le"), np.uint32)
        left[row, : len(points)] = points
        right[row, m - len(points) :] = points
    return left, right


def single_edits(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Compare all rows of two tiles (any leading axes alike): whether they are one edit apart, and where they first differ.

    The longer words have as many code points as the matrices have columns; pairs of two shorter words do not count.
    """
    m = a[0].shape[-1]
    same = a[0][..., :, None, :] == b[0][..., None, :, :]
    prefix = np.where(same.all(-1), m, same.argmin(-1))
    same = (a[1][..., :, None, :] == b[1][..., None, :, :])[..., ::-1]
    suffix = np.where(same.all(-1), m, same.argmin(-1))
    full = (a[0][..., -1] > 0)[..., :, None] | (b[0][..., -1] > 0)[..., None, :]
    return full & (prefix < m) & (prefix + suffix >= m - 1), prefix


def _tiles(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells sorted by (m, cell): per word and cell its neighbours there, the largest count among them and its word."""
    for table in whole_groups(batches, "cell", rows=1 << 15):
        cut = bounds(table["cell"].to_numpy())
        many = np.repeat(np.diff(cut) > 1, np.diff(cut))
        table = table.filter(pa.array(many))
        if not table.num_rows:
            continue
        cell, m, window, n, side = (table[c].to_numpy() for c in ("cell", "m", "window", "n", "side"))
        diagonal = table["diagonal"].to_numpy()
        words = table["word"].to_pylist()
        hits, best = np.zeros(len(words), np.int64), np.full(len(words), -1, np.int64)
        by_length = bounds(m)
        for x, y in zip(by_length[:-1], by_length[1:], strict=True):
            _one_length(words[x:y], int(m[x]), cell[x:y], window[x:y], n[x:y], side[x:y], diagonal[x:y], hits[x:y], best[x:y])
            best[x:y] += x
        some = np.flatnonzero(hits)
        yield pa.RecordBatch.from_pydict({
            "word": pa.array([words[i] for i in some], pa.string()),
            "hits": pa.array(hits[some], pa.int64()),
            "best_n": pa.array(n[best[some]], pa.int64()),
            "best": pa.array([words[i] for i in best[some]], pa.string()),
        })


def _one_length(words, m, cell, window, n, side, diagonal, hits, best) -> None:
    """Fill ``hits`` and ``best`` (row numbers) for the cells of one length; rows of a cell are in order of words."""
    left, right = matrices(words, m)
    width = max(2, -(-m // WINDOWS))
    cut = bounds(cell)
    sizes = np.diff(cut)

    def note(rows: np.ndarray, others: np.ndarray) -> None:
        """Compare tiles of rows (cells, a) with tiles of others (cells, b)."""
        near, first = single_edits((left[rows], right[rows]), (left[others], right[others]))
        near &= first // width == window[rows][..., :, None]
        one, two = rows[..., :, None], others[..., None, :]
        # Two rows of one chunk meet in its diagonal cell, rows of two chunks in the cell of both.
        near &= np.where(side[one] == side[two], diagonal[one] & diagonal[two], True)
        count = near.sum(-1)
        if not count.any():
            return
        # The first of the largest: others are in order of words.
        at = np.where(near, n[two], -1).argmax(-1)
        found = np.take_along_axis(others, at, -1)
        flat, found, count = rows.ravel(), found.ravel(), count.ravel()
        some = count > 0
        flat, found = flat[some], found[some]
        hits[flat] += count[some]
        now = np.maximum(best[flat], 0)
        better = (best[flat] < 0) | (n[found] > n[now]) | ((n[found] == n[now]) & (found < now))
        best[flat[better]] = found[better]

    for size in np.unique(sizes):
        starts = cut[:-1][sizes == size]
        if size * size * m <= TILE:
            step = max(1, TILE // int(size * size * m))
            for k in range(0, len(starts), step):
                rows = starts[k : k + step, None] + np.arange(size)
                note(rows, rows)
            continue
        # A large cell, tile by tile; a tile narrows down to one pair for words of millions of code points.
        edge = max(1, int((TILE / m) ** 0.5))
        for start in starts:
            for a in range(start, start + size, edge):
                for b in range(start, start + size, edge):
                    note(np.arange(a, min(a + edge, start + size))[None], np.arange(b, min(b + edge, start + size))[None])


def neighbours(words: DataFrame) -> DataFrame:
    """``words`` (word, n): (word, n_near, best_n, best) of the words that have others one edit apart."""
    rows = _blocks(words)
    cell = ("m", "window", "cell", "word", "n", "side", "diagonal")
    narrow = rows.filter(F.col("m") <= NARROW).select(
        "m", "window", F.col("key").alias("cell"), "word", "n", F.lit(0).alias("side"), F.lit(True).alias("diagonal"))
    wide = rows.filter(F.col("m") > NARROW)
    sizes = wide.groupBy("key").count().withColumnRenamed("count", "size").filter("size > 1").withColumnRenamed("size", "members")
    wide = chunked(wide.withColumnRenamed("n", "times"), "key", "word", sizes.withColumnRenamed("members", "n"), CHUNK)
    cells = narrow.unionByName(wide.withColumnRenamed("times", "n").select(*cell))
    return (
        cells.repartition(shuffle_count(words.sparkSession), "cell").sortWithinPartitions("m", "cell", "word")
        .mapInArrow(_tiles, "word string, hits long, best_n long, best string")
        .groupBy("word").agg(F.sum("hits").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("minus"), "best")).alias("top"))
        .select("word", "n_near", (-F.col("top.minus")).alias("best_n"), F.col("top.best").alias("best"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """``forms`` (word, form): (word, root), the last form that can be reached. Each round doubles the steps."""
    now = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        a, b = now.alias("a"), now.alias("b")
        step = a.join(b, F.col("a.root") == F.col("b.word"), "left")
        now = stored(
            step.select("a.word", F.coalesce("b.root", "a.root").alias("root"), F.col("b.root").isNotNull().alias("moved")), "spelling-roots"
        )
        if now.filter("moved").isEmpty():
            return now.drop("moved")
        now = now.drop("moved")


def variants(docs: DataFrame, rare: int = 97, least_length: int = 5, least_count: int = 3, ratio: int = 2) -> DataFrame:
    """``docs`` (doc_id, text): one row per word of the vocabulary: word, form, root, n, n_near, form_n."""
    words = stored(vocabulary(only(docs, "doc_id", "text"), rare, least_length, least_count), "spelling-words")
    near = stored(neighbours(words), "spelling-near")
    known = words.join(near, "word", "left").withColumn("leads", F.col("best_n") >= ratio * F.col("n"))
    rows = stored(known.select(
        "word", F.when(F.col("leads"), F.col("best")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("leads"), F.col("best_n")).alias("form_n"),
    ), "spelling-forms")
    return rows.join(roots(rows.filter("form IS NOT NULL")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
