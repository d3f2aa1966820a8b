"""Packing documents into sequences by the linear grouping scheme.

1. Every document becomes token ids and an end id; longer ones are cut into pieces of
   ``capacity`` ids, the remainder first.
2. A histogram of piece lengths, at most ``capacity`` numbers, is all that the plan
   needs. Lengths above ``small`` are put in order and cut into ``groups`` groups of
   equal numbers of pieces; each group's lengths are rounded up to its largest.
3. For these few sizes configurations are chosen: the largest remaining size, filled
   up as far as a knapsack of the remaining sizes can, used as often as the numbers
   allow, and so on.
4. The actual pieces take the places of the rounded ones; then the small pieces go, by
   decreasing length, each into the sequence with the least sufficient room.

The plan speaks of intervals: "of the pieces of length l, those of ranks a to b go to
the sequences from s on, at offset o". It has a few thousand rows, however many pieces
there are. The pieces are numbered inside their length in two steps (hash buckets,
then inside a bucket), so that a length with most of the pieces is not one task.

Token ids: a text is cut where a single blank or line break stands between two other
characters. The pre-tokeniser never joins across such a place, so the ids of the parts,
which are remembered, make up the ids of the whole.

Defined cases: a null or empty text is the end id alone; a row without id is packed like
any other; repeated rows are packed each; an empty table gives no rows; other columns
are not looked at.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.shared import only, pieces, stored

CAPACITY = 1024
SMALL = 300
GROUPS = 768
END_ID = 2
BUCKETS = 512
REMEMBERED = 600_000
LONGEST_PART = 200
_SAFE_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")


# Fixed value: how the byte-level pre-tokeniser cuts a text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write a byte as a letter: printable ones as themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class Tokens:
    """Ids of texts as little-endian 32-bit bytes.

    The vocabulary is that of the tokenizer file. Its ids are in the order of its
    merges, so it is applied as a table of ranks, several times faster than by the
    library that reads the file and with the same ids. Special tokens are ordinary text, unless ``added`` asks for the
    library's plain call: then a text with any of the file's added tokens goes to the library.
    """

    def __init__(self, path: str, added: bool = False):
        import tiktoken
        from tokenizers import Tokenizer

        letter = byte_of_letter()
        tokenizer = Tokenizer.from_file(path)
        special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
        ranks = {bytes(letter[c] for c in t): i for t, i in tokenizer.get_vocab().items() if t not in special}
        self._ranks = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._library = tokenizer
        self._added = [t for t in special if t] if added else []
        self._after_blank: dict[str, bytes | None] = {}
        self._exact: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", self._ranks.encode_ordinary(t)).tobytes() for t in texts]

    def _learn(self, parts: set[str]) -> None:
        new = [p for p in parts if p not in self._after_blank]
        if len(self._after_blank) + len(new) > REMEMBERED:
            self._after_blank.clear()
            new = list(parts)
        plain = []
        for p in new:
            core = p[1:] if p[:1] == "\n" else p
            if len(p) <= LONGEST_PART and core.split() == [core]:
                plain.append(p)
            else:
                self._after_blank[p] = None
        ids = self._encode([p if p[0] == "\n" else " " + p for p in plain])
        self._after_blank.update(zip(plain, ids, strict=True))

    def _whole(self, text: str) -> bytes:
        if len(self._exact) > REMEMBERED // 4:
            self._exact.clear()
        parts = _SAFE_CUT.split(text) if text else []
        new = [p for p in dict.fromkeys(parts) if p not in self._exact]
        known = dict(zip(new, self._encode(new), strict=True))
        out = b"".join([known[p] if p in known else self._exact[p] for p in parts])
        self._exact.update((p, x) for p, x in known.items() if len(p) <= LONGEST_PART)
        return out

    def ids(self, texts: list[str]) -> list[bytes]:
        out = []
        for text in texts:
            if any(t in text for t in self._added):
                out.append(array("I", self._library.encode(text, add_special_tokens=False).ids).tobytes())
                continue
            head, *parts = text.replace("\n", " \n").split(" ")
            if head.split() != [head]:
                out.append(self._whole(text))
                continue
            try:
                rest = b"".join(map(self._after_blank.get, parts))
            except TypeError:  # parts that are new, or where the text can't be cut
                self._learn(set(parts))
                if None in map(self._after_blank.get, parts):
                    out.append(self._whole(text))
                    continue
                rest = b"".join(map(self._after_blank.get, parts))
            out.append(self._whole(head) + rest)
        return out


_TOKENS: dict[tuple[str, bool], Tokens] = {}


def _pieces(path: str, capacity: int, end: int, added: bool):
    last = np.array([end], "<u4").tobytes()

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (path, added) not in _TOKENS:
            _TOKENS[path, added] = Tokens(path, added)
        for batch in pieces(batches):
            out: dict[str, list] = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": []}
            ids = _TOKENS[path, added].ids(batch["text"].fill_null("").to_pylist())
            for doc, x in zip(batch["doc_id"].to_pylist(), ids, strict=True):
                x += last
                n = len(x) // 4
                head = n % capacity or capacity
                starts = [0, *range(head, n, capacity)]
                for k, a in enumerate(starts):
                    b = head if k == 0 else a + capacity
                    out["doc_id"].append(doc)
                    out["piece"].append(k)
                    out["start"].append(a)
                    out["length"].append(b - a)
                    out["ids_crc32"].append(zlib.crc32(x[4 * a : 4 * b]))
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                ("ids_crc32", pa.int64())]))

    return work


def token_pieces(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END_ID, added: bool = False
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32."""
    return only(docs, "doc_id", "text").mapInArrow(
        _pieces(path, capacity, end, added), "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


# --- the plan, from the histogram alone ------------------------------------------


def _best_filling(sizes: list[int], numbers: list[int], room: int) -> list[int]:
    """How many of each size fill ``room`` best; sums are bits of one integer."""
    mask = (1 << (room + 1)) - 1
    reach = [1]
    for size, number in zip(sizes, numbers, strict=True):
        now = reach[-1]
        for _ in range(min(number, room // size)):
            wider = (now | reach[-1] | now << size) & mask
            if wider == now:
                break
            now = wider
        reach.append(now)
    at, take = reach[-1].bit_length() - 1, [0] * len(sizes)
    for i in range(len(sizes) - 1, -1, -1):
        while not reach[i] >> at & 1:
            take[i] += 1
            at -= sizes[i]
    return take


def _groups(counts: dict[int, int], groups: int) -> list[list[tuple[int, int, int]]]:
    """Intervals (length, from rank, to rank), by decreasing length, in groups of equal numbers of pieces."""
    total = sum(counts.values())
    each = max(1, -(-total // groups))
    out: list[list[tuple[int, int, int]]] = [[]]
    left = each
    for length in sorted(counts, reverse=True):
        a, end = 0, counts[length]
        while a < end:
            if not left:
                out.append([])
                left = each
            b = min(end, a + left)
            out[-1].append((length, a, b))
            left -= b - a
            a = b
    return [g for g in out if g]


def plan(counts: dict[int, int], capacity: int = CAPACITY, small: int = SMALL, groups: int = GROUPS) -> np.ndarray:
    """Rows (length, from rank, to rank, first sequence, offset), ordered by length and rank."""
    rows: list[tuple[int, int, int, int, int]] = []
    room: dict[int, list[tuple[int, int]]] = {}
    opened = 0

    def has_room(r: int, a: int, b: int) -> None:
        if r and b > a:
            room.setdefault(r, []).append((a, b))

    large = _groups({k: n for k, n in counts.items() if k > small}, groups)
    sizes = [g[0][0] for g in large]
    left = [sum(b - a for _, a, b in g) for g in large]
    queues = [list(reversed(g)) for g in large]
    while any(left):
        lead = next(i for i, n in enumerate(left) if n)
        rest = [n - (i == lead) for i, n in enumerate(left)]
        able = [i for i in range(lead, len(sizes)) if rest[i] and sizes[i] <= capacity - sizes[lead]]
        take = _best_filling([sizes[i] for i in able], [rest[i] for i in able], capacity - sizes[lead])
        use = {i: k for i, k in zip(able, take, strict=True) if k}
        use[lead] = use.get(lead, 0) + 1
        times = min(left[i] // k for i, k in use.items())
        slots: list[list[tuple[int, int, int]]] = []
        for i, k in sorted(use.items()):
            left[i] -= k * times
            for _ in range(k):
                need, slot = times, []
                while need:
                    length, a, b = queues[i].pop()
                    if b - a > need:
                        queues[i].append((length, a + need, b))
                        b = a + need
                    slot.append((length, a, b))
                    need -= b - a
                slots.append(slot)
        cuts = sorted({c for slot in slots for c in np.cumsum([0, *[b - a for _, a, b in slot]]).tolist()})
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            offset = 0
            for slot in slots:
                length, a, b = slot[0]
                rows.append((length, a, a + hi - lo, opened + lo, offset))
                offset += length
                slot[0] = (length, a + hi - lo, b)
                if slot[0][1] == b:
                    slot.pop(0)
            has_room(capacity - offset, opened + lo, opened + hi)
        opened += times
    rooms = sorted(room)
    for length in sorted((k for k in counts if k <= small), reverse=True):
        rank, end = 0, counts[length]
        while rank < end:
            i = bisect_left(rooms, length)
            if i == len(rooms):
                new = -(-(end - rank) // (capacity // length))
                r, (a, b) = capacity, (opened, opened + new)
                opened += new
            else:
                r = rooms[i]
                a, b = room[r].pop()
                if not room[r]:
                    del room[r]
                    rooms.pop(i)
            n = min(b - a, end - rank)
            rows.append((length, rank, rank + n, a, capacity - r))
            rank += n
            for r2, x, y in ((r - length, a, a + n), (r, a + n, b)):
                if r2 and y > x:
                    if r2 not in room:
                        insort(rooms, r2)
                    has_room(r2, x, y)
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _assign(rows: np.ndarray):
    keys = rows[:, 0] << 44 | rows[:, 1]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch["rank"].to_numpy()
            row = rows[np.searchsorted(keys, batch["length"].to_numpy() << 44 | rank, side="right") - 1]
            yield pa.RecordBatch.from_arrays(
                [*[batch[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")],
                 pa.array(row[:, 3] + rank - row[:, 1]), pa.array(row[:, 4])],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return work


def pack(
    docs: DataFrame, path: str, capacity: int = CAPACITY, small: int = SMALL, groups: int = GROUPS, end: int = END_ID,
    added: bool = False,
) -> DataFrame:
    """``docs`` (doc_id, text): one row per piece, with its sequence and its place there."""
    cut = stored(token_pieces(docs, path, capacity, end, added), "packing-pieces")
    cut = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(BUCKETS)).cast("int"))
    tally = cut.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    counts = {k: n for k, n in tally.groupBy("length").agg(F.sum("n")).collect()}  # at most ``capacity`` numbers
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tally.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = cut.withColumn("inside", F.row_number().over(inside)).join(offsets, ["length", "bucket"])
    return ranked.select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("inside") - 1).alias("rank")
    ).mapInArrow(
        _assign(plan(counts, capacity, small, groups)),
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )
