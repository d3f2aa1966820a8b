"""Helpers the operators share: scratch tables, whole groups from sorted batches, words and hashes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.session import scratch_dir

SLICE_BYTES = 4 << 20


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, lineage cut, safe from lost executors."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    # Shuffle files are deleted once the driver collects what refers to them; else they pile up until the job ends.
    df.sparkSession.sparkContext._jvm.System.gc()
    return df.sparkSession.read.schema(df.schema).parquet(path)


BROADCAST_IDS = 2_000_000  # 16 MB of ids


def among(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """``df`` without rows whose key is not among the (stored) ``ids``, where that can be told without a shuffle.

    The ids are counted; up to BROADCAST_IDS they are broadcast, so that the other
    rows' texts are not shuffled only to be dropped by the join that follows. Beyond
    that ``df`` stays as it is and the join alone decides.
    """
    if ids.count() > BROADCAST_IDS:
        return df
    return df.join(F.broadcast(ids.select(key)), key, "left_semi")


def shuffle_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns and no others, so extra columns of any name cannot clash."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def chunked(df: DataFrame, key: str, member: str, sizes: DataFrame, chunk: int) -> DataFrame:
    """Deal the members of every key over cells of at most two chunks, so that each pair meets.

    ``sizes`` holds ``key`` and ``n``, its number of members. A key with up to
    ``chunk`` members is one cell. A larger one is cut into c chunks by a hash of
    the member, and chunk a goes to the cells {a, b} for all b. Adds ``cell`` and
    ``side`` (the chunk); pairs of one chunk belong to the cell {a, a}.
    """
    c = F.ceil(F.col("n") / F.lit(chunk)).cast("int")
    mine = F.pmod(F.xxhash64(F.lit("chunk"), F.col(member)), F.col("_c")).cast("int")
    return (
        df.join(sizes, key)
        .withColumn("_c", c)
        .withColumn("side", mine)
        .withColumn("_b", F.explode(F.sequence(F.lit(0), F.col("_c") - 1)))
        .withColumn("cell", F.xxhash64(key, F.least("side", "_b"), F.greatest("side", "_b")))
        .withColumn("diagonal", F.col("side") == F.col("_b"))
        .drop("_c", "_b", "n")
    )


def by_cell(df: DataFrame, cell: str = "cell") -> DataFrame:
    """Rows of one cell together and in order; cells are small, so partitions come out even."""
    return df.repartition(shuffle_count(df.sparkSession), cell).sortWithinPartitions(cell)


def whole_groups(batches: Iterable[pa.RecordBatch], key: str, rows: int = 4096) -> Iterator[pa.Table]:
    """Tables of whole groups out of batches sorted by ``key``; a group never spans two tables."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n < rows:
            continue
        table = pa.Table.from_batches(held)
        keys = table[key].to_numpy()
        cut = int(np.argmax(keys == keys[-1]))
        if cut:
            yield table.slice(0, cut)
            held = table.slice(cut).combine_chunks().to_batches()
            n = table.num_rows - cut
    if held:
        yield pa.Table.from_batches(held)


def bounds(keys: np.ndarray) -> np.ndarray:
    """Start of every run of equal keys, and the end."""
    if not len(keys):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])


def list_rows(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A matrix as a list column."""
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(values.ravel()).cast(kind))


def list_matrix(column: pa.ChunkedArray | pa.Array, fill: float = 0) -> np.ndarray:
    """A list column as a matrix; shorter lists are filled up."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    width = int(sizes.max()) if len(sizes) else 0
    if len(values) == len(sizes) * width:
        return values.reshape(len(sizes), width)
    out = np.full((len(sizes), width), fill, values.dtype)
    out[np.arange(width)[None, :] < sizes[:, None]] = values
    return out


# --- texts ---------------------------------------------------------------------

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (every input bit reaches every output bit)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of a pair of hashes, in order."""
    return mix(a * _ODD + b + np.uint64(0x632BE59BD9B4E019))


def pieces(batches: Iterable[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches cut so that each piece holds about SLICE_BYTES of text (one text at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        marks = np.cumsum(_lengths(batch[text])) // SLICE_BYTES
        cuts = bounds(marks)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield batch.slice(a, b - a)


def offsets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, places, data = column.buffers()
    at = np.frombuffer(places, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def _lengths(column: pa.Array) -> np.ndarray:
    return np.diff(offsets(column)[1])


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a column of texts, as arrays.

    Word w of the batch has the bytes ``raw[start[w]:end[w]]``; text d has the words
    ``first[d]:first[d + 1]``. A null text has none.
    """

    def __init__(self, column: pa.Array, lower: bool = False):
        raw, at = offsets(column)
        self.raw = _LOWER[raw] if lower else raw
        solid = ~SPACE[raw]
        begins = solid.copy()
        begins[1:] &= ~solid[:-1]
        heads = at[:-1][at[:-1] < len(raw)]
        begins[heads] |= solid[heads]
        self.start = np.flatnonzero(begins)
        ends = solid.copy()
        ends[:-1] &= ~solid[1:]
        tails = at[1:][at[1:] > 0] - 1
        ends[tails] |= solid[tails]
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, at)
        self._solid = solid

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of every word."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        size = self.end - self.start
        begin = np.cumsum(size) - size
        step = np.arange(begin[-1] + size[-1]) - np.repeat(begin, size)
        table = mix(np.arange(1, 257, dtype=np.uint64) * _ODD + np.uint64(seed))
        power = np.cumprod(np.full(int(size.max()), _ODD | np.uint64(2 * seed + 1), np.uint64))
        return mix(np.add.reduceat(table[self.raw[self._solid]] * power[step], begin) + size.astype(np.uint64))


def windows(h: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` hashes, by doubling: two halves make the whole.

    Runs across the end of a text are included; the caller leaves them out.
    """
    have = 1
    while have < length:
        add = min(have, length - have)
        if len(h) <= add:
            return h[:0]
        h = joined(h[:-add], h[add:]) + np.uint64(have + add)
        have += add
    return h

