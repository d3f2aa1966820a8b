"""Prefix trie of conversations: a count-min sketch tells prefixes of one conversation from those that may be shared.

1. Places. Turns are sorted over the cluster by conversation and turn; a turn's place is its number in
   its partition plus the conversation's turns in the partitions before, so a conversation of any length
   spreads over many tasks. From here on a turn is a 128-bit digest of (role, text) and a number of words.
2. Prefixes. The digest of the first d turns is the running exclusive-or of hashes of (place, turn), taken in
   segments of SEGMENT turns and then over the segments' totals.
3. Screen. Tasks count their prefixes' slots in ROWS rows of counters; the sums per slot are kept as one
   bit, "one" or "more", and broadcast. A prefix that meets a slot of one is proven to be of one
   conversation alone. Its node is complete where it stands: one member, one leaf, nothing saved. Only prefixes whose
   slots all say "more" are shuffled and grouped exactly; a false alarm costs a shuffled row, no result.
4. Exact nodes. Groups give members, ends and the least conv_id. A conversation is its node's
   representative from some depth on; the words before that depth are what it repeats of others. So the sums over
   subtrees (leaves, saved words) are plain sums over members, without a walk through the levels.
5. Ends. The ids that end in a shared node are sorted over the cluster, joined into blocks of text, and the blocks
   of a node are hashed one after another as a stream.

The sketch has 2 to 4 bits per prefix and row, at most 2 ** MOST_BITS; beyond that it proves fewer
prefixes to be single, and more are grouped exactly.

Defined cases: rows without conv_id are of no conversation and left out; null role or text is empty; rows of
one turn are ordered by the digest of role and text; a turn null comes first; a conversation that is rebuilt to no turns ends
in the root; an empty table has no node, the root included; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.mixing import word_count
from tidegate.llm.shared import bounds, mix, only, shuffle_count, stored

SEGMENT = 1024
ROWS = 2
MOST_BITS = 28
BLOCK = 1 << 16  # counters that are summed together
HEAVY = 1000  # a node with more than 1/HEAVY of all children is met by broadcast; there are fewer than HEAVY
ENDS_BYTES = 1 << 20
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def borrowed(conv_id: Column) -> Column:
    """How many turns a conversation takes over from its base."""
    return F.pmod(F.crc32(conv_id.cast("string").cast("binary")), F.lit(4)).cast("long")


def _placed(turns: DataFrame) -> DataFrame:
    """Digest rows with their place (from 1) in their conversation."""
    n = shuffle_count(turns.sparkSession)
    rows = stored(
        turns.repartitionByRange(n, "conv_id", F.col("turn").asc_nulls_first(), "a", "b")
        .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "a", "b")
        .withColumn("at", F.monotonically_increasing_id()).drop("turn"),
        "trie-turns",
    )
    part = F.shiftright("at", 33)
    starts = rows.groupBy("conv_id", part.alias("part")).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    return rows.withColumn("part", part).join(starts, ["conv_id", "part"]).select(
        "conv_id", (F.col("at") - F.col("first") + F.col("before") + 1).alias("place"), "a", "b", "words"
    )


def rebuild(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Placed turns to rebuilt ones (conv_id, depth, a, b, words), and one row (conv_id, n) per conversation."""
    lengths = stored(turns.groupBy("conv_id").agg(F.max("place").alias("length")), "trie-lengths")
    base = F.col("conv_id") - F.col("conv_id") % 20
    bases = lengths.filter(F.col("conv_id") % 20 == 0).select(F.col("conv_id").alias("base"), F.col("length").alias("base_length"))
    plan = stored(
        lengths.withColumn("base", base).withColumn("h", borrowed(F.col("conv_id"))).join(bases, "base", "left")
        .withColumn("taken", F.least("h", F.coalesce("base_length", F.lit(0))))
        .select("conv_id", "base", "length", "h", "taken", (F.col("taken") + F.greatest(F.col("length") - F.col("h"), F.lit(0))).alias("n")),
        "trie-plan",
    )
    heads = (
        turns.filter((F.col("conv_id") % 20 == 0) & (F.col("place") <= 3)).withColumnRenamed("conv_id", "base")
        .join(plan.filter("taken > 0"), "base").filter("place <= h")
        .select("conv_id", F.col("place").alias("depth"), "a", "b", "words")
    )
    # Own turns meet their plan segment by segment, so that a very long conversation is not one join key.
    own = (
        turns.withColumn("segment", F.floor(F.col("place") / SEGMENT))
        .join(
            plan.select("conv_id", "h", "taken", F.explode(
                F.sequence(F.lit(0).cast("long"), F.floor(F.col("length") / SEGMENT))).alias("segment")),
            ["conv_id", "segment"],
        )
        .filter("place > h")
        .select("conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("depth"), "a", "b", "words")
    )
    return heads.unionByName(own), plan.select("conv_id", "n")


def prefixes(rebuilt: DataFrame, lengths: DataFrame) -> DataFrame:
    """One row per conversation and depth, 0 included: the prefix's digest (p, q), its parent's (pp, pq), words, words before, last."""
    mark = [F.xxhash64(F.lit(k), "depth", "a", "b") for k in (1, 2)]
    segment = F.floor((F.col("depth") - 1) / SEGMENT).alias("segment")
    rows = rebuilt.select("conv_id", "depth", "words", segment, mark[0].alias("x"), mark[1].alias("y"))
    totals = rows.groupBy("conv_id", "segment").agg(
        F.bit_xor("x").alias("x_all"), F.bit_xor("y").alias("y_all"), F.sum("words").alias("w_all"))
    earlier = Window.partitionBy("conv_id").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    totals = totals.select(
        "conv_id", "segment",
        F.coalesce(F.bit_xor("x_all").over(earlier), none).alias("x_all"),
        F.coalesce(F.bit_xor("y_all").over(earlier), none).alias("y_all"),
        F.coalesce(F.sum("w_all").over(earlier), none).alias("w_all"),
    )
    inside = Window.partitionBy("conv_id", "segment").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    n = lengths.withColumn("segment", F.explode(F.sequence(none, F.floor(F.greatest(F.col("n") - 1, none) / SEGMENT))))
    runs = (
        rows.withColumn("x_run", F.bit_xor("x").over(inside)).withColumn("y_run", F.bit_xor("y").over(inside))
        .withColumn("w_run", F.sum("words").over(inside))
        .join(totals, ["conv_id", "segment"]).join(n, ["conv_id", "segment"])
        .withColumn("p", F.col("x_run").bitwiseXOR(F.col("x_all"))).withColumn("q", F.col("y_run").bitwiseXOR(F.col("y_all")))
    )
    root = lengths.select(
        "conv_id", none.alias("depth"), none.alias("p"), none.alias("q"), none.alias("pp"), none.alias("pq"),
        none.alias("words"), none.alias("before"), (F.col("n") == 0).alias("last"),
    )
    return root.unionByName(runs.select(
        "conv_id", "depth", "p", "q", F.col("p").bitwiseXOR(F.col("x")).alias("pp"), F.col("q").bitwiseXOR(F.col("y")).alias("pq"),
        "words", (F.col("w_run") + F.col("w_all") - F.col("words")).alias("before"), (F.col("depth") == F.col("n")).alias("last"),
    ))


# --- the sketch ------------------------------------------------------------------


def _slots(p: np.ndarray, q: np.ndarray, bits: int) -> list[np.ndarray]:
    """A prefix's slot in every row."""
    one, two = mix(p.view(np.uint64)), mix(q.view(np.uint64)) | np.uint64(1)
    return [(mix(one + np.uint64(r) * two) >> np.uint64(64 - bits)).astype(np.int64) for r in range(ROWS)]


def _longs(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch[n].to_numpy(zero_copy_only=False).astype(np.int64) for n in names]


def _count(bits: int):
    """A task's own counts, block by block, as slots that occur (twice, if more than once)."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r, slots in enumerate(_slots(*_longs(batch, "p", "q"), bits)):
                slot, n = np.unique(slots, return_counts=True)
                slot = np.repeat(slot, np.minimum(n, 2))
                cut = bounds(slot // BLOCK)
                starts = cut[:-1] if len(slot) else cut[:0]
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array(((r << bits) + slot[starts]) // BLOCK, pa.int64()),
                    "slots": pa.array([(slot[a:b] % BLOCK).astype(np.uint16).tobytes() for a, b in zip(starts, cut[1:], strict=False)], pa.binary()),
                })

    return work


def _sum(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block: one row of bits per block, set where the sum exceeds one."""
    now, counts = None, np.zeros(BLOCK, np.int64)

    def done() -> pa.RecordBatch:
        bits = np.packbits(counts > 1, bitorder="little").tobytes()
        return pa.RecordBatch.from_pydict({"block": pa.array([now], pa.int64()), "bits": pa.array([bits], pa.binary())})

    for batch in batches:
        for block, slots in zip(batch["block"].to_pylist(), batch["slots"].to_pylist(), strict=True):
            if block != now:
                if now is not None:
                    yield done()
                now, counts = block, np.zeros(BLOCK, np.int64)
            np.add.at(counts, np.frombuffer(slots, np.uint16), 1)
    if now is not None:
        yield done()


def sketch(rows: DataFrame, count: int) -> tuple[np.ndarray, int]:
    """Bits of all rows of counters over the (p, q) of ``rows``: set where a counter exceeds one. And the bits of a slot number."""
    bits = min(MOST_BITS, max(16, (2 * max(count, 1)).bit_length()))
    blocks = (
        rows.select("p", "q").mapInArrow(_count(bits), "block long, slots binary")
        .repartition(shuffle_count(rows.sparkSession), "block").sortWithinPartitions("block")
        .mapInArrow(_sum, "block long, bits binary")
    )
    table = np.zeros((ROWS << bits) // BLOCK * (BLOCK // 8), np.uint8)
    for block, words in blocks.toLocalIterator():  # at most ROWS * 2 ** MOST_BITS bits in all
        table[block * (BLOCK // 8) : (block + 1) * (BLOCK // 8)] = np.frombuffer(words, np.uint8)
    return table, bits


def _screen(shared, bits: int):
    def many(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        table, out = shared.value, np.ones(len(p), bool)
        for r, slot in enumerate(_slots(p, q, bits)):
            at = slot + (r << bits)
            out &= (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return out

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, q, pp, pq, depth = _longs(batch, "p", "q", "pp", "pq", "depth")
            yield batch.append_column("many", pa.array(many(p, q))).append_column("below_many", pa.array((depth > 0) & many(pp, pq)))

    return work


# --- the ends --------------------------------------------------------------------


def _joined_ids(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (p, q, conv_id): per node one or more texts of ids, with the first id."""
    schema = pa.schema([("p", pa.int64()), ("q", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])
    now, ids, size = None, [], 0

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"p": now[0], "q": now[1], "first": ids[0], "ids": ",".join(map(str, ids))}], schema)

    for batch in batches:
        for p, q, c in zip(*(x.tolist() for x in _longs(batch, "p", "q", "conv_id")), strict=True):
            if (p, q) != now or size >= ENDS_BYTES:
                if ids:
                    yield done()
                now, ids, size = (p, q), [], 0
            ids.append(c)
            size += len(str(c)) + 1
    if ids:
        yield done()


def _hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of ids sorted by node and first id: one digest per node, whose texts pass through as a stream."""
    schema = pa.schema([("p", pa.int64()), ("q", pa.int64()), ("ends", pa.string())])
    now, digest, out = None, None, []
    for batch in batches:
        for p, q, ids in zip(*(x.tolist() for x in _longs(batch, "p", "q")), batch["ids"].to_pylist(), strict=True):
            if (p, q) == now:
                digest.update(b"," + ids.encode())
                continue
            if now is not None:
                out.append({"p": now[0], "q": now[1], "ends": digest.hexdigest()})
            now, digest = (p, q), hashlib.sha256(ids.encode())
        if len(out) >= 4096:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    if now is not None:
        out.append({"p": now[0], "q": now[1], "ends": digest.hexdigest()})
    yield pa.RecordBatch.from_pylist(out, schema)


def ends_of_nodes(ends: DataFrame) -> DataFrame:
    """``ends`` (p, q, conv_id): (p, q, ends), the SHA-256 of each node's ids in order, joined by commas."""
    n = shuffle_count(ends.sparkSession)
    texts = ends.repartitionByRange(n, "p", "q", "conv_id").sortWithinPartitions("p", "q", "conv_id").mapInArrow(
        _joined_ids, "p long, q long, first long, ids string")
    return texts.repartition(n, "p", "q").sortWithinPartitions("p", "q", "first").mapInArrow(_hashed, "p long, q long, ends string")


# --- the nodes -------------------------------------------------------------------


def trie(conversations: DataFrame) -> DataFrame:
    """Nodes of the trie over the rebuilt ``conversations`` (conv_id, turn, role, text).

    One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.
    """
    role = F.coalesce("role", F.lit(""))
    content = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, F.coalesce("text", F.lit(""))), 256)
    turns = (
        only(conversations, "conv_id", "turn", "role", "text").filter("conv_id IS NOT NULL")
        .select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), content.alias("sha"), word_count(F.col("text")).alias("words"))
        .select("conv_id", "turn", F.xxhash64(F.lit(3), "sha").alias("a"), F.xxhash64(F.lit(4), "sha").alias("b"), "words")
    )
    placed = stored(_placed(turns), "trie-places")
    rows = stored(prefixes(*rebuild(placed)), "trie-prefixes")
    table, bits = sketch(rows, rows.count())
    shared = rows.sparkSession.sparkContext.broadcast(table)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", many boolean, below_many boolean"
    rows = stored(rows.mapInArrow(_screen(shared, bits), schema), "trie-screened")
    single, many = rows.filter("NOT many"), rows.filter("many")

    own_end = F.when(F.col("last"), F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(EMPTY_SHA)
    local = single.select(
        "conv_id", "depth", "pp", "pq", "below_many", F.lit(1).cast("long").alias("n_convs"),
        (~F.col("last")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"), own_end.alias("ends_sha256"),
    )

    groups = stored(
        many.groupBy("p", "q").agg(
            F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.count_if("last").alias("n_ends"),
            *[F.min(c).alias(c) for c in ("depth", "pp", "pq", "before")], F.bool_or("below_many").alias("below_many"),
        ),
        "trie-groups",
    )
    # From which word on a conversation stands for its nodes itself, and whether it is a leaf's representative.
    kept = (
        groups.select("conv_id", "before", (F.col("n_convs") == F.col("n_ends")).alias("leaf"))
        .unionByName(single.select("conv_id", "before", F.col("last").alias("leaf")))
        .groupBy("conv_id").agg(F.min("before").alias("stop"), F.bool_or("leaf").alias("leaf"))
    )
    members = many.withColumn("segment", F.floor(F.col("depth") / SEGMENT))
    reach = members.groupBy("conv_id", "segment").agg(F.max(F.col("before") + F.col("words")).alias("upto"))
    whole = reach.groupBy("conv_id").agg(F.max("upto").alias("upto"), F.max("segment").alias("segments"))
    flags = (
        whole.join(kept, "conv_id", "left")
        .select("conv_id", F.least("upto", F.coalesce("stop", "upto")).alias("stop"), F.coalesce("leaf", F.lit(False)).cast("long").alias("leaf"),
                F.explode(F.sequence(F.lit(0).cast("long"), F.col("segments"))).alias("segment"))
    )
    sums = (
        members.join(flags, ["conv_id", "segment"]).groupBy("p", "q")
        .agg(F.sum("leaf").alias("n_leaves"), F.sum(F.greatest(F.col("stop") - F.col("before"), F.lit(0))).alias("saved_tokens"))
    )
    children = (
        groups.select("pp", "pq", "depth").unionByName(local.filter("below_many").select("pp", "pq", "depth")).filter("depth > 0")
        .groupBy("pp", "pq").agg(F.count("*").alias("n_children")).withColumnsRenamed({"pp": "p", "pq": "q"})
    )
    exact = stored(
        groups.join(sums, ["p", "q"]).join(children, ["p", "q"], "left")
        .join(ends_of_nodes(many.filter("last").select("p", "q", "conv_id")), ["p", "q"], "left")
        .select("p", "q", "conv_id", "depth", "pp", "pq", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
                "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(EMPTY_SHA)).alias("ends_sha256"), "below_many"),
        "trie-exact",
    )

    columns = ("conv_id", "depth", "pp", "pq", "below_many", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    nodes = exact.select(*columns).unionByName(local.select(*columns))
    done = ("n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    # A parent that is proven single is the same conversation's; only the others are looked up.
    alone = nodes.filter("NOT below_many").select("conv_id", "depth", F.when(F.col("depth") > 0, F.col("conv_id")).alias("parent_conv_id"), *done)
    parents = exact.select(F.col("p").alias("pp"), F.col("q").alias("pq"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    all_children = parents.agg(F.sum("n_children")).first()[0] or 0
    # Fewer than HEAVY nodes can have more than 1/HEAVY of all children, so this side of the join is bounded.
    is_heavy = F.col("n_children") * HEAVY > F.lit(all_children)
    heavy, light = (parents.filter(c).drop("n_children") for c in (is_heavy, ~is_heavy))
    below = nodes.filter("below_many")
    met = below.join(F.broadcast(heavy), ["pp", "pq"])
    rest = below.join(F.broadcast(heavy), ["pp", "pq"], "left_anti").join(light, ["pp", "pq"])
    final = ("conv_id", "depth", "parent_conv_id", *done)
    return alone.select(*final).unionByName(met.select(*final)).unionByName(rest.select(*final))
