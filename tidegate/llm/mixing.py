"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

1. Targets. The mix has ``share`` times the words of all sources, dealt by weight; a
   source stops at ``most`` times its own words, and the excess is dealt again by
   weight until no source is above. In the order of words per weight the stopped
   sources come first, so the level is found in one pass over the sources.
2. Quotas. Seats are blocks of ``block`` words. Source i's j-th seat has the quotient
   target_i / (2 j - 1), and seats are given in the order of quotients (ties: the
   earlier source), which makes the apportionment of every shorter prefix of the mix
   as even as that of the whole. Shard s holds the seats of the ranks
   ``s * shard_blocks`` on; a source's quota in it is the number of its seats there.
3. Selection. A source's documents, in seeded hash order, form a ring of words. The
   shards take its blocks from the ring one after another, from the first document
   on and around again: a shard's quota says where on the ring the next shard begins.
   ``shares`` gives the passages of every document that each shard holds, ``by_shard``
   a document's sum of them with its first and last shard, and ``mix`` the sum alone,
   the length of the document's overlap with all that was taken.

Positions on the ring are prefix sums in two steps, over hash buckets and inside a
bucket, so a source with a third of all documents is not one task.

Defined cases: a null or word-less text has size 0 and takes nothing; a null source
is a source of its own, the last; sources without words get target 0; an empty table
gives no rows; repeated rows lie on the ring one behind the other; weights repeat in
source order; of two equal quotients at the edge of a shard the earlier source's seat is
in it; a document across an edge is in both shards; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.shared import stored

def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; null: 0."""
    marks = F.translate(text, "\t\n\x0b\x0c\r", "     ")
    return F.coalesce(F.size(F.filter(F.split(marks, " ", -1), lambda w: w != "")), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """``sources`` (source, source_size): adds place (from 0), weight, target. One row per source throughout."""
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    s = sources.withColumn("place", F.row_number().over(in_order) - 1).withColumn("weight", w)
    s = s.withColumn("stop", F.col("source_size") * F.lit(float(most)))
    everything = Window.partitionBy()
    filled = Window.orderBy(F.col("stop") / F.col("weight"), "place").rowsBetween(Window.unboundedPreceding, -1)
    s = (
        s.withColumn("total", F.lit(float(share)) * F.sum("source_size").over(everything))
        .withColumn("stopped_before", F.coalesce(F.sum("stop").over(filled), F.lit(0.0)))
        .withColumn("weight_left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(filled), F.lit(0.0)))
        # Dealt by weight among this source and all that stop later.
        .withColumn("level", (F.col("total") - F.col("stopped_before")) / F.col("weight_left"))
        .withColumn("goes_on", F.col("weight") * F.col("level") < F.col("stop"))
    )
    # The first source that goes on sets the level for itself and all behind it.
    first = F.min_by(F.when(F.col("goes_on"), F.col("level")), F.when(
        F.col("goes_on"), F.struct(F.col("stop") / F.col("weight"), "place"))).over(everything)
    return s.withColumn(
        "target", F.least("stop", F.coalesce(F.col("weight") * first, F.col("stop")))
    ).select("source", "source_size", "place", "weight", "target")


def quotas(sources: DataFrame, block: int, shard_blocks: int) -> DataFrame:
    """``sources`` with target and place: one row per source and shard, with its quota and its seats up to there (until).

    The house grows shard by shard. For the house after each shard, every source
    first gets the whole seats of its share; the remaining seats, fewer than there
    are sources, go by quotient among the few seats next to that point, which hold
    all seats that the highest quotients can pick.
    """
    everything = Window.partitionBy()
    s = (
        sources.filter("target > 0")
        .withColumn("all_target", F.sum("target").over(everything))
        .withColumn("n_sources", F.count("*").over(everything))
        .withColumn("house", F.round(F.col("all_target") / block).cast("long"))
        .withColumn("shards", F.ceil(F.col("house") / F.lit(shard_blocks)))
    )
    grown = (
        s.filter("house > 0")
        .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)))
        .withColumn("seats", F.least((F.col("shard") + 1) * shard_blocks, F.col("house")))
        .withColumn("share", F.col("target") / F.col("all_target"))
        # A divisor that surely gives too few seats in all, so that seats are only added.
        .withColumn("sure", F.greatest(
            F.floor(F.col("share") * (F.col("seats") - F.col("n_sources") / 2) - 0.5 - 1e-9), F.lit(0)).cast("long"))
        .withColumn("sure_sum", F.sum("sure").over(Window.partitionBy("shard")))
        .withColumn("open", F.col("seats") - F.col("sure_sum"))
        # As many further seats as a divisor that surely gives enough would add.
        .withColumn("upto", F.ceil(F.col("share") * (F.col("seats") + F.col("n_sources") / 2) + 0.5 + 1e-9).cast("long"))
    )
    more = (
        grown.withColumn("j", F.explode(F.sequence(F.col("sure") + 1, F.col("upto") + 1)))
        .withColumn("rank", F.row_number().over(
            Window.partitionBy("shard").orderBy(F.desc(F.col("target") / (2 * F.col("j") - 1)), "place")))
        .filter("rank <= open").groupBy("shard", "place").agg(F.count("*").alias("added"))
    )
    so_far = F.col("sure") + F.coalesce("added", F.lit(0))
    return (
        grown.join(more, ["shard", "place"], "left")
        .withColumn("so_far", so_far)
        .withColumn("quota", F.col("so_far") - F.coalesce(
            F.lag("so_far").over(Window.partitionBy("place").orderBy("shard")), F.lit(0)))
        .select("place", "source", "shard", "quota", F.col("so_far").alias("until"))
    )


def _rings(
    docs: DataFrame, weights: Sequence[float], share: float, most: float, block: int, shard_blocks: int, seed: int
) -> tuple[DataFrame, DataFrame]:
    """All documents with their places on the rings, and the quotas.

    The first has one row per row of ``docs``: doc_id, source, size, source_size,
    target, words (taken of the source), start (on its source's ring), and nth, which
    tells repeated rows of one bucket apart.
    """
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string"))), 1, 15)
    turn = F.conv(digits, 16, 10).cast("long")
    sized = stored(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
        .withColumn("turn", turn).withColumn("bucket", F.shiftright("turn", 48).cast("int")),
        "mix-sizes",
    )
    buckets = sized.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    sources = targets(buckets.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), weights, share, most)
    seats = quotas(sources, block, shard_blocks)
    blocks = seats.groupBy("place").agg(F.sum("quota").alias("blocks"))
    planned = stored(
        sources.join(blocks, "place", "left").withColumn(
            "words", F.least(F.coalesce(F.col("blocks"), F.lit(0)) * block, F.floor(F.col("source_size") * most)).cast("long")
        ),
        "mix-plan",
    )
    behind = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        buckets.withColumn("before", F.coalesce(F.sum("bucket_size").over(behind), F.lit(0)))
        .withColumnRenamed("source", "s").withColumnRenamed("bucket", "b")
        .join(planned.withColumnRenamed("source", "p"), F.col("s").eqNullSafe(F.col("p")))
        .select("s", "b", "before", "place", "source_size", "target", "words")
    )
    inside = Window.partitionBy("source", "bucket").orderBy("turn", "doc_id", "size")
    placed = (
        sized.withColumn("within", F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("nth", F.row_number().over(inside))
        .join(offsets, F.col("source").eqNullSafe(F.col("s")) & F.col("bucket").eqNullSafe(F.col("b")))
        .withColumn("start", F.col("before") + F.col("within"))
        .withColumn("source_size", F.col("source_size").cast("long"))
    )
    return placed.select("doc_id", "source", "size", "source_size", "target", "place", "words", "start", "bucket", "nth"), seats


def mix(
    docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
    block: int = 64, shard_blocks: int = 16384, seed: int = 0,
) -> DataFrame:
    """``docs`` (doc_id, text, source): doc_id, source, size, source_size, target, taken, one row per row."""
    placed, _ = _rings(docs, weights, share, most, block, shard_blocks, seed)
    size, words = F.col("source_size"), F.col("words")
    whole = F.when(size > 0, F.expr("words div source_size")).otherwise(0).cast("long")
    # What is taken of the last, unfinished round reaches from the ring's start to this word.
    rest = words - whole * size
    part = F.greatest(F.least(F.col("start") + F.col("size"), rest) - F.col("start"), F.lit(0))
    return placed.select(
        "doc_id", "source", "size", "source_size", "target", (whole * F.col("size") + part).cast("long").alias("taken")
    )


def _passages(placed: DataFrame, seats: DataFrame, block: int) -> DataFrame:
    """``placed`` by the shards that hold its words; rows of which none is taken stay, with a null shard.

    Both sides are cut at the same cells of the unrolled ring. A source's cells are as
    wide as its mean shard, so a cell meets few shards and a large source has many cells.
    """
    on_ring = placed.select("place", "words").distinct()
    held = (
        seats.filter("quota > 0")
        .withColumn("shards", F.count("*").over(Window.partitionBy("place")))
        .join(on_ring, "place")
        .withColumn("wide", F.ceil(F.col("words") / F.col("shards")).cast("long"))
        .withColumn("lo", (F.col("until") - F.col("quota")) * block)
        .withColumn("hi", F.least(F.col("until") * block, F.col("words")))
        .filter("lo < hi")
    )
    widths = held.select("place", "wide").distinct()
    held = held.select(
        "place", "shard", "lo", "hi", F.explode(F.sequence(F.expr("lo div wide"), F.expr("(hi - 1) div wide"))).alias("cell")
    )
    begin = F.col("start") + F.col("turn") * F.col("source_size")
    last_turn = F.expr("CASE WHEN words > start AND size > 0 THEN (words - 1 - start) div source_size END")
    docs = (
        placed.join(widths, "place", "left")
        .withColumn("turn", F.explode_outer(F.sequence(F.lit(0).cast("long"), last_turn)))
        .withColumn("begin", begin)
        .withColumn("end", F.least(begin + F.col("size"), F.col("words")))
        .withColumn("cell", F.explode_outer(F.sequence(F.expr("begin div wide"), F.expr("(end - 1) div wide"))))
    )
    lo, hi = F.greatest("begin", "lo"), F.least("end", "hi")
    # A passage over several cells counts in the one in which it begins.
    meet = (lo < hi) & (F.expr("greatest(begin, lo) div wide") == F.col("cell"))
    return docs.join(held, ["place", "cell"], "left").select(
        *placed.columns, "turn", F.when(meet, F.col("shard")).alias("shard"),
        F.when(meet, lo - F.col("begin")).alias("from_word"), F.when(meet, hi - lo).alias("n_words"),
    )


def shares(
    docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
    block: int = 64, shard_blocks: int = 16384, seed: int = 0,
) -> DataFrame:
    """``docs`` (doc_id, text, source): the mix itself, one row per passage of a document in a shard.

    doc_id, source, shard, turn (round of the ring, from 0), from_word (in the document, from 0), n_words.
    """
    placed, seats = _rings(docs, weights, share, most, block, shard_blocks, seed)
    return _passages(placed, seats, block).filter("shard IS NOT NULL").select(
        "doc_id", "source", "shard", "turn", "from_word", "n_words"
    )


def by_shard(
    docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
    block: int = 64, shard_blocks: int = 16384, seed: int = 0,
) -> DataFrame:
    """As ``mix``, summed over the shards' passages, with first_shard and last_shard (null: in none)."""
    placed, seats = _rings(docs, weights, share, most, block, shard_blocks, seed)
    row = ["doc_id", "source", "size", "source_size", "target", "place", "bucket", "nth"]
    return (
        _passages(placed, seats, block).groupBy(*row)
        .agg(
            F.coalesce(F.sum("n_words"), F.lit(0)).cast("long").alias("taken"),
            F.min("shard").alias("first_shard"), F.max("shard").alias("last_shard"),
        )
        .drop("place", "bucket", "nth")
    )
