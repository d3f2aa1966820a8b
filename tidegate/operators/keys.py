"""One row per key, flags per key, recent rows per key.

All of these are written so that a key holding a large share of the rows is
reduced inside the map tasks first: either the aggregate has a partial phase,
or the row-number filter is pruned before the exchange.
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.numbers import round_dec
from tidegate.session import scratch_dir

RANK = "_rank"


def _ordering(df: DataFrame, order_by: Sequence[Column | str], keys: Sequence[str], newest: bool) -> list[Column]:
    chosen = []
    for c in order_by:
        if isinstance(c, str):
            chosen.append(F.desc_nulls_last(c) if newest else F.asc_nulls_last(c))
        else:
            chosen.append(c)
    # Break the remaining ties by the other columns, so a rerun picks the same row.
    named = {c for c in order_by if isinstance(c, str)} | set(keys)
    for f in df.schema.fields:
        if f.name not in named and not isinstance(f.dataType, (T.MapType, T.VariantType)):
            chosen.append(F.desc_nulls_last(f"`{f.name}`") if newest else F.asc_nulls_last(f"`{f.name}`"))
    return chosen


def _pick(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str], newest: bool) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*_ordering(df, order_by, keys, newest))
    return df.withColumn(RANK, F.row_number().over(w)).filter(F.col(RANK) == 1).drop(RANK)


def dedupe_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """Keep the newest row of each key."""
    return _pick(df, keys, order_by, newest=True)


def dedupe_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """Keep the oldest row of each key."""
    return _pick(df, keys, order_by, newest=False)


SPREAD = "_spread"


def with_spread(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds a second join key that sends rows without a key, which match nothing, to different places."""
    no_key = reduce(operator.or_, [F.col(k).isNull() for k in keys])
    return df.withColumn(SPREAD, F.when(no_key, F.monotonically_increasing_id()).otherwise(F.lit(-1).cast("long")))


def newest_rows(df: DataFrame, keys: Sequence[str], order_by: str, n: int) -> DataFrame:
    """The ``n`` newest rows per key, numbered in ``_rank``; pruned per map task first."""
    w = Window.partitionBy(*keys).orderBy(*_ordering(df, [order_by], keys, True))
    return df.withColumn(RANK, F.row_number().over(w)).filter(F.col(RANK) <= n)


def latest_two(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str,
    values: Sequence[str],
    derive: Callable[[DataFrame], DataFrame] = lambda d: d,
) -> DataFrame:
    """Newest row per key with the previous values and their difference.

    ``derive`` may compute the values; it sees the two surviving rows of each
    key only. The last step is a plain aggregate over those two rows.
    """
    two = derive(newest_rows(df, keys, order_by, 2))

    def at(rank: int, c: str) -> Column:
        return F.max(F.when(F.col(RANK) == rank, F.col(c)))

    picks = [at(1, order_by).alias(order_by)]
    for v in values:
        picks += [at(1, v).alias(f"{v}_current"), at(2, v).alias(f"{v}_prior")]
    out = two.groupBy(*keys).agg(*picks)
    return out.withColumns(
        {f"{v}_wow_delta": round_dec(F.col(f"{v}_current") - F.col(f"{v}_prior"), 4) for v in values}
    )


def any_flag(parent: DataFrame, child: DataFrame, key: str, flag: str, alias: str | None = None) -> DataFrame:
    """True when any linked child row carries the flag, false when none does."""
    alias = alias or flag
    per_key = child.groupBy(key).agg(F.bool_or(flag).alias(alias))
    return parent.join(per_key, key, "left").withColumn(alias, F.coalesce(F.col(alias), F.lit(False)))


def sustained(df: DataFrame, key: str, hour: str, flag: str, n: int = 3) -> DataFrame:
    """Runs of at least ``n`` consecutive flagged hours per key.

    Rows are first reduced to one per key and hour, so the window of one key
    never holds more rows than there are hours in the data.
    """
    hours = df.filter(F.coalesce(F.col(flag), F.lit(False))).select(key, hour).distinct()
    index = F.floor(F.unix_seconds(F.col(hour).cast("timestamp")) / 3600)
    w = Window.partitionBy(key).orderBy(hour)
    runs = hours.withColumn("_run", index - F.row_number().over(w))
    return (
        runs.groupBy(key, "_run")
        .agg(
            F.min(hour).alias("run_start"),
            F.max(hour).alias("run_end"),
            F.count("*").alias("hours"),
        )
        .filter(F.col("hours") >= n)
        .drop("_run")
    )


def rework_flag(
    orders: DataFrame,
    address: str = "location_address",
    scheduled: str = "scheduled_start",
    days: int = 30,
    direction: str = "later",
    alias: str = "rework_flag",
) -> DataFrame:
    """Is there another order at the same address within ``days``?

    Time is cut into buckets of that length. Any order in the same bucket is
    near enough, and in the next (or previous) bucket only the earliest (or
    latest) order matters. So per-bucket minimum, maximum and count decide it:
    no self join, and no address is ever gathered into one sorted window.
    """
    at = F.unix_micros(F.col(scheduled).cast("timestamp"))
    span = days * 86_400_000_000
    rows = orders.withColumns({"_at": at, "_b": F.floor(at / span)})
    per_bucket = (
        rows.filter(F.col(address).isNotNull() & F.col("_at").isNotNull())
        .groupBy(address, "_b")
        .agg(F.min("_at").alias("_lo"), F.max("_at").alias("_hi"), F.count("*").alias("_n"))
    )
    # Each summary is also sent to the bucket before (and after) it, which looks
    # at its edge. Only summaries are multiplied; the orders are joined once.
    views = [
        F.struct("_b", "_lo", "_hi", "_n", F.lit(None).cast("long").alias("_next_lo"), F.lit(None).cast("long").alias("_prev_hi")),
        _neighbour(F.col("_b") - 1, next_lo=F.col("_lo")),
    ]
    near = (F.col("_hi") > F.col("_at")) | (F.col("_next_lo") <= F.col("_at") + span)
    if direction == "any":
        views.append(_neighbour(F.col("_b") + 1, prev_hi=F.col("_hi")))
        near = near | (F.col("_n") > 1) | (F.col("_prev_hi") >= F.col("_at") - span)
    edges = (
        per_bucket.select(address, F.explode(F.array(*views)).alias("_v"))
        .select(address, "_v.*")
        .groupBy(address, "_b")
        .agg(*[F.max(c).alias(c) for c in ("_hi", "_n", "_next_lo", "_prev_hi")])
    )
    out = rows.join(edges, [address, "_b"], "left")
    return out.withColumn(alias, F.coalesce(near, F.lit(False))).select(*orders.columns, alias)


def _neighbour(bucket: Column, next_lo: Column | None = None, prev_hi: Column | None = None) -> Column:
    empty = F.lit(None).cast("long")
    return F.struct(
        bucket.alias("_b"),
        empty.alias("_lo"),
        empty.alias("_hi"),
        empty.alias("_n"),
        (empty if next_lo is None else next_lo).alias("_next_lo"),
        (empty if prev_hi is None else prev_hi).alias("_prev_hi"),
    )


def dense_ids(df: DataFrame, key: str, alias: str) -> DataFrame:
    """Distinct keys numbered 1, 2, 3 … in key order, at any number of keys.

    The keys are dealt by range and written with the number of their range, so
    that all later steps see the same ranges. A key's number is the count of keys
    in the ranges before (one row per range) plus its place in its own.
    """
    spark = df.sparkSession
    keys = df.select(key).filter(F.col(key).isNotNull()).distinct()
    path = scratch_dir(spark, "ranges")
    keys.repartitionByRange(F.col(key)).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    ranged = spark.read.schema(T.StructType([df.schema[key], T.StructField("_range", T.IntegerType())])).parquet(path)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    starts = starts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(key))
    return ranged.withColumn("_place", place).join(starts, "_range").select(key, (F.col("_before") + F.col("_place")).alias(alias))


def anonymise(df: DataFrame, key: str, alias: str) -> DataFrame:
    """Replace ``key`` by its rank among the distinct keys."""
    ids = dense_ids(df, key, alias)
    return df.join(ids, key, "left").drop(key)


def with_group_max(df: DataFrame, key: str, value: str, alias: str) -> DataFrame:
    """Attach the maximum of the key. For groups of bounded size, such as one row a week: the input is read once."""
    return df.withColumn(alias, F.max(value).over(Window.partitionBy(key)))
