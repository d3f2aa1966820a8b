"""Exact distinct counts that are kept up by the day: bitmaps of ids, built once per day and united at any grain.

A day's bitmaps hold one bit per id in buckets of 32,768 ids, so a refresh reads the new day alone and the
counts of a week, a month or of a coarser key come from the stored bitmaps without the facts. Ids are
non-negative whole numbers (as from ``keys.dense_ids``); null ids count nowhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily_bitmaps(df: DataFrame, by: Sequence[str], day: str, key: str) -> DataFrame:
    """One row per group, day and bucket of ids: (…by, day, bucket, bits)."""
    ids = F.col(key).cast("long")
    return (
        df.filter(ids >= 0).groupBy(*by, day, F.bitmap_bucket_number(ids).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(ids)).alias("bits"))
    )


def distinct_counts(bitmaps: DataFrame, by: Sequence[str], alias: str) -> DataFrame:
    """Distinct ids per group of ``by``, over all days and finer groups that ``bitmaps`` holds."""
    united = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return united.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias(alias))


def trailing_counts(bitmaps: DataFrame, by: Sequence[str], day: str, days: int, last, alias: str) -> DataFrame:
    """Distinct ids of the ``days`` up to and including each day, up to ``last``: every bitmap is united into the days that look back on it."""
    seen = bitmaps.withColumn("as_of", F.explode(F.sequence(F.col(day), F.date_add(day, days - 1))))
    return distinct_counts(seen.filter(F.col("as_of") <= F.lit(last).cast("date")), [*by, "as_of"], alias)
