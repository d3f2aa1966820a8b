"""Runs of hours and pairs of events, found while both sides still arrive.

State lives in Spark's own stateful operators. The watermark decides when a run is over or a row stays
unmatched; what comes later than ``delay`` behind the newest row is dropped, as in any such stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Flagged hours are an hour apart or at least two; anything between the two tells them apart.
HOUR_GAP = "90 minutes"


def sustained_stream(df: DataFrame, key: str, ts: str, flag: str, n: int = 3, delay: str = "2 hours") -> DataFrame:
    """Runs of at least ``n`` consecutive flagged hours per key: key, run_start, run_end, hours.

    The streaming twin of ``operators.keys.sustained``. Rows are cut to their hour; a session of
    flagged hours ends where an hour is missing, and a late hour within the delay joins two
    runs. Inside a session no hour is missing, so its first and last hour give the number of hours: the
    state of a key is one row per open run, however many rows arrive.
    """
    hours = (
        df.filter(F.coalesce(F.col(flag), F.lit(False)))
        .select(key, F.date_trunc("hour", F.col(ts).cast("timestamp")).alias("_hour"))
        .withWatermark("_hour", delay)
    )
    runs = hours.groupBy(key, F.session_window("_hour", HOUR_GAP)).agg(F.min("_hour").alias("first"), F.max("_hour").alias("last"))
    length = ((F.unix_seconds("last") - F.unix_seconds("first")) / 3600 + 1).cast("long")
    return runs.select(
        key,
        F.col("first").cast("timestamp_ntz").alias("run_start"),
        F.col("last").cast("timestamp_ntz").alias("run_end"),
        length.alias("hours"),
    ).filter(F.col("hours") >= n)


def preceded_by(
    later: DataFrame, earlier: DataFrame, keys: Sequence[str], later_ts: str, earlier_ts: str, within: str, delay: str = "2 hours"
) -> DataFrame:
    """Every ``later`` row with each ``earlier`` row of the same keys at most ``within`` before it, or with nulls.

    Works on two streams and on two batches. Both sides are kept in state only as long as a partner can
    still come; a row without a partner is emitted once the watermark has passed its interval. Rows with a
    null key meet nothing. Columns of ``earlier`` except the keys must have names of their own.
    """
    a = later.withWatermark(later_ts, delay).alias("a")
    b = earlier.withColumnsRenamed({k: f"_{k}" for k in keys}).withWatermark(earlier_ts, delay).alias("b")
    condition = (F.col(f"b.{earlier_ts}") <= F.col(f"a.{later_ts}")) & (
        F.col(f"b.{earlier_ts}") >= F.col(f"a.{later_ts}") - F.expr(f"INTERVAL {within}")
    )
    for k in keys:
        condition = condition & (F.col(f"a.{k}") == F.col(f"b._{k}"))
    return a.join(b, condition, "left_outer").drop(*[f"_{k}" for k in keys])
