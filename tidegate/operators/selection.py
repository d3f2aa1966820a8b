"""Exact percentiles where no buffer may grow with the values: by rank, and as of every day."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegate.functions.numbers import round_dec
from tidegate.functions.times import as_date
from tidegate.session import scratch_dir


def percentiles_by_rank(df: DataFrame, by: Sequence[str], value: str, shares: Mapping[str, float]) -> DataFrame:
    """Exact interpolated percentiles of ``value`` per group, one column for each of ``shares``, whatever the values are.

    The values are sorted over the cluster by range, so a group of any size lies in many partitions, and
    written with their places. A group's partitions have one count each; these say in which partition,
    and where in it, the two neighbours of a percentile stand, and only those places are read again. No group is gathered.
    Nulls are no values; groups without values have no row; a null group key is a group.
    """
    path = scratch_dir(df.sparkSession, "ranks")
    part, offset = F.shiftright("_at", 33).cast("int"), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sorted_rows = (
        df.filter(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_value"))
        .repartitionByRange(*by, "_value").sortWithinPartitions(*by, "_value").withColumn("_at", F.monotonically_increasing_id())
        .select("*", part.alias("_part"), offset.alias("_offset")).drop("_at")
    )
    sorted_rows.write.parquet(path)
    rows = df.sparkSession.read.schema(sorted_rows.schema).parquet(path)
    runs = rows.groupBy(*by, "_part").agg(F.min("_offset").alias("_first"), F.count("*").alias("_n"))
    group = Window.partitionBy(*by)
    before = F.coalesce(F.sum("_n").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.withColumn("_before", before).withColumn("_all", F.sum("_n").over(group))
    wanted = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), ((F.col("_all") - 1) * F.lit(float(p))).alias("rank")) for name, p in shares.items()]))
    places = (
        runs.withColumn("_w", wanted)
        .withColumn("_rank", F.explode(F.array(F.floor("_w.rank"), F.ceil("_w.rank"))))
        .withColumn("_upper", F.col("_rank") > F.col("_w.rank"))
        .filter((F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_n")))
        .select(*by, "_part", (F.col("_first") + F.col("_rank") - F.col("_before")).alias("_offset"),
                F.col("_w.name").alias("_name"), (F.col("_w.rank") - F.floor("_w.rank")).alias("_share"), "_upper")
    )
    found = places.join(rows.select("_part", "_offset", "_value"), ["_part", "_offset"])
    weight = F.when(F.col("_upper"), F.col("_share")).otherwise(F.when(F.col("_share") > 0, 1 - F.col("_share")).otherwise(0.5))
    # A percentile that falls on a value has that value as both neighbours.
    return found.groupBy(*by).agg(
        *[round_dec(F.sum(F.when(F.col("_name") == name, F.col("_value") * weight)), 4).cast("double").alias(name) for name in shares]
    )


def percentile_as_of(df: DataFrame, by: Sequence[str], day: str, value: str, p: float, days: int, last, alias: str) -> DataFrame:
    """The percentile of the ``days`` before and on each day, for every day up to ``last`` that has a value in reach.

    Equal values of a day are counted first; the daily histogram then counts for each of the days that look back on
    it, so a fact travels once and a group's day holds one row per distinct value. ``value`` must lie on a grid.
    """
    daily = df.filter(F.col(value).isNotNull() & F.col(day).isNotNull()).groupBy(*by, day, value).agg(F.count("*").alias("_n"))
    seen = daily.withColumn("as_of", F.explode(F.sequence(F.col(day), F.date_add(day, days)))).filter(F.col("as_of") <= as_date(last))
    sliding = seen.groupBy(*by, "as_of", value).agg(F.sum("_n").alias("_n"))
    return sliding.groupBy(*by, "as_of").agg(
        F.sum("_n").alias("rows"), round_dec(F.percentile(F.col(value).cast("double"), p, F.col("_n")), 4).cast("double").alias(alias)
    )
