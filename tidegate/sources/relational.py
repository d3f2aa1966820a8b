"""Relational pull over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_sql(
    spark: SparkSession,
    url: str,
    query: str,
    partition_col: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 16,
    fetchsize: int = 10_000,
    **options: str,
) -> DataFrame:
    """Run ``query`` at the source and read the result straight into executors.

    With ``partition_col`` and ``bounds`` the result is pulled by several tasks
    at once. Without them it is one task, fine for small extracts only.
    """
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", fetchsize).options(**options)
    if partition_col is None:
        return reader.option("query", query).load()
    low, high = bounds
    return (
        reader.option("dbtable", f"({query}) src")
        .option("partitionColumn", partition_col)
        .option("lowerBound", low)
        .option("upperBound", high)
        .option("numPartitions", partitions)
        .load()
    )
