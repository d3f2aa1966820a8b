"""Run log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.times import as_date


def audit_row(spark: SparkSession, pipeline: str, run_id: str, table: str, run_date) -> DataFrame:
    return spark.range(1).select(
        F.lit(pipeline).alias("dag_id"),
        F.lit(run_id).alias("run_id"),
        F.lit(table).alias("target_table"),
        as_date(run_date).alias("run_date"),
        F.current_timestamp().alias("loaded_at"),
    )
