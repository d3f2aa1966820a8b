"""Copies to the second warehouse and the feature exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.operators.aggregates import billing_monthly, capex_indices
from tidegate.operators.keys import latest_two, with_group_max
from tidegate.operators.merge import upsert
from tidegate.operators.quality import Gate, enforce
from tidegate.sinks.control import audit_row
from tidegate.sinks.exports import unload
from tidegate.sinks.tables import full_refresh, replace_partition
from tidegate.sources.files import EmptyInput, scan_date


def network_performance_copy(
    spark: SparkSession, source: DataFrame, path: str, run_date: str, run_id: str, min_rows: int = 500, date_col: str = "report_date"
) -> dict[str, DataFrame]:
    replace_partition(scan_date(source, date_col, run_date), path, date_col, run_date)
    loaded = scan_date(spark.read.parquet(path), date_col, run_date)
    gate = enforce(Gate(loaded, "network_performance").min_rows(min_rows).report())
    return {"loaded": loaded, "gate": gate, "audit": audit_row(spark, "network_performance", run_id, "network_performance", run_date)}


def cvc_billing_copy(spark: SparkSession, source: DataFrame, path: str, run_date: str) -> dict[str, DataFrame]:
    replace_partition(scan_date(source, "billing_date", run_date), path, "billing_date", run_date)
    table = spark.read.parquet(path)
    loaded = scan_date(table, "billing_date", run_date)
    gate = enforce(Gate(loaded, "cvc_billing_lines").min_rows(1).not_null("rsp_id").report())
    return {"loaded": loaded, "gate": gate, "monthly": billing_monthly(table)}


def evm_trends(weeks: DataFrame) -> DataFrame:
    """Latest and prior week of both indices, per project."""
    t = latest_two(weeks, ["project_id"], "week_ending_date", ["cpi", "spi"], derive=capex_indices)
    return t.select(
        "project_id", "week_ending_date", "cpi_current", "cpi_prior", "cpi_wow_delta",
        "spi_current", "spi_prior", "spi_wow_delta",
    )


def capex_board(weeks: DataFrame) -> DataFrame:
    return with_group_max(capex_indices(weeks), "project_id", "loaded_at", "last_loaded_at")


def capex_copy(spark: SparkSession, source: DataFrame, path: str, trends_so_far: DataFrame | None = None) -> dict[str, DataFrame]:
    full_refresh(source, path)
    table = spark.read.parquet(path)
    trends = evm_trends(table)
    if trends_so_far is not None:
        trends = upsert(trends_so_far, trends, ["project_id", "week_ending_date"])
    return {"table": table, "trends": trends, "board": capex_board(table)}


def feature_export(tables: dict[str, tuple[DataFrame, str]], base: str, run_date: str) -> dict[str, str]:
    """Unload one date of each ``name -> (table, date column)``."""
    return {
        name: unload(scan_date(df, date_col, run_date), f"{base.rstrip('/')}/{name}/run_date={run_date}")
        for name, (df, date_col) in tables.items()
    }


def churn_scores(predictions: DataFrame, run_date) -> DataFrame:
    """Score rows to send, keyed by service; a date without predictions is an error."""
    rows = scan_date(predictions, "prediction_date", run_date).select(
        "service_id",
        F.col("churn_score").alias("Churn_Score__c"),
        F.col("churn_risk_band").alias("Churn_Risk_Band__c"),
        F.col("predicted_at").alias("Churn_Predicted_At__c"),
    )
    if rows.isEmpty():
        raise EmptyInput(f"no predictions for {run_date}")
    return rows
