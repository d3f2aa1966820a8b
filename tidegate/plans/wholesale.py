"""Weekly order-book reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.functions.times import as_date
from tidegate.operators.reconcile import exceeds, recon_summary, reconcile


def rsp_reconciliation(billing: DataFrame, crm: DataFrame, run_date, compare=("rsp_id", "product_code")) -> dict[str, DataFrame]:
    live = billing.filter(
        F.col("billing_status").isin("ACTIVE", "SUSPENDED") & (F.col("effective_from") < F.date_add(as_date(run_date), 1))
    )
    open_crm = crm.filter(F.col("status").isin("Active", "Suspended"))
    found = reconcile(live, open_crm, "order_id", compare, "rate_per_gbps", ["service_id"])
    found = found.withColumn("recon_date", as_date(run_date))
    return {
        "discrepancies": found,
        "summary": recon_summary(found),
        "alert": exceeds(found),
        "alert_by_rsp": exceeds(found, 51, by=["rsp_id"]),
    }
