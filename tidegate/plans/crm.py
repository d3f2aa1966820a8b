"""CRM accounts, cases, opportunities and contacts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.functions.numbers import annual_revenue, monthly_revenue
from tidegate.functions.text import mask
from tidegate.functions.times import boundary_diff, elapsed_hours, to_business_time
from tidegate.operators.aggregates import first_response_hours
from tidegate.operators.keys import any_flag
from tidegate.operators.merge import soft_delete, upsert
from tidegate.operators.quality import Gate

CONTACT_MASKS = {"email": "masked@example.com", "phone": "+61200000000"}


def cases_with_metrics(cases: DataFrame, comments: DataFrame, history: DataFrame) -> DataFrame:
    df = first_response_hours(cases, comments)
    df = any_flag(df, history, "sf_case_id", "is_escalated", "escalated_flag")
    return df.withColumn("resolution_hours", elapsed_hours("created_date", "closed_date"))


def opportunities(df: DataFrame) -> DataFrame:
    months = boundary_diff("month", "contract_start_date", "contract_end_date")
    out = df.withColumn("mrr_aud", monthly_revenue("amount", months))
    return out.withColumn("arr_aud", annual_revenue("mrr_aud"))


def accounts(df: DataFrame, opps: DataFrame, deleted: DataFrame) -> DataFrame:
    """Contracted services from won opportunities; a blank RSP code becomes null and is flagged."""
    won = opps.filter(F.col("stage") == "Closed Won").groupBy("sf_account_id").agg(F.sum("service_count").alias("contracted_services"))
    out = df.join(won, "sf_account_id", "left").withColumn(
        "contracted_services", F.coalesce(F.col("contracted_services"), F.lit(0).cast("long"))
    )
    out = out.withColumn("rsp_code", F.when(F.trim("rsp_code") != "", F.col("rsp_code")))
    out = out.withColumn("needs_review", F.col("rsp_code").isNull())
    return soft_delete(out, deleted, "sf_account_id", {"active_flag": False})


def case_gate(cases: DataFrame, accts: DataFrame, min_rows: int = 10) -> DataFrame:
    return (
        Gate(cases, "sf_cases")
        .min_rows(min_rows)
        .not_null("sf_account_id")
        .not_null("created_date")
        .value("resolution_hours", F.col("resolution_hours") >= 0)
        .foreign_key("sf_account_id", accts)
        .unique(["sf_case_id"])
        .report()
    )


def crm_load(
    accts: DataFrame, opps: DataFrame, cases: DataFrame, comments: DataFrame, history: DataFrame, contacts: DataFrame,
    deleted: DataFrame, env: str, cases_so_far: DataFrame | None = None,
) -> dict[str, DataFrame]:
    a = accounts(accts, opps, deleted)
    c = cases_with_metrics(cases, comments, history).withColumn("last_modified_date", to_business_time("last_modified_date"))
    merged = c if cases_so_far is None else upsert(cases_so_far, c, ["sf_case_id"], order_by=["last_modified_date"])
    return {
        "accounts": a,
        "opportunities": opportunities(opps),
        "cases": merged,
        "contacts": mask(contacts, env, CONTACT_MASKS),
        "gate": case_gate(c, a),
    }
