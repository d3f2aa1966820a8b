"""General ledger, receivables, payables and project actuals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.functions.numbers import is_reversal
from tidegate.functions.rules import payment_status, transaction_type
from tidegate.functions.text import composite_id, decode_segments
from tidegate.functions.times import to_business_time
from tidegate.operators.joins import lookup
from tidegate.operators.reconcile import ar_gl_reconciliation


def journal_lines(lines: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Posted lines only, decoded, categorised, in business time."""
    posted = lines.filter(F.col("status") == "P")
    df = decode_segments(posted).withColumns(
        {
            "je_line_id": composite_id("je_header_id", "je_line_num"),
            "is_reversal": is_reversal(F.coalesce(F.col("accounted_dr"), F.lit(0)) + F.coalesce(F.col("accounted_cr"), F.lit(0))),
            "_ebs_last_update_date": to_business_time("last_update_date"),
        }
    )
    return lookup(df, taxonomy, "je_category_name", ["je_category"], defaults={"je_category": "UNKNOWN"})


def period_open_flag(lines: DataFrame, periods: DataFrame) -> DataFrame:
    """Warn on lines whose accounting period is still open."""
    out = lookup(lines, periods, "period_name", ["closing_status"])
    return out.withColumn("_period_open_flag", F.coalesce(F.col("closing_status") == "O", F.lit(False)))


def receivables(ar: DataFrame, today) -> DataFrame:
    return ar.withColumns(
        {
            "payment_status": payment_status("invoice_amount", "amount_due_remaining", "due_date", today),
            "is_reversal": is_reversal("invoice_amount"),
        }
    )


def payables(ap: DataFrame, categories: DataFrame) -> DataFrame:
    paid = F.col("amount_paid")
    status = F.when(paid >= F.col("invoice_amount"), "Paid").when(paid > 0, "Partially Paid").otherwise("Unpaid")
    df = ap.withColumns({"payment_status": status, "amount_remaining": F.col("invoice_amount") - paid})
    return lookup(df, categories, "account_code", ["expense_category"], defaults={"expense_category": "Opex"})


def project_actuals(df: DataFrame) -> DataFrame:
    return df.withColumns({"transaction_type": transaction_type("gl_posted", "po_backed"), "is_reversal": is_reversal("amount_aud")})


def finance_load(lines: DataFrame, taxonomy: DataFrame, periods: DataFrame, ar: DataFrame, ap: DataFrame, categories: DataFrame,
                 actuals: DataFrame, today) -> dict[str, DataFrame]:
    gl = period_open_flag(journal_lines(lines, taxonomy), periods)
    invoices = receivables(ar, today)
    return {
        "journal_lines": gl,
        "receivables": invoices,
        "payables": payables(ap, categories),
        "project_actuals": project_actuals(actuals),
        "reconciliation": ar_gl_reconciliation(invoices, gl),
    }
