"""Revenue journals and their balance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.functions.numbers import MONEY
from tidegate.functions.rules import DEFERRED_ACCOUNT, REVENUE_ACCOUNTS
from tidegate.functions.text import map_codes
from tidegate.functions.times import as_date, in_month, month_label

# Fixed values of the ledger interface.
GL_STATUS, GL_LEDGER, GL_CURRENCY = "NEW", 2001, "AUD"
GL_BATCH_PREFIX = "AIRFLOW-REVREC-"


def billable_lines(lines: DataFrame, headers: DataFrame, month) -> DataFrame:
    """Complete, non-tax invoice lines whose ledger date lies in the month."""
    kept = headers.filter(in_month("gl_date", month) & (F.col("complete_flag") == "Y"))
    return lines.filter(F.col("line_type") != "TAX").join(kept, "header_id")


def journal_entries(ar: DataFrame, deferred: DataFrame, month, balancing: bool = False) -> DataFrame:
    """Credit-only revenue lines; ``balancing`` adds the debit side."""
    first = F.trunc(as_date(month), "month")
    label = month_label(first)

    def rows(df, account, amount, description, source, line_type):
        return df.select(
            first.alias("journal_date"),
            account.alias("account_code"),
            "rsp_id",
            F.lit(0).cast(MONEY).alias("debit"),
            F.col(amount).cast(MONEY).alias("credit"),
            description.alias("description"),
            F.lit(source).alias("source"),
            line_type.alias("line_type"),
        )

    kind = F.col("line_type")
    revenue = rows(
        ar.filter(kind.isin(*REVENUE_ACCOUNTS)),
        map_codes(kind, REVENUE_ACCOUNTS, None),
        "amount",
        F.concat(kind, F.lit(" Revenue "), label),
        "AR",
        kind,
    )
    amortised = rows(
        deferred,
        F.lit(DEFERRED_ACCOUNT),
        "current_period_recognition",
        F.concat(F.lit("Deferred Connection Fee Amort "), label),
        "DEFERRED",
        F.lit("CONNECTION_FEE"),
    )
    out = revenue.unionByName(amortised)
    if balancing:
        contra = out.groupBy("journal_date", "rsp_id").agg(F.sum("credit").cast(MONEY).alias("debit"))
        out = out.unionByName(
            contra.select(
                "journal_date",
                F.lit("1200").alias("account_code"),
                "rsp_id",
                "debit",
                F.lit(0).cast(MONEY).alias("credit"),
                F.concat(F.lit("Receivable "), label).alias("description"),
                F.lit("BALANCING").alias("source"),
                F.lit("RECEIVABLE").alias("line_type"),
            )
        )
    return out


def to_gl_interface(journals: DataFrame, month) -> DataFrame:
    label = month_label(as_date(month))
    return journals.select(
        F.lit(GL_STATUS).alias("status"),
        F.lit(GL_LEDGER).alias("ledger_id"),
        F.col("journal_date").alias("accounting_date"),
        F.col("account_code").alias("segment1"),
        F.lit(GL_CURRENCY).alias("currency_code"),
        F.col("debit").alias("entered_dr"),
        F.col("credit").alias("entered_cr"),
        "description",
        F.concat(F.lit(GL_BATCH_PREFIX), label).alias("reference10"),
    )
