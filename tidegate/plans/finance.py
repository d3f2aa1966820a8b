"""Weekly capital projects and monthly revenue recognition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.functions.times import as_date
from tidegate.operators.aggregates import capex_summary, deferred_amortisation, evm_metrics, flag_summary, flagged, trial_balance
from tidegate.operators.journals import billable_lines, journal_entries, to_gl_interface
from tidegate.operators.merge import upsert
from tidegate.operators.quality import Gate


def capex_projects(projects: DataFrame, target: DataFrame | None, run_date) -> dict[str, DataFrame]:
    open_projects = projects.filter((F.col("key_date") <= as_date(run_date)) & (F.col("status") != "CLSD"))
    scored = evm_metrics(open_projects).withColumn("run_date", as_date(run_date))
    merged = scored if target is None else upsert(target, scored, ["project_id", "run_date"], order_by=["key_date"])
    return {
        "projects": merged,
        "risk": flag_summary(scored, "risk_level"),
        "critical": flagged(scored, "risk_level", ["CRITICAL"], ["project_id", "project_name"]),
        "summary": capex_summary(scored),
    }


def revenue_recognition(lines: DataFrame, headers: DataFrame, balances: DataFrame, month, balancing: bool = False) -> dict[str, DataFrame]:
    """Journals of one billing month, their ledger interface rows and balance."""
    journals = journal_entries(
        billable_lines(lines, headers, month), deferred_amortisation(balances, month), month, balancing
    )
    return {
        "journals": journals,
        "gl_interface": to_gl_interface(journals, month),
        "imbalance": trial_balance(journals, month),
        "gate": journal_gate(journals).report(),
    }


def journal_gate(journals: DataFrame) -> Gate:
    return Gate(journals, "journals").balance("credit", "debit")
