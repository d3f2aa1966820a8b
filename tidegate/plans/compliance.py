"""Weekly regulatory report."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidegate.operators.aggregates import congestion_metrics, regulatory_metrics
from tidegate.operators.keys import anonymise
from tidegate.session import cut_lineage

# The columns of the published submission.
SUBMISSION_COLUMNS = (
    "report_date", "state_territory", "technology_type", "rsp_anon_id", "total_activations",
    "sla_compliance_pct", "total_faults", "resolved_2bd", "resolved_5bd", "msf_event_count",
    "total_affected_premises", "congested_hours", "peak_utilisation_pct",
)


def regulatory_report(facts: DataFrame, utilisation: DataFrame, poi: DataFrame, run_date) -> dict[str, DataFrame]:
    """``facts``: the activations and incidents, see ``regulatory_metrics``."""
    metrics = regulatory_metrics(facts, congestion_metrics(utilisation, poi, run_date), run_date)
    # The submission reads the finished report, so the rollups run once.
    metrics = cut_lineage(metrics)
    return {"metrics": metrics, "submission": anonymise(metrics, "rsp_id", "rsp_anon_id").select(*SUBMISSION_COLUMNS)}
