"""Daily activations and weekly surveys."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.functions.rules import STATUS_LABELS, nps_category, sentiment, sla_met
from tidegate.functions.text import DEFAULT_REDACTIONS, clean_verbatim, map_codes
from tidegate.functions.times import as_date, elapsed_days, in_window
from tidegate.operators.aggregates import nps_scorecard, rsp_kpi_daily
from tidegate.operators.incremental import incremental_activations
from tidegate.operators.joins import lookup
from tidegate.operators.merge import upsert
from tidegate.operators.quality import Gate


def with_sla(activations: DataFrame, run_date=None) -> DataFrame:
    df = activations.withColumns(
        {
            "status": map_codes("status_code", STATUS_LABELS),
            "days_to_activate": elapsed_days("order_created_at", "activation_completed_at"),
            "customer_segment": F.upper("customer_segment"),
        }
    ).withColumn("sla_met", sla_met("status", "order_priority", "days_to_activate"))
    return df if run_date is None else df.withColumn("run_date", as_date(run_date))


def activation_gate(batch: DataFrame) -> Gate:
    return Gate(batch, "activations").rate("sla_met")


def rsp_activations(source: DataFrame, target: DataFrame | None, run_date) -> dict[str, DataFrame]:
    batch = with_sla(incremental_activations(source, run_date), run_date)
    merged = batch if target is None else upsert(target, batch, ["order_id"], order_by=["order_created_at"])
    return {
        "activations": merged,
        "batch": batch,
        "gate": activation_gate(batch).report(),
        "kpi": rsp_kpi_daily(merged),
    }


def score_responses(responses: DataFrame, patterns=DEFAULT_REDACTIONS) -> DataFrame:
    df = responses.withColumns(
        {
            "score": F.coalesce(F.col("score").try_cast("int"), F.lit(0)),
            "verbatim": clean_verbatim("verbatim", patterns=patterns),
        }
    )
    return df.withColumns({"nps_category": nps_category("score"), "sentiment": sentiment("verbatim", "score")})


def nps_survey(responses: DataFrame, mapping: DataFrame, run_date: str, patterns=DEFAULT_REDACTIONS) -> dict[str, DataFrame]:
    """The seven days before the run date, cleaned, scored and attributed."""
    d = dt.date.fromisoformat(run_date)
    first = d - dt.timedelta(days=7)
    week = responses.filter(in_window("completed_at", first.isoformat(), run_date))
    scored = score_responses(week, patterns).withColumn("week_start", F.lit(first))
    attributed = lookup(
        scored, mapping, "service_id", ["rsp_id", "rsp_name", "state_territory"],
        defaults={"rsp_id": "UNKNOWN", "rsp_name": "UNKNOWN"},
    )
    return {"responses": attributed, "scorecard": nps_scorecard(attributed)}
