"""Survey responses, topic scores, daily NPS and the link to faults."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.functions.numbers import normalise_score
from tidegate.functions.rules import sentiment_category
from tidegate.functions.text import composite_id
from tidegate.functions.times import to_business_time
from tidegate.operators.aggregates import nps_daily
from tidegate.operators.merge import apply_retention, recompute_tail

FAULT_TOPIC = "FAULT_RESOL"


def survey_responses(df: DataFrame, programmes: DataFrame) -> DataFrame:
    """Category, 0-100 satisfaction by the programme's own scale, business date."""
    scale = programmes.select("programme_id", "scale_low", "scale_high")
    out = df.join(scale, "programme_id", "left")
    s = F.col("nps_score")
    return out.withColumns(
        {
            "nps_category": F.when(s >= 9, "Promoter").when(s >= 7, "Passive").when(s.isNotNull(), "Detractor"),
            "overall_satisfaction_score": normalise_score("satisfaction", F.col("scale_low"), F.col("scale_high")),
            "response_timestamp": to_business_time("response_timestamp"),
        }
    ).withColumn("response_date", F.to_date("response_timestamp")).drop("scale_low", "scale_high")


def topic_scores(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "topic_score_id": composite_id("response_id", "topic_code"),
            "sentiment_category": sentiment_category("sentiment_score"),
        }
    )


def cx_fault_correlation(responses: DataFrame, incidents: DataFrame, topics: DataFrame) -> DataFrame:
    fault = topics.filter(F.col("topic_code") == FAULT_TOPIC).select(
        "response_id", F.col("sentiment_score").alias("fault_resolution_sentiment")
    )
    inc = incidents.select(
        F.col("snow_sys_id").alias("servicenow_incident_id"),
        F.col("priority").alias("incident_priority"),
        "resolution_minutes",
        "sla_breached_flag",
    )
    return (
        responses.join(inc, "servicenow_incident_id")
        .join(fault, "response_id", "left")
        .select(
            "response_id", "response_date", "servicenow_incident_id", "incident_priority", "resolution_minutes",
            "sla_breached_flag", "nps_score", "nps_category", "fault_resolution_sentiment",
            "overall_satisfaction_score", "rsp_code",
        )
    )


def cx_load(responses: DataFrame, programmes: DataFrame, topics: DataFrame, incidents: DataFrame, today: str,
            nps_so_far: DataFrame | None = None, years: int = 3) -> dict[str, DataFrame]:
    r = apply_retention(survey_responses(responses, programmes), "response_date", today, years)
    t = topic_scores(topics)
    daily = nps_daily(r) if nps_so_far is None else recompute_tail(nps_so_far, r, "response_date", today, nps_daily)
    return {"responses": r, "topics": t, "nps_daily": daily, "correlation": cx_fault_correlation(r, incidents, t)}
