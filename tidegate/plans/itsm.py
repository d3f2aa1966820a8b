"""Incidents, task SLAs, problems and work orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.functions.rules import reportable_fault
from tidegate.functions.times import boundary_diff, business_minutes, to_business_time
from tidegate.operators.aggregates import sla_breach_summary, technician_performance
from tidegate.operators.keys import any_flag, rework_flag


def incidents_with_flags(incidents: DataFrame, slas: DataFrame) -> DataFrame:
    df = any_flag(incidents, slas.withColumnRenamed("incident_sys_id", "snow_sys_id"), "snow_sys_id", "has_breached", "sla_breached_flag")
    df = df.withColumns({c: to_business_time(c) for c in ("opened_at", "resolved_at")})
    return df.withColumns(
        {
            "resolution_minutes": boundary_diff("minute", "opened_at", "resolved_at"),
            "accc_reportable_flag": reportable_fault("priority", "category", "customer_impact_count", "state"),
        }
    )


def task_slas(slas: DataFrame, holidays=()) -> DataFrame:
    """Calendar and working minutes of each SLA clock, net of pauses.

    Input times are UTC; working hours are counted in business time.
    """
    start, end = to_business_time("start_time"), to_business_time("end_time")
    pause = F.coalesce(F.col("pause_duration_minutes"), F.lit(0))
    return slas.withColumns(
        {
            "actual_elapsed_minutes": boundary_diff("minute", start, end),
            "net_elapsed_minutes": boundary_diff("minute", start, end) - pause,
            "business_duration_minutes": business_minutes(start, end, holidays, pause),
        }
    )


def problems_with_counts(problems: DataFrame, incidents: DataFrame) -> DataFrame:
    linked = incidents.filter(F.col("problem_id").isNotNull()).groupBy("problem_id").agg(F.count("*").alias("linked_incident_count"))
    out = problems.join(linked.withColumnRenamed("problem_id", "snow_sys_id"), "snow_sys_id", "left")
    return out.withColumn("linked_incident_count", F.coalesce(F.col("linked_incident_count"), F.lit(0).cast("long")))


def work_orders(orders: DataFrame, direction: str = "later") -> DataFrame:
    df = orders.withColumn("time_on_site_minutes", boundary_diff("minute", "actual_start", "actual_end"))
    return rework_flag(df, direction=direction)


def itsm_load(incidents: DataFrame, slas: DataFrame, problems: DataFrame, orders: DataFrame, holidays=()) -> dict[str, DataFrame]:
    inc = incidents_with_flags(incidents, slas)
    wo = work_orders(orders)
    return {
        "incidents": inc,
        "task_slas": task_slas(slas, holidays),
        "problems": problems_with_counts(problems, incidents),
        "work_orders": wo,
        "sla_breach_summary": sla_breach_summary(inc),
        "technician_performance": technician_performance(wo),
    }
