"""Hourly node health and weekly port audit."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidegate.operators.aggregates import (
    flag_summary,
    node_alerts,
    node_hour,
    port_utilisation,
    remediation_queue,
    scored_nodes,
)
from tidegate.operators.merge import upsert


def node_health(samples: DataFrame, alerts_so_far: DataFrame | None = None) -> dict[str, DataFrame]:
    scored = scored_nodes(node_hour(samples))
    alerts = node_alerts(scored)
    if alerts_so_far is not None:
        alerts = upsert(alerts_so_far, alerts, ["node_id", "hour_label"])
    return {"health": scored, "alerts": alerts}


def port_audit(splitters: DataFrame, splitter_ports: DataFrame, cabinets: DataFrame, cabinet_ports: DataFrame, run_date) -> dict[str, DataFrame]:
    s = port_utilisation(splitters, splitter_ports, "splitter_id", "total_ports", run_date=run_date)
    c = port_utilisation(
        cabinets, cabinet_ports, "rim_id", "total_dsl_ports", statuses=("ACTIVE",), flag="cabinet", run_date=run_date
    ).withColumnRenamed("active_ports", "active_dsl_ports")
    return {
        "splitters": s,
        "cabinets": c,
        "remediation": remediation_queue(s, c),
        "splitter_flags": flag_summary(s, "flag"),
    }
