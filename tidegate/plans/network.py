"""Hourly capacity and 15-minute outage loads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.functions.numbers import number_or_zero
from tidegate.functions.rules import mass_failure
from tidegate.functions.times import floor_hour, in_window
from tidegate.operators.incremental import next_watermark, read_incremental
from tidegate.operators.joins import congestion_alerts, cvc_utilisation, lookup
from tidegate.operators.keys import sustained
from tidegate.operators.merge import upsert


def cvc_capacity(events: DataFrame, contracts: DataFrame, run_date, start=None, end=None) -> dict[str, DataFrame]:
    """Utilisation of one closed hour (or of all events) against contracts."""
    if start is not None:
        events = events.filter(in_window("timestamp_utc", start, end))
    stamped = events.withColumn("hour_label", floor_hour("timestamp_utc"))
    utilisation = cvc_utilisation(stamped, contracts, run_date)
    return {
        "utilisation": utilisation,
        "alerts": congestion_alerts(utilisation),
        "sustained": sustained(utilisation, "poi_id", "hour_label", "congestion_flag"),
    }


def enrich_incidents(incidents: DataFrame, poi: DataFrame) -> DataFrame:
    """POI attributes, numeric premises, mass-failure flags."""
    df = incidents.withColumn("premises_count", number_or_zero("premises_count", "long"))
    df = lookup(df, poi.withColumnRenamed("poi_id", "affected_poi_id"), "affected_poi_id",
                ["poi_name", "state_territory", "technology_type"])
    return df.withColumns(
        {
            "msf_eligible": mass_failure("premises_count", "resolved_at"),
            # Sticky form: the size alone, so resolving an outage does not erase it.
            "msf_ever": F.coalesce(F.col("premises_count") >= 2500, F.lit(False)),
        }
    )


def outage_incidents(
    source: DataFrame, poi: DataFrame, target: DataFrame | None, watermark, updated: str = "sys_updated_on"
) -> dict[str, object]:
    """One poll: everything past the watermark, enriched and merged.

    The new watermark is the newest row of this poll. A page must not end a poll:
    rows that share the time at its edge would be passed over by the next one.
    """
    batch = read_incremental(source, updated, watermark, inclusive=False)
    enriched = enrich_incidents(batch, poi)
    merged = enriched if target is None else upsert(target, enriched, ["sys_id"], order_by=[updated])
    return {"incidents": merged, "batch": enriched, "watermark": lambda: next_watermark(batch, updated) or watermark}
