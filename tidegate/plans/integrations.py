"""File, queue, document-store and legacy loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.times import as_date, business_date, in_window
from tidegate.operators.aggregates import poor_signal
from tidegate.operators.incremental import next_watermark, read_incremental
from tidegate.operators.keys import dedupe_latest
from tidegate.operators.merge import replace_date, replace_range, upsert
from tidegate.operators.quality import Gate, enforce
from tidegate.sources.files import list_inputs, read_csv_strict, read_jsonl, scan_date
from tidegate.sources.landed import decode_clickstream, flatten_incident, parse_or_deadletter
from tidegate.sources.schemas import LEGACY_BILLING_COLUMNS, ORDER_EVENT, RSP_BILLING_FILE, STATION_TELEMETRY

BILLING_KEYS = ["rsp_id", "billing_date", "service_id"]


def rsp_billing_files(spark: SparkSession, pattern: str, target: DataFrame | None, run_date) -> dict[str, DataFrame]:
    """Strict CSV drop; the newest file wins for a repeated statement line."""
    rows = read_csv_strict(spark, list_inputs(spark, pattern), RSP_BILLING_FILE)
    rows = rows.withColumn("loaded_at", F.current_timestamp())
    batch = dedupe_latest(rows, BILLING_KEYS, ["loaded_at"])
    if target is not None:
        batch = upsert(
            target, batch, BILLING_KEYS, update_cols=["plan_code", "charge_amount", "currency", "loaded_at"]
        )
    return {"statements": batch, "gate": billing_gate(batch, run_date).report()}


def billing_gate(batch: DataFrame, run_date) -> Gate:
    return Gate(batch, "rsp_billing").min_rows(1, where=F.col("billing_date") == as_date(run_date))


def station_telemetry(spark: SparkSession, path: str, target: DataFrame | None, start, end) -> dict[str, DataFrame]:
    rows = read_jsonl(spark, path, STATION_TELEMETRY).withColumn("run_date", business_date("telemetry_ts"))
    table = rows if target is None else replace_range(target, rows, "telemetry_ts", start, end)
    hour = table.filter(in_window("telemetry_ts", start, end))
    return {"telemetry": table, "poor_signal": poor_signal(hour), "gate": telemetry_gate(table, start, end).report()}


def telemetry_gate(table: DataFrame, start, end) -> Gate:
    return Gate(table, "telemetry").threshold("poor_signal", in_window("telemetry_ts", start, end) & (F.col("signal_dbm") < -100))


def order_events(raw: DataFrame, body: str = "body") -> dict[str, DataFrame]:
    good, dead = parse_or_deadletter(raw, body, ORDER_EVENT)
    return {"events": good.withColumn("event_timestamp", F.col("event_timestamp").try_cast("timestamp_ntz")), "dead_letters": dead}


def legacy_billing(source: DataFrame, target: DataFrame | None, run_date) -> dict[str, DataFrame]:
    """Complete snapshot of one date; nothing for the date is an error."""
    batch = scan_date(source.select(*LEGACY_BILLING_COLUMNS), "billing_date", run_date)
    gate = enforce(Gate(batch, "legacy_billing").min_rows(1).report())
    table = batch if target is None else replace_date(target, batch, "billing_date", run_date)
    return {"records": table, "gate": gate}


def noc_incidents(docs: DataFrame, target: DataFrame | None, watermark) -> dict[str, object]:
    pulled = flatten_incident(read_incremental(docs, "updated_at", watermark, inclusive=True))
    merged = pulled if target is None else upsert(target, pulled, ["incident_id"], order_by=["updated_at"])
    return {"incidents": merged, "watermark": lambda: next_watermark(pulled, "updated_at") or watermark}


def clickstream(raw: DataFrame, target: DataFrame | None, start, end) -> dict[str, DataFrame]:
    batch = decode_clickstream(raw, start, end)
    return {"clicks": batch if target is None else replace_range(target, batch, "arrival_ts", start, end)}
