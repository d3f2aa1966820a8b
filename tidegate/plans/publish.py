"""The loads as writers: gates first, then only the partitions that a batch touches.

Every function may run again with the same input and leaves the same rows. A batch is
computed once: the job that stages it observes what its gate asks for, and the table is merged or
replaced from the staged copy. Tables are merged by their business key and partitioned by a month. A
time that is missing puts a row into the partition without a month; when it arrives or
is corrected, the row moves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.operators.quality import Gate, enforce
from tidegate.plans import customer, finance, infrastructure, integrations, network
from tidegate.sinks.staging import Arrivals, checked_batch, refresh_checked
from tidegate.sinks.tables import full_refresh, merge_into, replace_hour, replace_partition
from tidegate.sources.files import scan_date
from tidegate.sources.schemas import LEGACY_BILLING_COLUMNS

MONTH = "load_month"


def _by_month(df: DataFrame, time: str) -> DataFrame:
    return df.withColumn(MONTH, F.date_format(time, "yyyy-MM"))


def outage_poll(source: DataFrame, poi: DataFrame, path: str, watermark, updated: str = "sys_updated_on", least: int = 0):
    """Merge one poll of at least ``least`` rows; returns the next watermark."""
    batch = network.outage_incidents(source, poi, None, watermark, updated)["batch"]
    gate = lambda df: Gate(df, "outages").min_rows(least).not_null("sys_id")
    with checked_batch(batch, gate, newest=F.max(updated)) as (staged, seen):
        merge_into(_by_month(staged, "opened_at"), path, ["sys_id"], MONTH, [updated], staged=True)
    return seen["newest"] or watermark


def activations(source: DataFrame, path: str, run_date) -> None:
    batch = customer.rsp_activations(source, None, run_date)["batch"]
    with checked_batch(batch, customer.activation_gate) as (staged, _):
        merge_into(_by_month(staged, "order_created_at"), path, ["order_id"], MONTH, ["order_created_at"], staged=True)


def node_alerts(samples: DataFrame, path: str) -> None:
    """No alerts is good news, no samples is a failure."""
    arrivals = Arrivals(samples, "node_samples")
    with checked_batch(infrastructure.node_health(arrivals.df)["alerts"]) as (staged, _):
        arrivals.enforce()
        # The month follows from the hour, which is part of the key, so no other partition is searched.
        keys = ["node_id", "hour_label", MONTH]
        merge_into(_by_month(staged, "hour_label"), path, keys, MONTH, ["hour_label"], null_safe=["hour_label", MONTH], staged=True)


def billing_files(spark: SparkSession, pattern: str, path: str, run_date) -> None:
    rows = integrations.rsp_billing_files(spark, pattern, None, run_date)["statements"]
    keys = [*integrations.BILLING_KEYS, MONTH]
    with checked_batch(rows, lambda df: integrations.billing_gate(df, run_date)) as (staged, _):
        merge_into(_by_month(staged, "billing_date"), path, keys, MONTH, ["loaded_at"], null_safe=["billing_date", MONTH], staged=True, stamped=True)


def telemetry(spark: SparkSession, source: str, path: str, start, end) -> None:
    rows = integrations.station_telemetry(spark, source, None, start, end)["telemetry"]
    with checked_batch(rows, lambda df: integrations.telemetry_gate(df, start, end)) as (staged, _):
        replace_hour(staged, path, "telemetry_ts", str(start), str(end))


def legacy_billing(source: DataFrame, path: str, run_date: str) -> None:
    """A complete snapshot of one date; nothing for the date is an error."""
    rows = scan_date(source.select(*LEGACY_BILLING_COLUMNS), "billing_date", run_date)
    with checked_batch(rows, lambda df: Gate(df, "legacy_billing").min_rows(1)) as (staged, _):
        replace_partition(staged, path, "billing_date", run_date)


def noc_incidents(docs: DataFrame, path: str, watermark, least: int = 0):
    """Merge one pull of at least ``least`` rows; returns the next watermark."""
    batch = integrations.noc_incidents(docs, None, watermark)["incidents"]
    gate = lambda df: Gate(df, "noc_incidents").min_rows(least).not_null("incident_id")
    with checked_batch(batch, gate, newest=F.max("updated_at")) as (staged, seen):
        merge_into(_by_month(staged, "created_at"), path, ["incident_id"], MONTH, ["updated_at"], staged=True)
    return seen["newest"] or watermark


def clickstream(raw: DataFrame, path: str, start, end) -> None:
    clicks = integrations.clickstream(raw, None, start, end)["clicks"]
    with checked_batch(clicks, lambda df: Gate(df, "clicks").min_rows(1)) as (staged, _):
        replace_hour(staged, path, "arrival_ts", str(start), str(end))


def journals(lines: DataFrame, headers: DataFrame, balances: DataFrame, path: str, month, balancing: bool = True) -> None:
    """One month of journals, which must balance before it is written."""
    refresh_checked(
        finance.revenue_recognition(lines, headers, balances, month, balancing)["journals"], path, finance.journal_gate
    )


def checked(outputs: dict[str, DataFrame], paths: dict[str, str]) -> None:
    """Write the named outputs of a load whose gate holds."""
    enforce(outputs["gate"])
    for name, path in paths.items():
        full_refresh(outputs[name], path)
