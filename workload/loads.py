"""The complete loads over the test tables: each runs from raw view to its main output."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.operators import aggregates as agg
from tidegate.plans import assets as assets_plan
from tidegate.plans import (
    compliance,
    crm,
    customer,
    experience,
    finance,
    infrastructure,
    integrations,
    itsm,
    ledger,
    network,
    publish,
    replication,
    wholesale,
)
from tidegate.sinks import tables
from tidegate.sources.schemas import LEGACY_BILLING_COLUMNS
from workload import control, core, landing, specs
from workload import views as v
from workload.registry import D, DAY, MONEY, PCT, R, SQL, Tables, query

def back(t: Tables, path: str, partition: str = publish.MONTH) -> DataFrame:
    """What a load has written, without the partition column."""
    return tables.read_partitioned(t.spark, path, T.StructField(partition, T.StringType())).drop(partition)


def source_table(t: Tables, df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table of the source system: every poll reads it, none derives it again."""
    path = t.scratch(label)
    df.write.parquet(path)
    return t.spark.read.schema(df.schema).parquet(path)


# --- network ---------------------------------------------------------------------------


@query("load_cvc_capacity", SQL["congestion_alerts"])
def load_cvc_capacity(t: Tables) -> DataFrame:
    traffic = v.hourly_traffic(t).withColumnRenamed("hour_label", "timestamp_utc")
    return network.cvc_capacity(traffic, v.contracts(t), v.CONTRACT_DAY)["alerts"]


OUTAGES = f"""WITH {v.ACCOUNTS}, {v.SHIPPED}, {v.INCIDENTS}
SELECT sys_id, opened_at, resolved_at, premises_count, affected_poi_id, opened_at AS sys_updated_on, c_name AS poi_name, r_name AS state_territory,
  c_mktsegment AS technology_type, premises_count >= 2500 AND resolved_at IS NULL AS msf_eligible, premises_count >= 2500 AS msf_ever
FROM incidents LEFT JOIN accounts ON c_custkey = affected_poi_id"""


@query("load_outages", OUTAGES)
def load_outages(t: Tables) -> DataFrame:
    """A first poll loads everything up to a day, a second one, run twice, the rest."""
    rows = v.incidents(t).select("sys_id", "opened_at", "resolved_at", "premises_count", "affected_poi_id")
    rows = source_table(t, rows.withColumn("sys_updated_on", F.col("opened_at")), "outage-source")
    poi, path = core.poi_registry(t), t.scratch("outages")
    mark = publish.outage_poll(rows.filter(F.col("sys_updated_on") <= dt.datetime(1999, 1, 1)), poi, path, None)
    for _ in range(2):
        publish.outage_poll(rows, poi, path, mark)
    return back(t, path)


UNTIMED = "sys_id % 5 = 0"


@query("load_outages_untimed", f"SELECT * REPLACE (CASE WHEN {UNTIMED} AND premises_count < 300000 THEN NULL ELSE opened_at END AS opened_at) FROM ({OUTAGES})")
def load_outages_untimed(t: Tables) -> DataFrame:
    """Every fifth outage comes without its time, three times over; those of the large ones arrive later."""
    rows = v.incidents(t).select("sys_id", "opened_at", "resolved_at", "premises_count", "affected_poi_id")
    rows = source_table(t, rows.withColumn("sys_updated_on", F.col("opened_at")), "outage-source")
    poi, path = core.poi_registry(t), t.scratch("outages")
    untimed = rows.withColumn("opened_at", F.when(~F.expr(UNTIMED), F.col("opened_at")))
    for _ in range(3):
        publish.outage_poll(untimed, poi, path, None)
    for _ in range(2):
        publish.outage_poll(rows.filter("premises_count >= 300000"), poi, path, None)
    return back(t, path)


# --- customer ----------------------------------------------------------------------------


@query(
    "load_activations",
    f"""WITH {v.ACTIVATIONS} SELECT {core.ACT_COLS}, customer_segment, status, '{core.ACT_DATE}' AS run_date, {D('days_to_activate')} AS days_to_activate, sla_met
FROM sla WHERE {core.OPEN_OR_DONE}""",
)
def load_activations(t: Tables) -> DataFrame:
    """Run twice for the same date: the second merge changes nothing."""
    path = t.scratch("activations")
    for _ in range(2):
        publish.activations(v.activations(t), path, core.ACT_DATE)
    return back(t, path)


WEEK = "completed_at >= DATE '2024-01-08' AND completed_at < DATE '2024-01-15'"


@query(
    "load_nps_survey",
    f"""WITH {core.SCORED}, {v.ACCOUNTS}, {core.RSP_MAP}
SELECT '2024-01-08' AS week_start, r_name AS state_territory, coalesce(CAST(c_nationkey AS VARCHAR), 'UNKNOWN') AS rsp_id, count(*) AS responses,
  {PCT('count(*) FILTER (WHERE score >= 9) - count(*) FILTER (WHERE score <= 6)', 'count(score)')} AS nps_score,
  count(*) FILTER (WHERE sentiment = 'negative') AS negative_comments
FROM answered LEFT JOIN mapping ON c_custkey = service_id WHERE {WEEK} GROUP BY r_name, coalesce(CAST(c_nationkey AS VARCHAR), 'UNKNOWN')""",
)
def load_nps_survey(t: Tables) -> DataFrame:
    return customer.nps_survey(v.responses(t), core.rsp_mapping(t), "2024-01-15")["scorecard"]


# --- wholesale and finance -----------------------------------------------------------------


@query(
    "load_reconciliation",
    f"WITH {v.ORDER_BOOKS} SELECT {core.RECON_COLS}, '2001-12-31' AS recon_date FROM recon WHERE discrepancy_type IS NOT NULL",
)
def load_reconciliation(t: Tables) -> DataFrame:
    return wholesale.rsp_reconciliation(v.billing_orders(t), v.crm_orders(t), "2001-12-31")["discrepancies"]


@query(
    "load_capex_projects",
    f"""WITH {v.EVM} SELECT category, '1999-12-31' AS run_date, count(*) AS projects, {D('sum(budget)')} AS approved_budget, {D('sum(actual)')} AS actual_cost,
{D('sum(earned)')} AS earned_value, count(*) FILTER (WHERE risk_level = 'CRITICAL') AS critical_projects, {PCT('sum(actual)', 'sum(budget)')} AS budget_utilisation_pct
FROM evm WHERE p_size <= 45 GROUP BY 1""",
)
def load_capex_projects(t: Tables) -> DataFrame:
    return finance.capex_projects(v.projects(t), None, "1999-12-31")["summary"]


@query("load_revenue", SQL["journal_entries"])
def load_revenue(t: Tables) -> DataFrame:
    return finance.revenue_recognition(v.ar_lines(t), v.ar_headers(t), v.deferred_balances(t), v.BILLING_MONTH)["journals"]


@query(
    "load_revenue_balanced",
    f"""WITH {v.JOURNALS}, sides AS (SELECT sum(credit) AS credit, sum(debit) AS debit FROM (
  SELECT credit, debit FROM journals UNION ALL SELECT 0, sum(credit) FROM journals GROUP BY journal_date, rsp_id))
SELECT 'journals.balance' AS "check", {D('abs(credit - debit)')} AS observed, CAST(0.01 AS DOUBLE) AS threshold, abs(credit - debit) <= 0.01 AS passed, 'fail' AS severity FROM sides""",
)
def load_revenue_balanced(t: Tables) -> DataFrame:
    """With the receivable side added the month balances."""
    out = finance.revenue_recognition(v.ar_lines(t), v.ar_headers(t), v.deferred_balances(t), v.BILLING_MONTH, balancing=True)
    return out["gate"]


# --- compliance and infrastructure -----------------------------------------------------------

SUBMITTED = [c for c in core.SUBMISSION_COLUMNS if c != "rsp_anon_id"]
SUBMISSION = f"""WITH {core.report_ctes('state', core.RUN_DATE)}
SELECT {', '.join(SUBMITTED)}, dense_rank() OVER (ORDER BY rsp_id) AS rsp_anon_id FROM report"""


@query("load_regulatory_report", SUBMISSION)
def load_regulatory_report(t: Tables) -> DataFrame:
    return compliance.regulatory_report(core.rated(v.activated_and_faulty(t)), core.utilisation(t), core.poi_registry(t), core.RUN_DATE)["submission"]


@query("load_node_health", core.ALERTS)
def load_node_health(t: Tables) -> DataFrame:
    samples, path = v.node_samples(t), t.scratch("alerts")
    publish.node_alerts(samples.filter(F.col("sample_ts") < dt.datetime(2024, 1, 16)), path)
    for _ in range(2):
        publish.node_alerts(samples, path)
    return back(t, path)


NULL_HOUR = "node_id % 4 = 0"


@query("load_node_health_untimed", core.ALERTS.replace("FROM scored", "FROM scored WHERE NOT (node_id % 4 = 0)").replace("WHERE health_status", "AND health_status"))
def load_node_health_untimed(t: Tables) -> DataFrame:
    """Samples without a time make one alert without an hour per node, however often they are merged."""
    samples, path = v.node_samples(t), t.scratch("alerts")
    samples = samples.withColumn("sample_ts", F.when(~F.expr(NULL_HOUR), F.col("sample_ts")))
    for _ in range(3):
        publish.node_alerts(samples, path)
    alerts = back(t, path)
    repeated = alerts.filter("hour_label IS NULL").groupBy("node_id", "node_type", "poi_id").count().filter("count > 1")
    return alerts.filter("hour_label IS NOT NULL").join(repeated, "node_id", "left_anti")


@query("load_port_audit", core.REMEDIATION)
def load_port_audit(t: Tables) -> DataFrame:
    s = v.splitters(t).withColumn("state_territory", F.col("state_territory").cast("string"))
    return infrastructure.port_audit(s, v.splitter_ports(t), v.cabinets(t), v.cabinet_ports(t), core.RUN_DATE)["remediation"]


# --- replication ---------------------------------------------------------------------------------

DAY_SQL = "ts >= DATE '2024-01-10' AND ts < DATE '2024-01-11'"


@query("load_network_copy", f"SELECT event_id, user_id, {D('value')} AS value, '2024-01-10' AS report_date FROM events WHERE {DAY_SQL}")
def load_network_copy(t: Tables) -> DataFrame:
    links = t.events.select("event_id", "user_id", "value", F.to_date("ts").alias("report_date"))
    return replication.network_performance_copy(t.spark, links, t.scratch("links"), "2024-01-10", "run-1", min_rows=1)["loaded"]


@query("load_billing_copy", core.BILLING_MONTHLY.replace("FROM billing", "FROM billing WHERE billing_date = DATE '1999-06-30'"))
def load_billing_copy(t: Tables) -> DataFrame:
    path, lines = t.scratch("billing"), v.billing_lines(t)
    replication.cvc_billing_copy(t.spark, lines, path, "1999-06-30")
    return replication.cvc_billing_copy(t.spark, lines, path, "1999-06-30")["monthly"]


@query("load_capex_copy", SQL["evm_trends"])
def load_capex_copy(t: Tables) -> DataFrame:
    return replication.capex_copy(t.spark, v.capex_weeks(t), t.scratch("capex"))["trends"]


@query(
    "load_feature_export",
    f"""SELECT 'clicks' AS feature, count(*) AS rows FROM events WHERE {DAY_SQL}
UNION ALL SELECT 'orders', count(*) FROM orders WHERE o_orderdate = DATE '1999-06-30'
UNION ALL SELECT 'lines', count(*) FROM lineitem WHERE l_shipdate = DATE '1999-06-30'""",
)
def load_feature_export(t: Tables) -> DataFrame:
    base = t.scratch("features")
    out = replication.feature_export({"clicks": (t.events, "ts")}, base, "2024-01-10")
    out |= replication.feature_export({"orders": (t.orders, "o_orderdate"), "lines": (t.lineitem, "l_shipdate")}, base, "1999-06-30")
    counts = [t.spark.read.parquet(p).agg(F.lit(n).alias("feature"), F.count("*").alias("rows")) for n, p in out.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("load_churn_scores", "SELECT CAST(user_id AS VARCHAR) AS service_id, value AS Churn_Score__c, event_type AS Churn_Risk_Band__c, ts AS Churn_Predicted_At__c FROM events WHERE " + DAY_SQL)
def load_churn_scores(t: Tables) -> DataFrame:
    predictions = t.events.select(
        F.col("user_id").cast("string").alias("service_id"),
        F.col("value").alias("churn_score"),
        F.col("event_type").alias("churn_risk_band"),
        F.col("ts").alias("predicted_at"),
        F.to_date("ts").alias("prediction_date"),
    )
    return replication.churn_scores(predictions, "2024-01-10")


# --- integrations --------------------------------------------------------------------------------------

STATEMENTS = f"""SELECT CAST(l_suppkey AS VARCHAR) AS rsp_id, {DAY('l_shipdate')} AS billing_date, CAST(l_orderkey AS VARCHAR) AS service_id,
  {D(f"max({MONEY('l_extendedprice')})")} AS charge_amount, 'AUD' AS currency FROM lineitem GROUP BY l_suppkey, l_shipdate, l_orderkey"""


@query("load_rsp_billing_files", STATEMENTS)
def load_rsp_billing_files(t: Tables) -> DataFrame:
    """Statement files from the item lines; the dearest line of a statement is sent."""
    path = t.scratch("statements")
    rows = t.lineitem.groupBy("l_suppkey", "l_shipdate", "l_orderkey").agg(F.max(v.money("l_extendedprice")).alias("charge_amount"))
    rows.select(
        F.col("l_suppkey").alias("rsp_id"),
        F.to_date("l_shipdate").alias("billing_date"),
        F.col("l_orderkey").alias("service_id"),
        F.lit("NULL").alias("plan_code"),
        "charge_amount",
        F.lit("AUD").alias("currency"),
    ).write.option("header", True).csv(path)
    out = t.scratch("statements")
    for _ in range(2):
        publish.billing_files(t.spark, f"{path}/*.csv", out, "1999-06-30")
    return back(t, out).drop("loaded_at", "plan_code")


@query("load_station_telemetry", SQL["poor_signal"])
def load_station_telemetry(t: Tables) -> DataFrame:
    path = t.scratch("telemetry")
    line = F.to_json(F.struct(F.col("user_id").alias("station_id"), (-F.col("value")).alias("signal_dbm"), F.col("ts").cast("string").alias("telemetry_ts")))
    t.events.select(F.explode(F.array(line, F.lit(""), F.lit("{"))).alias("value")).write.text(path)
    out = t.scratch("telemetry")
    publish.telemetry(t.spark, path, out, dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1))
    publish.telemetry(t.spark, path, out, dt.datetime(2024, 1, 10, 5), dt.datetime(2024, 1, 10, 6))
    return agg.poor_signal(back(t, out, "hour").withColumn("station_id", F.col("station_id").cast("long")))


@query("load_order_events", SQL["order_events"])
def load_order_events(t: Tables) -> DataFrame:
    out = integrations.order_events(landing.order_messages(t))["events"]
    return out.withColumn("event_id", F.col("order_id").cast("long")).drop("payload", "_ingested_at")


def legacy_source(t: Tables) -> DataFrame:
    have = {
        "transaction_id": F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")),
        "customer_id": F.col("l_suppkey").cast("string"),
        "billing_date": F.to_date("l_shipdate"),
        "charge_amount": v.money("l_extendedprice"),
        "gst_amount": v.money(F.col("l_extendedprice") * F.col("l_tax")),
    }
    return t.lineitem.select([have.get(c, F.lit(None).cast("string")).alias(c) for c in LEGACY_BILLING_COLUMNS])


@query(
    "load_legacy_billing",
    f"""SELECT l_orderkey || '-' || l_linenumber AS transaction_id, CAST(l_suppkey AS VARCHAR) AS customer_id, {DAY('l_shipdate')} AS billing_date,
{D(MONEY('l_extendedprice'))} AS charge_amount FROM lineitem WHERE l_shipdate <= DATE '1999-06-30'""",
)
def load_legacy_billing(t: Tables) -> DataFrame:
    """The target holds all earlier dates and a stale copy of the loaded one."""
    source = legacy_source(t)
    stale = source.filter(F.col("billing_date") <= dt.date(1999, 6, 30)).withColumn(
        "charge_amount", F.when(F.col("billing_date") < dt.date(1999, 6, 30), F.col("charge_amount"))
    )
    path = t.scratch("legacy")
    tables.overwrite_partitions(stale, path, ["billing_date"])
    for _ in range(2):
        publish.legacy_billing(source, path, "1999-06-30")
    table = tables.read_partitioned(t.spark, path, T.StructField("billing_date", T.DateType()))
    return table.select("transaction_id", "customer_id", "billing_date", "charge_amount")


@query("load_noc_incidents", landing.FLAT_INCIDENT)
def load_noc_incidents(t: Tables) -> DataFrame:
    docs, mark = landing.noc_docs(t), dt.datetime(2024, 1, 20)
    path = t.scratch("noc")
    publish.noc_incidents(docs.filter(F.col("updated_at") < dt.datetime(2024, 1, 22)), path, None)
    for _ in range(2):
        publish.noc_incidents(docs, path, mark)
    return back(t, path)


@query("load_noc_untimed", f"SELECT * REPLACE (CASE WHEN CAST(severity AS INT) % 3 = 0 THEN NULL ELSE created_at END AS created_at) FROM ({landing.FLAT_INCIDENT})")
def load_noc_untimed(t: Tables) -> DataFrame:
    """A third of the incidents have no creation time; they are pulled three times."""
    docs, path = landing.noc_docs(t), t.scratch("noc")
    docs = docs.withColumn("created_at", F.when(F.col("severity").cast("int") % 3 != 0, F.col("created_at")))
    for _ in range(3):
        publish.noc_incidents(docs, path, None)
    return back(t, path)


@query("load_clickstream", landing.CLICKS)
def load_clickstream(t: Tables) -> DataFrame:
    """Whole month first, then one day again: the day is replaced, not doubled."""
    raw = landing.clicks_raw(t)
    path = t.scratch("clicks")
    publish.clickstream(raw, path, dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1))
    publish.clickstream(raw, path, dt.datetime(2024, 1, 10, 3, 20), dt.datetime(2024, 1, 10, 5))
    return back(t, path, "hour")


# --- the five specified feeds -----------------------------------------------------------------------------


def crm_outputs(t: Tables) -> dict[str, DataFrame]:
    contacts = t.customer.select(F.col("c_custkey").alias("sf_contact_id"), F.col("c_name").alias("email"), F.col("c_name").alias("phone"))
    deleted = t.customer.filter("c_acctbal < 0").select(F.col("c_custkey").alias("sf_account_id"))
    return crm.crm_load(specs.crm_accounts(t), specs.opportunities(t), specs.cases(t), specs.comments(t), specs.case_history(t),
                        contacts, deleted, "staging")


@query("load_crm", specs.CASES)
def load_crm(t: Tables) -> DataFrame:
    return crm_outputs(t)["cases"].drop("last_modified_date")


@query("load_crm_accounts", specs.ACCOUNTS_SQL)
def load_crm_accounts(t: Tables) -> DataFrame:
    return crm_outputs(t)["accounts"]


@query("load_crm_contacts", f"SELECT c_custkey AS sf_contact_id, '{crm.CONTACT_MASKS['email']}' AS email, '{crm.CONTACT_MASKS['phone']}' AS phone FROM customer")
def load_crm_contacts(t: Tables) -> DataFrame:
    return crm_outputs(t)["contacts"]


@query(
    "load_crm_gate",
    f"""WITH c AS (SELECT * FROM ({specs.CASES})), n AS (SELECT count(*) AS cases, count(*) FILTER (WHERE resolution_hours < 0) AS negative,
  count(*) - count(DISTINCT sf_case_id) AS repeated FROM c)
SELECT 'sf_cases.min_rows' AS "check", {D('cases')} AS observed, CAST(10 AS DOUBLE) AS threshold, cases >= 10 AS passed, 'fail' AS severity FROM n
UNION ALL SELECT 'sf_cases.not_null.sf_account_id', 0.0, 0.0, true, 'fail'
UNION ALL SELECT 'sf_cases.not_null.created_date', 0.0, 0.0, true, 'fail'
UNION ALL SELECT 'sf_cases.value.resolution_hours', {D('negative')}, 0.0, negative = 0, 'warn' FROM n
UNION ALL SELECT 'sf_cases.foreign_key.sf_account_id', (SELECT CAST(count(*) AS DOUBLE) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)), 0.0,
  NOT EXISTS (FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)), 'warn'
UNION ALL SELECT 'sf_cases.unique.sf_case_id', {D('repeated')}, 0.0, repeated = 0, 'fail' FROM n""",
)
def load_crm_gate(t: Tables) -> DataFrame:
    """The gate of the feed, as a report."""
    return crm_outputs(t)["gate"]


LEDGER_RECON = f"""WITH {specs.GL}, ar AS (SELECT strftime(o_orderdate, '%Y-%m') AS period_name, CASE o_orderstatus WHEN 'F' THEN 'A' WHEN 'O' THEN 'N' ELSE 'R' END AS invoice_type,
  sum({MONEY('o_totalprice')}) AS a FROM orders GROUP BY 1, 2),
g AS (SELECT period_name, invoice_type, sum(CAST(accounted_cr AS DECIMAL(18,4))) AS g FROM gl GROUP BY 1, 2),
b AS (SELECT coalesce(ar.period_name, g.period_name) AS period_name, coalesce(ar.invoice_type, g.invoice_type) AS invoice_type, a, g,
  {R('coalesce(a, 0) - coalesce(g, 0)', 2)} AS gap FROM ar FULL JOIN g ON ar.period_name = g.period_name AND ar.invoice_type = g.invoice_type)
SELECT period_name, invoice_type, {D('a')} AS ar_total_invoiced, {D('g')} AS gl_total_posted, gap AS variance_aud, {R("gap / NULLIF(CAST(a AS DOUBLE), 0)", 6)} AS variance_pct,
  coalesce(abs(gap / NULLIF(CAST(a AS DOUBLE), 0)) < 0.01, false) AS reconciled_flag FROM b"""


def ledger_outputs(t: Tables) -> dict[str, DataFrame]:
    s = F.col("o_orderstatus")
    ar = t.orders.select(
        F.date_format("o_orderdate", "yyyy-MM").alias("period_name"),
        F.when(s == "F", "A").when(s == "O", "N").otherwise("R").alias("invoice_type"),
        v.money("o_totalprice").alias("invoice_amount"),
        v.money("o_totalprice").alias("amount_due_remaining"),
        F.to_date("o_orderdate").alias("due_date"),
    )
    ap = t.lineitem.select(v.money("l_extendedprice").alias("invoice_amount"), v.money(v.net_price()).alias("amount_paid"), F.col("l_partkey").cast("string").alias("account_code"))
    categories = t.part.select(F.col("p_partkey").cast("string").alias("account_code"), F.col("p_type").alias("expense_category"))
    actuals = t.lineitem.select(v.money("l_extendedprice").alias("amount_aud"), (F.col("l_linestatus") == "F").alias("gl_posted"), (F.col("l_returnflag") == "R").alias("po_backed"))
    return ledger.finance_load(specs.gl_source(t), specs.taxonomy(t), specs.periods(t), ar, ap, categories, actuals, "2001-01-01")


@query("load_ledger", LEDGER_RECON)
def load_ledger(t: Tables) -> DataFrame:
    return ledger_outputs(t)["reconciliation"]


@query("load_ledger_lines", SQL["gl_lines"])
def load_ledger_lines(t: Tables) -> DataFrame:
    internal = ("accounted_dr", "closing_status", "je_category_name", "last_update_date", "segments", "status")
    return ledger_outputs(t)["journal_lines"].drop(*internal)


@query(
    "payables",
    f"""SELECT l_orderkey, l_linenumber, {D(f"{MONEY('l_extendedprice')} - {MONEY('l_extendedprice * (1 - l_discount)')}")} AS amount_remaining,
CASE WHEN {MONEY('l_extendedprice * (1 - l_discount)')} >= {MONEY('l_extendedprice')} THEN 'Paid' ELSE 'Partially Paid' END AS payment_status,
CASE WHEN p_size <= 40 THEN p_type ELSE 'Opex' END AS expense_category,
CASE WHEN l_linestatus = 'F' THEN 'Actual' WHEN l_returnflag = 'R' THEN 'Committed' ELSE 'Forecast' END AS transaction_type
FROM lineitem JOIN part ON p_partkey = l_partkey""",
)
def payables(t: Tables) -> DataFrame:
    lines = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        v.money("l_extendedprice").alias("invoice_amount"),
        v.money(v.net_price()).alias("amount_paid"),
        F.col("l_partkey").alias("account_code"),
        v.money("l_extendedprice").alias("amount_aud"),
        (F.col("l_linestatus") == "F").alias("gl_posted"),
        (F.col("l_returnflag") == "R").alias("po_backed"),
    )
    categories = t.part.filter("p_size <= 40").select(F.col("p_partkey").alias("account_code"), F.col("p_type").alias("expense_category"))
    out = ledger.project_actuals(ledger.payables(lines, categories))
    return out.select("l_orderkey", "l_linenumber", "amount_remaining", "payment_status", "expense_category", "transaction_type")


def itsm_outputs(t: Tables) -> dict[str, DataFrame]:
    slas = specs.itsm_slas(t).withColumns({"start_time": F.lit(None).cast("timestamp_ntz"), "end_time": F.lit(None).cast("timestamp_ntz"), "pause_duration_minutes": F.lit(0)})
    problems = t.customer.select(F.col("c_custkey").alias("snow_sys_id"))
    return itsm.itsm_load(specs.itsm_incidents(t), slas, problems, specs.work_orders(t), specs.HOLIDAYS)


@query("load_itsm", specs.BREACHES)
def load_itsm(t: Tables) -> DataFrame:
    return itsm_outputs(t)["sla_breach_summary"]


@query("load_itsm_technicians", specs.TECH)
def load_itsm_technicians(t: Tables) -> DataFrame:
    return itsm_outputs(t)["technician_performance"]


@query("load_assets", f"SELECT equipment_id, poi_id, asset_age_years, lifecycle_status, equipment_category, utilisation_p95_30d, latency_p95_30d, fault_count_90d, refresh_risk_score FROM ({specs.HEALTH}) JOIN (SELECT p_partkey AS e2, CASE WHEN p_size > 45 THEN 'Decommissioned' ELSE 'Active' END AS lifecycle_status, CASE WHEN p_type = 'ECONOMY' THEN 'UNKNOWN' ELSE upper(substring(p_type, 1, 1)) || lower(substring(p_type, 2)) END AS equipment_category FROM part) ON e2 = equipment_id")
def load_assets(t: Tables) -> DataFrame:
    out = assets_plan.asset_load(specs.asset_rows(t), specs.asset_categories(t), specs.performance(t), specs.maintenance(t),
                                 specs.purchase_orders(t), specs.wbs(t), specs.people(t), "staging", specs.TODAY)
    return out["health"].select("equipment_id", "poi_id", "asset_age_years", "lifecycle_status", "equipment_category",
                                "utilisation_p95_30d", "latency_p95_30d", "fault_count_90d", "refresh_risk_score")


CX_DAILY = f"""WITH {specs.CX}
SELECT response_date, programme_id, rsp_code, count(*) AS total_responses, count(*) FILTER (WHERE nps_score >= 9) AS promoters,
  count(*) FILTER (WHERE nps_score BETWEEN 7 AND 8) AS passives, count(*) FILTER (WHERE nps_score <= 6) AS detractors,
  {PCT('count(*) FILTER (WHERE nps_score >= 9) - count(*) FILTER (WHERE nps_score <= 6)', 'count(*)')} AS nps_score,
  {R('CAST(sum(CAST(overall_satisfaction_score AS DECIMAL(18,2))) AS DOUBLE) / count(overall_satisfaction_score)', 2)} AS avg_satisfaction, grouping(rsp_code) = 1 AS is_total
FROM cx_all GROUP BY GROUPING SETS ((response_date, programme_id, rsp_code), (response_date, programme_id))"""


def experience_outputs(t: Tables) -> dict[str, DataFrame]:
    inc = itsm.incidents_with_flags(specs.itsm_incidents(t), specs.itsm_slas(t))
    return experience.cx_load(specs.cx_responses(t), specs.programmes(t), control.topics(t), inc, "2024-01-31")


@query("load_experience", CX_DAILY)
def load_experience(t: Tables) -> DataFrame:
    return experience_outputs(t)["nps_daily"]


@query("load_experience_topics", SQL["topic_scores"])
def load_experience_topics(t: Tables) -> DataFrame:
    return experience_outputs(t)["topics"]


@query("load_experience_correlation", specs.CORRELATION)
def load_experience_correlation(t: Tables) -> DataFrame:
    return experience_outputs(t)["correlation"]
