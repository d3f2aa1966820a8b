"""Billing, activations, capacity, node health, surveys, reconciliation, finance, ports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.functions.text import clean_verbatim, redact, word_set
from tidegate.functions.times import boundary_diff, business_date, effective_on, floor_hour, in_window, iso_week, previous_hour
from tidegate.functions.rules import sentiment
from tidegate.operators import aggregates as agg
from tidegate.operators import joins, keys
from tidegate.operators import reconcile as rec
from tidegate.operators.incremental import incremental_activations
from tidegate.operators.journals import billable_lines, journal_entries, to_gl_interface
from tidegate.operators.merge import upsert
from tidegate.plans.compliance import SUBMISSION_COLUMNS
from tidegate.plans.customer import score_responses, with_sla
from tidegate.plans.replication import capex_board, evm_trends
from tidegate.session import cut_lineage
from tidegate.sources.files import scan_date
from workload import views as v
from workload.registry import D, DAY, N, PCT, RATIO, Tables, query

RUN_DATE = "1999-06-30"

# --- billing ---------------------------------------------------------------------

BILLING_MONTHLY = f"""WITH {v.BILLING},
dated AS (SELECT strftime(billing_date, '%Y-%m') || '-01' AS billing_month, * FROM billing)
SELECT billing_month, rsp_id, max(loaded_at) AS last_loaded_at, count(*) AS line_count, {D('sum(cvc_mb_used)')} AS total_cvc_mb_used,
       {D('sum(cvc_mb_allocated)')} AS total_cvc_mb_allocated, {D('sum(charge_amount_aud)')} AS total_charge_aud
FROM dated GROUP BY billing_month, rsp_id"""


@query("billing_monthly", BILLING_MONTHLY)
def billing_monthly(t: Tables) -> DataFrame:
    return agg.billing_monthly(v.billing_lines(t))


@query(
    "date_scan",
    f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
WHERE o_orderdate >= DATE '{RUN_DATE}' AND o_orderdate < DATE '{RUN_DATE}' + 1 AND o_orderstatus IN ('F', 'O') AND o_orderpriority <> '5-LOW'""",
)
def date_scan(t: Tables) -> DataFrame:
    day = scan_date(t.orders, "o_orderdate", RUN_DATE)
    return day.filter(F.col("o_orderstatus").isin("F", "O") & (F.col("o_orderpriority") != "5-LOW"))


@query("snapshot_scan", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def snapshot_scan(t: Tables) -> DataFrame:
    return t.part


# --- activations -------------------------------------------------------------------

ACT_COLS = "order_id, service_id, rsp_id, rsp_name, technology_type, order_priority, order_created_at, activation_completed_at, status_code, state_territory"
ACT_DATE = "1997-03-10"
OPEN_OR_DONE = f"""(CAST(activation_completed_at AS DATE) = DATE '{ACT_DATE}'
  OR (status_code IN ('PND', 'PRG') AND CAST(order_created_at AS DATE) <= DATE '{ACT_DATE}'))"""


@query("activations_incremental", f"WITH {v.ACTIVATIONS} SELECT {ACT_COLS} FROM activations WHERE {OPEN_OR_DONE}")
def activations_incremental(t: Tables) -> DataFrame:
    return incremental_activations(v.activations(t), ACT_DATE).drop("customer_segment")


def rated(activations: DataFrame) -> DataFrame:
    return with_sla(activations).withColumn("run_date", F.to_date("activation_completed_at"))


def sla_frame(t: Tables) -> DataFrame:
    return rated(v.activations(t))


SLA_COLS = f"{ACT_COLS}, customer_segment, status, {DAY('run_date')} AS run_date, {D('days_to_activate')} AS days_to_activate, sla_met"


@query("activation_sla", f"WITH {v.ACTIVATIONS} SELECT {SLA_COLS} FROM sla")
def activation_sla(t: Tables) -> DataFrame:
    return sla_frame(t)


ACTIVE_WEEK = f"status = 'ACTIVE' AND run_date BETWEEN DATE '{RUN_DATE}' - 7 AND DATE '{RUN_DATE}'"
M_ACT = f"""m_act AS (
  SELECT state_territory, technology_type, rsp_id, count(*) AS total_activations, count(*) FILTER (WHERE sla_met) AS sla_met_count,
         {RATIO('sum(days_to_activate)', 'count(days_to_activate)', 2)} AS avg_days_to_activate,
         {PCT('count(*) FILTER (WHERE sla_met)', 'count(*)')} AS sla_compliance_pct
  FROM sla WHERE {ACTIVE_WEEK} GROUP BY 1, 2, 3)"""
M_FAULT = f"""m_fault AS (
  SELECT state_territory, technology_type, rsp_id, count(*) AS total_faults,
         {', '.join(f"count(*) FILTER (WHERE date_diff('day', opened_at, resolved_at) <= {n}) AS resolved_{n}bd" for n in (2, 5, 20))}
  FROM incidents WHERE resolved_at BETWEEN DATE '{RUN_DATE}' - 7 AND DATE '{RUN_DATE}' GROUP BY 1, 2, 3)"""
M_MSF = f"""m_msf AS (
  SELECT state_territory, count(*) AS msf_event_count, {N('sum(premises_count)')} AS total_affected_premises,
         {RATIO("sum(date_diff('minute', opened_at, resolved_at))", 'count(resolved_at)', 4)} AS avg_resolution_mins
  FROM incidents WHERE premises_count >= 2500 AND opened_at BETWEEN DATE '{RUN_DATE}' - 7 AND DATE '{RUN_DATE}' GROUP BY 1)"""
CVC_DATE = "2024-01-20"


def m_cvc(grain: str, day: str) -> str:
    poi = ", u.poi_id" if grain == "poi" else ""
    return f"""m_cvc_{grain} AS (
  SELECT r_name AS state_territory{poi}, count(DISTINCT hour_label) AS congested_hours, max(utilisation_pct) AS peak_utilisation_pct
  FROM utilisation u JOIN accounts ON c_custkey = u.poi_id
  WHERE congestion_flag AND hour_label BETWEEN DATE '{day}' - 7 AND DATE '{day}' GROUP BY ALL)"""


@query("activation_metrics", f"WITH {v.ACTIVATIONS}, {M_ACT} SELECT * FROM m_act")
def activation_metrics(t: Tables) -> DataFrame:
    return agg.activation_metrics(sla_frame(t), RUN_DATE)


@query(
    "sla_rate",
    f"""WITH {v.ACTIVATIONS} SELECT count(sla_met) AS rated,
CAST(count(*) FILTER (WHERE sla_met) AS DOUBLE) / count(sla_met) AS sla_rate FROM sla""",
)
def sla_rate(t: Tables) -> DataFrame:
    return agg.sla_rate(sla_frame(t))


@query("status_distribution", f"WITH {v.ACTIVATIONS} SELECT status, count(*) AS rows FROM sla GROUP BY 1")
def status_distribution(t: Tables) -> DataFrame:
    return agg.status_distribution(sla_frame(t))


@query(
    "rsp_kpi_daily",
    f"""WITH {v.ACTIVATIONS} SELECT {DAY('run_date')} AS run_date, rsp_id, count(*) AS orders,
count(*) FILTER (WHERE status = 'ACTIVE') AS activated, count(*) FILTER (WHERE sla_met) AS sla_met_count,
{PCT('count(*) FILTER (WHERE sla_met)', "count(*) FILTER (WHERE status = 'ACTIVE')")} AS sla_compliance_pct,
{RATIO("sum(days_to_activate) FILTER (WHERE status = 'ACTIVE')", "count(days_to_activate) FILTER (WHERE status = 'ACTIVE')", 2)} AS avg_days_to_activate
FROM sla GROUP BY sla.run_date, rsp_id""",
)
def rsp_kpi_daily(t: Tables) -> DataFrame:
    return agg.rsp_kpi_daily(sla_frame(t))


# --- regulatory report ---------------------------------------------------------------


@query("fault_metrics", f"WITH {v.ACCOUNTS}, {v.SHIPPED}, {v.INCIDENTS}, {M_FAULT} SELECT * FROM m_fault")
def fault_metrics(t: Tables) -> DataFrame:
    return agg.fault_metrics(v.incidents(t), RUN_DATE)


@query("msf_metrics", f"WITH {v.ACCOUNTS}, {v.SHIPPED}, {v.INCIDENTS}, {M_MSF} SELECT * FROM m_msf")
def msf_metrics(t: Tables) -> DataFrame:
    return agg.msf_metrics(v.incidents(t), RUN_DATE)


def poi_registry(t: Tables) -> DataFrame:
    return v.accounts(t).select(
        F.col("c_custkey").alias("poi_id"),
        F.col("c_name").alias("poi_name"),
        F.col("r_name").alias("state_territory"),
        F.col("c_mktsegment").alias("technology_type"),
    )


def utilisation(t: Tables) -> DataFrame:
    return joins.cvc_utilisation(v.hourly_traffic(t), v.contracts(t), v.CONTRACT_DAY)


@query("congestion_metrics", f"WITH {v.ACCOUNTS}, {v.UTILISATION}, {m_cvc('poi', CVC_DATE)} SELECT * FROM m_cvc_poi")
def congestion_metrics(t: Tables) -> DataFrame:
    return agg.congestion_metrics(utilisation(t), poi_registry(t), CVC_DATE, "poi")


def regulatory(t: Tables) -> DataFrame:
    return agg.regulatory_metrics(
        rated(v.activated_and_faulty(t)),
        # The traffic is from another year than the orders, so it has its own week.
        agg.congestion_metrics(utilisation(t), poi_registry(t), CVC_DATE),
        RUN_DATE,
    )


COUNTED = ["total_activations", "sla_met_count", "sla_compliance_pct", "avg_days_to_activate"]
REPORTED = [*COUNTED, "total_faults", "resolved_2bd", "resolved_5bd", "resolved_20bd", "msf_event_count",
            "total_affected_premises", "congested_hours", "peak_utilisation_pct"]


def report_ctes(grain: str, cvc_date: str = CVC_DATE) -> str:
    """The four metric sets as rows of one key, of which each column is known in one; state figures are dealt to the state's keys."""
    each = ", ".join(f"max({c}) AS {c}" for c in REPORTED)
    return f"""{v.ACTIVATIONS}, {v.INCIDENTS}, {v.UTILISATION}, {M_ACT}, {M_FAULT}, {M_MSF}, {m_cvc(grain, cvc_date)},
keyed AS (SELECT DISTINCT state_territory, technology_type, rsp_id FROM m_act),
facts AS (SELECT * FROM m_act UNION ALL BY NAME SELECT * FROM m_fault
  UNION ALL BY NAME SELECT * FROM keyed JOIN m_msf USING (state_territory)
  UNION ALL BY NAME SELECT * FROM keyed JOIN m_cvc_{grain} USING (state_territory)),
report AS (SELECT '{RUN_DATE}' AS report_date, state_territory, technology_type, rsp_id, {each} FROM facts
  GROUP BY state_territory, technology_type, rsp_id HAVING count(total_activations) > 0)"""


@query("accc_metrics", f"WITH {report_ctes('state')} SELECT * FROM report")
def accc_metrics(t: Tables) -> DataFrame:
    return regulatory(t)


SUBMISSION = f"""WITH {report_ctes('state')}
SELECT {', '.join(c for c in SUBMISSION_COLUMNS if c != 'rsp_anon_id')}, dense_rank() OVER (ORDER BY rsp_id) AS rsp_anon_id FROM report"""


@query("rsp_anonymised", SUBMISSION)
def rsp_anonymised(t: Tables) -> DataFrame:
    return keys.anonymise(cut_lineage(regulatory(t)), "rsp_id", "rsp_anon_id").select(*SUBMISSION_COLUMNS)


# --- capacity ------------------------------------------------------------------------

U_COLS = f"poi_id, hour_label, {D('throughput_gbps')} AS throughput_gbps, {D('contracted_gbps')} AS contracted_gbps, utilisation_pct, headroom_gbps, congestion_flag"


@query("cvc_utilisation", f"WITH {v.UTILISATION} SELECT {U_COLS} FROM utilisation")
def cvc_utilisation(t: Tables) -> DataFrame:
    return utilisation(t)


@query("congestion_alerts", f"WITH {v.UTILISATION} SELECT poi_id, hour_label, utilisation_pct, headroom_gbps FROM utilisation WHERE congestion_flag")
def congestion_alerts(t: Tables) -> DataFrame:
    return joins.congestion_alerts(utilisation(t))


SUSTAINED = f"""WITH {v.UTILISATION}, runs AS (
  SELECT poi_id, hour_label, CAST(epoch(hour_label) AS BIGINT) // 3600 - row_number() OVER (PARTITION BY poi_id ORDER BY hour_label) AS g
  FROM utilisation WHERE congestion_flag)
SELECT poi_id, min(hour_label) AS run_start, max(hour_label) AS run_end, count(*) AS hours FROM runs GROUP BY poi_id, g HAVING count(*) >= 2"""


@query("sustained_congestion", SUSTAINED)
def sustained_congestion(t: Tables) -> DataFrame:
    return keys.sustained(utilisation(t), "poi_id", "hour_label", "congestion_flag", n=2)


@query(
    "effective_contracts",
    f"WITH {v.CONTRACTS} SELECT poi_id, {D('contracted_cvc_gbps')} AS contracted_cvc_gbps FROM contracts WHERE effective_from <= DATE '2024-01-15' AND (effective_to IS NULL OR effective_to > DATE '2024-01-15')",
)
def effective_contracts(t: Tables) -> DataFrame:
    return v.contracts(t).filter(effective_on("2024-01-15")).select("poi_id", "contracted_cvc_gbps")


@query(
    "contract_per_event",
    f"""WITH {v.CONTRACTS} SELECT event_id, user_id, ts, {D('c.contracted_cvc_gbps')} AS contracted_gbps FROM events
LEFT JOIN contracts c ON c.poi_id = user_id AND c.effective_from <= CAST(ts AS DATE) AND (c.effective_to IS NULL OR c.effective_to > CAST(ts AS DATE))""",
)
def contract_per_event(t: Tables) -> DataFrame:
    facts = t.events.select("event_id", F.col("user_id").alias("poi_id"), "ts")
    return joins.asof_contract_by_row(facts, v.contracts(t), "ts").withColumnRenamed("poi_id", "user_id")


@query(
    "event_window",
    f"""SELECT event_id, ts, CAST(CAST(ts + INTERVAL 10 HOUR AS DATE) AS VARCHAR) AS business_date, date_trunc('hour', ts) AS hour_label,
date_trunc('hour', ts) - INTERVAL 1 HOUR AS previous_hour, {D('value')} AS value
FROM events WHERE ts >= TIMESTAMP '2024-01-10 13:00:00' AND ts < TIMESTAMP '2024-01-10 14:00:00'""",
)
def event_window(t: Tables) -> DataFrame:
    hour = t.events.filter(in_window("ts", _ts("2024-01-10 13:00:00"), _ts("2024-01-10 14:00:00")))
    return hour.select("event_id", "ts", business_date("ts").alias("business_date"), floor_hour("ts").alias("hour_label"),
                       previous_hour("ts").alias("previous_hour"), "value")


def _ts(text: str):
    import datetime as dt

    return dt.datetime.fromisoformat(text)


@query(
    "time_boundaries",
    """SELECT event_id, date_diff('day', TIMESTAMP '2024-01-01 12:30:30', ts) AS days, date_diff('hour', TIMESTAMP '2024-01-01 12:30:30', ts) AS hours,
date_diff('minute', TIMESTAMP '2024-01-01 12:30:30', ts) AS minutes, date_diff('month', TIMESTAMP '2023-11-30 12:30:30', ts) AS months,
isoyear(ts) || '-W' || lpad(CAST(weekofyear(ts) AS VARCHAR), 2, '0') AS iso_week FROM events""",
)
def time_boundaries(t: Tables) -> DataFrame:
    a, b = F.lit(_ts("2024-01-01 12:30:30")), F.lit(_ts("2023-11-30 12:30:30"))
    return t.events.select(
        "event_id",
        *[boundary_diff(u, a, "ts").cast("long").alias(f"{u}s") for u in ("day", "hour", "minute")],
        boundary_diff("month", b, "ts").cast("long").alias("months"),
        iso_week("ts").alias("iso_week"),
    )


# --- node health -----------------------------------------------------------------------


@query("node_health", f"WITH {v.NODES} SELECT * FROM scored")
def node_health(t: Tables) -> DataFrame:
    return agg.scored_nodes(agg.node_hour(v.node_samples(t)))


# First run: the first fortnight. Second run: everything from the tenth on, so the two overlap.
ALERTS = f"WITH {v.NODES} SELECT node_id, hour_label, health_status, health_score, node_type, poi_id FROM scored WHERE health_status <> 'HEALTHY'"


@query("node_alerts_upsert", ALERTS)
def node_alerts_upsert(t: Tables) -> DataFrame:
    alerts = agg.node_alerts(agg.scored_nodes(agg.node_hour(v.node_samples(t))))
    first = alerts.filter(F.col("hour_label") < _ts("2024-01-15 00:00:00")).withColumn("health_score", F.lit(0))
    again = alerts.filter(F.col("hour_label") >= _ts("2024-01-10 00:00:00"))
    early = alerts.filter(F.col("hour_label") < _ts("2024-01-10 00:00:00"))
    return upsert(upsert(first, again, ["node_id", "hour_label"]), early, ["node_id", "hour_label"])


# --- surveys and text --------------------------------------------------------------------

# The patterns and word lists of the rules.
EMAIL = r"[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+"
US_PHONE = r"\+1 \(\d{3}\) \d{3}-\d{4}"
AU_PHONE = r"\b(?:\+61|0)[2-9]\d{8,9}\b"
WS = "".join(f"\\x{{{ord(c):x}}}" for c in "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0     　") + r"\x{2000}-\x{200a}"


def sql_clean(text: str) -> str:
    red = f"regexp_replace(regexp_replace({text}, '{EMAIL}', '[EMAIL]', 'g'), '{AU_PHONE}', '[PHONE]', 'g')"
    return f"coalesce(regexp_replace(regexp_replace({red}, '^[{WS}]+', ''), '[{WS}]+$', ''), '')"


POS = "['great','excellent','fast','love','perfect','reliable','happy','amazing']"
NEG = "['slow','terrible','awful','disconnected','outage','useless','poor','dropout']"


def sql_sentiment(text: str, score: str) -> str:
    words = f"regexp_split_to_array(lower({text}), '[{WS}]+')"
    pos, neg = (f"len(list_intersect(list_distinct({words}), {x}))" for x in (POS, NEG))
    return f"""CASE WHEN coalesce({text}, '') = '' THEN 'neutral' WHEN {pos} > {neg} AND {score} >= 7 THEN 'positive'
  WHEN {neg} > {pos} OR {score} <= 4 THEN 'negative' ELSE 'neutral' END"""


def sql_category(score: str) -> str:
    return f"CASE WHEN {score} >= 9 THEN 'promoter' WHEN {score} >= 7 THEN 'passive' WHEN {score} IS NOT NULL THEN 'detractor' END"


SCORED = f"""answers AS (
  SELECT event_id AS response_id, user_id AS service_id, {v.K} % 11 AS score, {sql_clean('text')} AS verbatim,
         event_type AS survey_channel, ts AS completed_at
  FROM events LEFT JOIN documents ON doc_id = event_id),
answered AS (
  SELECT *, {sql_category('score')} AS nps_category, {sql_sentiment('verbatim', 'score')} AS sentiment FROM answers)"""


@query("nps_scored", f"WITH {SCORED} SELECT * FROM answered")
def nps_scored(t: Tables) -> DataFrame:
    return score_responses(v.responses(t))


NPS_DAILY = f"""WITH {v.SURVEY}
SELECT {DAY('response_date')} AS response_date, programme_id, rsp_code, count(*) AS total_responses,
       count(*) FILTER (WHERE nps_score >= 9) AS promoters, count(*) FILTER (WHERE nps_score BETWEEN 7 AND 8) AS passives,
       count(*) FILTER (WHERE nps_score <= 6) AS detractors,
       {PCT('count(*) FILTER (WHERE nps_score >= 9) - count(*) FILTER (WHERE nps_score <= 6)', 'count(*)')} AS nps_score,
       {RATIO('sum(sat)', 'count(sat)', 2)} AS avg_satisfaction, grouping(rsp_code) = 1 AS is_total
FROM survey GROUP BY GROUPING SETS ((survey.response_date, programme_id, rsp_code), (survey.response_date, programme_id))"""


@query("nps_daily", NPS_DAILY)
def nps_daily(t: Tables) -> DataFrame:
    return agg.nps_daily(v.survey_facts(t))


@query(
    "verbatim_clean",
    f"""SELECT doc_id, {sql_clean('text')} AS clean,
regexp_replace(regexp_replace(text, '{EMAIL}', '[EMAIL]', 'g'), '{US_PHONE}', '[PHONE]', 'g') AS redacted FROM documents""",
)
def verbatim_clean(t: Tables) -> DataFrame:
    return t.documents.select(
        "doc_id", clean_verbatim("text").alias("clean"), redact("text", [(EMAIL, "[EMAIL]", "@"), (US_PHONE, "[PHONE]", "+1 (")]).alias("redacted")
    )


@query(
    "sentiment_label",
    f"""SELECT d.doc_id, {sql_sentiment('text', 'coalesce(quality, 0) * 9')} AS sentiment,
len(list_distinct(list_filter(regexp_split_to_array(lower(text), '[{WS}]+'), lambda w: w <> ''))) AS distinct_words
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def sentiment_label(t: Tables) -> DataFrame:
    df = t.documents.join(t.labels, "doc_id", "left")
    return df.select(
        "doc_id",
        sentiment("text", F.coalesce(F.col("quality"), F.lit(0)) * 9).alias("sentiment"),
        F.size(word_set("text")).cast("long").alias("distinct_words"),
    )


RSP_MAP = """mapping AS (SELECT c_custkey, c_nationkey, n_name, r_name FROM accounts WHERE c_acctbal > 0)"""


def rsp_mapping(t: Tables) -> DataFrame:
    return v.accounts(t).filter("c_acctbal > 0").select(
        F.col("c_custkey").alias("service_id"),
        F.col("c_nationkey").cast("string").alias("rsp_id"),
        F.col("n_name").alias("rsp_name"),
        F.col("r_name").alias("state_territory"),
    )


@query(
    "rsp_attribution",
    f"""WITH {v.ACCOUNTS}, {RSP_MAP} SELECT event_id, user_id AS service_id, coalesce(CAST(c_nationkey AS VARCHAR), 'UNKNOWN') AS rsp_id,
coalesce(n_name, 'UNKNOWN') AS rsp_name, r_name AS state_territory FROM events LEFT JOIN mapping ON c_custkey = user_id""",
)
def rsp_attribution(t: Tables) -> DataFrame:
    facts = t.events.select("event_id", F.col("user_id").alias("service_id"))
    return joins.lookup(facts, rsp_mapping(t), "service_id", ["rsp_id", "rsp_name", "state_territory"],
                        defaults={"rsp_id": "UNKNOWN", "rsp_name": "UNKNOWN"})


@query(
    "lookup_dims",
    """SELECT c_custkey, c_nationkey, n_name, CASE WHEN n_regionkey <> 0 THEN r_name ELSE 'UNKNOWN' END AS region_name
FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""",
)
def lookup_dims(t: Tables) -> DataFrame:
    nation = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    known = t.region.filter(F.col("r_name") != "AFRICA").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region_name"))
    df = joins.lookup(t.customer.select("c_custkey", "c_nationkey"), nation, "c_nationkey", ["n_name", "n_regionkey"])
    df = joins.lookup(df, known, "n_regionkey", ["region_name"], defaults={"region_name": "UNKNOWN"})
    return df.drop("n_regionkey")


# --- reconciliation ----------------------------------------------------------------------


def recon(t: Tables) -> DataFrame:
    live = v.billing_orders(t).filter(F.col("billing_status").isin("ACTIVE", "SUSPENDED"))
    return rec.reconcile(live, v.crm_orders(t), "order_id", ["rsp_id", "product_code"], "rate_per_gbps", ["service_id"])


RECON_COLS = f"""order_id, rsp_id, product_code, {D('rate_per_gbps')} AS rate_per_gbps, discrepancy_type, source,
CASE WHEN discrepancy_type = 'MISMATCH' THEN crm_rsp END AS sf_rsp_id, {D("CASE WHEN discrepancy_type = 'RATE_ERR' THEN b_rate END")} AS ebs_rate,
{D("CASE WHEN discrepancy_type = 'RATE_ERR' THEN c_rate END")} AS sf_rate"""


@query("reconcile", f"WITH {v.ORDER_BOOKS} SELECT {RECON_COLS} FROM recon WHERE discrepancy_type IS NOT NULL")
def reconcile(t: Tables) -> DataFrame:
    return recon(t)


@query("recon_summary", f"WITH {v.ORDER_BOOKS} SELECT discrepancy_type, count(*) AS discrepancies FROM recon WHERE discrepancy_type IS NOT NULL GROUP BY 1")
def recon_summary(t: Tables) -> DataFrame:
    return rec.recon_summary(recon(t))


@query("recon_alert", f"WITH {v.ORDER_BOOKS} SELECT rsp_id, count(*) AS total, count(*) >= 50 AS exceeded FROM recon WHERE discrepancy_type IS NOT NULL GROUP BY 1")
def recon_alert(t: Tables) -> DataFrame:
    return rec.exceeds(recon(t), by=["rsp_id"])


# --- capital projects ----------------------------------------------------------------------

EVM_COLS = f"""project_id, project_name, category, {D('budget')} AS approved_budget, {D('actual')} AS actual_cost, {D('committed')} AS committed_cost,
{D('planned')} AS planned_value, {D('earned')} AS earned_value, spi, cpi, eac, used AS budget_utilisation_pct, risk_level"""


@query("evm_metrics", f"WITH {v.EVM} SELECT {EVM_COLS} FROM evm")
def evm_metrics(t: Tables) -> DataFrame:
    return agg.evm_metrics(v.projects(t)).drop("key_date", "status")


@query("budget_risk", f"WITH {v.EVM} SELECT risk_level, count(*) AS items FROM evm GROUP BY 1")
def budget_risk(t: Tables) -> DataFrame:
    return agg.flag_summary(agg.evm_metrics(v.projects(t)), "risk_level")


def _AT(rank: int, column: str) -> str:
    """The value of a project's newest or second newest week."""
    return f"max({column}) FILTER (rn = {rank})"


TRENDS = f"""WITH {v.WEEKS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY project_id ORDER BY week_ending_date DESC) AS rn FROM weeks)
SELECT project_id, {DAY(_AT(1, 'week_ending_date'))} AS week_ending_date,
       {D(_AT(1, 'cpi'))} AS cpi_current, {D(_AT(2, 'cpi'))} AS cpi_prior, {D(_AT(1, 'cpi') + ' - ' + _AT(2, 'cpi'))} AS cpi_wow_delta,
       {D(_AT(1, 'spi'))} AS spi_current, {D(_AT(2, 'spi'))} AS spi_prior, {D(_AT(1, 'spi') + ' - ' + _AT(2, 'spi'))} AS spi_wow_delta
FROM ranked WHERE rn <= 2 GROUP BY project_id"""


@query("evm_trends", TRENDS)
def evm_trends_query(t: Tables) -> DataFrame:
    return evm_trends(v.capex_weeks(t))


BOARD = f"""WITH {v.WEEKS} SELECT project_id, {DAY('week_ending_date')} AS week_ending_date, {D('actual')} AS actual_spend_aud,
{D('earned')} AS earned_value_aud, {D('planned')} AS planned_value_aud, loaded_at, {D('cpi')} AS cpi, {D('spi')} AS spi,
max(loaded_at) OVER (PARTITION BY project_id) AS last_loaded_at FROM weeks"""


@query("capex_board", BOARD)
def capex_board_query(t: Tables) -> DataFrame:
    return capex_board(v.capex_weeks(t))


# --- ports -------------------------------------------------------------------------------------

FLAG = "CASE WHEN utilisation_pct > 85 THEN 'HOT' WHEN utilisation_pct < 20 THEN 'COLD' ELSE 'OK' END"


@query("port_utilisation", f"WITH {v.PORTS} SELECT *, {FLAG} AS flag FROM s_util")
def port_utilisation(t: Tables) -> DataFrame:
    return agg.port_utilisation(v.splitters(t), v.splitter_ports(t), "splitter_id", "total_ports")


def audited(t: Tables) -> tuple[DataFrame, DataFrame]:
    s = agg.port_utilisation(v.splitters(t), v.splitter_ports(t), "splitter_id", "total_ports", run_date=RUN_DATE)
    c = agg.port_utilisation(v.cabinets(t), v.cabinet_ports(t), "rim_id", "total_dsl_ports", ("ACTIVE",), "cabinet", RUN_DATE)
    return (s.withColumn("state_territory", F.col("state_territory").cast("string")), c)


REMEDIATION = f"""WITH {v.PORTS}
SELECT splitter_id AS asset_id, 'PON_SPLITTER' AS asset_type, 'HOT' AS flag, utilisation_pct, CAST(state_territory AS VARCHAR) AS state,
       '{RUN_DATE}' AS run_date, CASE WHEN utilisation_pct > 95 THEN 'HIGH' ELSE 'MEDIUM' END AS priority FROM s_util WHERE utilisation_pct > 85
UNION ALL SELECT rim_id, 'RIM_CABINET', 'CRITICAL', utilisation_pct, state_territory, '{RUN_DATE}', 'HIGH' FROM c_util WHERE utilisation_pct > 90"""


@query("remediation_queue", REMEDIATION)
def remediation_queue(t: Tables) -> DataFrame:
    return agg.remediation_queue(*audited(t))


# --- revenue -------------------------------------------------------------------------------------


def journals(t: Tables) -> DataFrame:
    ar = billable_lines(v.ar_lines(t), v.ar_headers(t), v.BILLING_MONTH)
    return journal_entries(ar, agg.deferred_amortisation(v.deferred_balances(t), v.BILLING_MONTH), v.BILLING_MONTH)


J_COLS = f"{DAY('journal_date')} AS journal_date, account_code, rsp_id, {D('debit')} AS debit, {D('credit')} AS credit, description, source, line_type"


@query("journal_entries", f"WITH {v.JOURNALS} SELECT {J_COLS} FROM journals")
def journal_entries_query(t: Tables) -> DataFrame:
    return journals(t)


@query("deferred_amortisation", f"WITH {v.DEFERRED} SELECT rsp_id, {D('total_deferred')} AS total_deferred, {D('current_period_recognition')} AS current_period_recognition FROM deferred")
def deferred_amortisation(t: Tables) -> DataFrame:
    return agg.deferred_amortisation(v.deferred_balances(t), v.BILLING_MONTH)


@query("trial_balance", f"WITH {v.JOURNALS} SELECT {D('abs(sum(credit) - sum(debit))')} AS imbalance FROM journals HAVING abs(sum(credit) - sum(debit)) > 0.01")
def trial_balance(t: Tables) -> DataFrame:
    return agg.trial_balance(journals(t), v.BILLING_MONTH)


@query(
    "gl_interface",
    f"""WITH {v.JOURNALS} SELECT 'NEW' AS status, 2001 AS ledger_id, {DAY('journal_date')} AS accounting_date, account_code AS segment1, 'AUD' AS currency_code,
{D('debit')} AS entered_dr, {D('credit')} AS entered_cr, description, 'AIRFLOW-REVREC-{v.BILLING_MONTH[:7]}' AS reference10 FROM journals""",
)
def gl_interface(t: Tables) -> DataFrame:
    return to_gl_interface(journals(t), v.BILLING_MONTH)


# --- telemetry and freshness ------------------------------------------------------------------------

POOR = """SELECT date_trunc('hour', ts) AS telemetry_hour, count(DISTINCT user_id) AS poor_signal_count, min(-value) AS worst_signal_dbm
FROM events WHERE -value < -100 GROUP BY 1"""


def telemetry(t: Tables) -> DataFrame:
    return t.events.select(F.col("user_id").alias("station_id"), (-F.col("value")).alias("signal_dbm"), F.col("ts").alias("telemetry_ts"))


@query("poor_signal", POOR)
def poor_signal(t: Tables) -> DataFrame:
    return agg.poor_signal(telemetry(t))


@query(
    "poor_signal_stations",
    "SELECT date_trunc('hour', ts) AS telemetry_hour, user_id AS station_id, min(-value) AS worst_signal_dbm FROM events WHERE -value < -100 GROUP BY 1, 2",
)
def poor_signal_stations(t: Tables) -> DataFrame:
    return agg.poor_signal_stations(telemetry(t))


@query(
    "stale_pipelines",
    """SELECT user_id AS pipeline_id, max(ts) AS watermark_ts, date_diff('hour', max(ts), TIMESTAMP '2024-01-31 00:30:00') AS hours_since_run
FROM events GROUP BY 1 HAVING date_diff('hour', max(ts), TIMESTAMP '2024-01-31 00:30:00') > 10""",
)
def stale_pipelines(t: Tables) -> DataFrame:
    marks = t.events.groupBy(F.col("user_id").alias("pipeline_id")).agg(F.max("ts").alias("watermark_ts"))
    return agg.stale_pipelines(marks, _ts("2024-01-31 00:30:00"), hours=10)
