"""The five specified feeds: CRM, ledger, ITSM, assets and workforce, experience."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.operators import aggregates as agg
from tidegate.operators import selection
from tidegate.operators.keys import rework_flag
from tidegate.operators.reconcile import ar_gl_reconciliation
from tidegate.plans import assets as assets_plan
from tidegate.plans import crm, experience, itsm, ledger
from workload import control
from workload import views as v
from workload.registry import D, DAY, MONEY, PCT, R, RATIO, Tables, query

# --- ITSM --------------------------------------------------------------------------------


def itsm_incidents(t: Tables) -> DataFrame:
    s = F.col("o_orderstatus")
    return v.shipped_orders(t).join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("snow_sys_id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "Network").otherwise("Billing").alias("category"),
        F.col("c_nationkey").alias("customer_impact_count"),
        F.when(s == "P", "Cancelled").when(s == "F", "Resolved").otherwise("New").alias("state"),
        F.col("o_orderdate").alias("opened_at"),
        F.when(s == "F", F.col("done_at")).alias("resolved_at"),
        F.col("o_custkey").alias("problem_id"),
    )


def itsm_slas(t: Tables) -> DataFrame:
    return t.lineitem.select(F.col("l_orderkey").alias("incident_sys_id"), (F.col("l_tax") >= 0.08).alias("has_breached"))


ITSM = f"""{v.SHIPPED}, breached AS (SELECT l_orderkey, max(l_tax) >= 0.08 AS hit FROM lineitem GROUP BY 1),
itsm AS (
  SELECT o_orderkey AS snow_sys_id, CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS priority,
         CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'Network' ELSE 'Billing' END AS category, c_nationkey AS customer_impact_count,
         CASE o_orderstatus WHEN 'P' THEN 'Cancelled' WHEN 'F' THEN 'Resolved' ELSE 'New' END AS state,
         o_orderdate + INTERVAL 10 HOUR AS opened_at, CASE WHEN o_orderstatus = 'F' THEN done_at + INTERVAL 10 HOUR END AS resolved_at,
         o_custkey AS problem_id, coalesce(hit, false) AS sla_breached_flag
  FROM shipped JOIN customer ON c_custkey = o_custkey LEFT JOIN breached ON l_orderkey = o_orderkey),
itsm_flags AS (
  SELECT *, date_diff('minute', opened_at, resolved_at) AS resolution_minutes,
         priority IN (1, 2) AND category = 'Network' AND customer_impact_count >= 1 AND state <> 'Cancelled' AS accc_reportable_flag FROM itsm)"""


@query("sla_breached", f"WITH {ITSM} SELECT * FROM itsm_flags")
def sla_breached(t: Tables) -> DataFrame:
    return itsm.incidents_with_flags(itsm_incidents(t), itsm_slas(t))


BREACHES = f"""WITH {ITSM} SELECT {DAY("date_trunc('week', opened_at)")} AS report_week, priority AS incident_priority, category AS incident_category,
count(*) AS total_incidents, count(*) FILTER (WHERE sla_breached_flag) AS sla_breached_count,
{RATIO('sum(resolution_minutes)', 'count(resolution_minutes)', 4)} AS avg_resolution_minutes,
{R("(1.0 - CAST(count(*) FILTER (WHERE sla_breached_flag) AS DOUBLE) / count(*)) * 100", 2)} AS sla_compliance_rate_pct,
{R("quantile_cont(CAST(resolution_minutes AS DOUBLE), 0.95)", 4)} AS p95_resolution_minutes
FROM itsm_flags WHERE accc_reportable_flag GROUP BY date_trunc('week', opened_at), priority, category"""


@query("sla_breach_summary", BREACHES)
def sla_breach_summary(t: Tables) -> DataFrame:
    return agg.sla_breach_summary(itsm.incidents_with_flags(itsm_incidents(t), itsm_slas(t)))


@query("linked_incidents", "SELECT c_custkey AS snow_sys_id, count(o_orderkey) AS linked_incident_count FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1")
def linked_incidents(t: Tables) -> DataFrame:
    problems = t.customer.select(F.col("c_custkey").alias("snow_sys_id"))
    return itsm.problems_with_counts(problems, t.orders.select(F.col("o_custkey").alias("problem_id")))


def work_orders(t: Tables) -> DataFrame:
    s = F.col("o_orderstatus")
    return v.shipped_orders(t).join(v.accounts(t), F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("work_order_id"),
        F.col("o_custkey").alias("location_address"),
        F.col("o_orderdate").alias("scheduled_start"),
        F.col("o_orderdate").alias("actual_start"),
        F.col("done_at").alias("actual_end"),
        F.when(s == "F", "Resolved").when(s == "O", "Escalated").otherwise("No Access").alias("closure_code"),
        F.col("c_mktsegment").alias("assigned_team"),
        F.col("r_name").alias("location_fsa"),
        F.to_date("o_orderdate").alias("run_date"),
    )


def follow_up(a: str, any_way: bool = False) -> str:
    near = (
        f"abs(epoch_us(b.o_orderdate) - epoch_us({a}.o_orderdate)) <= 30 * 86400000000 AND b.o_orderkey <> {a}.o_orderkey"
        if any_way
        else f"b.o_orderdate > {a}.o_orderdate AND b.o_orderdate <= {a}.o_orderdate + INTERVAL 30 DAY"
    )
    return f"EXISTS (SELECT 1 FROM orders b WHERE b.o_custkey = {a}.o_custkey AND {near})"


@query("rework_flag", f"SELECT o_orderkey, {follow_up('a')} AS rework_flag, {follow_up('a', True)} AS near_flag FROM orders a")
def rework(t: Tables) -> DataFrame:
    df = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    df = rework_flag(df, "o_custkey", "o_orderdate")
    return rework_flag(df, "o_custkey", "o_orderdate", direction="any", alias="near_flag").drop("o_custkey", "o_orderdate")


TECH = f"""WITH {v.ACCOUNTS}, {v.SHIPPED}, wo AS (
  SELECT a.*, c_mktsegment, r_name, date_diff('minute', o_orderdate, done_at) AS minutes, {follow_up('a')} AS rework
  FROM shipped a JOIN accounts ON c_custkey = o_custkey)
SELECT {DAY('o_orderdate')} AS run_date, c_mktsegment AS assigned_team, r_name AS location_fsa, count(*) FILTER (WHERE o_orderstatus = 'F') AS completed_orders,
  count(*) FILTER (WHERE o_orderstatus <> 'F') AS incomplete_orders, {RATIO('sum(minutes)', 'count(minutes)', 2)} AS avg_time_on_site_minutes,
  {PCT('count(*) FILTER (WHERE rework)', "count(*) FILTER (WHERE o_orderstatus = 'F')")} AS rework_rate_pct
FROM wo GROUP BY o_orderdate, c_mktsegment, r_name"""


@query("tech_performance", TECH)
def tech_performance(t: Tables) -> DataFrame:
    return agg.technician_performance(itsm.work_orders(work_orders(t)))


HOLIDAYS = ["2024-01-01", "2024-01-26"]
MINUTES = f"""WITH s AS (
  SELECT event_id, epoch_ms(ts + INTERVAL 10 HOUR) // 60000 AS a, epoch_ms(ts + INTERVAL 10 HOUR + to_minutes({v.K} * 37)) // 60000 AS b, {v.K} % 5 AS pause FROM events),
cal AS (SELECT epoch_ms(d) // 60000 AS d FROM generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-10', INTERVAL 1 DAY) g(d)
  WHERE isodow(d) <= 5 AND CAST(d AS DATE) NOT IN (DATE '2024-01-01', DATE '2024-01-26'))
SELECT event_id, b - a AS actual_elapsed_minutes, b - a - pause AS net_elapsed_minutes,
  greatest(CAST(coalesce(sum(greatest(0, least(b, d + 1080) - greatest(a, d + 480))) FILTER (WHERE d IS NOT NULL), 0) AS BIGINT) - pause, 0) AS business_duration_minutes
FROM s LEFT JOIN cal ON d + 1440 > a AND d < b GROUP BY event_id, a, b, pause"""


def sla_clocks(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id",
        F.col("ts").alias("start_time"),
        (F.col("ts") + F.make_dt_interval(mins=v.k() * 37)).alias("end_time"),
        (v.k() % 5).alias("pause_duration_minutes"),
    )


@query("business_minutes", MINUTES)
def business_minutes_query(t: Tables) -> DataFrame:
    return itsm.task_slas(sla_clocks(t), HOLIDAYS).drop("start_time", "end_time", "pause_duration_minutes")


# --- CRM ------------------------------------------------------------------------------------


def cases(t: Tables) -> DataFrame:
    return v.shipped_orders(t).select(
        F.col("o_orderkey").alias("sf_case_id"),
        F.col("o_custkey").alias("sf_account_id"),
        F.col("o_orderdate").alias("created_date"),
        F.when(F.col("o_orderstatus") == "F", F.col("done_at")).alias("closed_date"),
        F.col("o_orderdate").alias("last_modified_date"),
    )


def comments(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("sf_case_id"), F.col("l_shipdate").alias("comment_ts"), (F.col("l_linestatus") == "F").alias("is_internal")
    )


def case_history(t: Tables) -> DataFrame:
    return t.lineitem.select(F.col("l_orderkey").alias("sf_case_id"), (F.col("l_returnflag") == "R").alias("is_escalated"))


def _hours(a: str, b: str) -> str:
    return R(f"(epoch_us({b}) - epoch_us({a})) / 3600000000.0", 2)


CASES = f"""WITH {v.SHIPPED}, notes AS (
  SELECT l_orderkey, min(CASE WHEN l_linestatus = 'F' THEN l_shipdate END) AS first_at, bool_or(l_returnflag = 'R') AS escalated FROM lineitem GROUP BY 1)
SELECT o_orderkey AS sf_case_id, o_custkey AS sf_account_id, o_orderdate AS created_date, CASE WHEN o_orderstatus = 'F' THEN done_at END AS closed_date,
  {_hours('o_orderdate', 'first_at')} AS first_response_hours, coalesce(escalated, false) AS escalated_flag,
  {_hours('o_orderdate', "CASE WHEN o_orderstatus = 'F' THEN done_at END")} AS resolution_hours
FROM shipped LEFT JOIN notes ON l_orderkey = o_orderkey"""


@query("case_metrics", CASES)
def case_metrics(t: Tables) -> DataFrame:
    return crm.cases_with_metrics(cases(t), comments(t), case_history(t)).drop("last_modified_date")


def opportunities(t: Tables) -> DataFrame:
    return v.shipped_orders(t).select(
        F.col("o_orderkey").alias("sf_opportunity_id"),
        F.col("o_custkey").alias("sf_account_id"),
        F.when(F.col("o_orderstatus") == "F", "Closed Won").otherwise("Negotiation").alias("stage"),
        v.money("o_totalprice").alias("amount"),
        F.to_date("o_orderdate").alias("contract_start_date"),
        F.to_date("done_at").alias("contract_end_date"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("service_count"),
    )


@query(
    "recurring_revenue",
    f"""WITH {v.SHIPPED}, m AS (
  SELECT o_orderkey, ((cents * 2 + months) // (2 * months)) / 100.0 AS mrr_aud FROM (
    SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents, NULLIF(date_diff('month', o_orderdate, done_at), 0) AS months FROM shipped))
SELECT o_orderkey AS sf_opportunity_id, mrr_aud, {R('CAST(mrr_aud AS DECIMAL(18,2)) * 12', 2)} AS arr_aud FROM m""",
)
def recurring_revenue(t: Tables) -> DataFrame:
    return crm.opportunities(opportunities(t)).select("sf_opportunity_id", "mrr_aud", "arr_aud")


def crm_accounts(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").alias("sf_account_id"),
        F.col("c_name").alias("account_name"),
        F.when(F.col("c_mktsegment") == "BUILDING", " ").otherwise(F.col("c_mktsegment")).alias("rsp_code"),
        F.lit(True).alias("active_flag"),
    )


ACCOUNTS_SQL = """SELECT c_custkey AS sf_account_id, c_name AS account_name, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS rsp_code,
c_acctbal >= 0 AS active_flag, CAST(coalesce(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(substring(o_orderpriority, 1, 1) AS INTEGER) END), 0) AS BIGINT) AS contracted_services,
c_mktsegment = 'BUILDING' AS needs_review FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL"""


@query("crm_accounts", ACCOUNTS_SQL)
def crm_accounts_query(t: Tables) -> DataFrame:
    deleted = t.customer.filter("c_acctbal < 0").select(F.col("c_custkey").alias("sf_account_id"))
    return crm.accounts(crm_accounts(t), opportunities(t), deleted)


# --- ledger ------------------------------------------------------------------------------------


def gl_source(t: Tables) -> DataFrame:
    """Item lines as ledger lines; the account follows the return flag, the category the supplier's nation."""
    f = F.col("l_returnflag")
    account = F.when(f == "R", 1_500_000 + F.col("l_partkey")).when(f == "A", 6_000_000 + F.col("l_partkey")).otherwise(F.lit(9))
    sign = F.when(F.col("l_discount") == 0.1, F.lit(-1)).otherwise(F.lit(1))
    return t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_orderkey").alias("je_header_id"),
        F.col("l_linenumber").alias("je_line_num"),
        F.concat_ws(".", F.lit("01"), F.col("l_suppkey").cast("string"), account.cast("string"), F.when(f == "R", "P1").otherwise("")).alias("segments"),
        F.col("s_nationkey").alias("je_category_name"),
        F.when(F.col("l_linestatus") == "F", "P").otherwise("U").alias("status"),
        F.lit(None).cast("decimal(18,4)").alias("accounted_dr"),
        (v.money("l_extendedprice") * sign).cast("decimal(18,4)").alias("accounted_cr"),
        F.date_format("l_shipdate", "yyyy-MM").alias("period_name"),
        f.alias("invoice_type"),
        F.col("l_shipdate").alias("last_update_date"),
    )


def taxonomy(t: Tables) -> DataFrame:
    return t.nation.filter("n_regionkey <> 0").select(F.col("n_nationkey").alias("je_category_name"), F.col("n_name").alias("je_category"))


def periods(t: Tables) -> DataFrame:
    months = t.orders.select(F.trunc("o_orderdate", "month").alias("m")).distinct()
    status = F.when(F.col("m") >= dt.date(2001, 6, 1), "O").otherwise("C")
    return months.select(F.date_format("m", "yyyy-MM").alias("period_name"), status.alias("closing_status"))


GL = f"""gl AS (
  SELECT l_orderkey AS je_header_id, l_linenumber AS je_line_num, l_orderkey || '_' || l_linenumber AS je_line_id, '01' AS entity, CAST(l_suppkey AS VARCHAR) AS cost_centre,
         CASE l_returnflag WHEN 'R' THEN CAST(1500000 + l_partkey AS VARCHAR) WHEN 'A' THEN CAST(6000000 + l_partkey AS VARCHAR) ELSE '9' END AS account_code,
         CASE l_returnflag WHEN 'R' THEN 'P1' END AS project_code,
         CASE WHEN l_returnflag = 'R' AND l_partkey < 100000 THEN 'CAPEX' WHEN l_returnflag = 'A' AND l_partkey < 1000000 THEN 'OPEX' ELSE 'OTHER' END AS account_range,
         coalesce(CASE WHEN n_regionkey <> 0 THEN n_name END, 'UNKNOWN') AS je_category,
         {D(f"{MONEY('l_extendedprice')} * CASE WHEN l_discount = 0.1 THEN -1 ELSE 1 END")} AS accounted_cr, l_discount = 0.1 AS is_reversal,
         strftime(l_shipdate, '%Y-%m') AS period_name, l_returnflag AS invoice_type, l_shipdate + INTERVAL 10 HOUR AS _ebs_last_update_date,
         coalesce((SELECT max(o_orderdate) FROM orders) >= date_trunc('month', l_shipdate) AND l_shipdate >= DATE '2001-06-01', false) AS _period_open_flag
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey WHERE l_linestatus = 'F')"""


@query("gl_lines", f"WITH {GL} SELECT * FROM gl")
def gl_lines(t: Tables) -> DataFrame:
    out = ledger.period_open_flag(ledger.journal_lines(gl_source(t), taxonomy(t)), periods(t))
    return out.drop("segments", "je_category_name", "status", "accounted_dr", "last_update_date", "closing_status")


def ar_invoices(t: Tables) -> DataFrame:
    s, total = F.col("o_orderstatus"), v.money("o_totalprice")
    return t.orders.select(
        F.col("o_orderkey").alias("trx_id"),
        F.date_format("o_orderdate", "yyyy-MM").alias("period_name"),
        F.col("o_orderpriority").alias("invoice_type"),
        total.alias("invoice_amount"),
        F.when(s == "F", v.money(F.lit(0))).when(s == "O", v.money(total / 2)).otherwise(total).alias("amount_due_remaining"),
        F.date_add(F.to_date("o_orderdate"), 30).alias("due_date"),
    )


def gl_posted(t: Tables) -> DataFrame:
    """Orders with at least one line are posted in full; the few without lines are the variance."""
    posted = t.orders.join(t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_semi")
    return posted.select(
        F.date_format("o_orderdate", "yyyy-MM").alias("period_name"),
        F.col("o_orderpriority").alias("invoice_type"),
        v.money("o_totalprice").alias("accounted_cr"),
    )


AR_GL = f"""WITH ar AS (SELECT strftime(o_orderdate, '%Y-%m') AS period_name, o_orderpriority AS invoice_type, sum({MONEY('o_totalprice')}) AS a FROM orders GROUP BY 1, 2),
gl AS (SELECT strftime(o_orderdate, '%Y-%m') AS period_name, o_orderpriority AS invoice_type, sum({MONEY('o_totalprice')}) AS g FROM orders
  WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) GROUP BY 1, 2),
b AS (SELECT coalesce(ar.period_name, gl.period_name) AS period_name, coalesce(ar.invoice_type, gl.invoice_type) AS invoice_type, a, g,
  {R('coalesce(a, 0) - coalesce(g, 0)', 2)} AS gap FROM ar FULL JOIN gl ON ar.period_name = gl.period_name AND ar.invoice_type = gl.invoice_type)
SELECT period_name, invoice_type, {D('a')} AS ar_total_invoiced, {D('g')} AS gl_total_posted, gap AS variance_aud, {RATIO('gap', 'a', 6)} AS variance_pct,
  coalesce(abs(gap / NULLIF({D('a')}, 0)) < 0.01, false) AS reconciled_flag FROM b"""


@query("ar_gl_recon", AR_GL)
def ar_gl_recon(t: Tables) -> DataFrame:
    return ar_gl_reconciliation(ar_invoices(t), gl_posted(t))


PAYMENT = f"""SELECT o_orderkey AS trx_id, strftime(o_orderdate, '%Y-%m') AS period_name, o_orderpriority AS invoice_type, {D(MONEY('o_totalprice'))} AS invoice_amount,
{D(MONEY(f"CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN {MONEY('o_totalprice')} / 2 ELSE o_totalprice END"))} AS amount_due_remaining,
{DAY("o_orderdate + INTERVAL 30 DAY")} AS due_date, false AS is_reversal,
CASE WHEN o_orderstatus = 'F' THEN 'Paid' WHEN o_orderdate + INTERVAL 30 DAY < DATE '2001-01-01' THEN 'Overdue' WHEN o_orderstatus = 'O' THEN 'Partially Paid' ELSE 'Open' END AS payment_status
FROM orders"""


@query("payment_status", PAYMENT)
def payment_status(t: Tables) -> DataFrame:
    return ledger.receivables(ar_invoices(t), "2001-01-01")


# --- assets ------------------------------------------------------------------------------------------


def purchase_orders(t: Tables) -> DataFrame:
    f, q = F.col("l_returnflag"), v.money("l_quantity")
    return t.lineitem.select(
        F.col("l_orderkey").alias("po_number"),
        F.col("l_linenumber").alias("po_item"),
        q.alias("po_quantity"),
        v.money("l_extendedprice").alias("net_price_aud"),
        F.when(f == "R", q).when(f == "A", v.money(q / 2)).otherwise(v.money(F.lit(0))).alias("goods_receipt_quantity"),
        (F.col("l_tax") == 0.08).alias("deleted"),
        F.col("l_partkey").alias("wbs_element"),
    )


def wbs(t: Tables) -> DataFrame:
    return t.part.filter("p_brand <> 'Brand#13'").select(F.col("p_partkey").alias("wbs_element"), F.col("p_brand").alias("oracle_project_code"))


@query(
    "po_status",
    f"""SELECT l_orderkey AS po_number, l_linenumber AS po_item, {D(MONEY('l_quantity'))} AS po_quantity, {D(R(f"{MONEY('l_quantity')} * {MONEY('l_extendedprice')}", 2))} AS total_value_aud,
CASE WHEN l_tax = 0.08 THEN 'Cancelled' WHEN l_returnflag = 'R' THEN 'Completed' WHEN l_returnflag = 'A' THEN 'Partially Received' ELSE 'Open' END AS po_status,
CASE WHEN p_brand <> 'Brand#13' THEN p_brand END AS oracle_project_code FROM lineitem JOIN part ON p_partkey = l_partkey""",
)
def po_status(t: Tables) -> DataFrame:
    out = assets_plan.procurement_orders(purchase_orders(t), wbs(t))
    return out.drop("net_price_aud", "goods_receipt_quantity", "deleted", "wbs_element")


TODAY = "1999-06-30"


def asset_rows(t: Tables) -> DataFrame:
    size = F.col("p_size")
    site = F.concat(F.lit("Exchange POI-SYD"), F.lpad((F.col("p_partkey") % 10000).cast("string"), 4, "0"), F.lit(" rack 3"))
    return t.part.select(
        F.col("p_partkey").alias("equipment_id"),
        F.when(F.col("p_brand") == "Brand#7", "no site").otherwise(site).alias("functional_location"),
        F.when(size > 1, F.date_add(F.lit(dt.date(1985, 1, 1)), size * 100)).alias("installation_date"),
        F.date_add(F.lit(dt.date(1995, 1, 1)), size * 100).alias("warranty_expiry_date"),
        F.when(size > 45, "X").otherwise("").alias("deletion_flag"),
        F.lit("Active").alias("user_status"),
        F.col("p_type").alias("category_code"),
    )


def asset_categories(t: Tables) -> DataFrame:
    return t.part.filter("p_type <> 'ECONOMY'").select(F.col("p_type").alias("category_code")).distinct().withColumn(
        "equipment_category", F.initcap("category_code")
    )


POI = "CASE WHEN p_brand <> 'Brand#7' THEN 'POI-SYD' || lpad(CAST(p_partkey % 10000 AS VARCHAR), 4, '0') END"
AGE = R(f"date_diff('day', CASE WHEN p_size > 1 THEN DATE '1985-01-01' + p_size * 100 END, DATE '{TODAY}') / 365.25", 2)


@query(
    "lifecycle_status",
    f"""SELECT p_partkey AS equipment_id, {POI} AS poi_id, {AGE} AS asset_age_years, CASE WHEN p_size > 45 THEN 'Decommissioned' ELSE 'Active' END AS lifecycle_status,
CASE WHEN p_type = 'ECONOMY' THEN 'UNKNOWN' ELSE upper(substring(p_type, 1, 1)) || lower(substring(p_type, 2)) END AS equipment_category FROM part""",
)
def lifecycle_status(t: Tables) -> DataFrame:
    out = assets_plan.network_assets(asset_rows(t), asset_categories(t), TODAY)
    return out.select("equipment_id", "poi_id", "asset_age_years", "lifecycle_status", "equipment_category")


def performance(t: Tables) -> DataFrame:
    poi = F.concat(F.lit("POI-SYD"), F.lpad((F.col("l_partkey") % 10000).cast("string"), 4, "0"))
    return t.lineitem.select(
        poi.alias("poi_id"),
        F.to_date("l_shipdate").alias("report_date"),
        v.money(F.col("l_quantity") * 2).alias("utilisation_pct"),
        v.money(F.col("l_tax") * 100).alias("latency_ms"),
    )


def maintenance(t: Tables) -> DataFrame:
    f = F.col("l_returnflag")
    return t.lineitem.select(
        F.col("l_partkey").alias("equipment_id"),
        F.when(f == "R", "PM01").when(f == "A", "PM02").otherwise("PM03").alias("order_type"),
        F.to_date("l_shipdate").alias("actual_finish"),
    )


HEALTH = f"""WITH perf AS (
  SELECT 'POI-SYD' || lpad(CAST(l_partkey % 10000 AS VARCHAR), 4, '0') AS poi_id, {R('quantile_cont(l_quantity * 2, 0.95)', 4)} AS util,
         {R(f"quantile_cont({D(MONEY('l_tax * 100'))}, 0.95)", 4)} AS lat
  FROM lineitem WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '{TODAY}' - 30 AND DATE '{TODAY}' GROUP BY 1),
work AS (
  SELECT l_partkey, count(*) FILTER (WHERE l_returnflag = 'R' AND CAST(l_shipdate AS DATE) BETWEEN DATE '{TODAY}' - 90 AND DATE '{TODAY}') AS faults,
         max(CASE WHEN l_returnflag = 'A' THEN CAST(l_shipdate AS DATE) END) AS prevented FROM lineitem GROUP BY 1),
a AS (SELECT p_partkey, {POI} AS poi_id, {AGE} AS age, DATE '1995-01-01' + p_size * 100 AS warranty FROM part)
SELECT p_partkey AS equipment_id, a.poi_id, age AS asset_age_years, {DAY('warranty')} AS warranty_expiry_date, util AS utilisation_p95_30d, lat AS latency_p95_30d,
       coalesce(faults, 0) AS fault_count_90d, CAST(prevented AS VARCHAR) AS last_preventive_maintenance,
       {R("25.0 * least(greatest(coalesce(age / 10, 0), 0), 1) + 25.0 * least(greatest(coalesce(util / 100, 0), 0), 1) + 25.0 * least(coalesce(CAST(faults AS DOUBLE) / 5, 0), 1) + 25.0 * CASE WHEN warranty < DATE '" + TODAY + "' THEN 1 ELSE 0 END", 2)} AS refresh_risk_score
FROM a LEFT JOIN perf ON perf.poi_id = a.poi_id LEFT JOIN work ON l_partkey = p_partkey"""


@query("asset_health", HEALTH)
def asset_health(t: Tables) -> DataFrame:
    a = assets_plan.network_assets(asset_rows(t), asset_categories(t), TODAY)
    a = a.select("equipment_id", "poi_id", "asset_age_years", "warranty_expiry_date")
    return agg.asset_health(a, performance(t), maintenance(t), TODAY)


def people(t: Tables) -> DataFrame:
    code = F.concat(F.lit("C"), F.col("s_nationkey").cast("string"))
    quals = F.array(
        F.struct(code.alias("code"), F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("s_nationkey")).alias("expiry")),
        F.struct(F.lit("ACMA").alias("code"), F.when(F.col("s_acctbal") > 0, dt.date(2024, 2, 1)).otherwise(dt.date(2023, 2, 1)).alias("expiry")),
    )
    return t.supplier.select(
        F.col("s_suppkey").alias("employee_id"),
        F.col("s_name").alias("first_name"),
        F.col("s_name").alias("last_name"),
        F.col("s_name").alias("preferred_name"),
        quals.alias("qualifications"),
        F.floor(F.col("s_suppkey") / 10).alias("manager_employee_id"),
    )


PEOPLE = """SELECT s.s_suppkey AS employee_id, 'Employee' AS first_name, s.s_suppkey AS last_name, s.s_name AS preferred_name,
array_to_string(list_sort(list_filter([CASE WHEN DATE '2024-01-01' + s.s_nationkey >= DATE '2024-01-12' THEN 'C' || s.s_nationkey END, CASE WHEN s.s_acctbal > 0 THEN 'ACMA' END], lambda x: x IS NOT NULL)), ',') AS certifications,
CAST(DATE '2024-01-01' + s.s_nationkey AS VARCHAR) AS first_expiry, s.s_suppkey // 10 AS manager_employee_id, m.s_name AS manager_preferred_name
FROM supplier s LEFT JOIN supplier m ON m.s_suppkey = s.s_suppkey // 10"""


@query("active_quals", PEOPLE)
def active_quals(t: Tables) -> DataFrame:
    out = assets_plan.workforce(people(t), "staging", "2024-01-12")
    first = F.element_at(F.col("certification_expiry_dates"), F.element_at(F.map_keys("certification_expiry_dates"), 1))
    return out.withColumn("first_expiry", first).drop("certification_expiry_dates")


# --- experience ---------------------------------------------------------------------------------------


def cx_responses(t: Tables) -> DataFrame:
    rsp = F.col("user_id") % 10
    return t.events.select(
        F.col("event_id").alias("response_id"),
        F.col("event_type").alias("programme_id"),
        F.when(rsp != 0, rsp).alias("rsp_code"),
        F.when(F.col("event_type") == "error", F.col("event_id")).alias("servicenow_incident_id"),
        F.col("ts").alias("response_timestamp"),
        (v.k() % 11).alias("nps_score"),
        F.when(F.col("event_type") == "click", v.k() % 5 + 1).otherwise(v.k() % 11).alias("satisfaction"),
    )


def programmes(t: Tables) -> DataFrame:
    five = F.col("programme_id") == "click"
    return t.events.select(F.col("event_type").alias("programme_id")).distinct().withColumns(
        {"scale_low": F.when(five, 1).otherwise(0), "scale_high": F.when(five, 5).otherwise(10)}
    )


CX = f"""cx AS (
  SELECT event_id AS response_id, event_type AS programme_id, CASE WHEN user_id % 10 <> 0 THEN user_id % 10 END AS rsp_code,
         CASE WHEN event_type = 'error' THEN event_id END AS servicenow_incident_id, ts + INTERVAL 10 HOUR AS response_timestamp, {v.K} % 11 AS nps_score,
         {R(f"CASE WHEN event_type = 'click' THEN CAST({v.K} % 5 AS DOUBLE) / 4 ELSE CAST({v.K} % 11 AS DOUBLE) / 10 END * 100", 2)} AS overall_satisfaction_score
  FROM events),
cx_all AS (SELECT *, CASE WHEN nps_score >= 9 THEN 'Promoter' WHEN nps_score >= 7 THEN 'Passive' ELSE 'Detractor' END AS nps_category,
  CAST(CAST(response_timestamp AS DATE) AS VARCHAR) AS response_date FROM cx)"""


@query("survey_responses", f"WITH {CX} SELECT * FROM cx_all")
def survey_responses(t: Tables) -> DataFrame:
    return experience.survey_responses(cx_responses(t), programmes(t)).drop("satisfaction")


CORRELATION = f"""WITH {ITSM}, {CX}, {control.TOPICS}
SELECT c.response_id, response_date, servicenow_incident_id, priority AS incident_priority, resolution_minutes, sla_breached_flag, nps_score, nps_category,
  {D('sentiment_score')} AS fault_resolution_sentiment, overall_satisfaction_score, rsp_code
FROM cx_all c JOIN itsm_flags ON snow_sys_id = servicenow_incident_id LEFT JOIN topics t ON t.response_id = c.response_id AND topic_code = 'FAULT_RESOL'"""


@query("cx_fault_correlation", CORRELATION)
def cx_fault_correlation(t: Tables) -> DataFrame:
    inc = itsm.incidents_with_flags(itsm_incidents(t), itsm_slas(t))
    r = experience.survey_responses(cx_responses(t), programmes(t))
    return experience.cx_fault_correlation(r, inc, control.topics(t))


@query(
    "percentiles_by_rank",
    f"""SELECT event_type, {R('quantile_cont(value, 0.5)', 4)} AS p50, {R('quantile_cont(value, 0.95)', 4)} AS p95, {R('max(value)', 4)} AS p100 FROM events GROUP BY 1""",
)
def percentiles_by_rank(t: Tables) -> DataFrame:
    """Exact percentiles of values without a grid."""
    return selection.percentiles_by_rank(t.events, ["event_type"], "value", {"p50": 0.5, "p95": 0.95, "p100": 1.0})


@query(
    "p95_as_of_every_day",
    f"""WITH f AS (SELECT user_id AS poi_id, CAST(ts AS DATE) AS d, round({MONEY('value')}, 0) AS pct FROM events),
days AS (SELECT DISTINCT poi_id, CAST(d + CAST(k AS INTEGER) AS DATE) AS as_of FROM f, unnest(generate_series(0, 30)) AS s(k))
SELECT days.poi_id, CAST(as_of AS VARCHAR) AS as_of, count(*) AS rows, {R('quantile_cont(CAST(pct AS DOUBLE), 0.95)', 4)} AS p95
FROM days JOIN f ON f.poi_id = days.poi_id AND f.d BETWEEN as_of - 30 AND as_of WHERE as_of <= DATE '2024-02-10' GROUP BY ALL""",
)
def p95_as_of_every_day(t: Tables) -> DataFrame:
    """Utilisation in the thirty days before every day, not before one fixed date."""
    facts = t.events.select(F.col("user_id").alias("poi_id"), F.to_date("ts").alias("d"), F.round(v.money("value"), 0).alias("pct"))
    return selection.percentile_as_of(facts, ["poi_id"], "d", "pct", 0.95, 30, "2024-02-10", "p95")
