"""The further outputs of the service, asset, finance and customer feeds, each evaluated through the whole load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.plans import assets as assets_plan
from tidegate.plans import itsm
from workload import loads, specs
from workload import views as v
from workload.registry import DAY, MONEY, RATIO, SQL, D, Tables, query

# --- incidents, SLA clocks, problems, work orders ------------------------------------

HOLIDAYS = ["1995-01-02", "1996-12-25"]


def sla_clocks(t: Tables) -> DataFrame:
    """A clock per order line: it runs for some days and stands still for a while."""
    start = F.col("l_shipdate").cast("timestamp_ntz")
    return t.lineitem.select(
        F.col("l_orderkey").alias("incident_sys_id"),
        (F.col("l_tax") >= 0.08).alias("has_breached"),
        start.alias("start_time"),
        (start + F.make_dt_interval(mins=F.col("l_quantity").cast("int") * 97)).alias("end_time"),
        F.when(F.col("l_linenumber") > 1, F.col("l_linenumber") * 10).alias("pause_duration_minutes"),
    )


def itsm_outputs(t: Tables) -> dict[str, DataFrame]:
    problems = t.customer.select(F.col("c_custkey").alias("snow_sys_id"), F.col("c_mktsegment").alias("problem_area"))
    return itsm.itsm_load(specs.itsm_incidents(t), sla_clocks(t), problems, specs.work_orders(t), HOLIDAYS)


@query("load_itsm_incidents", f"WITH {specs.ITSM} SELECT * FROM itsm_flags")
def load_itsm_incidents(t: Tables) -> DataFrame:
    return itsm_outputs(t)["incidents"]


@query(
    "load_itsm_task_slas",
    f"""WITH raw AS (SELECT l_orderkey, l_linenumber, l_tax >= 0.08 AS hit, CAST(l_shipdate AS TIMESTAMP) + INTERVAL 10 HOUR AS began,
  CAST(l_quantity AS INTEGER) * 97 AS mins, CASE WHEN l_linenumber > 1 THEN l_linenumber * 10 ELSE 0 END AS pause FROM lineitem),
kinds AS (SELECT DISTINCT began, mins FROM raw),
cal AS (SELECT d FROM generate_series((SELECT date_trunc('day', min(began)) FROM raw), (SELECT max(began) + INTERVAL 5 DAY FROM raw), INTERVAL 1 DAY) g(d)
  WHERE isodow(d) <= 5 AND CAST(d AS DATE) NOT IN (DATE '1995-01-02', DATE '1996-12-25')),
worked AS (SELECT began, mins, coalesce(sum(greatest(0, date_diff('minute', greatest(began, d + INTERVAL 8 HOUR), least(began + to_minutes(mins), d + INTERVAL 18 HOUR))))
    FILTER (WHERE d IS NOT NULL), 0) AS w
  FROM kinds LEFT JOIN cal ON d + INTERVAL 1 DAY > began AND d < began + to_minutes(mins) GROUP BY began, mins)
SELECT l_orderkey AS incident_sys_id, hit AS has_breached, CAST(mins AS BIGINT) AS actual_elapsed_minutes, CAST(mins - pause AS BIGINT) AS net_elapsed_minutes,
  CAST(greatest(w - pause, 0) AS BIGINT) AS business_duration_minutes FROM raw JOIN worked USING (began, mins)""",
)
def load_itsm_task_slas(t: Tables) -> DataFrame:
    return itsm_outputs(t)["task_slas"].drop("start_time", "end_time", "pause_duration_minutes")


@query(
    "load_itsm_problems",
    """WITH linked AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey)
SELECT c_custkey AS snow_sys_id, c_mktsegment AS problem_area, coalesce(n, 0) AS linked_incident_count FROM customer LEFT JOIN linked ON o_custkey = c_custkey""",
)
def load_itsm_problems(t: Tables) -> DataFrame:
    return itsm_outputs(t)["problems"]


@query(
    "load_itsm_work_orders",
    f"""WITH {v.SHIPPED} SELECT o_orderkey AS work_order_id, o_custkey AS location_address, o_orderdate AS scheduled_start,
  CASE o_orderstatus WHEN 'F' THEN 'Resolved' WHEN 'O' THEN 'Escalated' ELSE 'No Access' END AS closure_code,
  date_diff('minute', o_orderdate, done_at) AS time_on_site_minutes, {specs.follow_up('shipped')} AS rework_flag FROM shipped""",
)
def load_itsm_work_orders(t: Tables) -> DataFrame:
    return itsm_outputs(t)["work_orders"].select(
        "work_order_id", "location_address", "scheduled_start", "closure_code", "time_on_site_minutes", "rework_flag"
    )


# --- assets ------------------------------------------------------------------------------


def asset_outputs(t: Tables) -> dict[str, DataFrame]:
    return assets_plan.asset_load(specs.asset_rows(t), specs.asset_categories(t), specs.performance(t), specs.maintenance(t),
                                  specs.purchase_orders(t), specs.wbs(t), specs.people(t), "staging", specs.TODAY)


@query("load_assets_register", SQL["lifecycle_status"])
def load_assets_register(t: Tables) -> DataFrame:
    return asset_outputs(t)["assets"].select("equipment_id", "poi_id", "asset_age_years", "lifecycle_status", "equipment_category")


@query(
    "load_assets_maintenance",
    f"""WITH named AS (SELECT * FROM (VALUES ('R', 'PM01', 'Corrective'), ('A', 'PM02', 'Preventive'), ('N', 'PM03', 'Inspection')) AS x(flag, code, label))
SELECT l_partkey AS equipment_id, code AS order_type, {DAY('l_shipdate')} AS actual_finish, label AS order_type_description FROM lineitem JOIN named ON flag = l_returnflag""",
)
def load_assets_maintenance(t: Tables) -> DataFrame:
    return asset_outputs(t)["maintenance"]


@query("load_assets_procurement", SQL["po_status"])
def load_assets_procurement(t: Tables) -> DataFrame:
    return asset_outputs(t)["procurement"].drop("net_price_aud", "goods_receipt_quantity", "deleted", "wbs_element")


# On this day every certification is still valid.
STILL_VALID = specs.PEOPLE.replace("2024-01-12", specs.TODAY).replace("CASE WHEN s.s_acctbal > 0 THEN 'ACMA' END", "'ACMA'")


@query("load_assets_workforce", STILL_VALID)
def load_assets_workforce(t: Tables) -> DataFrame:
    expiry = F.col("certification_expiry_dates")
    return asset_outputs(t)["workforce"].withColumn("first_expiry", F.map_values(expiry)[0]).drop("certification_expiry_dates")


@query(
    "load_assets_gate",
    f"""WITH a AS (SELECT {RATIO(f'count({specs.POI})', 'count(*)', 4)} AS share FROM part),
p AS (SELECT {RATIO("count(CASE WHEN p_brand <> 'Brand#13' THEN 1 END)", 'count(*)', 4)} AS share FROM lineitem LEFT JOIN part ON p_partkey = l_partkey)
SELECT 'assets.match_rate.poi_id' AS "check", share AS observed, CAST(0.9 AS DOUBLE) AS threshold, share >= 0.9 AS passed, 'warn' AS severity FROM a
UNION ALL SELECT 'procurement.match_rate.project_code', share, CAST(0.8 AS DOUBLE), share >= 0.8, 'warn' FROM p""",
)
def load_assets_gate(t: Tables) -> DataFrame:
    return asset_outputs(t)["gate"]


# --- finance -----------------------------------------------------------------------------


@query(
    "load_ledger_receivables",
    f"""SELECT strftime(o_orderdate, '%Y-%m') AS period_name, translate(o_orderstatus, 'FOP', 'ANR') AS invoice_type, {D(MONEY('o_totalprice'))} AS invoice_amount,
  {DAY('o_orderdate')} AS due_date, CASE WHEN {MONEY('o_totalprice')} = 0 THEN 'Paid' WHEN CAST(o_orderdate AS DATE) < DATE '2001-01-01' AND o_totalprice > 0 THEN 'Overdue' ELSE 'Open' END AS payment_status,
  o_totalprice < 0 AS is_reversal FROM orders""",
)
def load_ledger_receivables(t: Tables) -> DataFrame:
    return loads.ledger_outputs(t)["receivables"].drop("amount_due_remaining")


@query(
    "load_ledger_payables",
    f"""WITH due AS (SELECT l_partkey, {MONEY('l_extendedprice')} AS billed, {MONEY('l_extendedprice * (1 - l_discount)')} AS paid FROM lineitem)
SELECT CAST(l_partkey AS VARCHAR) AS account_code, {D('billed')} AS invoice_amount, {D('paid')} AS amount_paid, {D('billed - paid')} AS amount_remaining,
  CASE WHEN paid >= billed THEN 'Paid' WHEN paid > 0 THEN 'Partially Paid' ELSE 'Unpaid' END AS payment_status, coalesce(p_type, 'Opex') AS expense_category
FROM due LEFT JOIN part ON p_partkey = l_partkey""",
)
def load_ledger_payables(t: Tables) -> DataFrame:
    return loads.ledger_outputs(t)["payables"]


@query(
    "load_ledger_actuals",
    f"""SELECT {D(MONEY('l_extendedprice'))} AS amount_aud, l_linestatus = 'F' AS gl_posted, l_returnflag = 'R' AS po_backed, l_extendedprice < 0 AS is_reversal,
  CASE WHEN l_linestatus = 'F' THEN 'Actual' WHEN l_returnflag = 'R' THEN 'Committed' ELSE 'Forecast' END AS transaction_type FROM lineitem""",
)
def load_ledger_actuals(t: Tables) -> DataFrame:
    return loads.ledger_outputs(t)["project_actuals"]


# --- customers ---------------------------------------------------------------------------


@query("load_crm_opportunities", SQL["recurring_revenue"])
def load_crm_opportunities(t: Tables) -> DataFrame:
    return loads.crm_outputs(t)["opportunities"].select("sf_opportunity_id", "mrr_aud", "arr_aud")
