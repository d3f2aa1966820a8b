"""Business-shaped views over the test tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.numbers import MONEY as MONEY_TYPE
from tidegate.functions.times import floor_hour
from workload.registry import MONEY, Tables


def money(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(MONEY_TYPE)


def k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"


# --- billing lines: one per line item ------------------------------------------


def billing_lines(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_suppkey").alias("rsp_id"),
        F.to_date("l_shipdate").alias("billing_date"),
        F.col("l_orderkey").alias("service_id"),
        F.col("l_linestatus").alias("plan_code"),
        money("l_extendedprice").alias("charge_amount_aud"),
        money("l_quantity").alias("cvc_mb_allocated"),
        money(F.col("l_quantity") * (1 - F.col("l_discount"))).alias("cvc_mb_used"),
        F.col("l_shipdate").alias("loaded_at"),
    )


BILLING = f"""billing AS (
  SELECT l_suppkey AS rsp_id, CAST(l_shipdate AS DATE) AS billing_date, l_orderkey AS service_id,
         l_linestatus AS plan_code, {MONEY('l_extendedprice')} AS charge_amount_aud,
         {MONEY('l_quantity')} AS cvc_mb_allocated, {MONEY('l_quantity * (1 - l_discount)')} AS cvc_mb_used,
         l_shipdate AS loaded_at
  FROM lineitem)"""


# --- customers with nation and region -------------------------------------------


def accounts(t: Tables) -> DataFrame:
    places = t.nation.join(t.region, t.nation.n_regionkey == t.region.r_regionkey).select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name"
    )
    return t.customer.join(places, "c_nationkey")


ACCOUNTS = """accounts AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, n_name, r_name
  FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey)"""


# --- orders with the first shipment on or after the order date ---------------------


def shipped_orders(t: Tables) -> DataFrame:
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate")
    # An inner join can be split on either side, so an order with very many
    # lines does not end up in one task; the minimum then combines per task.
    done = (
        lines.join(t.orders.select("o_orderkey", "o_orderdate"), "o_orderkey")
        .filter(F.col("l_shipdate") >= F.col("o_orderdate"))
        .groupBy("o_orderkey")
        .agg(F.min("l_shipdate").alias("done_at"))
    )
    return t.orders.join(done, "o_orderkey", "left")


SHIPPED = """shipped AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
         min(CASE WHEN l_shipdate >= o_orderdate THEN l_shipdate END) AS done_at
  FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
  GROUP BY ALL)"""


def owned_orders(t: Tables) -> DataFrame:
    return shipped_orders(t).join(accounts(t), F.col("o_custkey") == F.col("c_custkey"))


def _as_activation() -> list[Column]:
    p, s = F.col("o_orderpriority"), F.col("o_orderstatus")
    return [
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("service_id"),
        F.col("c_nationkey").alias("rsp_id"),
        F.col("n_name").alias("rsp_name"),
        F.col("c_mktsegment").alias("technology_type"),
        F.lower("c_mktsegment").alias("customer_segment"),
        F.when(p == "1-URGENT", "Priority").when(p == "2-HIGH", "Business").otherwise("Residential").alias("order_priority"),
        F.col("o_orderdate").alias("order_created_at"),
        F.col("done_at").alias("activation_completed_at"),
        F.when(s == "F", "ACT").when(s == "O", "PND").when(s == "P", "PRG").alias("status_code"),
        F.col("r_name").alias("state_territory"),
    ]


def activations(t: Tables) -> DataFrame:
    return owned_orders(t).select(*_as_activation())


ACTIVATIONS = f"""{ACCOUNTS}, {SHIPPED}, activations AS (
  SELECT o_orderkey AS order_id, o_custkey AS service_id, c_nationkey AS rsp_id, n_name AS rsp_name,
         c_mktsegment AS technology_type, upper(c_mktsegment) AS customer_segment,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Priority' WHEN '2-HIGH' THEN 'Business' ELSE 'Residential' END AS order_priority,
         o_orderdate AS order_created_at, done_at AS activation_completed_at,
         CASE o_orderstatus WHEN 'F' THEN 'ACT' WHEN 'O' THEN 'PND' WHEN 'P' THEN 'PRG' END AS status_code,
         CASE o_orderstatus WHEN 'F' THEN 'ACTIVE' WHEN 'O' THEN 'PENDING' WHEN 'P' THEN 'IN_PROGRESS' END AS status,
         r_name AS state_territory
  FROM shipped JOIN accounts ON c_custkey = o_custkey),
sla AS (
  SELECT *, CAST(activation_completed_at AS DATE) AS run_date,
         CAST((epoch_us(activation_completed_at) - epoch_us(order_created_at)) / 86400000000.0 AS DECIMAL(38,2)) AS days_to_activate,
         CASE WHEN status = 'ACTIVE' THEN coalesce(
           (epoch_us(activation_completed_at) - epoch_us(order_created_at)) / 86400000000.0 <=
           CASE lower(order_priority) WHEN 'priority' THEN 2 WHEN 'business' THEN 5 ELSE 15 END, false) END AS sla_met
  FROM activations)"""


# --- incidents: the same orders seen as faults ---------------------------------------


def _fault() -> list[Column]:
    premises = F.floor("o_totalprice")
    return [
        F.col("o_orderdate").alias("opened_at"),
        F.when(F.col("o_orderstatus") != "O", F.col("done_at")).alias("resolved_at"),
        premises.alias("premises_count"),
        (premises >= 2500).alias("msf_ever"),
    ]


def incidents(t: Tables) -> DataFrame:
    return owned_orders(t).select(
        F.col("o_orderkey").alias("sys_id"),
        F.col("o_custkey").alias("affected_poi_id"),
        F.col("c_nationkey").alias("rsp_id"),
        F.col("c_mktsegment").alias("technology_type"),
        F.col("r_name").alias("state_territory"),
        *_fault(),
    )


def activated_and_faulty(t: Tables) -> DataFrame:
    """Every order as an activation and as an incident, in one row."""
    return owned_orders(t).select(*_as_activation(), *_fault())


INCIDENTS = """incidents AS (
  SELECT o_orderkey AS sys_id, o_orderdate AS opened_at,
         CASE WHEN o_orderstatus <> 'O' THEN done_at END AS resolved_at,
         CAST(floor(o_totalprice) AS BIGINT) AS premises_count, o_custkey AS affected_poi_id,
         c_nationkey AS rsp_id, c_mktsegment AS technology_type, r_name AS state_territory
  FROM shipped JOIN accounts ON c_custkey = o_custkey)"""


# --- capacity: hourly traffic per user against contracts ------------------------------


def hourly_traffic(t: Tables) -> DataFrame:
    return t.events.groupBy(F.col("user_id").alias("poi_id"), floor_hour("ts").alias("hour_label")).agg(
        F.sum(money("value")).alias("throughput_gbps")
    )


def contracts(t: Tables) -> DataFrame:
    """Customers in credit hold two consecutive contracts, the newer twice as large."""
    held = t.customer.filter("c_acctbal > 0")
    periods = F.explode(
        F.array(
            F.struct(
                F.lit("1995-01-01").cast("date").alias("effective_from"),
                F.lit("2024-01-15").cast("date").alias("effective_to"),
                money(F.col("c_acctbal") / 100).alias("contracted_cvc_gbps"),
            ),
            F.struct(
                F.lit("2024-01-15").cast("date").alias("effective_from"),
                F.lit(None).cast("date").alias("effective_to"),
                money(F.col("c_acctbal") / 50).alias("contracted_cvc_gbps"),
            ),
        )
    )
    return held.select(F.col("c_custkey").alias("poi_id"), periods.alias("p")).select("poi_id", "p.*")


CONTRACT_DAY = "2024-01-20"
TRAFFIC = f"""traffic AS (
  SELECT user_id AS poi_id, date_trunc('hour', ts) AS hour_label, sum({MONEY('value')}) AS throughput_gbps
  FROM events GROUP BY 1, 2)"""
CONTRACTS = f"""contracts AS (
  SELECT c_custkey AS poi_id, DATE '1995-01-01' AS effective_from, DATE '2024-01-15' AS effective_to,
         {MONEY('c_acctbal / 100')} AS contracted_cvc_gbps FROM customer WHERE c_acctbal > 0
  UNION ALL
  SELECT c_custkey, DATE '2024-01-15', NULL, {MONEY('c_acctbal / 50')} FROM customer WHERE c_acctbal > 0)"""
UTILISATION = f"""{TRAFFIC}, {CONTRACTS}, live AS (
  SELECT poi_id, contracted_cvc_gbps AS contracted_gbps FROM contracts
  WHERE effective_from <= DATE '{CONTRACT_DAY}' AND (effective_to IS NULL OR effective_to > DATE '{CONTRACT_DAY}')),
utilisation AS (
  SELECT *, coalesce(utilisation_pct > 80, false) AS congestion_flag FROM (
    SELECT t.poi_id, hour_label, throughput_gbps, contracted_gbps,
           CAST(round(CAST(CAST(throughput_gbps AS DOUBLE) / NULLIF(CAST(contracted_gbps AS DOUBLE), 0) * 100 AS DECIMAL(38,12)), 2) AS DOUBLE) AS utilisation_pct,
           CAST(round(CAST(contracted_gbps - throughput_gbps AS DECIMAL(38,12)), 3) AS DOUBLE) AS headroom_gbps
    FROM traffic t LEFT JOIN live l ON l.poi_id = t.poi_id))"""


# --- node samples ----------------------------------------------------------------------


def node_samples(t: Tables) -> DataFrame:
    return t.events.select(
        F.col("user_id").alias("node_id"),
        F.col("event_type").alias("node_type"),
        F.concat(F.lit("P"), k().cast("string")).alias("poi_id"),
        F.upper("event_type").alias("state_territory"),
        (F.col("event_type") != "error").alias("is_up"),
        (F.col("value") / 100).alias("interface_errors"),
        k().cast("double").alias("cpu_pct"),
        ((k() * 7) % 100).cast("double").alias("mem_pct"),
        F.col("ts").alias("sample_ts"),
    )


def _avg(expr: str) -> str:
    return (
        f"CAST(round(CAST(CAST(sum({MONEY(expr)}) AS DOUBLE) / count({expr}) AS DECIMAL(38,12)), 4) AS DOUBLE)"
    )


NODES = f"""nodes AS (
  SELECT user_id AS node_id, date_trunc('hour', ts) AS hour_label,
         arg_max(event_type, ts) AS node_type, arg_max('P' || {K}, ts) AS poi_id, arg_max(upper(event_type), ts) AS state_territory,
         CAST(round(CAST(CAST(count(*) FILTER (WHERE event_type <> 'error') AS DOUBLE) / count(*) * 100 AS DECIMAL(38,12)), 4) AS DOUBLE) AS availability_pct,
         {_avg('value / 100')} AS error_rate_pct, {_avg(K)} AS cpu_utilisation_pct,
         {_avg(f'(({K}) * 7) % 100')} AS mem_utilisation_pct, count(*) AS sample_count
  FROM events GROUP BY 1, 2),
scored AS (
  SELECT *, CASE WHEN health_score < 40 THEN 'CRITICAL' WHEN health_score < 60 THEN 'WARNING' ELSE 'HEALTHY' END AS health_status
  FROM (SELECT *, CAST(greatest(100
      - CASE WHEN availability_pct < 95 THEN 40 WHEN availability_pct < 99 THEN 20 ELSE 0 END
      - CASE WHEN error_rate_pct > 1.0 THEN 30 WHEN error_rate_pct > 0.1 THEN 15 ELSE 0 END
      - CASE WHEN cpu_utilisation_pct > 95 THEN 20 WHEN cpu_utilisation_pct > 80 THEN 10 ELSE 0 END
      - CASE WHEN mem_utilisation_pct > 95 THEN 10 WHEN mem_utilisation_pct > 85 THEN 5 ELSE 0 END, 0) AS INTEGER) AS health_score
    FROM nodes))"""


# --- survey responses ---------------------------------------------------------------------


def responses(t: Tables) -> DataFrame:
    """Survey answers: score from the event, comment from the document of the same id."""
    docs = t.documents.select(F.col("doc_id").alias("event_id"), F.col("text").alias("verbatim"))
    return t.events.join(docs, "event_id", "left").select(
        F.col("event_id").alias("response_id"),
        F.col("user_id").alias("service_id"),
        (k() % 11).cast("string").alias("score"),
        "verbatim",
        F.col("event_type").alias("survey_channel"),
        F.col("ts").alias("completed_at"),
    )


def survey_facts(t: Tables) -> DataFrame:
    rsp = F.col("user_id") % 10
    return t.events.select(
        F.col("event_id").alias("response_id"),
        F.to_date("ts").alias("response_date"),
        F.col("event_type").alias("programme_id"),
        F.when(rsp != 0, rsp).alias("rsp_code"),
        (k() % 11).alias("nps_score"),
        money("value").alias("overall_satisfaction_score"),
    )


SURVEY = f"""survey AS (
  SELECT event_id AS response_id, CAST(ts AS DATE) AS response_date, event_type AS programme_id,
         CASE WHEN user_id % 10 <> 0 THEN user_id % 10 END AS rsp_code, {K} % 11 AS nps_score,
         {MONEY('value')} AS sat FROM events)"""


# --- two order books for reconciliation ---------------------------------------------------


def billing_orders(t: Tables) -> DataFrame:
    s = F.col("o_orderstatus")
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("service_id"),
        F.col("c_nationkey").alias("rsp_id"),
        F.col("o_orderpriority").alias("product_code"),
        F.when(s == "F", "ACTIVE").when(s == "O", "SUSPENDED").otherwise("CEASED").alias("billing_status"),
        money(F.col("o_totalprice") / 100).alias("rate_per_gbps"),
        F.col("o_orderdate").alias("effective_from"),
    )


def crm_orders(t: Tables) -> DataFrame:
    """Orders as the delivered lines show them: some product codes, owners and rates differ."""
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_tax").alias("tax"),
        F.max("l_linestatus").alias("line_status"),
        F.min("l_quantity").alias("qty"),
        F.max("l_discount").alias("disc"),
    )
    return (
        t.orders.join(lines, "o_orderkey")
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("service_id"),
            F.when(F.col("qty") < 40, F.col("c_nationkey")).alias("rsp_id"),
            F.when(F.col("disc") < 0.03, "CHANGED").otherwise(F.col("o_orderpriority")).alias("product_code"),
            F.when(F.col("line_status") == "F", "Suspended").otherwise("Active").alias("status"),
            (money(F.col("o_totalprice") / 100) + F.greatest(money("tax") - money(F.lit(0.06)), money(F.lit(0)))).alias("rate_per_gbps"),
        )
    )


ORDER_BOOKS = f"""billing AS (
  SELECT o_orderkey AS order_id, c_nationkey AS rsp_id, o_orderpriority AS product_code,
         {MONEY('o_totalprice / 100')} AS rate_per_gbps
  FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus IN ('F', 'O')),
crm AS (
  SELECT o_orderkey AS order_id, CASE WHEN min(l_quantity) < 40 THEN c_nationkey END AS rsp_id,
         CASE WHEN max(l_discount) < 0.03 THEN 'CHANGED' ELSE o_orderpriority END AS product_code,
         {MONEY('o_totalprice / 100')} + greatest({MONEY('max(l_tax)')} - 0.06, 0) AS rate_per_gbps
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
  GROUP BY o_orderkey, c_nationkey, o_orderpriority, o_totalprice),
recon AS (
  SELECT coalesce(b.order_id, c.order_id) AS order_id,
         CASE WHEN b.order_id IS NULL THEN c.rsp_id ELSE b.rsp_id END AS rsp_id,
         CASE WHEN b.order_id IS NULL THEN c.product_code ELSE b.product_code END AS product_code,
         CASE WHEN b.order_id IS NULL THEN c.rate_per_gbps ELSE b.rate_per_gbps END AS rate_per_gbps,
         CASE WHEN c.order_id IS NULL THEN 'GHOST' WHEN b.order_id IS NULL THEN 'ORPHAN'
              WHEN b.rsp_id IS DISTINCT FROM c.rsp_id OR b.product_code IS DISTINCT FROM c.product_code THEN 'MISMATCH'
              WHEN abs(coalesce(b.rate_per_gbps, 0) - coalesce(c.rate_per_gbps, 0)) > 0.01 THEN 'RATE_ERR' END AS discrepancy_type,
         CASE WHEN c.order_id IS NULL THEN 'EBS_ONLY' WHEN b.order_id IS NULL THEN 'SF_ONLY' END AS source,
         c.rsp_id AS crm_rsp, b.rate_per_gbps AS b_rate, c.rate_per_gbps AS c_rate
  FROM billing b FULL OUTER JOIN crm c ON b.order_id = c.order_id)"""


# --- capital projects ---------------------------------------------------------------------


def net_price() -> Column:
    return F.col("l_extendedprice") * (1 - F.col("l_discount"))


def project_sums(t: Tables, *keys: Column | str) -> DataFrame:
    return t.lineitem.groupBy(*keys).agg(
        F.sum(money(net_price())).alias("actual"),
        F.sum(F.when(F.col("l_linestatus") == "F", money("l_extendedprice")).otherwise(money(F.lit(0)))).alias("earned"),
        F.sum(money("l_quantity")).alias("committed"),
        F.sum(F.when(F.col("l_returnflag") != "N", money("l_extendedprice")).otherwise(money(F.lit(0)))).alias("planned"),
        F.max("l_shipdate").alias("loaded_at"),
    )


def projects(t: Tables) -> DataFrame:
    """Numbers arrive as text, and one brand's budget is not a number."""
    sums = project_sums(t, F.col("l_partkey").alias("p_partkey"))
    return t.part.join(sums, "p_partkey", "left").select(
        F.col("p_partkey").alias("project_id"),
        F.col("p_name").alias("project_name"),
        F.col("p_type").alias("category"),
        F.when(F.col("p_brand") == "Brand#13", "n/a").otherwise(money(F.col("p_retailprice") * 1000).cast("string")).alias("approved_budget"),
        *[F.col(a).cast("string").alias(b) for a, b in (("actual", "actual_cost"), ("committed", "committed_cost"),
                                                       ("planned", "planned_value"), ("earned", "earned_value"))],
        F.lit("1999-12-31").cast("date").alias("key_date"),
        F.when(F.col("p_size") > 45, "CLSD").otherwise("REL").alias("status"),
    )


_SUMS = f"""sum({MONEY('l_extendedprice * (1 - l_discount)')}) AS actual,
  sum(CASE WHEN l_linestatus = 'F' THEN {MONEY('l_extendedprice')} ELSE 0 END) AS earned,
  sum({MONEY('l_quantity')}) AS committed,
  sum(CASE WHEN l_returnflag <> 'N' THEN {MONEY('l_extendedprice')} ELSE 0 END) AS planned,
  max(l_shipdate) AS loaded_at"""
EVM = f"""sums AS (SELECT l_partkey, {_SUMS} FROM lineitem GROUP BY 1),
projects AS (
  SELECT p_partkey AS project_id, p_name AS project_name, p_type AS category, p_size,
         CASE WHEN p_brand = 'Brand#13' THEN 0 ELSE {MONEY('p_retailprice * 1000')} END AS budget,
         coalesce(actual, 0) AS actual, coalesce(committed, 0) AS committed, coalesce(planned, 0) AS planned, coalesce(earned, 0) AS earned
  FROM part LEFT JOIN sums ON l_partkey = p_partkey),
evm AS (
  SELECT *, CAST(round(CAST(CAST(budget AS DOUBLE) / NULLIF(cpi, 0) AS DECIMAL(38,12)), 2) AS DOUBLE) AS eac,
         CASE WHEN used > 100 THEN 'CRITICAL' WHEN used > 90 THEN 'WARNING' WHEN used > 75 THEN 'WATCH' ELSE 'ON_TRACK' END AS risk_level
  FROM (SELECT *,
    CAST(round(CAST(CAST(earned AS DOUBLE) / NULLIF(CAST(planned AS DOUBLE), 0) AS DECIMAL(38,12)), 4) AS DOUBLE) AS spi,
    CAST(round(CAST(CAST(earned AS DOUBLE) / NULLIF(CAST(actual AS DOUBLE), 0) AS DECIMAL(38,12)), 4) AS DOUBLE) AS cpi,
    CAST(round(CAST(CAST(actual AS DOUBLE) / NULLIF(CAST(budget AS DOUBLE), 0) * 100 AS DECIMAL(38,12)), 2) AS DOUBLE) AS used
    FROM projects))"""


def capex_weeks(t: Tables) -> DataFrame:
    week_end = F.date_add(F.to_date(F.date_trunc("week", "l_shipdate")), 6)
    sums = project_sums(t, F.col("l_partkey").alias("project_id"), week_end.alias("week_ending_date"))
    return sums.select(
        "project_id",
        "week_ending_date",
        F.col("actual").alias("actual_spend_aud"),
        F.col("earned").alias("earned_value_aud"),
        F.col("planned").alias("planned_value_aud"),
        "loaded_at",
    )


WEEKS = f"""weeks AS (
  SELECT *, CAST(round(CAST(CAST(earned AS DOUBLE) / NULLIF(CAST(actual AS DOUBLE), 0) AS DECIMAL(38,12)), 4) AS DECIMAL(18,4)) AS cpi,
         CAST(round(CAST(CAST(earned AS DOUBLE) / NULLIF(CAST(planned AS DOUBLE), 0) AS DECIMAL(38,12)), 4) AS DECIMAL(18,4)) AS spi
  FROM (SELECT l_partkey AS project_id, CAST(date_trunc('week', l_shipdate) AS DATE) + 6 AS week_ending_date, {_SUMS}
        FROM lineitem GROUP BY 1, 2))"""


# --- ports ------------------------------------------------------------------------------------


def _port_status() -> Column:
    f = F.col("l_returnflag")
    return F.when(f == "A", "ACTIVE").when(f == "R", "RESERVED").otherwise("SPARE").alias("status")


def splitters(t: Tables) -> DataFrame:
    return t.supplier.select(
        F.col("s_suppkey").alias("splitter_id"),
        (F.lit(400) + F.col("s_nationkey") * 25).alias("total_ports"),
        F.col("s_nationkey").alias("state_territory"),
        (F.col("s_acctbal") > 0).alias("active"),
    )


def splitter_ports(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_suppkey").alias("splitter_id"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("port_id"), _port_status()
    )


def cabinets(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("rim_id"),
        F.col("p_size").alias("total_dsl_ports"),
        F.col("p_type").alias("state_territory"),
        (F.col("p_retailprice") > 0).alias("active"),
    )


def cabinet_ports(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_partkey").alias("rim_id"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("port_id"), _port_status()
    )


PORTS = """port AS (SELECT DISTINCT l_suppkey, l_partkey, l_orderkey * 10 + l_linenumber AS id, l_returnflag AS state FROM lineitem),
by_splitter AS (SELECT l_suppkey AS id, state, count(*) AS n FROM (SELECT DISTINCT l_suppkey, id, state FROM port) GROUP BY ALL),
by_cabinet AS (SELECT l_partkey AS id, count(*) AS n FROM (SELECT DISTINCT l_partkey, id FROM port WHERE state = 'A') GROUP BY ALL),
splitters AS (
  SELECT s_suppkey AS splitter_id, 400 + s_nationkey * 25 AS total_ports, s_nationkey AS state_territory,
         coalesce(a.n, 0) AS active_ports, coalesce(r.n, 0) AS reserved_ports
  FROM supplier LEFT JOIN by_splitter a ON a.id = s_suppkey AND a.state = 'A'
  LEFT JOIN by_splitter r ON r.id = s_suppkey AND r.state = 'R' WHERE s_acctbal > 0),
cabinets AS (
  SELECT p_partkey AS rim_id, p_size AS total_dsl_ports, p_type AS state_territory, coalesce(n, 0) AS active_dsl_ports
  FROM part LEFT JOIN by_cabinet ON id = p_partkey),
s_util AS (SELECT *, CAST(round(CAST(CAST(active_ports + reserved_ports AS DOUBLE) / NULLIF(total_ports, 0) * 100 AS DECIMAL(38,12)), 2) AS DOUBLE) AS utilisation_pct FROM splitters),
c_util AS (SELECT *, CAST(round(CAST(CAST(active_dsl_ports AS DOUBLE) / NULLIF(total_dsl_ports, 0) * 100 AS DECIMAL(38,12)), 2) AS DOUBLE) AS utilisation_pct FROM cabinets)"""


# --- receivables --------------------------------------------------------------------------------


def ar_lines(t: Tables) -> DataFrame:
    f = F.col("l_returnflag")
    kind = F.when(F.col("l_discount") == 0, "TAX").when(f == "R", "CVC").when(f == "A", "AVC").otherwise("INSTALL")
    return t.lineitem.select(F.col("l_orderkey").alias("header_id"), kind.alias("line_type"), money("l_extendedprice").alias("amount"))


def ar_headers(t: Tables) -> DataFrame:
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("header_id"),
        F.col("c_nationkey").alias("rsp_id"),
        F.to_date("o_orderdate").alias("gl_date"),
        F.when(F.col("o_orderstatus") == "P", "N").otherwise("Y").alias("complete_flag"),
    )


def deferred_balances(t: Tables) -> DataFrame:
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_nationkey").alias("rsp_id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "CONNECTION_FEE").otherwise("OTHER").alias("revenue_category"),
        money("o_totalprice").alias("deferred_balance"),
        F.trunc("o_orderdate", "month").alias("original_invoice_month"),
    )


BILLING_MONTH = "1999-06-01"
DEFERRED = f"""deferred AS (
  SELECT rsp_id, total_deferred, {MONEY('((CAST(total_deferred * 10000 AS BIGINT) * 2 + 24) // 48) / 10000.0')} AS current_period_recognition
  FROM (SELECT c_nationkey AS rsp_id, sum({MONEY('o_totalprice')}) AS total_deferred
        FROM orders JOIN customer ON c_custkey = o_custkey
        WHERE o_orderpriority = '1-URGENT' AND date_diff('month', o_orderdate, DATE '{BILLING_MONTH}') < 24 GROUP BY 1))"""
JOURNALS = f"""{DEFERRED}, journals AS (
  SELECT DATE '{BILLING_MONTH}' AS journal_date, CASE line_type WHEN 'CVC' THEN '4100' ELSE '4200' END AS account_code, rsp_id,
         0 AS debit, amount AS credit, line_type || ' Revenue ' || '{BILLING_MONTH[:7]}' AS description, 'AR' AS source, line_type
  FROM (SELECT c_nationkey AS rsp_id, {MONEY('l_extendedprice')} AS amount,
               CASE WHEN l_discount = 0 THEN 'TAX' WHEN l_returnflag = 'R' THEN 'CVC' WHEN l_returnflag = 'A' THEN 'AVC' ELSE 'INSTALL' END AS line_type
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
        WHERE o_orderstatus <> 'P' AND date_trunc('month', o_orderdate) = DATE '{BILLING_MONTH}')
  WHERE line_type <> 'TAX'
  UNION ALL
  SELECT DATE '{BILLING_MONTH}', '4300', rsp_id, 0, current_period_recognition,
         'Deferred Connection Fee Amort {BILLING_MONTH[:7]}', 'DEFERRED', 'CONNECTION_FEE' FROM deferred)"""
