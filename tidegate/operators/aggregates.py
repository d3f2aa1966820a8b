"""Domain rollups. Every one is algebraic, so Spark combines on the map side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.functions.numbers import MONEY, number_or_zero, percent, ratio, round_dec, share_of
from tidegate.functions.rules import (
    URGENT_PCT,
    budget_risk,
    cabinet_flag,
    health_score,
    health_status,
    nps_score,
    refresh_risk,
    splitter_flag,
)
from tidegate.functions.times import as_date, as_timestamp, boundary_diff, elapsed_hours, floor_hour, in_month, month_label, trailing_week



def count_when(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def mean(c: Column | str, places: int) -> Column:
    """Mean of an exact sum, so partial aggregation order cannot change it."""
    return round_dec(ratio(F.sum(c), F.count(c)), places)


# --- billing -----------------------------------------------------------------


def billing_monthly(lines: DataFrame) -> DataFrame:
    return lines.groupBy("rsp_id", F.trunc("billing_date", "month").alias("billing_month")).agg(
        F.sum("charge_amount_aud").alias("total_charge_aud"),
        F.sum("cvc_mb_allocated").alias("total_cvc_mb_allocated"),
        F.sum("cvc_mb_used").alias("total_cvc_mb_used"),
        F.count("*").alias("line_count"),
        F.max("loaded_at").alias("last_loaded_at"),
    )


# --- node health -------------------------------------------------------------


def node_hour(samples: DataFrame, ts: str = "sample_ts", by_hour: bool = True) -> DataFrame:
    """One row per node (and hour): latest attributes, means, sample count."""
    keys = ["node_id"]
    if by_hour:
        samples = samples.withColumn("hour_label", floor_hour(ts))
        keys.append("hour_label")

    def latest(c: str) -> Column:
        # Ignoring nulls: a sample without the attribute must not win. The value
        # itself breaks ties between samples taken at the same moment.
        return F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(F.col(ts), F.col(c)))).alias(c)

    return samples.groupBy(*keys).agg(
        latest("node_type"),
        latest("poi_id"),
        latest("state_territory"),
        percent(count_when(F.col("is_up")), F.count("is_up"), 4).alias("availability_pct"),
        *[
            mean(F.col(c).cast(MONEY), 4).alias(a)
            for c, a in (
                ("interface_errors", "error_rate_pct"),
                ("cpu_pct", "cpu_utilisation_pct"),
                ("mem_pct", "mem_utilisation_pct"),
            )
        ],
        F.count("*").alias("sample_count"),
    )


def scored_nodes(nodes: DataFrame) -> DataFrame:
    score = health_score("availability_pct", "error_rate_pct", "cpu_utilisation_pct", "mem_utilisation_pct")
    return nodes.withColumn("health_score", score).withColumn("health_status", health_status("health_score"))


def node_alerts(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("health_status") != "HEALTHY").select(
        "node_id", "hour_label", "health_status", "health_score", "node_type", "poi_id"
    )


# --- ports -------------------------------------------------------------------


def port_utilisation(
    parents: DataFrame,
    ports: DataFrame,
    key: str,
    total: str,
    statuses: Sequence[str] = ("ACTIVE", "RESERVED"),
    flag: str = "splitter",
    run_date=None,
) -> DataFrame:
    """Distinct ports per status for every active parent, then utilisation.

    Ports are made distinct first and counted per parent before the join, so
    the parent table is matched against one row per parent.
    """
    seen = ports.filter(F.col("status").isin(*statuses)).select(key, "port_id", "status").distinct()
    counted = seen.groupBy(key).agg(*[count_when(F.col("status") == s).alias(f"{s.lower()}_ports") for s in statuses])
    names = [f"{s.lower()}_ports" for s in statuses]
    out = parents.filter(F.coalesce(F.col("active"), F.lit(False))).join(counted, key, "left")
    out = out.withColumns({n: F.coalesce(F.col(n), F.lit(0).cast("long")) for n in names})
    used = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    out = out.withColumn("utilisation_pct", percent(used, total)).drop("active")
    rule = splitter_flag if flag == "splitter" else cabinet_flag
    out = out.withColumn("flag", rule("utilisation_pct"))
    return out if run_date is None else out.withColumn("run_date", as_date(run_date))


def remediation_queue(splitters: DataFrame, cabinets: DataFrame) -> DataFrame:
    urgent = F.when(F.col("utilisation_pct") > URGENT_PCT, "HIGH").otherwise("MEDIUM")

    def rows(df: DataFrame, key: str, kind: str, flag: str, priority: Column) -> DataFrame:
        return df.filter(F.col("flag") == flag).select(
            F.col(key).alias("asset_id"),
            F.lit(kind).alias("asset_type"),
            "flag",
            "utilisation_pct",
            F.col("state_territory").alias("state"),
            "run_date",
            priority.alias("priority"),
        )

    hot = rows(splitters, "splitter_id", "PON_SPLITTER", "HOT", urgent)
    return hot.unionByName(rows(cabinets, "rim_id", "RIM_CABINET", "CRITICAL", F.lit("HIGH")))


def flag_summary(df: DataFrame, flag: str) -> DataFrame:
    return df.groupBy(flag).agg(F.count("*").alias("items"))


def flagged(df: DataFrame, flag: str, values: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """The flagged entities themselves, as rows rather than one collected list."""
    return df.filter(F.col(flag).isin(*values)).select(*cols, flag)


# --- regulatory report -------------------------------------------------------


def activation_metrics(activations: DataFrame, run_date, week_col: str = "run_date") -> DataFrame:
    scope = activations.filter(trailing_week(week_col, run_date) & (F.col("status") == "ACTIVE"))
    return scope.groupBy("state_territory", "technology_type", "rsp_id").agg(
        F.count("*").alias("total_activations"),
        count_when(F.col("sla_met")).alias("sla_met_count"),
        mean("days_to_activate", 2).alias("avg_days_to_activate"),
        percent(count_when(F.col("sla_met")), F.count("*")).alias("sla_compliance_pct"),
    )


def fault_metrics(incidents: DataFrame, run_date) -> DataFrame:
    days = boundary_diff("day", "opened_at", "resolved_at")
    return (
        incidents.filter(trailing_week("resolved_at", run_date))
        .groupBy("state_territory", "technology_type", "rsp_id")
        .agg(
            F.count("*").alias("total_faults"),
            *[count_when(days <= n).alias(f"resolved_{n}bd") for n in (2, 5, 20)],
        )
    )


def msf_metrics(incidents: DataFrame, run_date, flag: str = "msf_ever") -> DataFrame:
    minutes = boundary_diff("minute", "opened_at", "resolved_at")
    return (
        incidents.filter(F.coalesce(F.col(flag), F.lit(False)) & trailing_week("opened_at", run_date))
        .groupBy("state_territory")
        .agg(
            F.count("*").alias("msf_event_count"),
            F.sum("premises_count").alias("total_affected_premises"),
            mean(minutes, 4).alias("avg_resolution_mins"),
        )
    )


def congestion_metrics(utilisation: DataFrame, poi: DataFrame, run_date, grain: str = "state") -> DataFrame:
    keys = ["state_territory"] if grain == "state" else ["state_territory", "poi_id"]
    return (
        utilisation.filter(F.coalesce(F.col("congestion_flag"), F.lit(False)) & trailing_week("hour_label", run_date))
        .join(poi.select("poi_id", "state_territory"), "poi_id")
        .groupBy(*keys)
        .agg(
            F.count_distinct("hour_label").alias("congested_hours"),
            F.max("utilisation_pct").alias("peak_utilisation_pct"),
        )
    )


# The columns of the published report.
REPORT_COLUMNS = (
    "report_date",
    "state_territory",
    "technology_type",
    "rsp_id",
    "total_activations",
    "sla_met_count",
    "sla_compliance_pct",
    "avg_days_to_activate",
    "total_faults",
    "resolved_2bd",
    "resolved_5bd",
    "resolved_20bd",
    "msf_event_count",
    "total_affected_premises",
    "congested_hours",
    "peak_utilisation_pct",
)


# What the report asks of an activation and of an incident, beside state, technology and RSP.
ACTIVATION_FACTS = ("run_date", "status", "sla_met", "days_to_activate")
INCIDENT_FACTS = ("opened_at", "resolved_at", "premises_count", "msf_ever")
REPORT_KEYS = ("state_territory", "technology_type", "rsp_id")


def report_facts(activations: DataFrame, incidents: DataFrame) -> DataFrame:
    """Two sources as rows of one frame, each with the other's columns null."""
    a, i = activations.select(*REPORT_KEYS, *ACTIVATION_FACTS), incidents.select(*REPORT_KEYS, *INCIDENT_FACTS)
    return a.unionByName(i, allowMissingColumns=True)


def report_rollup(facts: DataFrame, run_date) -> DataFrame:
    """Activations, faults and mass failures of the week per state, technology and RSP, in one aggregation.

    A row of ``facts`` may be an activation, an incident, or both where one record
    serves as both; it then is read once.
    """
    days = boundary_diff("day", "opened_at", "resolved_at")
    active = F.coalesce(trailing_week("run_date", run_date) & (F.col("status") == "ACTIVE"), F.lit(False))
    fault = F.coalesce(trailing_week("resolved_at", run_date), F.lit(False))
    mass = F.coalesce(F.col("msf_ever") & trailing_week("opened_at", run_date), F.lit(False))
    met = active & F.col("sla_met")
    return (
        facts.filter(active | fault | mass)
        .groupBy(*REPORT_KEYS)
        .agg(
            count_when(active).alias("total_activations"),
            count_when(met).alias("sla_met_count"),
            percent(count_when(met), count_when(active)).alias("sla_compliance_pct"),
            mean(F.when(active, F.col("days_to_activate")), 2).alias("avg_days_to_activate"),
            count_when(fault).alias("total_faults"),
            *[count_when(fault & (days <= n)).alias(f"resolved_{n}bd") for n in (2, 5, 20)],
            count_when(mass).alias("_events"),
            F.sum(F.when(mass, F.col("premises_count"))).alias("_premises"),
        )
    )


def regulatory_metrics(facts: DataFrame, congestion: DataFrame, run_date) -> DataFrame:
    """The report: groups with activations, their faults, and the state's mass failures and congestion.

    ``facts`` holds activations and incidents (``report_facts``, or records that are
    both); ``congestion`` is rolled up already. Mass failures of a state also count
    where a group has faults or failures but no activation, so groups without
    activations leave only after the state's sum is taken.
    """
    state = Window.partitionBy("state_territory")
    any_mass = F.col("state_territory").isNotNull() & (F.sum("_events").over(state) > 0)
    any_fault = F.col("total_faults") > 0
    return (
        report_rollup(facts, run_date)
        .withColumn("msf_event_count", F.when(any_mass, F.sum("_events").over(state)))
        .withColumn("total_affected_premises", F.when(any_mass, F.sum("_premises").over(state)))
        .filter("total_activations > 0")
        .withColumns({c: F.when(any_fault, F.col(c)) for c in ("resolved_2bd", "resolved_5bd", "resolved_20bd")})
        .withColumn("total_faults", F.when(any_fault, F.col("total_faults")))
        .join(congestion, "state_territory", "left")
        .withColumn("report_date", as_date(run_date))
        .select(*REPORT_COLUMNS)
    )


# --- finance -----------------------------------------------------------------


def deferred_amortisation(balances: DataFrame, month, months: int = 24) -> DataFrame:
    age = boundary_diff("month", F.col("original_invoice_month"), as_date(month))
    return (
        balances.filter((F.col("revenue_category") == "CONNECTION_FEE") & (age < months))
        .groupBy("rsp_id")
        .agg(F.sum("deferred_balance").alias("total_deferred"))
        .withColumn("current_period_recognition", share_of("total_deferred", months, 4))
    )


def trial_balance(journals: DataFrame, month, tolerance: str = "0.01") -> DataFrame:
    """Empty when the month balances, else one row with the imbalance."""
    return (
        journals.filter(in_month("journal_date", month))
        .agg(F.abs(F.sum("credit") - F.sum("debit")).alias("imbalance"))
        .filter(F.col("imbalance") > F.lit(tolerance).cast(MONEY))
    )


def evm_metrics(projects: DataFrame) -> DataFrame:
    """Earned-value indices; the estimate at completion uses the rounded CPI."""
    money = ["approved_budget", "actual_cost", "committed_cost", "planned_value", "earned_value"]
    df = projects.withColumns({c: number_or_zero(c, MONEY) for c in money if c in projects.columns})
    return (
        df.withColumns(
            {
                "spi": round_dec(ratio("earned_value", "planned_value"), 4),
                "cpi": round_dec(ratio("earned_value", "actual_cost"), 4),
                "budget_utilisation_pct": percent("actual_cost", "approved_budget"),
            }
        )
        .withColumn("eac", round_dec(ratio("approved_budget", "cpi"), 2))
        .withColumn("risk_level", budget_risk("budget_utilisation_pct"))
    )


def capex_indices(weeks: DataFrame) -> DataFrame:
    return weeks.withColumns(
        {
            "cpi": round_dec(ratio("earned_value_aud", "actual_spend_aud"), 4),
            "spi": round_dec(ratio("earned_value_aud", "planned_value_aud"), 4),
        }
    )


# --- surveys -----------------------------------------------------------------


def nps_daily(responses: DataFrame, by: Sequence[str] = ("response_date", "programme_id"), rsp: str = "rsp_code") -> DataFrame:
    """NPS per day, programme and RSP plus an all-RSP row.

    Responses are counted once at the fine grain; the grouping sets then run
    over those counts, so the raw rows are never expanded.
    """
    score = F.col("nps_score")
    fine = responses.filter(score.isNotNull()).groupBy(*by, rsp).agg(
        F.count("*").alias("n"),
        count_when(score >= 9).alias("p"),
        count_when(score.between(7, 8)).alias("q"),
        count_when(score <= 6).alias("d"),
        F.sum("overall_satisfaction_score").alias("s"),
        F.count("overall_satisfaction_score").alias("sn"),
    )
    sets = [[F.col(c) for c in (*by, rsp)], [F.col(c) for c in by]]
    return (
        fine.groupingSets(sets, *by, rsp)
        .agg(
            F.sum("n").alias("total_responses"),
            F.sum("p").alias("promoters"),
            F.sum("q").alias("passives"),
            F.sum("d").alias("detractors"),
            nps_score(F.sum("p"), F.sum("d"), F.sum("n")).alias("nps_score"),
            round_dec(ratio(F.sum("s"), F.sum("sn")), 2).alias("avg_satisfaction"),
            (F.grouping(rsp) == 1).alias("is_total"),
        )
    )


def topic_averages(topics: DataFrame, by: Sequence[str], floor: float = 0.5) -> DataFrame:
    """Low-confidence scores stay in the fact but not in the average."""
    kept = F.when(F.col("confidence_score") >= floor, F.col("sentiment_score").cast(MONEY))
    return topics.groupBy(*by).agg(
        F.count("*").alias("topic_rows"),
        F.count(kept).alias("scored_rows"),
        mean(kept, 4).alias("avg_sentiment"),
    )


# --- percentiles -------------------------------------------------------------


def exact_percentile(df: DataFrame, by: Sequence[str], value: str, p: float, alias: str) -> DataFrame:
    """Exact interpolated percentile per group from a value histogram.

    Counting equal values first means a group contributes one row per distinct
    value, not one per record. ``value`` must lie on a grid (whole minutes, two
    decimals), which bounds the histogram whatever the row count. For other values there
    is ``selection.percentiles_by_rank``.
    """
    histogram = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_n"))
    return histogram.groupBy(*by).agg(round_dec(F.percentile(F.col(value).cast("double"), p, F.col("_n")), 4).alias(alias))


def null_safe_join(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Left join of two aggregates where null group keys must meet."""
    renamed = right.withColumnsRenamed({c: f"_{c}" for c in by})
    cond = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    return left.join(renamed, cond, "left").drop(*[f"_{c}" for c in by])


def sla_breach_summary(incidents: DataFrame) -> DataFrame:
    by = ["report_week", "incident_priority", "incident_category"]
    scope = incidents.filter(F.coalesce(F.col("accc_reportable_flag"), F.lit(False))).select(
        F.to_date(F.date_trunc("week", "opened_at")).alias("report_week"),
        F.col("priority").alias("incident_priority"),
        F.col("category").alias("incident_category"),
        "sla_breached_flag",
        "resolution_minutes",
    )
    # One histogram of minutes gives counts, mean and percentile.
    minutes, n = F.col("resolution_minutes"), F.col("_n")
    histogram = scope.groupBy(*by, "resolution_minutes").agg(
        F.count("*").alias("_n"), count_when(F.col("sla_breached_flag")).alias("_breached")
    )
    known = F.sum(F.when(minutes.isNotNull(), n))
    rate = round_dec((F.lit(1.0) - ratio("sla_breached_count", "total_incidents")) * 100, 2)
    return (
        histogram.groupBy(*by)
        .agg(
            F.sum("_n").alias("total_incidents"),
            F.sum("_breached").alias("sla_breached_count"),
            round_dec(ratio(F.sum(minutes * n), known), 4).alias("avg_resolution_minutes"),
            round_dec(F.percentile(minutes.cast("double"), 0.95, n), 4).alias("p95_resolution_minutes"),
        )
        .withColumn("sla_compliance_rate_pct", rate)
        .select(*by, "total_incidents", "sla_breached_count", "avg_resolution_minutes", "sla_compliance_rate_pct", "p95_resolution_minutes")
    )


def technician_performance(orders: DataFrame, by: Sequence[str] = ("run_date", "assigned_team", "location_fsa")) -> DataFrame:
    done = F.col("closure_code") == "Resolved"
    open_ended = F.col("closure_code").isin("Escalated", "No Access", "Parts Required")
    return orders.groupBy(*by).agg(
        count_when(done).alias("completed_orders"),
        count_when(open_ended).alias("incomplete_orders"),
        mean("time_on_site_minutes", 2).alias("avg_time_on_site_minutes"),
        percent(count_when(F.col("rework_flag")), count_when(done)).alias("rework_rate_pct"),
    )


# --- cases and assets --------------------------------------------------------


def first_response_hours(cases: DataFrame, comments: DataFrame, key: str = "sf_case_id") -> DataFrame:
    first = comments.filter(F.coalesce(F.col("is_internal"), F.lit(False))).groupBy(key).agg(F.min("comment_ts").alias("_first"))
    return cases.join(first, key, "left").withColumn(
        "first_response_hours", elapsed_hours("created_date", "_first")
    ).drop("_first")


def asset_health(assets: DataFrame, performance: DataFrame, orders: DataFrame, run_date, weights=(25, 25, 25, 25)) -> DataFrame:
    """Each side is reduced to one row per key before it meets the assets."""
    d = as_date(run_date)
    recent = performance.filter(F.col("report_date").between(F.date_sub(d, 30), d))
    # Both measures as rows of one table, so that the facts are read once.
    measures = {"utilisation_p95_30d": "utilisation_pct", "latency_p95_30d": "latency_ms"}
    rows = F.explode(F.array(*[F.struct(F.lit(a).alias("measure"), F.col(c).cast("double").alias("value")) for a, c in measures.items()]))
    tall = recent.select("poi_id", rows.alias("m")).select("poi_id", "m.measure", "m.value")
    p95 = exact_percentile(tall, ["poi_id", "measure"], "value", 0.95, "p95").groupBy("poi_id").agg(
        *[F.max(F.when(F.col("measure") == a, F.col("p95"))).alias(a) for a in measures]
    )
    work = orders.groupBy("equipment_id").agg(
        count_when((F.col("order_type") == "PM01") & F.col("actual_finish").between(F.date_sub(d, 90), d)).alias("fault_count_90d"),
        F.max(F.when(F.col("order_type") == "PM02", F.col("actual_finish"))).alias("last_preventive_maintenance"),
    )
    return (
        assets.join(p95, "poi_id", "left")
        .join(work, "equipment_id", "left")
        .withColumn("fault_count_90d", F.coalesce(F.col("fault_count_90d"), F.lit(0).cast("long")))
        .withColumn(
            "refresh_risk_score",
            refresh_risk(
                "asset_age_years", "utilisation_p95_30d", "fault_count_90d", F.col("warranty_expiry_date") < d, weights
            ),
        )
    )


# --- operations --------------------------------------------------------------


def poor_signal_stations(telemetry: DataFrame, threshold: float = -100) -> DataFrame:
    """Per hour and station under the threshold: the worst reading."""
    return (
        telemetry.filter(F.col("signal_dbm") < threshold)
        .groupBy(floor_hour("telemetry_ts").alias("telemetry_hour"), "station_id")
        .agg(F.min("signal_dbm").alias("worst_signal_dbm"))
    )


def poor_signal(telemetry: DataFrame, threshold: float = -100) -> DataFrame:
    """Per hour: number of stations under the threshold and the worst reading. The stations are rows of their own table."""
    return poor_signal_stations(telemetry, threshold).groupBy("telemetry_hour").agg(
        F.count("*").alias("poor_signal_count"), F.min("worst_signal_dbm").alias("worst_signal_dbm")
    )


def sla_rate(activations: DataFrame) -> DataFrame:
    met = F.col("sla_met")
    return activations.agg(F.count(met).alias("rated"), ratio(count_when(met), F.count(met)).alias("sla_rate"))


def status_distribution(df: DataFrame, status: str = "status") -> DataFrame:
    return df.groupBy(status).agg(F.count("*").alias("rows"))


def stale_pipelines(watermarks: DataFrame, now, hours: int = 25) -> DataFrame:
    age = boundary_diff("hour", F.col("watermark_ts"), as_timestamp(now))
    stale = watermarks.withColumn("hours_since_run", age).filter(F.col("hours_since_run") > hours)
    return stale.orderBy(F.desc("hours_since_run"), "watermark_ts")  # the worst first


# --- marts -------------------------------------------------------------------


def rsp_kpi_daily(activations: DataFrame) -> DataFrame:
    active = F.col("status") == "ACTIVE"
    return activations.groupBy("run_date", "rsp_id").agg(
        F.count("*").alias("orders"),
        count_when(active).alias("activated"),
        count_when(F.col("sla_met")).alias("sla_met_count"),
        percent(count_when(F.col("sla_met")), count_when(active)).alias("sla_compliance_pct"),
        mean(F.when(active, F.col("days_to_activate")), 2).alias("avg_days_to_activate"),
    )


def nps_scorecard(responses: DataFrame) -> DataFrame:
    """Weekly NPS per region and RSP."""
    s = F.col("score")
    return responses.groupBy("week_start", "state_territory", "rsp_id").agg(
        F.count("*").alias("responses"),
        nps_score(count_when(s >= 9), count_when(s <= 6), F.count(s)).alias("nps_score"),
        count_when(F.col("sentiment") == "negative").alias("negative_comments"),
    )


def capex_summary(projects: DataFrame) -> DataFrame:
    return projects.groupBy("category", "run_date").agg(
        F.count("*").alias("projects"),
        F.sum("approved_budget").alias("approved_budget"),
        F.sum("actual_cost").alias("actual_cost"),
        F.sum("earned_value").alias("earned_value"),
        count_when(F.col("risk_level") == "CRITICAL").alias("critical_projects"),
        percent(F.sum("actual_cost"), F.sum("approved_budget")).alias("budget_utilisation_pct"),
    )


def month_totals(df: DataFrame, date_col: str, amount: str) -> DataFrame:
    return df.groupBy(month_label(date_col).alias("period_name")).agg(F.sum(amount).alias("total"))
