"""Joins, windows, reconciliation, rollups: against small brute-force answers."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tidegate.operators import aggregates as agg
from tidegate.operators import joins, keys
from tidegate.operators import reconcile as rec
from tidegate.operators.journals import journal_entries, to_gl_interface


def tuples(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def h(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=n)


def test_dedupe(rows):
    df = rows("k int, ts int, v string", (1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (2, None, "d"), (2, 5, "e"))
    assert tuples(keys.dedupe_latest(df, ["k"], ["ts"]), "k") == [(1, 2, "c"), (2, 5, "e")]
    assert tuples(keys.dedupe_first(df, ["k"], ["ts"]), "k") == [(1, 1, "a"), (2, 5, "e")]


def test_dedupe_prunes_before_the_shuffle(rows):
    plan = keys.dedupe_latest(rows("k int, ts int", (1, 1)), ["k"], ["ts"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_latest_two(rows):
    df = rows("p int, w date, cpi decimal(18,4)", (1, dt.date(2024, 1, 7), 1), (1, dt.date(2024, 1, 14), 3), (1, dt.date(2024, 1, 21), 2), (2, dt.date(2024, 1, 7), None))
    got = tuples(keys.latest_two(df, ["p"], "w", ["cpi"]), "p")
    assert [tuple(map(lambda x: None if x is None else float(x) if not isinstance(x, (int, dt.date)) else x, g)) for g in got] == [
        (1, dt.date(2024, 1, 21), 2.0, 3.0, -1.0),
        (2, dt.date(2024, 1, 7), None, None, None),
    ]


def test_sustained(rows):
    flagged = [("a", n) for n in (1, 2, 3, 7, 8)] + [("b", n) for n in (5, 6, 7, 8)]
    df = rows("poi string, hour timestamp_ntz, f boolean", *[(p, h(n), True) for p, n in flagged], ("a", h(3), True), ("a", h(4), None), ("a", h(9), False))
    assert tuples(keys.sustained(df, "poi", "hour", "f"), "poi") == [("a", h(1), h(3), 3), ("b", h(5), h(8), 4)]


def test_rework_flag_brute_force(rows):
    rnd = random.Random(7)
    data = [(i, rnd.choice(["x", "x", "x", "y", None]), dt.datetime(2024, 1, 1) + dt.timedelta(days=rnd.randrange(900), hours=rnd.choice([0, 12]))) for i in range(200)]
    data.append((999, "x", None))
    df = rows("id int, addr string, at timestamp_ntz", *data)
    out = keys.rework_flag(df, "addr", "at")
    out = keys.rework_flag(out, "addr", "at", direction="any", alias="near")
    span = dt.timedelta(days=30)
    for r in out.collect():
        others = [d for d in data if d[0] != r["id"] and d[1] == r["addr"] and d[1] is not None and d[2] is not None and r["at"] is not None]
        assert r["rework_flag"] == any(r["at"] < d[2] <= r["at"] + span for d in others), r
        assert r["near"] == any(abs(r["at"] - d[2]) <= span for d in others), r


def test_dense_ids(rows):
    df = rows("rsp string", ("c",), ("a",), ("b",), ("a",), (None,))
    want = [("a", 1), ("b", 2), ("c", 3)]
    assert tuples(keys.dense_ids(df, "rsp", "n"), "rsp") == want
    many = rows("rsp string", *[(f"k{n:04d}",) for n in range(500) for _ in range(2)])
    assert tuples(keys.dense_ids(many, "rsp", "n"), "rsp") == [(f"k{n:04d}", n + 1) for n in range(500)]
    assert keys.dense_ids(df.limit(0), "rsp", "n").count() == 0


def test_any_flag(rows):
    parent, child = rows("k int", (1,), (2,), (3,)), rows("k int, hit boolean", (1, False), (1, True), (2, None))
    assert tuples(keys.any_flag(parent, child, "k", "hit"), "k") == [(1, True), (2, False), (3, False)]


def test_lookup_never_multiplies(rows):
    fact = rows("k int", (1,), (2,), (None,))
    dim = rows("k int, v int, name string", (1, 1, "old"), (1, 2, "new"))
    got = joins.lookup(fact, dim, "k", ["name"], {"name": "UNKNOWN"}, order_by=["v"])
    assert sorted(tuples(got), key=str) == sorted([(1, "new"), (2, "UNKNOWN"), (None, "UNKNOWN")], key=str)


def test_contracts(rows):
    d = dt.date
    contracts = rows(
        "poi_id int, effective_from date, effective_to date, contracted_cvc_gbps decimal(18,4)",
        (1, d(2023, 1, 1), None, 10), (1, d(2024, 1, 5), d(2024, 1, 10), 20), (2, d(2025, 1, 1), None, 5), (3, d(2023, 1, 1), None, 0),
    )
    facts = rows("poi_id int, throughput_gbps decimal(18,4), at date", *[(1, 8, d(2024, 1, n)) for n in (4, 5, 9, 10)], (2, 1, d(2024, 1, 4)), (3, 1, d(2024, 1, 4)))
    by_row = joins.asof_contract_by_row(facts, contracts, "at")
    assert [r["contracted_gbps"] for r in by_row.orderBy("poi_id", "at").collect()] == [10, 20, 20, 10, None, 0]
    used = joins.cvc_utilisation(facts.filter("at = '2024-01-04'"), contracts, "2024-01-04").orderBy("poi_id").collect()
    assert [(r["utilisation_pct"] and float(r["utilisation_pct"]), r["congestion_flag"]) for r in used] == [(80.0, False), (None, False), (None, False)]


def test_reconcile_kinds(rows):
    schema = "order_id string, rsp_id string, product_code string, rate decimal(18,4), v int"
    left = rows(schema, ("g", "r", "p", 1, 1), ("ok", "r", "p", 1, 1), ("m", "r", "p", 1, 1), ("n", None, "p", 1, 1), ("n1", None, "p", 1, 1),
                ("t", "r", "p", 1, 1), ("e", "r", "p", 1, 1), ("z", "r", "p", None, 1), ("d", "old", "p", 1, 1), ("d", "r", "p", 1, 2), (None, "r", "p", 1, 1))
    right = rows("order_id string, rsp_id string, product_code string, rate double, v int",
                 ("o", "r", "p", 1.0, 1), ("ok", "r", "p", 1.0, 1), ("m", "s", "p", 9.0, 1), ("n", None, "p", 1.0, 1), ("n1", "r", "p", 1.0, 1),
                 ("t", "r", "p", 1.01, 1), ("e", "r", "p", 1.0101, 1), ("z", "r", "p", 0.02, 1), ("d", "r", "p", 1.0, 1), (None, "r", "p", 1.0, 1))
    right = right.withColumn("rate", F.col("rate").cast("decimal(18,4)"))
    out = rec.reconcile(left, right, "order_id", ["rsp_id", "product_code"], "rate", ["v"])
    got = sorted((r["order_id"] or "~", r["discrepancy_type"]) for r in out.collect())
    assert got == [("e", "RATE_ERR"), ("g", "GHOST"), ("m", "MISMATCH"), ("n1", "MISMATCH"), ("o", "ORPHAN"), ("z", "RATE_ERR"), ("~", "GHOST"), ("~", "ORPHAN")]
    assert rec.duplicate_keys(left, "order_id").first()[0] == 1
    assert tuple(rec.exceeds(out, 8).first()) == (8, True)
    assert tuple(rec.exceeds(out, 9).first()) == (8, False)


def test_port_utilisation(rows):
    parents = rows("id int, total int, active boolean", (1, 4, True), (2, 4, True), (3, 0, True), (4, 4, False))
    ports = rows("id int, port_id int, status string", (1, 1, "ACTIVE"), (1, 1, "ACTIVE"), (1, 2, "RESERVED"), (1, 3, "SPARE"), (3, 9, "ACTIVE"), (4, 1, "ACTIVE"))
    got = [(r["id"], r["active_ports"], r["reserved_ports"], r["utilisation_pct"] and float(r["utilisation_pct"]), r["flag"])
           for r in agg.port_utilisation(parents, ports, "id", "total").orderBy("id").collect()]
    assert [g[:3] for g in got] == [(1, 1, 1), (2, 0, 0), (3, 1, 0)]
    assert [g[4] for g in got] == ["OK", "COLD", "OK"]


def test_exact_percentile(rows):
    df = rows("g int, v int", *[(1, n) for n in range(1, 101)], (2, 5), (2, None))
    got = {r["g"]: float(r["p"]) for r in agg.exact_percentile(df, ["g"], "v", 0.95, "p").collect()}
    assert got == {1: 95.05, 2: 5.0}


def test_nps_daily_total_and_null_rsp(rows):
    df = rows("response_date date, programme_id string, rsp_code string, nps_score int, overall_satisfaction_score decimal(18,4)",
              *[(dt.date(2024, 1, 1), "p", r, s, 10) for r, s in (("a", 9), ("a", 6), (None, 10), (None, None))])
    got = {(r["rsp_code"], r["is_total"]): (r["total_responses"], float(r["nps_score"])) for r in agg.nps_daily(df).collect()}
    assert got == {("a", False): (2, 0.0), (None, False): (1, 100.0), (None, True): (3, 33.33)}


def test_journals_balance(rows):
    ar = rows("rsp_id int, line_type string, amount decimal(18,4)", (1, "CVC", 10), (1, "AVC", 5), (2, "INSTALL", 2), (2, "CONNECTION_FEE", 99))
    deferred = agg.deferred_amortisation(
        rows("rsp_id int, revenue_category string, deferred_balance decimal(18,4), original_invoice_month date",
             (1, "CONNECTION_FEE", 24, dt.date(2023, 1, 1)), (1, "CONNECTION_FEE", 24, dt.date(2022, 2, 1)), (1, "CONNECTION_FEE", 24, dt.date(2022, 1, 1)), (2, "OTHER", 24, dt.date(2023, 1, 1))),
        "2024-01-01",
    )
    assert [(r[0], float(r[2])) for r in deferred.collect()] == [(1, 2.0)]
    j = journal_entries(ar, deferred, "2024-01-01")
    assert sorted((r["account_code"], float(r["credit"])) for r in j.collect()) == [("4100", 10.0), ("4200", 2.0), ("4200", 5.0), ("4300", 2.0)]
    assert float(agg.trial_balance(j, "2024-01-01").first()[0]) == 19.0
    assert agg.trial_balance(journal_entries(ar, deferred, "2024-01-01", balancing=True), "2024-01-01").count() == 0
    gl = to_gl_interface(j, "2024-01-01").first()
    assert (gl["status"], gl["ledger_id"], gl["currency_code"], gl["reference10"][-7:]) == ("NEW", 2001, "AUD", "2024-01")


def test_congestion_grain(rows):
    u = rows("poi_id int, hour_label timestamp_ntz, utilisation_pct double, congestion_flag boolean",
             (1, h(1), 90.0, True), (1, h(2), 95.0, True), (2, h(1), 99.0, True), (2, h(3), 10.0, False), (2, h(4), None, None))
    poi = rows("poi_id int, state_territory string", (1, "N"), (2, "N"))
    assert tuples(agg.congestion_metrics(u, poi, "2024-01-02")) == [("N", 2, 99.0)]
    assert tuples(agg.congestion_metrics(u, poi, "2024-01-02", "poi"), "poi_id") == [("N", 1, 2, 95.0), ("N", 2, 1, 99.0)]


def test_remediation_priority(rows):
    s = rows("splitter_id int, flag string, utilisation_pct double, state_territory string, run_date date", (1, "HOT", 95.0, "a", None), (2, "HOT", 95.01, "a", None), (3, "OK", 50.0, "a", None))
    c = rows("rim_id int, flag string, utilisation_pct double, state_territory string, run_date date", (7, "CRITICAL", 91.0, "b", None), (8, "OK", 1.0, "b", None))
    assert [(r["asset_id"], r["priority"]) for r in agg.remediation_queue(s, c).orderBy("asset_id").collect()] == [(1, "MEDIUM"), (2, "HIGH"), (7, "HIGH")]


def test_stale_and_poor_signal(rows):
    marks = rows("pipeline_id string, watermark_ts timestamp_ntz", ("a", h(0)), ("b", h(20)))
    assert [(r[0], r[2]) for r in agg.stale_pipelines(marks, h(26)).collect()] == [("a", 26)]
    t = rows("station_id string, signal_dbm double, telemetry_ts timestamp_ntz", ("s2", -101.0, h(1)), ("s1", -120.0, h(1)), ("s1", -110.0, h(1)), ("s3", -100.0, h(1)))
    assert tuples(agg.poor_signal(t)) == [(h(1), 2, -120.0)]
    assert sorted(r[1] for r in agg.poor_signal_stations(t).collect()) == ["s1", "s2"]


def test_node_first_attribute_ignores_nulls(rows):
    df = rows("node_id int, node_type string, poi_id string, state_territory string, is_up boolean, interface_errors double, cpu_pct double, mem_pct double, sample_ts timestamp_ntz",
              (1, "OLT", "p", None, True, 0.1, 10.0, None, h(0)), (1, None, "q", None, False, 0.3, 20.0, None, h(0) + dt.timedelta(minutes=5)))
    r = agg.scored_nodes(agg.node_hour(df)).first()
    assert (r["node_type"], r["poi_id"], r["state_territory"], float(r["availability_pct"]), r["sample_count"], r["mem_utilisation_pct"]) == ("OLT", "q", None, 50.0, 2, None)
    assert r["health_score"] == 45 and r["health_status"] == "WARNING"


def test_report_from_one_frame_or_two(rows):
    day = dt.date(2024, 1, 8)
    t = lambda n: dt.datetime(2024, 1, n)
    both = rows(
        "state_territory string, technology_type string, rsp_id int, run_date date, status string, sla_met boolean,"
        " days_to_activate decimal(38,2), opened_at timestamp, resolved_at timestamp, premises_count long, msf_ever boolean",
        ("N", "F", 1, day, "ACTIVE", True, 1, t(2), t(3), 10, False),
        ("N", "F", 1, day, "ACTIVE", None, None, t(3), None, 5000, True),  # no verdict, an open mass failure
        ("N", "F", 2, day, "PENDING", None, None, t(4), t(7), 3000, True),  # counts for the state, not reported
        ("N", "W", 3, day, "ACTIVE", False, 9, None, None, None, None),  # no incident of its own
        ("V", "F", 1, dt.date(2023, 12, 1), "ACTIVE", True, 1, t(2), t(3), 10, False),  # out of the week
        (None, "F", 1, day, "ACTIVE", True, 2, t(2), t(3), 9000, True),
    )
    congestion = rows("state_territory string, congested_hours long, peak_utilisation_pct double", ("N", 4, 91.5))
    got = agg.regulatory_metrics(both, congestion, "2024-01-08")
    keep = ["state_territory", "rsp_id", "total_activations", "sla_met_count", "total_faults", "resolved_2bd", "msf_event_count",
            "total_affected_premises", "congested_hours"]
    assert tuples(got.select(keep), "rsp_id", F.col("state_territory").desc()) == [
        ("N", 1, 2, 1, 1, 1, 2, 8000, 4),
        (None, 1, 1, 1, 1, 1, None, None, None),
        ("N", 3, 1, 0, None, None, 2, 8000, 4),
    ]
    apart = agg.regulatory_metrics(agg.report_facts(both, both), congestion, "2024-01-08")
    assert sorted(map(str, apart.collect())) == sorted(map(str, got.collect()))
