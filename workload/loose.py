"""Documents with undeclared fields, pages that failed, and operators that had no query of their own."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.operators.aggregates import month_totals
from tidegate.operators.reconcile import duplicate_keys
from tidegate.sources import files, landed, loose
from workload import views as v
from workload.registry import D, MONEY, Tables, query

BROKEN = "event_type = 'view' AND value < 5"
FIELDS = {
    "event_id": ("id", "bigint"),
    "amount": ("amount", "double"),
    "team": ("assignment.team", "string"),
    "ended_at": ("ended_at", "timestamp_ntz"),
}
LATE = {"code": ("failure.code", "string"), "step": ("failure.trace.step", "bigint")}


def documents_raw(t: Tables) -> DataFrame:
    """One text per event; its members depend on the event's type, and some texts are cut off."""
    kind, k = F.col("event_type"), v.k()

    def only(of: str, value):
        return F.when(kind == of, value)

    body = F.to_json(
        F.struct(
            F.col("event_id").alias("id"),
            F.when(kind != "signup", F.col("value")).alias("amount"),
            only("purchase", F.struct(F.col("event_type").alias("team"), F.array(k, k).alias("crew"))).alias("assignment"),
            only("error", F.struct(F.concat(F.lit("E"), k.cast("string")).alias("code"), F.struct(k.alias("step")).alias("trace"))).alias("failure"),
            only("click", k > 50).alias("late"),
        )
    )
    # A sign-up says its amount as text, or as null.
    amount = F.when(k < 50, '"amount":"none"').otherwise('"amount":null')
    body = F.when(kind == "signup", F.concat(F.substring(body, F.lit(1), F.length(body) - 1), F.lit(","), amount, F.lit("}"))).otherwise(body)
    cut = F.substring(body, F.lit(1), F.length(body) - 2)
    return t.events.select("event_id", F.when(F.expr(BROKEN), cut).otherwise(body).alias("body"))


def parsed(t: Tables) -> DataFrame:
    good, _ = loose.read_loose(documents_raw(t), "body")
    return good


def text_of(rest: str = "rest"):
    """The map as one text in the order of its paths."""
    return F.array_join(F.array_sort(F.transform(F.map_entries(rest), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ";")


def members(*pairs: tuple[str, str, str]) -> str:
    """SQL of that text: (condition, path, JSON text), in the order of the paths."""
    return "concat_ws(';', " + ", ".join(f"CASE WHEN {c} THEN '{p}=' || {x} END" for c, p, x in pairs) + ")"


OK = f"NOT ({BROKEN})"
MISFIT = (f"event_type = 'signup' AND {v.K} < 50", "amount", "'\"none\"'")
CREW = ("event_type = 'purchase'", "assignment.crew", f"'[' || {v.K} || ',' || {v.K} || ']'")
CODE = ("event_type = 'error'", "failure.code", f"'\"E' || {v.K} || '\"'")
STEP = ("event_type = 'error'", "failure.trace.step", f"CAST({v.K} AS VARCHAR)")
LATE_CLICK = ("event_type = 'click'", "late", f"CAST({v.K} > 50 AS VARCHAR)")
DECLARED_SQL = f"""event_id, CASE WHEN event_type <> 'signup' THEN {D('value')} END AS amount,
  CASE WHEN event_type = 'purchase' THEN event_type END AS team, CAST(NULL AS TIMESTAMP) AS ended_at"""


@query("loose_rows", f"SELECT {DECLARED_SQL}, {members(MISFIT, CREW, CODE, STEP, LATE_CLICK)} AS rest FROM events WHERE {OK}")
def loose_rows(t: Tables) -> DataFrame:
    return loose.flatten_loose(parsed(t), FIELDS).withColumn("rest", text_of())


@query(
    "loose_promoted",
    f"""SELECT {DECLARED_SQL}, CASE WHEN event_type = 'error' THEN 'E' || {v.K} END AS code,
  CAST(CASE WHEN event_type = 'error' THEN {v.K} END AS BIGINT) AS step, {members(MISFIT, CREW, LATE_CLICK)} AS rest FROM events WHERE {OK}""",
)
def loose_promoted(t: Tables) -> DataFrame:
    """Rows landed before the failure's fields were declared get their columns from what was kept."""
    path = t.scratch("loose")
    loose.flatten_loose(parsed(t), FIELDS).write.parquet(path)
    return loose.promote(t.spark.read.parquet(path), LATE).withColumn("rest", text_of())


@query("loose_dead_letters", f"SELECT event_id FROM events WHERE {BROKEN}")
def loose_dead_letters(t: Tables) -> DataFrame:
    _, dead = loose.read_loose(documents_raw(t), "body", ["event_id"])
    return dead.select("event_id")


def counted(*rows: tuple[str, str, str]) -> str:
    """SQL of (path, second column, condition): rows of a path and how many documents meet the condition."""
    return " UNION ALL ".join(f"SELECT '{p}' AS path, {x} AS mark, count(*) FILTER (WHERE {c}) AS n FROM ok" for p, x, c in rows)


@query(
    "field_profile",
    f"WITH ok AS (SELECT * FROM events WHERE {OK}) SELECT path, mark AS kind, n FROM ("
    + counted(
        ("id", "'number'", "true"),
        ("amount", "'number'", "event_type <> 'signup'"),
        ("amount", "'text'", f"event_type = 'signup' AND {v.K} < 50"),
        ("amount", "'null'", f"event_type = 'signup' AND {v.K} >= 50"),
        ("assignment.team", "'text'", "event_type = 'purchase'"),
        ("assignment.crew", "'array'", "event_type = 'purchase'"),
        ("failure.code", "'text'", "event_type = 'error'"),
        ("failure.trace.step", "'number'", "event_type = 'error'"),
        ("late", "'boolean'", "event_type = 'click'"),
    )
    + ") WHERE n > 0",
)
def field_profile(t: Tables) -> DataFrame:
    return loose.profile_fields(parsed(t))


@query(
    "field_drift",
    f"""WITH ok AS (SELECT * FROM events WHERE {OK}),
bad AS (SELECT count(*) AS n_bad FROM ok WHERE event_type = 'signup' AND {v.K} < 50),
found AS ({counted(
        ("id", "'bigint'", "true"),
        ("amount", "'double'", "true"),
        ("assignment.team", "'string'", "event_type = 'purchase'"),
        ("ended_at", "'timestamp_ntz'", "false"),
        ("assignment.crew", "NULL", "event_type = 'purchase'"),
        ("failure.code", "NULL", "event_type = 'error'"),
        ("failure.trace.step", "NULL", "event_type = 'error'"),
        ("late", "NULL", "event_type = 'click'"),
    )})
SELECT path, mark AS declared, n AS n_docs, CASE WHEN path = 'amount' THEN n_bad ELSE 0 END AS n_misfit,
  CASE WHEN mark IS NULL THEN 'new' WHEN n = 0 THEN 'missing' WHEN path = 'amount' AND n_bad > 0 THEN 'misfit' ELSE 'as declared' END AS status
FROM found, bad WHERE mark IS NOT NULL OR n > 0""",
)
def field_drift(t: Tables) -> DataFrame:
    return loose.field_drift(parsed(t), FIELDS)


# --- operators without a query so far ------------------------------------------------


@query("failed_pages", f"SELECT user_id, count(*) AS failed, max(event_id) AS last_failed FROM events WHERE event_type = 'error' GROUP BY user_id")
def failed_pages(t: Tables) -> DataFrame:
    """Pages answer with data or with an ``errors`` member; the failed ones by caller."""
    errors = F.to_json(F.struct(F.array(F.struct(F.col("props").alias("message"))).alias("errors")))
    data = F.to_json(F.struct(F.struct("event_id").alias("data")))
    pages = t.events.select("event_id", "user_id", F.when(F.col("event_type") == "error", errors).otherwise(data).alias("body"))
    failed = landed.page_errors(pages, "body").filter(F.col("errors").isNotNull())
    return failed.groupBy("user_id").agg(F.count("*").alias("failed"), F.max("event_id").alias("last_failed"))


@query("duplicate_keys", "SELECT count(*) - count(DISTINCT l_orderkey) AS extra_rows FROM lineitem")
def duplicate_keys_query(t: Tables) -> DataFrame:
    return duplicate_keys(t.lineitem, "l_orderkey")


@query("month_totals", f"SELECT strftime(l_shipdate, '%Y-%m') AS period_name, {D('sum(' + MONEY('l_extendedprice') + ')')} AS total FROM lineitem GROUP BY 1")
def month_totals_query(t: Tables) -> DataFrame:
    return month_totals(t.lineitem.select("l_shipdate", v.money("l_extendedprice").alias("amount")), "l_shipdate", "amount")


HOUR = dt.datetime(2024, 1, 10, 9)


@query(
    "previous_hour",
    f"SELECT event_id, user_id, {D('value')} AS value FROM events WHERE ts >= TIMESTAMP '2024-01-10 08:00:00' AND ts < TIMESTAMP '2024-01-10 09:00:00'",
)
def previous_hour(t: Tables) -> DataFrame:
    """Events landed under a folder per hour; only the folder of the hour before the run is read."""
    base = t.scratch("hours")
    hours = t.events.select("event_id", "user_id", "value", F.date_format("ts", "yyyy-MM-dd-HH").alias("hour"))
    hours.repartition("hour").write.partitionBy("hour").parquet(base)
    folder = f"{base}/{files.hour_prefix(HOUR + dt.timedelta(minutes=20), 'hour=%Y-%m-%d-%H')}"
    return t.spark.read.schema("event_id long, user_id long, value double").parquet(folder)
