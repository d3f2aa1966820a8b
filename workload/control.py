"""Upserts, replacements, gates, watermarks and streams."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.times import in_window
from tidegate.operators import incremental as inc
from tidegate.operators import bitmaps, keys, merge
from tidegate.operators.aggregates import nps_daily, topic_averages
from tidegate.operators.joins import orphans, with_manager
from tidegate.operators.quality import Gate
from tidegate.plans.experience import topic_scores
from tidegate.sinks import tables, versions
from tidegate.streaming import correlate, jobs
from workload import core, landing
from workload import views as v
from workload.registry import D, MONEY, R, Tables, query

# --- upserts -----------------------------------------------------------------------

LINE_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
NEWEST = ", ".join(f"{c} DESC" for c in ["l_shipdate", *LINE_REST])
OLDEST = ", ".join(["l_shipdate", *LINE_REST])


@query(
    "upsert_lineitem_dedup",
    f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {NEWEST}) AS newest,
  row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {OLDEST}) AS oldest FROM lineitem)
SELECT o.l_orderkey, o.l_linenumber, o.l_partkey, o.l_suppkey, n.l_quantity, n.l_extendedprice, o.l_shipdate
FROM r o JOIN r n ON n.l_orderkey = o.l_orderkey AND n.l_linenumber = o.l_linenumber AND n.newest = 1 WHERE o.oldest = 1""",
)
def upsert_lineitem_dedup(t: Tables) -> DataFrame:
    """The first delivery of each line is the target, the last one updates two columns."""
    k = ["l_orderkey", "l_linenumber"]
    target = keys.dedupe_first(t.lineitem, k, ["l_shipdate"])
    out = merge.upsert(target, t.lineitem.distinct(), k, order_by=["l_shipdate"], update_cols=["l_quantity", "l_extendedprice"])
    return out.select(*k, "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")


MOVED = "o_totalprice > 400000 AND o_orderstatus <> 'F'"


@query(
    "merge_partitioned",
    f"""SELECT o_orderkey, o_custkey, CASE WHEN {MOVED} THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
CASE WHEN {MOVED} THEN 0.0 ELSE o_totalprice END AS o_totalprice FROM orders""",
)
def merge_partitioned(t: Tables) -> DataFrame:
    """Expensive orders change status, so the merge moves them between partitions."""
    path = t.scratch("merge")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    tables.overwrite_partitions(rows, path, ["o_orderstatus"])
    moved = rows.filter(MOVED).withColumns({"o_orderstatus": F.lit("F"), "o_totalprice": F.lit(0.0)})
    tables.merge_into(moved, path, ["o_orderkey"], "o_orderstatus", ["o_custkey"])
    return t.spark.read.parquet(path)


def merged_parts(t: Tables, part, moved) -> DataFrame:
    """Orders partitioned by ``part``; dear ones get price 0 and the partition ``moved``, twice."""
    path = t.scratch("merge")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", part.alias("p"))
    tables.overwrite_partitions(rows, path, ["p"])
    batch = rows.filter("o_totalprice > 400000").withColumns({"p": moved, "o_totalprice": F.lit(0.0)})
    for _ in range(2):
        tables.merge_into(batch, path, ["o_orderkey"], "p", ["o_custkey"])
    return tables.read_partitioned(t.spark, path, rows.schema["p"])


DEAR = "o_totalprice > 400000"
MERGED = f"SELECT o_orderkey, o_custkey, CASE WHEN {DEAR} THEN 0.0 ELSE o_totalprice END AS o_totalprice"


@query("merge_null_partition", f"{MERGED}, nullif(o_orderstatus, 'O') AS p FROM orders")
def merge_null_partition(t: Tables) -> DataFrame:
    """Rows without a partition value, touched and untouched, all stay."""
    part = F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus"))
    return merged_parts(t, part, F.col("p"))


@query("merge_text_partition", f"{MERGED}, lpad(CAST(o_custkey % 10 AS VARCHAR), 3, '0') AS p FROM orders")
def merge_text_partition(t: Tables) -> DataFrame:
    """Partition values such as 007 are text and stay text."""
    return merged_parts(t, F.lpad((F.col("o_custkey") % 10).cast("string"), 3, "0"), F.col("p"))


@query(
    "merge_escaped_partition",
    f"""{MERGED}, CASE WHEN {DEAR} THEN 'moved: x=1/2' WHEN o_orderstatus = 'P' THEN 'a:b/c d%' ELSE 'dear? ' || o_orderstatus END AS p
FROM orders""",
)
def merge_escaped_partition(t: Tables) -> DataFrame:
    """Values that paths escape, with keys that move; a partition that moves as a whole leaves no folder."""
    name = F.when(F.col("o_orderstatus") == "P", "a:b/c d%").otherwise(F.concat(F.lit("dear? "), "o_orderstatus"))
    part = F.when((F.col("o_orderstatus") == "O") & (F.col("o_totalprice") > 400000), "goes: away").otherwise(name)
    return merged_parts(t, part, F.lit("moved: x=1/2"))


@query(
    "merge_late_partition",
    f"""SELECT o_orderkey, o_custkey, o_totalprice, CASE WHEN o_orderstatus = 'O' AND NOT ({DEAR}) THEN NULL
WHEN {DEAR} AND o_orderstatus = 'F' THEN NULL ELSE strftime(o_orderdate, '%Y') END AS p FROM orders""",
)
def merge_late_partition(t: Tables) -> DataFrame:
    """Open orders have no year yet. Three reruns add nothing; then the dear ones' year arrives, and dear filled ones lose theirs."""
    path = t.scratch("merge")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", F.date_format("o_orderdate", "yyyy").alias("year"))
    early = rows.withColumn("p", F.when(F.col("o_orderstatus") != "O", F.col("year"))).drop("year", "o_orderstatus")
    for _ in range(3):
        tables.merge_into(early, path, ["o_orderkey"], "p", ["o_custkey"])
    later = rows.filter(DEAR).withColumn("p", F.when(F.col("o_orderstatus") != "F", F.col("year"))).drop("year", "o_orderstatus")
    for _ in range(3):
        tables.merge_into(later, path, ["o_orderkey"], "p", ["o_custkey"])
    return tables.read_partitioned(t.spark, path, early.schema["p"])


@query(
    "merge_time_partition",
    f"{MERGED}, CASE WHEN {DEAR} THEN TIMESTAMP '2030-01-01 10:30:00' ELSE date_trunc('year', o_orderdate) + INTERVAL 90 MINUTE END AS p FROM orders",
)
def merge_time_partition(t: Tables) -> DataFrame:
    part = F.date_trunc("year", "o_orderdate").cast("timestamp_ntz") + F.expr("INTERVAL 90 MINUTE")
    return merged_parts(t, part, F.expr("TIMESTAMP_NTZ'2030-01-01 10:30:00'"))


@query(
    "versioned_refresh",
    """SELECT o_orderpriority, count(*) AS orders, 3 AS refreshes, 2 AS versions, true AS reader_kept_its_version FROM orders GROUP BY 1""",
)
def versioned_refresh(t: Tables) -> DataFrame:
    """A mart refreshed three times under one name; a reader that began before the second step still reads its rows."""
    name, root = f"mart_{uuid.uuid4().hex}", t.scratch("mart")
    rows = t.orders.groupBy("o_orderpriority").agg(F.count("*").alias("orders"))
    first = rows.withColumn("refreshes", F.lit(1))
    versions.refresh(first, name, root, lambda df: Gate(df, "mart").min_rows(1))
    reader = t.spark.table(name)
    want = {tuple(r) for r in reader.collect()}
    versions.refresh(rows.withColumn("refreshes", F.lit(2)), name, root)
    kept = {tuple(r) for r in reader.collect()} == want
    versions.refresh(rows.withColumn("refreshes", F.lit(3)), name, root)
    found = t.spark.read.parquet(versions.location(t.spark, name))
    number = len(versions.versions(t.spark, root))
    t.spark.sql(f"DROP TABLE {name}")
    return found.withColumns({"versions": F.lit(number), "reader_kept_its_version": F.lit(kept)})


@query(
    "merge_bucketed",
    f"""SELECT o_orderkey, o_custkey, CASE WHEN {DEAR} THEN 'dear' ELSE o_orderstatus END AS o_orderstatus,
CASE WHEN {DEAR} THEN 0.0 ELSE o_totalprice END AS o_totalprice FROM orders""",
)
def merge_bucketed(t: Tables) -> DataFrame:
    """A bucketed target takes the dear orders twice and the latest ones, which it does not have yet, once."""
    name, rows = f"orders_{uuid.uuid4().hex}", t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    late = F.col("o_orderdate") >= dt.datetime(2001, 1, 1)
    versions.write_bucketed(rows.filter(~late).drop("o_orderdate"), name, t.scratch("bucketed"), ["o_orderkey"], 8)
    rows = rows.withColumns({"o_totalprice": F.when(F.expr(DEAR), 0.0).otherwise(F.col("o_totalprice")),
                             "o_orderstatus": F.when(F.expr(DEAR), "dear").otherwise(F.col("o_orderstatus"))})
    for batch in (rows.filter("o_orderstatus = 'dear'"), rows.filter("o_orderstatus = 'dear'"), rows.filter(late)):
        path = t.scratch("bucketed")
        versions.merge_bucketed(batch.drop("o_orderdate"), name, path, ["o_orderkey"], 8, ["o_totalprice"])
    t.spark.sql(f"DROP TABLE {name}")
    return t.spark.read.parquet(path)


LO, HI = dt.datetime(2024, 1, 10, 5), dt.datetime(2024, 1, 10, 9)
CUT_LO, CUT_HI = dt.datetime(2024, 1, 11, 5, 30), dt.datetime(2024, 1, 11, 7, 10)


@query(
    "replace_hour_path",
    f"""SELECT event_id, ts, CASE WHEN ts >= TIMESTAMP '{LO}' AND ts < TIMESTAMP '{HI}' THEN 'reloaded'
WHEN ts >= TIMESTAMP '{CUT_LO}' AND ts < TIMESTAMP '{CUT_HI}' THEN 'again' ELSE event_type END AS event_type,
strftime(ts, '%Y-%m-%dT%H') AS hour FROM events
WHERE NOT (ts >= TIMESTAMP '2024-01-12 03:00:00' AND ts < TIMESTAMP '2024-01-12 04:45:00')""",
)
def replace_hour_path(t: Tables) -> DataFrame:
    """Whole hours, hours that the range cuts, and a range whose batch is empty; each replaced twice."""
    path = t.scratch("hours")
    rows = t.events.select("event_id", "ts", "event_type")
    tables.overwrite_partitions(rows.withColumn("hour", F.date_format("ts", "yyyy-MM-dd'T'HH")), path, ["hour"])
    for _ in range(2):
        tables.replace_hour(rows.withColumn("event_type", F.lit("reloaded")), path, "ts", str(LO), str(HI))
        tables.replace_hour(rows.withColumn("event_type", F.lit("again")), path, "ts", str(CUT_LO), str(CUT_HI))
        tables.replace_hour(rows.limit(0), path, "ts", "2024-01-12 03:00:00", "2024-01-12 04:45:00")
    return tables.read_partitioned(t.spark, path, T.StructField("hour", T.StringType()))


@query(
    "replace_hour",
    f"""SELECT event_id, ts, CASE WHEN ts >= TIMESTAMP '{LO}' AND ts < TIMESTAMP '{HI}' THEN 'reloaded' ELSE event_type END AS event_type FROM events""",
)
def replace_hour(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "ts", "event_type")
    batch = rows.filter(in_window("ts", LO, HI)).withColumn("event_type", F.lit("reloaded"))
    once = merge.replace_range(rows, batch, "ts", LO, HI)
    return merge.replace_range(once, batch, "ts", LO, HI)


@query("retention", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= DATE '2001-08-01' - INTERVAL 36 MONTH")
def retention(t: Tables) -> DataFrame:
    return merge.apply_retention(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", "2001-08-01")


@query("soft_delete", "SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN 'Decommissioned' ELSE 'Active' END AS lifecycle_status, c_acctbal >= 0 AS active_flag FROM customer")
def soft_delete(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", "c_name", F.lit("Active").alias("lifecycle_status"), F.lit(True).alias("active_flag"))
    gone = t.customer.filter("c_acctbal < 0").select("c_custkey")
    return merge.soft_delete(rows, gone, "c_custkey", {"lifecycle_status": "Decommissioned", "active_flag": False})


@query("nps_recompute", core.NPS_DAILY)
def nps_recompute(t: Tables) -> DataFrame:
    """A mart built from half the answers; its last week is then built again from all."""
    facts = v.survey_facts(t)
    old = nps_daily(facts.filter(F.col("response_date") < dt.date(2024, 1, 23)))
    stale = nps_daily(facts.filter((F.col("response_date") >= dt.date(2024, 1, 23)) & (F.col("nps_score") > 5)))
    return merge.recompute_tail(old.unionByName(stale), facts, "response_date", "2024-01-30", nps_daily)


REEVAL = dt.datetime(2024, 1, 30)


@query(
    "reflag_48h",
    """SELECT event_id, CASE WHEN ts >= TIMESTAMP '2024-01-28' AND ts < TIMESTAMP '2024-01-30' THEN value > 50 ELSE value > 90 END AS flag,
CASE WHEN ts >= TIMESTAMP '2024-01-29' AND ts < TIMESTAMP '2024-01-30' THEN 'new' ELSE 'old' END AS score FROM events""",
)
def reflag_48h(t: Tables) -> DataFrame:
    """Flags of the last 48 hours and scores of the last 24 are evaluated again by the present rule."""
    rows = t.events.select("event_id", "ts", "value", (F.col("value") > 90).alias("flag"), F.lit("old").alias("score"))
    flags = merge.reevaluate_recent(rows, "ts", REEVAL, 48, {"flag": F.col("value") > 50})
    return merge.reevaluate_recent(flags, "ts", REEVAL, 24, {"score": F.lit("new")}).select("event_id", "flag", "score")


# --- gates ---------------------------------------------------------------------------------


@query(
    "quality_report",
    f"""WITH dup AS (SELECT count(*) AS n FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)),
orphan AS (SELECT count(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)),
c AS (SELECT count(*) AS rows, count(*) FILTER (WHERE c_acctbal < 0) AS neg, count(*) FILTER (WHERE c_name IS NULL) AS nulls,
  {R("CAST(count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS DOUBLE) / count(*)", 4)} AS share FROM customer),
e AS (SELECT {D(R("CAST(count(*) FILTER (WHERE event_type = 'purchase') AS DOUBLE) / count(*)", 4))} AS rate, count(*) FILTER (WHERE -value < -100) AS poor,
  {R(f"abs(avg({MONEY('value')}) - 50)", 4)} AS gap FROM events)
SELECT 'customer.min_rows' AS "check", {D('rows')} AS observed, CAST(500 AS DOUBLE) AS threshold, rows >= 500 AS passed, 'fail' AS severity FROM c
UNION ALL SELECT 'customer.not_null.c_name', {D('nulls')}, 0.0, nulls = 0, 'fail' FROM c
UNION ALL SELECT 'customer.value.balance', {D('neg')}, 0.0, neg = 0, 'warn' FROM c
UNION ALL SELECT 'customer.match_rate.segment', share, 0.9, share >= 0.9, 'warn' FROM c
UNION ALL SELECT 'events.rate.bought', rate, 1.0, rate > 0, 'warn' FROM e
UNION ALL SELECT 'events.poor_signal', {D('poor')}, 0.0, poor = 0, 'warn' FROM e
UNION ALL SELECT 'events.tolerance.value', gap, 2.0, gap <= 2, 'warn' FROM e
UNION ALL SELECT 'events.no_errors', 0.0, 0.0, true, 'fail'
UNION ALL SELECT 'lineitem.unique.l_orderkey+l_linenumber', {D('n')}, 0.0, n = 0, 'fail' FROM dup
UNION ALL SELECT 'orders.foreign_key.o_custkey', {D('n')}, 0.0, n = 0, 'warn' FROM orphan""",
)
def quality_report(t: Tables) -> DataFrame:
    c = (
        Gate(t.customer, "customer")
        .min_rows(500)
        .not_null("c_name")
        .value("balance", F.col("c_acctbal") >= 0)
        .match_rate("segment", F.col("c_mktsegment") == "BUILDING", 0.9)
    )
    ev = t.events.withColumns({"bought": F.col("event_type") == "purchase", "errors": F.get_json_object("props", "$.errors")})
    e = (
        Gate(ev.withColumn("bought", F.col("bought").cast("int")), "events")
        .rate("bought")
        .threshold("poor_signal", -F.col("value") < -100)
        .tolerance("value", F.avg(v.money("value")), 50, 2)
        .no_errors("errors")
    )
    line = Gate(t.lineitem, "lineitem").unique(["l_orderkey", "l_linenumber"])
    good = t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    order = Gate(t.orders, "orders").foreign_key("o_custkey", good)
    return c.report().unionByName(e.report()).unionByName(line.report()).unionByName(order.report())


@query("orphan_orders", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def orphan_orders(t: Tables) -> DataFrame:
    good = t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return orphans(t.orders.select("o_orderkey", "o_custkey"), good, "o_custkey")


@query(
    "manager_chain",
    "SELECT c.c_custkey, c.c_custkey // 10 AS manager_key, m.c_name AS manager_c_name FROM customer c LEFT JOIN customer m ON m.c_custkey = c.c_custkey // 10",
)
def manager_chain(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", "c_name", F.floor(F.col("c_custkey") / 10).alias("manager_key"))
    return with_manager(rows, "c_custkey", "manager_key", ["c_name"]).drop("c_name")


# --- watermarks ----------------------------------------------------------------------------------

MARK = dt.datetime(2001, 7, 1)


@query(
    "incremental_pull",
    """SELECT 'inclusive' AS pull, o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '2001-07-01'
UNION ALL SELECT 'exclusive', o_orderkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '2001-07-01'
UNION ALL SELECT 'first_run', o_orderkey, o_orderdate FROM orders""",
)
def incremental_pull(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_orderdate")
    pulls = {
        "inclusive": inc.read_incremental(rows, "o_orderdate", MARK, inclusive=True),
        "exclusive": inc.read_incremental(rows, "o_orderdate", MARK, inclusive=False),
        "first_run": inc.read_incremental(rows, "o_orderdate", None),
    }
    out = [df.withColumn("pull", F.lit(name)) for name, df in pulls.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query(
    "watermark_cycle",
    """SELECT o_orderkey, o_orderdate, CASE WHEN o_orderdate <= TIMESTAMP '1998-01-01' THEN 1 WHEN o_orderdate <= TIMESTAMP '2000-01-01' THEN 2
ELSE 3 END AS poll FROM orders UNION ALL SELECT -1, max(o_orderdate), 0 FROM orders""",
)
def watermark_cycle(t: Tables) -> DataFrame:
    """Three polls of a growing source: pull, load, move the watermark, pull again. Many orders share a time."""
    source = t.orders.select("o_orderkey", "o_orderdate")
    marks = t.spark.createDataFrame([], inc.WATERMARK_SCHEMA)
    target = source.withColumn("poll", F.lit(0)).limit(0)
    for poll, until in enumerate((dt.datetime(1998, 1, 1), dt.datetime(2000, 1, 1), None), 1):
        visible = source if until is None else source.filter(F.col("o_orderdate") <= until)
        mark = inc.read_watermark(marks, "orders")
        batch = inc.read_incremental(visible, "o_orderdate", mark, inclusive=False).withColumn("poll", F.lit(poll))
        target = merge.upsert(target, batch, ["o_orderkey"], order_by=["o_orderdate"])
        marks = inc.set_watermark(marks, "orders", inc.next_watermark(batch, "o_orderdate"))
    last = marks.select(F.lit(-1).cast("long").alias("o_orderkey"), F.col("watermark_ts").alias("o_orderdate"), F.lit(0).alias("poll"))
    return target.unionByName(last)


@query("watermark_table", "SELECT 'feed' AS pipeline_id, o_orderstatus AS module, max(o_orderdate) AS watermark_ts FROM orders GROUP BY 2")
def watermark_table(t: Tables) -> DataFrame:
    """One watermark per module, moved to the newest row each module loaded."""
    marks = t.orders.groupBy(F.lit("feed").alias("pipeline_id"), F.col("o_orderstatus").alias("module"))
    early = marks.agg(F.min("o_orderdate").alias("watermark_ts"))
    late = marks.agg(F.max("o_orderdate").alias("watermark_ts"))
    return merge.upsert(early, late, ["pipeline_id", "module"])


# --- surveys: topic scores -----------------------------------------------------------------------


def topics(t: Tables) -> DataFrame:
    return t.events.select(
        F.col("event_id").alias("response_id"),
        F.when(F.col("event_type") == "error", "FAULT_RESOL").otherwise("SPEED_PERF").alias("topic_code"),
        (F.least(v.money("value"), F.lit(200).cast("decimal(18,4)")) / 100 - 1).cast("decimal(18,4)").alias("sentiment_score"),
        (v.k() / 100).cast("decimal(5,3)").alias("confidence_score"),
    )


TOPICS = f"""topics AS (
  SELECT event_id AS response_id, CASE WHEN event_type = 'error' THEN 'FAULT_RESOL' ELSE 'SPEED_PERF' END AS topic_code,
         CAST(CAST(least({MONEY('value')}, 200) - 100 AS DOUBLE) / 100 AS DECIMAL(18,4)) AS sentiment_score,
         CAST({v.K} / 100.0 AS DECIMAL(5,3)) AS confidence_score FROM events)"""


@query(
    "topic_scores",
    f"""WITH {TOPICS} SELECT response_id, topic_code, {D('sentiment_score')} AS sentiment_score, {D('confidence_score')} AS confidence_score,
response_id || '_' || topic_code AS topic_score_id,
CASE WHEN sentiment_score > 0.2 THEN 'Positive' WHEN sentiment_score < -0.2 THEN 'Negative' ELSE 'Neutral' END AS sentiment_category FROM topics""",
)
def topic_scores_query(t: Tables) -> DataFrame:
    return topic_scores(topics(t))


@query(
    "topic_averages",
    f"""WITH {TOPICS} SELECT topic_code, count(*) AS topic_rows, count(*) FILTER (WHERE confidence_score >= 0.5) AS scored_rows,
{R("CAST(sum(sentiment_score) FILTER (WHERE confidence_score >= 0.5) AS DOUBLE) / count(*) FILTER (WHERE confidence_score >= 0.5)", 4)} AS avg_sentiment FROM topics GROUP BY 1""",
)
def topic_averages_query(t: Tables) -> DataFrame:
    return topic_averages(topics(t), ["topic_code"])


# --- streams ----------------------------------------------------------------------------------------

EVENT_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
# Longer than the data, because the files of a test stream arrive in any order.
NEVER_LATE = "60 days"

# One task writes a file and one reads it whole, since a file of this size has a single row group.
ROWS_PER_FILE = 500_000

# A sink that only appends takes no more files than these at once, so the batch it keeps stops growing.
FILES_PER_TRIGGER = 24


def dealt(df: DataFrame, files: int, *keys: str) -> tuple[DataFrame, int]:
    """``df`` in ``files`` partitions, or in a multiple that keeps them near ``ROWS_PER_FILE`` rows; and the factor.

    A trigger takes the same share of more files, because each one that merges may rewrite its whole table.
    """
    times = max(1, -(-df.count() // (files * ROWS_PER_FILE)))
    return df.repartition(files * times, *keys), times


def event_stream(t: Tables, label: str, per_trigger: int = 2) -> DataFrame:
    """The events table as a directory of files, read a share of the files per trigger."""
    path = t.scratch(label)
    rows, times = dealt(t.events.withColumn("ts", F.col("ts").cast("timestamp")), 6, "event_id")
    rows.write.parquet(path)
    return jobs.read_events(
        t.spark, "parquet", {"path": path, "maxFilesPerTrigger": str(per_trigger * times)}, EVENT_SCHEMA.replace("timestamp_ntz", "timestamp")
    )


@query(
    "hourly_stream",
    f"SELECT event_type, date_trunc('hour', ts) AS hour_label, count(*) AS events, {D('sum(' + MONEY('value') + ')')} AS total FROM events GROUP BY 1, 2",
)
def hourly_stream(t: Tables) -> DataFrame:
    """Hour totals arrive in update mode and are merged into a table by day, so a batch rewrites the days it touches."""
    totals = [F.count("*").alias("events"), F.sum(v.money("value")).alias("total")]
    hourly = jobs.hourly_stream(event_stream(t, "events"), "ts", ["event_type"], totals, NEVER_LATE)
    out = t.scratch("hourly")
    daily = hourly.withColumn("day", F.to_date("hour_label"))
    jobs.drain(daily, jobs.upsert_sink(out, ["event_type", "hour_label", "day"], "day", ["events"]), mode="update")
    return t.spark.read.parquet(out).drop("day")


@query("stream_upsert", f"SELECT user_id, event_id, event_type, {D('value')} AS value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def stream_upsert(t: Tables) -> DataFrame:
    """Latest event per user: later batches may hold older events, so the newest wins."""
    out = t.scratch("latest")
    rows = event_stream(t, "events", 3).select("user_id", "event_id", "event_type", "value", "ts")
    rows = rows.withColumn("bucket", F.pmod(F.hash("user_id"), F.lit(4)))
    jobs.drain(rows, jobs.upsert_sink(out, ["user_id"], "bucket", ["ts", "event_id"], newest_wins=True))
    return t.spark.read.parquet(out).select("user_id", "event_id", "event_type", "value")


@query("stream_dedupe", "SELECT event_type, count(*) AS events FROM events GROUP BY 1")
def stream_dedupe(t: Tables) -> DataFrame:
    """Every event is delivered twice and counted once."""
    stream = event_stream(t, "events", 6)
    twice = stream.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("delivery"))
    out = t.scratch("unique")

    def handle(batch: DataFrame, batch_id: int) -> None:
        jobs._write_batch(batch.select("event_id", "event_type"), out, batch_id)

    jobs.drain(jobs.dedupe_stream(twice, ["event_id"], "ts", NEVER_LATE), handle)
    return t.spark.read.parquet(out).groupBy("event_type").agg(F.count("*").alias("events"))


@query("stream_late_rows", "SELECT event_id, CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 'late' ELSE 'on_time' END AS route FROM events")
def stream_late_rows(t: Tables) -> DataFrame:
    """Rows of hours that are closed go to a side table."""
    late, good = t.scratch("late"), t.scratch("on-time")

    def on_time(batch: DataFrame, batch_id: int) -> None:
        jobs._write_batch(batch, good, batch_id)

    jobs.drain(event_stream(t, "events").select("event_id", "ts"), jobs.late_sink("ts", dt.datetime(2024, 1, 15), on_time, late))
    both = [t.spark.read.parquet(p).select("event_id", F.lit(r).alias("route")) for p, r in ((good, "on_time"), (late, "late"))]
    return both[0].unionByName(both[1])


@query(
    "stream_dead_letters",
    f"SELECT event_id, CASE WHEN {landing.BROKEN} THEN 'dead' ELSE 'good' END AS route FROM events",
)
def stream_dead_letters(t: Tables) -> DataFrame:
    raw = t.scratch("messages")
    rows, times = dealt(landing.order_messages(t), 4)
    rows.write.parquet(raw)
    stream = jobs.read_events(t.spark, "parquet", {"path": raw, "maxFilesPerTrigger": str(min(2 * times, FILES_PER_TRIGGER))}, "event_id long, body string")
    good, dead = t.scratch("good"), t.scratch("dead")
    jobs.drain(stream, jobs.deadletter_sink("order_id string, event_type string", "body", good, dead, ["event_id"]))
    both = [t.spark.read.parquet(p).select("event_id", F.lit(r).alias("route")) for p, r in ((good, "good"), (dead, "dead"))]
    return both[0].unionByName(both[1])


CLOSING = -1


def closing_stream(t: Tables, df: DataFrame, label: str, files: int = 3) -> DataFrame:
    """``df`` (with ts) as files in a stream, and after them a row of the far future, which lets the watermark close everything."""
    path, last = t.scratch(label), F.lit("2026-01-01").cast("timestamp")
    df = df.withColumn("ts", F.col("ts").cast("timestamp"))
    rows, times = dealt(df, files)
    rows.write.parquet(path)
    # The closing row needs a key, because Spark drops rows without one before it looks at their time.
    end = [(last if f.name == "ts" else F.lit(True if f.dataType == T.BooleanType() else CLOSING).cast(f.dataType)).alias(f.name) for f in df.schema.fields]
    t.spark.range(1).select(*end).write.mode("append").parquet(path)
    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
    return jobs.read_events(t.spark, "parquet", {"path": path, "maxFilesPerTrigger": str(2 * times)}, shape)


BUSY = "value > 40"


@query(
    "sustained_stream",
    f"""WITH hours AS (SELECT DISTINCT event_type, date_trunc('hour', ts) AS h FROM events WHERE {BUSY}),
runs AS (SELECT event_type, h, h - INTERVAL 1 HOUR * row_number() OVER (PARTITION BY event_type ORDER BY h) AS run FROM hours)
SELECT event_type, min(h) AS run_start, max(h) AS run_end, count(*) AS hours FROM runs GROUP BY event_type, run HAVING count(*) >= 3""",
)
def sustained_stream(t: Tables) -> DataFrame:
    """Runs of three busy hours as a stream, whose files hold the hours in any order."""
    rows = t.events.select("event_type", "ts", F.expr(BUSY).alias("busy"))
    stream = closing_stream(t, rows, "busy")
    out = t.scratch("runs")
    jobs.drain(correlate.sustained_stream(stream, "event_type", "ts", "busy", 3, NEVER_LATE), jobs.append_sink(out))
    return t.spark.read.parquet(out).select("event_type", "run_start", "run_end", "hours").filter(F.col("event_type") != str(CLOSING))


@query(
    "survey_fault_stream",
    """SELECT r.event_id AS response_id, r.user_id AS service_id, r.ts AS responded_at, i.event_id AS incident_id, i.ts AS opened_at
FROM events r LEFT JOIN events i ON i.event_type = 'error' AND i.user_id = r.user_id AND i.ts <= r.ts AND i.ts >= r.ts - INTERVAL 48 HOUR
WHERE r.event_type = 'purchase'""",
)
def survey_fault_stream(t: Tables) -> DataFrame:
    """Surveys meet the faults of the 48 hours before them as both arrive; those without a fault come out too."""
    kind = F.col("event_type")
    surveys = closing_stream(t, t.events.filter(kind == "purchase").select(
        F.col("event_id").alias("response_id"), F.col("user_id").alias("service_id"), "ts"), "surveys")
    faults = closing_stream(t, t.events.filter(kind == "error").select(
        F.col("event_id").alias("incident_id"), F.col("user_id").alias("service_id"), "ts"), "faults")
    pairs = correlate.preceded_by(
        surveys.withColumnRenamed("ts", "responded_at"), faults.withColumnRenamed("ts", "opened_at"), ["service_id"],
        "responded_at", "opened_at", "48 HOURS", NEVER_LATE,
    )
    out = t.scratch("pairs")
    jobs.drain(pairs, jobs.append_sink(out))
    return t.spark.read.parquet(out).filter(F.col("response_id") != CLOSING).select("response_id", "service_id", "responded_at", "incident_id", "opened_at")


@query("drops_once", "SELECT event_id, event_type, 1 AS loads FROM events")
def drops_once(t: Tables) -> DataFrame:
    """Drops of JSON files arrive in two rounds and are drained four times; every event is loaded once."""
    folder, archive, checkpoint, out = (t.scratch(x) for x in ("drops", "archive", "drop-check", "loaded"))
    early = F.col("event_id") % 3 == 0
    for part in (early, ~early):
        rows, times = dealt(t.events.filter(part).select("event_id", "event_type"), 3)
        rows.write.mode("append").json(folder)
        for _ in range(2):
            drops = jobs.read_drops(t.spark, folder, "json", "event_id long, event_type string", archive, 2 * times)
            jobs.drain(drops, jobs.append_sink(out), checkpoint)
    return t.spark.read.parquet(out).groupBy("event_id", "event_type").agg(F.count("*").cast("int").alias("loads"))


@query(
    "distinct_users_trailing",
    """WITH f AS (SELECT event_type, CAST(ts AS DATE) AS d, user_id FROM events),
days AS (SELECT DISTINCT event_type, CAST(d + CAST(k AS INTEGER) AS DATE) AS as_of FROM f, unnest(generate_series(0, 6)) AS s(k))
SELECT days.event_type, CAST(as_of AS VARCHAR) AS as_of, count(DISTINCT user_id) AS users FROM days
JOIN f ON f.event_type = days.event_type AND f.d BETWEEN as_of - 6 AND as_of WHERE as_of <= DATE '2024-02-05' GROUP BY ALL""",
)
def distinct_users_trailing(t: Tables) -> DataFrame:
    """Users of the last seven days, every day, from a mart of bitmaps whose newest days are loaded last and twice."""
    path = t.scratch("bitmaps")
    facts = t.events.select("event_type", "user_id", F.to_date("ts").alias("day"))
    cut = dt.date(2024, 1, 20)
    for part in (F.col("day") < cut, F.col("day") >= cut, F.col("day") >= cut):
        tables.overwrite_partitions(bitmaps.daily_bitmaps(facts.filter(part), ["event_type"], "day", "user_id"), path, ["day"])
    mart = tables.read_partitioned(t.spark, path, facts.schema["day"])
    return bitmaps.trailing_counts(mart, ["event_type"], "day", 7, "2024-02-05", "users")
