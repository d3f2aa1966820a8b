"""Landed files and messages, and the writers that unload tables."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.functions.text import clean_strings, mask, normalise_columns, snake_case_columns
from tidegate.operators.aggregates import billing_monthly
from tidegate.operators.keys import dedupe_latest
from tidegate.sinks import exports, tables
from tidegate.sources import files, landed
from workload import core
from workload import views as v
from workload.registry import D, MONEY, SQL, Tables, query

# --- messages ------------------------------------------------------------------------


def clicks_raw(t: Tables) -> DataFrame:
    """Base64 JSON per event; large error values arrive as garbage."""
    payload = F.to_json(
        F.struct(
            F.col("user_id").cast("string").alias("session_id"),
            F.col("event_type"),
            F.concat(F.lit("/p/"), v.k().cast("string")).alias("page_path"),
            (v.k() * 10).alias("duration_ms"),
            F.col("ts").cast("string").alias("event_ts"),
        )
    )
    broken = (F.col("event_type") == "error") & (F.col("value") > 100)
    return t.events.select(
        F.col("event_id").cast("string").alias("SequenceNumber"),
        F.concat(F.lit("shard-"), F.col("event_type")).alias("ShardId"),
        F.col("ts").alias("ApproximateArrivalTimestamp"),
        F.when(broken, F.lit("#not base64#")).otherwise(F.base64(payload.cast("binary"))).alias("Data"),
    )


CLICKS = f"""SELECT CAST(event_id AS VARCHAR) AS sequence_number, 'shard-' || event_type AS shard_id, ts AS arrival_ts,
  CAST(user_id AS VARCHAR) AS session_id, CAST(NULL AS VARCHAR) AS rsp_id, CAST(NULL AS VARCHAR) AS user_id, event_type,
  '/p/' || {v.K} AS page_path, CAST(NULL AS VARCHAR) AS referrer, CAST(NULL AS VARCHAR) AS device_type,
  CAST({v.K} * 10 AS BIGINT) AS duration_ms, ts AS event_ts
FROM events WHERE NOT (event_type = 'error' AND value > 100)"""


@query("clickstream_decode", CLICKS)
def clickstream_decode(t: Tables) -> DataFrame:
    return landed.decode_clickstream(clicks_raw(t))


BROKEN = "event_type = 'error' AND value < 5"


def order_messages(t: Tables) -> DataFrame:
    body = F.to_json(
        F.struct(
            F.col("event_id").alias("order_id"),
            F.col("event_type"),
            F.col("user_id").alias("customer_id"),
            F.col("ts").cast("string").alias("event_timestamp"),
        )
    )
    cut = F.substring(body, F.lit(1), F.length(body) - 3)
    return t.events.select("event_id", F.when(F.expr(BROKEN), cut).otherwise(body).alias("body"))


@query(
    "order_events",
    f"""SELECT event_id, CAST(event_id AS VARCHAR) AS order_id, event_type, CAST(NULL AS VARCHAR) AS service_id, CAST(user_id AS VARCHAR) AS customer_id,
CAST(NULL AS VARCHAR) AS rsp_id, CAST(NULL AS VARCHAR) AS status, ts AS event_timestamp FROM events WHERE NOT ({BROKEN})""",
)
def order_events(t: Tables) -> DataFrame:
    good, _ = landed.parse_or_deadletter(order_messages(t), keep=["event_id"])
    return good.drop("payload", "_ingested_at").withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz"))


@query("order_events_dlq", f"SELECT event_id FROM events WHERE {BROKEN}")
def order_events_dlq(t: Tables) -> DataFrame:
    _, dead = landed.parse_or_deadletter(order_messages(t), keep=["event_id"])
    return dead.select("event_id")


@query("queue_dedupe", f"SELECT event_id, user_id, event_type, {D('value')} AS value FROM events")
def queue_dedupe(t: Tables) -> DataFrame:
    once = t.events.select("event_id", "user_id", "event_type", "value", F.lit(1).alias("delivery"))
    twice = once.withColumn("delivery", F.lit(2))
    return dedupe_latest(once.unionByName(twice), ["event_id"], ["delivery"]).drop("delivery")


# --- documents -------------------------------------------------------------------------


def noc_docs(t: Tables) -> DataFrame:
    """Nested incidents; an error event has no location, a signup no assignment."""
    e, kind = t.events, F.col("event_type")
    return e.select(
        F.col("event_id").cast("string").alias("_id"),
        F.concat(F.lit("INC"), F.col("event_id").cast("string")).alias("incident_number"),
        F.col("event_type").alias("title"),
        v.k().cast("string").alias("severity"),
        F.lit("open").alias("status"),
        F.lit("network").alias("category"),
        F.col("props").alias("notes"),
        F.when(kind != "error", F.struct(kind.alias("region"), F.col("user_id").cast("string").alias("poi_code"))).alias("location"),
        F.when(kind != "signup", F.struct(kind.alias("team"), F.lit(None).cast("string").alias("agent"))).alias("assignment"),
        F.struct(F.when(F.col("value") > 50, "power").alias("root_cause")).alias("resolution"),
        F.col("ts").alias("created_at"),
        F.col("ts").alias("updated_at"),
        F.when(F.col("value") > 50, F.col("ts")).alias("resolved_at"),
    )


FLAT_INCIDENT = f"""SELECT CAST(event_id AS VARCHAR) AS incident_id, 'INC' || event_id AS incident_number, event_type AS title, CAST({v.K} AS VARCHAR) AS severity,
  'open' AS status, 'network' AS category, CASE WHEN event_type <> 'error' THEN event_type END AS affected_region,
  CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS affected_poi, CASE WHEN event_type <> 'signup' THEN event_type END AS assigned_team,
  CAST(NULL AS VARCHAR) AS assigned_agent, ts AS created_at, ts AS updated_at, CASE WHEN value > 50 THEN ts END AS resolved_at,
  CASE WHEN value > 50 THEN 'power' END AS root_cause, props AS notes, 'MONGODB_NOC' AS source_system FROM events"""


@query("flatten_incident", FLAT_INCIDENT)
def flatten_incident(t: Tables) -> DataFrame:
    return landed.flatten_incident(noc_docs(t))


@query(
    "crm_flatten",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderkey AS order_id, o_custkey AS service_id, o_orderpriority AS product_code, o_orderstatus AS status,
{D(MONEY('o_totalprice'))} AS rate_per_gbps, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) END AS rsp_id FROM orders""",
)
def crm_flatten(t: Tables) -> DataFrame:
    raw = t.orders.select(
        F.col("o_orderkey").cast("string").alias("Id"),
        F.col("o_orderkey").alias("Order_ID__c"),
        F.col("o_custkey").alias("Service_ID__c"),
        F.col("o_orderpriority").alias("Product_Code__c"),
        F.col("o_orderstatus").alias("Status__c"),
        v.money("o_totalprice").alias("Rate_Per_Gbps__c"),
        F.when(F.col("o_orderstatus") != "P", F.struct(F.col("o_custkey").cast("string").alias("RSP_Code__c"))).alias("RSP_Account__r"),
    )
    return normalise_columns(landed.flatten_crm(raw))


@query(
    "search_hits",
    f"SELECT CAST(event_id AS VARCHAR) AS _id, user_id, ts, {D('value')} AS value FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12'",
)
def search_hits(t: Tables) -> DataFrame:
    hits = t.events.select(F.col("event_id").cast("string").alias("_id"), F.struct("user_id", "ts", "value").alias("_source"))
    return landed.flatten_hits(hits, "ts", dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 12))


@query(
    "kv_hashes",
    "SELECT 'session:' || event_id AS key, CAST(user_id AS VARCHAR) AS user, event_type AS kind, CAST(NULL AS VARCHAR) AS device FROM events WHERE event_type <> 'view' AND value >= 1",
)
def kv_hashes(t: Tables) -> DataFrame:
    prefix = F.when(F.col("event_type") == "view", "cache:").otherwise("session:")
    full = F.create_map(F.lit("user"), F.col("user_id").cast("string"), F.lit("kind"), F.col("event_type"))
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    rows = t.events.select(F.concat(prefix, F.col("event_id").cast("string")).alias("key"), F.when(F.col("value") >= 1, full).otherwise(empty).alias("h"))
    return landed.hash_rows(rows, "key", "h", "session:", ["user", "kind", "device"])


@query(
    "typed_attrs",
    f"SELECT event_id, CASE WHEN event_type <> 'view' THEN event_type END AS kind, {D('value')} AS amount, event_type = 'error' AS failed FROM events",
)
def typed_attrs(t: Tables) -> DataFrame:
    def attr(tag: str, c: Column) -> Column:
        return F.struct(c.cast("string").alias(tag))

    kind = F.when(F.col("event_type") == "view", F.to_json(attr("NULL", F.lit("true")))).otherwise(F.to_json(attr("S", F.col("event_type"))))
    body = F.format_string(
        '{"event_id":%s,"kind":%s,"amount":%s,"failed":%s}',
        F.to_json(attr("N", F.col("event_id"))),
        kind,
        F.to_json(attr("N", F.col("value"))),
        F.to_json(F.struct((F.col("event_type") == "error").alias("BOOL"))),
    )
    return landed.decode_typed_attrs(t.events.select(body.alias("item")), "item", "event_id long, kind string, amount double, failed boolean")


@query("snake_case", "SELECT c_custkey AS customer_key, c_name AS display_name, c_nationkey AS nation_id, c_mktsegment AS market_segment FROM customer")
def snake_case(t: Tables) -> DataFrame:
    raw = t.customer.select(
        F.col("c_custkey").alias("customerKey"),
        F.col("c_name").alias("displayName"),
        F.struct(F.col("c_nationkey").alias("nationID"), F.col("c_mktsegment").alias("marketSegment")).alias("placeInfo"),
    )
    return snake_case_columns(raw).select("customer_key", "display_name", "place_info.*")


@query(
    "clean_strings",
    "SELECT c_custkey, substring(c_name, 1, 12) AS c_name, CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN c_mktsegment END AS c_mktsegment FROM customer",
)
def clean_strings_query(t: Tables) -> DataFrame:
    seg = F.col("c_mktsegment")
    raw = t.customer.select("c_custkey", "c_name", F.when(seg == "BUILDING", "").when(seg == "MACHINERY", "   ").otherwise(seg).alias("c_mktsegment"))
    return clean_strings(raw, {"c_name": 12})


@query(
    "mask_contacts",
    "SELECT c_custkey, 'masked@example.com' AS email, CASE WHEN c_acctbal >= 0 THEN '+61200000000' END AS phone FROM customer",
)
def mask_contacts(t: Tables) -> DataFrame:
    raw = t.customer.select(
        "c_custkey",
        F.concat("c_name", F.lit("@mail.test")).alias("email"),
        F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("04"), F.col("c_custkey").cast("string"))).alias("phone"),
    )
    return mask(raw, "staging", {"email": "masked@example.com", "phone": "+61200000000"})


# --- files -------------------------------------------------------------------------------

SAMPLE = "event_id long, user_id long, event_type string, value double"
SAMPLE_SQL = f"SELECT event_id, user_id, event_type, {D('value')} AS value FROM events"
PER_FILE = 500


def write_array_files(t: Tables, path: str, wrap: str = "%s") -> None:
    """One JSON array per file. Ids are unique, so an array never holds more than PER_FILE rows."""
    rec = F.struct("event_id", "user_id", "event_type", "value")
    arrays = t.events.groupBy(F.floor(F.col("event_id") / PER_FILE)).agg(F.to_json(F.collect_list(rec)).alias("a"))
    arrays.select(F.format_string(wrap, "a").alias("value")).write.option("maxRecordsPerFile", 1).text(path)


@query("json_landing", SAMPLE_SQL)
def json_landing(t: Tables) -> DataFrame:
    base = t.scratch("json")
    write_array_files(t, f"{base}/arrays")
    t.region.select(F.lit('{"event_id": ').alias("value")).write.text(f"{base}/broken")
    return files.read_json_files(t.spark, f"{base}/*/part-*", SAMPLE)


@query("json_lines", SAMPLE_SQL)
def json_lines(t: Tables) -> DataFrame:
    """Good lines, blank lines and broken lines in the same files."""
    path = t.scratch("jsonl")
    line = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    noise = F.when(F.col("event_type") == "error", F.array(line, F.lit(""), F.lit("{broken"))).otherwise(F.array(line))
    t.events.select(F.explode(noise).alias("value")).write.text(path)
    return files.read_jsonl(t.spark, path, SAMPLE)


@query("result_pages", SAMPLE_SQL)
def result_pages(t: Tables) -> DataFrame:
    path = t.scratch("pages")
    write_array_files(t, path, '{"d":{"results":%s}}')
    pages = t.spark.read.option("wholetext", True).text(path)
    return landed.explode_pages(pages, "value", ("d", "results"), SAMPLE)


@query(
    "csv_landing",
    f"""SELECT c_custkey, c_name, CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') THEN c_mktsegment END AS c_mktsegment,
{D(MONEY('c_acctbal'))} AS c_acctbal FROM customer""",
)
def csv_landing(t: Tables) -> DataFrame:
    path = t.scratch("csv")
    seg = F.col("c_mktsegment")
    token = F.when(seg == "BUILDING", "NULL").when(seg == "MACHINERY", "null").when(seg == "HOUSEHOLD", "").otherwise(seg)
    rows = t.customer.select("c_custkey", "c_name", token.alias("c_mktsegment"), v.money("c_acctbal").alias("c_acctbal"))
    rows.write.option("header", True).option("quoteAll", True).csv(path)
    found = files.list_inputs(t.spark, f"{path}/*.csv")
    return files.read_csv_strict(t.spark, found, "c_custkey long, c_name string, c_mktsegment string, c_acctbal decimal(18,4)")


@query("latest_file", "SELECT s_suppkey, s_name FROM supplier")
def latest_file(t: Tables) -> DataFrame:
    """Three dated drops; only the newest one is read."""
    base = t.scratch("drops")
    for day, rows in (("2024-01-01", t.supplier.filter("s_acctbal > 5000")), ("2024-01-08", t.supplier.filter("s_acctbal > 0")), ("2024-01-15", t.supplier)):
        rows.select("s_suppkey", "s_name").coalesce(1).write.json(f"{base}/{day}")
    return files.read_latest(
        t.spark, f"{base}/*/part-*.json", lambda p: t.spark.read.schema("s_suppkey long, s_name string").json(p), "s_suppkey long, s_name string"
    )


@query("xml_records", f"SELECT CAST(event_id AS VARCHAR) AS SessionId, event_type AS CallingParty, CASE WHEN {v.K} < 10 THEN 0 ELSE {v.K} END AS DurationSeconds FROM events")
def xml_records(t: Tables) -> DataFrame:
    """One namespaced envelope per file, like the landed responses of a service."""
    path = t.scratch("xml")
    seconds = F.when(v.k() < 10, "").otherwise(F.format_string("<cdr:DurationSeconds>%d</cdr:DurationSeconds>", v.k()))
    record = F.format_string(
        "<cdr:CDRRecord><cdr:SessionId>%d</cdr:SessionId><cdr:CallingParty>%s</cdr:CallingParty>%s</cdr:CDRRecord>",
        F.col("event_id"),
        F.col("event_type"),
        seconds,
    )
    envelope = '<env:Envelope xmlns:env="http://example.com/env" xmlns:cdr="http://example.com/cdr"><env:Body>%s</env:Body></env:Envelope>'
    pages = t.events.groupBy(F.floor(F.col("event_id") / PER_FILE)).agg(F.concat_ws("", F.collect_list(record)).alias("r"))
    pages.select(F.format_string(envelope, "r").alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return files.read_xml_records(t.spark, path, "CDRRecord", "SessionId string, CallingParty string, DurationSeconds int", ["DurationSeconds"])


# --- unloads -----------------------------------------------------------------------------------


@query("ml_export", f"SELECT event_id, user_id, event_type, {D('value')} AS value FROM events WHERE ts >= DATE '2024-01-10' AND ts < DATE '2024-01-11'")
def ml_export(t: Tables) -> DataFrame:
    day = files.scan_date(t.events, "ts", "2024-01-10").select("event_id", "user_id", "event_type", "value")
    return t.spark.read.parquet(exports.unload(day, t.scratch("ml")))


@query(
    "ordered_extract",
    "SELECT l_orderkey, l_linenumber, l_shipdate, row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS place FROM lineitem",
)
def ordered_extract(t: Tables) -> DataFrame:
    """The place of every line in the extract: file by file, and inside a file by its order."""
    by = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    path = exports.ordered_extract(t.lineitem.select(*by), t.scratch("extract"), by)
    rows = t.spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy("file").agg(F.count("*").alias("n")).select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return rows.join(files, "file").select("l_orderkey", "l_linenumber", "l_shipdate", (F.col("before") + F.col("at") + 1).alias("place"))


@query("csv_gz_unload", core.BILLING_MONTHLY)
def csv_gz_unload(t: Tables) -> DataFrame:
    df = billing_monthly(v.billing_lines(t))
    path = exports.unload_csv_gz(df, t.scratch("csvgz"))
    return t.spark.read.option("header", True).schema(df.schema).csv(path)


@query("submission_json", SQL["rsp_anonymised"])
def submission_json(t: Tables) -> DataFrame:
    df = core.rsp_anonymised(t)
    path = exports.write_submission(df, t.scratch("submission"), core.RUN_DATE)
    return t.spark.read.schema(df.schema).json(path)


@query("full_refresh", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def full_refresh(t: Tables) -> DataFrame:
    path = t.scratch("parts")
    tables.full_refresh(t.part.filter("p_size < 10"), path)
    tables.full_refresh(t.part, path)
    return t.spark.read.parquet(path)


@query("append_log", core.BILLING_MONTHLY)
def append_log(t: Tables) -> DataFrame:
    path = tables.partition_path(t.scratch("append"), "finance", "billing_lines")
    lines = v.billing_lines(t)
    for code in ("F", "O"):
        tables.append(lines.filter(F.col("plan_code") == code), path, ["plan_code"])
    return billing_monthly(t.spark.read.parquet(path))


@query("mart_refresh", core.BILLING_MONTHLY)
def mart_refresh(t: Tables) -> DataFrame:
    path = t.scratch("mart")
    tables.refresh_mart(lambda: billing_monthly(v.billing_lines(t)), path)
    return tables.register_view(t.spark, "v_billing_monthly", t.spark.read.parquet(path))


@query(
    "replace_date",
    f"""SELECT event_id, user_id, {D('CASE WHEN CAST(ts AS DATE) = DATE \'2024-01-10\' THEN value * 2 ELSE value END')} AS value, {"CAST(CAST(ts AS DATE) AS VARCHAR)"} AS event_date
FROM events WHERE CAST(ts AS DATE) <> DATE '2024-01-11'""",
)
def replace_date(t: Tables) -> DataFrame:
    """Load all days, reload one with new values, reload another with nothing."""
    path = t.scratch("replace")
    rows = t.events.select("event_id", "user_id", "value", F.to_date("ts").alias("event_date"))
    tables.overwrite_partitions(rows, path, ["event_date"])
    tables.replace_partition(rows.withColumn("value", F.col("value") * 2), path, "event_date", "2024-01-10")
    tables.replace_partition(rows.filter("value < 0"), path, "event_date", "2024-01-11")
    return t.spark.read.schema("event_id long, user_id long, value double, event_date date").parquet(path)


@query("keyed_export", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice FROM orders")
def keyed_export(t: Tables) -> DataFrame:
    """Rows are written by key into a folder that stands in for the store."""
    out = t.scratch("keyed")
    items = exports.as_string_items(t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice"))
    items.write.json(out)
    return t.spark.read.schema("o_orderkey string, o_orderstatus string, o_totalprice string").json(out)


@query("add_partitions", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def add_partitions(t: Tables) -> DataFrame:
    """Folders written outside the catalogue become visible once registered; twice is no error."""
    path, name = t.scratch("catalogued"), f"orders_{uuid.uuid4().hex}"
    tables.overwrite_partitions(t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus"), path, ["o_orderstatus"])
    t.spark.sql(
        f"CREATE TABLE {name} (o_orderkey bigint, o_totalprice double, o_orderstatus string) "
        f"USING parquet PARTITIONED BY (o_orderstatus) LOCATION '{path}'"
    )
    tables.add_partitions(t.spark, name, [{"o_orderstatus": s} for s in ("F", "O")])
    tables.add_partitions(t.spark, name, [{"o_orderstatus": s} for s in ("O", "P")])
    return t.spark.table(name)
