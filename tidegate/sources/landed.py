"""Decoders for records that arrive as text, bytes or nested documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.numbers import _col
from tidegate.functions.times import in_window
from tidegate.sources.parsing import as_struct, parse_records, typed
from tidegate.sources.schemas import CLICKSTREAM_PAYLOAD, CRM_ORDER_RENAMES, ORDER_EVENT

def parse_or_deadletter(
    raw: DataFrame, body: str = "body", schema: str = ORDER_EVENT, keep: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Split messages into parsed rows (with their raw payload) and dead letters."""
    parsed = parse_records(raw, body, schema, keep)
    good = (
        parsed.filter(~F.col("_bad"))
        .drop("_bad")
        .withColumnRenamed(body, "payload")
        .withColumn("_ingested_at", F.current_timestamp())
    )
    dead = parsed.filter("_bad").select(*keep, body, F.current_timestamp().alias("_rejected_at"))
    return good, dead


def decode_clickstream(raw: DataFrame, start=None, end=None) -> DataFrame:
    """Base64 JSON records whose arrival lies in ``[start, end)``; bad ones dropped."""
    df = raw
    if start is not None:
        df = df.filter(in_window("ApproximateArrivalTimestamp", start, end))
    df = df.withColumn("_text", F.try_to_binary("Data", F.lit("base64")).cast("string"))
    keep = ["SequenceNumber", "ShardId", "ApproximateArrivalTimestamp"]
    parsed = parse_records(df, "_text", CLICKSTREAM_PAYLOAD, keep).filter(~F.col("_bad"))
    return parsed.select(
        F.col("SequenceNumber").alias("sequence_number"),
        F.col("ShardId").alias("shard_id"),
        F.col("ApproximateArrivalTimestamp").alias("arrival_ts"),
        "session_id",
        "rsp_id",
        "user_id",
        "event_type",
        "page_path",
        "referrer",
        "device_type",
        F.col("duration_ms").try_cast("long").alias("duration_ms"),
        F.col("event_ts").try_cast("timestamp_ntz").alias("event_ts"),
    )


def explode_pages(pages: DataFrame, body: str, path: Sequence[str], schema: str) -> DataFrame:
    """Rows of a result page: ``path`` leads to the array, e.g. ``("d", "results")``."""
    inner: T.DataType = T.ArrayType(as_struct(schema))
    for name in reversed(path):
        inner = T.StructType([T.StructField(name, inner)])
    parsed = pages.select(F.from_json(F.col(body), inner).alias("_p"))
    return parsed.select(F.inline(F.col("_p." + ".".join(path))))


def page_errors(pages: DataFrame, body: str) -> DataFrame:
    """The page's ``errors`` member, null when the call succeeded."""
    return pages.withColumn("errors", F.get_json_object(body, "$.errors"))


def flatten_crm(df: DataFrame, mapping: Mapping[str, str] = CRM_ORDER_RENAMES) -> DataFrame:
    """Rename custom fields and pull the related account's code (null when unrelated)."""
    flat = df.withColumn("rsp_id", F.col("RSP_Account__r.RSP_Code__c")).drop("RSP_Account__r")
    return flat.withColumnsRenamed(dict(mapping))


def flatten_incident(docs: DataFrame) -> DataFrame:
    """Sixteen flat columns from a nested incident document."""
    return docs.select(
        F.coalesce(F.col("_id"), F.lit("")).alias("incident_id"),
        "incident_number",
        "title",
        "severity",
        "status",
        "category",
        F.col("location.region").alias("affected_region"),
        F.col("location.poi_code").alias("affected_poi"),
        F.col("assignment.team").alias("assigned_team"),
        F.col("assignment.agent").alias("assigned_agent"),
        "created_at",
        "updated_at",
        "resolved_at",
        F.col("resolution.root_cause").alias("root_cause"),
        "notes",
        F.lit("MONGODB_NOC").alias("source_system"),
    )


def flatten_hits(hits: DataFrame, ts_col: str, start, end) -> DataFrame:
    """``_source`` of every hit; the time range is mandatory."""
    return hits.select("_id", "_source.*").filter(in_window(ts_col, start, end))


def decode_typed_attrs(df: DataFrame, body: str, schema: str) -> DataFrame:
    """Items whose attributes carry their type: ``{"a": {"N": "1"}}``."""
    fields = as_struct(schema).fields
    attr = T.StructType([T.StructField(k, T.StringType()) for k in ("S", "N", "BOOL", "NULL")])
    item = F.from_json(body, T.StructType([T.StructField(f.name, attr) for f in fields]))
    parsed = df.withColumn("_i", item)

    def value(f: T.StructField) -> Column:
        a = F.col(f"_i.{f.name}")
        text = F.when(a["NULL"].isNull(), F.coalesce(a["N"], a["BOOL"], a["S"]))
        return typed(text, f.dataType).alias(f.name)

    return parsed.select([value(f) for f in fields])


def hash_rows(df: DataFrame, key: str, hash_col: str, prefix: str, fields: Sequence[str]) -> DataFrame:
    """Non-empty hashes under a key prefix, one column per wanted field."""
    h = F.col(hash_col)
    kept = df.filter(F.col(key).startswith(prefix) & (F.coalesce(F.size(h), F.lit(0)) > 0))
    return kept.select(key, *[F.try_element_at(h, F.lit(f)).alias(f) for f in fields])


def active_certifications(quals: Column | str, today: Column) -> tuple[Column, Column]:
    """Sorted codes still valid today, and the map of every code to its expiry.

    ``quals`` is an array of ``struct(code, expiry)``.
    """
    q = _col(quals)
    live = F.filter(q, lambda x: x["expiry"] >= today)
    codes = F.array_sort(F.array_distinct(F.transform(live, lambda x: x["code"])))
    expiry = F.map_from_entries(F.transform(q, lambda x: F.struct(x["code"], x["expiry"])))
    return codes, expiry
