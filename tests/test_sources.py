"""Malformed input, null tokens, latest file, nested and typed records."""

import base64
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidegate.functions.times import as_date
from tidegate.sources import files, landed
from tidegate.sources.relational import read_sql


def write(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_json_files(spark, tmp_path):
    write(tmp_path, "a.json", '[{"id": 1, "v": "1.5"}, {"id": 2, "v": "bad"}]')
    write(tmp_path, "b.json", '{"id": 3}')
    write(tmp_path, "c.json", '[{"id": 4}, {"id"')
    df = files.read_json_files(spark, str(tmp_path), "id int, v double")
    assert content(df) == [(1, 1.5), (2, None), (3, None)] and df.count() == 3
    assert [r[0].rsplit("/", 1)[1] for r in files.broken_files(spark, str(tmp_path)).collect()] == ["c.json"]


def test_jsonl(spark, tmp_path):
    write(tmp_path, "a.json", '{"id": 1}\n\n   \n{bad\n{"id": 2, "value": "x"}\n{\'id\': 3}\n')
    df = files.read_jsonl(spark, str(tmp_path), "id int, value string")
    assert content(df) == [(1, None), (2, "x")] and df.count() == 2
    write(tmp_path / "empty", "a.json", "\n{\n")
    with pytest.raises(files.EmptyInput):
        files.read_jsonl(spark, str(tmp_path / "empty"), "id int")
    assert files.read_jsonl(spark, str(tmp_path / "empty"), "id int", require_rows=False).count() == 0


def test_csv_strict(spark, tmp_path):
    write(tmp_path, "a.csv", 'id,name,amount\n1,"a, b",1.5\n2,NULL,null\n3,,"2.25"\n4,"say ""hi""",1\n')
    schema = "id int, name string, amount decimal(18,4)"
    got = [(r[0], r[1], r[2] and float(r[2])) for r in files.read_csv_strict(spark, str(tmp_path), schema).orderBy("id").collect()]
    assert got == [(1, "a, b", 1.5), (2, None, None), (3, None, 2.25), (4, 'say "hi"', 1.0)]
    for bad in ("id,name,amount\n1,a,xyz\n", "id,name,amount\n1,a\n"):
        folder = tmp_path / str(abs(hash(bad)))
        write(folder, "b.csv", bad)
        with pytest.raises(Exception):
            files.read_csv_strict(spark, str(folder), schema).collect()


def test_inputs_and_latest(spark, tmp_path):
    with pytest.raises(files.EmptyInput):
        files.list_inputs(spark, f"{tmp_path}/*.csv")
    assert files.list_inputs(spark, f"{tmp_path}/*.csv", required=False) is None
    assert files.read_latest(spark, f"{tmp_path}/*/s.json", spark.read.json, "id int").count() == 0
    for day, n in (("2024-01-01", 1), ("2024-01-08", 2)):
        write(tmp_path / day, "s.json", json.dumps({"id": n}))
    out = files.read_latest(spark, f"{tmp_path}/*/s.json", lambda p: spark.read.schema("id int").json(p), "id int")
    assert content(out) == [(2,)]
    at = dt.datetime(2024, 3, 1, 0, 5)
    assert files.hour_prefix(at) == "2024/02/29/23"
    assert files.hour_prefix(at, "%Y-%m-%dT%H", back=0) == "2024-03-01T00"


def test_scan_date_reaches_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = files.scan_date(df, "o_orderdate", "1997-01-05")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_clickstream(rows):
    def enc(text):
        return base64.b64encode(text.encode()).decode()

    t = dt.datetime(2024, 1, 1, 5)
    data = [
        ("1", "s", t, enc('{"session_id": "a", "duration_ms": 7, "event_ts": "2024-01-01T04:59:00"}')),
        ("2", "s", t - dt.timedelta(seconds=1), enc("{}")),
        ("3", "s", t + dt.timedelta(hours=1), enc("{}")),
        ("4", "s", t, "%%%"),
        ("5", "s", t, enc("{oops")),
        ("6", "s", t, enc('{"duration_ms": "long"}')),
        ("7", "s", t, None),
    ]
    raw = rows("SequenceNumber string, ShardId string, ApproximateArrivalTimestamp timestamp_ntz, Data string", *data)
    out = landed.decode_clickstream(raw, t, t + dt.timedelta(hours=1))
    assert len(out.columns) == 12
    got = {r["sequence_number"]: (r["session_id"], r["duration_ms"], r["event_ts"]) for r in out.collect()}
    assert got == {"1": ("a", 7, dt.datetime(2024, 1, 1, 4, 59)), "6": (None, None, None)}


def test_dead_letters(rows):
    raw = rows("body string", ('{"order_id": 5, "status": "ok"}',), ("{",), (None,), ('{"other": 1}',), ("text",))
    good, dead = landed.parse_or_deadletter(raw)
    assert sorted((r["order_id"] or "~", r["payload"]) for r in good.collect()) == [("5", '{"order_id": 5, "status": "ok"}'), ("~", '{"other": 1}')]
    assert dead.count() == 3 and good.first()["_ingested_at"] is not None


def test_message_is_parsed_once(rows):
    good, _ = landed.parse_or_deadletter(rows("body string", ("{}",)))
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_pages(rows):
    df = rows("body string", ('{"result": [{"id": 1}, {"id": 2}]}',), ('{"errors": [{"m": 1}]}',), ('{"result": []}',))
    assert content(landed.explode_pages(df, "body", ("result",), "id int")) == [(1,), (2,)]
    assert landed.page_errors(df, "body").filter("errors is not null").count() == 1
    nested = rows("body string", ('{"d": {"results": [{"id": 3}]}}',))
    assert content(landed.explode_pages(nested, "body", ("d", "results"), "id int")) == [(3,)]


def test_typed_attributes(rows):
    df = rows("item string", ('{"a": {"N": "1.5"}, "b": {"S": "x"}, "c": {"BOOL": true}, "d": {"NULL": true}}',), ('{"a": {"N": "oops"}}',))
    got = [tuple(r) for r in landed.decode_typed_attrs(df, "item", "a double, b string, c boolean, d string").collect()]
    assert got == [(1.5, "x", True, None), (None, None, None, None)]


def test_nested_documents(spark):
    docs = spark.createDataFrame(
        [("1", None, ("t", None), None), (None, ("r", "p"), None, ("c",))],
        "_id string, location struct<region:string,poi_code:string>, assignment struct<team:string,agent:string>, resolution struct<root_cause:string>",
    )
    for c in ("incident_number", "title", "severity", "status", "category", "notes", "created_at", "updated_at", "resolved_at"):
        docs = docs.withColumn(c, F.lit(None).cast("string"))
    out = landed.flatten_incident(docs)
    assert len(out.columns) == 16
    got = [(r["incident_id"], r["affected_region"], r["assigned_team"], r["root_cause"]) for r in out.collect()]
    assert got == [("1", None, "t", None), ("", "r", None, "c")]


def test_hashes_and_hits(spark):
    df = spark.createDataFrame([("session:1", {"u": "a"}), ("session:2", {}), ("other:1", {"u": "b"}), ("session:3", None)], "k string, h map<string,string>")
    assert content(landed.hash_rows(df, "k", "h", "session:", ["u", "x"])) == [("session:1", "a", None)]
    t = dt.datetime(2024, 1, 1)
    hits = spark.createDataFrame([("a", (t,)), ("b", (t + dt.timedelta(days=1),))], "_id string, _source struct<ts:timestamp_ntz>")
    assert [r["_id"] for r in landed.flatten_hits(hits, "ts", t, t + dt.timedelta(days=1)).collect()] == ["a"]


def test_certifications(spark):
    d = dt.date
    df = spark.createDataFrame([([("B", d(2024, 2, 1)), ("A", d(2024, 1, 10)), ("C", d(2024, 1, 9))],), (None,)], "q array<struct<code:string,expiry:date>>")
    codes, expiry = landed.active_certifications("q", as_date("2024-01-10"))
    got = df.select(codes.alias("c"), expiry.alias("e")).collect()
    assert got[0]["c"] == ["A", "B"] and got[0]["e"]["C"] == d(2024, 1, 9)
    assert got[1]["c"] is None


def test_read_sql_names_an_unreachable_source(spark):
    """The reader needs a database to answer; here only its options are exercised."""
    with pytest.raises(Exception):
        read_sql(spark, "jdbc:nosuchdriver:x", "select 1")
