"""Boundary rows of every classification rule and scalar function."""

import datetime as dt
from decimal import Decimal as Dec

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidegate.functions import numbers, rules, text, times


def test_sla_boundaries(values):
    data = [
        ("ACTIVE", "Priority", 2.0), ("ACTIVE", "priority", 2.01), ("ACTIVE", "Business", 5.0), ("ACTIVE", "BUSINESS", 5.01),
        ("ACTIVE", "Residential", 15.0), ("ACTIVE", "odd", 15.01), ("ACTIVE", None, 15.0), ("PENDING", "Priority", 1.0), ("ACTIVE", "Priority", None),
    ]
    got = values("s string, p string, d double", data, v=rules.sla_met("s", "p", "d"))
    assert got == [True, False, True, False, True, False, True, None, False]


def test_nps_category(values):
    got = values("s int", [(0,), (6,), (7,), (8,), (9,), (10,), (None,)], v=rules.nps_category("s"))
    assert got == ["detractor", "detractor", "passive", "passive", "promoter", "promoter", None]


def test_sentiment(values):
    data = [("", 0), (None, 9), ("great slow", 8), ("great", 7), ("great", 6), ("so slow", 9), ("fine", 4), ("fine", 5), ("slow,", 8), ("GREAT \tfast", 9)]
    got = values("t string, s int", data, v=rules.sentiment("t", "s"))
    assert got == ["neutral", "neutral", "neutral", "positive", "neutral", "negative", "negative", "neutral", "neutral", "positive"]


def test_health_score(values):
    data = [
        (100.0, 0.0, 0.0, 0.0), (94.99, 0.0, 0.0, 0.0), (95.0, 0.0, 0.0, 0.0), (98.99, 0.0, 0.0, 0.0), (99.0, 0.0, 0.0, 0.0),
        (100.0, 0.1, 80.0, 85.0), (100.0, 0.11, 80.01, 85.01), (100.0, 1.0, 95.0, 95.0), (100.0, 1.01, 95.01, 95.01),
        (0.0, 9.0, 99.0, 99.0), (None, None, None, None),
    ]
    got = values("a double, e double, c double, m double", data, v=rules.health_score("a", "e", "c", "m"))
    assert got == [100, 60, 80, 80, 100, 100, 70, 70, 40, 0, 100]
    assert values("s int", [(39,), (40,), (59,), (60,)], v=rules.health_status("s")) == ["CRITICAL", "WARNING", "WARNING", "HEALTHY"]


def test_flags(values):
    assert values("u double", [(80.0,), (80.01,), (None,)], v=rules.congestion_flag("u")) == [False, True, False]
    data = [(2499, None), (2500, None), (None, None), (9999, dt.datetime(2024, 1, 1))]
    assert values("p int, r timestamp_ntz", data, v=rules.mass_failure("p", "r")) == [False, True, False, False]
    data = [(75.0,), (75.01,), (90.01,), (100.0,), (100.01,), (None,)]
    assert values("u double", data, v=rules.budget_risk("u")) == ["ON_TRACK", "WATCH", "WARNING", "WARNING", "CRITICAL", "ON_TRACK"]
    data = [(19.99,), (20.0,), (85.0,), (85.01,), (None,)]
    assert values("u double", data, v=rules.splitter_flag("u")) == ["COLD", "OK", "OK", "HOT", "OK"]
    assert values("u double", [(90.0,), (90.01,)], v=rules.cabinet_flag("u")) == ["OK", "CRITICAL"]


def test_status_rules(values):
    day = dt.date(2024, 1, 10)
    data = [(10.0, 0.0, day), (10.0, 10.0, dt.date(2024, 1, 9)), (10.0, 5.0, day), (10.0, 10.0, day)]
    got = values("a double, r double, d date", data, v=rules.payment_status("a", "r", "d", "2024-01-10"))
    assert got == ["Paid", "Overdue", "Partially Paid", "Open"]
    data = [(5.0, 5.0, True), (5.0, 5.0, False), (5.0, 1.0, None), (5.0, 0.0, False), (5.0, None, False)]
    got = values("q double, g double, x boolean", data, v=rules.purchase_status("q", "g", "x"))
    assert got == ["Cancelled", "Completed", "Partially Received", "Open", "Open"]
    data = [(1, "Network", 1, "New"), (3, "Network", 1, "New"), (2, "Billing", 1, "New"), (2, "Network", 0, "New"), (1, "Network", 5, "Cancelled"), (1, "Network", None, "New")]
    got = values("p int, c string, i int, s string", data, v=rules.reportable_fault("p", "c", "i", "s"))
    assert got == [True, False, False, False, False, False]
    data = [(0.2,), (0.21,), (-0.2,), (-0.21,), (None,)]
    assert values("s double", data, v=rules.sentiment_category("s")) == ["Neutral", "Positive", "Neutral", "Negative", None]
    assert values("x string, s string", [("X", "Active"), ("", "Spare"), (None, "Spare")], v=rules.lifecycle_status("x", "s")) == ["Decommissioned", "Spare", "Spare"]
    assert values("p boolean, b boolean", [(True, True), (False, True), (None, None)], v=rules.transaction_type("p", "b")) == ["Actual", "Committed", "Forecast"]


def test_refresh_risk(values):
    data = [(10.0, 100.0, 5, True), (5.0, 50.0, 0, False), (None, None, None, None), (99.0, 500.0, 50, True)]
    got = values("a double, u double, f int, w boolean", data, v=rules.refresh_risk("a", "u", "f", "w"))
    assert got == [Dec("100.00"), Dec("25.00"), Dec("0.00"), Dec("100.00")]


def test_safe_numbers(values):
    assert values("t string", [("1.5",), ("x",), (None,), ("NaN",)], v=numbers.number_or_zero("t")) == [1.5, 0.0, 0.0, 0.0]
    assert values("a double, b double", [(1.0, 0.0), (1.0, None), (1.0, 4.0)], v=numbers.ratio("a", "b")) == [None, None, 0.25]
    assert values("a double", [(float("nan"),), (1.0,)], v=numbers.nan_to_null("a")) == [None, 1.0]
    assert values("a double", [(1.005,), (2.675,), (-1.005,)], v=numbers.round_dec("a", 2)) == [Dec("1.01"), Dec("2.68"), Dec("-1.01")]
    got = values("a decimal(18,4), m int", [(Dec("326183.22"), 12), (Dec("1"), 0)], v=numbers.monthly_revenue("a", "m"))
    assert got == [Dec("27181.94"), None]
    assert values("s double", [(1.0,), (5.0,), (3.0,)], v=numbers.normalise_score("s", 1, 5)) == [Dec("0.00"), Dec("100.00"), Dec("50.00")]


def test_redaction(values):
    data = [("a.b@c.com. hi",), ("mail x@y.org",), ("call 0412345678 now",), ("call +61412345678",), ("x+61412345678",), (None,), ("  pad \n",)]
    got = values("t string", data, v=text.clean_verbatim("t"))
    assert got == ["[EMAIL] hi", "mail [EMAIL]", "call [PHONE] now", "call +61412345678", "x[PHONE]", "", "pad"]
    strict = [(text.STRICT_PHONE_PATTERN, "[PHONE]", "")]
    assert values("t string", [("call +61412345678",)], v=text.redact("t", strict)) == ["call [PHONE]"]
    long = "y" * 2001
    assert values("t string", [(long,)], v=F.length(text.clean_verbatim("t"))) == [2001]
    assert values("t string", [(long,)], v=F.length(text.clean_verbatim("t", 2000))) == [2000]
    # The address straddles the cut: it is redacted before the text is cut.
    assert values("t string", [("y" * 1995 + " someone@example.com",)], v=text.clean_verbatim("t", 2000))[0].endswith(" [EMA")


def test_text_helpers(values):
    assert values("t string", [("at POI-SYD0042 x",), ("none",), (None,)], v=text.extract_or_null("t")) == ["POI-SYD0042", None, None]
    assert values("a int, b int", [(1, 23), (12, 3)], v=text.composite_id("a", "b")) == ["1_23", "12_3"]
    assert values("c string", [("ACT",), ("zzz",), (None,)], v=text.map_codes("c", rules.STATUS_LABELS)) == ["ACTIVE", "UNKNOWN", "UNKNOWN"]
    assert [text.snake_case(x) for x in ("partnerId", "nationID", "HTTPCode", "already_ok")] == ["partner_id", "nation_id", "http_code", "already_ok"]


def test_decode_segments(rows):
    df = rows("segments string", ("01.200.1500000.P7",), ("01.200.6999999.",), ("01.200.1600000",), ("01.200.abc.P",))
    got = [tuple(r)[1:] for r in text.decode_segments(df).collect()]
    assert got == [
        ("01", "200", "1500000", "P7", "CAPEX"),
        ("01", "200", "6999999", None, "OPEX"),
        ("01", "200", "1600000", None, "OTHER"),
        ("01", "200", "abc", "P", "OTHER"),
    ]


def test_boundary_counts(values):
    a, b = dt.datetime(2024, 1, 31, 23, 59, 59), dt.datetime(2024, 2, 1, 0, 0, 0)
    units = {u: times.boundary_diff(u, "a", "b") for u in ("minute", "hour", "day", "month")}
    assert values("a timestamp_ntz, b timestamp_ntz", [(a, b), (b, a)], **units) == [(1, 1, 1, 1), (-1, -1, -1, -1)]


def test_calendar_labels(values):
    data = [(dt.datetime(2024, 12, 30, 5),), (dt.datetime(2024, 6, 30, 14, 0),)]
    got = values("t timestamp_ntz", data, w=times.iso_week("t"), b=times.business_date("t"), p=times.previous_hour("t"))
    assert got == [
        ("2025-W01", dt.date(2024, 12, 30), dt.datetime(2024, 12, 30, 4)),
        ("2024-W26", dt.date(2024, 7, 1), dt.datetime(2024, 6, 30, 13)),
    ]
    assert times.iso_week_label("2024-12-30") == "2025-W01"


def test_trailing_week(values):
    d = [(dt.datetime(2024, 1, 3),), (dt.datetime(2024, 1, 2, 23),), (dt.datetime(2024, 1, 10),), (dt.datetime(2024, 1, 10, 0, 0, 1),)]
    assert values("t timestamp_ntz", d, v=times.trailing_week("t", "2024-01-10")) == [True, False, True, False]


def test_business_minutes_examples(values):
    fri, mon = dt.datetime(2024, 3, 1, 17), dt.datetime(2024, 3, 4, 9, 30)
    data = [
        (fri, mon),
        (dt.datetime(2024, 3, 4, 18, 30), dt.datetime(2024, 3, 4, 23)),
        (dt.datetime(2024, 3, 4, 9), dt.datetime(2024, 3, 4, 10)),
        (dt.datetime(2024, 3, 5, 0), dt.datetime(2024, 3, 6, 0)),
        (fri, None),
    ]
    got = values("a timestamp_ntz, b timestamp_ntz", data, v=times.business_minutes("a", "b"), h=times.business_minutes("a", "b", ["2024-03-05"]))
    assert [g[0] for g in got] == [150, 0, 60, 600, None]
    assert [g[1] for g in got] == [150, 0, 60, 0, None]


_moment = st.datetimes(dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 28)).map(lambda x: x.replace(second=0, microsecond=0))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(_moment, _moment).map(lambda p: tuple(sorted(p))), min_size=40, max_size=40))
def test_business_minutes_brute_force(spark, pairs):
    holidays = [dt.date(2024, 1, 1), dt.date(2024, 1, 26), dt.date(2024, 1, 27)]

    def slow(a, b):
        n, m = 0, a
        while m < b:
            if m.weekday() < 5 and m.date() not in holidays and 8 <= m.hour < 18:
                n += 1
            m += dt.timedelta(minutes=1)
        return n

    df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")
    for r in df.withColumn("v", times.business_minutes("a", "b", holidays)).collect():
        assert r["v"] == slow(r["a"], r["b"])


@pytest.mark.parametrize("env,expected", [("prod", ("a@b.c", None)), ("dev", ("hidden", None))])
def test_mask(rows, env, expected):
    df = rows("e string, p string", ("a@b.c", None))
    assert tuple(text.mask(df, env, {"e": "hidden", "p": "x"}).first()) == expected


def test_clean_strings(rows):
    df = rows("a string, b string, n int", ("  ", "abcdef", 1), ("", None, 2))
    assert [tuple(r) for r in text.clean_strings(df, {"b": 3}).collect()] == [(None, "abc", 1), (None, None, 2)]


def test_snake_case_nested(rows):
    df = rows("partnerId int, pageInfo struct<endCursor:string,innerList:array<struct<aB:int>>>", (1, ("x", [(2,)])))
    out = text.snake_case_columns(df)
    assert out.schema.simpleString() == "struct<partner_id:int,page_info:struct<end_cursor:string,inner_list:array<struct<a_b:int>>>>"
