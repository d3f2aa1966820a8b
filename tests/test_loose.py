"""Undeclared documents: a plain walk over the parsed JSON gives the same leaves, rows and drift."""

import json

from tidegate.sources import loose

TEXTS = [
    '{"id": 1, "place": {"region": "NSW", "deep": {"a": {"b": {"c": 1}}}}, "tags": [1, 2], "empty": {}}',
    '{"id": "two", "place": {"region": null}, "x.y": 1, "x": {"y": 2}, "`": true}',
    '{"id": 3.5, "place": "nowhere", "new": {"flag": false}}',
    '{"id": null}',
    "{}",
    "[1]",
    '"text"',
    "17",
    "null",
    "",
    '{"id": 1',
    '{"id": 1, "id": 2}',
    None,
]
FIELDS = {"id": ("id", "bigint"), "region": ("place.region", "string"), "gone": ("gone", "int"), "fresh": ("new", "map<string,boolean>")}


def walk(obj, whole=(), depth=loose.DEPTH, under=None):
    for k, v in obj.items():
        k = "`" + k.replace("`", "``") + "`" if "." in k or "`" in k else k
        path = k if under is None else f"{under}.{k}"
        if isinstance(v, dict) and v and path not in whole and depth > 1:
            yield from walk(v, whole, depth - 1, path)
        else:
            yield path, v


def objects():
    return [(i, json.loads(t)) for i, t in enumerate(TEXTS[:5])]


def parsed(rows):
    raw = rows("n int, body string", *enumerate(TEXTS)).selectExpr("*", "'x' AS path", "'x' AS value")
    return loose.read_loose(raw, "body", ["n"])


def test_dead_letters(rows):
    good, dead = parsed(rows)
    assert sorted(r.n for r in good.collect()) == [0, 1, 2, 3, 4]
    assert sorted((r.n, r.body) for r in dead.collect()) == list(enumerate(TEXTS))[5:]


def test_profile(rows):
    kinds = {type(None): "null", str: "text", bool: "boolean", int: "number", float: "number", list: "array", dict: "object"}
    for depth in (1, 2, 4, 9):
        want = {}
        for _, obj in objects():
            for path, v in walk(obj, depth=depth):
                want[path, kinds[type(v)]] = want.get((path, kinds[type(v)]), 0) + 1
        got = loose.profile_fields(parsed(rows)[0], depth=depth).collect()
        assert {(r.path, r.kind): r.n for r in got} == want and len(got) == len(want)


def test_rows_keep_everything(rows):
    got = {r.n: r for r in loose.flatten_loose(parsed(rows)[0], FIELDS, ["n"]).collect()}
    assert got[0].id == 1 and got[0].region == "NSW" and got[0].gone is None
    assert (got[1].id, got[2].id, got[3].id, got[2].region, got[2].fresh) == (None, 3, None, None, {"flag": False})
    whole = [at for at, _ in FIELDS.values()]
    for n, obj in objects():
        rest = {k: json.loads(v) for k, v in got[n].rest.items()}
        want = dict(walk(obj, whole))
        assert {k: v for k, v in want.items() if k not in whole}.items() <= rest.items()
        assert set(rest) - set(want) == set() and {k: want[k] for k in rest} == rest
    assert json.loads(got[1].rest["id"]) == "two" and "place.region" not in got[1].rest


def test_drift(rows):
    got = {r.path: r for r in loose.field_drift(parsed(rows)[0], FIELDS).collect()}
    assert (got["id"].n_docs, got["id"].n_misfit, got["id"].status) == (4, 1, "misfit")
    assert (got["gone"].n_docs, got["gone"].status, got["gone"].declared) == (0, "missing", "int")
    assert (got["place.region"].n_docs, got["place.region"].status) == (2, "as declared")
    whole = [at for at, _ in FIELDS.values()]
    found = {p for _, obj in objects() for p, _ in walk(obj, whole)}
    assert {p for p, r in got.items() if r.status == "new"} == found - set(whole)


def test_promote(rows):
    flat = loose.flatten_loose(parsed(rows)[0], FIELDS, ["n"])
    got = {r.n: r for r in loose.promote(flat, {"late": ("x.y", "int"), "word": ("id", "string")}).collect()}
    assert got[1].late == 2 and got[1].word == "two" and "x.y" not in got[1].rest and "`x.y`" in got[1].rest
    assert got[0].late is None and got[2].word is None and "tags" in got[0].rest


def test_empty(rows):
    good, dead = loose.read_loose(rows("body string"), "body")
    assert good.count() == dead.count() == loose.profile_fields(good).count() == 0
    assert {r.status for r in loose.field_drift(good, FIELDS).collect()} == {"missing"}
