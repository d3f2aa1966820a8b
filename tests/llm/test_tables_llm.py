"""URL filter, packing, mixing and web archives against plain forms and round trips."""

import gzip
import hashlib
import random
import re
import zipfile
import zlib
from datetime import datetime
from io import BytesIO

import brute
import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidegate.llm import mixing, packing, url_filter, warc_packages
from tidegate.llm.queries import URL_RULES, tokenizer_path

# --- urls ------------------------------------------------------------------------


def judge(url, rules):
    at = (url or "").find("://")
    tail = url[at + 3 :] if at >= 0 else ""
    end = min([i for i in map(tail.find, "/?#") if i >= 0], default=len(tail))
    host, rest = tail[:end].translate(brute.UPPER), tail[end:]
    path = rest[: min([i for i in map(rest.find, "?#") if i >= 0], default=len(rest))]
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules
            if h and host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, 0, None, "allow"))
    return host, path, best[3], best[4]


def test_url_filter(spark):
    rng = random.Random(8)
    hosts = ["example.com", "WWW.Example.com", "a.www.example.com", "x.net", "net", "notexample.com", "com", "", "é.com", "a..com", ".com"]
    urls = [rng.choice(["http://", "https://", "://", "", "x:/"]) + rng.choice(hosts)
            + rng.choice(["", "/", "/en/", "/en", "/EN/x", "/es/1?q#z", "/fr/#a?b", "?/en/", "#", "/en/\nx", "/e", "/enx"])
            for _ in range(400)]
    urls += [None, "", "http://", "http://a.com://b/en/", "x" * 5000, "http://x.com/" + "y" * 5000]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    pages = pages.union(pages.limit(5)).select("*", *[F.lit("x").alias(c) for c in ("host", "path", "rule", "prefix", "digest")])
    rules = [*URL_RULES, ("com", "/e", "block"), ("www.example.com", "/en/", "block"), ("com", "", "allow"), ("é.com", "/en/x", "block")]
    table = spark.createDataFrame([*rules, rules[0], (None, "/", "block"), ("", "", "block"), ("com", None, "block"), ("com", "/", "?")],
                                  "host string, path string, verdict string")
    got = url_filter.judge(pages, table).collect()
    assert len(got) == len(urls) + 5
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == judge(urls[r.page_id], rules), urls[r.page_id]
    assert url_filter.judge(pages.limit(0), table).count() == 0
    assert {r.verdict for r in url_filter.judge(pages, table.limit(0)).collect()} == {"allow"}


# --- packing -----------------------------------------------------------------------


def odd_texts(seed, n):
    rng = random.Random(seed)
    parts = [" ", "  ", "\n", "\n\n", "\t", "a", "don't", "'ll", "12", "é", "<|endoftext|>", "!", " ", "\x1c", "字", " x", "\xa0", "word" * 70]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def library_ids(texts):
    """Ids of whole texts by the library of the tokenizer file."""
    tokenizer = Tokenizer.from_file(tokenizer_path())
    tokenizer.encode_special_tokens = True
    return [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_ids_of_parts_are_those_of_the_whole(monkeypatch):
    tokens = packing.Tokens(tokenizer_path())
    texts = odd_texts(1, 1500)
    assert tokens.ids(texts) == library_ids(texts)
    monkeypatch.setattr(packing, "REMEMBERED", 20)
    assert tokens.ids(texts[:300]) == library_ids(texts[:300])


def test_ids_of_test_documents():
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist()
    assert packing.Tokens(tokenizer_path()).ids(texts) == library_ids(texts)


def test_added_tokens_as_by_the_plain_call(spark):
    texts = ["a <|endoftext|> b", "<|endoftext|>", "a<|endoftext|>b  <|endoftext|>\n", "<|endoftext|", "plain text\n", *odd_texts(7, 300)]
    plain = Tokenizer.from_file(tokenizer_path())
    want = [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert packing.Tokens(tokenizer_path(), added=True).ids(texts) == want
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    end = np.array([packing.END_ID], "<u4").tobytes()
    got = {r.doc_id: r.ids_crc32 for r in packing.pack(docs, tokenizer_path(), added=True).collect()}
    assert got == {i: zlib.crc32(x + end) for i, x in enumerate(want)}


def check_packing(rows, texts, capacity):
    """Rows cover every document once and in order, and every sequence without gap or overlap."""
    ids = {i: x + b"\x02\0\0\0" for i, x in zip(texts, library_ids([t or "" for t in texts.values()]), strict=True)}
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for i, own in by_doc.items():
        own.sort(key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        at = 0
        for r in own:
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[i][4 * at : 4 * (at + r.length)])
            at += r.length
        assert at * 4 == len(ids[i]) and all(r.length == capacity for r in own[1:])
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by_sequence), -(-sum(len(x) // 4 for x in ids.values()) // capacity)


def test_packing(spark):
    rng = random.Random(2)
    texts = dict(enumerate([None, "", *odd_texts(3, 200), *[" ".join(["word"] * rng.randint(1, 700)) for _ in range(400)]]))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    docs = docs.select("*", *[F.lit("x").alias(c) for c in ("length", "bucket", "rank", "piece", "start", "inside", "before")])
    for capacity in (64, 256):
        used, least = check_packing(packing.pack(docs, tokenizer_path(), capacity, small=capacity // 4).collect(), texts, capacity)
        assert used <= least * 1.03 + 2
    twice = packing.pack(docs.filter("doc_id = 9").union(docs.filter("doc_id = 9")), tokenizer_path()).collect()
    assert len(twice) == 2 and len({(r.sequence_id, r.offset) for r in twice}) == 2
    assert packing.pack(docs.limit(0), tokenizer_path()).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan(seed):
    rng = random.Random(seed)
    counts = {rng.randint(1, 100): rng.choice([1, 2, 50, 3000]) for _ in range(rng.choice([1, 3, 30, 100]))}
    rows = packing.plan(counts, 100, rng.choice([0, 20, 100]), rng.choice([1, 5, 64])).tolist()
    room = {}
    for length, n in counts.items():
        own = [r for r in rows if r[0] == length]
        assert [r[1] for r in own] == [0, *[r[2] for r in own[:-1]]] and own[-1][2] == n
        for _, a, b, sequence, offset in own:
            for k in range(b - a):
                room.setdefault(sequence + k, []).append((offset, length))
    for own in room.values():
        own.sort()
        assert [x for x, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))] and sum(n for _, n in own) <= 100
    assert sorted(room) == list(range(len(room)))


# --- mixing --------------------------------------------------------------------------


def test_mixing(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(["w"] * rng.randint(0, 300)), f"s{min(rng.randrange(12), rng.randrange(12))}") for i in range(600)]
    rows += [(1000, None, "s0"), (1001, "a b", None), (1002, "c " * 500, None), (1003, "", "nothing"), (None, "x y", "s1"), (5, *rows[5][1:])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    docs = docs.select("*", *[F.lit("x").alias(c) for c in ("place", "target", "words", "bucket", "n_sources", "s", "share")])
    got = mixing.mix(docs, block=16, shard_blocks=64).collect()
    assert len(got) == len(rows)
    size = {}
    for i, t, s in rows:
        size[s] = size.get(s, 0) + len(brute.words(t))
    names = sorted([s for s in size if s is not None]) + [None]
    target = brute.filled([size[s] for s in names], [3, 1, 2], 1.5, 2)
    quota = brute.seats(target, round(sum(target) / 16))
    taken = dict.fromkeys(names, 0)
    for r in got:
        at = names.index(r.source)
        assert r.source_size == size[r.source] and abs(r.target - target[at]) < 1e-6 * max(1, target[at])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s, t, q in zip(names, target, quota, strict=True):
        assert taken[s] == min(16 * q, 2 * size[s]) and abs(taken[s] - t) <= 32
    again = mixing.mix(docs.repartition(2), block=16, shard_blocks=64).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert mixing.mix(docs.limit(0)).count() == 0

    # Block by block: the seat of every block of a source's ring says which shard its words are in.
    order = [i for _, i in sorted((-t / (2 * j - 1), i) for i, t in enumerate(target) if t for j in range(1, quota[i] + 1))]
    shard_of = {s: [seat // 64 for seat, i in enumerate(order) if names[i] == s] for s in names}
    ring = {s: [] for s in names}
    key = lambda r: (hashlib.md5(f"0:{r[0]}".encode() if r[0] is not None else b"0").hexdigest()[:15], r[0] or 0)
    for n, (i, t, s) in enumerate(sorted(rows, key=key)):
        ring[s] += [(n, i, w) for w in range(len(brute.words(t)))]
    want, by_row = {}, {}
    for s in names:
        for at in range(taken[s]):
            n, i, w = ring[s][at % len(ring[s])]
            shard = shard_of[s][at // 16]
            want.setdefault((s, shard), []).append((str(i), w))
            by_row.setdefault((n, i, s), []).append(shard)
    found = {}
    for r in mixing.shares(docs, block=16, shard_blocks=64).collect():
        assert r.n_words > 0
        found.setdefault((r.source, r.shard), []).extend((str(r.doc_id), r.from_word + w) for w in range(r.n_words))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()} and len(want) > 30
    in_shards = mixing.by_shard(docs, block=16, shard_blocks=64).collect()
    assert sorted(str(r[:6]) for r in in_shards) == sorted(str(tuple(r)) for r in got)
    ends = sorted((str(i), min(v), max(v), len(v)) for (_, i, _), v in by_row.items())
    assert sorted((str(r.doc_id), r.first_shard, r.last_shard, r.taken) for r in in_shards if r.taken) == ends
    assert all(r.first_shard is None and r.last_shard is None for r in in_shards if not r.taken)
    assert mixing.by_shard(docs.limit(0)).count() == 0


def test_equal_quotients_at_the_edge_of_a_shard(spark):
    rows = spark.createDataFrame([(i, f"s{i}", 100.0) for i in range(4)], "place int, source string, target double")
    got = {(r.place, r.shard): (r.quota, r.until) for r in mixing.quotas(rows, 20, 6).collect()}
    assert [[got[i, s] for i in range(4)] for s in range(4)] == [
        [(2, 2), (2, 2), (1, 1), (1, 1)], [(1, 3), (1, 3), (2, 3), (2, 3)],
        [(2, 5), (2, 5), (1, 4), (1, 4)], [(0, 5), (0, 5), (1, 5), (1, 5)],
    ]


def test_quotas_per_shard(spark):
    target = [700.0, 200.0, 90.0, 10.0, 0.0]
    rows = spark.createDataFrame([(i, f"s{i}", t) for i, t in enumerate(target)], "place int, source string, target double")
    got = {(r.place, r.shard): r.quota for r in mixing.quotas(rows, 10, 30).collect()}
    so_far = [0] * 5
    for shard, house in enumerate((30, 60, 90, 100)):
        now = brute.seats(target, house)
        assert [got.get((i, shard), 0) for i in range(5)] == [a - b for a, b in zip(now, so_far, strict=True)]
        so_far = now


# --- archives --------------------------------------------------------------------------


@pytest.mark.parametrize("wide", [False, True])
def test_zip_directories(wide):
    out = BytesIO()
    package = warc_packages.StoredZip(out, wide)
    members = {"a/ü.txt": b"", "b.bin": bytes(range(256)) * 10, "c": b"PK\x05\x06" + b"x" * 30}
    for name, data in members.items():
        package.add(name, data)
    package.close()
    with zipfile.ZipFile(BytesIO(out.getvalue())) as z:
        assert z.testzip() is None and {n: z.read(n) for n in z.namelist()} == members
    read = BytesIO(out.getvalue())
    found = warc_packages.directory(read, len(out.getvalue()))
    assert {n: warc_packages._range(read, *warc_packages.member(read, e)) for n, e in found.items()} == members


def test_zip_made_elsewhere():
    out = BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.comment = b"a comment"
        with z.open("big", "w", force_zip64=True) as f:
            f.write(b"data")
        z.writestr("small", b"more", zipfile.ZIP_DEFLATED)
    for front in (b"", b"#!/bin/sh\n"):
        read = BytesIO(front + out.getvalue())
        found = warc_packages.directory(read, len(read.getvalue()))
        assert warc_packages._range(read, *warc_packages.member(read, found["big"])) == b"data"
        with pytest.raises(ValueError):
            warc_packages.member(read, found["small"])
    with pytest.raises(ValueError):
        warc_packages.directory(BytesIO(b"no zip"), 6)


def test_archives(spark, monkeypatch):
    long, other = "é" * 600, "z\r\n\r\n" * 400
    rows = [(1, "http://a/\r\n", long), (2, None, long), (3, "u", "short"), (4, "u", "short"), (5, "u", None), (6, "u", ""), (7, "u", other),
            (8, "u", long), (8, "v", long), (None, "u", other), (9, "u", "y" * 300_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    pages = pages.select("*", *[F.lit("x").alias(c) for c in ("digest", "refers_to", "n", "payload", "package", "bytes")])
    for package in (1, 32 << 20):
        monkeypatch.setattr(warc_packages, "PACKAGE_BYTES", package)
        got = warc_packages.archived(spark, pages).collect()
        assert len(got) == len(rows)
        sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
        want = sorted(
            (i or 0, len((t or "").encode()), sha(t), *(("revisit", 8) if t == long and i != 8 else ("revisit", 7) if t == other and i != 7 else ("response", 0)))
            for i, _, t in rows
        )
        assert sorted((r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to or 0) for r in got) == want
    assert warc_packages.archived(spark, pages.limit(0)).count() == 0


def test_records_by_the_standard(spark, tmp_path):
    """A strict reader of WARC 1.1: mandatory fields, their forms, unique ids, revisits that name their response."""
    long = "x" * 1500
    rows = [(1, "http://a/ü b<c>?q=1%20#f", long), (2, None, long), (2, "", "short"), (3, "http://b/", long), (4, "http://c/\r\nX-Evil: 1", "y" * 1200),
            (5, "http://d/", "y" * 1200), (5, "http://d/", "y" * 1200), (5, "http://d/", None), (None, "http://e/", long)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    made = warc_packages.write_packages(pages, f"file://{tmp_path}/w", date=datetime(2024, 2, 29, 23, 59, 58)).collect()
    records = []
    for row in made:
        with zipfile.ZipFile(row.package.removeprefix("file://")) as z:
            plain = gzip.decompress(z.read(warc_packages.ARCHIVE))
        while plain:
            head, _, rest = plain.partition(b"\r\n\r\n")
            first, *lines = head.decode().split("\r\n")
            pairs = [line.split(": ", 1) for line in lines]
            fields = dict(pairs)
            assert first == "WARC/1.1" and len(fields) == len(pairs)
            n = int(fields["Content-Length"])
            assert rest[n : n + 4] == b"\r\n\r\n"
            records.append((fields, rest[:n]))
            plain = rest[n + 4 :]
    assert len(records) == len(rows) == sum(r.records for r in made)
    by_id = {f["WARC-Record-ID"]: f for f, _ in records}
    assert len(by_id) == len(rows) and all(re.fullmatch("<urn:uuid:[0-9a-f-]{36}>", i) for i in by_id)
    for f, block in records:
        assert f["WARC-Date"] == "2024-02-29T23:59:58Z"
        assert re.fullmatch(r"[A-Za-z][A-Za-z0-9+.-]*:[A-Za-z0-9%:/?#\[\]@!$&'()*+,;=._~-]+", f["WARC-Target-URI"])
        body = block.partition(b"\r\n\r\n")[2]
        if f["WARC-Type"] == "response":
            assert f["WARC-Payload-Digest"] == "sha1:" + hashlib.sha1(body).hexdigest() and "WARC-Profile" not in f
            continue
        assert f["WARC-Type"] == "revisit" and not body and f["WARC-Profile"].endswith("/revisit/identical-payload-digest")
        named = [g for g in by_id.values() if g.get("Page-ID") == f["Refers-To-Page-ID"] and g["WARC-Payload-Digest"] == f["WARC-Payload-Digest"]]
        assert {(g["WARC-Type"], g["WARC-Target-URI"], g["WARC-Date"]) for g in named} == {
            ("response", f["WARC-Refers-To-Target-URI"], f["WARC-Refers-To-Date"])
        }
        assert ("WARC-Refers-To" in f) == (len(named) == 1)
        assert "WARC-Refers-To" not in f or by_id[f["WARC-Refers-To"]] is named[0]
    assert sorted(f.get("Page-ID", "") for f, _ in records if f["WARC-Type"] == "revisit") == ["", "1", "2", "4"]
