"""Web archives in ZIP packages: written by tasks, read back by ranges.

A package is a ZIP file whose members are stored, not compressed: an archive member
of WARC records, each its own gzip member, and an index member with one line per
record (offset and length inside the archive member). Reading takes the end of the
file, the central directory (with its ZIP64 parts), the local header of a member, the
index, and then only the ranges of the records; nothing is extracted.

Equal payloads of ``least`` bytes or more are written once: the record with the
largest id is the response, the others are revisits that name it.

Records carry what WARC 1.1 asks of them: type, date, an id of their own and a target;
a revisit its profile and the target and date of its response. Page ids stand in fields
of our own (``Page-ID``, ``Refers-To-Page-ID``). A record's id follows from page id and
digest, so a revisit can name its response's; rows that repeat both get random ids, and
a revisit of such a response names it by target and date alone.

Files go through ``pyarrow.fs``, so a package may lie on any store that it knows. A
task writes under a name of its own; only packages that the finished job reports are
read, so an attempt that died leaves nothing behind that counts.

Defined cases: null html is an empty payload; payloads below ``least`` are always
responses; repeated rows of one id each get a record, and the first of them (by url)
is the response where it has the largest id; a row without id is never referred to;
a null or empty url has the target ``about:invalid`` and is null when read back; what no
URI may hold is percent-encoded; an empty table writes no package; other columns are not
looked at.
"""

from __future__ import annotations

import datetime as dt
import gzip
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from io import BytesIO
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.shared import shuffle_count, stored
from tidegate.session import scratch_dir

LEAST_BYTES = 1000
PACKAGE_BYTES = 32 << 20
RANGE_BYTES = 4 << 20
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.jsonl"


# --- ZIP: writing ----------------------------------------------------------------


class StoredZip:
    """Writes stored members one after another; ``wide`` forces the ZIP64 forms."""

    def __init__(self, out, wide: bool = False):
        self.out, self.at, self.wide, self.members = out, 0, wide, []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, name: str, data: bytes) -> None:
        raw, crc, begin = name.encode(), zlib.crc32(data), self.at
        big = self.wide or len(data) >= 0xFFFFFFFF
        extra = struct.pack("<HHQQ", 1, 16, len(data), len(data)) if big else b""
        size = 0xFFFFFFFF if big else len(data)
        self._put(struct.pack("<IHHHHHIIIHH", 0x04034B50, 45 if big else 20, 0x800, 0, 0, 0x21, crc, size, size,
                              len(raw), len(extra)) + raw + extra)
        self._put(data)
        self.members.append((raw, crc, len(data), begin))

    def close(self) -> None:
        begin = self.at
        for raw, crc, size, at in self.members:
            big = self.wide or size >= 0xFFFFFFFF or at >= 0xFFFFFFFF
            extra = struct.pack("<HHQQQ", 1, 24, size, size, at) if big else b""
            s, a = (0xFFFFFFFF, 0xFFFFFFFF) if big else (size, at)
            self._put(struct.pack("<IHHHHHHIIIHHHHHII", 0x02014B50, 45, 45 if big else 20, 0x800, 0, 0, 0x21, crc, s, s,
                                  len(raw), len(extra), 0, 0, 0, 0, a) + raw + extra)
        size, n = self.at - begin, len(self.members)
        if self.wide or begin >= 0xFFFFFFFF or n >= 0xFFFF:
            end = self.at
            self._put(struct.pack("<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, n, n, size, begin))
            self._put(struct.pack("<IIQI", 0x07064B50, 0, end, 1))
            n, size, begin = 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF
        self._put(struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, n, n, size, begin, 0))


# --- ZIP: reading ----------------------------------------------------------------


def _range(file, at: int, size: int) -> bytes:
    file.seek(at)
    data = file.read(size)
    if len(data) != size:
        raise ValueError(f"{size} bytes wanted at {at}, {len(data)} there")
    return data


def directory(file, size: int) -> dict[str, tuple[int, int, int]]:
    """Members of a ZIP file: name -> (method, stored size, place of the local header)."""
    tail = _range(file, max(0, size - 65_557), min(size, 65_557))
    found = tail.rfind(b"PK\x05\x06")
    while found >= 0 and found + 22 + int.from_bytes(tail[found + 20 : found + 22], "little") != len(tail):
        found = tail.rfind(b"PK\x05\x06", 0, found)
    if found < 0:
        raise ValueError("no end of a central directory")
    count, length, begin = struct.unpack("<HII", tail[found + 10 : found + 20])
    end = size - len(tail) + found
    shift = end - length - begin  # bytes in front of the archive
    if 0xFFFF == count or 0xFFFFFFFF in (length, begin):
        mark, _, wide, _ = struct.unpack("<IIQI", _range(file, end - 20, 20))
        if mark == 0x07064B50:
            record = _range(file, wide, 56)
            if record[:4] != b"PK\x06\x06":
                raise ValueError("no ZIP64 end record where its locator points")
            count, length, begin = struct.unpack("<QQQ", record[32:56])
            shift = 0
    data, at, out = _range(file, begin + shift, length), 0, {}
    for _ in range(count):
        head = struct.unpack("<IHHHHHHIIIHHHHHII", data[at : at + 46])
        if head[0] != 0x02014B50:
            raise ValueError("broken central directory")
        method, stored_size, plain_size, place = head[4], head[8], head[9], head[16]
        names, extras, comment = head[10:13]
        name = data[at + 46 : at + 46 + names]
        extra = data[at + 46 + names : at + 46 + names + extras]
        while len(extra) >= 4:
            kind, n = struct.unpack("<HH", extra[:4])
            if kind == 1:
                fields = [x for (x,) in struct.iter_unpack("<Q", extra[4 : 4 + n - n % 8])]
                if plain_size == 0xFFFFFFFF:
                    plain_size = fields.pop(0)
                if stored_size == 0xFFFFFFFF:
                    stored_size = fields.pop(0)
                if place == 0xFFFFFFFF:
                    place = fields.pop(0)
            extra = extra[4 + n :]
        out[name.decode()] = (method, stored_size, place + shift)
        at += 46 + names + extras + comment
    return out


def member(file, entry: tuple[int, int, int]) -> tuple[int, int]:
    """Place and size of a stored member's bytes."""
    method, size, place = entry
    head = _range(file, place, 30)
    if head[:4] != b"PK\x03\x04" or method:
        raise ValueError("not a stored member")
    names, extras = struct.unpack("<HH", head[26:30])
    return place + 30 + names + extras, size


# --- records ---------------------------------------------------------------------


NO_TARGET = "about:invalid"
# What RFC 3986 allows in a URI beside letters and digits, and the standard's name for equal payloads.
URI_MARKS = "%:/?#[]@!$&'()*+,;=-._~"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def target(url: str | None) -> str:
    return quote(url, safe=URI_MARKS) if url else NO_TARGET


def record_id(page_id: int | None, digest: str, unique: bool) -> str:
    """An id that follows from page and payload where no other record has both."""
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"page:{page_id}:{digest}") if unique else uuid.uuid4()
    return f"<urn:uuid:{name}>"


def record(page: dict, payload: bytes, digest: str, date: str) -> bytes:
    """One WARC record as a gzip member; a revisit (``refers_to`` is set) has no payload of its own."""
    refers = page["refers_to"]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (payload if refers is None else b"")
    fields = [
        ("WARC-Type", "response" if refers is None else "revisit"),
        ("WARC-Record-ID", record_id(page["page_id"], digest, not page["repeats"])),
        ("WARC-Date", date),
        ("WARC-Target-URI", target(page["url"])),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
    ]
    if page["page_id"] is not None:
        fields.append(("Page-ID", str(page["page_id"])))
    if refers is not None:
        fields += [
            ("WARC-Profile", PROFILE),
            ("WARC-Refers-To-Target-URI", target(page["refers_to_url"])),
            ("WARC-Refers-To-Date", date),
            ("Refers-To-Page-ID", str(refers)),
        ]
        if page["refers_to_one"]:
            fields.append(("WARC-Refers-To", record_id(refers, digest, True)))
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return gzip.compress(head.encode() + block + b"\r\n\r\n", compresslevel=1, mtime=0)


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Fields and payload of one gzip member."""
    plain = zlib.decompress(data, 31)
    head, _, rest = plain.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    return fields, rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")[2]


def _place(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


PLANNED = ("page_id", "url", "html", "refers_to", "refers_to_url", "refers_to_one", "repeats")


def _write(folder: str, package_bytes: int, date: str):
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _place(folder)
        warc, index = BytesIO(), []

        def close() -> pa.RecordBatch:
            name = f"{uuid.uuid4().hex}.wacz"
            with store.open_output_stream(f"{root}/{name}") as out:
                package = StoredZip(out)
                package.add(ARCHIVE, warc.getvalue())
                package.add(INDEX, "".join(json.dumps(x) + "\n" for x in index).encode())
                package.close()
                row = {"package": [f"{folder}/{name}"], "bytes": [package.at], "records": [len(index)]}
            warc.seek(0)
            warc.truncate()
            index.clear()
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            for values in zip(*[batch[c].to_pylist() for c in PLANNED], strict=True):
                page = dict(zip(PLANNED, values, strict=True))
                payload = (page.pop("html") or "").encode()
                data = record(page, payload, hashlib.sha1(payload).hexdigest(), date)
                index.append({"offset": warc.tell(), "length": len(data)})
                warc.write(data)
                if warc.tell() >= package_bytes:
                    yield close()
        if index:
            yield close()

    return work


def write_packages(pages: DataFrame, folder: str, least: int = LEAST_BYTES, date: dt.datetime | None = None) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) as packages below ``folder``: package, bytes, records.

    ``date`` (UTC; default: now) is the capture time of all records.
    """
    html = F.coalesce("html", F.lit(""))
    digest = F.sha1(html.cast("binary"))
    # Payloads stay out of this: one row per page and digest, then one per digest.
    payloads = pages.select("page_id", "url", digest.alias("digest"), F.octet_length(html).alias("n")).groupBy(
        "page_id", "digest").agg(F.min("url").alias("url"), F.max("n").alias("n"), F.count("*").alias("rows"))
    latest = (
        payloads.filter((F.col("n") >= least) & F.col("page_id").isNotNull())
        .groupBy("digest").agg(F.max(F.struct("page_id", "url", "rows")).alias("last"))
    )
    last, own = F.col("last.page_id"), F.col("n") >= least
    is_revisit = F.coalesce(own & ~F.col("page_id").eqNullSafe(last) & last.isNotNull(), F.lit(False))
    # Only what differs from a plain response is joined to the pages.
    marks = (
        payloads.join(latest, "digest", "left")
        .filter(is_revisit | (F.col("rows") > 1))
        .select(
            F.col("page_id").alias("marked"), F.col("digest"), (F.col("rows") > 1).alias("more"),
            F.when(is_revisit, last).alias("refers_to"), F.when(is_revisit, F.col("last.url")).alias("refers_to_url"),
            (F.col("last.rows") == 1).alias("one"),
        )
    )
    planned = (
        pages.select("page_id", "url", "html").alias("p")
        .join(marks.alias("m"), F.col("p.page_id").eqNullSafe(F.col("marked")) & (digest == F.col("m.digest")), "left")
        .select("p.page_id", "p.url", "p.html", "refers_to", "refers_to_url", F.coalesce("one", F.lit(False)).alias("refers_to_one"),
                F.coalesce("more", F.lit(False)).alias("repeats"))
    )
    stamp = (date or dt.datetime.now(dt.UTC)).strftime("%Y-%m-%dT%H:%M:%SZ")
    store, root = _place(folder)
    store.create_dir(root, recursive=True)
    return stored(planned.mapInArrow(_write(folder, PACKAGE_BYTES, stamp), "package string, bytes long, records long"),
                  "warc-manifest")


def _index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per run of neighbouring records, of about RANGE_BYTES."""
    for batch in batches:
        for package, size in zip(batch["package"].to_pylist(), batch["bytes"].to_pylist(), strict=True):
            store, path = _place(package)
            with store.open_input_file(path) as file:
                members = directory(file, size)
                begin, _ = member(file, members[ARCHIVE])
                lines = [json.loads(x) for x in _range(file, *member(file, members[INDEX])).splitlines()]
            places: list[int] = []
            runs: list[list[int]] = []
            for x in lines:
                if not runs or sum(runs[-1]) + x["length"] > RANGE_BYTES:
                    places.append(begin + x["offset"])
                    runs.append([])
                runs[-1].append(x["length"])
            if runs:
                yield pa.RecordBatch.from_pydict({
                    "package": [package] * len(runs), "at": places,
                    "lengths": pa.array(runs, pa.list_(pa.int64())),
                })


def _records(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("page_id", "url", "record_type", "refers_to", "payload_digest", "payload")
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                        ("refers_to", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])

    def number(text: str | None) -> int | None:
        return int(text) if text is not None else None

    for batch in batches:
        for package, at, lengths in zip(*[batch[c].to_pylist() for c in ("package", "at", "lengths")], strict=True):
            store, path = _place(package)
            with store.open_input_file(path) as file:
                data = _range(file, at, sum(lengths))
            out: dict[str, list] = {n: [] for n in names}
            begin = 0
            for n in lengths:
                fields, payload = parse(data[begin : begin + n])
                begin += n
                revisit = fields["WARC-Type"] == "revisit"
                digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                if not revisit and hashlib.sha1(payload).hexdigest() != digest:
                    raise ValueError(f"damaged payload in {package}")
                uri = fields["WARC-Target-URI"]
                values = (number(fields.get("Page-ID")), None if uri == NO_TARGET else uri, fields["WARC-Type"],
                          number(fields.get("Refers-To-Page-ID")), digest, None if revisit else payload)
                for k, v in zip(names, values, strict=True):
                    out[k].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=schema)


def read_packages(packages: DataFrame) -> DataFrame:
    """``packages`` (package, bytes): one row per record; a revisit's payload is null."""
    ranges = packages.select("package", "bytes").repartition(shuffle_count(packages.sparkSession), "package").mapInArrow(
        _index, "package string, at long, lengths array<long>"
    )
    return ranges.repartition(shuffle_count(packages.sparkSession), "package", "at").mapInArrow(
        _records,
        "page_id long, url string, record_type string, refers_to long, payload_digest string, payload binary",
    )


def archived(spark: SparkSession, pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """Writes ``pages``, reads them back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    packages = write_packages(pages, scratch_dir(spark, "warc"), least)
    records = stored(
        read_packages(packages).select(
            "page_id", F.octet_length("payload").cast("long").alias("own_bytes"), "payload_digest", "record_type", "refers_to"
        ),
        "warc-records",
    )
    # A revisit's payload is that of the response it names.
    full = (
        records.filter("record_type = 'response'").groupBy("payload_digest").agg(F.max("own_bytes").alias("full_bytes"))
    )
    revisits = records.filter("record_type = 'revisit'").join(full, "payload_digest")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return (
        records.filter("record_type = 'response'").withColumnRenamed("own_bytes", "payload_bytes").select(columns)
        .union(revisits.withColumnRenamed("full_bytes", "payload_bytes").select(columns))
    )
