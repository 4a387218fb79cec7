"""Legacy ARC archives to WARC: read by header lines and declared lengths, rewritten with revisits, read back.

An ARC file begins with a version block whose second line names the fields of all later header
lines: five in version 1 (URL IP-address Archive-date Content-type Archive-length), ten in version 2
(with Result-code, Checksum, Location, Offset and Filename before the length). Each record is one header line and as
many bytes as it declares. Files may be plain or gzip, with one member or one per record.

What ARC lacks is made up from what it has: the record id is a name-based UUID of archive and place,
so a repeated run gives the same; 8, 12 or 14 digit dates become ISO times, an unreadable one is taken from the version block; a
block that begins like HTTP is a `response`, any other one a `resource`, the version block `metadata`;
digests are SHA-1 of block and payload. Of records with one payload of at least `MIN_REVISIT` bytes
one stays a response and the others become revisits of it, without payload.

Archives are rows of the text writer, partitioned by a number that each task counts up whenever its
archive is full. So any Hadoop file system will do, a repeated task writes the same files, and an
archive is at most `ARCHIVE_BYTES` and one record. Readers get whole files and decompress them as a stream.

NULL and empty URLs are written as `-`; white space and control characters in a URL are percent-encoded. A NULL text
is an empty payload, a NULL id is no id. Very long texts are records like any other, up to the 2 GB of
a file in one row. Equal payloads: the largest id stays a response, then the last place; repeated rows are
records of their own. A declared length beyond the end of a file gives a truncated record; a header
line that cannot be read stops the job with its archive and offset. Extra columns are not read. Empty tables give
an archive with nothing but its version block, or none, and no rows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.llm.common import Scratch, attach, hot_keys

MIN_REVISIT = 1000
# Bytes of an archive before compression, and of a batch of records that a task hands on.
ARCHIVE_BYTES = 64 << 20
BATCH_BYTES = 8 << 20

# The names of header fields by ARC version, and the media types and profile of WARC records.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
HTTP_RESPONSE = "application/http; msgtype=response"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# The header line of the page's number in the HTTP block, which both kinds of archive keep.
PAGE_HEADER = "X-Page-Id"
_PAGE = re.compile(rb"\r\n" + PAGE_HEADER.encode() + rb": (-?\d+)\r\n")
_DRAWN = re.compile(r"(part-\d+)-[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}")
_UNSAFE = re.compile(rb"[\x00-\x20\x7f]")
_NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:daygrain:arc")
_NO_DATE = "19700101000000"


def _stream(content: bytes) -> io.BufferedIOBase:
    return gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


# ---- ARC out


def _url_field(url: str | None) -> bytes:
    if not url:
        return b"-"
    return _UNSAFE.sub(lambda m: b"%%%02X" % m[0][0], url.encode("utf-8", "surrogatepass"))


def _arc_head(name: str, version: int) -> bytes:
    block = f"{version} 0 daygrain\n{FIELDS[version]}\n".encode()
    rest = ["0.0.0.0", _NO_DATE, "text/plain", *(["200", "-", "-", "0", name] if version == 2 else []), str(len(block))]
    return " ".join([f"filedesc://{name}", *rest]).encode() + b"\n" + block


def _arc_record(name: str, version: int, page_id: int | None, url: str | None, payload: bytes) -> bytes:
    number = b"" if page_id is None else b"%s: %d\r\n" % (PAGE_HEADER.encode(), page_id)
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n%s\r\n" % (len(payload), number)
    more = f"200 - - 0 {name} " if version == 2 else ""
    line = f" 0.0.0.0 {_NO_DATE} text/html {more}{len(head) + len(payload)}\n".encode()
    return b"".join((_url_field(url), line, head, payload))


class _Roll:
    """Numbers archives within a task and cuts its records into batches."""

    def __init__(self, opening):
        self.task, self.count, self.opening = TaskContext.get().partitionId(), 0, opening
        self.filled, self.place, self.rows, self.held = ARCHIVE_BYTES, 0, [], 0

    def add(self, make) -> Iterator[pa.RecordBatch]:
        """`make(name, number)` gives the bytes of a record in the archive at hand."""
        if self.filled >= ARCHIVE_BYTES:
            self.count += 1
            self.filled = 0
            self._put(self.opening(*self._at()))
        self._put(make(*self._at()))
        if self.held >= BATCH_BYTES:
            yield self.batch()

    def _at(self) -> tuple[str, int]:
        number = (self.task << 24) | self.count
        return f"{number:016x}", number

    def _put(self, record: bytes) -> None:
        self.rows.append((self._at()[1], self.place, record))
        self.place += 1
        self.filled += len(record)
        self.held += len(record)

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [(), (), ()]
        self.rows, self.held = [], 0
        kinds = (pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["archive", "place", "record"])


def _version(number: int) -> int:
    return 1 + number % 2


def _arcs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    roll = _Roll(lambda name, number: _arc_head(name, _version(number)))
    for batch in batches:
        for page_id, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            payload = (html or "").encode("utf-8", "surrogatepass")
            yield from roll.add(lambda name, n: _arc_record(name, _version(n), page_id, url, payload))  # noqa: B023
    yield roll.batch()


def _write(records: DataFrame, path: str, end: str) -> None:
    """One folder per archive; a row's bytes go out as they are, each followed by `end`."""
    (
        records.sortWithinPartitions("archive", "place")
        .select("archive", F.col("record").cast("string").alias("value"))
        .write.mode("overwrite").partitionBy("archive").option("lineSep", end).option("compression", "gzip").text(path)
    )


_ROLL = "archive long, place long, record binary"


def write_arcs(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Pages as ARC archives, half of them of version 1 and half of version 2."""
    rows = pages.select(F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html"))
    _write(rows.mapInArrow(_arcs, _ROLL), path, "\n")


# ---- ARC in


def _iso(digits: str, fallback: str) -> str:
    """`YYYYMMDD[hhmm[ss]]` as an ISO time in UTC."""
    for text in (digits, fallback, _NO_DATE):
        if re.fullmatch(r"\d{8}|\d{12}|\d{14}", text):
            t = text.ljust(14, "0")
            return f"{t[:4]}-{t[4:6]}-{t[6:8]}T{t[8:10]}:{t[10:12]}:{t[12:]}Z"
    raise AssertionError


def arc_records(content: bytes, name: str = "") -> Iterator[dict]:
    """The records of one file: kind, url, ip, date, mime, head, payload, truncated."""
    stream, names, dated, at, skip = _stream(content), None, "", 0, b"\r\n"
    while line := stream.readline():
        start, at = at, at + len(line)
        if not line.strip(skip):
            continue
        known = names or FIELDS[2 if line.count(b" ") >= 9 else 1].lower().split()
        # What is too much belongs to the URL, which old crawlers wrote with blanks in it.
        values = line.rstrip(b"\r\n").rsplit(b" ", len(known) - 1)
        field = dict(zip(known, (v.decode("utf-8", "replace") for v in values), strict=False))
        length = field.get("archive-length", "")
        if len(values) != len(known) or not length.isdigit():
            raise ValueError(f"{name}: no ARC header line at byte {start}: {line[:200]!r}")
        block = stream.read(int(length))
        at += len(block)
        opening = names is None and field["url"].startswith("filedesc:")
        if opening:
            lines = block.decode("utf-8", "replace").splitlines()
            names, dated = (lines[1] if len(lines) > 1 else FIELDS[1]).lower().split(), field["archive-date"]
        elif names is None:
            names = known
        http = block.startswith(b"HTTP/")
        head, mark, payload = block.partition(b"\r\n\r\n") if http else (b"", b"", block)
        yield {
            "kind": "metadata" if opening else "response" if http else "resource",
            "url": field["url"], "ip": field["ip-address"], "mime": field["content-type"],
            "date": _iso(field["archive-date"], dated), "head": head + mark, "payload": payload,
            "truncated": len(block) < int(length),
        }


def _page_of(head: bytes) -> int | None:
    found = _PAGE.search(head)
    return int(found[1]) if found else None


_INDEX = pa.schema([
    ("archive", pa.string()), ("place", pa.int64()), ("id", pa.string()), ("kind", pa.string()),
    ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("digest", pa.binary()),
])
_WHOLE = pa.schema([
    *_INDEX, ("url", pa.string()), ("ip", pa.string()), ("date", pa.string()), ("mime", pa.string()),
    ("truncated", pa.bool_()), ("head", pa.binary()), ("payload", pa.binary()),
])
_SPARK = {pa.string(): "string", pa.int64(): "long", pa.binary(): "binary", pa.bool_(): "boolean"}


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {_SPARK[f.type]}" for f in schema)


def _parsed(whole: bool):
    schema = _WHOLE if whole else _INDEX

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                # Folder and file name identify an archive wherever its root is mounted, without what Spark draws.
                name = _DRAWN.sub(r"\1", "/".join(path.as_py().split("/")[-2:]))
                rows, held = [], 0
                for place, r in enumerate(arc_records(content.as_buffer().to_pybytes(), name)):
                    r |= {
                        "archive": name, "place": place, "id": str(uuid.uuid5(_NAMESPACE, f"{name}#{place}")),
                        "page_id": _page_of(r["head"]), "payload_bytes": len(r["payload"]),
                        "digest": hashlib.sha1(r["payload"]).digest(),
                    }
                    rows.append({k: r[k] for k in schema.names})
                    held += 200 + (len(r["payload"]) if whole else 0)
                    if held >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    return read


def _files(spark: SparkSession, path: str) -> DataFrame:
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return found.where("length > 0").select("path", "content")


def read_arcs(spark: SparkSession, path: str, whole: bool = True) -> DataFrame:
    """One row per ARC record; without `whole` only what identifies it and its payload."""
    return _files(spark, path).mapInArrow(_parsed(whole), _ddl(_WHOLE if whole else _INDEX))


# ---- WARC out


def _warc(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return f"WARC/1.1\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode() + block


def _warc_head(name: str, number: int) -> bytes:
    block = b"software: daygrain\r\nformat: WARC File Format 1.1\r\nconformsTo: http://iipc.github.io/warc-specifications/specifications/warc-format/warc-1.1/\r\n"
    fields = [
        ("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(_NAMESPACE, name)}>"),
        ("WARC-Date", _iso(_NO_DATE, "")), ("WARC-Filename", f"{name}.warc.gz"),
        ("Content-Type", "application/warc-fields"),
    ]
    return _warc(fields, block)


def _warc_record(r: dict) -> bytes:
    again = r["refers_to"] is not None
    block = r["head"] if again else r["head"] + r["payload"]
    kind = "revisit" if again else r["kind"]
    fields = [
        ("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{r['id']}>"), ("WARC-Date", r["date"]),
        ("WARC-Target-URI", r["url"]),
        ("WARC-IP-Address", None if r["ip"] in ("", "-", "0.0.0.0") else r["ip"]),
        ("WARC-Refers-To", f"<urn:uuid:{r['refers_to']}>" if again else None),
        ("WARC-Profile", IDENTICAL if again else None),
        ("WARC-Truncated", "length" if again else "unspecified" if r["truncated"] else None),
        ("Content-Type", HTTP_RESPONSE if r["head"] else r["mime"]),
        ("WARC-Block-Digest", _sha1(block)),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(r["digest"]).decode()),
        # Not among the named fields of the format, which allows others: the length of the payload left out.
        ("WARC-Payload-Length", str(r["payload_bytes"]) if again else None),
    ]
    return _warc(fields, block)


def _warcs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    roll = _Roll(_warc_head)
    for batch in batches:
        for r in batch.to_pylist():
            yield from roll.add(lambda name, n: _warc_record(r))  # noqa: B023
    yield roll.batch()


def convert(spark: SparkSession, arcs: str, warcs: str, scratch: Scratch) -> None:
    """The ARC archives below `arcs` as WARC archives below `warcs`."""
    index = scratch.save(read_arcs(spark, arcs, whole=False).where("kind = 'response'"), "index")
    best = F.max(F.struct("page_id", "archive", "place", "id")).alias("best")
    kept = (
        index.where(F.col("payload_bytes") >= MIN_REVISIT)
        .groupBy("digest").agg(F.count(F.lit(1)).alias("n"), best).where("n > 1")
        .select("digest", F.col("best.id").alias("stays"))
    )
    kept = scratch.save(kept, "kept")
    # Both sides come straight from their shuffle, so Spark splits a payload with very many copies.
    joined = read_arcs(spark, arcs).join(kept.hint("merge"), "digest", "left")
    again = (F.col("kind") == "response") & (F.col("stays") != F.col("id"))
    out = joined.withColumn("refers_to", F.when(again, F.col("stays"))).drop("stays")
    out = out.withColumn("payload", F.when(F.col("refers_to").isNull(), F.col("payload")))
    _write(out.mapInArrow(_warcs, _ROLL), warcs, "\r\n\r\n")


# ---- WARC in


def warc_records(content: bytes, name: str = "") -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of each record of one file."""
    stream = _stream(content)
    while line := stream.readline():
        if not line.strip(b"\r\n"):
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{name}: no WARC record at {line[:200]!r}")
        fields = {}
        while (line := stream.readline()).strip(b"\r\n"):
            key, _, value = line.decode("utf-8", "replace").partition(":")
            fields[key.strip().lower()] = value.strip()
        yield fields, stream.read(int(fields["content-length"]))


_BACK = pa.schema([
    ("id", pa.string()), ("kind", pa.string()), ("refers_to", pa.string()), ("url", pa.string()), ("date", pa.string()),
    ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
])


def _uuid(field: str | None) -> str | None:
    return field.removeprefix("<urn:uuid:").removesuffix(">") if field else None


def _back(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
            rows = []
            for fields, block in warc_records(content.as_buffer().to_pybytes(), path.as_py()):
                http = fields.get("content-type", "").startswith("application/http")
                head, mark, payload = block.partition(b"\r\n\r\n") if http else (b"", b"", block)
                said = fields.get("warc-payload-digest", "").removeprefix("sha1:")
                digest = base64.b32decode(said).hex() if said else hashlib.sha1(payload).hexdigest()
                again = fields["warc-type"] == "revisit"
                if not again and digest != hashlib.sha1(payload).hexdigest():
                    raise ValueError(f"{path}: payload of {fields['warc-record-id']} is not the one it was")
                rows.append({
                    "id": _uuid(fields["warc-record-id"]), "kind": fields["warc-type"],
                    "refers_to": _uuid(fields.get("warc-refers-to")), "url": fields.get("warc-target-uri"),
                    "date": fields["warc-date"], "page_id": _page_of(head + mark),
                    "payload_bytes": int(fields["warc-payload-length"]) if again else len(payload), "payload_digest": digest,
                })
            yield pa.RecordBatch.from_pylist(rows, _BACK)


def read_warcs(spark: SparkSession, path: str) -> DataFrame:
    """One row per WARC record; payloads are checked against their digests."""
    return _files(spark, path).mapInArrow(_back, _ddl(_BACK))


def resolved(records: DataFrame, scratch: Scratch) -> DataFrame:
    """Responses and revisits with `refers_page`, the page of the response that a revisit refers to."""
    rows = scratch.save(records.where("kind IN ('response', 'revisit')"), "back")
    asked = rows.where("refers_to IS NOT NULL").groupBy("refers_to").count().drop("count")
    met = rows.select(F.col("id").alias("refers_to"), F.col("page_id").alias("refers_page"))
    lookup = scratch.save(met.join(asked, "refers_to"), "targets")
    return attach(rows, lookup, "refers_to", scratch.save(hot_keys(rows, "refers_to"), "hot"))


def archived(pages: DataFrame) -> DataFrame:
    """Pages written as ARC, converted to WARC and read back: one row per page."""
    spark = pages.sparkSession
    scratch = Scratch(spark, "archives")
    arcs, warcs = f"{scratch.path}/arc", f"{scratch.path}/warc"
    write_arcs(pages, arcs)
    convert(spark, arcs, warcs, scratch)
    scratch.drop("arc")
    return resolved(read_warcs(spark, warcs), scratch).select(
        "page_id", "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), F.col("refers_page").alias("refers_to"),
        "url", "date", F.col("id").alias("record_id"),
    )
