"""ARC and WARC: parsers on hand-made files, the whole way on odd pages; the query has SQL, which test_exact_dedup compares."""

import gzip
import hashlib

import pytest

from daygrain.llm import arc
from daygrain.llm.common import Scratch

HTTP = b"HTTP/1.0 200 OK\r\nServer: x\r\n\r\n"


def version_1(*records, origin=b"19981231"):
    block = b"1 0 Museum\nURL IP-address Archive-date Content-type Archive-length\n"
    head = b"filedesc://old-0001.arc 10.0.0.9 %s text/plain %d\n" % (origin, len(block))
    return [head + block + b"\n", *[b"%s 10.1.2.3 %s %s %d\n%s\n" % (u, d, m, len(b), b) for u, d, m, b in records]]


def version_2(*records):
    block = b"2 0 Museum\nURL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length\n"
    head = b"filedesc://old-0002.arc 0.0.0.0 20010203040506 text/plain 200 - - 0 old-0002.arc %d\n" % len(block)
    return [head + block + b"\n", *[
        b"%s 10.1.2.3 %s %s 404 c0ffee - 99 old-0002.arc %d\n%s\n" % (u, d, m, len(b), b) for u, d, m, b in records
    ]]


RECORDS = [
    (b"http://a.example/x y", b"20000102030405", b"text/html", HTTP + b"<p>one\n\nhttp://b 1 2 3 4\n"),
    (b"dns:a.example", b"200001020304", b"text/dns", b"20000102\na.example 60 IN A 10.1.2.3\n"),
    (b"http://a.example/raw", b"unknown", b"image/gif", bytes(range(256))),
    (b"http://a.example/none", b"20000102", b"text/html", b""),
]


@pytest.mark.parametrize("build", [version_1, version_2])
@pytest.mark.parametrize("pack", [b"".join, lambda r: gzip.compress(b"".join(r)), lambda r: b"".join(map(gzip.compress, r))])
def test_records_of_both_versions(build, pack):
    found = list(arc.arc_records(pack(build(*RECORDS))))
    assert [r["kind"] for r in found] == ["metadata", "response", "resource", "resource", "resource"]
    assert [r["url"] for r in found[1:]] == ["http://a.example/x y", "dns:a.example", "http://a.example/raw", "http://a.example/none"]
    assert found[1]["head"] == HTTP and found[1]["payload"] == RECORDS[0][3].removeprefix(HTTP)
    assert found[3]["payload"] == bytes(range(256)) and found[4]["payload"] == b""
    first = "1998-12-31T00:00:00Z" if build is version_1 else "2001-02-03T04:05:06Z"
    assert [r["date"] for r in found] == [first, "2000-01-02T03:04:05Z", "2000-01-02T03:04:00Z", first, "2000-01-02T00:00:00Z"]
    assert not any(r["truncated"] for r in found)


def test_declared_lengths_rule():
    whole = b"".join(version_1(*RECORDS[:1]))
    cut = list(arc.arc_records(whole[:-10]))
    assert cut[1]["truncated"] and cut[1]["payload"] + b" 1 2 3 4\n" == RECORDS[0][3].removeprefix(HTTP)
    with pytest.raises(ValueError, match="old.arc: no ARC header line at byte"):
        list(arc.arc_records(whole + b"no header\n", "old.arc"))
    bare = b"http://a.example/ 1.2.3.4 20000102030405 text/html 3\nabc\n"
    assert [(r["kind"], r["payload"]) for r in arc.arc_records(bare)] == [("resource", b"abc")]
    assert list(arc.arc_records(b"")) == []


BIG, OTHER = "<p>" + "ä" * 600, "y" * 1000
PAGES = [
    (5, "http://a.example/1", BIG), (9, "https://b.example/a b\n", BIG), (2, None, BIG), (None, "", BIG), (9, "http://c.example/", BIG),
    (7, "http://d.example/", OTHER), (6, "http://d.example/", OTHER), (1, "u", "z" * 999), (3, "u", "z" * 999), (4, "v", None),
    (8, "v", ""), (10, "filedesc://x", "WARC/1.1\r\n\r\n" * 90), (11, "w", "long " * 200_000), (12, "w", "long " * 200_000),
]
SCHEMA = "page_id long, url string, html string, archive string, place int, digest string"


@pytest.mark.parametrize("size", [1, 64 << 20])
def test_pages_there_and_back(spark, monkeypatch, size):
    monkeypatch.setattr(arc, "ARCHIVE_BYTES", size)
    pages = spark.createDataFrame([(*p, "a", 1, "d") for p in PAGES], SCHEMA).repartition(3)
    rows = arc.archived(pages).collect()
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest) for r in rows) == sorted(
        (str(i), len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest()) for i, _, h in PAGES
    )
    said = sorted((str(r.page_id), r.record_type, r.refers_to) for r in rows)
    nines = [s for s in said if s[0] == "9"]
    assert sorted(nines) == [("9", "response", None), ("9", "revisit", 9)]
    revisits = {(i, 9) for i in ("5", "2", "None")} | {("6", 7), ("11", 12)}
    assert {(i, to) for i, kind, to in said if kind == "revisit"} == revisits | {("9", 9)}
    assert all(to is None for _, kind, to in said if kind == "response")
    urls = {r.page_id: r.url for r in rows if r.page_id != 9}
    assert urls[2] == urls[None] == "-" and urls[10] == "filedesc://x"
    assert {r.url for r in rows if r.page_id == 9} == {"https://b.example/a%20b%0A", "http://c.example/"}


def test_archives_are_whole_and_repeatable(spark, monkeypatch):
    monkeypatch.setattr(arc, "ARCHIVE_BYTES", 3000)
    pages = spark.createDataFrame([p for p in PAGES], "page_id long, url string, html string").coalesce(1)
    texts = []
    for _ in range(2):
        scratch = Scratch(spark, "t")
        arc.write_arcs(pages, f"{scratch.path}/arc")
        arc.convert(spark, f"{scratch.path}/arc", f"{scratch.path}/warc", scratch)
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{scratch.path}/warc").collect()
        kinds = []
        for f in files:
            found = list(arc.warc_records(bytes(f.content)))
            kinds.append([h["warc-type"] for h, _ in found])
            for head, block in found:
                assert int(head["content-length"]) == len(block)
                if head["warc-type"] == "response":
                    assert head["warc-block-digest"] == arc._sha1(block)
                if head["warc-type"] == "revisit":
                    assert head["warc-refers-to"] and block.endswith(b"\r\n\r\n") and head["warc-profile"] == arc.IDENTICAL
        assert all(k[0] == "warcinfo" and "warcinfo" not in k[1:] for k in kinds if k)
        versions = {r["mime"] for f in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{scratch.path}/arc").collect()
                    for r in arc.arc_records(bytes(f.content))}
        assert versions == {"text/plain", "text/html"}
        back = arc.resolved(arc.read_warcs(spark, f"{scratch.path}/warc"), scratch)
        texts.append(sorted((r.id, str(r.page_id), r.kind, str(r.refers_to)) for r in back.collect()))
    assert texts[0] == texts[1]


def test_no_rows(spark):
    assert arc.archived(spark.createDataFrame([], SCHEMA)).collect() == []
