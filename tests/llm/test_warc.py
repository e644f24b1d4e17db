"""WARC archives: round trips with odd pages, records by hand, transactions that name each other in several ways."""

import gzip
import hashlib
from collections import Counter

import pytest

from tallyfield.llm import warc

PAGES = "page_id long, url string, html string, type string, first long"
LONG = "a line of a page\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\n" * 3


def brute(pages, least=100):
    sizes = [(i, (h or "").encode()) for i, _, h in pages]
    first = {}
    for i, raw in sizes:
        if len(raw) >= least and i is not None:
            first[raw] = min(i, first.get(raw, i))
    out = []
    for i, raw in sizes:
        at = first.get(raw)
        again = at is not None and (i is None or i > at)
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", at if again else None))
    return Counter(out)


ODD = [
    (1, "http://a.example/", "<p>short</p>"), (2, "http://a.example/", "<p>short</p>"), (3, None, None), (4, "", ""), (5, "x\r\ny", LONG), (6, "http://b.example/?q", LONG),
    (2, "http://c.example/", LONG), (2, "http://d.example/", LONG), (None, "http://e.example/", LONG), (7, "u", "é" * 50), (8, "u", "é" * 50), (9, "u", "é" * 49), (10, "u", "é" * 49),
    (11, "u", "ends\r\n" * 30), (12, "u", "ends\r\n\r\n" * 30), (13, "u", "\r\n\r\n"), (14, "u", "\r\n\r\nWARC/1." * 20), (15, "u", "WARC/1.1\r\n" * 20), (16, "u", "x" * 3_000_000),
    (None, "u", "n" * 200), (None, "v", "n" * 200), (17, "u", "\x00\x1a﻿" * 60), (18, "u", "\r\r\n\r\n\r\nWARC/1" * 20), (None, "u", None), (None, "u", None),
]


def test_round_trip_of_odd_pages(spark):
    pages = spark.createDataFrame([(*p, "clash", 1) for p in ODD], PAGES)
    assert Counter(map(tuple, warc.archive(pages.repartition(3)).collect())) == brute(ODD)


def test_payloads_and_pages_come_back(spark, tmp_path):
    pages = spark.createDataFrame([(*p, "clash", 1) for p in ODD], PAGES).coalesce(2)
    warc.write_warc(pages, str(tmp_path / "a"))
    rows = warc.captures(warc.read_records(spark, str(tmp_path / "a"))).collect()
    assert len(rows) == len(ODD) and all(len(r.requests) == len(r.metadatas) == 1 and r.record.whole for r in rows)
    held = Counter(bytes(r.record.payload).decode() for r in rows if r.record.type == "response")
    want = Counter()
    for (i, _, h), kind in ((p, next(k for k in brute(ODD) if k[0] == p[0] and k[2] == hashlib.sha256((p[2] or "").encode()).hexdigest())) for p in ODD):
        want[h or ""] += kind[3] == "response"
    assert held == +want
    assert {r.record.target_uri for r in rows} >= {None, "x%0D%0Ay", "http://b.example/?q"}
    assert len({r.record.record_id for r in rows}) == len(ODD)


def record(kind, name, block=b"", more=()):
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", *more, f"Content-Length: {len(block)}"]
    return "\r\n".join(["WARC/1.0", *lines]).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_archives_of_others(spark, tmp_path):
    """Members gzipped record by record, headers in any case and folded, bytes that are no UTF-8, identifiers on either side."""
    http = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n\xff\xfe body"
    records = [
        record("warcinfo", "i", b"software: x\r\n", ["Content-Type: application/warc-fields"]),
        record("response", "r1", http, ["content-type: application/http;msgtype=response", "WARC-Target-URI:\thttp://x/", "WARC-Concurrent-To: <q1>", "WARC-Concurrent-To: <m1>"]),
        record("request", "q1", b"GET / HTTP/1.1\r\n\r\n", ["Content-Type: application/http"]),
        record("metadata", "m1", b"k: v\r\n  w\r\n", ["Content-Type: application/warc-fields"]),
        record("response", "r2", http, ["Content-Type: application/http"]),
        record("request", "q2", b"", ["WARC-Concurrent-To: <r2>"]),
        record("metadata", "m2", b"", ["WARC-Concurrent-To: <q2>"]),
        record("metadata", "m3", b"", ["WARC-Concurrent-To: <r2>", "WARC-Concurrent-To: <r1>"]),
        record("metadata", "lost", b"", ["WARC-Concurrent-To: <nowhere>"]),
        record("resource", "s", b"plain"),
    ]
    folder = tmp_path / "w"
    folder.mkdir()
    (folder / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    (folder / "b.warc").write_bytes(record("response", "cut", b"x" * 50)[:-20])
    (folder / "c.warc.gz").write_bytes(b"")
    found = warc.read_records(spark, str(folder))
    assert found.count() == len(records) + 1
    rows = {r.record.record_id[1:-1]: r for r in warc.captures(found).collect()}
    names = lambda x: [y.record_id[1:-1] for y in x or ()]
    assert {k: (names(r.requests), names(r.metadatas)) for k, r in rows.items()} == {
        "r1": (["q1"], ["m1", "m3"]), "r2": (["q2"], ["m2", "m3"]), "s": ([], []), "cut": ([], []),
    }
    assert bytes(rows["r1"].record.payload) == b"\xff\xfe body" and rows["r1"].metadatas[0].fields == {"k": "v w"}
    assert not rows["cut"].record.whole and rows["s"].record.whole and rows["cut"].record.payload_bytes == 34


def test_cuts_at_every_place_of_the_readers_buffers(spark, tmp_path):
    """A block that ends with line ends, laid so that the cut after it straddles the reader's 64 KiB in every way."""
    folder = tmp_path / "w"
    folder.mkdir()
    size = len(record("request", "q", b"", [])) - 4
    for k in range(40):
        block = b"x" * (65536 - size - 20 + k - len(str(65000)) + 1 - 4) + b"\r\n\r\n"
        (folder / f"{k}.warc.gz").write_bytes(gzip.compress(record("request", "q", block) + record("metadata", "m", b"end") + record("metadata", "n", b"")))
    rows = warc.read_records(spark, str(folder)).collect()
    assert Counter((r.record_id, r.payload_bytes if r.record_id != "<q>" else None, r.whole) for r in rows) == {("<q>", None, True): 40, ("<m>", 3, True): 40, ("<n>", 0, True): 40}


def test_plain_archives_are_not_read_in_pieces(spark, tmp_path):
    (tmp_path / "big.warc").write_bytes(b"".join(record("resource", f"n{k}", b"x" * 1000) for k in range(2000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500k")
    try:
        with pytest.raises(Exception, match="read in pieces"):
            warc.read_records(spark, str(tmp_path / "big.warc")).count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert warc.read_records(spark, str(tmp_path / "big.warc")).count() == 2000


def test_revisits_of_missing_responses(spark, tmp_path):
    more = ["Content-Type: application/http", "WARC-Refers-To: <gone>", "WARC-Payload-Digest: sha256:abc"]
    (tmp_path / "a.warc").write_bytes(record("revisit", "v", b"HTTP/1.1 200 OK\r\n\r\n", more))
    row = warc.page_captures(warc.captures(warc.read_records(spark, str(tmp_path / "a.warc")))).first()
    assert tuple(row) == (None, None, "abc", "revisit", None)


def test_empty_table(spark):
    assert warc.archive(spark.createDataFrame([], PAGES)).collect() == []
