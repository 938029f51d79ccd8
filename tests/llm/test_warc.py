import gzip
import hashlib
import os

import pytest

from orderloom.llm import warc as w

BIG = "x" * 200
TRICKY = ["\r\n\r\nWARC/1.1\r\n\r\n\r\n", "\r\n" * 90, "é\r\n\r\n" * 60, "\r\n", "a\r\n\r", "", "\r\n\r\n\r\nb", "\r\r\n\r\n\n\r\n\r" * 20]


@pytest.fixture
def pages(spark):
    rows = [(1, "http://a/1", BIG), (2, "http://a/2", BIG), (2, "http://a/2", BIG), (3, None, None), (None, "n", BIG), (4, "u\r\nX: y", "short")]
    rows += [(10 + k, "t", t) for k, t in enumerate(TRICKY)] + [(30, "s", "short")]
    return spark.createDataFrame([(*r, "own", "own") for r in rows], "page_id long, url string, html string, row string, payload string")


def test_round_trip(spark, pages, folder):
    path = f"{folder}/warc"
    w.write_captures(pages, path)
    found = w.resolve_revisits(w.captures(w.read_records(spark, path)))
    rows = found.withColumn("page_id", w.page_id_of(found)).collect()
    assert len(rows) == pages.count()
    html = {str(r.page_id): r.html or "" for r in pages.collect()}
    kinds = {}
    for r in rows:
        assert (r.n_requests, r.n_metadata) == (1, 1) and r.request.http_head.startswith("GET ")
        kinds.setdefault(r.page_id, []).append(r.response.type)
        raw = html[str(r.page_id)].encode()
        if r.response.type == "response":
            assert bytes(r.response.payload) == raw and r.response.payload_digest == hashlib.sha256(raw).hexdigest()
        else:
            assert r.original.page_id == "1" and r.original.payload_bytes == 200 and r.response.payload_bytes == 0
    assert kinds["1"] == ["response"] and kinds["2"] == ["revisit"] * 2 and kinds[None] == ["revisit"]
    assert kinds["4"] == kinds["30"] == ["response"]
    files = [f for f in os.listdir(path) if f.endswith(".gz")]
    assert files and all(gzip.open(f"{path}/{f}").read(8) == b"WARC/1.1" for f in files)


def record(kind, rid, block=b"", **fields):
    head = [b"WARC/1.0", b"WARC-Type: " + kind, b"WARC-Record-ID: " + rid, b"Content-Length: %d" % len(block)]
    head += [k.replace("_", "-").encode() + b": " + v for k, vs in fields.items() for v in (vs if isinstance(vs, list) else [vs])]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_foreign_archives(spark, folder):
    """A member per record, links in both directions, several requests, a record cut off, and binary payloads."""
    answer = b"HTTP/1.1 200 OK\r\n\r\n\xff\xfe\r\n\r\nbody"
    parts = [
        record(b"warcinfo", b"<i>", b"software: x"),
        record(b"response", b"<r1>", answer, Content_Type=b"application/http; msgtype=response", WARC_Concurrent_To=[b"<q1>", b"<q0>"]),
        record(b"request", b"<q1>", b"GET / HTTP/1.1\r\n\r\n"),
        record(b"request", b"<q0>", b"GET /0 HTTP/1.1\r\n\r\n", WARC_Concurrent_To=b"<r1>"),
        record(b"metadata", b"<m1>", b"a: b", WARC_Concurrent_To=b"<r1>"),
        record(b"metadata", b"<m9>", b"a: b", WARC_Concurrent_To=b"<gone>"),
        record(b"response", b"<r2>", b"cut off before its end")[:-12],
    ]
    with open(f"{folder}/a.warc.gz", "wb") as f:
        f.write(b"".join(gzip.compress(p) for p in parts))
    rows = {r.record_id: r for r in w.captures(w.read_records(spark, folder)).collect()}
    assert set(rows) == {"<r1>", "<r2>"}
    one = rows["<r1>"]
    assert bytes(one.response.payload) == b"\xff\xfe\r\n\r\nbody"
    assert (one.n_requests, one.request.record_id, one.n_metadata, one.metadata.record_id) == (2, "<q0>", 1, "<m1>")
    assert rows["<r2>"].response.truncated and rows["<r2>"].request is None and not one.response.truncated


def test_empty_table(spark, pages, folder):
    w.write_captures(pages.where("false"), f"{folder}/none")
    assert w.captures(w.read_records(spark, f"{folder}/none")).collect() == []
