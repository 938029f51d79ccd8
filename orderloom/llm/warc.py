"""WARC archives: captures written as request, response or revisit, and metadata records, and put together again.

Archives are gzip files written and read by Spark's text source, so they lie wherever Spark can reach. The record separator
CRLF CRLF serves as the line separator; records are cut by their ``Content-Length``, so payloads may contain it. A gzip
file is read front to back by one task as a stream: memory is bounded by the largest record, not by the archive.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.shipping import ready

CRLF = "\r\n"
SEPARATOR = CRLF * 2
SEP = SEPARATOR.encode()
#: Payloads of fewer bytes are always stored in full.
MIN_REVISIT_BYTES = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _urn(kind: str, row: Column) -> Column:
    """A record id of the row, as a name-based UUID."""
    h = F.md5(F.concat(F.lit(kind + ":"), row.cast("string")))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(kind: Column, record_id: Column, uri: Column, date: Column, fields: list[tuple[str, Column]], block: Column) -> Column:
    """The text of one record without its final separator; fields with a null value are left out."""
    lines = [F.lit("WARC/1.1")]
    head = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", date), ("WARC-Target-URI", uri), *fields]
    lines += [F.concat(F.lit(f"{name}: "), value) for name, value in head]
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(SEPARATOR), block)


def mark_revisits(pages: DataFrame, page_id: str = "page_id", html: str = "html", min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``pages`` with ``payload_bytes``, ``payload_digest``, ``row`` and ``first`` (page id and row of the
    response that a revisit refers to; null for a response).

    Only digests and ids are grouped; where many pages share one payload, the groups are counted in the map tasks and
    the join that follows may split them.
    """
    payload = F.coalesce(F.col(html), F.lit(""))
    known = pages.withColumns(
        {
            "row": F.monotonically_increasing_id(),
            "payload": payload,
            "payload_bytes": F.octet_length(payload).cast("long"),
            "payload_digest": F.sha2(payload.cast("binary"), 256),
        }
    )
    order = F.struct(F.col(page_id).isNull().alias("no_id"), F.col(page_id).alias("page_id"), "row")
    firsts = (
        known.where(F.col("payload_bytes") >= min_bytes)
        .groupBy("payload_digest")
        .agg(F.min(order).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("payload_digest", "first")
    )
    joined = known.join(firsts, "payload_digest", "left")
    return joined.withColumn("first", F.when(F.col("first.row") != F.col("row"), F.col("first")))


def write_captures(
    pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", page_id: str = "page_id", url: str = "url", html: str = "html"
) -> None:
    """Write a request, a response or revisit, and a metadata record for every row, as gzip archives in ``path``.

    Of rows with equal payloads of at least 100 bytes, that with the smallest page id is the response
    (null ids come last; of repeated ids the row read first) and the others are revisits of it; smaller payloads are responses.
    A null html is an empty payload, a null url an empty target. Other columns of ``pages`` are not written.
    """
    uri = F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), r"[\r\n]", " ")
    slim = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html")
    )
    marked = mark_revisits(slim)
    revisit = F.col("first").isNotNull()
    main, when = _urn("capture", F.col("row")), F.lit(date)
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    answer = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(SEPARATOR),
        body,
    )
    digest = F.concat(F.lit("sha256:"), F.col("payload_digest"))
    captured = _record(
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        main,
        uri,
        when,
        [
            ("WARC-Payload-Digest", digest),
            ("WARC-Refers-To", F.when(revisit, _urn("capture", F.col("first.row")))),
            ("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
            ("Content-Type", F.lit("application/http; msgtype=response")),
        ],
        answer,
    )
    asked = _record(
        F.lit("request"),
        _urn("request", F.col("row")),
        uri,
        when,
        [("WARC-Concurrent-To", main), ("Content-Type", F.lit("application/http; msgtype=request"))],
        F.concat(F.lit("GET "), uri, F.lit(" HTTP/1.1\r\nAccept: text/html\r\n\r\n")),
    )
    noted = _record(
        F.lit("metadata"),
        _urn("metadata", F.col("row")),
        uri,
        when,
        [("WARC-Concurrent-To", main), ("Content-Type", F.lit("application/warc-fields"))],
        F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(CRLF)),
    )
    records = marked.select(F.explode(F.array(asked, captured, noted)).alias("value"))
    records.write.option("lineSep", SEPARATOR).option("compression", "gzip").text(path)


RECORD_SCHEMA = (
    "record_id string, type string, uri string, date string, concurrent_to array<string>, refers_to string, "
    "headers map<string, string>, http_head string, payload binary, payload_bytes long, payload_digest string, truncated boolean"
)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the gzip archives in ``path``, in any order.

    ``payload`` is the body for HTTP blocks and the block for others; ``payload_bytes`` and ``payload_digest`` (bare
    lower-case hex SHA-256) are of what is there, so those of a revisit are of its empty body. A record cut off at the end of its file is
    returned with ``truncated``. An archive without records gives no rows.
    """
    lines = spark.read.option("lineSep", SEPARATOR).text(path)
    ready(lines)
    raw = lines.select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"))
    return raw.mapInArrow(_parse, RECORD_SCHEMA)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, bytes, bool]]:
    """(head, block, cut off) of every record from pieces between separators, file by file."""
    file, head, parts, have, want = None, None, [], 0, 0
    for batch in batches:
        names, values = batch.column("file"), batch.column("value")
        for i in range(batch.num_rows):
            if (name := names[i].as_py()) != file:
                if head is not None:
                    yield head, SEP.join(parts), True
                file, head = name, None
            piece = values[i].as_py() or b""
            while piece is not None:
                if head is None:
                    piece = piece.lstrip(b"\r\n")
                    if not piece:
                        break
                    head, parts, have, want = piece, [], 0, _length(piece)
                    break
                parts.append(piece)
                have += len(piece) + len(SEP) * (len(parts) > 1)
                piece = None
                if have >= want:
                    block = SEP.join(parts)
                    yield head, block[:want], False
                    head, rest = None, block[want:]
                    piece = rest.lstrip(b"\r\n") or None
    if head is not None:
        yield head, SEP.join(parts), True


def _fields(head: bytes) -> list[tuple[str, str]]:
    out = []
    for line in head.decode("utf-8", "replace").split(CRLF)[1:]:
        name, colon, value = line.partition(":")
        if colon:
            out.append((name.strip().lower(), value.strip()))
    return out


def _length(head: bytes) -> int:
    value = dict(_fields(head)).get("content-length", "")
    return int(value) if value.isdigit() else 0


def _parse(batches: Iterator[pa.RecordBatch], size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [
            ("record_id", pa.string()), ("type", pa.string()), ("uri", pa.string()), ("date", pa.string()),
            ("concurrent_to", pa.list_(pa.string())), ("refers_to", pa.string()), ("headers", pa.map_(pa.string(), pa.string())),
            ("http_head", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
            ("truncated", pa.bool_()),
        ]
    )
    rows, held = [], 0
    for head, block, cut in _records(batches):
        fields = _fields(head)
        of = dict(fields)
        http, body = None, block
        if of.get("content-type", "").startswith("application/http"):
            top, _, body = block.partition(SEP)
            http = top.decode("utf-8", "replace")
        rows.append(
            {
                "record_id": of.get("warc-record-id"), "type": of.get("warc-type"), "uri": of.get("warc-target-uri"),
                "date": of.get("warc-date"), "concurrent_to": [v for k, v in fields if k == "warc-concurrent-to"],
                "refers_to": of.get("warc-refers-to"), "headers": list(of.items()), "http_head": http, "payload": body,
                "payload_bytes": len(body), "payload_digest": hashlib.sha256(body).hexdigest(), "truncated": cut,
            }
        )
        held += len(body) + 1000
        if held >= size:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)
            rows, held = [], 0
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def captures(records: DataFrame) -> DataFrame:
    """One row per response or revisit: ``record_id``, ``uri``, ``date``, and the nested ``response``,
    ``request`` and ``metadata``; the last two are null if no record names the capture.

    A request or metadata record belongs to the captures named by its concurrent-to fields, and to those that name it. Of several
    of one kind that belong to one capture, the one with the smallest record id is kept in the row, and ``n_requests``
    and ``n_metadata`` count them. Records repeated under one id count once; a capture without id gets neither.
    """
    kept = ["record_id", "uri", "date", "http_head", "payload", "payload_bytes", "payload_digest", "headers", "truncated"]
    main = records.where("type in ('response', 'revisit')")
    side = records.where("type in ('request', 'metadata')")
    named = main.where("size(concurrent_to) > 0").select(
        F.col("record_id").alias("capture"), F.explode("concurrent_to").alias("record_id")
    )
    fields = side.select("type", F.struct(*kept).alias("part"), "record_id", "concurrent_to")
    linked = (
        fields.select("type", "part", "record_id", F.explode("concurrent_to").alias("capture"))
        .unionByName(fields.join(named, "record_id").select("type", "part", "record_id", "capture"))
        .groupBy("capture", "type", "record_id")
        .agg(F.first("part").alias("part"))  # a record may be there more than once, and be linked both ways
        .groupBy("capture")
        .agg(
            *(
                x
                for kind in ("request", "metadata")
                for x in (
                    F.min_by(F.when(F.col("type") == kind, F.col("part")), F.when(F.col("type") == kind, F.col("record_id"))).alias(kind),
                    F.count(F.when(F.col("type") == kind, F.col("record_id"))).alias(f"n_{kind}"),
                )
            )
        )
        .withColumnRenamed("n_request", "n_requests")
    )
    joined = main.join(linked, main.record_id == linked.capture, "left")
    return joined.select(
        "record_id",
        "uri",
        "date",
        F.struct("type", "refers_to", *(c for c in kept if c not in ("record_id", "uri", "date"))).alias("response"),
        "request",
        "metadata",
        F.coalesce("n_requests", F.lit(0)).alias("n_requests"),
        F.coalesce("n_metadata", F.lit(0)).alias("n_metadata"),
    )


def page_id_of(capture: DataFrame) -> Column:
    """The page id that ``write_captures`` put into the metadata record."""
    block = capture["metadata.payload"].cast("string")
    return F.nullif(F.regexp_extract(block, r"page-id: ([^\r\n]*)", 1), F.lit(""))


def resolve_revisits(found: DataFrame) -> DataFrame:
    """``captures`` with ``original``: record id, page id, length and digest of the response that a
    revisit refers to, null for responses and for revisits whose response is not in the archives.

    Only revisits are joined. ``found`` is read three times: store it first where it is a long plan.
    """
    page = page_id_of(found)
    originals = found.where("response.type = 'response'").select(
        F.col("record_id").alias("_to"),
        F.struct(
            "record_id", page.alias("page_id"), F.col("response.payload_bytes").alias("payload_bytes"),
            F.col("response.payload_digest").alias("payload_digest"),
        ).alias("original"),
    )
    by_id = originals.groupBy("_to").agg(F.first("original").alias("original"))
    refers = F.coalesce(F.col("response.refers_to").isNotNull(), F.lit(False))
    joined = found.where(refers).withColumn("_from", F.col("response.refers_to"))
    resolved = joined.join(by_id, F.col("_from") == F.col("_to"), "left").select(*found.columns, "original")
    nothing = F.lit(None).cast(by_id.schema["original"].dataType).alias("original")
    return found.where(~refers).select("*", nothing).unionByName(resolved)
