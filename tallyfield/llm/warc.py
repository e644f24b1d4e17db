r"""WARC archives: written from pages, read record by record, assembled into captures.

Writing.  A capture is three records: request, response (or revisit) and metadata, the first
and last with WARC-Concurrent-To the second.  Spark's text writer makes the files: a row is a
capture's records, and the line separator is the two line ends that close a record, so tasks
commit whole gzipped archives and a lost executor costs a task.  Of captures with equal
payloads of at least LEAST_BYTES the one with the smallest page_id is the response; the others
are revisits that hold no payload and name it in WARC-Refers-To.

Reading.  Spark's text reader cuts archives at "\r\n\r\nWARC/1.", one record (or a piece of
one, where a payload holds that text; at times more than one, as the reader misses a cut that
straddles two of its buffers); where a record ends is told by its Content-Length alone.  A task
holds one record.  Archives are read from their start to their end, so gzipped
ones, which Spark never splits, may have any size; a plain one must fit
spark.sql.files.maxPartitionBytes, and reading fails where it is split.

Assembly.  Requests and metadata are joined to the captures that they are concurrent to:
identifiers may be named on either side, or on a record that is itself concurrent to the
capture.  Each capture is one nested row.  A revisit's payload size and page are those of the
response that it refers to.

Defined cases: null html is an empty payload; a null url has no WARC-Target-URI, line ends in
one are percent-encoded; a null page_id is never the first of its payload unless all are
null, and then all are responses; rows that repeat a page_id with one payload (ties) are all
responses if theirs is the smallest, and revisits refer to one of them; long payloads are
one record each; extra columns are ignored, whatever their names; an empty table gives an
empty table.  A record that its file cuts short is read with whole = false; a companion whose
capture is missing is in no capture; a revisit whose response is missing keeps the digest of
its header and has no size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import _shared as S

LEAST_BYTES = 100
DATE = "2020-01-01T00:00:00Z"
END = "\r\n\r\n"
_NEXT = END + "WARC/1."
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURES, COMPANIONS = ("response", "revisit", "resource"), ("request", "metadata")
RECORD = (
    "file string, type string, record_id string, target_uri string, date string, concurrent_to array<string>, refers_to string, "
    "digest string, fields map<string,string>, whole boolean, payload_bytes long, sha256 string, payload binary"
)


# Writing


def _record(kind: str | Column, record_id: Column, headers: dict[str, Column | str], block: Column) -> Column:
    """Text of a record without the two line ends that close it; headers that are null are left out."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    named = {"WARC-Type": kind, "WARC-Record-ID": record_id, "WARC-Date": F.lit(DATE), **headers, "Content-Length": F.octet_length(block).cast("string")}
    lines = [F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value) for name, value in named.items()]
    return F.concat(F.concat_ws("\r\n", F.lit("WARC/1.1"), *lines), F.lit(END), block)


def _record_id(kind: str, page_id: Column, digest: Column, nth: Column) -> Column:
    name = F.sha2(F.concat_ws("|", F.lit(kind), F.coalesce(page_id.cast("string"), F.lit("null")), digest, nth.cast("string")), 256)
    return F.regexp_replace(name, "^(.{8})(.{4})(.{4})(.{4})(.{12}).*$", "<urn:uuid:$1-$2-$3-$4-$5>")


def write_warc(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES) -> None:
    """Gzipped archives with the three records of every row."""
    page = F.col("page_id").cast("long").alias("page_id")
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
    rows = pages.select(page, F.col("url").cast("string").alias("url"), html).withColumn("digest", F.sha2("html", 256))
    seen = S.stage(pages.select(page, F.sha2(html, 256).alias("digest"), F.octet_length(html).alias("size")), "payloads")
    firsts = seen.filter(F.col("size") >= least_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1 and first is not null").drop("n")
    rows = S.join_hot(rows, firsts, "digest", "page_id")
    if seen.groupBy("page_id", "digest").count().filter("count > 1").isEmpty():
        rows = rows.withColumn("nth", F.lit(1))
    else:  # identifiers of repeated rows
        rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy("page_id", "digest").orderBy("url")))
    again = F.col("first").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") > F.col("first")))
    names = {kind: _record_id(kind, F.col("page_id"), F.col("digest"), F.col("nth")) for kind in ("request", "response", "metadata")}
    rows = rows.withColumns({"again": again, **{f"{kind}_id": name for kind, name in names.items()}})
    capture, uri = F.col("response_id"), F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    common = {"WARC-Target-URI": uri}
    host = F.regexp_extract(F.coalesce(uri, F.lit("")), "^[A-Za-z]+://([^/?#]*)", 1)
    request = _record(
        "request",
        F.col("request_id"),
        {**common, "WARC-Concurrent-To": capture, "Content-Type": "application/http; msgtype=request"},
        F.concat(F.lit("GET "), F.coalesce(uri, F.lit("/")), F.lit(" HTTP/1.1\r\nHost: "), host, F.lit(END)),
    )
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("html").cast("string"), F.lit(END))
    only_again = {
        "WARC-Refers-To": F.when(F.col("again"), _record_id("response", F.col("first"), F.col("digest"), F.lit(1))),
        "WARC-Profile": F.when(F.col("again"), _PROFILE),
        "WARC-Truncated": F.when(F.col("again"), "length"),
    }
    response = _record(
        F.when(F.col("again"), "revisit").otherwise("response"),
        capture,
        {**common, "WARC-Payload-Digest": F.concat(F.lit("sha256:"), F.col("digest")), **only_again, "Content-Type": "application/http; msgtype=response"},
        F.when(F.col("again"), http).otherwise(F.concat(http, F.col("html"))),
    )
    metadata = _record(
        "metadata",
        F.col("metadata_id"),
        {**common, "WARC-Concurrent-To": capture, "Content-Type": "application/warc-fields"},
        F.coalesce(F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit("\r\n")), F.lit("")),
    )
    rows.select(F.concat_ws(END, request, response, metadata).alias("value")).write.option("lineSep", END).option("compression", "gzip").text(path)


# Reading


def _headers(lines: bytes) -> list[tuple[str, str]]:
    """Names in lower case and values; a line that begins with white space goes on with the one before."""
    out: list[tuple[str, str]] = []
    for line in lines.decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {line.strip()}")
        elif ":" in line:
            name, _, value = line.partition(":")
            out.append((name.strip().lower(), value.strip(" \t")))
    return out


def _parsed(file: str, head: bytes, block: bytes, whole: bool, payloads: bool) -> tuple[int, tuple]:
    named = _headers(head)
    of = dict(reversed(named))  # the first of a name counts
    kind, content = of.get("warc-type"), of.get("content-type", "")
    payload = block
    if content.startswith("application/http"):
        payload = block.partition(b"\r\n\r\n")[2]
    fields = dict(_headers(block)) if content.startswith("application/warc-fields") else {}
    digest = of.get("warc-payload-digest", "").partition(":")[2] or None
    row = (
        file, kind, of.get("warc-record-id"), of.get("warc-target-uri"), of.get("warc-date"), [v for k, v in named if k == "warc-concurrent-to"],
        of.get("warc-refers-to"), digest, list(fields.items()), whole, len(payload), hashlib.sha256(payload).hexdigest(), payload if payloads else None,
    )
    return len(block) + 500, row


def _records(payloads):
    def rows(batches) -> Iterator[tuple[int, tuple]]:
        file, head, blocks, have, need = None, None, [], 0, 0

        def finish() -> tuple[int, tuple]:
            return _parsed(file, head, b"".join(blocks), have >= need, payloads)

        for batch in batches:
            files, starts, values = (batch.column(c) for c in ("file", "start", "value"))
            for k in range(batch.num_rows):
                value = values[k].as_py()
                if starts[k].as_py():
                    raise ValueError(f"{files[k]} is read in pieces: gzip it or raise spark.sql.files.maxPartitionBytes")
                if files[k].as_py() == file:
                    value = _NEXT.encode() + value
                elif value.startswith(b"WARC/1."):
                    if file is not None:
                        yield finish()
                    file, value, have, need = files[k].as_py(), END.encode() + value, 0, 0
                    blocks, head = [], None
                else:
                    raise ValueError(f"{files[k]} isn't a WARC archive")
                while True:
                    left = need - have  # of the block; what follows it is the next record
                    if left > 0:
                        blocks.append(value[:left])
                        have += len(blocks[-1])
                        value = value[left:]
                    if not value.startswith(_NEXT.encode()):
                        break
                    if head is not None:
                        yield finish()
                    head, _, value = value[len(_NEXT) :].partition(b"\r\n\r\n")
                    length = dict(reversed(_headers(head))).get("content-length", "")
                    blocks, have, need = [], 0, int(length) if length.isdigit() else len(value)
        if file is not None:
            yield finish()

    def run(batches, schema):
        yield from S.sized_batches(rows(batches), schema)

    return run


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row a record (RECORD); without payloads, that column is null, size and digest are still taken from the bytes."""
    pieces = spark.read.option("lineSep", _NEXT).text(path)
    found = pieces.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("value"))
    return S.map_arrow(found, _records(payloads), RECORD)


# Assembly


def captures(records: DataFrame) -> DataFrame:
    """A nested row for each response, revisit and resource: record, requests, metadata."""
    main, others = (records.filter(F.col("type").isin(*kinds)) for kinds in (CAPTURES, COMPANIONS))
    named = others.select("record_id", F.explode("concurrent_to").alias("other"))
    named = named.union(main.select(F.explode("concurrent_to"), "record_id")).distinct()
    direct = named.join(main.select(F.col("record_id").alias("other")), "other", "left_semi").select("record_id", F.col("other").alias("capture"))
    by_other = named.join(direct.select(F.col("record_id").alias("other"), "capture"), "other").join(direct.select("record_id"), "record_id", "left_anti")
    links = direct.union(by_other.select("record_id", "capture")).distinct()
    parts = others.join(links, "record_id").select("capture", "type", F.struct("record_id", "target_uri", "date", "fields", "payload_bytes", "payload").alias("part"))
    arrays = {f"{kind}s": F.array_sort(F.collect_list(F.when(F.col("type") == kind, F.col("part"))), lambda x, y: F.when(x["record_id"] < y["record_id"], -1).when(x["record_id"] > y["record_id"], 1).otherwise(0)) for kind in COMPANIONS}
    grouped = parts.groupBy(F.col("capture").alias("record_id")).agg(*(c.alias(name) for name, c in arrays.items()))
    record = F.struct(*(c for c in main.columns)).alias("record")
    return main.select("record_id", record).join(grouped, "record_id", "left").select("record", "requests", "metadatas")


def page_captures(captured: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of captures that `write_warc` wrote."""
    page = F.col("metadatas")[0]["fields"]["page-id"].cast("long").alias("page_id")
    rows = captured.select(page, *(F.col(f"record.{c}").alias(c) for c in ("type", "record_id", "refers_to", "digest", "payload_bytes", "sha256")))
    rows = S.stage(rows, "captures")
    wanted = rows.filter("type = 'revisit'").select(F.col("refers_to").alias("record_id")).distinct()
    targets = rows.filter("type <> 'revisit'").join(wanted, "record_id", "left_semi")
    targets = targets.select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("first"), F.col("payload_bytes").alias("first_bytes"), F.col("sha256").alias("first_sha256"))
    found = S.join_hot(rows, targets, "refers_to", "record_id")
    again = F.col("type") == "revisit"
    return found.select(
        "page_id",
        F.when(again, F.col("first_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(again, F.coalesce("first_sha256", "digest")).otherwise(F.col("sha256")).alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.when(again, F.col("first")).alias("refers_to"),
    )


def archive(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write archives of pages, read them back and give their captures."""
    spark = pages.sparkSession
    path = S.scratch_path(spark, "warc")
    write_warc(pages, path, least_bytes)
    return page_captures(captures(S.stage(read_records(spark, path, payloads=False), "records")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive(spark.read.parquet(f"{sf_dir}/pages.parquet"))


SQL = """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS size, sha256(coalesce(html, '')) AS digest FROM pages
), firsts AS (
  SELECT digest, min(page_id) AS first FROM payloads WHERE size >= 100 GROUP BY digest
), found AS (
  SELECT page_id, size, digest, first, first IS NOT NULL AND (page_id IS NULL OR page_id > first) AS again FROM payloads LEFT JOIN firsts USING (digest)
)
SELECT page_id, cast(size AS bigint) AS payload_bytes, digest AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN first END AS refers_to
FROM found
"""
