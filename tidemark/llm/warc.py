"""WARC archives of pages: writing, reading, and assembly of transactions.

Writing. Each page becomes three records: the request, the response (or a revisit, where
another page with the same payload is the response) and metadata. Request and metadata name
the response or revisit with ``WARC-Concurrent-To``. Records are text in UTF-8, so Spark's own
text writer commits them, compressed as a whole per file, to any storage Spark reaches.

Reading. Files are read as they are and cut by ``Content-Length``, so a payload may hold
anything, a record's first line included. Writers keep files small enough for that.

Assembly. Records of one capture are joined through their concurrent-to identifiers, in
either direction and over one record between, and give one nested row per capture.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.casts import quoted
from tidemark.llm.common import map_batches, tidy
from tidemark.operators.sizes import broadcast_if, estimated_bytes, fits_broadcast
from tidemark.workspace import Workspace

FILE_BYTES = 32 * 1024 * 1024
# Fixed values of the format.
VERSION = "WARC/1.1"
NEWLINE = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32(hex_digest: Column) -> Column:
    """Upper-case base32 of a 160-bit digest in hexadecimal."""
    letters = []
    for start in range(0, 40, 10):  # 40 bits are ten hexadecimal digits and eight letters
        part = F.conv(F.substring(hex_digest, start + 1, 10), 16, 10).cast("bigint")
        for shift in range(35, -1, -5):
            index = F.shiftright(part, shift).bitwiseAND(31).cast("int") + 1
            letters.append(F.substring(F.lit(_ALPHABET), index, F.lit(1)))
    return F.concat(*letters)


def _record_id(kind: str, uid: Column) -> Column:
    digest = F.md5(F.concat(F.lit(f"{kind} "), uid))
    parts = [F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(headers: list[tuple[str, Column]], content: Column) -> Column:
    """A whole record but for the last newline, which the text writer adds.

    A header that is null is left out.
    """
    lines = [F.concat(F.lit(f"{name}: "), value) for name, value in headers]
    head = F.concat_ws(NEWLINE, F.lit(VERSION), *lines)
    size = F.concat(F.lit("Content-Length: "), F.octet_length(content).cast("string"))
    return F.concat(head, F.lit(NEWLINE), size, F.lit(2 * NEWLINE), content, F.lit("\r\n\r"))


def _header_text(value: Column) -> Column:
    """Blanks and controls would end or split a header."""
    return F.regexp_replace(value, r"[\x00-\x20\x7F]", "%20")


def write_pages(
    pages: DataFrame,
    path: str,
    min_bytes: int = 0,
    date: str = "2024-01-01T00:00:00Z",
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    file_bytes: int = FILE_BYTES,
) -> None:
    """Write archives of ``pages`` into folder ``path``.

    Of pages with equal payloads of at least ``min_bytes`` the one with the largest id is the
    response and others revisit it; smaller payloads are all responses. A null html is an
    empty payload; a null url leaves the target out. Rows that repeat the largest id are all
    responses; a null id counts as smaller than any other.
    """
    rows = pages.select(
        quoted(id_col).cast("bigint").alias("page_id"),
        quoted(url_col).alias("url"),
        F.coalesce(quoted(html_col), F.lit("")).alias("html"),
    )
    hashed = rows.withColumn("sha1", F.sha1(F.col("html").cast("binary")))
    rank = F.coalesce("page_id", F.lit(-(2**63)))
    large = hashed.filter(F.octet_length("html") >= min_bytes)
    shared = large.groupBy("sha1").agg(F.max(rank).alias("leader"), F.count("*").alias("n"))
    shared = shared.filter("n > 1").select("sha1", "leader")
    joined = hashed.join(broadcast_if(shared, fits_broadcast(shared, rows)), "sha1", "left")
    revisit = F.coalesce((rank != F.col("leader")) & (F.octet_length("html") >= min_bytes), F.lit(False))

    digest = F.concat(F.lit("sha1:"), base32(F.col("sha1")))
    # Also tells rows with the same page id apart; only this write uses it.
    uid = F.concat_ws(" ", "page_id", "sha1", F.monotonically_increasing_id())
    marked = joined.select(
        "page_id", "html", _header_text(F.col("url")).alias("url"), digest.alias("digest"),
        revisit.alias("revisit"), uid.alias("uid"),
    )
    target = F.col("url")
    own = _record_id("response", F.col("uid"))
    host = F.regexp_extract("url", r"^[a-z]+://([^/?#]*)", 1)
    place = F.regexp_replace(F.col("url"), r"^[a-z]+://[^/?#]*|#.*$", "")
    place = F.when(place.startswith("/"), place).otherwise(F.concat(F.lit("/"), place))
    size = F.octet_length("html").cast("string")
    answer = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        size, F.lit("\r\n\r\n"),
    )
    at = ("WARC-Date", F.lit(date))
    revisited = F.col("revisit")
    response = _record(
        [
            ("WARC-Type", F.when(revisited, "revisit").otherwise("response")),
            ("WARC-Record-ID", own), at, ("WARC-Target-URI", target),
            ("WARC-Profile", F.when(revisited, PROFILE)),
            ("WARC-Payload-Digest", F.col("digest")),
            ("Content-Type", F.lit("application/http; msgtype=response")),
        ],
        F.when(revisited, answer).otherwise(F.concat(answer, F.col("html"))),
    )
    request = _record(
        [
            ("WARC-Type", F.lit("request")), ("WARC-Record-ID", _record_id("request", F.col("uid"))),
            at, ("WARC-Target-URI", target), ("WARC-Concurrent-To", own),
            ("Content-Type", F.lit("application/http; msgtype=request")),
        ],
        F.concat(F.lit("GET "), F.coalesce(place, F.lit("/")), F.lit(" HTTP/1.1\r\nHost: "),
                 F.coalesce(host, F.lit("")), F.lit("\r\n\r\n")),
    )
    metadata = _record(
        [
            ("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", _record_id("metadata", F.col("uid"))),
            at, ("WARC-Target-URI", target), ("WARC-Concurrent-To", own),
            ("Content-Type", F.lit("application/warc-fields")),
        ],
        F.concat_ws(NEWLINE, F.concat(F.lit("page-id: "), F.col("page_id")), F.concat(F.lit("payload-bytes: "), size), F.lit("")),
    )
    records = marked.select(F.concat_ws("\n", request, response, metadata).alias("value"))
    # At most so many rows a file, from the mean size; a scan's splits mostly keep files smaller.
    mean = estimated_bytes(pages) / max(1, pages.count())
    most = max(1, int(file_bytes / max(1.0, 4 * mean)))
    writer = records.write.option("compression", "gzip").option("maxRecordsPerFile", most)
    writer.text(path)


def _parse(content: bytes) -> Iterator[tuple[dict[str, str], list[str], bytes]]:
    """(headers in lower case, concurrent-to ids, block) of each record of a file."""
    raw, at = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content, 0
    while at < len(raw):
        stop = raw.find(b"\r\n\r\n", at)
        head = raw[at : len(raw) if stop < 0 else stop].decode("utf-8").strip("\r\n")
        if not head:
            return
        if stop < 0 or not head.startswith("WARC/"):
            raise ValueError(f"not a record at byte {at}")
        headers, linked = {}, []
        for line in head.split(NEWLINE)[1:]:
            name, _, value = line.partition(":")
            name, value = name.lower(), value.strip()
            headers[name] = value
            if name == "warc-concurrent-to":
                linked.append(value)
        size = int(headers["content-length"])
        block = raw[stop + 4 : stop + 4 + size]
        if len(block) < size:
            raise ValueError(f"record cut off at byte {at}")
        yield headers, linked, block
        at = stop + 4 + size
        while raw[at : at + 2] == b"\r\n":
            at += 2


RECORDS = (
    "record_id string, record_type string, target_uri string, date string, concurrent_to array<string>, "
    "payload_digest string, payload_bytes bigint, payload binary, fields map<string,string>"
)


def _records(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema(
            [("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()),
             ("date", pa.string()), ("concurrent_to", pa.list_(pa.string())), ("payload_digest", pa.string()),
             ("payload_bytes", pa.int64()), ("payload", pa.binary()), ("fields", pa.map_(pa.string(), pa.string()))]
        )
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for headers, linked, block in _parse(content.as_py()):
                    kind, payload, fields = headers["warc-type"], None, None
                    digest = headers.get("warc-payload-digest", "").partition(":")[2] or None
                    if kind == "response":
                        payload = block.partition(b"\r\n\r\n")[2]
                        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                        if digest is not None and digest != found:
                            raise ValueError(f"payload of {headers['warc-record-id']} does not match its digest")
                        digest = found
                    elif kind == "metadata":
                        pairs = (line.partition(":") for line in block.decode("utf-8").split(NEWLINE) if line)
                        fields = {name.strip(): value.strip() for name, _, value in pairs}
                    size = None if payload is None else len(payload)
                    rows.append(
                        (headers["warc-record-id"], kind, headers.get("warc-target-uri"), headers.get("warc-date"),
                         linked, digest, size, payload if with_payload else None,
                         None if fields is None else list(fields.items()))
                    )
                    held += len(block)
                    if held > 8_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kinds)], schema=kinds)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kinds)], schema=kinds)

    return run


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives in ``path``, as ``RECORDS``. A response's payload must
    match its digest; a file that is cut off fails the read."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return map_batches(files, _records(with_payload), RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One row per response or revisit, with ``request`` and ``metadata`` as arrays of records.

    A record belongs to the capture that it names or that names it; failing that, to the one
    that such a neighbour belongs to. Records tied to no capture are left out; a capture
    without any has nulls. Payloads move once, to the joined row.
    """
    is_capture = F.col("record_type").isin("response", "revisit")
    named = records.select(F.col("record_id").alias("a"), F.explode("concurrent_to").alias("b"))
    links = named.unionAll(named.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    captures = records.filter(is_capture).drop("concurrent_to", "fields")
    ids = captures.select(F.col("record_id").alias("b"))
    near = links.join(ids, "b", "left_semi").select("a", F.col("b").alias("capture"))
    far = links.join(near.withColumnRenamed("a", "b"), "b").select("a", "capture")
    tied = near.withColumn("steps", F.lit(1)).unionAll(far.withColumn("steps", F.lit(2)))
    chosen = tied.groupBy("a").agg(F.min(F.struct("steps", "capture"))["capture"].alias("capture"))
    others = records.filter(~is_capture).withColumnRenamed("record_id", "a").join(chosen, "a")
    request = F.struct(F.col("a").alias("record_id"), "target_uri", "date")
    metadata = F.struct(F.col("a").alias("record_id"), F.map_entries("fields").alias("fields"))

    def all_of(kind: str, entry: Column) -> Column:
        return F.sort_array(F.collect_list(F.when(F.col("record_type") == kind, entry))).alias(kind)

    grouped = others.groupBy(F.col("capture").alias("record_id")).agg(
        all_of("request", request), all_of("metadata", metadata)
    )
    return captures.join(grouped, "record_id", "left")


def page_captures(records: DataFrame) -> DataFrame:
    """Assembled captures with the ``page_id`` of their metadata; a revisit also gets the size of
    its payload and the page id of the response it ``refers_to``, found by digest."""
    captures = assemble(records)
    entries = F.flatten(F.transform("metadata", lambda m: m["fields"]))
    page_id = F.get(F.filter(entries, lambda e: e["key"] == "page-id"), F.lit(0))["value"].cast("bigint")
    known = captures.withColumn("page_id", page_id)
    is_response = F.col("record_type") == "response"
    rank = F.coalesce("page_id", F.lit(-(2**63)))
    originals = known.filter(is_response).groupBy("payload_digest").agg(
        F.max(F.struct(rank.alias("rank"), "page_id"))["page_id"].alias("original"),
        F.max("payload_bytes").alias("original_bytes"),
    )
    # Responses need no original, so only revisits are joined.
    revisits = known.filter(~is_response).join(originals, "payload_digest", "left")
    bytes_ = F.col("original_bytes").alias("payload_bytes")
    columns = [c for c in known.columns]
    resolved = revisits.select(
        *[bytes_ if c == "payload_bytes" else F.col(c) for c in columns], F.col("original").alias("refers_to")
    )
    responses = known.filter(is_response).select(*columns, F.lit(None).cast("bigint").alias("refers_to"))
    return responses.unionAll(resolved)


def archive_pages(pages: DataFrame, workspace: Workspace, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives, read them back and assemble them; payloads are not kept."""
    with tidy(pages.sparkSession):
        path = workspace.path("archives")
        write_pages(pages, path, min_bytes)
        records = read_records(pages.sparkSession, path, with_payload=False)
        return page_captures(workspace.store(records, "records"))
