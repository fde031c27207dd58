"""WARC archives: written with segments and revisits, read back with reassembly."""

from __future__ import annotations

import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkstrata.llm.skew import join_by_key
from inkstrata.llm.store import new_path, written

SEGMENT_BYTES = 65_536  # a longer block is cut into continuation records
CHUNK_BYTES = 16_384  # of a chunk; payloads longer than one chunk are sent chunked
LEAST_REVISIT = 100  # payload bytes from which an equal payload becomes a revisit
RECORDS_PER_FILE = 1_000  # with SEGMENT_BYTES this bounds a file at 66 MB before compression
DATE = "2026-01-01T00:00:00Z"
CRLF = "\r\n"
NOTHING = bytes.fromhex("1f8b08000000000002ff03000000000000000000")  # a gzip member of no bytes, which Spark's writer sets between records


def _record(fields: list[tuple[str, object]], part: bytes) -> bytes:
    """A record as a gzip member of its own. Fields without a value have no line."""
    head = "".join(f"{k}: {v}{CRLF}" for k, v in fields if v is not None)
    return gzip.compress(f"WARC/1.1{CRLF}{head}Content-Length: {len(part)}{CRLF}{CRLF}".encode() + part + b"\r\n\r\n", 5, mtime=0)


def _block(payload: bytes, revisit: bool) -> bytes:
    """The HTTP response, chunked if it is long; of a revisit only its head."""
    head = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"
    if revisit or len(payload) <= CHUNK_BYTES:
        return f"{head}Content-Length: {len(payload)}{CRLF}{CRLF}".encode() + (b"" if revisit else payload)
    chunks = [payload[i : i + CHUNK_BYTES] for i in range(0, len(payload), CHUNK_BYTES)]
    return b"".join([f"{head}Transfer-Encoding: chunked{CRLF}{CRLF}".encode(), *(x for c in chunks for x in (b"%x\r\n" % len(c), c, b"\r\n")), b"0\r\n\r\n"])


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[bytes] = []
    for batch in batches:
        for page, url, html, row, digest, first_row, first_page in zip(*batch.columns):
            payload, row, first_row = html.as_buffer().to_pybytes(), row.as_py(), first_row.as_py()
            page, digest, first_page = page.as_py(), digest.as_py(), first_page.as_py()
            revisit = first_row is not None and first_row != row
            block = _block(payload, revisit)
            parts = [block[i : i + SEGMENT_BYTES] for i in range(0, len(block), SEGMENT_BYTES)]
            target = None if url.as_py() is None else re.sub("[\r\n]+", " ", url.as_py())
            common, cut = [("WARC-Date", DATE), ("WARC-Target-URI", target)], len(parts) > 1
            for k, part in enumerate(parts, 1):
                if k == 1:
                    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _urn(row)), *common, ("Content-Type", "application/http; msgtype=response"), ("X-Page-Id", page), ("WARC-Payload-Digest", f"sha256:{digest}")]
                    if revisit:
                        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", _urn(first_row)), ("X-Refers-To-Page-Id", first_page)]
                else:
                    fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", _urn(f"{row}:{k}")), *common, ("WARC-Segment-Origin-ID", _urn(row))]
                fields += [("WARC-Segment-Number", k if cut else None), ("WARC-Segment-Total-Length", len(block) if cut and k == len(parts) else None)]
                held.append(_record(fields, part))
            if sum(map(len, held)) > 1_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["value"])
                held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["value"])


def _urn(row: object) -> str:
    return f"<urn:inkstrata:row:{row}>"


def write_archives(pages: DataFrame, path: str) -> None:
    """One record, and its continuations, for each row of pages (page_id, url, html), as WARC/1.1 files of gzip members under path.

    The payload is html in UTF-8 (null: empty). Of equal payloads of at least LEAST_REVISIT bytes the row
    with the smallest page_id is a response and the others are revisits without body. Every other record is a response.
    Payloads of more than CHUNK_BYTES are framed as chunked; blocks of more than
    SEGMENT_BYTES are cut into segments. Line ends in url become blanks; a null url or page_id has no header line.

    Rows are written with their numbers first, which name the records. Each record is a gzip member, so readers can seek to it; Spark's
    writer, whose files its commit protocol guards against lost tasks, sets a member of no bytes after each."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = written(rows.select("page_id", "url", F.col("html").cast("binary").alias("html"), F.monotonically_increasing_id().alias("row_id"), F.sha2("html", 256).alias("digest"), F.octet_length("html").alias("n")), "pages")
    order = F.struct(F.isnull("page_id").alias("none"), "page_id", "row_id")
    firsts = rows.filter(F.col("n") >= LEAST_REVISIT).groupBy("digest").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    firsts = written(firsts.select("digest", F.col("first.row_id").alias("first_row"), F.col("first.page_id").alias("first_page"), "copies"), "firsts")
    rows = join_by_key(rows, firsts, ["digest"], "copies", F.col("row_id"), how="left")
    made = rows.select("page_id", "url", "html", "row_id", "digest", "first_row", "first_page").mapInArrow(_records, "value binary")
    writer = made.selectExpr("cast(value as string) value").write.option("lineSep", NOTHING.decode("latin-1")).option("encoding", "ISO-8859-1")
    writer.option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def unzipped(raw: bytes) -> bytes:
    """The bytes of all members of a gzip file."""
    out, at, z = [], 0, zlib.decompressobj(31)
    while at < len(raw):
        got = raw[at : at + 65_536]
        at += len(got)
        while got:
            out.append(z.decompress(got))
            got = z.unused_data
            if z.eof:
                z = zlib.decompressobj(31)
    return b"".join(out)


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an uncompressed archive."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "replace").split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        n = int(head["content-length"])
        yield head, data[end + 4 : end + 4 + n]
        at = end + 4 + n + 4


def dechunk(body: bytes) -> bytes:
    """The payload of a chunked body; chunk extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        n = int(body[at:end].partition(b";")[0], 16)
        if not n:
            return b"".join(out)
        out.append(body[end + 2 : end + 2 + n])
        if len(out[-1]) != n or body[end + 2 + n : end + 4 + n] != b"\r\n":
            raise ValueError("a chunk is cut short")
        at = end + 4 + n


def reassemble(parts: list[tuple[int, bytes, int | None]]) -> bytes:
    """The block of segments (number, bytes, total length or None): in order of their numbers, which must be 1..n; the last one's total must hold."""
    parts = sorted(parts, key=lambda x: x[0])
    block = b"".join(x[1] for x in parts)
    if [x[0] for x in parts] != list(range(1, len(parts) + 1)) or parts[-1][2] != len(block):
        raise ValueError("segments are missing, repeated or of another total length")
    return block


def payload_of(block: bytes) -> tuple[bytes, int]:
    """The payload of an HTTP response block, and its Content-Length (-1 without)."""
    head, _, body = block.partition(b"\r\n\r\n")
    fields = dict((k.strip().lower(), v.strip()) for k, _, v in (x.partition(":") for x in head.decode("latin-1").split(CRLF)[1:]))
    if fields.get("transfer-encoding", "").lower() == "chunked":
        return dechunk(body), -1
    return body, int(fields.get("content-length", -1))


_OUT = "origin string, page_id long, url string, record_type string, refers string, payload_bytes long, payload_digest string, seg int, total long, block binary"
_NAMES = [x.split()[0] for x in _OUT.split(", ")]
_TYPES = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.binary()]


def _int(x: str | None) -> int | None:
    return None if x is None else int(x)


def _judged(head: dict, block: bytes) -> tuple:
    """The row of a whole record; the digest of a response's payload must be the one it was given."""
    kind, digest, n = head["warc-type"], head.get("warc-payload-digest", "").removeprefix("sha256:"), None
    if kind != "revisit":
        payload, length = payload_of(block)
        told, digest, n = digest, hashlib.sha256(payload).hexdigest(), len(payload)
        if told and told != digest or length not in (-1, n):
            raise ValueError(f"payload of {head['warc-record-id']} doesn't have its digest or length")
    return (head["warc-record-id"], _int(head.get("x-page-id")), head.get("warc-target-uri"), kind, head.get("warc-refers-to"), n, digest, None, None, None)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content"):
            rows, cut = [], {}
            for head, block in records(unzipped(content.as_buffer().to_pybytes())):
                if "warc-segment-number" in head:
                    cut.setdefault(head.get("warc-segment-origin-id", head["warc-record-id"]), []).append((head, block))
                elif head["warc-type"] in ("response", "revisit"):
                    rows.append(_judged(head, block))
            for origin, found in cut.items():
                parts = [(int(h["warc-segment-number"]), b, _int(h.get("warc-segment-total-length"))) for h, b in found]
                if {p[0] for p in parts} == set(range(1, len(parts) + 1)) and any(p[2] is not None for p in parts):
                    rows.append(_judged(next(h for h, _ in found if h["warc-type"] != "continuation"), reassemble(parts)))
                    continue
                for (h, _), (seg, b, total) in zip(found, parts):  # the rest is in other files
                    rows.append((origin, _int(h.get("x-page-id")), h.get("warc-target-uri"), h["warc-type"], h.get("warc-refers-to"), None, h.get("warc-payload-digest"), seg, total, b))
            for at in range(0, len(rows), 100):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[at : at + 100]), _TYPES)], names=_NAMES)


def _rejoin(group: pd.DataFrame) -> pd.DataFrame:
    block = reassemble([(int(s), bytes(b), None if pd.isna(t) else int(t)) for s, b, t in zip(group.seg, group.block, group.total)])
    first = group[group.record_type != "continuation"].iloc[0]
    head = {"warc-type": first.record_type, "warc-record-id": first.origin, "warc-payload-digest": first.payload_digest or ""}
    row = list(_judged(head, block))
    row[1], row[2] = (None if pd.isna(first.page_id) else int(first.page_id)), first.url
    return pd.DataFrame([row], columns=_NAMES).astype({"page_id": "Int64", "payload_bytes": "Int64", "seg": "Int32", "total": "Int64"})


def resolved(found: DataFrame) -> DataFrame:
    """Records with each revisit's payload taken from the response that it refers to by record id, which must be there and have the revisit's digest."""
    columns = ["origin", "page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest"]
    responses = found.filter("record_type <> 'revisit'").withColumn("refers_to", F.lit(None).cast("long")).select(columns)
    revisits = found.filter("record_type = 'revisit'").select("origin", "page_id", "url", "record_type", "refers", F.col("payload_digest").alias("told"))
    asked = revisits.groupBy("refers").agg(F.count(F.lit(1)).alias("copies"))
    targets = responses.select(F.col("origin").alias("refers"), F.col("page_id").alias("refers_to"), "payload_bytes", "payload_digest").join(asked, "refers")
    revisits = join_by_key(revisits, written(targets, "targets"), ["refers"], "copies", F.col("origin"), how="left")
    checked = F.when(F.col("told") == F.col("payload_digest"), F.col("payload_digest")).otherwise(F.raise_error(F.concat(F.col("origin"), F.lit(" refers to no record with its digest"))))
    return responses.unionByName(revisits.withColumn("payload_digest", checked).select(columns))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of gzipped archives under path: origin (record id), page_id, url, record_type, refers_to, payload_bytes, payload_digest.

    Segments of a record are put together where one file has all of them; else they are grouped by their origin's
    id, ordered by number and checked against the total length. Chunked framing is decoded and the digest of each
    payload recomputed and checked. A revisit is looked up among the records read: see resolved(). A missing or
    repeated segment, a cut chunk, a wrong digest or a reference to nothing is an error, never a silent loss. A task holds one file."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    found = written(files.mapInArrow(_read, _OUT), "records")
    rest = found.filter("seg is not null").groupBy("origin").applyInPandas(_rejoin, _OUT)
    return resolved(found.filter("seg is null").unionByName(rest))


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Writes pages as archives in the shared folder, reads them back: see write_archives() and read_archives().

    Repeated rows are records of their own; an empty table gives an empty result; further columns are ignored."""
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    write_archives(pages, path)
    return read_archives(spark, path)
