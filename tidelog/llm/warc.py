"""Converter of legacy ARC archives to WARC, with revisit records for repeated payloads.

An ARC archive begins with a version block, whose record names the version; each further record is
a header line of space-separated fields, then as many bytes as its last field declares. Version 1
lines have five fields and version 2 lines ten, counted from the right, as URLs may hold spaces. The
converter reads whole archives, parses each line by the archive's version, takes the declared bytes
as they are, and synthesises what WARC asks for: a unique record id, an ISO 8601 date, a record type
and digests. Bodies are never decoded.

Archives hold at most ARCHIVE_BYTES of records (or one longer record), each record compressed by
itself, so that reading one back takes bounded memory.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from datetime import datetime
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import bounded_batches, hinted, scratch_dir, stash

ARCHIVE_BYTES = 8 << 20
REVISIT_BYTES = 100
#: Header fields of the two ARC versions, the revisit profile, record ends and versions.
ARC_FIELDS = {
    1: ("url", "ip", "date", "mime", "length"),
    2: ("url", "ip", "date", "mime", "status", "checksum", "location", "offset", "file", "length"),
}
ARC_COLUMNS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
ARC_END, WARC_END, CRLF = b"\n", b"\r\n\r\n", "\r\n"
ARC_DATE, NO_DATE = "20000101000000", "19700101000000"  # the pages carry no date
HEADER_END = re.compile(rb"\r\n\r\n|\n\n")


def _binary(*parts: Column | str) -> Column:
    return F.concat(*[(F.lit(p) if isinstance(p, str) else p).cast("binary") for p in parts])


def arc_records(pages: DataFrame, version: int = 1) -> DataFrame:
    """One binary column ``record``: each page as an ARC record whose body is an HTTP response.
    The page id travels in an HTTP header. Null html is an empty payload. Line breaks and other
    control characters in a URL are percent-encoded as one space; spaces stay."""
    if version not in ARC_FIELDS:
        raise ValueError(f"no such ARC version: {version}")
    url = F.regexp_replace(F.coalesce(F.col("url"), F.lit("urn:x-unknown")), r"[\x00-\x1F]+", "%20")
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Page-Id: "), page, F.lit(CRLF + CRLF))
    body = _binary(http, F.coalesce(F.col("html").cast("binary"), F.lit(b"")))
    middle = f" 0.0.0.0 {ARC_DATE} text/html " + ("200 - - 0 pages.arc " if version == 2 else "")
    return pages.select(_binary(url, middle, F.octet_length(body).cast("string"), "\n", body).alias("record"))


def version_block(version: int) -> bytes:
    """The first record of an ARC archive."""
    body = f"{version} 0 tidelog\n{ARC_COLUMNS[version]}\n".encode()
    middle = "200 - - 0 pages.arc " if version == 2 else ""
    return f"filedesc://pages.arc 0.0.0.0 {ARC_DATE} text/plain {middle}{len(body)}\n".encode() + body


def warc_info() -> bytes:
    """The first record of a WARC archive."""
    body = b"software: tidelog\r\nformat: WARC File Format 1.0\r\n"
    head = f"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nWARC-Date: {_warc_date(ARC_DATE)}\r\n"
    return f"{head}Content-Type: application/warc-fields\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body


def write_archives(records: DataFrame, path: str, end: bytes, first: bytes) -> str:
    """Write a column of whole records as archives in ``path``, each beginning with the record
    ``first``. Tasks put records together up to ARCHIVE_BYTES, each a gzip member at the fastest
    level, and Spark's text sink writes each archive's bytes, cast to a string unchanged, as a file."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[bytes] = []
        size = 0
        for b in batches:
            for record in b["record"]:
                if held and size + len(record) > ARCHIVE_BYTES:
                    yield pd.DataFrame({"archive": [b"".join(held)]})
                    held, size = [], 0
                held = held or [gzip.compress(first + end, 1)]
                held.append(gzip.compress(record + end, 1))
                size += len(record)
        if held:
            yield pd.DataFrame({"archive": [b"".join(held)]})

    archives = bounded_batches(records).mapInPandas(run, "archive binary")
    archives.select(F.col("archive").cast("string")).write.option("maxRecordsPerFile", 1).text(path)
    return path


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Whole archives, one row each: ``path`` and ``content``."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def unpacked(data: bytes) -> bytes:
    """The content of an archive, compressed by record or as a whole, or not at all. The text sink ends
    each file with a line feed."""
    if data[:2] != b"\x1f\x8b":
        return data
    try:
        return gzip.GzipFile(fileobj=io.BytesIO(data[:-1] if data.endswith(b"\n") else data)).read()
    except EOFError as e:
        raise ValueError("a compressed record ends early") from e


def _arc_fields(line: bytes, version: int | None) -> dict[str, str]:
    """The fields of a header line, from the right. Without a version block it is version 2 where the
    line has its fields, with a result code and an offset in their places."""
    parts = line.rstrip(b"\r").decode("utf-8", "replace").split(" ")
    if version is None:
        two = len(parts) >= 10 and re.fullmatch(r"\d{3}|-", parts[-6]) and parts[-3].isdigit()
        version = 2 if two else 1
    names = ARC_FIELDS[version]
    if len(parts) < len(names) or not parts[-1].isdigit():
        raise ValueError(f"an ARC header line of version {version} has {len(parts)} fields: {line[:200]!r}")
    cut = len(parts) - len(names) + 1
    return dict(zip(names, [" ".join(parts[:cut]), *parts[cut:]], strict=True))


def split_arc(data: bytes) -> Iterator[tuple[dict[str, str], bytes, int]]:
    """Header fields, body and place of each record of one ARC archive. A version block is not a
    record; it sets the version of the lines after it, and its date stands in for unreadable ones."""
    at, version, date = 0, None, NO_DATE
    while at < len(data):
        if data[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        stop = data.find(b"\n", at)
        line = data[at : stop if stop >= 0 else len(data)]
        block = line.startswith(b"filedesc:")
        if block:
            header = dict(zip(("url", "ip", "date"), line.decode("utf-8", "replace").split(" "), strict=False))
            header["length"] = line.split()[-1].decode("utf-8", "replace")
        else:
            header = _arc_fields(line, version)
        if stop < 0 or not header["length"].isdigit():
            raise ValueError(f"an ARC record without a length: {line[:200]!r}")
        size = int(header["length"])
        body = data[stop + 1 : stop + 1 + size]
        if len(body) != size:
            raise ValueError("an ARC record is shorter than its declared length")
        if block:
            named = body[:1].decode("latin-1")
            if named not in ("1", "2"):
                raise ValueError(f"an ARC archive of unknown version: {body[:40]!r}")
            version, date = int(named), header.get("date", NO_DATE)
        else:
            if not _is_date(header["date"]):
                header["date"] = date
            yield header, body, at
        at = stop + 1 + size


@lru_cache(maxsize=10_000)
def _is_date(arc_date: str) -> bool:
    try:
        datetime.strptime(_warc_date(arc_date), "%Y-%m-%dT%H:%M:%SZ")
    except ValueError:
        return False
    return arc_date[12:] not in ("60", "61")


def _warc_date(arc_date: str) -> str:
    """An ARC date of 4 to 14 digits as ISO 8601; what it leaves out is the least it may be."""
    if not re.fullmatch(r"\d{4}(\d\d){0,5}", arc_date):
        raise ValueError(f"no ARC date: {arc_date!r}")
    d = arc_date + "00000101000000"[len(arc_date) :]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _page_id(http: bytes) -> int | None:
    found = re.search(rb"(?im)^x-page-id:[ \t]*(-?\d+)[ \t]*\r?$", http)
    return int(found[1]) if found else None


RECORD = "page_id long, record_id string, uri string, date string, mime string, http binary, payload binary, digest string"


def convert_arc(archives: DataFrame) -> DataFrame:
    """Records of ARC archives with synthesised WARC fields: page_id (null where the HTTP header has
    none), record_id (from the archive's path and the record's place, so unique and the same when a
    task runs again), uri (white space encoded), date, mime, http (header block; null for a body
    that is no HTTP response), payload, and digest (SHA-256 of the payload)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in RECORD.split(", ")]
        for b in batches:
            for path, content in zip(b["path"], b["content"], strict=True):
                rows = []
                for head, body, at in split_arc(unpacked(content)):
                    http, payload = None, body
                    if body.startswith(b"HTTP/"):
                        cut = HEADER_END.search(body)
                        http, payload = (body[: cut.start()], body[cut.end() :]) if cut else (body.rstrip(b"\r\n"), b"")
                    record_id = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{path}#{at}')}>"
                    uri = re.sub(r"\s", lambda m: "".join(f"%{c:02X}" for c in m[0].encode()), head["url"])
                    digest = hashlib.sha256(payload).hexdigest()
                    rows.append((_page_id(http or b""), record_id, uri, _warc_date(head["date"]), head["mime"], http, payload, digest))
                yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64"})

    return archives.select("path", "content").mapInPandas(run, RECORD)


def with_record_types(records: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """Add ``refers_to`` and ``refers_to_id``: for a payload of at least ``least`` bytes, the smallest
    page id that has it and that page's record, where the id is smaller than the record's own; else
    null. Rows that repeat the smallest id are all responses, and so are rows without an id. The
    first ids are combined before their shuffle; of payloads that occur once nothing is kept. The
    join back is by a checked broadcast, or one whose skew Spark can split, since its other side is
    a written table."""
    large = F.octet_length("payload") >= least
    named = records.where(large & F.col("page_id").isNotNull()).groupBy("digest")
    first = named.agg(F.min(F.struct("page_id", "record_id")).alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    first = stash(first.select("digest", F.col("_first.page_id").alias("_page"), F.col("_first.record_id").alias("_record")), "repeated-payloads")
    joined = records.join(hinted(first), "digest", "left")
    again = large & (F.col("page_id") > F.col("_page"))
    return joined.withColumn("refers_to", F.when(again, F.col("_page"))).withColumn("refers_to_id", F.when(again, F.col("_record"))).drop("_page", "_record")


def warc_records(records: DataFrame) -> DataFrame:
    """One binary column ``record``: a response with the HTTP message, a resource where there is none,
    or a revisit with the HTTP header only, naming the record it refers to and the full payload's
    length and digest."""
    revisit, has_http = F.col("refers_to").isNotNull(), F.col("http").isNotNull()
    head = F.when(has_http, _binary(F.col("http"), CRLF + CRLF)).otherwise(F.lit(b""))
    block = F.when(revisit, head).otherwise(_binary(head, F.col("payload")))
    kind = F.when(revisit, F.lit("revisit")).when(has_http, F.lit("response")).otherwise(F.lit("resource"))
    fields = F.concat_ws(
        CRLF,
        F.lit("WARC/1.0"),
        F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit("WARC-Record-ID: "), F.col("record_id")),
        F.concat(F.lit("WARC-Target-URI: "), F.col("uri")),
        F.concat(F.lit("WARC-Date: "), F.col("date")),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        F.concat(F.lit("X-Payload-Length: "), F.octet_length("payload").cast("string")),
        F.concat(F.lit("X-Page-Id: "), F.col("page_id").cast("string")),
        F.concat(F.lit("WARC-Refers-To: "), F.col("refers_to_id")),
        F.concat(F.lit("X-Refers-To-Page-Id: "), F.col("refers_to").cast("string")),
        F.when(revisit, F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        F.concat(F.lit("Content-Type: "), F.when(has_http, F.lit("application/http; msgtype=response")).otherwise(F.col("mime"))),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    )
    return records.select(_binary(fields, CRLF + CRLF, block).alias("record"))


def split_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record of one WARC archive."""
    at = 0
    while at < len(data):
        if data[at : at + 2] == b"\r\n":
            at += 2
            continue
        stop = data.find(b"\r\n\r\n", at)
        lines = data[at : stop if stop >= 0 else len(data)].decode("utf-8", "replace").split(CRLF)
        if stop < 0 or not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record here: {lines[0][:80]!r}")
        fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(fields["content-length"])
        block = data[stop + 4 : stop + 4 + size]
        if len(block) != size:
            raise ValueError("a WARC record is shorter than its declared length")
        at = stop + 4 + size
        yield fields, block


def read_warc(archives: DataFrame) -> DataFrame:
    """The responses, resources and revisits of WARC archives: page_id, payload_bytes, payload_digest,
    record_type and refers_to. A payload's length and digest are taken of its bytes and must agree
    with the header; a revisit's are those its header declares."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = lambda x: None if x is None else int(x)
        for b in batches:
            for content in b["content"]:
                rows = []
                for head, block in split_warc(unpacked(content)):
                    if head["warc-type"] not in ("response", "resource", "revisit"):
                        continue
                    size, digest = int(head["x-payload-length"]), head["warc-payload-digest"].partition(":")[2]
                    if head["warc-type"] != "revisit":
                        payload = block.partition(b"\r\n\r\n")[2] if head["warc-type"] == "response" else block
                        if (size, digest) != (len(payload), hashlib.sha256(payload).hexdigest()):
                            raise ValueError(f"the payload of {head['warc-record-id']} does not match its header")
                    rows.append((number(head.get("x-page-id")), size, digest, head["warc-type"], number(head.get("x-refers-to-page-id"))))
                names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
                yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return archives.select("content").mapInPandas(run, schema)


def arc_to_warc(spark: SparkSession, arc: str, warc: str) -> str:
    """Convert the ARC archives below a path to WARC archives in another."""
    records = with_record_types(convert_arc(read_archives(spark, arc)))
    return write_archives(warc_records(records), warc, WARC_END, warc_info())


def archive_pages(pages: DataFrame, version: int = 1) -> DataFrame:
    """Write pages as ARC archives, convert these to WARC archives, and read the WARC back.

    Pages without html have an empty payload, pages without a URL a placeholder, pages without an
    id stay without one; repeated rows give a record each; an empty table gives no rows. Other
    columns are ignored."""
    spark = pages.sparkSession
    top = f"{scratch_dir(spark)}/archives-{uuid.uuid4().hex}"
    arc = write_archives(arc_records(pages, version), f"{top}/arc", ARC_END, version_block(version))
    return read_warc(read_archives(spark, arc_to_warc(spark, arc, f"{top}/warc")))
