"""Legacy ARC archives to WARC, and both formats as files that Spark writes and reads.

An ARC file opens with a version block that names the fields of its record headers: version 1 has five, version 2 ten.
A record is one header line, as many bytes as its last field declares, and a line end. The converter gives every record
what WARC asks for beyond that: an identifier, an ISO date, a type and digests. Of records with equal payloads one stays
a response, the others become revisits that refer to it and hold the protocol header alone.

Files are written by Spark's text writer (one record a row, the record end as line separator, gzip) and read with
Spark's binary reader, so any store that Spark reaches will do. Records are cut by their declared lengths only. What is
decided on records goes to their files: a file meets the list of its revisits as it lies, packed, and is parsed after that.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from courtside.session import fresh_path, settle

# records in a file, so that a file fits in memory with room to spare
PER_FILE = 500
# gzip level of the writer: level 6, the default, takes four times as long for files smaller by a tenth
LEVEL = "TWO"
LEAST_REVISIT = 1000

# Header fields of the two ARC versions, in order.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
# Texts of the WARC format.
WARC_VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RESPONSE_TYPE = "application/http; msgtype=response"
DATE = "20240101000000"

PARSED = (
    "record_id string, page_id long, url string, date string, payload_bytes long, payload_digest string, head string, payload string, "
    "file string"
)
READ_BACK = (
    "record_id string, record_type string, page_id long, url string, date string, refers_id string, "
    "payload_bytes long, payload_digest string, payload string"
)


class BrokenArchive(ValueError):
    """An archive whose text does not agree with its declared lengths or fields."""


def _plain_url(url: str | None) -> str:
    """A URL as one header field: blanks and line ends percent-encoded, nothing as a dash."""
    return re.sub(r"[\s]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or "") or "-"


def http_head(page_id: int | None, length: int) -> str:
    return (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"X-Page-Id: {'' if page_id is None else page_id}\r\nContent-Length: {length}\r\n\r\n"
    )


def version_block(version: int, name: str) -> str:
    """The first record of an ARC file, without the line end that follows it."""
    body = f"{version} 0 courtside\n{ARC_FIELDS[version]}\n"
    rest = {1: "text/plain", 2: f"text/plain 200 - - 0 {name}"}[version]
    return f"filedesc://{name} 0.0.0.0 {DATE} {rest} {len(body)}\n{body}"


def arc_record(version: int, page_id: int | None, url: str | None, html: str | None, date: str = DATE) -> str:
    """One ARC record, without the line end that follows it."""
    html = html or ""
    length = len(html.encode())
    head = http_head(page_id, length)
    rest = {1: "text/html", 2: "text/html 200 - - 0 -"}[version]
    return f"{_plain_url(url)} 0.0.0.0 {date} {rest} {len(head) + length}\n{head}{html}"


def _whole(raw: bytes) -> bytes:
    """Content of a file, unpacked if it is gzip; several gzip members follow each other."""
    out = []
    while raw[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(raw))
        if not member.eof:
            raise BrokenArchive("the file ends inside a gzip member")
        raw = member.unused_data
    return b"".join(out) if out else raw


def parse_arc(raw: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header fields, content) of the records behind the version block."""
    data = _whole(raw)
    at, names = 0, None
    while at < len(data):
        line_end = data.find(b"\n", at)
        if line_end < 0:
            raise BrokenArchive(f"no header line at {at}")
        line = data[at:line_end].decode()
        fields = line.split(" ")
        if names is None:
            if not line.startswith("filedesc://"):
                raise BrokenArchive("no version block")
            length = int(fields[-1])
            body = data[line_end + 1 : line_end + 1 + length].decode()
            version = int(body.split(" ", 1)[0])
            names = body.split("\n")[1].split(" ")
            if version not in ARC_FIELDS or " ".join(names) != ARC_FIELDS[version] or len(fields) != len(names):
                raise BrokenArchive(f"unknown version block {body!r}")
        else:
            # a URL may hold blanks in old files: the other fields are counted from the right
            fields = line.rsplit(" ", len(names) - 1)
            if len(fields) != len(names):
                raise BrokenArchive(f"{len(fields)} fields at {at}")
            length = int(fields[-1])
            content = data[line_end + 1 : line_end + 1 + length]
            if len(content) != length:
                raise BrokenArchive(f"content ends early at {at}")
            yield at, dict(zip(names, fields)), content
        at = line_end + 1 + length
        if data[at : at + 1] != b"\n":
            raise BrokenArchive(f"no line end after the record before {at}")
        at += 1


def split_http(content: bytes) -> tuple[str, bytes]:
    head, gap, body = content.partition(b"\r\n\r\n")
    return (head + gap).decode("latin-1"), body


def http_field(head: str, name: str) -> str | None:
    found = re.search(rf"(?im)^{re.escape(name)}:[ \t]*(.*?)[ \t]*\r?$", head)
    return found[1] if found else None


def warc_record(record_id: str, kind: str, date: str, url: str, digest: str, head: str, payload: str, refers: str | None) -> str:
    """One WARC record, without the two line ends that follow it."""
    block = head if kind == "revisit" else head + payload
    raw = block.encode()
    lines = [WARC_VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {date}", f"WARC-Target-URI: {url}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{hashlib.sha1(raw).hexdigest()}"]
    if kind == "revisit":
        lines += [f"WARC-Refers-To: <{refers}>", f"WARC-Profile: {SAME_PAYLOAD}"]
    lines += [f"Content-Type: {RESPONSE_TYPE}", f"Content-Length: {len(raw)}"]
    return "\r\n".join(lines) + "\r\n\r\n" + block


def parse_warc(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of every record, cut by the declared lengths."""
    data, at = _whole(raw), 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise BrokenArchive(f"no record header at {at}")
        lines = data[at:end].decode().split("\r\n")[1:]
        head = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
        length = int(head["content-length"])
        block = data[end + 4 : end + 4 + length]
        at = end + 4 + length
        if len(block) != length or data[at : at + 4] != b"\r\n\r\n":
            raise BrokenArchive(f"declared length does not fit before {at}")
        at += 4
        yield head, block


def _iso(date: str) -> str:
    return f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"


def _page(head: str) -> int | None:
    value = http_field(head, "X-Page-Id")
    return int(value) if value else None


def write_arcs(pages: DataFrame, path: str, per_file: int = PER_FILE) -> None:
    """ARC files of the pages under ``path``; files of both versions take turns. The version block opens every file."""

    def lines(batches):
        n = 0
        for batch in batches:
            ids, urls, htmls = (batch.column(c).to_pylist() for c in range(3))
            for at in range(0, len(ids), 64):
                out = []
                for page, url, html in zip(ids[at : at + 64], urls[at : at + 64], htmls[at : at + 64]):
                    version = 1 + n // (per_file - 1) % 2
                    if n % (per_file - 1) == 0:
                        out.append(version_block(version, f"pages-{n // (per_file - 1)}.arc"))
                    out.append(arc_record(version, page, url, html))
                    n += 1
                yield pa.record_batch([pa.array(out, pa.string())], ["value"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string"), F.col("html").cast("string"))
    _write(rows.mapInArrow(lines, "value string"), path, "\n", per_file)


def _write(records: DataFrame, path: str, end: str, per_file: int) -> None:
    options = {"lineSep": end, "compression": "gzip", "zlib.compress.level": LEVEL, "maxRecordsPerFile": per_file}
    records.write.options(**options).text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def _records(name: str, raw: bytes, payloads: bool = True) -> Iterator[dict]:
    """Records of one ARC file with what WARC needs: identifier from file and offset, ISO date, digest."""
    for offset, fields, content in parse_arc(raw):
        head, payload = split_http(content)
        mark = hashlib.sha1(f"{name.rsplit('/', 1)[-1]}:{offset}".encode()).digest()[:16]
        yield {
            "record_id": f"urn:uuid:{uuid.UUID(bytes=mark, version=5)}", "page_id": _page(head), "url": fields["URL"],
            "date": _iso(fields["Archive-date"]), "payload_bytes": len(payload),
            "payload_digest": hashlib.sha1(payload).hexdigest(), "head": head,
            "payload": payload.decode() if payloads else None, "file": name,
        }


def read_arcs(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of ARC files with what WARC needs, and the file each stands in."""

    def parse(batches):
        for batch in batches:
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                yield pa.RecordBatch.from_pylist(list(_records(name, raw.as_py(), payloads)), schema=ARC_SCHEMA)

    return _files(spark, path).mapInArrow(parse, PARSED)


ARC_SCHEMA = pa.schema([
    ("record_id", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("date", pa.string()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("head", pa.string()), ("payload", pa.string()), ("file", pa.string()),
])
WARC_SCHEMA = pa.schema([
    ("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("date", pa.string()),
    ("refers_id", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.string()),
])


def read_warcs(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of WARC files. Digests of blocks and of payloads that are there are computed again and must agree."""

    def parse(batches):
        for batch in batches:
            for raw in batch.column(1):
                rows = []
                for fields, block in parse_warc(raw.as_py()):
                    kind = fields["warc-type"]
                    if kind not in ("response", "revisit"):
                        continue
                    head, payload = split_http(block)
                    digest = fields["warc-payload-digest"].removeprefix("sha1:")
                    sums = [(fields["warc-block-digest"].removeprefix("sha1:"), block)] + [(digest, payload)] * (kind == "response")
                    if any(want != hashlib.sha1(part).hexdigest() for want, part in sums):
                        raise BrokenArchive(f"digest of {fields['warc-record-id']}")
                    rows.append({
                        "record_id": fields["warc-record-id"].strip("<>"), "record_type": kind, "page_id": _page(head),
                        "url": fields["warc-target-uri"], "date": fields["warc-date"],
                        "refers_id": fields["warc-refers-to"].strip("<>") if kind == "revisit" else None,
                        "payload_bytes": int(http_field(head, "Content-Length")) if kind == "revisit" else len(payload),
                        "payload_digest": digest, "payload": payload.decode() if payloads and kind == "response" else None,
                    })
                yield pa.RecordBatch.from_pylist(rows, schema=WARC_SCHEMA)

    return _files(spark, path).mapInArrow(parse, READ_BACK)


def convert(spark: SparkSession, arcs: str, warcs: str, least: int = LEAST_REVISIT, per_file: int = PER_FILE) -> None:
    """ARC files under ``arcs`` to WARC files under ``warcs``.

    Records with equal payloads of at least ``least`` bytes keep one response, that with the largest page id (then the
    largest identifier); the others become revisits of it. Decisions are made on identifiers and digests alone.
    """
    _write(_converted(spark, arcs, least), warcs, "\r\n\r\n", per_file)


def _converted(spark: SparkSession, arcs: str, least: int) -> DataFrame:
    """The WARC records of ``convert``, as column ``value``."""
    marks = settle(
        read_arcs(spark, arcs, payloads=False).select("record_id", "page_id", "payload_bytes", "payload_digest", "file"), "marks"
    )
    large = marks.where(F.col("payload_bytes") >= least)
    # null ids come first, so any id is larger
    newest = large.groupBy("payload_digest", "payload_bytes").agg(
        F.max(F.struct("page_id", "record_id")).alias("kept"), F.count(F.lit(1)).alias("n")
    ).where("n > 1").select("payload_digest", "payload_bytes", F.col("kept.record_id").alias("refers"))
    revisits = large.join(newest, ["payload_digest", "payload_bytes"]).where("record_id <> refers")
    # as many as the file has records at most
    of_file = revisits.groupBy(F.col("file").alias("path")).agg(
        F.collect_list("record_id").alias("revisits"), F.collect_list("refers").alias("refers")
    )

    def lines(batches):
        for batch in batches:
            names, revisits, refers = (batch.column(c).to_pylist() for c in (0, 2, 3))
            for name, raw, ids, targets in zip(names, batch.column(1), revisits, refers):
                target = dict(zip(ids or (), targets or ()))
                out = []
                for r in _records(name, raw.as_py()):
                    to = target.get(r["record_id"])
                    out.append(warc_record(
                        r["record_id"], "revisit" if to else "response", r["date"], r["url"], r["payload_digest"], r["head"], r["payload"], to,
                    ))
                    if len(out) == 64:
                        yield pa.record_batch([pa.array(out, pa.string())], ["value"])
                        out = []
                if out:
                    yield pa.record_batch([pa.array(out, pa.string())], ["value"])

    files = _files(spark, arcs).join(of_file, "path", "left").select("path", "content", "revisits", "refers")
    return files.mapInArrow(lines, "value string")


def archived(pages: DataFrame) -> DataFrame:
    """Pages through ARC and WARC and back: ``page_id, payload_bytes, payload_digest, record_type, refers_to``.

    Only ``page_id``, ``url`` and ``html`` are read; other columns, whatever their names, play no part. One row per row.

    * null html is an empty payload, always a response; long pages are records like any other;
    * a null url is written as a dash, blanks in urls are percent-encoded; a null ``page_id`` stays null;
    * ties: of repeated rows of the largest page id one is the response, the others revisit it under that id;
    * an empty table gives an empty result.
    """
    spark = pages.sparkSession
    arcs, warcs = fresh_path(spark, "arcs"), fresh_path(spark, "warcs")
    write_arcs(pages, arcs)
    convert(spark, arcs, warcs)
    back = settle(read_warcs(spark, warcs, payloads=False).drop("payload"), "records")
    met = back.where("record_type = 'revisit'").select("refers_id").distinct()
    target = back.select(F.col("record_id").alias("refers_id"), F.col("page_id").alias("refers_to")).join(met, "refers_id", "left_semi")
    return back.join(target, "refers_id", "left").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
