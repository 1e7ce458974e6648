"""Legacy archive converter: ARC files to WARC files, both read by declared lengths.

An ARC file starts with a version block whose second line names the version; its record headers are one line,
``URL IP-address Archive-date Content-type Archive-length`` in version 1 and ``URL IP-address Archive-date
Content-type Result-code Checksum Location Offset Filename Archive-length`` in version 2, followed by that many bytes and a
line feed. ``read_arc`` parses the header by the file's version and takes the payload by its declared length; nothing inside a
payload can be mistaken for a header. ``to_warc`` synthesises what WARC asks for and ARC lacks: a record id
(UUID version 5 of the target, the date and the block's digest, so that a repeated conversion gives the same
ids), a 14-digit date as an ISO 8601 timestamp, the type (``warcinfo`` for the version block, ``response``
for HTTP, ``revisit`` for a payload that another record already holds, ``resource`` for other content) and
the block and payload digests (base32 SHA-1). ``read_warc`` parses the result, again by declared lengths.

The first record of a payload (the smallest sequence number) is the response; later ones are revisits that
name it and carry the HTTP header only. The first record of each digest is found by a combined ``min`` and
given back by a join in which digests of very many records are broadcast (``frames.attach``).

Files are written by Spark's text writer, one per task, so any file system works; a file is a complete
archive. They are one gzip stream each (``.txt.gz``), read back with a streaming decompressor.

Defined cases: null html is an empty payload; a null url is ``about:blank``, white space and control characters in a
url are percent-encoded; payloads may hold any text, header-like lines included; rows with one page_id are
separate records (the smaller file position comes first among equal ids); a null page_id sorts after all others
and stays null; an empty table gives no file and an empty result; other columns are ignored. A file that
ends inside a record, or a header with the wrong number of fields, raises an error: nothing is skipped.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwell.llm.frames import attach, cut_lineage, read
from rankwell.session import ensure_checkpoint_dir

V1_FIELDS = "URL IP-address Archive-date Content-type Archive-length"
V2_FIELDS = "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"
PAGE_HEADER = "X-Page-Id"
_CHUNK = 1 << 20
#: Compressing takes most of the time of writing; the third level takes much less of it than the sixth for slightly larger archives.
LEVEL = ("zlib.compress.level", "THREE")


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# --- streams ---------------------------------------------------------------------------------------------

class ByteStream:
    """Lines and exact lengths from a (gzip or plain) file's bytes, decompressed piece by piece."""

    def __init__(self, data: bytes):
        self._pieces = self._inflate(data) if data[:2] == b"\x1f\x8b" else (data[i:i + _CHUNK] for i in range(0, len(data), _CHUNK))
        self._have = bytearray()
        self._at = 0

    @staticmethod
    def _inflate(data: bytes) -> Iterator[bytes]:
        view, at = memoryview(data), 0
        while at < len(view):
            inflate = zlib.decompressobj(31)
            while not inflate.eof:
                if at >= len(view):
                    raise ValueError("the gzip stream ends too early")
                piece = view[at:at + _CHUNK]
                at += len(piece)
                yield inflate.decompress(piece)
            at -= len(inflate.unused_data)

    def _more(self) -> bool:
        piece = next(self._pieces, None)
        if piece is None:
            return False
        del self._have[:self._at]
        self._at = 0
        self._have += piece
        return True

    def line(self) -> bytes | None:
        """The next line without its line feed; None at the end."""
        start = 0
        while True:
            end = self._have.find(b"\n", self._at + start)
            if end >= 0:
                out = bytes(self._have[self._at:end])
                self._at = end + 1
                return out
            start = len(self._have) - self._at
            if not self._more():
                if start:
                    raise ValueError("the file ends inside a line")
                return None

    def exactly(self, n: int) -> bytes:
        while len(self._have) - self._at < n:
            if not self._more():
                raise ValueError(f"the file ends inside a record: {n} bytes were declared")
        out = bytes(self._have[self._at:self._at + n])
        self._at += n
        return out


# --- ARC -------------------------------------------------------------------------------------------------

def arc_records(data: bytes) -> Iterator[dict]:
    """Every record of an ARC file, the version block first."""
    stream = ByteStream(data)
    head = stream.line()
    if head is None:
        return
    fields = head.decode().split(" ")
    block = stream.exactly(int(fields[-1]))
    version = int(block.split(b"\n", 1)[0].split(b" ")[0])
    names = {1: V1_FIELDS, 2: V2_FIELDS}.get(version)
    if names is None or not head.startswith(b"filedesc:"):
        raise ValueError(f"not an ARC file of version 1 or 2: {head[:80]!r}")
    names = names.split(" ")
    yield {"url": fields[0], "date": fields[2], "type": fields[3], "version": version, "block": block}
    while (line := stream.line()) is not None:
        if not line:
            continue  # the line feed after a record
        values = line.decode().split(" ")
        if len(values) != len(names):
            raise ValueError(f"a version {version} header has {len(names)} fields: {line[:80]!r}")
        record = dict(zip(names, values))
        yield {"url": record["URL"], "date": record["Archive-date"], "type": record["Content-type"], "version": version,
               "block": stream.exactly(int(record["Archive-length"]))}


def write_arc(pages: DataFrame, path: str, version: int = 1, date: str = "20240101000000") -> None:
    """``pages`` (page_id, url, html) as ARC files of version 1 or 2, one per partition."""
    encode = F.coalesce(F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20"), F.lit(""))
    url = F.when(encode == "", "about:blank").otherwise(encode)
    html = F.coalesce(F.col("html"), F.lit(""))
    page = F.coalesce(F.concat(F.lit(f"{PAGE_HEADER}: "), F.col("page_id").cast("string"), F.lit("\r\n")), F.lit(""))
    block = F.concat(F.lit("HTTP/1.0 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"), page, F.lit("Content-Length: "),
                     F.octet_length(html).cast("string"), F.lit("\r\n\r\n"), html)
    names = {1: V1_FIELDS, 2: V2_FIELDS}[version]
    head = f"{version} 0 rankwell\n{names}\n"
    middle = F.lit(f" 0.0.0.0 {date} text/html" + (" 200 - - 0 -" if version == 2 else "") + " ")
    top = f"filedesc://pages.arc 0.0.0.0 {date} text/plain{' 200 - - 0 -' if version == 2 else ''} {len(head)}\n{head}\n"
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    record = F.concat(F.when(first, top).otherwise(""), url, middle, F.octet_length(block).cast("string"), F.lit("\n"), block)
    pages.select(record.alias("value")).write.option(*LEVEL).text(path, compression="gzip", lineSep="\n")


def _http(block: bytes) -> tuple[bytes, bytes]:
    """The HTTP header with its blank line, and the payload."""
    end = block.find(b"\r\n\r\n")
    return (block[:end + 4], block[end + 4:]) if block.startswith(b"HTTP/") and end >= 0 else (b"", block)


def read_arc(spark, path: str) -> DataFrame:
    """A row per record but the version blocks: file, place, url, date, type, page_id, header, payload_bytes,
    payload_digest, packed (the payload, Zstandard)."""
    def run(batches):
        z = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for file, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows, size = [], 0
                for place, r in enumerate(arc_records(data.as_py())):
                    if place == 0:
                        continue
                    header, payload = _http(r["block"])
                    page = next((int(x.split(b":")[1]) for x in header.split(b"\r\n") if x.startswith(PAGE_HEADER.encode())), None)
                    rows.append((file, place, r["url"], r["date"], r["type"], page, header, len(payload), sha1_base32(payload), z.compress(payload)))
                    size += len(rows[-1][-1])
                    if size > 4 * _CHUNK:
                        yield _batch(rows)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows)

    def _batch(rows):
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.binary()]
        names = ["file", "place", "url", "date", "type", "page_id", "header", "payload_bytes", "payload_digest", "packed"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(
        run, "file string, place long, url string, date string, type string, page_id long, header binary, payload_bytes long, "
             "payload_digest string, packed binary")


# --- WARC ------------------------------------------------------------------------------------------------

def _timestamp(date: str) -> str:
    d = (date + "00000101000000"[len(date):])[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _record(kind: str, fields: list[tuple[str, str]], block: bytes, url: str, date: str, salt: str = "") -> bytes:
    digest = sha1_base32(block)
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url} {date} {digest} {kind} {salt}')}>"),
            ("WARC-Date", _timestamp(date)), *fields, ("WARC-Block-Digest", f"sha1:{digest}"), ("Content-Length", str(len(block)))]
    return b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def to_warc(records: DataFrame, path: str) -> None:
    """Converts the rows of ``read_arc`` into WARC files, equal payloads as revisits.

    The archives are read twice, once for the digests and once for the payloads: a table of the payloads
    would take as much disk as the archives.
    """
    seq = F.struct(F.col("page_id").isNull().alias("none"), F.col("page_id").alias("id"), "file", "place")
    keys = cut_lineage(records.select("payload_digest", F.struct(seq.alias("seq"), "url", "date").alias("first")))
    firsts = cut_lineage(keys.groupBy("payload_digest").agg(F.min("first").alias("first"), F.count(F.lit(1)).alias("n")))
    out = attach(records.withColumn("seq", seq), firsts, "payload_digest", "n", keys.count())

    def run(batches):
        z = zstandard.ZstdDecompressor()
        begun = False
        for batch in batches:
            texts = []
            for r in batch.to_pylist():
                if not begun:
                    info = b"software: rankwell\r\nformat: WARC File Format 1.0\r\n"
                    texts.append(_record("warcinfo", [("Content-Type", "application/warc-fields")], info, "urn:rankwell", r["date"],
                                         f"{r['file']}#{r['place']}"))
                    begun = True
                fields = [("WARC-Target-URI", r["url"]), ("WARC-Payload-Digest", f"sha1:{r['payload_digest']}")]
                first = r["first"]
                kind, block = ("response", r["header"] + z.decompress(r["packed"])) if r["header"] else ("resource", z.decompress(r["packed"]))
                if first["seq"] != r["seq"]:
                    kind, block = "revisit", r["header"]
                    fields += [("WARC-Profile", "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"),
                               ("WARC-Refers-To-Target-URI", first["url"]), ("WARC-Refers-To-Date", _timestamp(first["date"])),
                               *([("X-Refers-To-Page-Id", str(first["seq"]["id"]))] if first["seq"]["id"] is not None else []),
                               ("X-Payload-Length", str(r["payload_bytes"]))]
                fields.append(("Content-Type", "application/http; msgtype=response" if r["header"] else r["type"]))
                texts.append(_record(kind, fields, block, r["url"], r["date"], f"{r['file']}#{r['place']}"))
            yield pa.RecordBatch.from_arrays([pa.array([t[:-1] for t in texts], pa.binary())], names=["value"])

    out.mapInArrow(run, "value binary").select(F.col("value").cast("string")).write.option(*LEVEL).text(path, compression="gzip", lineSep="\n")


def warc_records(data: bytes) -> Iterator[tuple[dict, bytes]]:
    """(fields, block) of every record of a WARC file."""
    stream = ByteStream(data)
    while (line := stream.line()) is not None:
        if line in (b"", b"\r"):
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC header: {line[:80]!r}")
        fields = {}
        while (line := (stream.line() or b"").rstrip(b"\r")):
            name, value = line.decode().split(": ", 1)
            fields[name] = value
        yield fields, stream.exactly(int(fields["Content-Length"]))


def read_warc(spark, path: str) -> DataFrame:
    """A row per record but warcinfo: record_id, record_type, url, date, page_id, payload_bytes, payload_digest,
    refers_to (a page_id) and payload (null for revisits). Digests and lengths of payloads that the file holds
    are computed from them."""
    def run(batches):
        for batch in batches:
            for data in batch.column(0):
                rows, size = [], 0
                for fields, block in warc_records(data.as_py()):
                    kind = fields["WARC-Type"]
                    if kind == "warcinfo":
                        continue
                    if f"sha1:{sha1_base32(block)}" != fields["WARC-Block-Digest"]:
                        raise ValueError(f"{fields['WARC-Record-ID']}: the block does not have its digest")
                    header, payload = _http(block)
                    page = next((int(x.split(b":")[1]) for x in header.split(b"\r\n") if x.startswith(PAGE_HEADER.encode())), None)
                    held = kind != "revisit"
                    rows.append((fields["WARC-Record-ID"], kind, fields["WARC-Target-URI"], fields["WARC-Date"], page,
                                 len(payload) if held else int(fields["X-Payload-Length"]),
                                 sha1_base32(payload) if held else fields["WARC-Payload-Digest"].removeprefix("sha1:"),
                                 int(fields["X-Refers-To-Page-Id"]) if "X-Refers-To-Page-Id" in fields else None, payload if held else None))
                    size += len(block)
                    if size > 4 * _CHUNK:
                        yield _rows(rows)
                        rows, size = [], 0
                if rows:
                    yield _rows(rows)

    def _rows(rows):
        kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
        names = ["record_id", "record_type", "url", "date", "page_id", "payload_bytes", "payload_digest", "refers_to", "payload"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(
        run, "record_id string, record_type string, url string, date string, page_id long, payload_bytes long, payload_digest string, "
             "refers_to long, payload binary")


def convert(spark, arc_path: str, warc_path: str) -> DataFrame:
    """ARC files to WARC files; returns the records as read back from the latter."""
    to_warc(read_arc(spark, arc_path), warc_path)
    return read_warc(spark, warc_path)


def op3_warc(spark, sf_dir: str) -> DataFrame:
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/archive-{uuid.uuid4().hex}"
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    write_arc(pages.filter("page_id % 2 = 0"), f"{root}/arc/v1", 1)
    write_arc(pages.filter("page_id % 2 <> 0 or page_id is null"), f"{root}/arc/v2", 2)
    out = convert(spark, f"{root}/arc/*", f"{root}/warc")
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL = """
WITH h AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS hex FROM pages),
v AS (SELECT *, list_transform(range(0, 8), lambda g: CAST('0x' || substr(hex, CAST(g * 5 + 1 AS INT), 5) AS INT)) AS part FROM h),
d AS (
  SELECT page_id, n, array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(((part[CAST(i // 4 + 1 AS INT)] >> CAST(15 - 5 * (i % 4) AS INT)) & 31) + 1 AS INT), 1)), '') AS digest
  FROM v)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = min(page_id) OVER same THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> min(page_id) OVER same THEN min(page_id) OVER same END AS refers_to
FROM d WINDOW same AS (PARTITION BY digest)
"""
