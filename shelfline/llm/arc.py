"""Legacy archives (ARC) converted to WARC, written, and read back.

An ARC file begins with a version block that names the fields of its header
lines: version 1 has five (URL, IP address, archive date, content type, length),
version 2 ten (with result code, checksum, location, offset and file name).
Records are cut by the declared length, never by a delimiter. A converted
record gets what WARC asks for and ARC lacks: a record identifier (a name-based
UUID of its header line and payload), a W3C timestamp, a type, a block digest
and a payload digest (SHA-1, base32). Among records of equal payload one is the
``response`` and the others ``revisit`` it by reference, without the payload.

The archives are real files: the writer hands Spark one record a row and lets
its text sink end each with the blank lines that WARC asks for, so they land
wherever the shared folder is, gzip-compressed. The reader cuts them by their
``Content-Length`` again and resolves the revisits by record identifier.

Only identifiers, page ids and digests take part in the choice of the
response; payloads are joined with the repeated digests only, whose size Spark
checks before it broadcasts them.

Defined cases: a null html is an empty payload, a null url is ``about:blank``;
blanks and control characters of a url are percent-encoded; a page with a null
id is never preferred as the response, and the revisits of one have a null
``refers_to``; rows that agree in id, url and html are one capture written
several times under one identifier, all with the same type; equal payloads of
one id but different urls are ordered by record identifier; extra columns are
left out; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.common import new_folder, stored

ARCHIVE_BYTES = 4 << 20        # uncompressed size of an ARC built from pages
CAPTURED = "20260101000000"    # pages carry no date
V1 = "URL IP-address Archive-date Content-type Archive-length"
V2 = "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"


# ---------------------------------------------------------------- ARC

def arc_file(name: str, version: int, records) -> bytes:
    """An ARC file of (url, ip, date, content type, network document) records."""
    fields = V1 if version == 1 else V2
    block = f"{version} 0 shelfline\n{fields}\n".encode()
    head = f"filedesc://{name} 0.0.0.0 {CAPTURED} text/plain" + ("" if version == 1 else f" 200 - - 0 {name}")
    out, at = [f"{head} {len(block)}\n".encode(), block, b"\n"], 0
    at = sum(map(len, out))
    for url, ip, date, kind, body in records:
        line = f"{url} {ip} {date} {kind} "
        if version == 2:
            line += f"200 {hashlib.md5(body).hexdigest()} - {at} {name} "
        part = [f"{line}{len(body)}\n".encode(), body, b"\n"]
        out += part
        at += sum(map(len, part))
    return b"".join(out)


def arc_records(data: bytes) -> Iterator[tuple[dict, bytes]]:
    """(header fields, network document) of every record of an ARC file behind its version block."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    names, at = None, 0
    while at < len(data):
        end = data.index(b"\n", at)
        line = data[at:end].decode("utf-8", "surrogateescape").rstrip("\r")
        if not line:
            at = end + 1
            continue
        values = line.split(" ")
        size = int(values[-1])
        body = data[end + 1:end + 1 + size]
        if len(body) < size:
            raise ValueError(f"record at {at} is shorter than it says")
        at = end + 1 + size
        if names is None:
            if not line.startswith("filedesc://"):
                raise ValueError("an ARC file begins with its version block")
            version, fields = body.decode().split("\n")[:2]
            names = fields.split(" ")
            if version.split(" ")[0] not in ("1", "2") or len(names) != {"1": 5, "2": 10}[version.split(" ")[0]]:
                raise ValueError(f"unknown version block {body!r}")
            continue
        if len(values) != len(names):
            raise ValueError(f"a header line has {len(values)} fields, the version block names {len(names)}")
        yield dict(zip(names, values)), body


def http_document(page_id, html: bytes) -> bytes:
    """The network document of a page: its HTTP response."""
    who = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{who}Content-Length: {len(html)}\r\n\r\n".encode() + html


def http_parts(document: bytes) -> tuple[dict, bytes]:
    """(lower-case header fields, payload) of an HTTP response; without a header all is payload."""
    cut = document.find(b"\r\n\r\n")
    if not document.startswith(b"HTTP/") or cut < 0:
        return {}, document
    lines = document[:cut].decode("latin-1").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, document[cut + 4:]


def safe_url(url: str | None) -> str:
    return quote(url, safe="!#$%&'()*+,/:;=?@[]~|{}^`\"<>\\") if url else "about:blank"


def archives(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(path, content): the pages as ARC files of about ``ARCHIVE_BYTES``, versions 1 and 2 in turn.

    The file's name is that of its first record, so a repeated task makes the same files.
    """
    rows = pages.select(F.col(key).cast("long").alias("i"), F.col(url).alias("u"), F.coalesce(F.col(html), F.lit("")).alias("h"))

    def run(batches):
        held, size, made = [], 0, 0

        def close():
            nonlocal held, size, made
            name = hashlib.md5(b"".join(r[4][:200] for r in held[:8])).hexdigest() + ".arc"
            data = arc_file(name, 1 + made % 2, held)
            held, size, made = [], 0, made + 1
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([data], pa.binary())], names=["path", "content"])

        for b in batches:
            for i, u, h in zip(*(b.column(k).to_pylist() for k in range(3))):
                body = http_document(i, h.encode())
                held.append((safe_url(u), "0.0.0.0", CAPTURED, "text/html", body))
                size += len(body)
                if size >= ARCHIVE_BYTES:
                    yield close()
        if held:
            yield close()

    return rows.mapInArrow(run, "path string, content binary")


# ---------------------------------------------------------------- conversion

def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def timestamp(date: str) -> str:
    """The 14 digits of an ARC date (or their first 4 to 12) as a W3C timestamp."""
    d = (date + "00000101000000"[len(date):])[:14] if len(date) < 14 else date[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


CONVERTED = "record_id string, uri string, date string, ip string, page_id long, digest string, payload_bytes long, block binary"


def converted(arcs: DataFrame, slim: bool = False) -> DataFrame:
    """The records of ARC files ``(path, content)`` with the fields that WARC needs.

    With ``slim`` the block is left empty.
    """
    def run(batches):
        for b in batches:
            for data in b.column(1).to_pylist():
                rows, size = [], 0
                for head, body in arc_records(data):
                    http, payload = http_parts(body)
                    digest, who = base32_sha1(payload), http.get("x-page-id")
                    name = f"{head['URL']} {head['Archive-date']} {who} {digest}"
                    rows.append((f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>", head["URL"], timestamp(head["Archive-date"]),
                                 head["IP-address"], None if who is None else int(who), digest, len(payload), b"" if slim else body))
                    size += len(rows[-1][-1])
                    if size >= ARCHIVE_BYTES:
                        yield _batch(rows)
                        rows, size = [], 0
                yield _batch(rows)

    def _batch(rows):
        kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())
        cols = list(zip(*rows)) if rows else [()] * 8
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=[x.split()[0] for x in CONVERTED.split(", ")])

    return arcs.select("path", "content").mapInArrow(run, CONVERTED)


def with_types(records: DataFrame, slim: DataFrame) -> DataFrame:
    """``records`` plus ``origin`` (record_id, page_id, uri, date): null for responses, the response for revisits."""
    best = F.max(F.struct(F.col("page_id").isNotNull().alias("there"), "page_id", "record_id", "uri", "date"))
    repeated = (slim.groupBy("digest").agg(best.alias("origin"), F.min("record_id").alias("lo"), F.max("record_id").alias("hi"))
                .where("lo <> hi").select("digest", "origin"))
    # a written table: its size is known before the join is chosen
    repeated = stored(repeated, "warc-repeated")
    joined = records.join(repeated, "digest", "left")
    return joined.withColumn("origin", F.when(F.col("origin.record_id") != F.col("record_id"), F.col("origin")))


def _record(row) -> bytes:
    """A WARC record without its closing blank lines."""
    head = ["WARC/1.1", f"WARC-Type: {'response' if row['origin'] is None else 'revisit'}", f"WARC-Record-ID: {row['record_id']}",
            f"WARC-Target-URI: {row['uri']}", f"WARC-Date: {row['date']}", f"WARC-IP-Address: {row['ip']}",
            f"WARC-Payload-Digest: sha1:{row['digest']}"]
    block = row["block"]
    if row["origin"] is not None:
        o = row["origin"]
        head += [f"WARC-Refers-To: {o['record_id']}", f"WARC-Refers-To-Target-URI: {o['uri']}", f"WARC-Refers-To-Date: {o['date']}",
                 f"WARC-Profile: {PROFILE}", "WARC-Truncated: length"]
        block = block[:len(block) - row["payload_bytes"]]               # the HTTP header stays
    head += ["Content-Type: application/http; msgtype=response", f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
             f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + END.encode() + block


def write_warc(records: DataFrame, folder: str) -> None:
    """Write typed records as WARC files below ``folder``."""
    def run(batches):
        for b in batches:
            for k in range(0, b.num_rows, 256):
                made = [_record(r) for r in b.slice(k, 256).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["record"])

    # the sink writes the bytes as they are and ends every record with END
    (records.mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value"))
     .write.option("lineSep", END).option("compression", "gzip").text(folder))


# ---------------------------------------------------------------- reading

def warc_records(data: bytes) -> Iterator[tuple[dict, bytes]]:
    """(lower-case header fields, block) of the records of a WARC file."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at = 0
    while at < len(data):
        cut = data.index(b"\r\n\r\n", at)
        lines = data[at:cut].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at {at}")
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        end = cut + 4 + int(head["content-length"])
        if data[end:end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at {at} does not end where it says")
        yield head, data[cut + 4:end]
        at = end + 4


READ = "record_id string, record_type string, page_id long, payload_bytes long, payload_digest string, declared string, origin_id string"


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Records of the WARC files below ``folder``, checked against their digests; a revisit has no payload of its own."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gz").load(folder)

    def run(batches):
        for b in batches:
            for data in b.column(0).to_pylist():
                rows = []
                for head, block in warc_records(data):
                    if head["warc-block-digest"] != f"sha1:{base32_sha1(block)}":
                        raise ValueError(f"the block of {head['warc-record-id']} has changed")
                    http, payload = http_parts(block)
                    kind, who = head["warc-type"], http.get("x-page-id")
                    own = kind == "response"
                    rows.append((head["warc-record-id"], kind, None if who is None else int(who), len(payload) if own else None,
                                 base32_sha1(payload) if own else None, head["warc-payload-digest"].removeprefix("sha1:"),
                                 head.get("warc-refers-to")))
                kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
                cols = list(zip(*rows)) if rows else [()] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                                 names=[x.split()[0] for x in READ.split(", ")])

    return files.select("content").mapInArrow(run, READ)


def resolved(read: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to): revisits take size and digest from their response."""
    own = read.where("record_type = 'response'")
    held = (own.groupBy(F.col("record_id").alias("origin_id"))
            .agg(F.max("page_id").alias("refers_to"), F.max("payload_bytes").alias("o_bytes"), F.max("payload_digest").alias("o_digest")))
    # only revisits are joined: they alone have an origin
    revisits = read.where("record_type <> 'response'").join(held, "origin_id", "left").select(
        "page_id", F.col("o_bytes").alias("payload_bytes"), F.col("o_digest").alias("payload_digest"), "record_type", "refers_to", "declared")
    return own.select("page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"),
                      "declared").unionByName(revisits)


def pages_round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Pages to ARC, ARC to WARC files in the shared folder, and the files read back."""
    spark = pages.sparkSession
    arcs = archives(pages, key, url, html)
    folder = new_folder(spark, "warc")
    write_warc(with_types(converted(arcs), converted(arcs, slim=True)), folder)
    return resolved(stored(read_warc(spark, folder), "warc-read"))
