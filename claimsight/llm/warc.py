"""WARC archives: a writer on Spark's text sink and a splittable reader.

Archives are gzip files with one member per record. The writer gives member bytes to Spark's
text sink with an empty gzip member as line separator, so files are valid gzip throughout and
are written and committed by Spark, on any store. The reader cuts files into byte ranges; a
task scans its range for the gzip magic, proves a candidate by decoding it up to a WARC version
line, and owns the records whose member starts inside its range.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimsight.session import materialize, work_path

MAGIC = b"\x1f\x8b\x08"
#: A gzip member of no data.
EMPTY_MEMBER = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\x03\x03\x00" + bytes(8)
RANGE_BYTES = 8 << 20
READ_BYTES = 1 << 20
#: Payloads from this size on are revisited.
LEAST_REVISIT = 100
DATE = "2024-01-01T00:00:00Z"

RECORD = (
    "page_id long, url string, record_type string, refers_to long, "
    "payload_bytes long, payload_digest string"
)


def member(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, digest: str) -> bytes:
    """One WARC/1.1 record as a gzip member. A revisit has the HTTP head only.

    The record id holds key and digest, so rows of one key with several payloads differ.
    """
    head = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    name = "none" if page_id is None else str(page_id)
    uri = (url or f"urn:page:{name}").encode("unicode_escape").decode("ascii").replace(" ", "%20")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{name}:{digest}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if refers_to is not None:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{refers_to}:{digest}>",
        ]
    body = head if refers_to is not None else head + payload
    lines.append(f"Content-Length: {len(body)}")
    record = "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def revisits(pages: DataFrame, key: str, html: str) -> DataFrame:
    """The pages with ``digest`` and, for copies of an earlier payload, ``refers_to``.

    Only small rows are grouped: key, length and digest; copies are combined before the
    shuffle. The join back is on the digest; Spark splits a hot one.
    """
    body = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.withColumn("digest", F.sha2(body, 256))
    first = (
        rows.filter(F.octet_length(body) >= LEAST_REVISIT)
        .groupBy("digest")
        .agg(F.min(key).alias("first_id"), F.count("*").alias("copies"))
        .filter("copies > 1")
        .drop("copies")
    )
    first = materialize(first, "warc-first")
    return rows.join(first, "digest", "left").withColumn(
        "refers_to", F.when(~F.col(key).eqNullSafe(F.col("first_id")), F.col("first_id"))
    ).drop("first_id")


def write_archives(
    pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html"
) -> None:
    """Write one record per row to gzip archives below ``path``.

    Of rows with equal payloads of at least LEAST_REVISIT bytes the one with the smallest key
    is a response and the others revisit it; smaller payloads are all responses. A null
    payload is empty, a null key is written as such, repeated rows are written each.
    """
    lean = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                rows = batch.slice(lo, 256).to_pylist()
                made = [
                    member(r["page_id"], r["url"], (r["html"] or "").encode(), r["refers_to"], r["digest"])
                    for r in rows
                ]
                yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["member"])

    rows = revisits(lean, "page_id", "html").select("page_id", "url", "html", "digest", "refers_to")
    (
        rows.mapInArrow(run, "member binary")
        .select(F.col("member").cast("string").alias("value"))
        .write.option("lineSep", EMPTY_MEMBER.decode("latin-1"))
        .option("encoding", "ISO-8859-1")
        .text(path)
    )


def _opened(path: str):
    """File system and path of a URI as Spark lists it (``file:/a`` and ``file:///a``)."""
    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), parts.path
    return fs.FileSystem.from_uri(path)


class Window:
    """A byte window of a file that grows forward as it is read."""

    def __init__(self, file, start: int, size: int):
        self.file, self.size, self.base, self.data = file, size, start, b""

    def at(self, offset: int, least: int) -> bytes:
        """Bytes from ``offset`` on, at least ``least`` unless the file ends; drops what is before."""
        if offset > self.base:
            self.data = self.data[offset - self.base :]
            self.base = offset
        while len(self.data) < least and self.base + len(self.data) < self.size:
            self.file.seek(self.base + len(self.data))
            got = self.file.read(max(READ_BYTES, least - len(self.data)))
            if not got:
                break
            self.data += got
        return self.data


def _decode(window: Window, offset: int) -> tuple[bytes, int] | None:
    """A whole member's data and where it ends, or None if no record member starts here."""
    unpack = zlib.decompressobj(31)
    out, at = [], offset
    first = True
    while not unpack.eof:
        data = _chunk(window, at)
        if not data:
            return None
        try:
            out.append(unpack.decompress(data))
        except zlib.error:
            return None
        at += len(data) - len(unpack.unused_data)
        if first and (got := b"".join(out))[:5]:
            if not b"WARC/".startswith(got[:5]) and not got.startswith(b"WARC/"):
                return None
            first = len(got) < 5
    return b"".join(out), at


def _chunk(window: Window, at: int) -> bytes:
    """The next bytes for decoding, without dropping what the scan still needs."""
    skip = at - window.base
    if skip < len(window.data):
        return window.data[skip : skip + READ_BYTES]
    if at >= window.size:
        return b""
    window.file.seek(at)
    return window.file.read(READ_BYTES)


def _records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower case) and block of each record of a member."""
    at = 0
    while data.startswith(b"WARC/", at):
        end = data.index(b"\r\n\r\n", at)
        fields = {}
        for line in data[at:end].decode("utf-8", "replace").split("\r\n")[1:]:
            k, _, v = line.partition(":")
            fields[k.strip().lower()] = v.strip()
        size = int(fields["content-length"])
        yield fields, data[end + 4 : end + 4 + size]
        at = end + 4 + size + 4


def scan(path: str, start: int, end: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records whose member starts at an offset in [start, end)."""
    where, name = _opened(path)
    with where.open_input_file(name) as file:
        window = Window(file, start, file.size())
        at = start
        sure = start == 0
        while at < end:
            data = window.at(at, len(EMPTY_MEMBER) + 2)
            if not data:
                return
            if not data.startswith(MAGIC):
                if sure:
                    raise ValueError(f"{path}: no gzip member at {at}")
                hit = data.find(MAGIC)
                at += hit if hit >= 0 else max(1, len(data) - 2)
                continue
            if data.startswith(EMPTY_MEMBER):
                at += len(EMPTY_MEMBER)
                continue
            found = _decode(window, at)
            if found is None:
                if sure:
                    raise ValueError(f"{path}: broken member at {at}")
                at += 1
                continue
            yield from _records(found[0])
            at, sure = found[1], True


def _number(urn: str | None) -> int | None:
    text = (urn or "").strip("<>").removeprefix("urn:page:").split(":")[0]
    return int(text) if text.lstrip("-").isdigit() else None


def read_archives(spark, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Records of all archives below ``path`` with length and digest of their full payload.

    Files are listed by Spark and cut into byte ranges; each range is a row that a task
    scans. A revisit names the digest of its payload and takes the length from the response
    of that digest that it refers to.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "length").filter("length > 0")
    ranges = files.select(
        "path",
        "length",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long"))).alias("start"),
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = "page_id url record_type refers_to payload_bytes payload_digest".split()
        for frame in frames:
            for name, start in zip(frame["path"], frame["start"]):
                rows = []
                for fields, block in scan(name, int(start), int(start) + range_bytes):
                    kind = fields["warc-type"]
                    payload = block[block.find(b"\r\n\r\n") + 4 :]
                    whole = kind != "revisit"
                    rows.append((
                        _number(fields.get("warc-record-id")),
                        fields.get("warc-target-uri"),
                        kind,
                        _number(fields.get("warc-refers-to")),
                        len(payload) if whole else None,
                        hashlib.sha256(payload).hexdigest()
                        if whole
                        else fields["warc-payload-digest"].removeprefix("sha256:"),
                    ))
                    if len(rows) >= 5000:
                        yield pd.DataFrame(rows, columns=columns).astype(_NULLABLE)
                        rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=columns).astype(_NULLABLE)

    # One range per row: spread them, or the few rows of the listing stay in one task.
    spread = ranges.repartition(max(1, spark.sparkContext.defaultParallelism * 4), "path", "start")
    records = materialize(spread.mapInPandas(run, RECORD), "warc-records")
    at = ["refers_to", "payload_digest"]
    again = records.filter("record_type = 'revisit'").drop("payload_bytes")
    known = records.filter("record_type = 'response'")
    lengths = (
        known.select(F.col("page_id").alias("refers_to"), "payload_digest", "payload_bytes")
        .join(again.select(at).distinct(), at, "left_semi")
        .groupBy(at)
        .agg(F.min("payload_bytes").alias("payload_bytes"))
    )
    again = again.join(lengths, at, "left").select(known.columns)
    return known.select(again.columns).unionByName(again)


_NULLABLE = {"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "Int64"}


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write the pages to archives in the shared work folder and read these back.

    One row per page row. Null and empty payloads are responses of 0 bytes. A null key stays
    null; among equal payloads it revisits the smallest key, if any. Rows that repeat a key
    with the same payload are all responses. An empty table gives no rows; other columns are
    ignored.
    """
    path = work_path(pages.sparkSession, "warc")
    write_archives(pages, path, key, url, html)
    return read_archives(pages.sparkSession, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
