"""WARC archives in Zstandard: written from pages, read back and validated.

An archive starts with a skippable frame that holds the dictionary of its records; every record is
one frame. The reader loads the dictionary, decodes frame by frame and checks each record: version
line, required headers, block length, the empty lines at its end, and digests; a fault raises.

Pages whose payloads (UTF-8 html, null: empty) have equal SHA-1 digests and at least
`revisit_bytes` bytes are written once: the one with the largest page_id is the response, the
others are revisits that name it. Records of smaller payloads are all responses.

Null urls leave out the target header; control characters in urls are percent-encoded. A null
page_id has an empty record id and is never the largest beside others; rows of one payload that
share the largest page_id (or have only null ids) are all responses. An empty table gives no
archive and no rows; extra columns are not read. Archives are closed at about `archive_bytes`, so
each is read by one task. A lost task writes its archives anew under the same names.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.common import SharedFile, open_shared, pick, shared

DICTIONARY_MAGIC = 0x184D2A5D  # fixed: the skippable frame of a dictionary
ZSTD_DICTIONARY, ZSTD_FRAME = 0xEC30A437, 0xFD2FB528  # fixed: first bytes of its content
READ = 1 << 20
SAMPLE_RECORDS, SAMPLE_BYTES, DICT_BYTES = 200, 4 << 20, 65_536
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in fields)]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def http_head(length: int) -> bytes:
    lines = ("HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {length}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n"


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_record(page_id: int | None, url: str | None, html: str | None, refers_to: int | None, date: str) -> bytes:
    """A response, or a revisit of the response of page `refers_to`."""
    payload = (html or "").encode("utf-8")
    fields = [("WARC-Record-ID", record_id(page_id)), ("WARC-Date", date)]
    if url:
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        fields.append(("WARC-Target-URI", safe))
    fields.append(("Content-Type", "application/http; msgtype=response"))
    fields.append(("WARC-Payload-Digest", "sha1:" + payload_digest(payload)))
    if refers_to is None:
        return record("response", fields, http_head(len(payload)) + payload)
    fields += [("WARC-Refers-To", record_id(refers_to)), ("WARC-Profile", REVISIT_PROFILE)]
    return record("revisit", fields, http_head(len(payload)))


class ArchiveWriter:
    """One archive: the first records train its dictionary, then all are written frame by frame."""

    def __init__(self, uri: str) -> None:
        self.out = SharedFile(uri)
        self.waiting: list[bytes] | None = []
        self.waiting_bytes = 0
        self.compressor = zstandard.ZstdCompressor(level=3, write_checksum=True)

    @property
    def size(self) -> int:
        return self.out.size + self.waiting_bytes

    def add(self, data: bytes) -> None:
        if self.waiting is None:
            self.out.write(self.compressor.compress(data))
            return
        self.waiting.append(data)
        self.waiting_bytes += len(data)
        if len(self.waiting) >= SAMPLE_RECORDS or self.waiting_bytes >= SAMPLE_BYTES:
            self._begin()

    def _begin(self) -> None:
        waiting, self.waiting, self.waiting_bytes = self.waiting or [], None, 0
        size = min(DICT_BYTES, max(1024, sum(map(len, waiting)) // 10))
        try:
            trained = zstandard.train_dictionary(size, waiting)
        except zstandard.ZstdError:  # too little to train on
            trained = None
        if trained:
            held = zstandard.ZstdCompressor(level=9).compress(trained.as_bytes())
            self.out.write(struct.pack("<II", DICTIONARY_MAGIC, len(held)) + held)
            self.compressor = zstandard.ZstdCompressor(level=3, dict_data=trained, write_checksum=True)
        for data in waiting:
            self.out.write(self.compressor.compress(data))

    def close(self) -> None:
        if self.waiting is not None:
            self._begin()
        self.out.close()


class _Source:
    """A stream with the bytes that a frame left over in front of it."""

    def __init__(self, stream) -> None:
        self.stream, self.rest = stream, b""

    def take(self, n: int) -> bytes:
        while len(self.rest) < n and (more := self.stream.read(max(READ, n))):
            self.rest += more
        out, self.rest = self.rest[:n], self.rest[n:]
        return out

    def chunk(self) -> bytes:
        out, self.rest = self.rest or self.stream.read(READ), b""
        return out


def frames(stream) -> Iterator[bytes]:
    """Decoded frames of an archive, one at a time, the dictionary loaded before the first."""
    source = _Source(stream)
    head = source.take(8)
    options = {}
    if len(head) == 8 and struct.unpack("<I", head[:4])[0] == DICTIONARY_MAGIC:
        length = struct.unpack("<I", head[4:])[0]
        content = source.take(length)
        if len(content) < max(length, 4):
            raise ValueError("dictionary frame is cut short")
        magic = struct.unpack("<I", content[:4])[0]
        if magic == ZSTD_FRAME:
            content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
        elif magic != ZSTD_DICTIONARY:
            raise ValueError("dictionary frame holds no dictionary")
        options = {"dict_data": zstandard.ZstdCompressionDict(content)}
    else:
        source.rest = head + source.rest
    decompressor = zstandard.ZstdDecompressor(**options)
    while chunk := source.chunk():
        frame, out = decompressor.decompressobj(), []
        while True:
            out.append(frame.decompress(chunk))
            if frame.eof:
                source.rest = frame.unused_data
                break
            chunk = source.chunk()
            if not chunk:
                raise ValueError("last frame is cut short")
        yield b"".join(out)


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and block of one record, checked."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not found or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError(f"no WARC record: {data[:40]!r}")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise ValueError(f"bad header line {line!r}")
        fields[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise ValueError(f"header {name} is missing")
    if not fields["content-length"].isdecimal():
        raise ValueError(f"content-length {fields['content-length']!r}")
    length = int(fields["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"record has {len(rest) - 4} bytes of {length}")
    return fields, rest[:length]


def page_of(value: str | None) -> int | None:
    if value is None:
        return None
    m = re.fullmatch(r"<urn:page:(-?\d*)>", value)
    if not m:
        raise ValueError(f"record id {value!r}")
    return int(m[1]) if m[1] else None


def page_row(data: bytes, payloads: bool = True) -> tuple:
    """(page_id, url, html bytes or None, payload_bytes, payload_digest, type, refers_to)."""
    fields, block = parse(data)
    head, found, payload = block.partition(b"\r\n\r\n")
    m = re.search(rb"(?mi)^Content-Length: *(\d+)\r?$", head + b"\r")
    if not found or not m:
        raise ValueError("block has no HTTP headers")
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    kind = fields["warc-type"]
    if kind == "response":
        if len(payload) != int(m[1]) or payload_digest(payload) != digest:
            raise ValueError(f"payload of {fields['warc-record-id']} differs from its length or digest")
    elif kind != "revisit" or payload or "warc-refers-to" not in fields:
        raise ValueError(f"record type {kind!r} or its block is not what a page has")
    return (
        page_of(fields["warc-record-id"]),
        fields.get("warc-target-uri"),
        payload if payloads and kind == "response" else None,
        int(m[1]),
        digest,
        kind,
        page_of(fields.get("warc-refers-to")),
    )


def with_responses(pages: DataFrame, revisit_bytes: int = 0) -> DataFrame:
    """pages with `refers_to`: null for a response, else the page_id of the response it repeats."""
    own = pick(pages, "page_id", "url", "html")
    data = F.coalesce("html", F.lit("")).cast("binary")
    keyed = own.withColumn("digest", F.unhex(F.sha1(data)))
    long_enough = F.octet_length(F.coalesce("html", F.lit(""))) >= revisit_bytes
    repeated = (
        keyed.where(long_enough)
        .groupBy("digest")
        .agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
        .where((F.col("n") > 1) & F.col("first").isNotNull())
        .drop("n")
    )
    joined = keyed.join(repeated, "digest", "left")
    is_first = F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select("page_id", "url", "html", F.when(~is_first, F.col("first")).alias("refers_to"))


def write(pages: DataFrame, revisit_bytes: int = 0, archive_bytes: int = 64 << 20) -> list[str]:
    """Write a record per page to archives in shared storage; returns the archives' paths."""
    _, folder = shared(pages.sparkSession, "warc")
    date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, out = TaskContext.get().partitionId(), 0, None
        made = []
        for batch in batches:
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    made.append(f"{folder}/part-{part:06d}-{number:04d}.warc.zst")
                    out, number = ArchiveWriter(made[-1]), number + 1
                out.add(page_record(page_id, url, html, refers_to, date))
                if out.size >= archive_bytes:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array(made, pa.string())], names=["path"])

    rows = with_responses(pages, revisit_bytes).mapInArrow(run, "path string")
    return sorted({r["path"] for r in rows.collect()})


def read(spark: SparkSession, paths: list[str], payloads: bool = True) -> DataFrame:
    """The records of archives: page_id, url, html (null in revisits, and without `payloads`),
    payload_bytes, payload_digest, record_type, refers_to. Archives are dealt out over tasks."""
    fields = (
        "page_id long, url string, html binary, payload_bytes long, payload_digest string, "
        "record_type string, refers_to long"
    )
    schema = pa.schema(
        [
            ("page_id", pa.int64()),
            ("url", pa.string()),
            ("html", pa.binary()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
        ]
    )

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = [[r[i] for r in rows] for i in range(len(schema))]
        arrays = [pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, size = [], 0
                with open_shared(path) as stream:
                    for data in frames(stream):
                        rows.append(page_row(data, payloads))
                        size += len(data)
                        if size >= 8 << 20:
                            yield batch_of(rows)
                            rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    listed = spark.createDataFrame([(p,) for p in paths], "path string")
    if paths:
        listed = listed.repartition(len(paths))
    return listed.mapInArrow(run, fields)


def archived(pages: DataFrame, revisit_bytes: int = 0) -> DataFrame:
    """Write all pages to archives and list what reading them gives."""
    paths = write(pages, revisit_bytes)
    rows = read(pages.sparkSession, paths, payloads=False)
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
