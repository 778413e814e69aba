"""WARC archives as seekable Zstandard bundles.

A bundle is a series of independent Zstandard frames of about ``FRAME`` bytes of records, then two
skippable frames: the record map (identifier, frame, offset within the frame's content, length) and a seek
table (compressed and plain size and a checksum of each frame) that ends in the seekable
format's footer.  One record is read by two small reads at the end and one frame.

Of records with equal payloads of ``REVISIT`` bytes or more, the one with the smallest page_id is a
response and the others revisit it; all shorter ones are responses.

Rows: a null html is an empty payload, a null url has no target.  A null page_id is written
without one, and revisits a known page with an equal payload.  Rows that share the smallest page_id are all
responses.  Further columns aren't read.  An empty table gives no bundles and an empty result.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .shared_files import Output, source

REVISIT = 100            # bytes from which equal payloads are written once
FRAME = 256 << 10        # bytes of records after which a frame ends
BUNDLE = 256 << 20       # bytes of a file after which the next begins
SALTS = 16               # a group of equal payloads is dealt to so many tasks
DATE = "2024-01-01T00:00:00Z"
# Fixed values of the seekable Zstandard format and of WARC
SKIP_MAP, SKIP_TABLE, SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "page_id bigint, file string, frame int, offset bigint, length bigint"
READ = ("page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, "
        "url string, file string, frame int, offset bigint")


def urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(name: str) -> int | None:
    number = name.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit holds the response's head but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {urn(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(f"%{ord(c):02X}" if ord(c) <= 0x20 or c == "%" else c for c in url))
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {urn(refers_to)}", f"WARC-Profile: {IDENTICAL}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The fields of a record; ``ValueError`` if a response's payload doesn't have its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha256:"), fields["WARC-Type"]
    if kind == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != size):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
    refers = fields.get("WARC-Refers-To")
    url = fields.get("WARC-Target-URI")
    if url is not None:
        parts = url.split("%")
        url = parts[0] + "".join(chr(int(x[:2], 16)) + x[2:] for x in parts[1:])
    return {"page_id": page_of(fields["WARC-Record-ID"]), "payload_bytes": size, "payload_digest": digest,
            "record_type": kind, "refers_to": page_of(refers) if refers else None, "url": url, "payload": payload}


class Bundle:
    """A bundle being written."""

    def __init__(self, folder: str, name: str) -> None:
        self.name, self.out = name, Output(folder, name)
        self.pack = zstandard.ZstdCompressor(level=3)
        self.table: list[tuple[int, int, int]] = []
        self.map: list[tuple[int | None, int, int, int]] = []
        self.frame: list[bytes] = []
        self.fill = 0

    def add(self, page_id: int | None, data: bytes) -> None:
        self.map.append((page_id, len(self.table), self.fill, len(data)))
        self.frame.append(data)
        self.fill += len(data)
        if self.fill >= FRAME:
            self._end_frame()

    def _end_frame(self) -> None:
        if self.frame:
            plain = b"".join(self.frame)
            packed = self.pack.compress(plain)
            self.out.write(packed)
            self.table.append((len(packed), len(plain), zlib.crc32(plain)))
            self.frame, self.fill = [], 0

    def close(self) -> pa.RecordBatch:
        """End the file; its record map as rows of ``INDEX``."""
        self._end_frame()
        names = "\n".join("" if p is None else str(p) for p, *_ in self.map).encode()
        entries = b"".join(struct.pack("<IQQ", *x) for _, *x in self.map)
        body = zlib.compress(struct.pack("<Q", len(self.map)) + entries + names)
        self.out.write(struct.pack("<II", SKIP_MAP, len(body)) + body)
        # as the seekable format has it: entries with checksums, then number of frames, descriptor, magic number
        table = b"".join(struct.pack("<III", *x) for x in [*self.table, (8 + len(body), 0, 0)])
        table += struct.pack("<IBI", len(self.table) + 1, 0x80, SEEKABLE)
        self.out.write(struct.pack("<II", SKIP_TABLE, len(table)) + table)
        self.out.__exit__(None, None, None)
        return pa.RecordBatch.from_pydict({
            "page_id": pa.array([m[0] for m in self.map], pa.int64()), "file": [self.name] * len(self.map),
            "frame": pa.array([m[1] for m in self.map], pa.int32()), "offset": pa.array([m[2] for m in self.map], pa.int64()),
            "length": pa.array([m[3] for m in self.map], pa.int64())})


class Reader:
    """Random access to a bundle by frame, from its seek table."""

    def __init__(self, f) -> None:  # noqa: ANN001 - a file opened for random access
        self.f, size = f, f.size()
        f.seek(size - 9)
        n, _, magic = struct.unpack("<IBI", f.read(9))
        if magic != SEEKABLE:
            raise ValueError("not a seekable bundle")
        f.seek(size - 9 - 12 * n)
        sizes = list(struct.iter_unpack("<III", f.read(12 * n)))
        self.frames, at = [], 0
        for packed, plain, check in sizes:
            self.frames.append((at, packed, plain, check))
            at += packed
        self.unpack = zstandard.ZstdDecompressor()

    def records(self) -> list[tuple[int | None, int, int, int]]:
        """The record map: (page_id, frame, offset, length)."""
        at, size, _, _ = self.frames[-1]
        self.f.seek(at + 8)
        body = zlib.decompress(self.f.read(size - 8))
        n = struct.unpack_from("<Q", body)[0]
        names = body[8 + 20 * n:].decode().split("\n") if n else []
        return [(int(p) if p else None, *x) for p, x in
                zip(names, struct.iter_unpack("<IQQ", body[8:8 + 20 * n]), strict=True)]

    def frame(self, number: int) -> bytes:
        at, packed, plain, check = self.frames[number]
        self.f.seek(at)
        data = self.unpack.decompress(self.f.read(packed), max_output_size=plain)
        if zlib.crc32(data) != check:
            raise ValueError(f"frame {number} is damaged")
        return data


def fetch(folder: str, file: str, frame: int, offset: int, length: int) -> dict:
    """One record by its place in the index."""
    with source(folder, file) as f:
        return parse(Reader(f).frame(frame)[offset:offset + length])


def with_targets(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, digest, refers_to) of each page; refers_to is null for responses.

    Groups of two or more equal payloads are found by a grouping of digests, which combines within tasks;
    each is then sent to ``SALTS`` keys, over which its pages are dealt by their page_id.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload")).select(
        "page_id", "url", "payload", F.sha2("payload", 256).alias("digest"))
    groups = (rows.where(F.octet_length("payload") >= REVISIT).groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
              .select("digest", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    other = ~F.col("page_id").eqNullSafe(F.col("first"))
    return dealt.join(groups, ["digest", "salt"], "left").select(
        "page_id", "url", "payload", "digest", F.when(other, F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record per page; return the written index of records."""
    spark = pages.sparkSession

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, bundle = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to")]
            for page_id, url, payload, digest, refers_to in zip(*columns, strict=True):
                if bundle is None:
                    bundle = Bundle(folder, f"pages-{part:06d}-{number:04d}.warc.zst")
                bundle.add(page_id, record(page_id, url, payload, digest, refers_to))
                if bundle.out.size >= BUNDLE:
                    yield bundle.close()
                    bundle, number = None, number + 1
        if bundle is not None:
            yield bundle.close()

    index = scratch_path(spark, "warc-index")
    with_targets(pages).mapInArrow(write, INDEX).write.parquet(index)
    return spark.read.schema(INDEX).parquet(index)


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """All records of the index's bundles, each found by the bundle's own record map."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch["file"].to_pylist():
                with source(folder, name) as f:
                    yield from _records(Reader(f), name)

    files = index.select("file").distinct()
    return files.repartitionByRange(max(1, files.count()), "file").mapInArrow(read, READ)


def _records(reader: Reader, name: str) -> Iterator[pa.RecordBatch]:
    kinds = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
             ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("file", pa.string()),
             ("frame", pa.int32()), ("offset", pa.int64())]
    rows: list[dict] = []
    held, data = -1, b""
    for page_id, frame, offset, length in reader.records():
        if frame != held:
            held, data = frame, reader.frame(frame)
        found = parse(data[offset:offset + length])
        if found["page_id"] != page_id:
            raise ValueError(f"{name}: the record map names {page_id}, the record {found['page_id']}")
        del found["payload"]
        rows.append(found | {"file": name, "frame": frame, "offset": offset})
        if len(rows) >= 4096:
            yield pa.RecordBatch.from_pylist(rows, pa.schema(kinds))
            rows = []
    if rows:
        yield pa.RecordBatch.from_pylist(rows, pa.schema(kinds))


def archive_digests(pages: DataFrame) -> DataFrame:
    """Write the archives, read them back, and return what they hold of each page."""
    folder = scratch_path(pages.sparkSession, "warc")
    back = read_archives(write_archives(pages, folder), folder)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
