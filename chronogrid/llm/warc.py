"""WARC archives: writing, normalising whole-file gzip streams, and reading by offset.

The normaliser inflates an archive that is one gzip stream once, writes every record as
a gzip member of its own, and writes a sidecar index of the members' offsets, so that any
record can be read without the ones before it.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import bounded, open_fs, saved, work_dir

#: Payload bytes after which the writer begins a new archive.
ARCHIVE_BYTES = 64 << 20
#: Shorter payloads are never revisits.
REVISIT_BYTES = 100
_CHUNK = 1 << 20
_DATE = "1970-01-01T00:00:00Z"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.0 record; a revisit keeps the HTTP head and leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.0", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>", f"WARC-Date: {_DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    head += ["Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha256:{digest}"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join([*head, f"Content-Length: {len(block)}"]).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _head(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def records(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records of a stream of inflated bytes; holds one record."""
    buffer = bytearray()
    for chunk in chunks:
        buffer += chunk
        at = 0
        while (end := buffer.find(b"\r\n\r\n", at)) >= 0:
            stop = end + 4 + int(_head(bytes(buffer[at:end]))["content-length"]) + 4
            if stop > len(buffer):
                break
            yield bytes(buffer[at:stop])
            at = stop
        del buffer[:at]
    if buffer:
        raise ValueError("the archive ends inside a record")


def inflated(stream) -> Iterator[bytes]:
    """Inflated bytes of a gzip file of one member or more, in bounded pieces."""
    d, begun = zlib.decompressobj(31), False
    while piece := stream.read(_CHUNK):
        while piece:
            begun = True
            if data := d.decompress(piece, 4 * _CHUNK):
                yield data
            # After a member's end only unused_data tells what is left; unconsumed_tail may be stale.
            if d.eof:
                piece, d, begun = d.unused_data, zlib.decompressobj(31), False
            else:
                piece = d.unconsumed_tail
    if begun:
        raise ValueError("the gzip stream ends early")


def _written(folder: str, level: int):
    """Rows -> archives of one gzip stream each. Names are new in each attempt, and only the rows of the attempt that counts name them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_fs(folder)
        out = packer = path = None
        size = n = 0
        done = []

        def close():
            out.write(packer.flush())
            out.close()
            done.append((path, n))

        for batch in batches:
            for page_id, url, html, digest, refers in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                if out is None:
                    path = f"{base}/{uuid.uuid4().hex}.warc.gz"
                    out, packer, size, n = fs.open_output_stream(path, compression=None), zlib.compressobj(level, zlib.DEFLATED, 31), 0, 0
                raw = record(page_id, url, (html or "").encode(), digest, refers)
                out.write(packer.compress(raw))
                size, n = size + len(raw), n + 1
                if size >= ARCHIVE_BYTES:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.string()), pa.array([x[1] for x in done], pa.int64())], ["path", "records"])

    return run


def write_monolithic(pages: DataFrame, folder: str, level: int = 1) -> DataFrame:
    """Write a record per row of ``pages`` to archives that are one gzip stream each; returns (path, records).

    Of records with equal payloads of at least 100 bytes, those with the smallest
    page_id are responses, the others revisit it; all shorter ones are responses. Null
    html is an empty payload. Rows that repeat the smallest page_id are all responses; a
    null page_id revisits a known one or else is a response. A null url leaves its field
    out. An empty table gives no archive.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    rows = rows.withColumn("digest", F.sha2(F.coalesce("html", F.lit("")), 256))
    long_ = rows.where(F.octet_length("html") >= REVISIT_BYTES)
    firsts = saved(long_.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL").select("digest", "first"), "firsts")
    joined = rows.join(firsts, "digest", "left").select("page_id", "url", "html", "digest", F.expr("IF(page_id = first, NULL, first)").alias("refers_to"))
    return saved(joined.mapInArrow(_written(folder, level), "path string, records long"), "archives")


def _normalised(folder: str, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_fs(folder)
        for batch in batches:
            for source in batch.column(0).to_pylist():
                path, at, index = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, []
                with fs.open_input_stream(source, compression=None) as stream, fs.open_output_stream(path, compression=None) as out:
                    for raw in records(inflated(stream)):
                        packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                        member = packer.compress(raw) + packer.flush()
                        out.write(member)
                        index.append((at, len(member)))
                        at += len(member)
                with fs.open_output_stream(path + ".idx", compression=None) as out:
                    out.write("".join(json.dumps({"offset": a, "length": n}) + "\n" for a, n in index).encode())
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(index), pa.string()), pa.array([x[0] for x in index], pa.int64()), pa.array([x[1] for x in index], pa.int64())], ["path", "offset", "length"])

    return run


def normalise(archives: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """Rewrite archives (path, ...) with a gzip member per record; returns the index (path, offset, length).

    Each archive is inflated once, in pieces; a task holds one record. Beside each new
    archive lies its sidecar index, one JSON object a line.
    """
    # One small row per archive: an explicit count keeps them from being put in one task.
    parts = 4 * archives.sparkSession.sparkContext.defaultParallelism
    return saved(archives.select("path").repartition(parts, "path").mapInArrow(_normalised(folder, level), "path string, offset long, length long"), "index")


def _listed(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_fs(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with fs.open_input_stream(path + ".idx", compression=None) as f:
                    places = [json.loads(x) for x in f.read().decode().splitlines()]
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(places), pa.string()), *(pa.array([x[k] for x in places], pa.int64()) for k in ("offset", "length"))], ["path", "offset", "length"])

    return run


def sidecar_index(archives: DataFrame, folder: str) -> DataFrame:
    """(path, offset, length) of all records of archives (path, ...), from their sidecar files alone. Repeated paths count once."""
    parts = 4 * archives.sparkSession.sparkContext.defaultParallelism
    return archives.select("path").distinct().repartition(parts, "path").mapInArrow(_listed(folder), "path string, offset long, length long")


def _parsed(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_fs(folder)
        path = file = None
        page = lambda s: None if s in (None, "<urn:page:null>") else int(s[10:-1])
        for batch in batches:
            rows = []
            for p, offset, length in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if p != path:
                    path, file = p, fs.open_input_file(p)
                file.seek(offset)
                raw = zlib.decompress(file.read(length), 31)
                end = raw.index(b"\r\n\r\n")
                head = _head(raw[:end])
                block = raw[end + 4 : -4]
                http, _, payload = block.partition(b"\r\n\r\n")
                if head["warc-type"] == "response":
                    size, digest = len(payload), hashlib.sha256(payload).hexdigest()
                    if head["warc-payload-digest"] != f"sha256:{digest}":
                        raise ValueError(f"payload of {head['warc-record-id']} differs from its digest")
                else:
                    size, digest = int(re.search(rb"(?i)^content-length:\s*(\d+)", http, re.M)[1]), head["warc-payload-digest"][7:]
                rows.append((page(head["warc-record-id"]), size, digest, head["warc-type"], page(head.get("warc-refers-to")), head.get("warc-target-uri"), payload if head["warc-type"] == "response" else None))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"])

    return run


def read_archives(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """Records read by the offsets of ``index``: page_id, payload_bytes, payload_digest, record_type, refers_to, url, payload.

    A response's size and digest are taken from its payload (and held against its
    header), a revisit's from its headers; a revisit's payload is null.
    """
    parts = 4 * index.sparkSession.sparkContext.defaultParallelism
    rows = bounded(index).repartition(parts, "path").sortWithinPartitions("path", "offset")
    out = rows.mapInArrow(_parsed(folder), "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary")
    return out if payloads else out.drop("payload")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to whole-file gzip archives, normalise them, and read all records back by the sidecars' offsets."""
    spark: SparkSession = pages.sparkSession
    first, second = work_dir(spark, "warc-raw"), work_dir(spark, "warc")
    archives = normalise(write_monolithic(pages, first), second).select("path")
    return read_archives(sidecar_index(archives, second), second)
