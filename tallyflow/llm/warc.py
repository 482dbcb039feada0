"""Operator 6, WARC: archives of one gzip member per record, and a sequential
reader that verifies them.

Writing. Pages with equal payloads of at least ``REVISIT_BYTES`` bytes are
written once: the one with the smallest id is a response, the others revisit
it (no payload, the same payload digest, the response's record id). Each task
streams its records into archives in the shared folder; a manifest table
lists the archives of the tasks that succeeded, so files that a lost or
repeated task left behind are never read.

Reading. A task opens an archive as a stream, decompresses it piece by piece
(zlib, one member per record), takes the header up to its empty line and then
``Content-Length`` bytes, and compares the block's and the payload's SHA-256
with the recorded ones; a mismatch, a missing byte or a second record in a
member is an error.

Files are opened by ``pyarrow.fs`` from the folder's URI (local, HDFS, S3,
GCS), so the executors need the same access to it as Spark has.

Defined cases: a null payload is empty; a null url is left out of the header;
a null id is archived without one and is a revisit when its payload has a
response; repeated rows with the response's id are responses themselves; an
empty table gives no record; other columns are not read; payloads of any
length are streamed.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow.llm.common import bounded_batches, skew_lookup, staged
from tallyflow.session import shared_path

REVISIT_BYTES = 100
#: An archive is closed when it has this size; the next record opens another.
ARCHIVE_BYTES = 128 << 20
#: Bytes read, and bytes decompressed, at a time.
CHUNK = 1 << 16
#: The date that every record carries: a rerun writes the same bytes.
DATE = "2026-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = "urn:x-page:"


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


# -- records ---------------------------------------------------------------


def record(page_id, url: str | None, payload: bytes, refers_to=None, is_revisit: bool = False) -> bytes:
    """One WARC record as a gzip member."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if is_revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if is_revisit else 'response'}", f"WARC-Date: {DATE}"]
    head.append(f"WARC-Record-ID: <{_ID}{'' if page_id is None else page_id}>")
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\r\n]+", " ", url))
    if is_revisit:
        head += [f"WARC-Refers-To: <{_ID}{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    head += [
        f"WARC-Payload-Digest: sha256:{hashlib.sha256(payload).hexdigest()}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    packed = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packed.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packed.flush()


class Reader:
    """The records of an archive, in order, as (header, block) pairs."""

    def __init__(self, stream: BinaryIO):
        self.stream, self.packed, self.member = stream, b"", None

    def _more(self) -> bytes:
        """Some decompressed bytes of this member; empty at its end."""
        while not self.member.eof:
            if not self.packed and not self.member.unconsumed_tail:
                self.packed = self.stream.read(CHUNK)
                if not self.packed:
                    raise ValueError("the archive ends within a record")
            feed, self.packed = self.member.unconsumed_tail + self.packed, b""
            plain = self.member.decompress(feed, CHUNK)
            if plain:
                return plain
        return b""

    def __iter__(self) -> Iterator[tuple[dict[str, str], bytes]]:
        while True:
            self.packed = self.packed or self.stream.read(CHUNK)
            if not self.packed:
                return
            self.member = zlib.decompressobj(31)
            yield self._record()
            self.packed = self.member.unused_data

    def _record(self) -> tuple[dict[str, str], bytes]:
        held = bytearray()
        while (end := held.find(b"\r\n\r\n")) < 0:
            more = self._more()
            if not more:
                raise ValueError("a record has no end of its header")
            held += more
        version, *lines = held[:end].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"not a WARC record: {version[:40]!r}")
        header = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines)}
        length = int(header["content-length"])
        block = held[end + 4 :]
        while len(block) < length + 4:
            more = self._more()
            if not more:
                raise ValueError("a record is shorter than its length")
            block += more
        if bytes(block[length:]) != b"\r\n\r\n" or self._more():
            raise ValueError("a member holds more than its record")
        return header, bytes(block[:length])


def verified(header: dict[str, str], block: bytes) -> dict:
    """The fields of a record whose digests are right."""
    if header["warc-block-digest"] != "sha256:" + hashlib.sha256(block).hexdigest():
        raise ValueError(f"the block digest of {header['warc-record-id']} is wrong")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?i)content-length: (\d+)", http)[1])
    kind, digest = header["warc-type"], header["warc-payload-digest"].removeprefix("sha256:")
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"the payload digest of {header['warc-record-id']} is wrong")
    number = lambda uri: int(x) if (x := uri.strip("<>").removeprefix(_ID)) else None
    return {
        "page_id": number(header["warc-record-id"]),
        "url": header.get("warc-target-uri"),
        "record_type": kind,
        "refers_to": number(header["warc-refers-to"]) if kind == "revisit" else None,
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": payload if kind == "response" else None,
    }


# -- Spark -----------------------------------------------------------------


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, top = file_system(folder)
        out, path, size, n, done = None, "", 0, 0, []
        try:
            for r in (r for batch in batches for k in range(0, batch.num_rows, 64) for r in batch.slice(k, 64).to_pylist()):
                if out is None:
                    where.create_dir(top, recursive=True)
                    name = f"{uuid.uuid4().hex}.warc.gz"  # each attempt has files of its own
                    out, path, size, n = where.open_output_stream(f"{top}/{name}"), f"{folder}/{name}", 0, 0
                data = record(r["page_id"], r["url"], (r["html"] or "").encode(), r["refers_to"], r["is_revisit"])
                out.write(data)
                size, n = size + len(data), n + 1
                if size >= ARCHIVE_BYTES:
                    out.close()
                    out = None
                    done.append((path, n, size))
        finally:
            if out is not None:
                out.close()
        if out is not None:
            done.append((path, n, size))
        if done:
            paths, counts, sizes = zip(*done, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())], ["path", "records", "bytes"])

    return run


def write_archives(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write pages (page_id, url, html) as archives; returns the manifest
    (path, records, bytes), a staged table."""
    spark = pages.sparkSession
    folder = folder or shared_path(spark, "llm", "warc", unique=True)
    html = F.coalesce("html", F.lit(""))
    rows = bounded_batches(pages).select(
        F.col("page_id").cast("long").alias("page_id"), "url", "html", F.octet_length(html).alias("n"), F.unhex(F.sha2(html, 256)).alias("digest")
    )
    same = staged(
        rows.where(F.col("n") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("pages"))
        .where("pages > 1"),
        "warc_same",
    )
    told = skew_lookup(rows, same, "digest", "pages", pages.count(), F.struct("page_id", "url"))
    is_revisit = F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    return staged(
        told.select("page_id", "url", "html", "refers_to", is_revisit.alias("is_revisit")).mapInArrow(
            _write(folder), "path string, records long, bytes long"
        ),
        "warc_manifest",
    )


_FIELDS = {
    "page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(),
    "payload_bytes": pa.int64(), "payload_digest": pa.string(), "payload": pa.binary(),
}
SCHEMA = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"


def _read(with_payload: bool):
    fields = [f for f in _FIELDS if with_payload or f != "payload"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            return pa.RecordBatch.from_arrays([pa.array([r[f] for r in rows], _FIELDS[f]) for f in fields], fields)

        for batch in batches:
            for uri in batch.column(0).to_pylist():
                where, path = file_system(uri)
                rows, held = [], 0
                with where.open_input_stream(path) as stream:
                    for header, block in Reader(stream):
                        rows.append(verified(header, block))
                        held += len(block) if with_payload else 256
                        if held >= 1 << 20:
                            yield out()
                            rows, held = [], 0
                if rows:
                    yield out()

    return run


def read_archives(manifest: DataFrame, payload: bool = False) -> DataFrame:
    """The verified records of the archives that ``manifest`` lists."""
    n = manifest.count()
    paths = manifest.select("path").repartition(max(1, n))
    return paths.mapInArrow(_read(payload), SCHEMA + (", payload binary" if payload else ""))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return read_archives(manifest).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


SQL = f"""
with p as (select page_id, coalesce(html, '') as h from pages),
f as (select h, min(page_id) as first from p where strlen(h) >= {REVISIT_BYTES} group by h)
select p.page_id, strlen(p.h) as payload_bytes, sha256(p.h) as payload_digest,
  case when f.first < p.page_id then 'revisit' else 'response' end as record_type,
  case when f.first < p.page_id then f.first end as refers_to
from p left join f using (h)
"""
