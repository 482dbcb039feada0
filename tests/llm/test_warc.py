from __future__ import annotations

import gzip
import hashlib
import io
import random

import pytest

from tallyflow.llm import warc

PAGES = "page_id long, url string, html string"


def pages(spark, rows, schema=PAGES):
    return spark.createDataFrame(rows, schema)


def brute(rows):
    first = {}
    for p, _, h in rows:
        h = h or ""
        if len(h.encode()) >= 100 and p is not None:
            first[h] = min(p, first.get(h, p))
    out = []
    for p, _, h in rows:
        b = (h or "").encode()
        f = first.get(h or "")
        revisit = f is not None and f != p
        out.append((p, "revisit" if revisit else "response", f if revisit else None, len(b), hashlib.sha256(b).hexdigest()))
    return sorted(out, key=str)


def some(n=300):
    rng = random.Random(1)
    bodies = ["<p>" + "é\r\n\r\nWARC/1.1 " * rng.randint(0, 60) + str(k) for k in range(60)]
    rows = [(k, None if k % 17 == 0 else f"http://x/{k}\r\nEvil: 1", rng.choice(bodies)) for k in range(n)]
    return rows + [(n, "u", None), (n + 1, "u", ""), (n + 2, "u", "x" * 99), (n + 3, "u", "x" * 99), (n + 4, "u", "y" * 100), (n + 5, "u", "y" * 100), (n + 6, "u", "z" * 500_000)]


def test_round_trip_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 4000)  # several archives a task
    rows = some()
    manifest = warc.write_archives(pages(spark, rows).repartition(4))
    assert manifest.count() > 4 and manifest.agg({"records": "sum"}).first()[0] == len(rows)
    got = warc.read_archives(manifest, payload=True).collect()
    assert sorted(((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in got), key=str) == brute(rows)
    html = {p: (h or "").encode() for p, _, h in rows}
    assert all(bytes(r["payload"]) == html[r["page_id"]] for r in got if r["record_type"] == "response")
    assert {r["url"] for r in got if r["page_id"] == 1} == {"http://x/1 Evil: 1"}


def test_each_record_is_a_gzip_member():
    one = warc.record(1, "http://x", b"body")
    assert gzip.decompress(one).startswith(b"WARC/1.1\r\nWARC-Type: response\r\n")
    both = one + warc.record(2, None, b"body", refers_to=1, is_revisit=True)
    found = [warc.verified(*r) for r in warc.Reader(io.BytesIO(both))]
    assert [(f["page_id"], f["record_type"], f["refers_to"], f["payload_bytes"]) for f in found] == [(1, "response", None, 4), (2, "revisit", 1, 4)]


@pytest.mark.parametrize("chunk", [1, 7, 1 << 16])
def test_reader_with_any_chunk(monkeypatch, chunk):
    monkeypatch.setattr(warc, "CHUNK", chunk)
    payloads = [b"", b"a" * 1000, b"\r\n\r\n" * 9, bytes(range(256)) * 5]
    data = b"".join(warc.record(k, "u", p) for k, p in enumerate(payloads))
    assert [warc.verified(*r)["payload"] for r in warc.Reader(io.BytesIO(data))] == payloads


def test_damage_is_an_error():
    good = warc.record(1, "u", b"some payload" * 20)

    def read(data):
        return [warc.verified(*r) for r in warc.Reader(io.BytesIO(data))]

    assert len(read(good)) == 1 and read(b"") == []
    with pytest.raises(ValueError):
        read(good[:-20])
    plain = gzip.decompress(good)
    with pytest.raises(ValueError):
        read(gzip.compress(plain.replace(b"some payload", b"same payload", 1)))
    with pytest.raises(ValueError):
        read(gzip.compress(plain + plain))
    with pytest.raises(ValueError):
        read(gzip.compress(plain[:-40]))
    with pytest.raises(ValueError):
        read(gzip.compress(b"HTTP/1.1 200 OK\r\n\r\n"))


def test_edges(spark):
    assert warc.read_archives(warc.write_archives(pages(spark, []))).collect() == []
    rows = [(3, None, "q" * 200, "x"), (3, None, "q" * 200, "x"), (None, "u", "q" * 200, "x"), (None, "u", None, "x")]
    got = warc.read_archives(warc.write_archives(pages(spark, rows, PAGES + ", digest string"))).collect()
    assert sorted((r["page_id"], r["record_type"], r["refers_to"]) for r in got if r["page_id"] == 3) == [(3, "response", None)] * 2
    assert sorted(str((r["record_type"], r["refers_to"])) for r in got if r["page_id"] is None) == ["('response', None)", "('revisit', 3)"]
