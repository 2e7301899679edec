"""WARC archives: what is written comes back, record by record."""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import zlib

import pytest

from tallyrank.llm import warc


def _expected(rows, least=0):
    groups: dict = {}
    for page, _, html in rows:
        groups.setdefault((html or "").encode(), []).append(page)
    out = []
    for payload, pages in groups.items():
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        known = sorted(p for p in pages if p is not None)
        order = known + [None] * (len(pages) - len(known))
        for i, page in enumerate(order):
            again = i > 0 and len(payload) >= least
            out.append(
                (page, len(payload), digest, "revisit" if again else "response", order[0] if again else None)
            )
    return sorted(out, key=str)


ROWS = [
    (5, "http://a.example/x?y=%20z", "<p>one</p>"),
    (3, "http://b.example/\r\nbad: header", "<p>one</p>"),
    (9, None, None),
    (8, "", ""),
    (None, "http://é.example/ü b", "<p>two \r\n\r\n WARC/1.1</p>"),
    (None, "u", "<p>one</p>"),
    (4, "u", "x" * 500_000),
    (4, "u", "x" * 500_000),
    (6, "u", "🙂"),
]


@pytest.mark.parametrize("least", [0, 11])
def test_round_trip(spark, tmp_path, least):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string").repartition(3)
    files = warc.archive_pages(pages, str(tmp_path / "w"), min_bytes=least)
    got = warc.read_archives(files, str(tmp_path / "w/records")).collect()
    rows = [
        (
            int(r["page_id"]) if r["page_id"] else None,
            r["payload_bytes"],
            r["payload_digest"],
            r["record_type"],
            int(r["refers_to"]) if r["refers_to"] else None,
        )
        for r in got
    ]
    assert sorted(rows, key=str) == _expected(ROWS, least)
    assert sorted(str(r["url"]) for r in got) == sorted(str(r[1]) for r in ROWS)
    payloads = {r["payload_digest"]: r["payload"] for r in got if r["record_type"] == "response"}
    assert {bytes(p).decode() for p in payloads.values()} == {r[2] or "" for r in ROWS}
    warc.delete_streams(spark, str(tmp_path / "w"))
    assert not (tmp_path / "w/streams").exists()


def test_members_and_index(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string").coalesce(1)
    records = warc.write_archives(pages, str(tmp_path / "streams"))
    decided = warc.find_revisits(records)
    files = warc.normalise(decided, str(tmp_path / "streams"), str(tmp_path / "records"))
    (file,) = [r["file"] for r in files.collect()]
    (stream,) = (tmp_path / "streams").glob("*.gz")
    first = zlib.decompressobj(16 + zlib.MAX_WBITS)
    first.decompress(stream.read_bytes())
    assert first.eof and not first.unused_data  # one member for the whole file
    raw = (tmp_path / "records" / file).read_bytes()
    at = 0
    for line in (tmp_path / "records" / f"{file}.index").read_text().splitlines():
        entry = json.loads(line)
        assert entry["offset"] == at
        member = zlib.decompressobj(16 + zlib.MAX_WBITS)
        text = member.decompress(raw[at : at + entry["length"]])
        assert member.eof and text.startswith(b"WARC/1.1\r\n") and entry["id"].encode() in text
        at += entry["length"]
    assert at == len(raw)
    assert gzip.decompress(raw).count(b"WARC/1.1\r\nWARC-Type") == len(ROWS)


def test_splitting_streams_of_any_chunk_size():
    records = [({"A": "1"}, b""), ({"A": "2"}, b"x\r\n\r\ny"), ({"A": "3"}, b"z" * 70)]
    raw = b"".join(warc.record_bytes(list(f.items()), b) for f, b in records)
    packed = gzip.compress(raw[:40]) + gzip.compress(raw[40:])
    for size in (1, 3, 1000):
        parts = (packed[i : i + size] for i in range(0, len(packed), size))
        got = [(f["A"], b) for f, b in warc.split_records(warc.inflate(parts))]
        assert got == [(f["A"], b) for f, b in records]
    with pytest.raises(ValueError, match="cut short"):
        list(warc.split_records(iter([raw[:-10]])))


def test_no_pages(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    files = warc.archive_pages(pages, str(tmp_path / "w"))
    assert warc.read_archives(files, str(tmp_path / "w/records")).count() == 0
