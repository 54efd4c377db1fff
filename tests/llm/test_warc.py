"""WARC archives against a plain version, their determinism, repair and faults."""

from __future__ import annotations

import gzip
import hashlib
import os

import pytest
from pyspark.errors import PythonException

from studylake.llm import warc

SCHEMA = "page_id long, url string, html string, shard int, rank string, bytes long"
BIG, OTHER = "é" * 600, "x" * 1000
ROWS = [
    (1, "http://a/1", BIG), (9, "http://a/9", BIG), (5, None, BIG), (None, "http://n", BIG), (None, None, BIG),
    (2, "http://b\r\nWARC-Type: x", OTHER), (3, "http://b", OTHER), (3, "http://b", OTHER), (3, "http://c", OTHER),
    (-4, "http://short", "x" * 999), (6, "http://short", "x" * 999), (7, "http://e", ""), (8, "http://e", None),
    (10, "http://one", "y" * 5000), (11, "http://long", "z\r\n\r\n" * 300_000), (6, "http://short", "x" * 998), (6, "http://short", "x" * 999),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, 1, "r", 2) for r in ROWS], SCHEMA)


def expected(rows):
    last = {}
    for page, _, html in rows:
        payload = (html or "").encode()
        if len(payload) >= 1000:
            last[payload] = max(last.get(payload, -(1 << 70)), -(1 << 70) if page is None else page)
    return last


def test_pages_come_back(pages):
    rows = warc.read(warc.write(pages, shard_bytes=2000, roll_bytes=1500), with_payload=True).collect()
    assert len(rows) == len(ROWS) and len({r["record_id"] for r in rows}) == len(rows)
    last = expected(ROWS)
    want = sorted((str(p), hashlib.sha1((h or "").encode()).hexdigest(), len((h or "").encode())) for p, _, h in ROWS)
    assert want == sorted((str(r["page_id"]), r["payload_digest"], r["payload_bytes"]) for r in rows)
    by_id = {r["record_id"]: r for r in rows}
    for r in rows:
        if r["record_type"] == "response":
            assert hashlib.sha1(r["payload"]).hexdigest() == r["payload_digest"] and r["refers_to"] is None
            if len(r["payload"]) >= 1000:
                assert r["page_id"] == last[r["payload"]]
        else:
            kept = by_id[r["refers_to_id"]]
            assert kept["record_type"] == "response" and kept["payload_digest"] == r["payload_digest"]
            assert kept["page_id"] == r["refers_to"] and r["payload"] is None and r["payload_bytes"] >= 1000
    assert sum(r["record_type"] == "response" and r["payload_bytes"] >= 1000 for r in rows) == len(last)
    targets = {r["target_uri"] for r in rows}
    assert {"urn:page:5", "urn:page:", "http://b%0D%0AWARC-Type:%20x"} <= targets


def test_same_pages_same_archive(pages):
    a, b = (warc.write(p, shard_bytes=2000, roll_bytes=1500) for p in (pages, pages.repartition(5)))
    named = [sorted((r["shard"], r["seq"], r["bytes"], r["records"], r["sha256"]) for r in m.collect()) for m in (a, b)]
    assert named[0] == named[1] and len({r[0] for r in named[0]}) > 2
    ranks = []
    for r in sorted(a.collect(), key=lambda r: (r["shard"], r["seq"])):  # files in order hold ranks in order
        data = open(r["path"].removeprefix("file:"), "rb").read()
        assert hashlib.sha256(data).hexdigest() == r["sha256"] and len(data) == r["bytes"]
        ids = [line.split(b": ")[1] for line in gzip.decompress(data).split(b"\r\n") if line.startswith(b"X-Page-ID: ")]
        ranks += [-(1 << 70) if i == b"" else int(i) for i in ids]
    assert ranks == sorted(ranks) and len(ranks) == len(ROWS)


def test_files_roll_by_compressed_size(spark):
    many = spark.range(400).selectExpr("id AS page_id", "'u' AS url", "sha2(cast(id as string), 512) AS html")
    files = warc.write(many, roll_bytes=6000).collect()
    assert len(files) > 5 and all(r["bytes"] <= 6000 for r in files) and sum(r["records"] for r in files) == 400


def test_commit_again_and_faults(spark, pages, tmp_path):
    root = f"file:{tmp_path}/archive"
    manifest = warc.write(pages, root)
    # what a lost attempt leaves is not read, and renaming again changes nothing
    os.makedirs(f"{tmp_path}/archive/_temporary", exist_ok=True)
    with open(f"{tmp_path}/archive/_temporary/part-00000-00000.warc.gz.dead", "wb") as f:
        f.write(b"half")
    os.rename(f"{tmp_path}/archive/_manifest", f"{tmp_path}/archive/_lost")
    written = spark.read.parquet(f"{tmp_path}/archive/_lost").selectExpr(
        "shard", "seq", "element_at(split(path, '/'), -1) || '.gone' AS path", "bytes", "records", "sha256")
    again = warc.commit(written, root)
    assert warc.read(again).count() == len(ROWS)
    path = again.first()["path"].removeprefix("file:")
    data = open(path, "rb").read()
    for bad in (data[:-30], data[:200] + bytes([data[200] ^ 1]) + data[201:], data + warc.page_record("\0u\0", 0, b"", None)):
        with open(path, "wb") as f:
            f.write(bad)
        with pytest.raises(PythonException):
            warc.read(again).count()


def test_hot_groups_and_empty_table(spark, monkeypatch):
    monkeypatch.setattr(warc, "HOT_GROUPS", 1)
    same = spark.range(3000).selectExpr("id AS page_id", "'u' AS url", "repeat(if(id % 2 = 0, 'a', cast(id % 3 AS string)), 1000) AS html")
    rows = warc.round_trip(same).collect()
    assert len(rows) == 3000 and sum(r["record_type"] == "response" for r in rows) == 4
    assert {r["refers_to"] for r in rows if r["page_id"] % 2 == 0} == {None, 2998}
    none = warc.write(same.limit(0))
    assert none.count() == 0 and warc.read(none).count() == 0
