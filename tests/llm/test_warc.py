"""WARC archives: round trips, layout, repeatability, revisits, the manifest."""

from __future__ import annotations

import base64
import hashlib
import os
import zlib

import pytest
from pyspark.sql import functions as F

from millrace.llm import warc
from millrace.llm.queries import QUERIES

BIG = "é" * 600  # 1200 bytes


@pytest.fixture
def pages(spark):
    def make(rows):
        return spark.createDataFrame(rows, "page_id long, url string, html string")

    return make


def files(root):
    return {f: open(os.path.join(root, f), "rb").read() for f in sorted(os.listdir(root)) if f.endswith(".warc.gz")}


ROWS = [(1, "http://a.org/x", "<p>one</p>"), (2, None, BIG), (3, "http://b c.org", BIG), (9, "http://c.org", BIG), (4, "http://d.org", None),
        (5, "", "x" * 1000), (6, "http://e.org", "x" * 1000), (7, "u", "y" * 999), (8, "u", "y" * 999), (None, "null", BIG), (6, "http://e.org", "x" * 1000)]


def test_round_trip_and_revisits(spark, pages, folder):
    manifest = warc.write(pages(ROWS).withColumn("key", F.lit("clash")), folder)
    out = warc.read(spark, folder).collect()
    assert sum(r.records for r in manifest.collect()) == len(out) == len(ROWS)
    by = {}
    for r in out:
        by.setdefault(r.key, []).append(r)
    sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    for key, _, html in ROWS:
        for r in by[key]:
            assert (r.payload_bytes, r.payload_digest) == (len((html or "").encode()), sha(html))
            assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == (html or "").encode()
    kinds = {k: {(r.record_type, r.refers_to) for r in rs} for k, rs in by.items()}
    assert kinds == {1: {("response", None)}, 2: {("revisit", 9)}, 3: {("revisit", 9)}, 9: {("response", None)}, 4: {("response", None)},
                     5: {("revisit", 6)}, 6: {("response", None)}, 7: {("response", None)}, 8: {("response", None)}, None: {("response", None)}}
    assert by[2][0].url is None and by[3][0].url == "http://b%20c.org" and by[5][0].url == ""


def test_records_follow_the_format_and_the_order(spark, pages, folder):
    warc.write(pages(ROWS).repartition(4), folder, roll_bytes=1)
    names, keys, ids = [], [], set()
    for name, data in files(folder).items():
        names.append(name)
        records = list(warc._members(data))
        assert records[0].startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")
        for record in records[1:]:
            head, _, rest = record.partition(b"\r\n\r\n")
            of = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            block = rest[:-4]
            assert rest.endswith(b"\r\n\r\n") and len(block) == int(of["Content-Length"])
            assert of["WARC-Block-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()
            keys.append(int(of.get("X-Key", -1)))
            ids.add(of["WARC-Record-ID"])
    assert len(names) == len(keys) == len(ids) == len(ROWS)  # each file is full after one record
    assert keys == sorted(keys)


def test_equal_input_gives_equal_files(spark, pages, folder):
    warc.write(pages(ROWS).repartition(5), folder + "a", range_bytes=1500)
    warc.write(pages(ROWS[::-1]).repartition(2), folder + "b", range_bytes=1500)
    a = files(folder + "a")
    assert a == files(folder + "b") and len(a) > 2


def test_outlying_hot_and_null_keys_span_ranges(spark, pages, folder):
    """One key far away, one that holds a third of the rows, and rows without a key."""
    rows = [(i, "u", f"{i}" * 300) for i in range(100)] + [(1 << 60, "u", "far")] + [(7, "u", f"hot {i} " * 150) for i in range(100)] + [(None, "u", f"null {i} " * 150) for i in range(100)]
    manifest = warc.write(pages(rows).repartition(6), folder, range_bytes=20_000)
    parts = {r.file.split("-")[0]: r.records for r in manifest.collect()}
    assert len(parts) >= 12 and max(parts.values()) <= 60
    assert len(warc.read(spark, folder).collect()) == len(rows)
    keys = [int(dict(x.split(": ", 1) for x in m.partition(b"\r\n\r\n")[0].decode().split("\r\n")[1:]).get("X-Key", -1))
            for data in files(folder).values() for m in list(warc._members(data))[1:]]
    assert keys == sorted(keys)


def test_reader_refuses_other_files(spark, pages, folder):
    warc.write(pages(ROWS), folder)
    with open(f"{folder}/999999-00000.warc.gz", "wb") as stray:
        stray.write(zlib.compress(b""))
    with pytest.raises(ValueError, match="manifest"):
        warc.read(spark, folder)


def test_empty_table(spark, pages, folder):
    warc.write(pages([]), folder)
    assert warc.read(spark, folder).collect() == []


def test_query_against_plain_python(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    sha = {r.page_id: hashlib.sha1((r.html or "").encode()).hexdigest() for r in rows}
    size = {r.page_id: len((r.html or "").encode()) for r in rows}
    last = {}
    for i, d in sha.items():
        last[d] = max(last.get(d, -1), i)
    out = QUERIES["op5_warc"](spark, sf_dir).collect()
    assert len(out) == len(rows)
    for r in out:
        to = last[sha[r.page_id]] if size[r.page_id] >= 1000 and last[sha[r.page_id]] != r.page_id else None
        assert (r.payload_bytes, r.payload_digest, r.refers_to) == (size[r.page_id], sha[r.page_id], to)
        assert r.record_type == ("response" if to is None else "revisit")
