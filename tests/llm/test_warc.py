import base64
import gzip
import hashlib
from collections import defaultdict

import cases
from pyspark.sql import functions as F

from ledgerstrata.llm import warc
from ledgerstrata.llm.common import new_folder, stored

PAGES = [
    (1, "http://a.example/x?q=ä b", "<p>same</p>"),
    (2, "http://a.example/y", "<p>same</p>"),
    (5, None, "<p>same</p>"),
    (3, "http://b.example", None),
    (4, "bad\r\nWARC-Type: response", ""),
    (6, "http://c.example/", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 3),
    (7, "http://c.example/long", "x" * 3_000_000 + "é"),
    (None, "http://d.example/", "<p>same</p>"),
    (None, "http://d.example/2", "<p>alone</p>"),
    (8, "http://e.example/", "twice"),
    (8, "http://e.example/", "twice"),
    *[(9, "http://f.example/", "<p>same</p>")] * 3,
    *[(9, "http://f.example/other", "<p>same</p>")] * 2,
    *[(2, "http://a.example/y", "<p>same</p>")] * 2,
    *[(None, None, None)] * 2,
]


def pages(spark, rows=PAGES):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.withColumns({n: F.lit("given") for n in ("payload", "sha1", "size", "original", "file", "n")})


def brute(rows, min_bytes=0):
    groups = defaultdict(list)
    for page_id, url, html in rows:
        groups[(html or "").encode()].append((page_id, url))
    out = []
    for body, found in groups.items():
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        last = max((p for p, _ in found if p is not None), default=None)
        for page_id, _ in found:
            again = len(body) >= min_bytes and page_id != last
            out.append((page_id, len(body), digest, "revisit" if again else "response", last if again else None))
    return sorted(out, key=cases.key)


def test_round_trip(spark):
    for least in (0, 8):
        got = warc.capture_digests(warc.capture_round_trip(pages(spark), min_bytes=least))
        assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        assert sorted((tuple(r) for r in got.collect()), key=cases.key) == brute(PAGES, least)
    assert warc.capture_digests(warc.capture_round_trip(pages(spark, []))).collect() == []


def test_many_repeats_of_one_row(spark):
    rows = [(1, "u", "body")] * 2500 + [(2, "u", "body"), (3, "v", "other")]
    got = warc.capture_digests(warc.capture_round_trip(pages(spark, rows)))
    assert sorted((tuple(r) for r in got.collect()), key=cases.key) == brute(rows)


def test_records_are_valid_and_nested(spark):
    files = warc.write_captures(pages(spark).repartition(3), new_folder(spark, "test-warc"))
    kinds, seen = defaultdict(int), []
    for row in files.collect():
        path = row.file.removeprefix("file:")
        data = gzip.open(path).read()
        assert data.startswith(b"WARC/1.1\r\n") and data.endswith(b"\r\n\r\n")
        ids = [headers["warc-record-id"] for headers, _ in warc.read_archive_records(row.file)]
        seen += ids
        assert len(ids) == 1 + 3 * row.captures
        for headers, block in warc.read_archive_records(row.file):
            kinds[headers["warc-type"]] += 1
            assert int(headers["content-length"]) == len(block)
    assert len(seen) == len(set(seen))
    assert kinds["request"] == kinds["metadata"] == len(PAGES)
    assert kinds["response"] + kinds["revisit"] == len(PAGES)
    records = stored(warc.read_records(spark, files), "test-records")
    nested = warc.assemble(records).collect()
    assert len(nested) == len(PAGES)
    assert all(r.n_request == r.n_metadata == 1 for r in nested)
    text = {r.metadata.fields.get("page-id"): r.capture.payload for r in nested if r.capture.payload is not None}
    assert text["7"].decode() == PAGES[6][2] and text["6"].decode() == PAGES[5][2]


def test_assembly_of_stray_records(spark):
    schema = warc.RECORDS

    def record(record_id, kind, to=None):
        return ("f", record_id, kind, to, None, "u", "d", None, {}, None, None, None)

    rows = [
        record("c1", "response"), record("c2", "revisit"), record("q2", "request", "c1"),
        record("q1", "request", "c1"), record("m1", "metadata", "gone"), record("m2", "metadata", None),
        record("w", "warcinfo"), record("c1", "response"),
    ]
    got = {r.capture.record_id: r for r in warc.assemble(spark.createDataFrame(rows, schema)).collect()}
    assert got.keys() == {"c1", "c2"}
    assert (got["c1"].request.record_id, got["c1"].n_request, got["c1"].metadata) == ("q1", 2, None)
    assert (got["c2"].request, got["c2"].n_request, got["c2"].n_metadata) == (None, 0, 0)
