import base64
import gzip
import hashlib
import io
from pathlib import Path

import pytest

from calibra.functions.sizing import scratch_path
from calibra.llm import queries, warc


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def expected(rows, min_bytes=0):
    first = {}
    for i, _, html in rows:
        data = (html or "").encode()
        if i is not None and len(data) >= min_bytes:
            first[data] = min(first.get(data, i), i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        again = data in first and first[data] != i
        out.append((i, len(data), digest(data), "revisit" if again else "response", first[data] if again else None))
    return sorted(out, key=str)


ROWS = [
    (3, "http://a.example/x", "<p>é</p>"),
    (1, "http://b.example/y\r\nX-Evil: 1", "<p>é</p>"),
    (2, None, None),
    (5, "u", ""),
    (7, "u", "body\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"),
    (8, "u", "x" * 300_000),
    (9, "u", "x" * 300_000),
    (None, "u", "<p>é</p>"),
    (None, "u", "only without key"),
]


def run(spark, rows, **options):
    path = scratch_path(spark, "warc-test")
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], "page_id bigint, url string, html string, digest string, id int")
    warc.write_warc(df.repartition(3), path, **options)
    return path, warc.read_warc(spark, path)


@pytest.mark.parametrize("min_bytes", [0, 10])
def test_round_trip(spark, min_bytes):
    _, read = run(spark, ROWS, min_bytes=min_bytes)
    full = warc.originals(read).collect()
    got = [
        (int(r["key"]) if r["key"] else None, len(r["payload"]), digest(bytes(r["payload"])), r["record_type"],
         int(r["refers_to"]) if r["refers_to"] else None)
        for r in full
    ]
    assert sorted(got, key=str) == expected(ROWS, min_bytes)
    assert all(r["payload_digest"] == digest(bytes(r["payload"])) and r["payload_bytes"] == len(r["payload"]) for r in full)
    assert {r["url"] for r in full} >= {"http://b.example/y X-Evil: 1", None}


def test_archives_are_plain_warc(spark):
    path, _ = run(spark, ROWS, records_per_archive=2)
    files = [p for p in Path(path.removeprefix("file:")).iterdir() if p.name.startswith("part-")]
    assert len(files) > 2
    types = []
    for f in files:
        data = gzip.decompress(f.read_bytes())
        for headers, payload in warc.records(io.BytesIO(data)):
            types.append(headers["warc-type"])
            assert headers["warc-record-id"].startswith("<urn:uuid:") and headers["warc-date"]
            if headers["warc-type"] == "revisit":
                assert payload == b"" and headers["warc-refers-to"] and headers["warc-profile"] == warc.REVISIT_PROFILE
    assert sorted(types) == sorted(t for *_, t, _ in expected(ROWS))


def test_binary_payloads_and_repeated_rows(spark):
    path = scratch_path(spark, "warc-test")
    raw = bytes(range(256))
    df = spark.createDataFrame([(1, "u", bytearray(raw)), (1, "u", bytearray(raw)), (2, "u", bytearray(raw))], "page_id bigint, url string, html binary")
    warc.write_warc(df, path)
    full = warc.originals(warc.read_warc(spark, path)).collect()
    assert [bytes(r["payload"]) for r in full] == [raw] * 3
    assert sorted((r["key"], r["record_type"]) for r in full) == [("1", "response")] * 2 + [("2", "revisit")]


def test_no_rows(spark):
    assert run(spark, [])[1].count() == 0


def test_query(spark):
    directory = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{directory}/pages.parquet").select("page_id", "url", "html").collect()]
    out = queries.QUERIES["op3_warc"](spark, directory)
    assert out.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, out.collect()), key=str) == expected(rows)
