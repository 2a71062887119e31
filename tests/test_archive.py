import gzip
import zlib

import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawltable.operators.extract import DEFAULT_SCHEMA, default_extract, raw_extract
from crawltable.sources import archive
from crawltable.sources.archive import ArchiveStore, archive_rows, read_archive, responses

POINTERS = "url string, filename string, offset bigint, length bigint"


def record(block, kind="response", uri="https://x.com/", date="2024-01-01T00:00:00Z", extra=""):
    head = (
        f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {uri}\r\nWARC-Date: {date}\r\n"
        f"{extra}Content-Length: {len(block)}\r\n\r\n"
    )
    return head.encode() + block + b"\r\n\r\n"


def http(body, *headers, end="\r\n"):
    lines = ["HTTP/1.1 200 OK", *headers, "", ""]
    return end.join(lines).encode() + body


def bodies(data):
    return [body for _, body in responses(data)]


def test_only_responses_are_kept():
    data = record(b"a", "request") + record(http(b"b")) + record(b"c", "metadata") + record(http(b"d"))
    assert bodies(data) == [b"b", b"d"]
    members = b"".join(gzip.compress(record(http(b), "response")) for b in (b"1", b"2"))
    assert bodies(members) == [b"1", b"2"]


def test_headers():
    block = http(b"x", "Content-Type: text/html;", "  charset=utf-8", "X-A: 1", "x-a: 2", "broken", end="\n")
    [(found, body)] = responses(record(block, extra="X-Note: café\r\n"))
    assert found.http_headers == {"content-type": "text/html; charset=utf-8", "x-a": "1"}
    assert found.headers["x-note"] == "café"
    assert body == b"x"
    latin = record(http(b"", "X-A: ?").replace(b"?", b"\xe9"))
    assert next(responses(latin))[0].http_headers["x-a"] == "é"


def test_records_without_http_headers():
    [(found, body)] = responses(record(b"20 text\n\nbody", uri="dns:x.com"))
    assert found.http_headers is None
    assert body == b"20 text\n\nbody"


@pytest.mark.parametrize(
    "headers, body",
    [
        ((), b"hello"),
        (("Content-Encoding: identity",), b"hello"),
        (("Content-Encoding: gzip",), gzip.compress(b"hello")),
        (("Content-Encoding: GZIP",), b"hello"),
        (("Content-Encoding: deflate",), zlib.compress(b"hello")),
        (("Content-Encoding: deflate",), zlib.compress(b"hello", wbits=-15)),
        (("Transfer-Encoding: chunked",), b"2\r\nhe\r\n3;x=y\r\nllo\r\n0\r\n\r\n"),
        (("Transfer-Encoding: chunked",), b"hello"),
        (
            ("Transfer-Encoding: chunked", "Content-Encoding: gzip"),
            b"%x\r\n%b\r\n0\r\n\r\n" % (len(gzip.compress(b"hello", mtime=0)), gzip.compress(b"hello", mtime=0)),
        ),
    ],
)
def test_encodings(headers, body):
    assert bodies(record(http(body, *headers))) == [b"hello"]


@pytest.mark.parametrize("coding", ["br", "none", "utf-8", "gzip, gzip"])
def test_other_encodings_are_passed_through(coding):
    assert bodies(record(http(b"hello", f"Content-Encoding: {coding}"))) == [b"hello"]


def test_all_members_of_a_body_are_unpacked():
    body = gzip.compress(b"one ") + gzip.compress(b"two")
    assert bodies(record(http(body, "Content-Encoding: gzip"))) == [b"one two"]


def test_cut_bodies_are_kept_and_marked():
    whole = gzip.compress(b"one two three four " * 50)
    for body in (whole[:-10], gzip.compress(b"one ") + whole[:-10]):
        [(found, text)] = responses(record(http(body, "Content-Encoding: gzip")))
        assert found.damaged and text.startswith(b"one ")
    [(found, _)] = responses(record(http(whole, "Content-Encoding: gzip")))
    assert not found.damaged


def test_parts_of_records_fail():
    whole = record(http(b"<p>" + b"a" * 100))
    for data, problem in [
        (b"<html>", "archive record"),
        (b"", "no archive record"),
        (b"\r\n\r\n", "no archive record"),
        (whole[:-54], "of its"),
        (gzip.compress(whole)[:-20], "within a compressed|of its"),
        (gzip.compress(whole) + gzip.compress(whole)[:30], "within a compressed|of its"),
    ]:
        with pytest.raises(ValueError, match=problem):
            bodies(data)


class FailingFiles:
    def __init__(self, failures):
        self.failures = failures

    def open_input_file(self, path):
        return self

    def read_at(self, length, offset):
        if self.failures:
            self.failures -= 1
            raise OSError("lost")
        return b"x" * length


def test_reads_are_repeated_with_growing_waits(monkeypatch):
    waits = []
    monkeypatch.setattr(archive.time, "sleep", waits.append)
    store = ArchiveStore("/tmp", retries=3, retry_delay=0.5)
    store.files = FailingFiles(3)
    assert store.read("f", 0, 4) == (b"xxxx", 4)
    assert waits == [0.5, 1.0, 2.0]
    store.files = FailingFiles(4)
    with pytest.raises(OSError):
        store.read("g", 0, 4)


class ShortFiles(FailingFiles):
    def read_at(self, length, offset):
        self.failures -= 1
        return b"x" * (length - (self.failures >= 0))


def test_short_reads_are_repeated(monkeypatch):
    monkeypatch.setattr(archive.time, "sleep", lambda seconds: None)
    store = ArchiveStore("/tmp", retries=2, retry_delay=0.0)
    store.files = ShortFiles(2)
    assert store.read("f", 0, 4) == (b"xxxx", 3)
    store.files = ShortFiles(3)
    with pytest.raises(OSError, match="3 of 4 bytes"):
        store.read("g", 0, 4)


@pytest.mark.parametrize("base", ["/tmp/", "file:/tmp", "file:///tmp/"])
def test_local_bases(base):
    assert archive.open_files(base)[1] == "/tmp"


@pytest.fixture
def stored(spark, tmp_path):
    """Three pointers: two responses, a request only, one response."""
    blocks = [
        gzip.compress(record(http(b"<p>1", "Content-Type: text/html"), uri="https://x.com/1"))
        + gzip.compress(record(http(b"2"), uri="https://x.com/2", extra="Content-Type: text/plain\r\n")),
        gzip.compress(record(b"GET", "request")),
        gzip.compress(record(http(b"3"), uri="https://x.com/3")),
    ]
    (tmp_path / "f").write_bytes(b"".join(blocks))
    rows, at = [], 0
    for n, block in enumerate(blocks):
        rows.append((f"u{n}", "f", at, len(block)))
        at += len(block)
    return spark.createDataFrame(rows, POINTERS), str(tmp_path)


def test_one_row_per_pointer(spark, stored):
    pointers, base = stored
    captures = read_archive(pointers, base, default_extract, DEFAULT_SCHEMA, read_partitions=2)
    rows = captures.orderBy("offset").collect()
    assert [(r.url, len(r["rows"]), r.requests, r.skipped) for r in rows] == [
        ("u0", 2, 1, 0), ("u1", 0, 1, 0), ("u2", 1, 1, 0),
    ]
    assert [r.bytes for r in rows] == [r.length for r in rows]
    found = archive_rows(captures).orderBy("_arrival").drop("_arrival").collect()
    assert found == [
        ("https://x.com/1", "2024-01-01T00:00:00Z", "text/html", "1"),
        ("https://x.com/2", "2024-01-01T00:00:00Z", "text/plain", "2"),
        ("https://x.com/3", "2024-01-01T00:00:00Z", "", "3"),
    ]


def test_large_ranges_are_handed_over_in_parts(spark, stored, monkeypatch):
    pointers, base = stored
    monkeypatch.setattr(archive, "FLUSH_BYTES", 1)
    captures = read_archive(pointers, base, raw_extract, T.StructType().add("body", T.BinaryType()))
    with pytest.raises(PySparkException, match="not in the schema"):
        captures.collect()
    captures = read_archive(pointers, base, default_extract, DEFAULT_SCHEMA, read_partitions=1, concurrency=1)
    assert captures.select(F.sum(F.size("rows"))).first()[0] == 3


def test_extractors_may_skip(spark, stored):
    def second_only(found, body):
        return {"url": found.headers["warc-target-uri"], "n": 2} if body == b"2" else None

    pointers, base = stored
    schema = T.StructType().add("url", T.StringType()).add("n", T.IntegerType())
    rows = read_archive(pointers, base, second_only, schema, key="url").orderBy("offset").collect()
    assert [r.skipped for r in rows] == [1, 0, 1]
    assert rows[0]["rows"] == [("https://x.com/2", 2)]


def test_rows_need_their_key_and_fitting_values(spark, stored):
    pointers, base = stored
    schema = T.StructType().add("url", T.StringType()).add("n", T.IntegerType())
    for extractor, problem in [
        (lambda found, body: {"n": 1}, "key column"),
        (lambda found, body: {"url": "u", "n": "many"}, "many|int"),
    ]:
        with pytest.raises(PySparkException, match=problem):
            read_archive(pointers, base, extractor, schema, key="url").collect()


def test_a_missing_archive_fails(spark, stored):
    pointers, base = stored
    lost = pointers.withColumn("filename", F.lit("none"))
    with pytest.raises(PySparkException, match="none"):
        read_archive(lost, base, default_extract, DEFAULT_SCHEMA, retries=1, retry_delay=0.0).collect()


@pytest.mark.parametrize("change", [-20, 2000])
def test_ranges_that_are_cut_or_pass_the_end_fail(spark, stored, change):
    pointers, base = stored
    cut = pointers.where("url = 'u2'").withColumn("length", F.col("length") + change)
    with pytest.raises(PySparkException, match="compressed archive record|of its|could be read"):
        read_archive(cut, base, default_extract, DEFAULT_SCHEMA, retries=0).collect()


def test_names_that_need_quoting(spark, stored):
    def odd(found, body):
        return {"og:title": "t", "a.b": len(body)}

    pointers, base = stored
    schema = T.StructType().add("og:title", T.StringType()).add("a.b", T.LongType())
    rows = archive_rows(read_archive(pointers, base, odd, schema))
    assert rows.columns == ["_arrival", "og:title", "a.b"]
    assert rows.select("`a.b`").agg(F.sum("`a.b`")).first()[0] == 6


def test_one_hot_archive_is_read_by_many_tasks(spark, stored):
    pointers, base = stored
    copies = pointers.where("url = 'u2'").withColumn("position", F.explode(F.sequence(F.lit(1), F.lit(800))))
    captures = read_archive(copies, base, default_extract, DEFAULT_SCHEMA, read_partitions=8)
    sizes = captures.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(sizes) == 8
    assert max(r["count"] for r in sizes) < 300


def test_ranges_that_touch_share_a_read(monkeypatch):
    monkeypatch.setattr(archive, "SHARED_BYTES", 100)
    ranges = [("a", 0, 10), ("a", 10, 5), ("a", 12, 20), ("a", 40, 60), ("b", 100, 10), ("b", 110, 95), ("b", 205, 5), ("b", 0, 3)]
    assert list(archive.shared_reads(ranges)) == [
        ("a", 0, 32, [(0, 10), (10, 5), (12, 20)]), ("a", 40, 100, [(40, 60)]), ("b", 100, 110, [(100, 10)]),
        ("b", 110, 210, [(110, 95), (205, 5)]), ("b", 0, 3, [(0, 3)]),
    ]
    assert list(archive.shared_reads([])) == []


def test_reads_ahead_are_bounded_by_bytes(monkeypatch):
    """Long ranges come alone, short ones together, and every range gets its own bytes."""
    monkeypatch.setattr(archive, "AHEAD_BYTES", 100)
    held, most = set(), 0

    class Store:
        def read(self, filename, offset, length):
            held.add(offset)
            return bytes(i % 251 for i in range(offset, offset + length)), 1

    class Pool:
        def submit(self, read, *place):
            nonlocal most
            submitted.append(place[2])
            most = max(most, sum(submitted))
            return Reading(read, place)

    class Reading:
        def __init__(self, read, place):
            self.read, self.place = read, place

        def result(self):
            submitted.remove(self.place[2])
            return self.read(*self.place)

    submitted = []
    ranges = [(n * 1000, 90 if n % 3 else 30) for n in range(12)] + [(50_000, 500), (60_000, 10), (60_010, 10)]
    batch = pa.RecordBatch.from_pylist([{"filename": "f", "offset": o, "length": n} for o, n in ranges])
    found = list(archive._in_order(batch, Store(), Pool(), 4))
    assert [d for d, _ in found] == [bytes(i % 251 for i in range(o, o + n)) for o, n in ranges]
    assert most == 500 and not submitted
