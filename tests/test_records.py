"""Archives as a data source, and extractors as table functions."""

import gzip
import sys
import time

import pytest
from pyspark import cloudpickle
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawltable.operators.lateral import register_extractor
from crawltable.sources import records
from crawltable.sources.records import RECORD_SCHEMA, RecordReader, scan_records
from test_archive import http, record

cloudpickle.register_pickle_by_value(sys.modules[__name__])

N = 60


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("records")
    (root / "archive").mkdir()
    rows, data = [], b""
    for n in range(N):
        url = f"{'http' if n % 3 else 'https'}://x.com/{n}"
        body = gzip.compress(f"<p>page {n}".encode() * 2000)
        parts = (record(b"GET", "request", uri=url), record(http(body, "Content-Type: text/html", "Content-Encoding: gzip"), uri=url))
        member = b"".join(map(gzip.compress, parts))
        rows.append((url, "a.gz", len(data), len(member)))
        data += member
    (root / "archive" / "a.gz").write_bytes(data)
    pointers = spark.createDataFrame(rows, "url string, filename string, offset bigint, length bigint")
    pointers.repartition(3).write.parquet(str(root / "pointers"))
    return {"pointers": str(root / "pointers"), "archive": str(root / "archive")}


def test_all_columns(spark, store):
    rows = scan_records(spark, store["pointers"], store["archive"]).orderBy("offset").collect()
    assert len(rows) == N and rows[0].__fields__ == RECORD_SCHEMA.names
    for n, row in enumerate(rows):
        assert row.uri == row.url and row.filename == "a.gz" and row.content_type == "text/html"
        assert row.body == f"<p>page {n}".encode() * 2000 and row.text.startswith(f"page {n} page {n}")
        assert row.headers["warc-type"] == "response" and row.http_headers["content-encoding"] == "gzip"
        assert row.date == "2024-01-01T00:00:00Z"


def test_filters_reach_the_pointers(spark, store, monkeypatch):
    found = scan_records(spark, store["pointers"], store["archive"], ["url", "offset", "content_type"])
    some = found.where((F.col("offset") > 300) & F.col("url").startswith("https") & (F.col("content_type") != "x"))
    assert some.count() == sum(1 for r in found.collect() if r.offset > 300 and r.url.startswith("https"))
    reader = RecordReader(T.StructType([RECORD_SCHEMA["url"]]), store)
    left = list(reader.pushFilters([
        records.EqualTo(("url",), "https://x.com/3"), records.EqualTo(("content_type",), "text/html"), records.GreaterThan(("length",), 5),
    ]))
    assert left == [records.EqualTo(("content_type",), "text/html")]
    assert [r["url"] for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()] == ["https://x.com/3"]
    # A range that no filter lets through is not opened at all.
    reader = RecordReader(T.StructType([RECORD_SCHEMA["url"]]), {**store, "archive": "/absent"})
    list(reader.pushFilters([records.In(("url",), ("nowhere",))]))
    assert [b for p in reader.partitions() for b in reader.read(p)] == []


def test_heads_alone_unpack_no_body(store, monkeypatch):
    def seconds(columns):
        reader = RecordReader(T.StructType([RECORD_SCHEMA[c] for c in columns]), store)
        start = time.process_time()
        rows = [r for _ in range(5) for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
        assert len(rows) == 5 * N
        return time.process_time() - start

    seconds(["uri"])
    assert seconds(["uri", "headers", "content_type"]) < 0.5 * seconds(["uri", "headers", "content_type", "text"])
    from crawltable.sources import archive

    monkeypatch.setattr(archive, "_plain_body", None)
    seconds(["uri"])
    with pytest.raises(TypeError):
        seconds(["body"])


def test_parts_and_bad_schemas(spark, store, monkeypatch):
    monkeypatch.setattr(records, "TASK_POINTERS", 7)
    monkeypatch.setattr(records, "FLUSH_BYTES", 1)
    reader = RecordReader(RECORD_SCHEMA, store)
    parts = reader.partitions()
    batches = [b for p in parts for b in reader.read(p)]
    assert len(parts) > 6 and len(batches) == N == sum(b.num_rows for b in batches)
    with pytest.raises(ValueError, match="no \\['title'\\]"):
        RecordReader(T.StructType().add("title", T.StringType()), store)
    empty = scan_records(spark, store["pointers"], store["archive"], ["url"]).where("url = 'nowhere'")
    assert empty.count() == 0


PAGE = T.StructType().add("url", T.StringType()).add("size", T.IntegerType()).add("tags", T.ArrayType(T.StringType()))


def page(found, body):
    n = int(found.headers["warc-target-uri"].rsplit("/", 1)[1])
    return None if n % 5 == 0 else {"url": found.headers["warc-target-uri"], "size": len(body), "tags": ["a", None]}


def test_table_function(spark, store):
    register_extractor(spark, "pages_of", page, PAGE, store["archive"])
    spark.read.parquet(store["pointers"]).createOrReplaceTempView("pointers")
    rows = spark.sql("SELECT p.offset, t.* FROM pointers p, LATERAL pages_of(p.filename, p.offset, p.length) t")
    assert rows.schema[1:] == PAGE.fields or [f.name for f in rows.schema] == ["offset", *PAGE.names]
    found = rows.collect()
    assert len(found) == N - N // 5 and all(r.tags == ["a", None] and r.size > 2000 for r in found)
    none = spark.sql("SELECT * FROM pages_of(CAST(NULL AS STRING), 1, 2)")
    assert none.columns == PAGE.names and none.count() == 0
    for bad in ("pages_of(1, 2, 3)", "pages_of('a.gz', 'x', 3)"):
        with pytest.raises(PySparkException, match="must be"):
            spark.sql(f"SELECT * FROM {bad}").collect()
    register_extractor(spark, "more_of", lambda r, b: {"other": 1}, PAGE, store["archive"])
    with pytest.raises(PySparkException, match="not in the schema"):
        spark.sql("SELECT t.* FROM pointers p, LATERAL more_of(p.filename, p.offset, p.length) t").collect()
