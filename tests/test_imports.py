import gzip
import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawltable import workspace
from crawltable.operators.counters import read_counters
from crawltable.operators.upsert import Target, read_table
from crawltable.plans import imports
from crawltable.plans.imports import import_cdx, import_domain, import_scope, read_options
from crawltable.sources import archive
from crawltable.sources.archive import archive_rows, read_archive
from crawltable.sources.cdx import parse_lines, select_cdx, stream_cdx
from crawltable.streaming.stream import import_stream, read_progress, stream_upsert
from crawltable.workspace import stage
from test_archive import http, record

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CAPTURES = [
    # url, day, status, mime, body
    ("https://www.x.com/a", 1, 200, "text/html", b"<style>.x{}</style>Hello <b>page</b>"),
    ("https://www.x.com/a", 2, 200, "text/html", b"<p>newer"),
    ("https://www.x.com/a", 3, 404, "text/html", b"<p>gone"),
    ("https://x.com/b", 1, 200, "text/html", b"<p>b"),
    ("https://www.x.com/robots.txt", 1, 200, "text/plain", b"capture 1"),
    ("https://www.x.com/robots.txt", 2, 200, "text/plain", b"capture 2"),
    ("https://other.org/", 1, 200, "text/html", b"<p>other"),
]
INDEX = (
    "url string, url_host_name string, url_host_registered_domain string, url_path string, "
    "content_mime_detected string, fetch_status int, fetch_time timestamp, warc_filename string, "
    "warc_record_offset bigint, warc_record_length bigint, crawl string, subset string"
)


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    """Archives, an index and CDX pages of the captures above."""
    root = tmp_path_factory.mktemp("store")
    (root / "archive").mkdir()
    (root / "cdx").mkdir()
    index, lines = [], []
    for n, (url, day, status, mime, body) in enumerate(CAPTURES):
        time = f"2024-01-0{day}T00:00:00Z"
        kind = f"Content-Type: {mime}; charset=utf-8"
        member = gzip.compress(record(http(body, kind), uri=url, date=time))
        (root / "archive" / f"{n}.gz").write_bytes(b"pad" + member)
        host, _, path = url.removeprefix("https://").partition("/")
        place = (f"{n}.gz", 3, len(member))
        index.append((url, host, host.removeprefix("www."), f"/{path}", mime, status, time, *place, "C2", "warc"))
        lines.append(
            json.dumps(
                {
                    "url": url, "timestamp": time, "mime": mime, "status": str(status),
                    "filename": place[0], "offset": "3", "length": str(place[2]),
                }
            )
        )
    index.append((*index[3][:-2], "C1", "warc"))
    fields = INDEX.replace("fetch_time timestamp", "fetch_time string")
    rows = spark.createDataFrame(index, fields).withColumn("fetch_time", F.col("fetch_time").cast("timestamp"))
    rows.write.partitionBy("crawl", "subset").parquet(str(root / "index"))
    for page, part in enumerate((lines[:3], lines[3:])):
        (root / "cdx" / f"page-{page}.json").write_text("\n".join(part))
    return {name: str(root / name) for name in ("index", "archive", "cdx")}


@pytest.fixture
def target(tmp_path, request):
    name = "".join(c if c.isalnum() else "_" for c in request.node.name)
    return Target(name, root=str(tmp_path), buckets=4)


def test_default_import(spark, store, target):
    table, counters = import_domain(spark, store["index"], "C2", "x.com", store["archive"], target)
    assert table.orderBy("url").collect() == [
        ("https://www.x.com/a", "2024-01-02T00:00:00Z", "text/html; charset=utf-8", "newer"),
        ("https://x.com/b", "2024-01-01T00:00:00Z", "text/html; charset=utf-8", "b"),
    ]
    assert counters[:4] == (2, 2, 0, 2) and counters.requests == 2 and counters.bytes_read > 100


def test_staged_data_is_removed(spark, store, target, monkeypatch, tmp_path):
    monkeypatch.setattr(workspace, "workspace", lambda spark: str(tmp_path / "work"))
    import_domain(spark, store["index"], "C2", "x.com", store["archive"], target)
    assert [p for p in (tmp_path / "work").rglob("*.parquet")] == []


def test_host_patterns_and_limit(spark, store, target):
    def urls(**options):
        table, _ = import_domain(spark, store["index"], "C2", archive=store["archive"], **options)
        return sorted(r.url for r in table.collect())

    one = Target(target.table + "1", root=target.root, buckets=4)
    assert urls(site="www.x.com", match="host", target=one) == ["https://www.x.com/a"]
    two = Target(target.table + "2", root=target.root, buckets=4)
    assert urls(site="x.com", url_patterns=["/b$"], target=two) == ["https://x.com/b"]
    three = Target(target.table + "3", root=target.root, buckets=4)
    assert urls(site="x.com", limit=1, target=three) == ["https://www.x.com/a"]
    four = Target(target.table + "4", root=target.root, buckets=4)
    assert urls(site="x.com", limit=0, target=four) == []


def test_imports_add_to_the_table(spark, store, target):
    import_domain(spark, store["index"], "C2", "x.com", store["archive"], target)
    table, _ = import_domain(spark, store["index"], "C2", "other.org", store["archive"], target)
    assert table.count() == 3


def robots_query(order):
    return f"""SELECT url, date_format(fetch_time, 'yyyy-MM-dd HH:mm:ss') AS timestamp, warc_filename,
      warc_record_offset, warc_record_length FROM ccindex
      WHERE crawl = 'C2' AND url_path = '/robots.txt' ORDER BY {order}"""


@pytest.mark.parametrize("order, text", [("fetch_time", "capture 2"), ("fetch_time DESC", "capture 1")])
def test_the_last_row_of_a_query_wins(spark, store, tmp_path, order, text):
    target = Target("robots_" + text[-1], root=str(tmp_path), buckets=4)
    table, counters = import_domain(
        spark, store["index"], "C2", "x.com", store["archive"], target, query=robots_query(order)
    )
    assert [(r.url, r.text) for r in table.collect()] == [("https://www.x.com/robots.txt", text)]
    assert (counters.matched, counters.imported) == (2, 1)


def test_a_key_counts_again_in_a_later_batch(spark, store, target):
    table, counters = import_domain(
        spark, store["index"], "C2", "x.com", store["archive"], target,
        query=robots_query("fetch_time"), batch_size=1,
    )
    assert (counters.matched, counters.imported, table.count()) == (2, 2, 1)


TITLED = T.StructType().add("url", T.StringType()).add("title", T.StringType())


def first_only(found, body):
    url = found.headers["warc-target-uri"]
    return None if url.endswith("/b") else {"url": url, "title": "A"}


def test_extractors_choose_rows_and_columns(spark, store, target):
    table, counters = import_domain(
        spark, store["index"], "C2", "x.com", store["archive"], target,
        extractor=first_only, schema=TITLED,
    )
    assert table.collect() == [("https://www.x.com/a", "A")]
    assert counters[:4] == (2, 1, 1, 2)


def varied(found, body):
    url = found.headers["warc-target-uri"]
    if url.endswith("/a"):
        return {"url": url, "size": len(body), "note": None, "tags": ["x"]}
    return {"url": url, "late": b"b", "size": 0.5}


def test_columns_can_be_found_in_the_rows(spark, store, target):
    table, counters = import_domain(
        spark, store["index"], "C2", "x.com", store["archive"], target, extractor=varied
    )
    assert table.dtypes == [
        ("url", "string"), ("size", "double"), ("note", "string"), ("tags", "array<string>"),
        ("late", "binary"),
    ]
    assert table.orderBy("url").collect() == [
        ("https://www.x.com/a", 8.0, None, ["x"], None),
        ("https://x.com/b", 0.5, None, None, b"b"),
    ]
    assert counters[:3] == (2, 2, 0)


def test_a_declared_schema_can_grow(spark, store, target):
    def run(**options):
        return import_domain(
            spark, store["index"], "C2", "x.com", store["archive"], target,
            extractor=varied, schema=TITLED, **options,
        )[0]

    with pytest.raises(PySparkException, match="not in the schema"):
        run(grow=False)
    assert run().columns == ["url", "title", "size", "note", "tags", "late"]


def test_the_key_may_come_from_the_rows(spark, store, target):
    schema = T.StructType().add("title", T.StringType())
    table, _ = import_domain(
        spark, store["index"], "C2", "x.com", store["archive"], target,
        extractor=first_only, schema=schema,
    )
    assert table.select("title", "url").collect() == [("A", "https://www.x.com/a")]
    with pytest.raises(ValueError, match="key column"):
        read_options(first_only, schema, grow=False)


def nested(found, body):
    url = found.headers["warc-target-uri"]
    if url.endswith("/a"):
        return {"url": url, "links": [], "m": {"t": None}, "og:title": "A", "a.b": 1}
    return {"url": url, "links": ["x"], "m": {"t": "x", "n": 1}, "a.b": 0.5}


@pytest.mark.parametrize("flush", [1, 8 << 20])
def test_found_types_do_not_depend_on_batches(spark, store, target, monkeypatch, flush):
    monkeypatch.setattr(archive, "FLUSH_BYTES", flush)
    table, _ = import_domain(
        spark, store["index"], "C2", "x.com", store["archive"], target, extractor=nested, read_partitions=1
    )
    assert table.dtypes == [
        ("url", "string"), ("links", "array<string>"), ("m", "struct<n:bigint,t:string>"),
        ("og:title", "string"), ("a.b", "double"),
    ]
    assert table.orderBy("url").collect() == [
        ("https://www.x.com/a", [], (None, None), "A", 1.0),
        ("https://x.com/b", ["x"], (1, "x"), None, 0.5),
    ]


@pytest.mark.parametrize("limit", [0, 100_000])
def test_last_rows(spark, monkeypatch, limit):
    monkeypatch.setattr(imports, "BROADCAST_ROWS", limit)
    data = [("a", 1, "x"), ("b", 2, "y"), ("a", 3, "z"), (None, 4, "u"), (None, 5, "v")]
    rows = spark.createDataFrame(data, "k string, i int, `t.t` string")
    kept = imports.last_rows(rows, "k", "i")
    assert sorted(kept.collect(), key=lambda r: r.i) == [("b", 2, "y"), ("a", 3, "z"), (None, 5, "v")]
    assert imports.last_rows(rows.where("i < 3"), "k", "i").count() == 2


def test_reading_tasks_follow_the_bytes(spark):
    def tasks(n, length):
        return imports._read_tasks(spark, imports.PointerSize(n, n * length))

    cores = spark.sparkContext.defaultParallelism
    assert tasks(3, 10) == 3 and tasks(1000, 10) == cores
    assert tasks(100_000, imports.READ_BYTES) == 100_000


def test_values_of_several_types_fail(spark, store, target):
    def mixed(found, body):
        url = found.headers["warc-target-uri"]
        return {"url": url, "v": 1 if url.endswith("/a") else "one"}

    with pytest.raises((ValueError, PySparkException)):
        import_domain(spark, store["index"], "C2", "x.com", store["archive"], target, extractor=mixed)


def test_without_schema_and_rows_there_is_no_table(spark, store, target):
    table, counters = import_domain(
        spark, store["index"], "C2", "x.com", store["archive"], target, extractor=lambda r, b: None
    )
    assert table.columns == [] and counters[:3] == (2, 0, 2)
    assert not spark.catalog.tableExists(target.name)


def test_empty_imports_leave_an_empty_table(spark, store, target):
    table, counters = import_domain(spark, store["index"], "C2", "none.org", store["archive"], target)
    assert table.columns == ["url", "date", "content_type", "text"] and table.count() == 0
    assert counters == (0, 0, 0, 0, 0, 0)


def test_scope_import_takes_the_newest_crawl(spark, store, target):
    table, counters = import_scope(
        spark, store["index"], "https://www.x.com", store["archive"], target, scope="domain"
    )
    assert table.count() == counters.matched == 2


def test_cdx_import(spark, store, target):
    table, counters = import_cdx(spark, store["cdx"], "x.com", store["archive"], target)
    texts = {r.url: r.text for r in table.collect()}
    assert texts == {
        "https://www.x.com/a": "newer",
        "https://x.com/b": "b",
        "https://www.x.com/robots.txt": "capture 2",
    }
    assert (counters.matched, counters.imported) == (5, 3)


def test_progress(spark, store, target, monkeypatch):
    monkeypatch.setattr(imports, "HEARTBEAT_SECONDS", 30)
    seen = []
    _, counters = import_domain(
        spark, store["index"], "C2", "x.com", store["archive"], target,
        extractor=first_only, schema=TITLED, on_progress=seen.append,
    )
    assert [e.stage for e in seen] == [
        "started", "index_registering", "index_listing", "index_querying", "index_batch_scanned",
        "record_matched", "record_skipped", "record_extracted", "batch_merged", "completed",
    ]
    last = seen[-1]
    assert (last.matched, last.imported, last.skipped, last.files_read, last.pending) == (2, 1, 1, 2, 0)
    assert (last.bytes_read, last.requests) == counters[4:]
    assert seen[-2].current_url == "https://x.com/b"


def test_heartbeats(spark, store, target, monkeypatch):
    monkeypatch.setattr(imports, "HEARTBEAT_SECONDS", 0.01)
    seen = []
    import_domain(
        spark, store["index"], "C2", "x.com", store["archive"], target, on_progress=seen.append
    )
    for stage_name in ("index_querying", "record_matched"):
        assert [e.stage for e in seen].count(stage_name) > 1


@pytest.mark.parametrize(
    "options",
    [
        {"key": ""}, {"key": "title"}, {"batch_size": 0}, {"read_partitions": 0}, {"concurrency": 0},
        {"retries": -1}, {"retry_delay": -0.1}, {"match": "prefix"},
    ],
)
def test_bad_options_fail_before_any_work(spark, store, target, options):
    with pytest.raises(ValueError):
        import_domain(spark, store["index"], "C2", "x.com", store["archive"], target, **options)
    assert not spark.catalog.tableExists(target.name)


def test_schemas():
    default = ["url", "date", "content_type", "text"]
    assert read_options().schema.names == default
    more = T.StructType().add("note", T.StringType()).add("text", T.StringType())
    assert read_options(schema=more).schema.names == ["note", "text", "url", "date", "content_type"]
    assert read_options(first_only, TITLED).grow and not read_options(first_only, TITLED, grow=False).grow
    assert read_options(first_only, grow=False).grow


def test_counters_do_not_read_texts(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    schema = T.StructType().add("url", T.StringType()).add("text", T.StringType())
    pointers = spark.createDataFrame([], "url string, filename string, offset bigint, length bigint, position string")
    captures = stage(read_archive(pointers, "/tmp", first_only, schema), "captures")
    rows = archive_rows(captures)
    for df in (read_counters(captures), rows.select("url", "_arrival")):
        assert "text" not in df._jdf.queryExecution().executedPlan().toString()


def test_cdx_stream(spark, store, target, tmp_path):
    def select(lines):
        return select_cdx(parse_lines(lines), "x.com", ordered=False)

    def run():
        query = import_stream(
            stream_cdx(spark, store["cdx"], max_files=1), store["archive"], target, select=select,
            checkpoint=str(tmp_path / "checkpoint"), progress_path=str(tmp_path / "progress"),
        )
        query.awaitTermination()
        events = read_progress(spark, str(tmp_path / "progress"))
        return events.where("stage = 'batch_merged'").agg(F.count("*"), F.sum("matched")).first()

    assert run() == (2, 5)
    assert {r.text for r in read_table(spark, target).collect()} == {"newer", "b", "capture 2"}
    # Started again, the stream finds nothing new.
    assert run() == (2, 5)


def test_stream_events(spark, tmp_path, target):
    folder = str(tmp_path / "drops")
    for start in (0, 10):
        spark.range(start, start + 10, 1, 1).selectExpr("id % 4 AS k", "id").write.mode("append").parquet(folder)
    stream = spark.readStream.schema("k bigint, id bigint").option("maxFilesPerTrigger", 1).parquet(folder)
    seen = []
    query = stream_upsert(stream, target, "k", "id", on_progress=seen.append)
    query.awaitTermination()
    for _ in range(100):
        if seen and seen[-1].stage == "completed":
            break
        __import__("time").sleep(0.1)
    assert [e.stage for e in seen] == [
        "started", *["record_matched", "record_extracted", "batch_merged"] * 2, "completed",
    ]
    assert (seen[-1].matched, seen[-1].imported, seen[-1].pending) == (20, 8, 0)
    assert sorted(read_table(spark, target).collect()) == [(0, 16), (1, 17), (2, 18), (3, 19)]
