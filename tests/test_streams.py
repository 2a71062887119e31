"""Streams against imports of the same pages at once."""

import gzip
import json
import os
import random
import sys
import time

import pytest
from pyspark import cloudpickle
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawltable.functions.places import sortable
from crawltable.operators import upsert as upserts
from crawltable.operators.counters import Arrivals, imported_count
from crawltable.operators.upsert import ORDER, Target, read_table, rebucket, upsert
from crawltable.plans import imports
from crawltable.plans.imports import import_cdx
from crawltable.sources.cdx import parse_lines, read_cdx, select_cdx, stream_cdx
from crawltable.sources.lines import PageReader, batch_ends, lines_between, place
from crawltable.streaming import stream as streams
from crawltable.streaming.stream import import_cdx_stream, import_stream, read_progress, stream_upsert
from test_archive import http, record

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PAGES, LINES = 5, 9


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    """Pages that list a few URLs again and again; the body of a capture is its place."""
    root = tmp_path_factory.mktemp("streams")
    (root / "archive").mkdir()
    pick = random.Random(4)
    pages = []
    for page in range(PAGES):
        data, lines = b"", []
        for line in range(LINES):
            url = f"https://x.com/{pick.randrange(12)}"
            member = gzip.compress(record(http(f"{page}.{line}".encode(), "Content-Type: text/plain"), uri=url))
            place = {"filename": f"{page}.gz", "offset": str(len(data)), "length": str(len(member))}
            lines.append(json.dumps({"url": url, "timestamp": f"{pick.randrange(99)}", "status": "200", **place}))
            data += member
        (root / "archive" / f"{page}.gz").write_bytes(data)
        pages.append("\n".join(lines[:4]) + "\n\n" + "\n".join(lines[4:]) + "\n")
    return {"archive": str(root / "archive"), "pages": pages}


def write_pages(folder, pages, order):
    """Pages whose times of writing have the given order."""
    folder.mkdir()
    for place, n in enumerate(order):
        file = folder / f"page-{n}.json"
        file.write_text(pages[n])
        os.utime(file, (1_700_000_000 + 10 * place,) * 2)
    return str(folder)


@pytest.fixture
def target(tmp_path, request):
    name = "".join(c if c.isalnum() else "_" for c in request.node.name)
    return Target(name, root=str(tmp_path / "tables"), buckets=4)


def content(spark, target):
    return sorted(map(tuple, read_table(spark, target).collect()))


@pytest.fixture
def at_once(spark, store, tmp_path, target):
    def run(order):
        own = Target(f"{target.table}_once", root=target.root, buckets=2)
        folder = write_pages(tmp_path / "once", store["pages"], order)
        _, counters = import_cdx(spark, folder, "x.com", store["archive"], own, batch_size=7)
        return content(spark, own), counters

    return run


@pytest.mark.parametrize(
    "order,limit", [([0, 1, 2, 3, 4], 1 << 20), ([4, 3, 2, 1, 0], 0), ([4, 3, 2, 1, 0], 1 << 20), ([2, 4, 0, 3, 1], 1 << 20)]
)
def test_file_times_do_not_matter(spark, store, target, tmp_path, at_once, monkeypatch, order, limit):
    monkeypatch.setattr(upserts, "BROADCAST_BYTES", limit)
    monkeypatch.setattr(upserts, "SHUFFLE_BYTES", 0)
    folder = write_pages(tmp_path / "cdx", store["pages"], order)
    import_stream(
        stream_cdx(spark, folder, max_files=1), store["archive"], target,
        select=lambda lines: select_cdx(parse_lines(lines), "x.com", ordered=False),
    ).awaitTermination()
    expected, _ = at_once(range(PAGES))
    assert content(spark, target) == expected


@pytest.mark.parametrize("max_files", [2, 5])
def test_counters_of_stream_and_batch_agree(spark, store, target, tmp_path, at_once, max_files):
    folder = write_pages(tmp_path / "cdx", store["pages"], range(PAGES))
    events = str(tmp_path / "events")
    import_stream(
        stream_cdx(spark, folder, max_files=max_files), store["archive"], target, progress_path=events,
        select=lambda lines: select_cdx(parse_lines(lines), "x.com", ordered=False), batch_size=7,
    ).awaitTermination()
    _, counters = at_once(range(PAGES))
    merged = read_progress(spark, events).where("stage = 'batch_merged'")
    assert merged.agg(F.sum("matched"), F.sum("imported")).first() == counters[:2]


def test_batches_by_rows(spark, store, target, tmp_path, at_once):
    """Batches of ten lines over page ends, stopped half way and started again."""
    folder = write_pages(tmp_path / "cdx", store["pages"][:3], range(3))
    options = {"batch_size": 10, "checkpoint": str(tmp_path / "checkpoint"), "progress_path": str(tmp_path / "events")}

    def run():
        import_cdx_stream(spark, folder, "x.com", store["archive"], target, **options).awaitTermination()
        merged = read_progress(spark, options["progress_path"]).where("stage = 'batch_merged'")
        return [r.matched for r in merged.orderBy("batch").collect()]

    assert run() == [10, 10, 7]
    for n, page in enumerate(store["pages"][3:], 3):
        (tmp_path / "cdx" / f"page-{n}.json").write_text(page)
        os.utime(tmp_path / "cdx" / f"page-{n}.json", (1_700_001_000 + n,) * 2)
    assert run() == [10, 10, 7, 10, 8]
    assert run() == [10, 10, 7, 10, 8]
    expected, counters = at_once(range(PAGES))
    assert content(spark, target) == expected
    totals = read_progress(spark, options["progress_path"]).where("stage = 'batch_merged'")
    assert totals.agg(F.sum("imported")).first()[0] == imported_in_batches(spark, tmp_path / "cdx", 10)


def imported_in_batches(spark, folder, size):
    urls = [r.url for r in read_cdx(spark, str(folder)).orderBy("position").collect()]
    return sum(len(set(urls[n : n + size])) for n in range(0, len(urls), size))


@pytest.mark.parametrize("pack", [None, gzip.compress])
def test_offsets_and_lines(store, tmp_path, pack):
    folder = tmp_path / "pages"
    folder.mkdir()
    for n, page in enumerate(store["pages"]):
        data = page.encode() if pack is None else pack(page.encode())
        (folder / f"p{n}.json{'.gz' if pack else ''}").write_bytes(data)
    (folder / "_hidden").write_text("x")
    (folder / "empty.json").write_text("")
    lines = sorted(line for page in store["pages"] for line in page.split("\n")[:-1])
    for size in (1, 4, 13, 1000):
        reader, start, found = PageReader(str(folder), size), None, []
        start = reader.initialOffset()
        while (end := reader.latestOffset()) != start:
            parts = reader.partitions(start, end)
            rows = [r for part in parts for batch in reader.read(part) for r in batch.to_pylist()]
            assert sum(r["line"] != "" for r in rows) == min(size, PAGES * LINES - sum(r["line"] != "" for r in found))
            found += rows
            # Another reader, as after a restart, is told the last batch and goes on.
            again = PageReader(str(folder), size)
            assert [vars(p) for p in again.partitions(start, end)] == [vars(p) for p in parts]
            reader = again if len(found) % 2 else reader
            start = end
        assert sorted(r["line"] for r in found) == lines
        assert len({(r["file"], r["number"]) for r in found}) == len(lines)
    assert PageReader(str(tmp_path / "absent"), 5).latestOffset() == reader.initialOffset()
    with pytest.raises(ValueError):
        PageReader(str(folder), 0)


def test_arrivals_equal_one_count(spark, tmp_path):
    keys = random.Random(1).choices("abcdefgh", k=60) + [None, None]
    rows = spark.createDataFrame([(k, n) for n, k in enumerate(keys)], "k string, n int")
    for size in (5, 40):
        for cuts in ([0, 3, 4, 20, 20, 62], [0, 5, 62]):
            total = 0
            for part, (start, end) in enumerate(zip(cuts, cuts[1:])):
                arrivals = Arrivals(str(tmp_path / f"{size}-{len(cuts)}-{cuts[1]}"), part)
                some = rows.where((F.col("n") >= start) & (F.col("n") < end))
                total += arrivals.count(some, "k", "n", size)
                # Counted again after a failure, a part gives the same number.
                if part == 1 and size == 5:
                    total += arrivals.count(some, "k", "n", size) - arrivals.count(some, "k", "n", size)
            assert total == imported_count(rows, "k", "n", size).first()["imported"]


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_later_rows_of_a_source_stay(spark, target, monkeypatch, limit):
    monkeypatch.setattr(upserts, "BROADCAST_BYTES", limit)
    monkeypatch.setattr(upserts, "SHUFFLE_BYTES", 0)

    def put(data, source, schema="k string, a int, at int"):
        upsert(spark, target, spark.createDataFrame(data, schema), "k", "at", source)

    def rows():
        return sorted(map(tuple, read_table(spark, target).select("k", "a").collect()))

    put([("x", 1, 10), ("y", 2, 10)], "s")
    put([("x", 3, 9), ("y", 4, 11), ("z", 5, 1)], "s")
    assert rows() == [("x", 1), ("y", 4), ("z", 5)]
    put([("x", 3, 10)], "s")
    assert rows() == [("x", 3), ("y", 4), ("z", 5)]
    put([("x", 6, -5)], "other")
    put([("x", 7, -6), ("y", 8, None)], "other")
    assert rows() == [("x", 6), ("y", 8), ("z", 5)]
    rebucket(spark, target, 3)
    put([("x", 9, -7), ("z", 0, 0)], "other")
    assert rows() == [("x", 6), ("y", 8), ("z", 0)]
    upsert(spark, target, spark.createDataFrame([("x", 11)], "k string, a int"), "k")
    assert rows()[0] == ("x", 11)
    put([("x", 12, 3, "new")], "other", "k string, a int, at int, b string")
    assert ORDER not in read_table(spark, target).columns
    assert read_table(spark, target).where("k = 'x'").select("a", "b").first() == (12, "new")


@pytest.mark.parametrize("reverse", [False, True])
def test_upserts_of_a_stream_keep_their_order(spark, tmp_path, target, reverse):
    folder = tmp_path / "drops"
    for n in range(3):
        part = folder / f"part-{n}"
        spark.range(10 * n, 10 * n + 10, 1, 1).selectExpr("id % 4 AS k", "id").write.parquet(str(part))
        for file in part.glob("*.parquet"):
            os.utime(file, (1_700_000_000 + (-n if reverse else n) * 100,) * 2)
    stream = spark.readStream.schema("k bigint, id bigint").option("maxFilesPerTrigger", 1)
    stream_upsert(stream.parquet(f"{folder}/*"), target, "k", "id").awaitTermination()
    assert content(spark, target) == [(0, 28), (1, 29), (2, 26), (3, 27)]


def test_texts_sort_as_their_values(spark):
    schema = "v struct<a:bigint,b:string,c:struct<d:date,e:timestamp>,f:boolean>"
    pick = random.Random(2)
    days = [None, *(T.DateType().fromInternal(n) for n in (-400, 0, 19_000))]
    times = [None, *(T.TimestampType().fromInternal(n) for n in (-5_000_000, 0, 1_700_000_000_000_001))]
    texts = [None, "", "a", "a\0", "a\0\1", "ab", "é", "\U0001f600", "￿"]
    numbers = [None, -(1 << 63), -5, 0, 3, (1 << 63) - 1]
    data = [
        ((pick.choice(numbers), pick.choice(texts), pick.choice([None, (pick.choice(days), pick.choice(times))]), pick.choice([None, True, False])),)
        for _ in range(400)
    ] + [(None,)]
    rows = spark.createDataFrame(data, schema)
    text = sortable(F.col("v"), rows.schema["v"].dataType)
    pairs = rows.select("v", text.alias("t")).coalesce(1)
    by_value = [r.v for r in pairs.orderBy("v").collect()]
    by_text = [r.v for r in pairs.orderBy("t").collect()]
    assert by_value == by_text and all(r.t for r in pairs.collect())
    with pytest.raises(TypeError):
        sortable(F.col("v"), T.DoubleType())


def test_counters_move_while_a_stage_runs(spark, store, target, tmp_path, monkeypatch):
    monkeypatch.setattr(imports, "HEARTBEAT_SECONDS", 0.05)

    def slow(found, body):
        time.sleep(0.03)
        return {"url": found.headers["warc-target-uri"], "text": body.decode()}

    seen = []
    folder = write_pages(tmp_path / "cdx", store["pages"], range(PAGES))
    schema = T.StructType().add("url", T.StringType()).add("text", T.StringType())
    _, counters = import_cdx(
        spark, folder, "x.com", store["archive"], target, extractor=slow, schema=schema, grow=False,
        read_partitions=24, on_progress=seen.append,
    )
    running = [e for e in seen if e.stage == "record_extracted"]
    done = [e.pending for e in running]
    assert len(set(done)) > 3 and done == sorted(done) and 0 < done[0] < done[-1] == counters.matched
    assert (running[-1].files_read, running[-1].bytes_read, running[-1].requests) == counters[3:]
    assert seen[-1][1:5] == counters[:4]


@pytest.fixture
def merges(monkeypatch):
    """Numbers of pointers of each merge; with ``merges.broken`` they fail."""

    class Merges(list):
        broken = False

    merges, whole = Merges(), streams.import_pointers

    def counted(spark, pointers, size, *rest):
        if merges.broken:
            raise OSError("no archive")
        merges.append(size.matched)
        return whole(spark, pointers, size, *rest)

    monkeypatch.setattr(streams, "import_pointers", counted)
    return merges


def test_small_batches_share_merges(spark, store, target, tmp_path, at_once, merges):
    folder = write_pages(tmp_path / "cdx", store["pages"], [2, 4, 0, 3, 1])
    import_cdx_stream(spark, folder, "x.com", store["archive"], target, batch_size=2).awaitTermination()
    expected, _ = at_once(range(PAGES))
    assert content(spark, target) == expected
    # 23 batches, and merges whenever their number has doubled.
    assert sum(merges) == PAGES * LINES and len(merges) <= 6


def test_batches_before_a_broken_line_are_merged(spark, store, target, tmp_path, at_once):
    folder = write_pages(tmp_path / "cdx", [*store["pages"], "{}\n"], range(PAGES + 1))
    with pytest.raises(StreamingQueryException):
        import_cdx_stream(spark, folder, "x.com", store["archive"], target, batch_size=5).awaitTermination()
    expected, _ = at_once(range(PAGES))
    assert content(spark, target) == expected


def test_captures_left_by_a_run_come_with_the_next(spark, store, target, tmp_path, at_once, merges):
    folder = write_pages(tmp_path / "cdx", store["pages"], range(PAGES))
    options = {"batch_size": 4, "checkpoint": str(tmp_path / "checkpoint")}
    merges.broken = True
    with pytest.raises(StreamingQueryException):
        import_cdx_stream(spark, folder, "x.com", store["archive"], target, **options).awaitTermination()
    assert content(spark, target) == []
    merges.broken = False
    import_cdx_stream(spark, folder, "x.com", store["archive"], target, **options).awaitTermination()
    expected, _ = at_once(range(PAGES))
    assert content(spark, target) == expected


def test_waiting_batches_run_no_job(spark, store, target, tmp_path, at_once, monkeypatch):
    staged, whole = [], streams.stage_pointers

    def counted(*args):
        staged.append(args)
        return whole(*args)

    monkeypatch.setattr(streams, "stage_pointers", counted)
    folder = write_pages(tmp_path / "cdx", store["pages"], [2, 4, 0, 3, 1])
    checkpoint = tmp_path / "checkpoint"
    import_cdx_stream(
        spark, folder, "x.com", store["archive"], target, batch_size=2, checkpoint=str(checkpoint)
    ).awaitTermination()
    expected, _ = at_once(range(PAGES))
    assert content(spark, target) == expected
    # 23 batches and one without lines, of which those that merge leave anything behind.
    assert len(list((checkpoint / "commits").glob("[0-9]*"))) == 24
    assert len(staged) <= 6 and not (checkpoint / "pending").exists()


@pytest.mark.parametrize("progress", [False, True])
def test_lines_left_by_a_killed_run_come_with_the_next(spark, store, target, tmp_path, at_once, monkeypatch, progress):
    folder = write_pages(tmp_path / "cdx", store["pages"], [2, 4, 0, 3, 1])
    options = {"batch_size": 4, "checkpoint": str(tmp_path / "checkpoint")}

    def killed(waiting, part, bring, whole=streams.Waiting.add):
        if part.number == 5:
            raise RuntimeError("killed")
        whole(waiting, part, bring)

    with monkeypatch.context() as patch, pytest.raises(StreamingQueryException):
        patch.setattr(streams.Waiting, "add", killed)
        import_cdx_stream(spark, folder, "x.com", store["archive"], target, **options).awaitTermination()
    expected, _ = at_once(range(PAGES))
    # Batches 3 and 4 wait.
    assert len(list((tmp_path / "checkpoint" / "commits").glob("[0-9]*"))) == 5
    assert content(spark, target) != expected
    if progress:
        options["progress_path"] = str(tmp_path / "events")
    import_cdx_stream(spark, folder, "x.com", store["archive"], target, **options).awaitTermination()
    assert content(spark, target) == expected
    # A run after that has nothing to do, whether progress was asked for or not.
    before = spark.table(target.name).inputFiles()
    import_cdx_stream(spark, folder, "x.com", store["archive"], target, batch_size=4, checkpoint=options["checkpoint"]).awaitTermination()
    assert spark.table(target.name).inputFiles() == before


def test_pointers_of_an_older_run_come_first(spark, store, target, tmp_path, at_once):
    """Checkpoints may still hold pointers, and no word of the lines that wait."""
    folder = write_pages(tmp_path / "cdx", store["pages"][:2], range(2))
    checkpoint = str(tmp_path / "checkpoint")
    lines = stream_cdx(spark, folder, max_rows=LINES)

    def select(lines):
        return select_cdx(parse_lines(lines), "x.com", ordered=False)

    def leave(batch, number):
        streams.stage_pointers(select(batch), f"{checkpoint}/pending", f"batch={number}")

    query = lines.writeStream.foreachBatch(leave).option("checkpointLocation", checkpoint).start()
    query.processAllAvailable()
    query.stop()
    for n, page in enumerate(store["pages"][2:], 2):
        (tmp_path / "cdx" / f"page-{n}.json").write_text(page)
    import_cdx_stream(spark, folder, "x.com", store["archive"], target, batch_size=LINES, checkpoint=checkpoint).awaitTermination()
    expected, _ = at_once(range(PAGES))
    assert content(spark, target) == expected


def test_batches_before_a_broken_line_of_a_merge(spark, store, target, tmp_path):
    # Of the batches of four that share the merge, the third one is broken.
    bad = 38
    lines = [line for page in store["pages"] for line in page.split("\n") if line]
    folder = write_pages(tmp_path / "cdx", ["\n".join([*lines[:bad], "{}", *lines[bad:]]) + "\n"], [0])
    with pytest.raises(StreamingQueryException):
        import_cdx_stream(spark, folder, "x.com", store["archive"], target, batch_size=4).awaitTermination()
    whole = Target(f"{target.table}_whole", root=target.root, buckets=2)
    first = write_pages(tmp_path / "first", ["\n".join(lines[: bad // 4 * 4]) + "\n"], [0])
    import_cdx(spark, first, "x.com", store["archive"], whole)
    assert content(spark, target) == content(spark, whole)


def test_lines_between_offsets(spark, store, tmp_path):
    folder = write_pages(tmp_path / "pages", store["pages"], [2, 4, 0, 3, 1])
    reader = PageReader(folder, 7)
    ends = [reader.initialOffset()]
    while place(end := reader.latestOffset()) != place(ends[-1]):
        ends.append(end)

    def lines(start, end):
        return sorted(r[1:] + (r.line,) for r in lines_between(spark, folder, start, end).select("line", "file", "number").collect())

    inner = [place(e) for e in batch_ends(folder, 7, ends[0], ends[-1])]
    assert inner == [place(e) for e in ends[1:-1]]
    assert [place(e) for e in batch_ends(folder, 7, ends[2], ends[4])] == [place(ends[3])]
    assert lines(ends[0], ends[-1]) == sorted(row for two in zip(ends, ends[1:]) for row in lines(*two))
    assert lines(ends[2], ends[2]) == []


def test_rows_that_share_a_place_are_one(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("b", 2)], "k string, n int")
    assert sorted(map(tuple, imports.last_rows(rows, "k", "n").collect())) == [("a", 1), ("b", 2)]
