"""Whole imports: select captures, read archives, extract rows, upsert them."""

import threading
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.accumulators import Accumulator
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawltable.functions.names import named
from crawltable.functions.shapes import table_schema
from crawltable.functions.sites import scope_patterns
from crawltable.operators.counters import Arrivals, imported_count, read_counters
from crawltable.operators.dedupe import dedupe_last
from crawltable.operators.extract import DEFAULT_SCHEMA, default_extract
from crawltable.operators.pointers import is_given, select_with_query, to_pointers
from crawltable.operators.select import select_captures
from crawltable.operators.upsert import (
    Target,
    ensure_table,
    read_table,
    upsert,
)
from crawltable.sources.archive import (
    Extractor,
    Tally,
    archive_rows,
    infer_schema,
    read_archive,
    typed_rows,
)
from crawltable.sources.cdx import read_cdx, select_cdx
from crawltable.sources.index import index_location, latest_crawl, open_index, scan_index
from crawltable.workspace import scratch, stage

# Defaults of the import options.
DEFAULT_TABLE = "captures"
BATCH_SIZE = 100
HEARTBEAT_SECONDS = 5.0

# Where no partition count is given: archive bytes per reading task.
READ_BYTES = 32 << 20
# Superseded rows whose places are broadcast; more are left to a shuffle.
BROADCAST_ROWS = 100_000


class ImportCounters(NamedTuple):
    matched: int
    imported: int
    skipped: int
    files_read: int
    bytes_read: int
    requests: int


class ProgressEvent(NamedTuple):
    stage: str
    matched: int = 0
    imported: int = 0
    skipped: int = 0
    files_read: int = 0
    pending: int = 0
    current_url: str | None = None
    current_file: str | None = None
    bytes_read: int = 0
    requests: int = 0


OnProgress = Callable[[ProgressEvent], None]


class ReadOptions(NamedTuple):
    """How archives are read and what is made of them."""

    extractor: Extractor = default_extract
    schema: T.StructType | None = DEFAULT_SCHEMA
    grow: bool = True
    key: str = "url"
    batch_size: int = BATCH_SIZE
    read_partitions: int | None = None
    concurrency: int = 16
    retries: int = 3
    retry_delay: float = 1.0

    def check(self) -> "ReadOptions":
        if not self.key:
            raise ValueError("key must not be empty")
        for name in ("batch_size", "read_partitions", "concurrency"):
            if getattr(self, name) is not None and getattr(self, name) <= 0:
                raise ValueError(f"{name} must be greater than zero")
        for name in ("retries", "retry_delay"):
            if getattr(self, name) < 0:
                raise ValueError(f"{name} must not be negative")
        if self.schema is not None and self.key not in self.schema.names and not self.grow:
            raise ValueError(f"the schema lacks the key column {self.key!r}")
        return self


def read_options(
    extractor: Extractor | None = None,
    schema: T.StructType | None = None,
    grow: bool = True,
    **options,
) -> ReadOptions:
    """Checked options of an import.

    Columns of a schema given without an extractor come before the default ones. An
    extractor may return columns that ``schema`` lacks, even the key; they are found in
    the rows, which takes another pass over them. ``grow=False`` saves that pass and
    makes other columns than those of ``schema`` an error.
    """
    if extractor is None:
        read = ReadOptions(grow=False, **options)
        read = read._replace(schema=table_schema(schema, DEFAULT_SCHEMA, read.key or "url"))
        return read.check()
    return ReadOptions(extractor, schema, grow or schema is None, **options).check()


def import_domain(
    spark: SparkSession,
    index_path: str,
    crawl: str,
    site: str,
    archive: str,
    target: Target = Target(DEFAULT_TABLE),
    *,
    match: str = "domain",
    url_patterns: str | Sequence[str] | None = None,
    query: str | None = None,
    limit: int | None = None,
    on_progress: OnProgress | None = None,
    **options,
) -> tuple[DataFrame, ImportCounters]:
    """Import the latest HTML captures of a host or registered domain.

    ``query`` selects by SQL over the view ``ccindex`` instead; it must return URL
    and pointer columns, and gets the whole index. ``options`` are those of
    ``ReadOptions``.
    """
    read = read_options(**options)
    if match not in ("domain", "host"):
        raise ValueError("match must be 'domain' or 'host'")
    report = Reporter(on_progress)
    _prepare(spark, target, read, report)
    place = index_path if is_given(query) else index_location(index_path, crawl)[1]
    report("index_registering", current_file=place)
    report("index_listing", current_file=place)
    if is_given(query):
        captures = select_with_query(open_index(spark, index_path), query, limit)
        # Rows arrive in the order the query gives them; the id grows with it.
        position = F.monotonically_increasing_id()
    else:
        index = scan_index(spark, index_path, crawl)
        captures = select_captures(index, site, match, url_patterns, limit, ordered=False)
        position = F.col("url")
    report("index_querying", current_file=place)
    pointers = to_pointers(captures).withColumn("position", position)
    with scratch(spark, "import") as folder:
        with _heartbeat(report, "index_querying", place):
            pointers, size = stage_pointers(pointers, folder)
        report("index_batch_scanned", current_file=place, pending=size.matched)
        counters = import_pointers(spark, pointers, size, archive, target, read, report, folder)
    return _finished(spark, target, report), counters


def import_cdx(
    spark: SparkSession,
    path: str | Sequence[str],
    site: str,
    archive: str,
    target: Target = Target(DEFAULT_TABLE),
    *,
    match: str = "domain",
    url_patterns: str | Sequence[str] | None = None,
    limit: int | None = None,
    on_progress: OnProgress | None = None,
    **options,
) -> tuple[DataFrame, ImportCounters]:
    """Import the captures that JSON-lines pages list for a host or domain."""
    read = read_options(**options)
    if match not in ("domain", "host"):
        raise ValueError("match must be 'domain' or 'host'")
    report = Reporter(on_progress)
    _prepare(spark, target, read, report)
    cdx = read_cdx(spark, path)
    captures = select_cdx(cdx, site, match, url_patterns, limit, ordered=False)
    with scratch(spark, "import") as folder:
        pointers, size = stage_pointers(captures, folder)
        counters = import_pointers(spark, pointers, size, archive, target, read, report, folder)
    return _finished(spark, target, report), counters


def import_scope(
    spark: SparkSession,
    index_path: str,
    url: str,
    archive: str,
    target: Target = Target(DEFAULT_TABLE),
    *,
    scope: str = "host",
    crawl: str | None = None,
    limit: int | None = None,
    **options,
) -> tuple[DataFrame, ImportCounters]:
    """Import what lies under ``url``, by default from the newest crawl."""
    site, pattern = scope_patterns(url, scope)
    if crawl is None:
        crawl = latest_crawl(spark, index_path).first()["crawl"]
    return import_domain(
        spark, index_path, crawl, site, archive, target,
        match=scope, url_patterns=pattern, limit=limit, **options,
    )


class Reporter:
    """Sends each event with the counters known so far."""

    def __init__(self, on_progress: OnProgress | None):
        self.on_progress = on_progress
        self.event = ProgressEvent("started")

    def __call__(
        self,
        stage_name: str,
        current_url: str | None = None,
        current_file: str | None = None,
        **counters: int,
    ) -> None:
        self.event = self.event._replace(
            stage=stage_name, current_url=current_url, current_file=current_file, **counters
        )
        if self.on_progress is not None:
            self.on_progress(self.event)


@contextmanager
def _heartbeat(
    report: Reporter, stage_name: str, place: str, tally: Accumulator | None = None
) -> Iterator[None]:
    """Repeat an event every few seconds while Spark is at work; once tasks have ended,
    with what their ``tally`` says."""
    done = threading.Event()

    def beat() -> None:
        while not done.wait(HEARTBEAT_SECONDS):
            counted = dict(zip(Tally.names, tally.value)) if tally is not None else {}
            if any(counted.values()):
                extracted = counted.pop("extracted")
                report("record_extracted", current_file=place, pending=extracted, **counted)
            else:
                report(stage_name, current_file=place)

    thread = threading.Thread(target=beat, daemon=True)
    thread.start()
    try:
        yield
    finally:
        done.set()
        thread.join()


def _prepare(spark, target, read, report):
    """With a known schema even an import without rows leaves a table."""
    if read.schema is not None and read.key in read.schema.names:
        ensure_table(spark, target, read.schema, read.key)
    report("started")


def _finished(spark, target, report):
    report("completed", pending=0)
    if not spark.catalog.tableExists(target.name):
        return spark.createDataFrame([], T.StructType())
    return read_table(spark, target)


class PointerSize(NamedTuple):
    """Number of pointers and of the bytes they point to."""

    matched: int
    length: int


def stage_pointers(
    pointers: DataFrame, folder: str, label: str = "pointers"
) -> tuple[DataFrame, PointerSize]:
    """Write pointers once, and measure them meanwhile."""
    written = Observation()
    seen = pointers.observe(written, F.count("*").alias("matched"), F.sum("length").alias("length"))
    pointers = stage(seen, label, folder)
    return pointers, PointerSize(written.get["matched"], written.get["length"] or 0)


def _read_tasks(spark: SparkSession, size: PointerSize) -> int:
    """Tasks by the bytes to read, so that none gets larger as an import does; all cores
    have work, but no task is without a capture."""
    cores = spark.sparkContext.defaultParallelism
    return max(1, min(size.matched, max(cores, -(-size.length // READ_BYTES))))


def last_rows(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key, of staged rows.

    Only keys and places are shuffled to find rows that a later one supersedes. Where
    there are none the rows go on as they are; few are taken out by a broadcast, many
    by ``dedupe_last``. So texts are rarely shuffled before the merge does it.
    """
    keys = rows.select(named(key).alias("_key"), named(order).alias("_order"))
    last = keys.groupBy("_key").agg(F.max("_order").alias("_last"), F.count("*").alias("_rows"))
    repeated = last.where("_rows > 1").withColumnRenamed("_key", "_again")
    superseded = repeated.agg(F.sum(F.col("_rows") - 1)).first()[0] or 0
    if not superseded:
        return rows
    if superseded > BROADCAST_ROWS:
        return dedupe_last(rows, key, order)
    late = keys.join(repeated, F.col("_key").eqNullSafe(F.col("_again")))
    late = late.where(F.col("_order") != F.col("_last")).select(F.col("_order").alias("_late"))
    if late.count() < superseded:
        # Some rows share the last place of their key.
        return dedupe_last(rows, key, order)
    return rows.join(F.broadcast(late), named(order) == F.col("_late"), "left_anti")


def import_pointers(
    spark: SparkSession,
    pointers: DataFrame,
    size: PointerSize,
    archive: str,
    target: Target,
    read: ReadOptions,
    report: Reporter,
    folder: str,
    source: str | None = None,
    arrivals: Arrivals | None = None,
) -> ImportCounters:
    """Read, extract, deduplicate and upsert staged pointers in one merge.

    Archives are read once, into a staged table in ``folder`` that the counters and
    the upsert then use. Which rows count as imported depends on the batch size; the
    table does not, since the last arrival wins either way. Pointers that are a part of a
    ``source`` leave later rows of it as they are, and are counted by its ``arrivals``;
    without these ``imported`` stays 0.
    """
    matched = size.matched
    report("record_matched", matched=matched, files_read=matched, pending=matched)
    places = pointers.select("url", "filename", "offset", "length", "position")
    tally = None
    if report.on_progress is not None:
        tally = spark.sparkContext.accumulator(Tally().zero(None), Tally())
    captures = read_archive(
        places, archive, read.extractor, None if read.grow else read.schema, read.key,
        read.retries, read.retry_delay,
        read.read_partitions or _read_tasks(spark, size),
        read.concurrency, tally,
    )
    with _heartbeat(report, "record_matched", archive, tally):
        captures = stage(captures, "archive", folder)
    if source is not None and report.on_progress is None and not read.grow:
        # Nobody asks a stream for its counters.
        last_of_keys = last_rows(archive_rows(captures), read.key, "_arrival")
        upsert(spark, target, last_of_keys, read.key, "_arrival", source)
        return ImportCounters(matched, 0, 0, 0, 0, 0)
    totals = read_counters(captures).first().asDict()
    last = totals.pop("last") or (None, None)
    extracted = totals.pop("extracted")
    read_so_far = {name: totals[name] for name in ("files_read", "bytes_read", "requests", "skipped")}
    if totals["skipped"]:
        report("record_skipped", *last, **read_so_far)
    if read.grow:
        found = infer_schema(captures)
        if not found.fields:
            return ImportCounters(imported=0, **totals)
        typed = typed_rows(captures, table_schema(read.schema, found, read.key))
        captures = stage(typed, "typed", folder)
    rows = archive_rows(captures)

    def imported() -> int:
        if arrivals is not None:
            return arrivals.count(rows, read.key, "_arrival", read.batch_size)
        if source is not None:
            return 0
        return imported_count(rows, read.key, "_arrival", read.batch_size).first()["imported"]

    # The count and the merge read the same staged rows and can share the cluster.
    with ThreadPoolExecutor(1) as beside:
        counting = beside.submit(imported)
        report("record_extracted", *last, pending=extracted, **read_so_far)
        updates = last_rows(rows, read.key, "_arrival")
        if source is None:
            upsert(spark, target, updates.drop("_arrival"), read.key)
        else:
            upsert(spark, target, updates, read.key, "_arrival", source)
        merged = counting.result()
    report("batch_merged", *last, imported=merged, pending=0)
    return ImportCounters(imported=merged, **totals)
