"""Incremental imports: each micro-batch of new files is one merge.

The micro-batches of a stream by rows are many and small, and a merge rewrites the buckets
it touches. So these leave their captures to an import of several (see ``Waiting``, and
``Pending`` where lines come by way of the caller).
"""

import json
import threading
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import Future
from contextlib import suppress
from typing import NamedTuple

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from crawltable.operators.counters import Arrivals
from crawltable.operators.dedupe import dedupe_last
from crawltable.operators.pointers import to_pointers
from crawltable.operators.upsert import Target, ensure_table, upsert
from crawltable.plans.imports import (
    BATCH_SIZE,
    OnProgress,
    PointerSize,
    ProgressEvent,
    Reporter,
    import_pointers,
    read_options,
    stage_pointers,
)
from crawltable.sources.cdx import parse_lines, select_cdx, stream_cdx
from crawltable.sources.lines import LINE_COLUMNS, START, batch_ends, lines_between, place
from crawltable.workspace import fresh_path, remove, scratch, stage

_EVENT_SCHEMA = (
    "stage string, matched bigint, imported bigint, skipped bigint, files_read bigint, "
    "pending bigint, current_url string, current_file string, bytes_read bigint, requests bigint"
)


def stream_upsert(
    rows: DataFrame,
    target: Target,
    key: str,
    order: str,
    *,
    checkpoint: str | None = None,
    on_progress: OnProgress | None = None,
    progress_path: str | None = None,
) -> StreamingQuery:
    """Merge a stream of keyed rows into ``target`` until no file is left.

    The last row of a key in ``order`` wins, whatever micro-batch it comes with. A row
    that is already in the table, or was put there by another stream, is replaced.
    A batch that is run again after a failure leaves the same table. Without a
    ``checkpoint`` of its own each run starts with the first file, as another stream.
    """

    def merge(batch: DataFrame, part: _Part) -> None:
        report = part.report
        received = Observation()
        with scratch(batch.sparkSession, "batch") as folder:
            seen = batch.observe(received, F.count("*").alias("rows"))
            # Counted while it is read; only the last row of each key is kept.
            last = stage(dedupe_last(seen, key, order), "last", folder)
            matched, imported = received.get["rows"], last.count()
            if not matched:
                return
            report("record_matched", matched=matched, files_read=matched, pending=matched)
            report("record_extracted", pending=imported)
            upsert(batch.sparkSession, target, last, key, order, part.source)
        report("batch_merged", imported=imported, pending=0)

    ensure_table(rows.sparkSession, target, rows.schema, key)
    return _start(rows, merge, checkpoint, on_progress, progress_path)


def import_stream(
    captures: DataFrame,
    archive: str,
    target: Target,
    *,
    select: Callable[[DataFrame], DataFrame] = to_pointers,
    checkpoint: str | None = None,
    on_progress: OnProgress | None = None,
    progress_path: str | None = None,
    **options,
) -> StreamingQuery:
    """Import a stream of captures: index files, or CDX lines from ``stream_cdx``.

    ``select`` turns a micro-batch into pointers, filtering as it likes. Of the captures
    of a key the last one by ``position`` is kept (without one: by URL and time), in
    whatever order Spark takes up the files, as if all were imported at once. Rows count
    as imported (see ``imported_count``) over the whole stream, if progress is asked for.
    The stream ends when it has no more to give.

    A stream by rows whose progress nobody follows imports the captures of several
    micro-batches at once. All are in the table when it ends. If it fails, those of the
    batches before the failing one are too; what is left when it is stopped or killed comes
    first when a stream with the same ``checkpoint`` goes on.
    """
    return _import(captures, archive, target, select, checkpoint, on_progress, progress_path, options)


def _import(
    captures: DataFrame,
    archive: str,
    target: Target,
    select: Callable[[DataFrame], DataFrame],
    checkpoint: str | None,
    on_progress: OnProgress | None,
    progress_path: str | None,
    options: dict,
    pages: tuple[str, int] | None = None,
) -> StreamingQuery:
    """``pages`` are the path and the rows a batch of captures that are lines just as
    ``stream_cdx`` gives them, so that they can be read again."""
    read = read_options(**options)
    counted = on_progress is not None or progress_path is not None
    collected = not counted and _by_rows(captures)
    waiting = Waiting(None if counted else pages)
    running: set[str] = set()

    def pointers_of(lines: DataFrame) -> DataFrame:
        pointers = select(lines)
        if "position" not in pointers.columns:
            pointers = pointers.withColumn("position", F.struct("url", "timestamp"))
        return pointers

    def merge(batch: DataFrame, part: _Part) -> None:
        spark = batch.sparkSession

        def take(pointers: DataFrame, size: PointerSize, folder: str) -> None:
            import_pointers(
                spark, pointers, size, archive, target, read, part.report, folder,
                part.source, Arrivals(f"{part.folder}/arrivals", part.number) if counted else None,
            )

        def bring(lines: DataFrame) -> None:
            with scratch(spark, "import") as folder:
                pointers, size = stage_pointers(pointers_of(lines), folder)
                if size.matched:
                    take(pointers, size, folder)

        pending = Pending(spark, part, take)
        if not running:
            # What another run has left.
            pending.merge()
            waiting.begin(spark, part, bring)
            running.add(part.source)
        if waiting.pages is not None:
            waiting.add(part, bring)
            return
        if not collected:
            bring(batch)
            return
        try:
            matched = pending.add(pointers_of(batch))
        except Exception:
            with suppress(Exception):
                pending.merge()
            raise
        if not matched and batch.isEmpty():
            pending.merge()

    if read.schema is not None and read.key in read.schema.names:
        ensure_table(captures.sparkSession, target, read.schema, read.key)
    return _start(captures, merge, checkpoint, on_progress, progress_path)


def import_cdx_stream(
    spark: SparkSession,
    path: str,
    site: str,
    archive: str,
    target: Target,
    *,
    match: str = "domain",
    url_patterns: str | Sequence[str] | None = None,
    batch_size: int = BATCH_SIZE,
    checkpoint: str | None = None,
    on_progress: OnProgress | None = None,
    progress_path: str | None = None,
    **options,
) -> StreamingQuery:
    """Import the captures that JSON-lines pages list for a host or domain, ``batch_size``
    lines at a time; a stream with the same ``checkpoint`` goes on at the next line.

    The captures of several micro-batches are imported at once, as ``import_stream`` does.
    Their lines are read then, so pages must stay as they are until the stream has ended."""

    def select(lines: DataFrame) -> DataFrame:
        return select_cdx(parse_lines(lines), site, match, url_patterns, ordered=False)

    lines = stream_cdx(spark, path, max_rows=batch_size)
    options["batch_size"] = batch_size
    return _import(
        lines, archive, target, select, checkpoint, on_progress, progress_path, options, (path, batch_size)
    )


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """Events written by a stream, with the number of their micro-batch."""
    return spark.read.schema(f"{_EVENT_SCHEMA}, batch bigint").parquet(path)


class _Part(NamedTuple):
    """One micro-batch: its number, its stream, the stream's own folder and its events."""

    number: int
    source: str
    folder: str
    report: Reporter


class Pending:
    """Pointers of micro-batches whose rows are not in the table yet.

    They lie in the stream's own folder, by batch, until the next merge. That follows when
    these batches are more than half of the stream's, so the table is rewritten for each
    doubling of the stream and not for each batch, and the stream's last batch, which is
    empty, brings in the rest. A merge that breaks off is repeated and gives the same table.
    """

    def __init__(self, spark: SparkSession, part: _Part, take: Callable[[DataFrame, PointerSize, str], object]):
        self.spark, self.number, self.take = spark, part.number, take
        self.folder = f"{part.folder}/pending"

    def add(self, pointers: DataFrame) -> int:
        """Keep the pointers of this batch, and give their number."""
        place = f"{self.folder}/batch={self.number}"
        remove(self.spark, place)
        _, size = stage_pointers(pointers, self.folder, f"batch={self.number}")
        if not size.matched:
            remove(self.spark, place)
        elif 2 * len(self._batches(self.number + 1)) > self.number + 1:
            self.merge(self.number + 1)
        return size.matched

    def merge(self, before: int | None = None) -> None:
        """Import what the batches before this one, or that number, have left."""
        batches = self._batches(self.number if before is None else before)
        if not batches:
            return
        try:
            self._import(batches)
        except Exception:
            # The batches before the one that fails are whole.
            for batch in batches:
                self._import([batch])

    def _import(self, batches: list[str]) -> None:
        pointers = self.spark.read.parquet(*batches)
        size = PointerSize(*pointers.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first())
        with scratch(self.spark, "import") as folder:
            self.take(pointers, size, folder)
        for batch in batches:
            remove(self.spark, batch)

    def _batches(self, before: int) -> list[str]:
        """Folders of the complete batches below that number, in their order."""
        return [folder for number, folder in _complete(self.spark, self.folder, "batch") if number < before]


class Waiting:
    """Lines of micro-batches whose rows are not in the table yet, as a range of the pages.

    A micro-batch that waits runs no job and writes nothing, however many wait with it.
    Merges follow as with ``Pending``; a merge reads the lines that wait at once. They end
    where the checkpoint says that the micro-batch does, and begin where the last merge
    ended, which the stream's own folder keeps under the number of the next batch.
    """

    def __init__(self, pages: tuple[str, int] | None):
        self.pages = pages
        self.next, self.start = 0, START

    def begin(self, spark: SparkSession, part: _Part, bring: Callable[[DataFrame], None]) -> None:
        """Import what another run has left, before the first batch of this one."""
        self.spark, self.folder, self.bring = spark, f"{part.folder}/waiting", bring
        own, kept = self.pages, _complete(spark, self.folder, "next")
        if own is None and not kept:
            return
        now = _offset(spark, part.folder, part.number - 1) if part.number else START
        self.next, self.start = part.number, now
        if kept:
            left = json.loads(spark.read.text(kept[-1][1]).first()["value"])
            self.next, self.start, self.pages = kept[-1][0], left["start"], tuple(left["pages"])
            self._merge(part.number, now)
            self.pages = own
        if own is None:
            # From now on every batch brings in its own rows.
            remove(spark, self.folder)

    def add(self, part: _Part, bring: Callable[[DataFrame], None]) -> None:
        """Let the lines of this batch wait, or import them with those that do."""
        self.bring, number = bring, part.number + 1
        end = _offset(self.spark, part.folder, part.number)
        if "end" in end or 2 * (number - self.next) > number:
            self._merge(number, end)

    def _merge(self, number: int, end: dict, ends: list[tuple[int, dict]] | None = None) -> None:
        """Import the lines up to ``end``, where the batch of that number begins."""
        if place(self.start) >= place(end):
            return
        try:
            self.bring(lines_between(self.spark, self.pages[0], self.start, end))
        except Exception:
            if ends is None:
                found = batch_ends(*self.pages, self.start, end)
                ends = [(min(self.next + n, number), found_end) for n, found_end in enumerate(found, 1)]
            if not ends:
                raise
            # The batches before the one that fails are whole.
            middle = len(ends) // 2
            self._merge(*ends[middle], ends[:middle])
            self._merge(number, end, ends[middle + 1 :])
            return
        self.next, self.start = number, end
        kept = json.dumps({"start": end, "pages": self.pages})
        kept = self.spark.createDataFrame([(kept,)], "value string").coalesce(1)
        kept.write.mode("overwrite").text(f"{self.folder}/next={number}")


def _complete(spark: SparkSession, folder: str, label: str) -> list[tuple[int, str]]:
    """Numbers of the complete folders that are named by the label and one, in their order."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{label}=*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    folders = (status.getPath().getParent() for status in found)
    return sorted((int(f.getName().removeprefix(f"{label}=")), f.toString()) for f in folders)


def _offset(spark: SparkSession, checkpoint: str, number: int) -> dict:
    """Where a micro-batch of a stream by rows ends; its checkpoint is written before it runs."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/offsets/{number}")
    file = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(file, "UTF-8")
    finally:
        file.close()
    return json.loads(text.splitlines()[-1])


def _by_rows(rows: DataFrame) -> bool:
    return set(rows.columns) >= set(LINE_COLUMNS)


def _start(rows, merge, checkpoint, on_progress, progress_path) -> StreamingQuery:
    spark = rows.sparkSession
    totals = _Totals(on_progress)
    folder = (checkpoint or fresh_path(spark, "stream")).rstrip("/")
    # The stream's id, which its checkpoint keeps, is known once it has been started.
    started: Future[str] = Future()

    def run(batch: DataFrame, batch_id: int) -> None:
        events: list[ProgressEvent] = []

        def note(event: ProgressEvent) -> None:
            events.append(event)
            totals.report(event)

        wanted = note if on_progress is not None or progress_path is not None else None
        merge(batch, _Part(batch_id, started.result(), folder, Reporter(wanted)))
        if events:
            totals.add(events[-1])
        if events and progress_path is not None:
            # A batch that runs again replaces its own events.
            rows = batch.sparkSession.createDataFrame(events, _EVENT_SCHEMA)
            rows.coalesce(1).write.mode("overwrite").parquet(f"{progress_path}/batch={batch_id}")

    name = f"import-{uuid.uuid4().hex}"
    if on_progress is not None:
        spark.streams.addListener(_Lifetime(spark, name, totals))
    writer = rows.writeStream.queryName(name).foreachBatch(run).option("checkpointLocation", folder)
    # Python sources give one batch only if asked for what is there now.
    endless = _by_rows(rows)
    trigger = {"processingTime": "0 seconds"} if endless else {"availableNow": True}
    try:
        query = writer.trigger(**trigger).start()
    except BaseException as error:
        started.set_exception(error)
        raise
    started.set_result(query.id)
    if endless:
        threading.Thread(target=_drain, args=(query,), daemon=True).start()
    return query


def _drain(query: StreamingQuery) -> None:
    """Stop a stream when nothing is left; if it fails, it tells so itself."""
    try:
        query.processAllAvailable()
        query.stop()
    except StreamingQueryException:
        pass


class _Totals:
    """Counters of the batches so far, added to those of the current one."""

    def __init__(self, on_progress: OnProgress | None):
        self.on_progress = on_progress
        self.done = ProgressEvent("started")

    def report(self, event: ProgressEvent) -> None:
        if self.on_progress is not None:
            self.on_progress(self._sum(event))

    def add(self, event: ProgressEvent) -> None:
        self.done = self._sum(event)

    def _sum(self, event: ProgressEvent) -> ProgressEvent:
        counters = ("matched", "imported", "skipped", "files_read", "bytes_read", "requests")
        return event._replace(
            **{c: getattr(self.done, c) + getattr(event, c) for c in counters}
        )


class _Lifetime(StreamingQueryListener):
    """First and last event of one query."""

    def __init__(self, spark: SparkSession, name: str, totals: _Totals):
        self.spark = spark
        self.name = name
        self.totals = totals
        self.run = None

    def onQueryStarted(self, event):
        if event.name == self.name:
            self.run = event.runId
            self.totals.report(ProgressEvent("started"))

    def onQueryProgress(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if event.runId != self.run:
            return
        if event.exception is None:
            self.totals.report(ProgressEvent("completed"))
        self.spark.streams.removeListener(self)
