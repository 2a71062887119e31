"""Capture lists as a stream of lines, so many per micro-batch.

Pages are taken up by their time of writing and then by name. An offset is a page and a
line within it, so a batch may begin and end anywhere, and a stream that is started again
goes on with the next line. To know where a batch ends, the driver counts the line ends of
each page once, a buffer at a time; the lines themselves are read by the executors.

When nothing is left, one more batch follows, without lines, so that what the batches before
it left to do can be done in a batch: if that fails, it is run again like any other.

``lines_between`` reads the lines between two offsets at once, whatever batches they came in.
"""

import bz2
import gzip
import io
import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from crawltable.sources.archive import open_files

LINE_COLUMNS = ("line", "file", "name", "block", "number")
LINE_SCHEMA = "line string, file string, name string, block bigint, number bigint"
BATCH_LINES = 10_000

START = {"time": 0, "file": "", "line": 0, "byte": 0}
_UNPACK = {".gz": gzip.open, ".bz2": bz2.open}
_PACKED = (*_UNPACK, ".zst", ".zstd", ".lz4")


class CaptureLines(DataSource):
    """Options: ``path``, the folder of the pages, and ``max_rows``, the lines that are not
    blank of a micro-batch; in a batch the offsets ``start`` and ``end`` as JSON."""

    @classmethod
    def name(cls) -> str:
        return "capture_lines"

    def schema(self) -> str:
        return LINE_SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return PageReader(self.options["path"], int(self.options["max_rows"]))

    def reader(self, schema) -> DataSourceReader:
        start, end = (json.loads(self.options[name]) for name in ("start", "end"))
        return RangeReader(self.options["path"], start, end)


class Lines(InputPartition):
    """Lines of a page from ``first``, which begins at ``byte``, up to ``last``."""

    def __init__(self, file: str, first: int, byte: int, last: int | None):
        self.file, self.first, self.byte, self.last = file, first, byte, last


class PageReader(DataSourceStreamReader):
    def __init__(self, path: str, max_rows: int):
        if max_rows <= 0:
            raise ValueError("max_rows must be greater than zero")
        self.path, self.max_rows = path, max_rows
        self.current: dict | None = None
        # The page that was counted last, open where the count ended.
        self.place, self.lines = None, None

    def initialOffset(self) -> dict:
        return START

    def latestOffset(self) -> dict:
        if self.current is None:
            self.current = self.initialOffset()
        after = self._after(self.current)
        if after == self._place(self.current):
            # A second time the offset stays as it is, and no batch follows.
            after = {**after, "end": True} if after != START else after
        self.current = after
        return self.current

    def partitions(self, start: dict, end: dict) -> list[Lines]:
        # A stream that goes on asks for its last batch first.
        if self.current is None:
            self.current = end
        return _parts(self.path, start, end)

    def read(self, partition: Lines) -> Iterator[pa.RecordBatch]:
        return _read(self.path, partition)

    @staticmethod
    def _place(offset: dict) -> dict:
        return {name: offset[name] for name in START}

    def _after(self, offset: dict) -> dict:
        """The offset ``max_rows`` rows later, or that of the last line there is."""
        offset, wanted = self._place(offset), self.max_rows
        for time, file in _pages(self.path):
            if (time, file) < _key(offset):
                continue
            if (time, file) != _key(offset):
                offset = {"time": time, "file": file, "line": 0, "byte": 0}
            if self.place != offset or self.lines is None:
                if self.lines is not None:
                    self.lines.close()
                self.lines = _open(self.path, file, offset["line"], offset["byte"])
            line, byte = offset["line"], offset["byte"]
            while wanted and (text := self.lines.readline()):
                line += 1
                byte += len(text)
                wanted -= bool(text.strip())
            offset = {"time": time, "file": file, "line": line, "byte": byte}
            self.place = offset
            if not wanted:
                break
            self.place = None
        return offset


class RangeReader(DataSourceReader):
    def __init__(self, path: str, start: dict, end: dict):
        self.path, self.start, self.end = path, start, end

    def partitions(self) -> list[Lines]:
        return _parts(self.path, self.start, self.end)

    def read(self, partition: Lines | None) -> Iterator[pa.RecordBatch]:
        # Without any partition Spark asks for the rows of none.
        return _read(self.path, partition) if partition is not None else iter(())


def lines_between(spark: SparkSession, path: str, start: dict, end: dict) -> DataFrame:
    """The lines that a stream gives between two offsets."""
    spark.dataSource.register(CaptureLines)
    offsets = {"start": json.dumps(start), "end": json.dumps(end)}
    return spark.read.format(CaptureLines.name()).options(path=path, **offsets).load()


def batch_ends(path: str, max_rows: int, start: dict, end: dict) -> list[dict]:
    """Offsets between these two, ``max_rows`` rows from one to the next."""
    reader, found, offset = PageReader(path, max_rows), [], start
    while place(offset) < place(after := reader._after(offset)) < place(end):
        found.append(after)
        offset = after
    return found


def place(offset: dict) -> tuple[int, str, int]:
    """Sorts offsets as their lines come."""
    return *_key(offset), offset["line"]


def _pages(path: str) -> list[tuple[int, str]]:
    files, folder = open_files(path)
    found = files.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
    pages = [i for i in found if i.type == pafs.FileType.File and not i.base_name.startswith((".", "_"))]
    return sorted((i.mtime_ns or 0, i.path) for i in pages)


def _parts(path: str, start: dict, end: dict) -> list[Lines]:
    found = []
    for time, file in _pages(path):
        if not _key(start) <= (time, file) <= _key(end):
            continue
        at_start, at_end = file == start["file"], file == end["file"]
        first, byte = (start["line"], start["byte"]) if at_start else (0, 0)
        last = end["line"] if at_end else None
        if last is None or first < last:
            found.append(Lines(file, first, byte, last))
    return found


def _read(path: str, part: Lines) -> Iterator[pa.RecordBatch]:
    name = part.file.rsplit("/", 1)[-1]
    number, rows = part.first, []
    with _open(path, part.file, part.first, part.byte) as page:
        while part.last is None or number < part.last:
            line = page.readline()
            if not line:
                break
            rows.append((line.decode("utf-8", "replace").strip(), number))
            number += 1
            if len(rows) == BATCH_LINES:
                yield _batch(rows, part.file, name)
                rows = []
    if rows:
        yield _batch(rows, part.file, name)


def _key(offset: dict) -> tuple[int, str]:
    return offset["time"], offset["file"]


def _open(base: str, file: str, line: int, byte: int) -> io.BufferedIOBase:
    """A page from a line on; packed ones are unpacked from their beginning."""
    files, _ = open_files(base)
    packed = next((end for end in _PACKED if file.lower().endswith(end)), None)
    if packed is None:
        stream = files.open_input_file(file)
        stream.seek(byte)
        return io.BufferedReader(stream)
    if packed in _UNPACK:
        page = _UNPACK[packed](files.open_input_file(file))
    else:
        page = io.BufferedReader(files.open_input_stream(file, compression="detect"))
    for _ in range(line):
        page.readline()
    return page


def _batch(rows: list[tuple[str, int]], file: str, name: str) -> pa.RecordBatch:
    lines, numbers = zip(*rows)
    n = len(rows)
    columns = [pa.array(lines), pa.array([file] * n), pa.array([name] * n), pa.array([0] * n), pa.array(numbers)]
    return pa.RecordBatch.from_arrays(columns, names=list(LINE_COLUMNS))
