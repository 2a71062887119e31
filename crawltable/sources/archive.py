"""Byte-range reads of web archives, fused with extraction in one Arrow stage."""

import pickle
import re
import time
import zlib
from collections import deque
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.accumulators import Accumulator, AccumulatorParam
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from crawltable.functions.shapes import joined, settled, shape_of
from crawltable.sources.index import STORE_REGION, has_credentials

# Raw bytes read before a batch of rows is handed back to Spark.
FLUSH_BYTES = 8 << 20

# Bytes of the reads of a task that are outstanding at a time; a longer one comes alone.
AHEAD_BYTES = 64 << 20
# Ranges that overlap or adjoin share a read of up to this size.
SHARED_BYTES = 8 << 20

READ_COUNTERS = "bytes bigint, requests bigint, skipped bigint, extracted bigint, damaged bigint"
SHAPES = "shapes array<struct<name:string,type:string,place:int>>"


@dataclass(frozen=True)
class ArchiveRecord:
    """Header blocks of one archive record, with lower-case names.

    ``damaged`` tells that the body's compression breaks off; what came before is kept.
    """

    kind: str
    headers: dict[str, str]
    http_headers: dict[str, str] | None = field(default=None)
    damaged: bool = False


Extractor = Callable[[ArchiveRecord, bytes], dict | None]


class Tally(AccumulatorParam):
    """Numbers of pointers read, bytes, requests, skipped and extracted rows, while a stage
    runs: they move whenever a task ends, and count tasks that run again once more."""

    names = ("files_read", "bytes_read", "requests", "skipped", "extracted")

    def zero(self, value):
        return (0,) * len(self.names)

    def addInPlace(self, one, other):
        return tuple(map(sum, zip(one, other)))


def read_archive(
    pointers: DataFrame,
    base: str,
    extractor: Extractor,
    schema: T.StructType | None,
    key: str | None = None,
    retries: int = 3,
    retry_delay: float = 1.0,
    read_partitions: int | None = None,
    concurrency: int = 16,
    tally: Accumulator | None = None,
) -> DataFrame:
    """Read each pointer's bytes and run ``extractor`` on the responses in them.

    Keeps one row per pointer and adds ``bytes``, ``requests``, ``skipped``,
    ``extracted``, ``damaged`` and ``rows``, so that counters are not multiplied by the
    number of responses. Without a schema ``rows`` holds pickled rows and ``shapes`` the columns
    found in them; see ``infer_schema`` and ``typed_rows``.

    Pointers are spread by ranges of file and offset: neighbours are read by the
    same task and an archive that holds most of the captures is split over many.
    Up to ``concurrency`` reads of a task are outstanding, and no more than AHEAD_BYTES.
    Ranges that overlap or adjoin are read at once; ``requests`` are the attempts at the
    read that a pointer's bytes came with, whether or not others share it. ``tally`` (see ``Tally``) tells
    how far they are before all are through.
    """
    place = ["filename", "offset"] + [c for c in pointers.columns if c == "position"]
    # With a number, so that pointers, being small, are not merged into few tasks.
    shuffle_partitions = int(pointers.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = pointers.repartitionByRange(read_partitions or shuffle_partitions, *place)
    out = T.StructType([*pointers.schema.fields, *T.StructType.fromDDL(READ_COUNTERS)])
    out = out.add("rows", T.ArrayType(T.BinaryType() if schema is None else schema))
    if schema is None:
        out = T.StructType([*out, *T.StructType.fromDDL(SHAPES)])
    out_arrow = to_arrow_schema(out)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = ArchiveStore(base, retries, retry_delay)
        with ThreadPoolExecutor(concurrency) as pool:
            for batch in batches:
                yield from _read_batch(batch, store, pool)

    def _read_batch(batch, store, pool):
        results, start, size = [], 0, 0
        for data, requests in _in_order(batch, store, pool, concurrency):
            rows, skipped, damaged = [], 0, 0
            for record, body in responses(data):
                damaged += record.damaged
                row = extractor(record, body)
                if row is None:
                    skipped += 1
                else:
                    rows.append(checked_row(row, schema, key))
            results.append((len(data), requests, skipped, len(rows), damaged, rows))
            size += len(data)
            if size >= FLUSH_BYTES:
                yield _attach(batch, start, results)
                results, start, size = [], start + len(results), 0
        if results:
            yield _attach(batch, start, results)

    def _attach(batch, start, results):
        *counters, rows = zip(*results)
        if tally is not None:
            tally.add((len(results), *(sum(c) for c in counters[:4])))
        added = [*counters, rows]
        if schema is None:
            added = [*counters, [[pickle.dumps(row) for row in r] for r in rows], _shapes(rows)]
        fields = list(out_arrow)
        kept = batch.slice(start, len(results)).columns
        columns = [c.cast(f.type) for c, f in zip(kept, fields)]
        columns += [pa.array(a, f.type) for a, f in zip(added, fields[len(kept) :])]
        return pa.RecordBatch.from_arrays(columns, names=out.names)

    return spread.sortWithinPartitions("filename", "offset").mapInArrow(read, out)


def archive_rows(captures: DataFrame, arrival: str = "_arrival") -> DataFrame:
    """One row per extracted row; ``arrival`` sorts them as the pointers are sorted,
    and within a pointer as they lie in the archive."""
    place = _place(captures)
    members = captures.select(*place, F.posexplode("rows").alias("member", "row"))
    return members.select(F.struct(*place, "member").alias(arrival), "row.*")


def infer_schema(captures: DataFrame) -> T.StructType:
    """Columns of rows read without a schema, in the order they were first seen."""
    seen = captures.select(
        F.struct(*_place(captures)).alias("pointer"), F.explode("shapes").alias("shape")
    )
    columns = (
        seen.groupBy("shape.name")
        .agg(
            F.collect_set("shape.type").alias("types"),
            F.min(F.struct("pointer", "shape.place")).alias("first"),
        )
        .orderBy("first")
        .collect()
    )
    schema = T.StructType()
    for column in columns:
        shapes = map(T._parse_datatype_json_string, column["types"])
        schema = schema.add(column["name"], _joined(column["name"], shapes))
    return schema


def _joined(name: str, shapes) -> T.DataType:
    try:
        return joined(shapes)
    except TypeError as error:
        raise ValueError(f"column {name!r} holds values of several types: {error}") from None


def typed_rows(captures: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows read without a schema, as rows of ``schema``; lacking columns are null."""
    kept = captures.drop("shapes")
    out = T.StructType(
        [f for f in kept.schema.fields if f.name != "rows"]
        + [T.StructField("rows", T.ArrayType(settled(schema)))]
    )
    out_arrow = to_arrow_schema(out)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = batch.column("rows").to_pylist()
            rows = [[pickle.loads(row) for row in pointer] for pointer in packed]
            columns = [
                pa.array(rows, f.type) if f.name == "rows" else batch.column(f.name).cast(f.type)
                for f in out_arrow
            ]
            yield pa.RecordBatch.from_arrays(columns, names=out.names)

    return kept.mapInArrow(unpack, out)


def _shapes(pointers: Sequence[list[dict]]) -> list[list[dict]]:
    """Name, type and place of each column, listed with the first pointer to have it."""
    columns = {}
    for n, rows in enumerate(pointers):
        for row in rows:
            for place, name in enumerate(row):
                columns.setdefault(name, (n, place, []))[2].append(row[name])
    shapes = [[] for _ in pointers]
    for name, (n, place, values) in columns.items():
        kind = _joined(name, map(shape_of, values))
        shapes[n].append({"name": name, "type": kind.json(), "place": place})
    return shapes


def _place(captures: DataFrame) -> list[str]:
    return [c for c in ("position", "filename", "offset") if c in captures.columns]


def checked_row(row: dict, schema: T.StructType | None, key: str | None) -> dict:
    if key is not None and key not in row:
        raise ValueError(f"extracted row without the key column {key!r}")
    unknown = row.keys() - set(schema.names) if schema is not None else ()
    if unknown:
        raise ValueError(f"extracted columns not in the schema: {sorted(unknown)}")
    return row


def _in_order(batch, store, pool, concurrency):
    """Read ahead, giving results in pointer order."""
    ahead, held = deque(), 0
    ranges = zip(*(batch.column(n).to_pylist() for n in ("filename", "offset", "length")))
    for filename, start, end, members in shared_reads(ranges):
        while ahead and (len(ahead) >= concurrency or held + end - start > AHEAD_BYTES):
            held -= yield from _parts(*ahead.popleft())
        ahead.append((pool.submit(store.read, filename, start, end - start), start, members))
        held += end - start
    while ahead:
        yield from _parts(*ahead.popleft())


def _parts(reading, start, members):
    data, requests = reading.result()
    for offset, length in members:
        own = data if length == len(data) else data[offset - start : offset - start + length]
        yield own, requests
    return len(data)


def shared_reads(ranges):
    """Runs of ranges, each with the file and bytes to read for all of them."""
    filename, start, end, members = None, 0, 0, []
    for name, offset, length in ranges:
        after = max(end, offset + length)
        if members and name == filename and start <= offset <= end and after - start <= SHARED_BYTES:
            end = after
        else:
            if members:
                yield filename, start, end, members
            filename, start, end, members = name, offset, offset + length, []
        members.append((offset, length))
    if members:
        yield filename, start, end, members


def open_files(base: str) -> tuple[pafs.FileSystem, str]:
    """File system of a path or URI, and the folder within it."""
    if re.match(r"s3a?://", base):
        files = pafs.S3FileSystem(anonymous=not has_credentials(), region=STORE_REGION)
        folder = base.split("://", 1)[1]
    else:
        files, folder = pafs.FileSystem.from_uri(re.sub(r"^file:/+", "/", base))
    return files, folder.rstrip("/")


class ArchiveStore:
    """Ranges of the files under one base path, read again after I/O errors."""

    def __init__(self, base: str, retries: int, retry_delay: float):
        self.retries = retries
        self.retry_delay = retry_delay
        self.files, self.folder = open_files(base)
        self.current = (None, None)

    def read(self, filename: str, offset: int, length: int) -> tuple[bytes, int]:
        """``(bytes, attempts)``; waits twice as long after each failure.

        Fewer bytes than asked for are a failure too.
        """
        for attempt in range(self.retries + 1):
            try:
                data = self.open(filename).read_at(length, offset)
                if len(data) != length:
                    raise OSError(
                        f"{filename}: {len(data)} of {length} bytes at {offset} could be read"
                    )
                return data, attempt + 1
            except OSError:
                self.current = (None, None)
                if attempt == self.retries:
                    raise
                time.sleep(self.retry_delay * 2**attempt)

    def open(self, filename: str):
        """Neighbouring ranges share one open file."""
        name, file = self.current
        if name != filename:
            file = self.files.open_input_file(f"{self.folder}/{filename}")
            self.current = (filename, file)
        return file


def responses(data: bytes) -> Iterator[tuple[ArchiveRecord, bytes]]:
    """Response records within a range, each with its decoded body.

    A range without any record, or with a part of one, fails.
    """
    for headers, http_headers, body in _responses(data):
        damaged = False
        if http_headers is not None:
            body, damaged = _plain_body(body, http_headers)
        yield ArchiveRecord("response", headers, http_headers, damaged), body


def heads(data: bytes) -> Iterator[tuple[ArchiveRecord, None]]:
    """The same without bodies, whose codings are left as they are."""
    for headers, http_headers, _ in _responses(data):
        yield ArchiveRecord("response", headers, http_headers), None


def _responses(data: bytes) -> Iterator[tuple[dict, dict | None, bytes]]:
    empty = True
    for headers, block in _records(data):
        empty = False
        if headers.get("warc-type") != "response":
            continue
        if headers.get("warc-target-uri", "").startswith(("http:", "https:")):
            head, body = _split_head(block)
            yield headers, _headers(head), body
        else:
            yield headers, None, block
    if empty:
        raise ValueError("range holds no archive record")


def _records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    for text in _members(data):
        while text := text.lstrip(b"\r\n"):
            if not text.startswith(b"WARC/"):
                raise ValueError("range does not start at an archive record")
            head, rest = _split_head(text)
            headers = _headers(head)
            size = int(headers.get("content-length", 0))
            if len(rest) < size:
                raise ValueError(f"archive record has {len(rest)} of its {size} bytes")
            yield headers, rest[:size]
            text = rest[size:]


def _members(data: bytes) -> Iterator[bytes]:
    """Plain bytes, or each gzip member in turn."""
    if not data.startswith(b"\x1f\x8b"):
        yield data
        return
    while data.startswith(b"\x1f\x8b"):
        member = zlib.decompressobj(wbits=31)
        yield member.decompress(data)
        if not member.eof:
            raise ValueError("range ends within a compressed archive record")
        data = member.unused_data


def _split_head(block: bytes) -> tuple[bytes, bytes]:
    end = re.search(rb"\r?\n\r?\n", block)
    return (block[: end.start()], block[end.end() :]) if end else (block, b"")


def _headers(head: bytes) -> dict[str, str]:
    """First value of each name; the version or status line is left out."""
    try:
        text = head.decode()
    except UnicodeDecodeError:
        text = head.decode("latin-1")
    headers = {}
    unfolded = re.sub(r"\r?\n[ \t]+", " ", text)
    for line in unfolded.splitlines()[1:]:
        name, colon, value = line.partition(":")
        if colon:
            headers.setdefault(name.strip().lower(), value.strip())
    return headers


def _plain_body(body: bytes, headers: dict[str, str]) -> tuple[bytes, bool]:
    """The body without transfer and content coding, and whether the latter breaks off.

    Codings other than gzip and deflate are passed through.
    """
    if headers.get("transfer-encoding", "").lower() == "chunked":
        body = _dechunked(body)
    encoding = headers.get("content-encoding", "").lower()
    # Servers label plain bodies as compressed and disagree on what deflate is.
    windows = {"gzip": (31,), "x-gzip": (31,), "deflate": (15, -15)}.get(encoding, ())
    for window in windows:
        parts, rest = [], body
        try:
            while rest and (not parts or window == 31 and rest.startswith(b"\x1f\x8b")):
                stream = zlib.decompressobj(wbits=window)
                parts.append(stream.decompress(rest))
                if not stream.eof:
                    return b"".join(parts), True
                rest = stream.unused_data
            return b"".join(parts), False
        except zlib.error:
            if parts:
                return b"".join(parts), True
    return body, False


def _dechunked(body: bytes) -> bytes:
    chunks, rest = [], body
    while rest:
        line, _, rest = rest.partition(b"\n")
        try:
            size = int(line.split(b";")[0], 16)
        except ValueError:
            return body if not chunks else b"".join(chunks)
        if size == 0:
            break
        chunks.append(rest[:size])
        rest = rest[size:].removeprefix(b"\r").removeprefix(b"\n")
    return b"".join(chunks)
