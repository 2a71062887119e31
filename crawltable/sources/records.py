"""Archive records as a data source of Spark: ``spark.read.format("archive_records")``.

The pointers lie in Parquet files under ``pointers``, and the archives under ``archive``.
A row is a response within a range. What is read follows from the schema that is asked
for: without ``body`` and ``text`` no body is put together, unpacked or decoded. Filters on
pointer columns are pushed to the pointer files, so ranges that cannot match are not read.
"""

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
    StringStartsWith,
)
from pyspark.sql.pandas.types import to_arrow_schema

from crawltable.functions.bodies import body_text, utc_date
from crawltable.sources.archive import ArchiveStore, heads, open_files, responses

_HEADERS = T.MapType(T.StringType(), T.StringType())
RECORD_SCHEMA = (
    T.StructType()
    .add("url", T.StringType())
    .add("filename", T.StringType())
    .add("offset", T.LongType())
    .add("length", T.LongType())
    .add("uri", T.StringType())
    .add("date", T.StringType())
    .add("content_type", T.StringType())
    .add("headers", _HEADERS)
    .add("http_headers", _HEADERS)
    .add("body", T.BinaryType())
    .add("text", T.StringType())
)
_POINTER = ("url", "filename", "offset", "length")
# Columns for which a body must be unpacked.
_WHOLE = {"body", "text"}
# Pointers of a task, and bytes of bodies and texts handed over at a time.
TASK_POINTERS = 20_000
FLUSH_BYTES = 8 << 20

_FILTER_CONF = "spark.sql.python.filterPushdown.enabled"


def scan_records(
    spark: SparkSession,
    pointers: str,
    archive: str,
    columns: Sequence[str] = tuple(RECORD_SCHEMA.names),
    **options,
) -> DataFrame:
    """Responses with the ``columns`` that are wanted, of all pointers under a path."""
    spark.dataSource.register(ArchiveRecords)
    spark.conf.set(_FILTER_CONF, True)
    reader = spark.read.format(ArchiveRecords.name()).schema(T.StructType([RECORD_SCHEMA[c] for c in columns]))
    return reader.options(pointers=pointers, archive=archive, **options).load()


class ArchiveRecords(DataSource):
    """Options: ``pointers``, ``archive``, and ``retries`` and ``retry_delay`` of the reads."""

    @classmethod
    def name(cls) -> str:
        return "archive_records"

    def schema(self) -> T.StructType:
        return RECORD_SCHEMA

    def reader(self, schema: T.StructType) -> "RecordReader":
        return RecordReader(schema, self.options)


class Pointers(InputPartition):
    """Some pointers of a row group, from ``first`` on."""

    def __init__(self, file: str, group: int, first: int, rows: int):
        self.file, self.group, self.first, self.rows = file, group, first, rows


class RecordReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options):
        unknown = set(schema.names) - set(RECORD_SCHEMA.names)
        if unknown:
            raise ValueError(f"archive records have no {sorted(unknown)}")
        self.names, self.arrow = schema.names, to_arrow_schema(schema)
        self.pointers, self.archive = options["pointers"], options["archive"]
        self.retries = int(options.get("retries", 3))
        self.retry_delay = float(options.get("retry_delay", 1.0))
        self.wanted: pc.Expression | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Take over what pointers alone decide; the rest is left to Spark."""
        for one in filters:
            condition = _condition(one)
            if condition is None:
                yield one
            else:
                self.wanted = condition if self.wanted is None else self.wanted & condition

    def partitions(self) -> list[Pointers]:
        files, folder = open_files(self.pointers)
        found = files.get_file_info(pafs.FileSelector(folder, recursive=True))
        parts = []
        for info in found:
            if info.type != pafs.FileType.File or not info.path.endswith(".parquet"):
                continue
            # Row groups whose statistics rule the filter out are left alone.
            fragment = ds.ParquetFileFormat().make_fragment(info.path, files)
            for group in fragment.split_by_row_group(filter=self.wanted):
                number, rows = group.row_groups[0].id, group.row_groups[0].num_rows
                parts += [Pointers(info.path, number, n, TASK_POINTERS) for n in range(0, rows, TASK_POINTERS)]
        # Spark needs a partition.
        return parts or [Pointers("", 0, 0, 0)]

    def read(self, partition: Pointers) -> Iterator[pa.RecordBatch]:
        if not partition.rows:
            return
        files, _ = open_files(self.pointers)
        with files.open_input_file(partition.file) as source:
            rows = pq.ParquetFile(source).read_row_group(partition.group, columns=list(_POINTER))
        rows = rows.slice(partition.first, partition.rows)
        if self.wanted is not None:
            rows = rows.filter(self.wanted)
        rows = rows.sort_by([("filename", "ascending"), ("offset", "ascending")])
        store = ArchiveStore(self.archive, self.retries, self.retry_delay)
        unpack = responses if _WHOLE & set(self.names) else heads
        out, size = [], 0
        for pointer in rows.to_pylist():
            data, _ = store.read(pointer["filename"], pointer["offset"], pointer["length"])
            for record, body in unpack(data):
                out.append(self._row(pointer, record, body))
                size += len(body or b"")
                if size >= FLUSH_BYTES:
                    yield self._batch(out)
                    out, size = [], 0
        if out:
            yield self._batch(out)

    def _row(self, pointer: dict, record, body: bytes | None) -> dict:
        kind = (record.http_headers or {}).get("content-type") or record.headers.get("content-type", "")
        made = {
            "uri": lambda: record.headers.get("warc-target-uri", ""),
            "date": lambda: utc_date(record.headers.get("warc-date", "")),
            "content_type": lambda: kind,
            "headers": lambda: list(record.headers.items()),
            "http_headers": lambda: record.http_headers and list(record.http_headers.items()),
            "body": lambda: body,
            "text": lambda: body_text(body, kind),
        }
        return {n: pointer[n] if n in _POINTER else made[n]() for n in self.names}

    def _batch(self, rows: list[dict]) -> pa.RecordBatch:
        columns = [pa.array([r[f.name] for r in rows], f.type) for f in self.arrow]
        return pa.RecordBatch.from_arrays(columns, schema=self.arrow)


def _condition(one: Filter) -> pc.Expression | None:
    if len(getattr(one, "attribute", ())) != 1 or one.attribute[0] not in _POINTER:
        return None
    field = pc.field(one.attribute[0])
    if isinstance(one, EqualTo):
        return field == one.value
    if isinstance(one, In):
        return field.isin(list(one.value))
    if isinstance(one, GreaterThan):
        return field > one.value
    if isinstance(one, GreaterThanOrEqual):
        return field >= one.value
    if isinstance(one, LessThan):
        return field < one.value
    if isinstance(one, LessThanOrEqual):
        return field <= one.value
    if isinstance(one, IsNotNull):
        return field.is_valid()
    if isinstance(one, StringStartsWith):
        return pc.starts_with(field, pattern=one.value)
    return None
