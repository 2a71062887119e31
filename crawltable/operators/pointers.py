"""Capture pointers: the canonical columns every import starts from."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawltable.functions.columns import timestamp14

# The names a pointer column may have, the preferred one first.
POINTER_NAMES = {
    "url": ("url",),
    "timestamp": ("timestamp", "fetch_time"),
    "mime": ("mime", "content_mime_detected"),
    "filename": ("filename", "warc_filename"),
    "offset": ("offset", "warc_record_offset"),
    "length": ("length", "warc_record_length"),
}


def to_pointers(captures: DataFrame) -> DataFrame:
    """``url, timestamp, mime, filename, offset, length`` of a selection.

    A missing required column fails here; an empty or null required value, or a
    text that is no number, fails when the row is computed. Where both names of a
    column exist the first one counts, null or not. ``position`` is kept.
    """
    timestamp = _source(captures, "timestamp")
    mime = _source(captures, "mime")
    columns = [
        _required_text(captures, "url"),
        timestamp14(captures[timestamp], captures.schema[timestamp].dataType)
        if timestamp
        else F.lit(""),
        captures[mime].cast("string") if mime else F.lit(None).cast("string"),
        _required_text(captures, "filename"),
        _required_number(captures, "offset"),
        _required_number(captures, "length"),
    ]
    named = [column.alias(name) for name, column in zip(POINTER_NAMES, columns)]
    return captures.select(*named, *(c for c in captures.columns if c == "position"))


def _source(captures: DataFrame, name: str, required: bool = False) -> str | None:
    found = [n for n in POINTER_NAMES[name] if n in captures.columns]
    if required and not found:
        raise ValueError(f"the selection must return {name!r}")
    return found[0] if found else None


def _required_text(captures: DataFrame, name: str) -> Column:
    source = _source(captures, name, required=True)
    if captures.schema[source].dataType.typeName() not in ("string", "varchar", "char"):
        raise ValueError(f"the selection must return {name!r} as text")
    value = captures[source]
    return F.when(value != "", value).otherwise(_missing(name))


def _required_number(captures: DataFrame, name: str) -> Column:
    value = captures[_source(captures, name, required=True)].try_cast("bigint")
    return F.coalesce(value, _missing(name).cast("bigint"))


def _missing(name: str) -> Column:
    return F.raise_error(F.lit(f"the selection must return {name!r}")).cast("string")


def is_given(query: str | None) -> bool:
    return query is not None and query.strip() != ""


def select_with_query(index: DataFrame, query: str, limit: int | None = None) -> DataFrame:
    """Rows of any Spark SQL over the view ``ccindex``.

    The view has the partition columns; a query that does not filter them reads
    every crawl. A limit implies no order.
    """
    if not is_given(query):
        raise ValueError("query must not be blank")
    index.createOrReplaceTempView("ccindex")
    rows = index.sparkSession.sql(query.strip().rstrip(";"))
    return rows if limit is None else rows.limit(limit)
