"""Extraction of rows from archived responses and of text from page columns."""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawltable.functions.bodies import body_text, decoded, utc_date, visible_text
from crawltable.functions.columns import charset_of
from crawltable.sources.archive import ArchiveRecord

DEFAULT_SCHEMA = T.StructType(
    [
        T.StructField("url", T.StringType(), nullable=False),
        T.StructField("date", T.StringType()),
        T.StructField("content_type", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)


def default_extract(record: ArchiveRecord, body: bytes) -> dict:
    kind = (record.http_headers or {}).get("content-type") or record.headers.get(
        "content-type", ""
    )
    return {
        "url": record.headers.get("warc-target-uri", ""),
        "date": utc_date(record.headers.get("warc-date", "")),
        "content_type": kind,
        "text": body_text(body, kind),
    }


_HEADERS = T.MapType(T.StringType(), T.StringType())
RAW_SCHEMA = (
    T.StructType()
    .add("headers", _HEADERS)
    .add("http_headers", _HEADERS)
    .add("body", T.BinaryType())
)


def raw_extract(record: ArchiveRecord, body: bytes) -> dict:
    """The response itself, for callers that go on in Spark SQL."""
    return {
        "headers": list(record.headers.items()),
        "http_headers": record.http_headers and list(record.http_headers.items()),
        "body": body,
    }


def html_text(
    df: DataFrame, body: str, content_type: str, text: str = "text"
) -> DataFrame:
    """Add the text of ``body``, a text or binary column, read as ``content_type``.

    Only markup and bodies that are still bytes go through Python; charsets and media
    types are worked out in the JVM.
    """
    kind = F.coalesce(F.col(content_type), F.lit(""))
    markup = kind.rlike("(?i)html|xml")

    @F.arrow_udf("string")
    def extract(parts: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for batch in parts:
            texts = []
            for page, charset, is_markup in zip(*(column.to_pylist() for column in batch)):
                plain = page if page is None else decoded(page, charset)
                texts.append(visible_text(plain) if is_markup and page is not None else plain)
            yield pa.array(texts, pa.string())

    extracted = extract(F.col(body), charset_of(kind), markup)
    if isinstance(df.schema[body].dataType, T.StringType):
        extracted = F.when(markup, extracted).otherwise(F.col(body))
    return df.withColumn(text, extracted)
