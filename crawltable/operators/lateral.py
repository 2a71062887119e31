"""Extractors as table functions of SQL."""

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from crawltable.sources.archive import ArchiveStore, Extractor, checked_row, responses


def register_extractor(
    spark: SparkSession,
    name: str,
    extractor: Extractor,
    schema: T.StructType,
    base: str,
    retries: int = 3,
    retry_delay: float = 1.0,
) -> None:
    """Make ``extractor`` a table function ``name(filename, offset, length)``.

    It reads a range of an archive under ``base`` and gives a row of ``schema`` per
    response that is not skipped, for lateral joins::

        SELECT c.crawl, t.* FROM ccindex c,
          LATERAL name(c.warc_filename, c.warc_record_offset, c.warc_record_length) t

    Ranges are read one by one in the order of the rows; sort these by file and offset
    (``DISTRIBUTE BY``, ``SORT BY``) where there are many. A null argument gives no row.
    """
    spark.udtf.register(name, udtf(_table_function(extractor, schema, base, retries, retry_delay), useArrow=True))


def _table_function(extractor, schema, base, retries, retry_delay):
    class Extracted:
        def __init__(self):
            self.store = ArchiveStore(base, retries, retry_delay)

        @staticmethod
        def analyze(filename: AnalyzeArgument, offset: AnalyzeArgument, length: AnalyzeArgument) -> AnalyzeResult:
            if not isinstance(filename.dataType, (T.StringType, T.NullType)):
                raise ValueError("the first argument must be the name of an archive")
            for argument in (offset, length):
                if not isinstance(argument.dataType, (T.IntegralType, T.NullType)):
                    raise ValueError("offset and length must be whole numbers")
            return AnalyzeResult(schema)

        def eval(self, filename: str, offset: int, length: int):
            if filename is None or offset is None or length is None:
                return
            data, _ = self.store.read(filename, offset, length)
            for record, body in responses(data):
                row = extractor(record, body)
                if row is not None:
                    checked_row(row, schema, None)
                    yield tuple(row.get(f.name) for f in schema)

    return Extracted
