"""Packing by power-of-two decomposition.

A document of n tokens is cut into n // longest pieces of the longest length and one
piece for each bit of the rest, longest first. Every piece is a sequence of its own:
lengths are powers of two, so nothing is padded and no sequence crosses documents.
Sequences are stored by length, so that a batch takes equal lengths from one folder.

Null texts are empty documents, of the end id alone. Repeated rows and null ids are
packed like others. Other columns are not read. The work of a row does not depend on
other rows: only the numbering of sequences, from one count per task and length, does.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crawltable.llm.arrow import slices
from crawltable.llm.tokens import END_ID, tokenizer, vocabulary_path
from crawltable.workspace import fresh_path, stage

LONGEST = 2048
# Rows of 20 bytes, one per task and length, up to which they are broadcast to number the
# sequences; more of them are joined by a shuffle.
BROADCAST_ROWS = 500_000

PIECES = """doc_id bigint, start bigint, doc_tokens bigint, ids binary,
  length bigint, part int, place bigint"""


def piece_lengths(n: int, longest: int = LONGEST) -> list[int]:
    rest = n % longest
    bits = [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]
    return [longest] * (n // longest) + bits


def pack(
    df: DataFrame,
    folder: str | None = None,
    longest: int = LONGEST,
    id: str = "doc_id",
    text: str = "text",
    vocabulary: str | None = None,
) -> DataFrame:
    """Sequences of all texts: one row per piece, with its ``ids`` (little-endian
    unsigned 32-bit integers), stored under ``folder`` by ``length``.

    ``sequence_id`` numbers the sequences without gaps, those of the longest length
    first, and ``offset`` is the place of the piece in its sequence, always 0.
    """
    if longest < 1 or longest & longest - 1:
        raise ValueError("the longest length must be a power of two")
    spark = df.sparkSession
    path = vocabulary or vocabulary_path()
    folder = folder or fresh_path(spark, "packed")
    rows = df.select(
        F.col(f"`{id}`").cast("bigint"), F.col(f"`{text}`"), F.spark_partition_id().alias("part")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokenizer(path)
        placed = dict.fromkeys(piece_lengths(2 * longest - 1, longest), 0)
        for batch in batches:
            for begin, length in slices(batch.column(1)):
                some = batch.slice(begin, length)
                encoded = words.encode(some.column(1).to_pylist())
                part = some.column(2)[0].as_py()
                out = [[] for _ in range(6)]
                for doc, ids in zip(some.column(0).to_pylist(), encoded):
                    data = np.append(ids, np.uint32(END_ID)).astype("<u4").tobytes()
                    start = 0
                    for size in piece_lengths(len(ids) + 1, longest):
                        values = (doc, start, len(ids) + 1, data[4 * start : 4 * (start + size)], size, placed[size])
                        for column, value in zip(out, values):
                            column.append(value)
                        placed[size] += 1
                        start += size
                out.insert(5, [part] * len(out[0]))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(out, kinds)],
                    names=["doc_id", "start", "doc_tokens", "ids", "length", "part", "place"],
                )

    pieces = rows.mapInArrow(cut, PIECES)
    pieces.write.option("compression", "zstd").partitionBy("length").parquet(folder)
    return read_packed(spark, folder)


def read_packed(spark, folder: str) -> DataFrame:
    """The stored sequences with their numbers."""
    schema = "doc_id bigint, start bigint, doc_tokens bigint, ids binary, part int, place bigint, length bigint"
    pieces = spark.read.schema(schema).parquet(folder)
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    longer = Window.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    lengths = counts.groupBy("length").agg(F.sum("n").alias("n")).select(
        "length", F.coalesce(F.sum("n").over(longer), F.lit(0)).alias("base")
    )
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    # A handful of lengths; one row per task and length.
    starts = starts.join(F.broadcast(lengths), "length").select(
        "length", "part", (F.col("base") + F.col("before")).alias("first")
    )
    starts = stage(starts, "starts")
    if starts.count() <= BROADCAST_ROWS:
        starts = F.broadcast(starts)
    return pieces.join(starts, ["length", "part"]).select(
        "doc_id", "start", "length", "doc_tokens", "ids",
        (F.col("first") + F.col("place")).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
    )
