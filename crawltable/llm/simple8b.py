"""Token ids in word-aligned Simple-8b files.

A 64-bit word holds a selector in its upper four bits and, by it, 1 to 240 values of
equal width in the other 60. Values of 2**60 and more take an escape word, followed by
the value in a word of its own. Every block of 128 values starts a new word and the
offsets of the blocks are stored, so all blocks are encoded and decoded side by side,
one numpy step per word of the longest block.

A file holds whole documents (layout in ``write_file``); a task writes as many as its
rows need, each about FILE_VALUES values long, so files and memory stay bounded however
large the table is. Only files that the returned rows name count: what a lost or
repeated task left behind is never read.

Null texts are empty documents; repeated ids are kept, in the order of a hash of the text; null ids
come first. Other columns are not read. An empty table gives no file.
"""

import io
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crawltable.llm.arrow import slices
from crawltable.llm.chars import sizes_to_offsets
from crawltable.llm.tokens import END_ID, tokenizer, vocabulary_path
from crawltable.sources.archive import open_files
from crawltable.workspace import fresh_path, stage

BLOCK = 128
FILE_VALUES = 4_000_000
MAGIC = b"S8B1"

# Fixed values of Simple-8b: how many values a word holds under each selector, and of
# how many bits. Selector 15 holds one value of 60 bits; 0 and 1 hold zeros only.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
# One value of 60 bits and more is an escape: a zero-run selector of a block is never
# full, as a block has 128 values, so selector 0 is free to mark it.
ESCAPE = 0
SELECTORS = range(1, 16)
PAYLOAD = np.uint64((1 << 60) - 1)


def encode_blocks(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of ``values`` and the offset of each block's first word (one more at the end)."""
    values = values.astype(np.uint64)
    n = len(values)
    n_blocks = -(-n // BLOCK)
    ends = np.minimum((np.arange(n_blocks) + 1) * BLOCK, n)
    # Bit widths of the values, each block followed by zeros that fit any word.
    stride = BLOCK + int(COUNTS[1])
    widths = np.zeros((n_blocks, stride), np.uint8)
    flat = np.zeros(n_blocks * BLOCK, np.uint8)
    flat[:n] = bit_widths(values)
    widths[:, :BLOCK] = flat.reshape(n_blocks, BLOCK)
    widths = widths.ravel()
    at = np.arange(n_blocks, dtype=np.int64) * BLOCK
    active = np.arange(n_blocks)
    words, owners, steps, step = [], [], [], 0
    while len(active):
        here, limit = at[active], ends[active]
        chosen = _selectors(widths, active * stride + here - active * BLOCK)
        taken = np.minimum(COUNTS[chosen], limit - here)
        packed = chosen.astype(np.uint64) << np.uint64(60)
        for s in SELECTORS:
            rows = np.flatnonzero(chosen == s)
            if not len(rows) or BITS[s] == 0:
                continue
            for k in range(int(COUNTS[s])):
                some = rows[taken[rows] > k]
                if not len(some):
                    break
                packed[some] |= values[here[some] + k] << np.uint64(k * BITS[s])
        escaped = np.flatnonzero(chosen == ESCAPE)
        taken[escaped] = 1
        words += [packed, values[here[escaped]]]
        owners += [active, active[escaped]]
        steps += [np.full(len(active), 2 * step), np.full(len(escaped), 2 * step + 1)]
        at[active] = here + taken
        active = active[at[active] < ends[active]]
        step += 1
    if not words:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    words, owners, steps = map(np.concatenate, (words, owners, steps))
    order = np.lexsort((steps, owners))
    return words[order], sizes_to_offsets(np.bincount(owners, minlength=n_blocks))


def bit_widths(values: np.ndarray) -> np.ndarray:
    """The least width of any selector that holds each value; 64 where none does."""
    limits = np.array(sorted({0, *BITS.tolist()}))
    if len(values) > 1 << 16 and values.max() < 1 << 16:
        return bit_widths(np.arange(1 << 16, dtype=np.uint64))[values]
    widths = np.zeros(len(values), np.uint8)
    for limit, wider in zip(limits, [*limits[1:], 64]):
        widths[values >> np.uint64(limit) != 0] = wider
    return widths


def _selectors(widths: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The first selector whose count of values from each place on fits its width."""
    few = np.maximum.accumulate(widths[places[:, None] + np.arange(8)], axis=1)
    chosen = np.full(len(places), ESCAPE)
    for s in reversed(range(8, 16)):
        chosen[few[:, COUNTS[s] - 1] <= BITS[s]] = s
    small = np.flatnonzero(few[:, 7] <= BITS[7])
    if len(small):
        many = np.maximum.accumulate(widths[places[small, None] + np.arange(COUNTS[1])], axis=1)
        for s in reversed(range(1, 8)):
            chosen[small[many[:, COUNTS[s] - 1] <= BITS[s]]] = s
    return chosen


def decode_blocks(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values of all blocks."""
    values = np.zeros(n, np.uint64)
    n_blocks = len(offsets) - 1
    read, write = offsets[:-1].copy(), np.arange(n_blocks, dtype=np.int64) * BLOCK
    ends = np.minimum(write + BLOCK, n)
    active = np.arange(n_blocks)
    while len(active):
        word = words[read[active]]
        selector = (word >> np.uint64(60)).astype(np.int64)
        payload = word & PAYLOAD
        taken = np.minimum(COUNTS[selector], ends[active] - write[active])
        escaped = np.flatnonzero(selector == ESCAPE)
        taken[escaped] = 1
        values[write[active[escaped]]] = words[read[active[escaped]] + 1]
        for s in np.unique(selector[selector != ESCAPE]):
            if BITS[s] == 0:
                continue
            rows = np.flatnonzero(selector == s)
            mask = np.uint64((1 << int(BITS[s])) - 1)
            for k in range(int(taken[rows].max())):
                some = rows[taken[rows] > k]
                values[write[active[some]] + k] = (payload[some] >> np.uint64(k * BITS[s])) & mask
        read[active] += 1 + (selector == ESCAPE)
        write[active] += taken
        active = active[write[active] < ends[active]]
    return values


def write_file(doc_ids: list[int | None], sizes: np.ndarray, values: np.ndarray) -> bytes:
    """Header, document index, block offsets and words of one file, little-endian.

    Header: magic, then the numbers of documents, values, blocks and words. The index
    has each document's id (and whether it has one) and its number of values.
    """
    words, offsets = encode_blocks(values)
    out = io.BytesIO()
    out.write(MAGIC + struct.pack("<QQQQ", len(doc_ids), len(values), len(offsets) - 1, len(words)))
    out.write(np.array([i is not None for i in doc_ids], "<u1").tobytes())
    out.write(np.array([i or 0 for i in doc_ids], "<i8").tobytes())
    out.write(sizes.astype("<i8").tobytes())
    out.write(offsets.astype("<i8").tobytes())
    out.write(words.astype("<u8").tobytes())
    return out.getvalue()


def read_file(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, their numbers of values, and all values of a file."""
    if data[:4] != MAGIC:
        raise ValueError("not a Simple-8b token file")
    n_docs, n_values, n_blocks, n_words = struct.unpack_from("<QQQQ", data, 4)
    place = 36
    parts = []
    for kind, count in (("<u1", n_docs), ("<i8", n_docs), ("<i8", n_docs), ("<i8", n_blocks + 1), ("<u8", n_words)):
        parts.append(np.frombuffer(data, kind, count, place))
        place += parts[-1].nbytes
    known, ids, sizes, offsets, words = parts
    if place != len(data):
        raise ValueError("token file is cut or has something after its end")
    doc_ids = [i if k else None for i, k in zip(ids.tolist(), known.tolist())]
    return doc_ids, sizes, decode_blocks(words, offsets, n_values)


def write_tokens(
    df: DataFrame,
    folder: str,
    id: str = "doc_id",
    text: str = "text",
    vocabulary: str | None = None,
    file_values: int = FILE_VALUES,
) -> DataFrame:
    """Encode all texts into files under ``folder``, in ascending order of the ids.

    Gives one row per file: ``part`` and ``number`` order the files, ``path`` is
    relative to ``folder``, ``n_docs`` and ``n_values`` count, and ``before`` is the
    number of values in all files before. The table is kept beside the files as
    ``index``, by which ``read_tokens`` finds them.
    """
    spark = df.sparkSession
    path = vocabulary or vocabulary_path()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col(f"`{id}`").cast("bigint").alias("id"), F.col(f"`{text}`").alias("text"))
    # Ranges by a hash of the text: their bounds are sampled, and whole texts should not be.
    ordered = rows.withColumn("hash", F.xxhash64("text")).repartitionByRange(partitions, "id", "hash")
    ordered = ordered.sortWithinPartitions("id", "hash", "text")
    ordered = ordered.select("id", "text", F.spark_partition_id().alias("part"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokenizer(path)
        files, base = open_files(folder)
        attempt = uuid.uuid4().hex[:12]
        ids, parts, part, number, held = [], [], None, 0, 0

        def flush():
            name = f"tokens-{part:05d}-{number:05d}-{attempt}.s8b"
            sizes = np.array([len(p) for p in parts], np.int64)
            with files.open_output_stream(f"{base}/{name}") as file:
                file.write(write_file(ids, sizes, np.concatenate(parts)))
            row = [[part], [number], [name], [len(ids)], [int(sizes.sum())]]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()))],
                names=["part", "number", "path", "n_docs", "n_values"],
            )

        files.create_dir(base, recursive=True)
        for batch in batches:
            if batch.num_rows:
                part = batch.column(2)[0].as_py()
            for start, length in slices(batch.column(1)):
                some = batch.slice(start, length)
                for doc, own in zip(some.column(0).to_pylist(), words.encode(some.column(1).to_pylist())):
                    ids.append(doc)
                    parts.append(np.append(own, np.uint32(END_ID)))
                    held += len(parts[-1])
                    if held >= file_values:
                        yield flush()
                        ids, parts, number, held = [], [], number + 1, 0
        if ids:
            yield flush()

    index = stage(
        ordered.mapInArrow(write, "part int, number int, path string, n_docs bigint, n_values bigint"),
        "index",
        folder,
    )
    return with_starts(index)


def with_starts(index: DataFrame) -> DataFrame:
    """Add the values before each file: by part from one row per part, then within it."""
    parts = index.groupBy("part").agg(F.sum("n_values").alias("size"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("start"))
    within = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    return index.join(F.broadcast(starts), "part").select(
        *index.columns,
        (F.col("start") + F.coalesce(F.sum("n_values").over(within), F.lit(0))).alias("before"),
    )


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Documents read back from the files: doc_id, start, n_tokens and ids (little-endian
    unsigned 32-bit integers)."""
    index = with_starts(spark.read.parquet(f"{folder}/index")).select("path", "before")
    # One file per row; every task reads a few of them.
    tasks = max(1, index.count() // 4, spark.sparkContext.defaultParallelism)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = open_files(folder)
        for batch in batches:
            for name, before in zip(*(c.to_pylist() for c in batch.columns)):
                with files.open_input_stream(f"{base}/{name}") as file:
                    ids, sizes, values = read_file(file.read())
                ends = sizes_to_offsets(sizes)
                data = values.astype("<u4").tobytes()
                for start, length in slices(pa.array([None] * len(ids), pa.null())):
                    span = slice(start, start + length)
                    blobs = [data[4 * a : 4 * b] for a, b in zip(ends[span].tolist(), ends[1:][span].tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(ids[span], pa.int64()),
                            pa.array(before + ends[:-1][span], pa.int64()),
                            pa.array(sizes[span], pa.int64()),
                            pa.array(blobs, pa.binary()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )

    return index.repartition(tasks, "path").mapInArrow(
        read, "doc_id bigint, start bigint, n_tokens bigint, ids binary"
    )


def token_files(df: DataFrame, **options) -> DataFrame:
    """Write the tokens of ``df`` to a fresh shared folder and read them back."""
    folder = fresh_path(df.sparkSession, "tokens")
    write_tokens(df, folder, **options)
    return read_tokens(df.sparkSession, folder)
