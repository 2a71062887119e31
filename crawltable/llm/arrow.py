"""Running a function over the whole texts of a table, batch by batch."""

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Bytes of text handed to Python at a time; a longer text comes by itself.
BATCH_BYTES = 4 << 20


def slices(column: pa.Array, size: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Start and length of consecutive runs of rows of about ``size`` bytes."""
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    else:
        sizes = [64] * len(column)
    start, total = 0, 0
    for n, one in enumerate(sizes):
        if n > start and total + one > size:
            yield start, n - start
            start, total = n, 0
        total += one
    if start < len(sizes):
        yield start, len(sizes) - start


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that is no column of ``df`` yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_texts(
    df: DataFrame,
    make: Callable[[], Callable[[list[str | None]], dict[str, object]]],
    added: str,
    text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """Columns ``keep`` of ``df`` and the columns ``added`` computed from its texts.

    ``make`` runs once per task; what it gives turns a list of texts into one
    sequence per added column. A null text comes as None.
    """
    keep = [c for c in df.columns if c != text] if keep is None else keep
    kept = [df.schema[c] for c in keep]
    new = T.StructType.fromDDL(added).fields
    out = T.StructType([*kept, *new])
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for batch in batches:
            column = batch.column(len(keep))
            for start, length in slices(column):
                part = batch.slice(start, length)
                result = apply(part.column(len(keep)).to_pylist())
                arrays = [part.column(n).cast(arrow.field(n).type) for n in range(len(keep))]
                arrays += [
                    pa.array(result[f.name], arrow.field(len(keep) + n).type)
                    for n, f in enumerate(new)
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    columns = [F.col(f"`{c}`") for c in keep]
    return df.select(*columns, F.col(f"`{text}`").alias("_text")).mapInArrow(run, out)
