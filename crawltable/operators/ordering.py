"""Global positions and limits without a single-partition sort."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawltable.workspace import stage

_ROW_BITS = 33  # monotonically_increasing_id(): partition above, row below


def with_arrival_index(
    df: DataFrame,
    order: Sequence[str | Column],
    name: str = "arrival",
    *,
    folder: str,
) -> DataFrame:
    """Number the rows 0, 1, 2, ... in ``order``, which should have no ties.

    Rows are range partitioned and sorted within partitions; what is known about
    all partitions together is one count each. The sorted rows are staged in ``folder``,
    which the caller removes.
    """
    sliced = df.repartitionByRange(*order).sortWithinPartitions(*order)
    sliced = sliced.withColumn("_place", F.monotonically_increasing_id())
    placed = stage(sliced, "arrival", folder)
    numbered = placed.withColumns(
        {
            "_slice": F.shiftright("_place", _ROW_BITS),
            "_row": F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
        }
    )
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        numbered.groupBy("_slice")
        .agg(F.count("*").alias("_size"))
        .select("_slice", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    )
    # One row per partition, so its size is bounded by the partition count.
    return numbered.join(F.broadcast(starts), "_slice").select(
        *df.columns, (F.col("_start") + F.col("_row")).alias(name)
    )


def first_rows(
    df: DataFrame, order: Sequence[str], limit: int | None, ordered: bool = True
) -> DataFrame:
    """The first ``limit`` rows in ``order``, sorted unless nothing needs them so.

    Every task gives up all but its own first ``limit`` rows, whatever the limit is.
    """
    if limit is not None:
        return df.orderBy(*order).limit(limit)
    return df.orderBy(*order) if ordered else df
