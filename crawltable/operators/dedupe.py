"""One row per key, the last arrival winning."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawltable.functions.names import named


def dedupe_last(
    df: DataFrame, key: str, order: str, first_seen: str | None = None
) -> DataFrame:
    """Each key's last row in ``order``; null is a key like any other.

    ``first_seen`` names an optional column with the key's first position, to sort
    the result in order of first arrival. Either way tasks give up all but one row
    of a key before the shuffle, even of a key that holds most rows.
    """
    if first_seen is None:
        return top_row(df, key, named(order).desc())
    last = F.max_by(F.struct(*(named(c) for c in df.columns if c != key)), named(order))
    kept = df.groupBy(named(key)).agg(last.alias("_last"), F.min(named(order)).alias(first_seen))
    columns = [named(c) if c == key else named("_last", c) for c in df.columns]
    return kept.select(*columns, named(first_seen))


def top_row(df: DataFrame, key: str, *order: Column) -> DataFrame:
    """The first row of each key in ``order``.

    Spark limits the groups below the shuffle. Rows are sorted by a hash before the
    key, as keys that start alike, such as URLs, are slow to sort.
    """
    ranking = Window.partitionBy(F.xxhash64(named(key)), named(key)).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(ranking))
    return ranked.where(F.col("_rank") == 1).drop("_rank")
