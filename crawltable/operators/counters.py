"""Counters of an import, taken from its staged rows."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawltable.functions.names import named
from crawltable.operators.ordering import with_arrival_index
from crawltable.workspace import scratch, stage


def read_counters(captures: DataFrame) -> DataFrame:
    """One row with totals over the per-pointer rows of ``read_archive``.

    Taken from staged rows rather than from accumulators, so tasks that ran twice
    are not counted twice. Bodies and texts are not read. ``last`` is the URL and
    file of the last pointer.
    """

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0))

    return captures.agg(
        F.count("*").alias("matched"),
        total("skipped").alias("skipped"),
        F.count("*").alias("files_read"),
        total("bytes").alias("bytes_read"),
        total("requests").alias("requests"),
        total("extracted").alias("extracted"),
        F.max_by(F.struct("url", "filename"), "position").alias("last"),
    )


def imported_count(rows: DataFrame, key: str, order: str, batch_size: int = 100) -> DataFrame:
    """One row with the number of rows merged when batches of ``batch_size`` rows
    are merged in order of arrival, keeping one row per key within a batch.

    A key that comes again in a later batch counts again; null is a key. The count is
    taken at once, and what was staged for it is removed.
    """
    spark = rows.sparkSession
    with scratch(spark, "arrival") as folder:
        count = _merged_keys(rows, key, order, batch_size, 0, folder).count()
    return spark.createDataFrame([(count,)], "imported bigint")


def _merged_keys(rows, key, order, batch_size, before, folder) -> DataFrame:
    """Each key of each batch, ``before`` rows having arrived earlier."""
    arrived = rows.select(named(key).alias("_key"), named(order).alias("_order"))
    numbered = with_arrival_index(arrived, ["_order"], folder=folder)
    batch = F.floor((F.col("arrival") + before) / batch_size).alias("_batch")
    return numbered.select("_key", batch).distinct()


class Arrivals:
    """The same count over rows that come in parts, such as the micro-batches of a stream.

    What a part leaves to the next one is kept under ``folder`` by the number of the part:
    the rows so far, and the keys of the batch they have begun. A part that is counted
    again starts from what the part before it left.
    """

    def __init__(self, folder: str, part: int):
        self.folder, self.part = folder, part

    def count(self, rows: DataFrame, key: str, order: str, batch_size: int) -> int:
        spark = rows.sparkSession
        before, begun = self._left(spark)
        with scratch(spark, "arrival") as folder:
            keys = stage(_merged_keys(rows, key, order, batch_size, before, folder), "keys", folder)
            total = before + spark.read.parquet(f"{folder}/arrival").count()
            found = keys.count()
            again = keys.where(F.col("_batch") == before // batch_size)
            if begun is not None:
                known = begun.select(F.col("_key").alias("_known"))
                again = again.join(known, F.col("_key").eqNullSafe(F.col("_known")), "left_semi")
                found -= again.count()
            left = keys.where(F.col("_batch") == total // batch_size).select("_key")
            if begun is not None and before // batch_size == total // batch_size:
                left = left.unionByName(begun.select("_key")).distinct()
            place = f"{self.folder}/part={self.part}"
            # The keys come last, and only a part with keys counts as done.
            spark.range(1).select(F.lit(total).alias("rows")).write.mode("overwrite").parquet(f"{place}/rows")
            left.write.mode("overwrite").parquet(f"{place}/keys")
        return found

    def _left(self, spark: SparkSession) -> tuple[int, DataFrame | None]:
        pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/part=*/keys/_SUCCESS")
        found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
        names = (status.getPath().getParent().getParent().getName() for status in found)
        parts = [n for n in (int(name.removeprefix("part=")) for name in names) if n < self.part]
        if not parts:
            return 0, None
        place = f"{self.folder}/part={max(parts)}"
        return spark.read.parquet(f"{place}/rows").first()["rows"], spark.read.parquet(f"{place}/keys")
