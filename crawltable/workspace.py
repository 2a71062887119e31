"""The shared folder for data that is written once and read by several jobs."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_own_folders: dict[str, str] = {}


def workspace(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    Where it is unset a temporary folder is made for a local master only: on a
    cluster no machine-local folder could be read by the other executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = context.applicationId
    if app not in _own_folders:
        _own_folders[app] = tempfile.mkdtemp(prefix="crawltable-")
        context.setCheckpointDir(_own_folders[app])
    return _own_folders[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{workspace(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back, so later jobs never repeat its work.

    The files outlive lost executors and pin down values Spark would otherwise
    compute anew for each action (partition ids, archive reads). They go to
    ``folder``, if their maker removes that, else they stay like checkpoints do.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label) if folder is None else f"{folder}/{label}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[str]:
    """A folder that is removed at the end."""
    folder = fresh_path(spark, label)
    try:
        yield folder
    finally:
        remove(spark, folder)


@contextmanager
def bounded_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """Jobs that run meanwhile hand rows to Python by ``size`` bytes at a time; a longer row
    comes by itself. Spark bounds its batches by rows only, so that long ones make large ones.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
