"""Partitioned Parquet capture index: ``<root>/crawl=<id>/subset=<name>/``."""

import os
import re
from collections.abc import Mapping
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

# The region of the public bucket and the environment variables
# whose presence means requests can be signed.
STORE_REGION = "us-east-1"
CREDENTIAL_VARIABLES = (
    "AWS_ACCESS_KEY_ID",
    "AWS_PROFILE",
    "AWS_WEB_IDENTITY_TOKEN_FILE",
    "AWS_CONTAINER_CREDENTIALS_RELATIVE_URI",
    "AWS_CONTAINER_CREDENTIALS_FULL_URI",
)


def has_credentials(environ: Mapping[str, str] = os.environ) -> bool:
    return any(name in environ for name in CREDENTIAL_VARIABLES)


def object_store_options(
    path: str, environ: Mapping[str, str] = os.environ
) -> dict[str, str]:
    """Reader options for an S3 path; empty for any other file system."""
    if not re.match(r"s3a?:", path):
        return {}
    bucket = re.match(r"s3a?://([^/]+)", path)
    if bucket is None:
        raise ValueError(f"no bucket in object store path {path!r}")
    prefix = f"fs.s3a.bucket.{bucket[1]}"
    options = {
        f"{prefix}.requester.pays.enabled": "true",
        f"{prefix}.endpoint.region": STORE_REGION,
    }
    if not has_credentials(environ):
        options[f"{prefix}.aws.credentials.provider"] = (
            "org.apache.hadoop.fs.s3a.AnonymousAWSCredentialsProvider"
        )
    return options


def index_location(path: str, crawl: str, subset: str = "warc") -> tuple[str, str]:
    """``(root, folder)``: the folder to read and the root its partitions hang on.

    A path that already names its partitions is read as given. Naming the folder,
    rather than filtering the root, keeps the driver from listing every crawl.
    """
    path = path.rstrip("/")
    if "/crawl=" in path or path.endswith("/subset=warc"):
        return _root(path), path
    return path, f"{path}/crawl={crawl}/subset={subset}"


def _root(path: str) -> str:
    return re.sub(r"(/crawl=.*|/subset=warc)$", "", path)


def scan_index(
    spark: SparkSession, path: str, crawl: str, subset: str = "warc"
) -> DataFrame:
    """Captures of one crawl and subset, with both partition columns."""
    root, folder = index_location(path, crawl, subset)
    return _parquet(spark, root, folder)


def open_index(spark: SparkSession, path: str) -> DataFrame:
    """The whole index; filter ``crawl`` and ``subset`` or every crawl is read."""
    path = path.rstrip("/")
    return _parquet(spark, _root(path), path)


def _parquet(spark: SparkSession, root: str, folder: str) -> DataFrame:
    reader = spark.read.options(**object_store_options(folder))
    return reader.option("basePath", _hadoop(root)).parquet(_hadoop(folder))


def _hadoop(path: str) -> str:
    return re.sub(r"^s3://", "s3a://", path)


def latest_crawl(spark: SparkSession, path: str) -> DataFrame:
    """One row with the newest crawl id; fails where there is none.

    Ids start with year and week, so the greatest text is the newest crawl. The
    ``crawl=`` folders are listed; no data file is opened.
    """
    folder = _hadoop(_root(path.rstrip("/")))
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/crawl=*")
    conf = spark._jsc.hadoopConfiguration()
    for name, value in object_store_options(folder).items():
        conf.set(name, value)
    found = pattern.getFileSystem(conf).globStatus(pattern) or []
    names = (unquote(status.getPath().getName()).removeprefix("crawl=") for status in found)
    crawls = [name for name in names if name and name != "__HIVE_DEFAULT_PARTITION__"]
    if not crawls:
        raise ValueError(f"the index holds no crawl: {path}")
    return spark.createDataFrame([(max(crawls),)], "crawl string")
