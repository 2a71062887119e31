"""Capture index, archives and CDX pages that Spark derives from ``pages``.

Every page is captured three times, and every host has one robots capture. Archives
are written once per session and table folder, into the shared workspace.
"""

import gzip
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawltable.functions.columns import timestamp14, url_host
from crawltable.sources.archive import open_files
from crawltable.workspace import bounded_batches, fresh_path

CRAWLS = ("2024-05", "2024-10")
CDX_PAGES = 12
# Bytes of captures that a task hands to Python at a time; a longer one comes by itself.
BATCH_BYTES = 4 << 20
ROBOTS_BODY = "User-agent: *\nDisallow: /private"

_prepared: dict[tuple[str, str], dict[str, str]] = {}


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def ccindex(spark: SparkSession, sf_dir: str, bodies: bool = False) -> DataFrame:
    """The capture index, with made-up places in archives; ``bodies`` adds ``html``."""
    host = url_host(F.col("url"))
    caps = (
        pages(spark, sf_dir)
        .select("page_id", "url", "html", F.explode(F.array(*map(F.lit, range(3)))).alias("cap"))
        .withColumn("host", host)
    )
    day = (F.col("page_id") + 2 * F.col("cap")) % 3
    captures = caps.select(
        (F.col("page_id") * 4 + F.col("cap")).alias("capture_id"),
        "page_id",
        "url",
        F.col("host").alias("url_host_name"),
        F.when(F.col("page_id") % 13 != 0, F.regexp_extract("url", r"^[a-z]+://[^/?#]*([^?#]*)", 1)).alias("url_path"),
        F.when((F.col("page_id") + F.col("cap")) % 10 == 0, 404).otherwise(200).alias("fetch_status"),
        F.when((F.col("page_id") + 2 * F.col("cap")) % 9 == 0, "application/pdf").otherwise("text/html").alias("content_mime_detected"),
        (F.lit(1704067200).cast("bigint") + F.col("page_id") * 37 + day * 86400).alias("fetch_epoch"),
        F.concat(F.lit("f"), (F.col("page_id") % 8).cast("string"), F.lit(".warc.gz")).alias("warc_filename"),
        (F.col("page_id") * 1000 + F.col("cap") * 300).alias("warc_record_offset"),
        F.when(F.col("cap") == 1, CRAWLS[0]).otherwise(CRAWLS[1]).alias("crawl"),
        "html",
    )
    robots = (
        pages(spark, sf_dir)
        .groupBy(host.alias("url_host_name"))
        .agg((F.min("page_id") * 4 + 3).alias("capture_id"))
        .select(
            "capture_id",
            F.lit(None).cast("bigint").alias("page_id"),
            F.concat(F.lit("https://"), "url_host_name", F.lit("/Robots.txt")).alias("url"),
            "url_host_name",
            F.lit("/Robots.txt").alias("url_path"),
            F.lit(200).alias("fetch_status"),
            F.lit("text/html").alias("content_mime_detected"),
            F.lit(1704067200).cast("bigint").alias("fetch_epoch"),
            F.lit("f0.warc.gz").alias("warc_filename"),
            F.lit(0).cast("bigint").alias("warc_record_offset"),
            F.lit(CRAWLS[1]).alias("crawl"),
            F.lit(ROBOTS_BODY).alias("html"),
        )
    )
    index = captures.unionByName(robots).withColumns(
        {
            "url_host_registered_domain": F.regexp_extract("url_host_name", r"([^.]+[.][^.]+)$", 1),
            "fetch_time": F.timestamp_seconds("fetch_epoch"),
            "warc_record_length": F.lit(300).cast("bigint"),
            "subset": F.lit("warc"),
        }
    )
    return index if bodies else index.drop("html")


def crawl_store(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Paths of ``index``, ``archive`` and ``cdx``, written on first use."""
    known = (spark.sparkContext.applicationId, sf_dir)
    if known not in _prepared:
        root = fresh_path(spark, "crawl")
        paths = {name: f"{root}/{name}" for name in ("index", "archive", "cdx")}
        with bounded_batches(spark, BATCH_BYTES):
            write_archives(ccindex(spark, sf_dir, bodies=True), paths["archive"]).write.partitionBy(
                "crawl", "subset"
            ).parquet(paths["index"])
        write_cdx(spark.read.parquet(paths["index"]), paths["cdx"])
        _prepared[known] = paths
    return _prepared[known]


def write_archives(captures: DataFrame, folder: str) -> DataFrame:
    """Write a request and a response record per capture, one archive per task, and
    give the index rows with their real places.

    The pointer of a capture covers both records. An archive's name is made anew by
    every attempt, so the rows of the attempt that counts name its own file.
    """
    tasks = captures.sparkSession.sparkContext.defaultParallelism
    schema = captures.drop("html").schema

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = open_files(folder)
        files.create_dir(path)
        name = f"part-{uuid.uuid4().hex}.warc.gz"
        with files.open_output_stream(f"{path}/{name}", compression=None) as out:
            for batch in batches:
                places = []
                for capture in batch.to_pylist():
                    offset = out.tell()
                    out.write(_member("request", capture, b"GET / HTTP/1.1\r\n\r\n"))
                    out.write(_member("response", capture, _response(capture)))
                    places.append((offset, out.tell() - offset))
                yield _with_places(batch, name, places, schema.names)

    return captures.repartition(tasks, "capture_id").mapInArrow(write, schema)


def _with_places(batch, name, places, names):
    columns = dict(zip(batch.schema.names, batch.columns))
    columns["warc_filename"] = pa.array([name] * len(places), pa.string())
    columns["warc_record_offset"] = pa.array([p[0] for p in places], pa.int64())
    columns["warc_record_length"] = pa.array([p[1] for p in places], pa.int64())
    return pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)


def _member(kind: str, capture: dict, block: bytes) -> bytes:
    time = capture["fetch_time"].astimezone(UTC)
    head = (
        f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {capture['url']}\r\n"
        f"WARC-Date: {time:%Y-%m-%dT%H:%M:%S}Z\r\n"
        f"Content-Type: application/http; msgtype={kind}\r\n"
        f"Content-Length: {len(block)}\r\n\r\n"
    )
    return gzip.compress(head.encode() + block + b"\r\n\r\n", mtime=0)


def _response(capture: dict) -> bytes:
    """Body plain, compressed or in chunks, by the kind of capture."""
    body = (capture["html"] or "").encode()
    coding = ""
    if capture["crawl"] == CRAWLS[0]:
        body, coding = gzip.compress(body, mtime=0), "Content-Encoding: gzip\r\n"
    elif capture["page_id"] is None:
        parts = (body[:7], body[7:], b"")
        body = b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts)
        coding = "Transfer-Encoding: chunked\r\n"
    elif capture["fetch_status"] == 404:
        body, coding = zlib.compress(body), "Content-Encoding: deflate\r\n"
    head = (
        f"HTTP/1.1 {capture['fetch_status']} -\r\n"
        f"Content-Type: {capture['content_mime_detected']}; charset=utf-8\r\n{coding}\r\n"
    )
    return head.encode() + body


def write_cdx(index: DataFrame, folder: str) -> None:
    """The index as JSON lines, sorted by URL over several pages, with blank lines."""
    line = F.to_json(
        F.struct(
            "url",
            timestamp14(F.col("fetch_time"), index.schema["fetch_time"].dataType).alias("timestamp"),
            F.col("content_mime_detected").alias("mime"),
            F.col("fetch_status").cast("string").alias("status"),
            F.col("warc_filename").alias("filename"),
            F.col("warc_record_offset").cast("string").alias("offset"),
            F.col("warc_record_length").cast("string").alias("length"),
        )
    )
    lines = index.repartitionByRange(CDX_PAGES, "url", "fetch_time").sortWithinPartitions("url", "fetch_time")
    lines.select(F.concat(line, F.lit("\n")).alias("value")).write.text(folder)
