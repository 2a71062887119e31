"""Capture lists kept as JSON lines, one page per file."""

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawltable.functions.columns import url_host
from crawltable.functions.sites import normalize_host, pattern_list
from crawltable.operators.ordering import first_rows
from crawltable.sources.lines import CaptureLines

_POSITION = "struct<page:bigint,file:string,block:bigint,line:bigint>"
# Endings of page files, which may hold digits that are no page number.
_ENDINGS = r"(?i)([.](gz|bz2|zst|zstd|xz|lz4|snappy|deflate|json|jsonl|ndjson|cdx|cdxj|txt))+$"
_SCHEMA = (
    "url string, timestamp string, mime string, filename string, offset bigint, "
    f"length bigint, status string, position {_POSITION}"
)


def read_cdx(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Validated captures of all pages under ``path``; blank lines are skipped.

    ``position`` sorts rows by page number, file and line. A page that vanished
    counts as empty, and so does a path that matches no page.
    """
    try:
        text = spark.read.option("ignoreMissingFiles", "true").text(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _SCHEMA)
    return parse_lines(cdx_lines(text))


def stream_cdx(
    spark: SparkSession, path: str, max_files: int | None = None, max_rows: int | None = None
) -> DataFrame:
    """Stream of the lines of new pages; ``parse_lines`` reads its micro-batches.

    A micro-batch has up to ``max_files`` pages, or ``max_rows`` lines that are not blank,
    of any pages. A stream by rows has no end of its own; ``import_stream`` ends it once
    nothing is left.
    """
    if max_rows is not None:
        spark.dataSource.register(CaptureLines)
        return spark.readStream.format(CaptureLines.name()).option("path", path).option("max_rows", max_rows).load()
    reader = spark.readStream.option("ignoreMissingFiles", "true")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return cdx_lines(reader.text(path))


def cdx_lines(text: DataFrame) -> DataFrame:
    return text.select(
        F.regexp_replace("value", r"^\s+|\s+$", "").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_name").alias("name"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def parse_lines(lines: DataFrame) -> DataFrame:
    stem = F.regexp_replace("name", _ENDINGS, "")
    numbers = F.regexp_extract_all(stem, F.lit(r"(\d+)"))
    position = F.struct(
        F.try_element_at(numbers, F.lit(-1)).try_cast("bigint").alias("page"),
        "file",
        "block",
        # Grows with the lines of a block, and a block is read by one task.
        (F.col("number") if "number" in lines.columns else F.monotonically_increasing_id()).alias("line"),
    )
    lines = lines.select("line", position.alias("position"))
    parsed = lines.where(F.col("line") != "").select(
        F.try_parse_json("line").alias("capture"), "position"
    )
    return parsed.select(
        _text("url"),
        _text("timestamp"),
        F.try_variant_get("capture", "$.mime", "string").alias("mime"),
        _text("filename"),
        _whole_number("offset"),
        _whole_number("length"),
        F.try_variant_get("capture", "$.status", "string").alias("status"),
        "position",
    )


def _text(name: str) -> Column:
    kind = F.schema_of_variant(F.try_variant_get("capture", f"$.{name}", "variant"))
    value = F.try_variant_get("capture", f"$.{name}", "string")
    problem = F.raise_error(F.lit(f"capture line without a text {name}"))
    return F.when(kind == "STRING", value).otherwise(problem).alias(name)


def _whole_number(name: str) -> Column:
    text = F.trim(F.try_variant_get("capture", f"$.{name}", "string"))
    value = F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("bigint"))
    problem = F.raise_error(F.lit(f"capture line without a whole number {name}"))
    return F.coalesce(value, problem.cast("bigint")).alias(name)


def select_cdx(
    cdx: DataFrame,
    site: str,
    match: str = "domain",
    url_patterns: str | Sequence[str] | None = None,
    limit: int | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Successful captures of a host, or of a domain with its subdomains.

    Unlike the columnar selection there is no media type, robots or latest rule.
    Lines without a status come from a listing that was already filtered on it.
    """
    wanted = normalize_host(site)
    host = url_host(F.col("url"))
    if match == "host":
        on_site = host == wanted
    elif match == "domain":
        on_site = (host == wanted) | host.endswith("." + wanted)
    else:
        raise ValueError("match must be 'domain' or 'host'")
    captures = cdx.where(F.coalesce("status", F.lit("200")) == "200").where(on_site)
    for pattern in pattern_list(url_patterns):
        captures = captures.where(F.col("url").rlike(pattern))
    return first_rows(captures.drop("status"), ["position"], limit, ordered)
