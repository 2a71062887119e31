"""The built-in capture selection of the columnar index."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawltable.functions.sites import normalize_host, pattern_list
from crawltable.operators.dedupe import top_row
from crawltable.operators.ordering import first_rows

# What a selectable capture looks like.
GOOD_STATUS = 200
PAGE_TYPE = "text/html"
ROBOTS_PATH = "/robots.txt"


def html_captures(index: DataFrame) -> DataFrame:
    """Successful HTML captures other than robots files; null paths are kept.

    Status and type are bare equalities, so they reach the Parquet row groups.
    """
    path = F.coalesce(F.lower("url_path"), F.lit(""))
    return index.where(
        (F.col("fetch_status") == GOOD_STATUS)
        & (F.col("content_mime_detected") == PAGE_TYPE)
        & (path != ROBOTS_PATH)
    )


def on_site(index: DataFrame, site: str, match: str = "domain") -> DataFrame:
    if match not in ("domain", "host"):
        raise ValueError("match must be 'domain' or 'host'")
    column = "url_host_name" if match == "host" else "url_host_registered_domain"
    return index.where(F.col(column) == normalize_host(site))


def matching_urls(index: DataFrame, url_patterns: str | Sequence[str] | None) -> DataFrame:
    """URLs in which every pattern is found. Patterns are Java regular expressions."""
    for pattern in pattern_list(url_patterns):
        index = index.where(F.col("url").rlike(pattern))
    return index


def latest_per_url(index: DataFrame) -> DataFrame:
    """Newest capture of each URL; unknown times win, then file and offset decide."""
    return top_row(
        index,
        "url",
        F.col("fetch_time").desc_nulls_first(),
        F.col("warc_filename").desc(),
        F.col("warc_record_offset").desc(),
    )


def select_captures(
    index: DataFrame,
    site: str,
    match: str = "domain",
    url_patterns: str | Sequence[str] | None = None,
    limit: int | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Latest HTML capture per URL of a host or registered domain, sorted by URL."""
    captures = on_site(html_captures(index), site, match)
    latest = latest_per_url(matching_urls(captures, url_patterns))
    return first_rows(latest, ["url"], limit, ordered)
