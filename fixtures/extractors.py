"""Extractors as a caller would write them."""

import re

from pyspark.sql import types as T

TITLED_SCHEMA = (
    T.StructType()
    .add("url", T.StringType())
    .add("title", T.StringType())
    .add("links", T.LongType())
)


def titled_page(record, body):
    """Title and number of links; a page without a title is skipped."""
    markup = body.decode()
    title = re.search("<title>(.*?)</title>", markup)
    if title is None:
        return None
    return {
        "url": record.headers["warc-target-uri"],
        "title": title[1],
        "links": markup.count("<a href="),
    }


def measured_page(record, body):
    """Columns that differ from page to page; no schema is declared for them."""
    row = {"url": record.headers["warc-target-uri"], "size": len(body)}
    lang = re.search(rb'<html lang="(en|fr)"', body)
    if lang is not None:
        row["lang"] = lang[1].decode()
    return row
