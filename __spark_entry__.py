"""Registered queries and their DuckDB counterparts."""

from __future__ import annotations

import itertools
import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import crawltable
import fixtures
from crawltable.functions import columns as C
from crawltable.functions.sites import scope_patterns
from crawltable.operators.counters import imported_count
from crawltable.operators.dedupe import dedupe_last
from crawltable.operators.extract import (
    DEFAULT_SCHEMA,
    RAW_SCHEMA,
    default_extract,
    html_text,
    raw_extract,
)
from crawltable.operators.lateral import register_extractor
from crawltable.operators.pointers import select_with_query, to_pointers
from crawltable.operators.select import (
    html_captures,
    latest_per_url,
    matching_urls,
    on_site,
    select_captures,
)
from crawltable.operators.upsert import Target, read_table, upsert
from crawltable.plans.imports import import_cdx, import_domain, import_scope
from crawltable.sources.archive import archive_rows, read_archive
from crawltable.sources.cdx import parse_lines, read_cdx, select_cdx, stream_cdx
from crawltable.sources.index import latest_crawl, open_index, scan_index
from crawltable.sources.records import scan_records
from crawltable.streaming.stream import (
    import_cdx_stream,
    import_stream,
    read_progress,
    stream_upsert,
)
from crawltable.workspace import fresh_path
from fixtures import oracle as O
from fixtures.derived import CRAWLS, ccindex, crawl_store, pages
from fixtures.extractors import TITLED_SCHEMA, measured_page, titled_page

# The subpackage llm may be absent; nothing else here needs it.
try:
    import corpus_pipeline
    from crawltable.llm import queries as llm_queries
except ImportError as absent:
    if absent.name not in ("corpus_pipeline", "crawltable.llm"):
        raise
    llm_queries = None

# Executors need not have this folder on their path.
cloudpickle.register_pickle_by_value(crawltable)
cloudpickle.register_pickle_by_value(fixtures)

NEWEST = CRAWLS[1]
DOMAIN = "example.net"
URL_PATTERNS = ["^https://", r"/(en|fr)/\d+"]
CUSTOM_SQL = f"""
  SELECT c.url, c.fetch_time, c.content_mime_detected, c.warc_filename,
         c.warc_record_offset, c.warc_record_length
  FROM ccindex c JOIN (SELECT url_host_name, max(fetch_time) AS newest FROM ccindex
                       WHERE crawl = '{NEWEST}' AND subset = 'warc' GROUP BY url_host_name) h
    ON c.url_host_name = h.url_host_name AND c.fetch_time = h.newest
  WHERE c.crawl = '{NEWEST}' AND c.subset = 'warc';
"""


def entry(spark: SparkSession) -> DataFrame:
    """Import the newest captures of one domain from archives."""
    return _import_domain(spark, "/root/testdata/sf0.001")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _target(spark: SparkSession, table: str, **address) -> Target:
    """A table of its own for every run; few buckets, as the data is small."""
    root = fresh_path(spark, "tables")
    return Target(f"{table}_{root[-8:]}", root=root, buckets=8, **address)


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return open_index(spark, crawl_store(spark, sf_dir)["index"])


def _index_scan(spark, sf):
    index = scan_index(spark, crawl_store(spark, sf)["index"], NEWEST)
    return index.select("capture_id", "url", "url_host_name", "fetch_status", "crawl", "subset")


def _html_captures(spark, sf):
    return html_captures(_index(spark, sf)).select("capture_id", "url", "url_path")


def _host_select(spark, sf):
    index = _index(spark, sf)
    hosts = index.groupBy("url_host_name").count()
    busiest = hosts.orderBy(F.desc("count"), "url_host_name").first()["url_host_name"]
    return on_site(index, f"HTTPS://{busiest}/", "host").select("capture_id", "url", "url_host_name")


def _domain_select(spark, sf):
    captures = on_site(_index(spark, sf), f" .{DOMAIN.upper()}.")
    return captures.select("capture_id", "url", "url_host_registered_domain")


def _regex_select(spark, sf):
    captures = html_captures(_index(spark, sf))
    return matching_urls(captures, URL_PATTERNS).select("capture_id", "url")


def _scope_select(spark, sf):
    site, pattern = scope_patterns("https://www.example.org/en/", "domain")
    captures = select_captures(_index(spark, sf), site, "domain", pattern)
    return captures.select("capture_id", "url")


def _latest_per_url(spark, sf):
    latest = latest_per_url(html_captures(_index(spark, sf)))
    return latest.select("url", "fetch_epoch", "capture_id")


def _latest_topk(spark, sf):
    captures = select_captures(_index(spark, sf), DOMAIN, limit=25)
    return captures.select("url", "fetch_epoch", "capture_id")


def _custom_select(spark, sf):
    pointers = to_pointers(select_with_query(_index(spark, sf), CUSTOM_SQL))
    # Names and places in archives are new in every run.
    placed = (F.length("filename") > 0) & (F.col("offset") >= 0) & (F.col("length") > 0)
    return pointers.select("url", "timestamp", "mime", placed.alias("placed"))


def _latest_crawl(spark, sf):
    return latest_crawl(spark, crawl_store(spark, sf)["index"])


def _timestamp14(spark, sf):
    def of(column):
        return C.timestamp14(F.col(column), texts.schema[column].dataType)

    texts = events(spark, sf).withColumns(
        {"text": F.col("ts").cast("string"), "instant": F.timestamp_seconds("event_id")}
    )
    return texts.select(
        "event_id",
        of("ts").alias("of_time"),
        of("text").alias("of_text"),
        of("props").alias("of_short"),
        of("instant").alias("of_instant"),
    )


def _normalize_host(spark, sf):
    bare = F.regexp_replace("url", "^[a-z]+://", "")
    return pages(spark, sf).select(
        "page_id",
        C.host_key(F.col("url")).alias("of_url"),
        C.host_key(F.upper(bare)).alias("of_name"),
        C.host_key(F.concat(F.lit(" ."), C.url_host(F.col("url")), F.lit("./x "))).alias("of_dotted"),
    )


def _charset_of(spark, sf):
    lang = F.regexp_extract("html", '<html lang="([a-z]*)"', 1)
    charset = F.regexp_extract("html", '<meta charset="([^"]*)"', 1)
    return pages(spark, sf).select(
        "page_id",
        C.charset_of(F.concat(F.lit("text/html; x="), lang, F.lit("; Charset="), charset)).alias("declared"),
        C.charset_of(F.concat(F.lit("text/html; charset= ; charset="), lang, F.lit("%2D1+x"))).alias("encoded"),
        C.charset_of(F.concat(F.lit("text/html; lang="), lang)).alias("absent"),
    )


def _content_type(spark, sf):
    http = F.regexp_extract("url", "[?]utm_source=(.*)$", 1)
    return _index(spark, sf).select(
        "capture_id", C.content_type(http, F.col("url_path")).alias("content_type")
    )


def _warc_date(spark, sf):
    iso = F.replace(F.col("ts").cast("string"), F.lit(" "), F.lit("T"))
    seconds = F.substring(iso, 1, 19)
    compact = F.regexp_replace(seconds, "[-:]", "")
    return events(spark, sf).select(
        "event_id",
        C.warc_date(F.concat(iso, F.lit("Z"))).alias("exact"),
        C.warc_date(F.concat(seconds, F.lit("+02:00"))).alias("shifted"),
        C.warc_date(F.concat(compact, F.lit("Z"))).alias("compact"),
        C.warc_date(F.substring(iso, 1, 10)).alias("day"),
        C.warc_date(F.col("props")).alias("kept"),
    )


def _html_text(spark, sf):
    rows = pages(spark, sf).withColumn("content_type", F.lit("text/html"))
    return html_text(rows, "html", "content_type").select("page_id", "url", "text")


def _decode_body(spark, sf):
    """The same from bytes of another charset than utf-8."""
    rows = pages(spark, sf).select(
        "page_id",
        "url",
        F.encode("html", "UTF-16LE").alias("body"),
        F.lit("text/html; Charset=utf-16-le").alias("content_type"),
    )
    return html_text(rows, "body", "content_type").select("page_id", "url", "text")


def _all_captures(spark, sf, extractor, schema):
    store = crawl_store(spark, sf)
    pointers = to_pointers(_index(spark, sf))
    cores = spark.sparkContext.defaultParallelism
    captures = read_archive(
        pointers, store["archive"], extractor, schema, read_partitions=cores
    )
    return archive_rows(captures)


def _warc_read(spark, sf):
    rows = _all_captures(spark, sf, raw_extract, RAW_SCHEMA)
    return rows.select(
        F.col("headers")["warc-target-uri"].alias("url"),
        F.col("headers")["warc-date"].alias("date"),
        F.col("http_headers")["content-type"].alias("content_type"),
        F.col("body").cast("string").alias("html"),
    )


def _extract_default(spark, sf):
    rows = _all_captures(spark, sf, default_extract, DEFAULT_SCHEMA)
    return rows.select("url", "date", "content_type", "text")


def _extract_custom(spark, sf):
    rows = _all_captures(spark, sf, titled_page, TITLED_SCHEMA)
    return rows.select("url", "title", "links")


def _extract_lateral(spark, sf):
    """The same in SQL, row by row of the index."""
    store = crawl_store(spark, sf)
    register_extractor(spark, "titled_pages", titled_page, TITLED_SCHEMA, store["archive"])
    _index(spark, sf).createOrReplaceTempView("ccindex")
    return spark.sql("""
      SELECT t.url, t.title, t.links
      FROM (SELECT * FROM ccindex DISTRIBUTE BY warc_filename SORT BY warc_filename, warc_record_offset) c,
        LATERAL titled_pages(c.warc_filename, c.warc_record_offset, c.warc_record_length) t""")


def _record_scan(spark, sf):
    """Headers of the responses under one scheme; no body is unpacked."""
    store = crawl_store(spark, sf)
    pointers = fresh_path(spark, "pointers")
    to_pointers(_index(spark, sf)).write.parquet(pointers)
    records = scan_records(spark, pointers, store["archive"], ["url", "uri", "date", "content_type"])
    records = records.where(F.col("url").startswith("https://"))
    return records.select(F.col("uri").alias("url"), "date", "content_type")


def _import_domain(spark, sf):
    store = crawl_store(spark, sf)
    target = _target(spark, "pages")
    table, _ = import_domain(spark, store["index"], NEWEST, DOMAIN, store["archive"], target)
    return table


def _import_query(spark, sf):
    store = crawl_store(spark, sf)
    table, _ = import_domain(
        spark, store["index"], NEWEST, DOMAIN, store["archive"], _target(spark, "pages"),
        query=f"SELECT * FROM ccindex WHERE crawl = '{NEWEST}' AND fetch_status = 200 ORDER BY fetch_time, url",
        extractor=titled_page, schema=TITLED_SCHEMA,
    )
    return table


def _import_grow(spark, sf):
    store = crawl_store(spark, sf)
    table, _ = import_domain(
        spark, store["index"], NEWEST, DOMAIN, store["archive"], _target(spark, "pages"),
        extractor=measured_page,
    )
    return table


def _import_scope(spark, sf):
    store = crawl_store(spark, sf)
    table, _ = import_scope(
        spark, store["index"], "https://www.example.com/", store["archive"],
        _target(spark, "pages"), scope="domain",
    )
    return table


def _import_counters(spark, sf):
    store = crawl_store(spark, sf)
    _, counters = import_domain(
        spark, store["index"], NEWEST, DOMAIN, store["archive"], _target(spark, "pages"),
        extractor=titled_page, schema=TITLED_SCHEMA,
    )
    row = counters._asdict()
    captures = select_captures(scan_index(spark, store["index"], NEWEST), DOMAIN, ordered=False)
    wanted = captures.agg(F.sum("warc_record_length")).first()[0]
    # Sizes of archives depend on their compression, so SQL cannot tell them.
    row["all_bytes_read"] = int(row.pop("bytes_read") == wanted)
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{n} bigint" for n in row))


def _empty_import(spark, sf):
    store = crawl_store(spark, sf)
    table, counters = import_domain(
        spark, store["index"], NEWEST, "absent.invalid", store["archive"], _target(spark, "pages")
    )
    return table.agg(F.count("*").alias("table_rows")).select(
        "table_rows",
        F.lit(",".join(table.columns)).alias("columns"),
        F.lit(counters.matched).cast("bigint").alias("matched"),
        F.lit(counters.imported).cast("bigint").alias("imported"),
    )


def _cdx(spark, sf):
    return read_cdx(spark, crawl_store(spark, sf)["cdx"])


def _cdx_select(spark, sf):
    captures = select_cdx(_cdx(spark, sf), DOMAIN, url_patterns=URL_PATTERNS)
    return captures.select("url", "timestamp", "mime")


def _cdx_limit(spark, sf):
    return select_cdx(_cdx(spark, sf), DOMAIN, limit=40).select("url", "timestamp", "mime")


def _import_cdx(spark, sf):
    store = crawl_store(spark, sf)
    table, _ = import_cdx(spark, store["cdx"], DOMAIN, store["archive"], _target(spark, "pages"))
    return table


def _import_stream(spark, sf):
    store = crawl_store(spark, sf)
    target = _target(spark, "pages")
    import_stream(
        stream_cdx(spark, store["cdx"], max_files=3), store["archive"], target,
        select=lambda lines: select_cdx(parse_lines(lines), DOMAIN, ordered=False),
    ).awaitTermination()
    return read_table(spark, target)


def _import_rows(spark, sf):
    store = crawl_store(spark, sf)
    target = _target(spark, "pages")
    stream = import_cdx_stream(spark, store["cdx"], DOMAIN, store["archive"], target, batch_size=1000)
    stream.awaitTermination()
    return read_table(spark, target)


LAST_DAY = "2024-01-30"
FILES_PER_WEEK = 4
WEEKS = ["2024-01-08", "2024-01-16", "2024-01-24"]


def _upsert(spark, sf):
    rows = events(spark, sf).select("user_id", "event_id", "event_type", "props", "ts")
    target = _target(spark, "users")
    before = rows.where(F.col("ts") < LAST_DAY).drop("ts")
    upsert(spark, target, dedupe_last(before, "user_id", "event_id"), "user_id")
    after = rows.where(F.col("ts") >= LAST_DAY).drop("ts", "props")
    upsert(spark, target, dedupe_last(after, "user_id", "event_id"), "user_id")
    return read_table(spark, target)


def _dedupe_last(spark, sf):
    rows = events(spark, sf).select("user_id", "event_id", "event_type", "value")
    return dedupe_last(rows, "user_id", "event_id", first_seen="first_event")


def _event_drops(spark, sf):
    """The events as files that arrive one after the other."""
    rows = events(spark, sf).drop("value")
    time = F.col("ts")
    weeks = [
        time < WEEKS[0],
        *((time >= start) & (time < end) for start, end in itertools.pairwise(WEEKS)),
        time.isNull() | (time >= WEEKS[-1]),
    ]
    folder = fresh_path(spark, "events")
    for week in weeks:
        rows.where(week).drop("ts").repartition(FILES_PER_WEEK).write.mode("append").parquet(folder)
    reader = spark.readStream.schema(rows.drop("ts").schema)
    return reader.option("maxFilesPerTrigger", FILES_PER_WEEK).parquet(folder)


def _stream_upsert(spark, sf):
    target = _target(spark, "users")
    stream_upsert(_event_drops(spark, sf), target, "user_id", "event_id").awaitTermination()
    return read_table(spark, target)


def _progress_events(spark, sf):
    path = fresh_path(spark, "progress")
    stream_upsert(
        _event_drops(spark, sf), _target(spark, "users"), "user_id", "event_id", progress_path=path
    ).awaitTermination()
    return read_progress(spark, path).select("batch", "stage", "matched", "imported", "pending")


def _schema_evolve(spark, sf):
    rows = events(spark, sf).select("event_id", "event_type", "user_id", "props")
    bought = F.col("event_type") == "purchase"
    target = _target(spark, "events")
    upsert(spark, target, rows.where(~bought).drop("props"), "event_id")
    upsert(spark, target, rows.where(bought), "event_id")
    return read_table(spark, target)


def _target_address(spark, sf):
    target = _target(spark, "users", namespace="crawls::::by_user", branch="review")
    rows = events(spark, sf).select("user_id", "event_id")
    upsert(spark, target, dedupe_last(rows, "user_id", "event_id"), "user_id")
    stored = spark.sql(f"SELECT user_id, event_id FROM {target.name}")
    return stored.withColumn("namespace", F.lit(target.database))


def _imported_count(spark, sf):
    rows = events(spark, sf)
    return imported_count(rows, "user_id", "event_id", batch_size=100)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "index_scan": _index_scan,
        "html_captures": _html_captures,
        "host_select": _host_select,
        "domain_select": _domain_select,
        "regex_select": _regex_select,
        "scope_select": _scope_select,
        "latest_per_url": _latest_per_url,
        "latest_topk": _latest_topk,
        "custom_select": _custom_select,
        "latest_crawl": _latest_crawl,
        "timestamp14": _timestamp14,
        "normalize_host": _normalize_host,
        "charset_of": _charset_of,
        "content_type": _content_type,
        "warc_date": _warc_date,
        "html_text": _html_text,
        "decode_body": _decode_body,
        "warc_read": _warc_read,
        "extract_default": _extract_default,
        "extract_custom": _extract_custom,
        "extract_lateral": _extract_lateral,
        "record_scan": _record_scan,
        "import_domain": _import_domain,
        "import_query": _import_query,
        "import_grow": _import_grow,
        "import_scope": _import_scope,
        "import_counters": _import_counters,
        "imported_count": _imported_count,
        "empty_import": _empty_import,
        "cdx_select": _cdx_select,
        "cdx_limit": _cdx_limit,
        "import_cdx": _import_cdx,
        "import_stream": _import_stream,
        "import_rows": _import_rows,
        "upsert": _upsert,
        "dedupe_last": _dedupe_last,
        "stream_upsert": _stream_upsert,
        "progress_events": _progress_events,
        "schema_evolve": _schema_evolve,
        "target_address": _target_address,
        **(_llm_queries() if llm_queries else {}),
    }


def _llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**llm_queries.queries(), "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    index = O.CCINDEX
    in_domain = f"url_host_registered_domain = '{DOMAIN}'"
    newest_html = f"SELECT * FROM html_captures WHERE crawl = '{NEWEST}'"
    patterns = " AND ".join(f"regexp_matches(url, '{p}')" for p in URL_PATTERNS)
    listed = f"FROM ccindex WHERE fetch_status = 200 AND {in_domain}"
    titles = """SELECT c.url, {columns} regexp_extract(html, '<title>(.*?)</title>', 1) AS title,
      CAST((length(html) - length(replace(html, '<a href=', ''))) / 8 AS BIGINT) AS links
      FROM {captures} c JOIN pages p ON c.page_id = p.page_id
      WHERE regexp_matches(html, '<title>(.*?)</title>')"""
    last_event = """SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY user_id
      ORDER BY event_id DESC) AS rn FROM events {where}) WHERE rn = 1"""
    imported_cdx = (
        f"{index}, {O.TEXTS} " + O.extracted(O.latest(f"SELECT * {listed}"))
    )
    page_texts = f"""WITH {O.TEXTS} SELECT page_id, url, text FROM texts
        JOIN (SELECT page_id AS id, url FROM pages) ON id = page_id"""
    llm = llm_queries.oracle_sql() if llm_queries else {}
    if llm_queries and corpus_pipeline.ORACLE_SQL:
        llm["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {
        **llm,
        "index_scan": f"""{index} SELECT capture_id, url, url_host_name, fetch_status, crawl, subset
            FROM ccindex WHERE crawl = '{NEWEST}' AND subset = 'warc'""",
        "html_captures": f"{index} SELECT capture_id, url, url_path FROM html_captures",
        "host_select": f"""{index} SELECT capture_id, url, url_host_name FROM ccindex
            WHERE url_host_name = (SELECT url_host_name FROM ccindex GROUP BY 1
                                   ORDER BY count(*) DESC, 1 LIMIT 1)""",
        "domain_select": f"""{index} SELECT capture_id, url, url_host_registered_domain
            FROM ccindex WHERE {in_domain}""",
        "regex_select": f"{index} SELECT capture_id, url FROM html_captures WHERE {patterns}",
        "scope_select": f"""{index} SELECT capture_id, url FROM {O.latest(
            "SELECT * FROM html_captures WHERE url_host_registered_domain = 'example.org' "
            "AND regexp_matches(url, '^https?://([^/]+[.])?example[.]org/en(/.*)?$')")}""",
        "latest_per_url": f"""{index} SELECT url, fetch_epoch, capture_id
            FROM {O.latest("SELECT * FROM html_captures")}""",
        "latest_topk": f"""{index} SELECT url, fetch_epoch, capture_id
            FROM {O.latest(f"SELECT * FROM html_captures WHERE {in_domain}")} ORDER BY url LIMIT 25""",
        "custom_select": f"""{index} SELECT c.url, {O.TIME14} AS timestamp,
              content_mime_detected AS mime, true AS placed
            FROM (SELECT * FROM ccindex WHERE crawl = '{NEWEST}') c
            JOIN (SELECT url_host_name, max(fetch_epoch) AS newest FROM ccindex
                  WHERE crawl = '{NEWEST}' GROUP BY url_host_name) h
              ON c.url_host_name = h.url_host_name AND c.fetch_epoch = h.newest""",
        "latest_crawl": f"{index} SELECT max(crawl) AS crawl FROM ccindex",
        "timestamp14": """SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS of_time,
              strftime(ts, '%Y%m%d%H%M%S') AS of_text, props AS of_short,
              strftime(make_timestamp(event_id * 1000000), '%Y%m%d%H%M%S') AS of_instant
            FROM events""",
        "normalize_host": """SELECT page_id, h AS of_url, h AS of_name, h AS of_dotted FROM
            (SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS h FROM pages)""",
        "charset_of": """SELECT page_id, regexp_extract(html, '<meta charset="([^"]*)"', 1) AS declared,
              regexp_extract(html, '<html lang="([a-z]*)"', 1) || '-1 x' AS encoded, 'utf-8' AS absent
            FROM pages""",
        "content_type": f"""{index} SELECT capture_id, coalesce(nullif(
              regexp_extract(url, '[?]utm_source=(.*)$', 1), ''), url_path, '') AS content_type
            FROM ccindex""",
        "warc_date": """SELECT event_id,
              CASE WHEN microsecond(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
                   ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS exact,
              strftime(ts - INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%SZ') AS shifted,
              strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS compact,
              strftime(ts, '%Y-%m-%dT00:00:00Z') AS day, props AS kept FROM events""",
        "html_text": page_texts,
        "decode_body": page_texts,
        "warc_read": f"""{index} SELECT c.url, {O.ISO_TIME} AS date, {O.CONTENT_TYPE} AS content_type,
              CASE WHEN c.page_id IS NULL THEN {O.ROBOTS} ELSE html END AS html
            FROM ccindex c LEFT JOIN pages p ON c.page_id = p.page_id""",
        "extract_default": f"{index}, {O.TEXTS} {O.extracted('ccindex')}",
        "extract_custom": f"{index} {titles.format(columns='', captures='ccindex')}",
        "extract_lateral": f"{index} {titles.format(columns='', captures='ccindex')}",
        "record_scan": f"""{index} SELECT url, {O.ISO_TIME} AS date, {O.CONTENT_TYPE} AS content_type
            FROM ccindex WHERE starts_with(url, 'https://')""",
        "import_domain": f"{index}, {O.TEXTS} "
        + O.extracted(O.latest(f"{newest_html} AND {in_domain}")),
        "import_query": f"{index} "
        + titles.format(
            columns="",
            captures=O.latest(f"SELECT * FROM ccindex WHERE crawl = '{NEWEST}' AND fetch_status = 200"),
        ),
        "import_grow": f"""{index} SELECT c.url, strlen(html) AS size,
              nullif(regexp_extract(html, '<html lang="(en|fr)"', 1), '') AS lang
            FROM {O.latest(f"{newest_html} AND {in_domain}")} c JOIN pages p ON c.page_id = p.page_id""",
        "import_scope": f"{index}, {O.TEXTS} "
        + O.extracted(
            O.latest(
                f"{newest_html} AND url_host_registered_domain = 'example.com' "
                "AND regexp_matches(url, '^https?://([^/]+[.])?example[.]com(/.*)?$')"
            )
        ),
        "import_counters": f"""{index} SELECT count(*) AS matched,
              count(*) FILTER (titled) AS imported, count(*) FILTER (NOT titled) AS skipped,
              count(*) AS files_read, count(*) AS requests, 1::BIGINT AS all_bytes_read
            FROM (SELECT regexp_matches(html, '<title>(.*?)</title>') AS titled
                  FROM {O.latest(f"{newest_html} AND {in_domain}")} c
                  JOIN pages p ON c.page_id = p.page_id)""",
        "imported_count": "SELECT count(DISTINCT (user_id, event_id // 100)) AS imported FROM events",
        "empty_import": """SELECT 0::BIGINT AS table_rows, 'url,date,content_type,text' AS columns,
              count(*) AS matched, count(*) AS imported
            FROM pages WHERE regexp_matches(url, '^[a-z]+://([^/]*[.])?absent[.]invalid(/|$)')""",
        "cdx_select": f"""{index} SELECT url, {O.TIME14} AS timestamp,
              content_mime_detected AS mime {listed} AND {patterns}""",
        "cdx_limit": f"""{index} SELECT url, {O.TIME14} AS timestamp,
              content_mime_detected AS mime {listed} ORDER BY url, fetch_epoch LIMIT 40""",
        "import_cdx": imported_cdx,
        "import_stream": imported_cdx,
        "import_rows": imported_cdx,
        "upsert": f"""SELECT l.user_id, l.event_id, l.event_type, b.props
            FROM ({last_event.format(columns="*", where="")}) l LEFT JOIN
              ({last_event.format(columns="*", where=f"WHERE ts < '{LAST_DAY}'")}) b
              ON l.user_id = b.user_id""",
        "dedupe_last": """SELECT user_id, max(event_id) AS event_id,
              arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value,
              min(event_id) AS first_event FROM events GROUP BY user_id""",
        "stream_upsert": last_event.format(columns="event_id, user_id, event_type, props", where=""),
        "progress_events": f"""SELECT batch, stage, matched,
              CASE WHEN stage = 'batch_merged' THEN users ELSE 0 END AS imported,
              CASE stage WHEN 'record_matched' THEN matched
                         WHEN 'record_extracted' THEN users ELSE 0 END AS pending
            FROM (SELECT {" ".join(f"CASE WHEN ts < '{w}' THEN {n} ELSE" for n, w in enumerate(WEEKS))}
                         {len(WEEKS)} {"END " * len(WEEKS)}::BIGINT AS batch,
                         count(*) AS matched, count(DISTINCT user_id) AS users
                  FROM events GROUP BY 1),
              unnest(['record_matched', 'record_extracted', 'batch_merged']) AS s(stage)""",
        "schema_evolve": """SELECT event_id, event_type, user_id,
              CASE WHEN event_type = 'purchase' THEN props END AS props FROM events""",
        "target_address": """SELECT user_id, max(event_id) AS event_id, 'crawls__by_user' AS namespace
            FROM events GROUP BY user_id""",
    }
