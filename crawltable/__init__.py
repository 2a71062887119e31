"""Turn web-crawl archives into clean, queryable tables with Spark."""

from crawltable.operators.dedupe import dedupe_last
from crawltable.operators.extract import default_extract, html_text
from crawltable.operators.lateral import register_extractor
from crawltable.operators.pointers import select_with_query, to_pointers
from crawltable.operators.select import latest_per_url, select_captures
from crawltable.operators.upsert import Target, ensure_table, read_table, upsert
from crawltable.plans.imports import import_cdx, import_domain, import_scope
from crawltable.sources.archive import read_archive
from crawltable.sources.cdx import read_cdx, select_cdx
from crawltable.sources.index import latest_crawl, open_index, scan_index
from crawltable.sources.records import scan_records
from crawltable.streaming.stream import import_cdx_stream, import_stream, stream_upsert

__all__ = [
    "Target",
    "dedupe_last",
    "default_extract",
    "ensure_table",
    "html_text",
    "import_cdx",
    "import_cdx_stream",
    "import_domain",
    "import_scope",
    "import_stream",
    "latest_crawl",
    "latest_per_url",
    "open_index",
    "read_archive",
    "read_cdx",
    "read_table",
    "register_extractor",
    "scan_index",
    "scan_records",
    "select_captures",
    "select_cdx",
    "select_with_query",
    "stream_upsert",
    "to_pointers",
    "upsert",
]
