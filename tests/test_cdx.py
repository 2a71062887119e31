import bz2
import gzip
import json

import pytest
from pyspark.errors import PySparkException

from crawltable.sources.cdx import read_cdx, select_cdx


def line(at, **fields):
    capture = {
        "url": at, "timestamp": "20240101000000", "mime": "text/html", "status": "200",
        "filename": "f.warc.gz", "offset": "12", "length": "34",
    } | fields
    return json.dumps({k: v for k, v in capture.items() if v is not None})


def write_pages(folder, pages):
    for name, lines in pages.items():
        (folder / name).write_text("\n".join(lines) + "\n")
    return str(folder)


def test_lines_become_pointers(spark, tmp_path):
    path = write_pages(
        tmp_path,
        {"p.json": ["", "  " + line("https://x.com/") + "\t", "   ", line("https://x.com/2", mime=None, offset=5)]},
    )
    rows = read_cdx(spark, path).orderBy("position").drop("position").collect()
    assert rows == [
        ("https://x.com/", "20240101000000", "text/html", "f.warc.gz", 12, 34, "200"),
        ("https://x.com/2", "20240101000000", None, "f.warc.gz", 5, 34, "200"),
    ]


@pytest.mark.parametrize(
    "bad",
    [
        {"url": 1}, {"timestamp": 2024}, {"filename": ["f"]}, {"filename": None}, {"offset": "x"},
        {"offset": None}, {"length": "1.5"},
    ],
)
def test_bad_lines_fail(spark, tmp_path, bad):
    path = write_pages(tmp_path, {"p.json": [line("https://x.com/", **bad)]})
    with pytest.raises(PySparkException, match="capture line without"):
        read_cdx(spark, path).collect()


def test_broken_json_fails(spark, tmp_path):
    with pytest.raises(PySparkException, match="capture line without"):
        read_cdx(spark, write_pages(tmp_path, {"p.json": ["{"]})).collect()


def test_other_media_types_are_text(spark, tmp_path):
    path = write_pages(tmp_path, {"p.json": [line("https://x.com/", mime=7)]})
    assert read_cdx(spark, path).first().mime == "7"


def test_pages_are_taken_by_number_and_missing_ones_count_as_empty(spark, tmp_path):
    pages = {f"page-{n}.json": [line(f"https://x.com/{n}/{i}") for i in range(3)] for n in (0, 2, 10)}
    cdx = read_cdx(spark, write_pages(tmp_path, pages))
    urls = [r.url for r in select_cdx(cdx, "x.com", limit=7).collect()]
    assert urls == [f"https://x.com/{n}/{i}" for n, i in [(0, 0), (0, 1), (0, 2), (2, 0), (2, 1), (2, 2), (10, 0)]]
    assert select_cdx(cdx, "x.com", limit=0).count() == 0


@pytest.mark.parametrize("ending, pack", [("jsonl.bz2", bz2.compress), ("json.gz", gzip.compress)])
def test_endings_are_no_page_numbers(spark, tmp_path, ending, pack):
    for n in (2, 10, 9):
        (tmp_path / f"page-{n}.{ending}").write_bytes(pack(line(f"https://x.com/{n}").encode()))
    captures = select_cdx(read_cdx(spark, str(tmp_path)), "x.com", limit=3)
    assert [r.url for r in captures.collect()] == [f"https://x.com/{n}" for n in (2, 9, 10)]


def test_no_page_at_all_is_empty(spark, tmp_path):
    cdx = read_cdx(spark, str(tmp_path / "none"))
    assert select_cdx(cdx, "x.com").count() == 0


def test_selection(spark, tmp_path):
    lines = [
        line("https://x.com/a"),
        line("https://WWW.x.com:443/robots.txt", mime="text/plain"),
        line("https://user@x.com/b", status="404"),
        line("https://x.com.evil.org/"),
        line("https://notx.com/"),
        line("https://x.com/c", status=None),
        line("https://x.com/a"),
    ]
    cdx = read_cdx(spark, write_pages(tmp_path, {"p.json": lines}))

    def urls(*args, **kwargs):
        return [r.url for r in select_cdx(cdx, *args, **kwargs).collect()]

    assert urls("x.com", "host") == ["https://x.com/a", "https://x.com/c", "https://x.com/a"]
    assert len(urls("X.com")) == 4
    assert urls("x.com", url_patterns=["/[ab]$", "^https"]) == ["https://x.com/a"] * 2
    with pytest.raises(ValueError):
        urls("x.com", "prefix")
