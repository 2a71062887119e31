from datetime import datetime

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from crawltable.functions.sites import normalize_host, pattern_list, scope_patterns
from crawltable.operators.ordering import first_rows, with_arrival_index
from crawltable.operators.pointers import select_with_query, to_pointers
from crawltable.operators.select import (
    html_captures,
    latest_per_url,
    matching_urls,
    on_site,
    select_captures,
)
from crawltable.sources.index import (
    index_location,
    latest_crawl,
    object_store_options,
    open_index,
    scan_index,
)

INDEX = (
    "url string, url_host_name string, url_host_registered_domain string, url_path string, "
    "content_mime_detected string, fetch_status int, fetch_time timestamp, "
    "warc_filename string, warc_record_offset bigint, warc_record_length bigint"
)


def capture(url="https://a.x.com/p", path="/p", mime="text/html", status=200, time=None, file="f", offset=0):
    return (url, "a.x.com", "x.com", path, mime, status, time, file, offset, 10)


def index_of(spark, *rows):
    return spark.createDataFrame(list(rows), INDEX)


def test_html_captures_keeps_null_paths_and_drops_robots_in_any_case(spark):
    index = index_of(
        spark,
        capture("u1", path=None),
        capture("u2", path="/ROBOTS.txt"),
        capture("u3", status=404),
        capture("u4", status=None),
        capture("u5", mime="text/html "),
        capture("u6", path="/robots.txt.html"),
    )
    assert [r.url for r in html_captures(index).orderBy("url").collect()] == ["u1", "u6"]


def test_domain_match_does_not_strip_www(spark):
    index = index_of(spark, capture())
    assert on_site(index, "x.com").count() == 1
    assert on_site(index, "www.x.com").count() == 0
    assert on_site(index, "A.X.com", "host").count() == 1
    with pytest.raises(ValueError):
        on_site(index, "x.com", "prefix")


def test_every_pattern_must_be_found_and_quotes_are_safe(spark):
    index = index_of(spark, capture("https://x.com/it's"), capture("https://x.com/its"))
    assert matching_urls(index, ["x[.]com", "it's"]).count() == 1
    assert matching_urls(index, r"x\.com").count() == 2
    assert matching_urls(index, None).count() == 2
    assert matching_urls(index, r"x\.co\b").count() == 0


def test_latest_prefers_unknown_then_newest_then_file_and_offset(spark):
    index = index_of(
        spark,
        capture("u1", time=datetime(2024, 1, 1)),
        capture("u1", time=datetime(2024, 1, 3), offset=7),
        capture("u1", time=datetime(2024, 1, 2)),
        capture("u2", time=datetime(2024, 1, 1)),
        capture("u2", time=None, offset=5),
        capture("u3", time=datetime(2024, 1, 1), file="a", offset=9),
        capture("u3", time=datetime(2024, 1, 1), file="b", offset=1),
        capture("u3", time=datetime(2024, 1, 1), file="b", offset=2),
    )
    rows = latest_per_url(index).orderBy("url").collect()
    assert [(r.url, r.warc_record_offset) for r in rows] == [("u1", 7), ("u2", 5), ("u3", 2)]


def test_filters_come_before_the_latest_rule(spark):
    index = index_of(
        spark,
        capture("https://x.com/a", time=datetime(2024, 1, 1), offset=1),
        capture("https://x.com/a", time=datetime(2024, 1, 2), offset=2, status=404),
    )
    assert [r.warc_record_offset for r in select_captures(index, "x.com").collect()] == [1]


def test_limit_is_taken_after_the_sort(spark):
    index = index_of(spark, *(capture(f"u{i}") for i in (3, 1, 2)))
    assert [r.url for r in select_captures(index, "x.com", limit=2).collect()] == ["u1", "u2"]
    assert select_captures(index, "x.com", limit=0).count() == 0


def test_limits_of_any_size_have_one_plan(spark):
    rows = spark.range(0, 60_000, 1, 16).withColumn("k", (F.col("id") * 7919) % 60_000)
    for limit in (10_000, 10_001, 25_000):
        first = first_rows(rows, ["k"], limit)
        assert "TakeOrderedAndProject" in first._jdf.queryExecution().executedPlan().toString()
        assert first.agg(F.count("*"), F.max("k")).first() == (limit, limit - 1)


def test_arrival_index_is_dense_and_ordered(spark, tmp_path):
    rows = spark.range(0, 5_000, 1, 16).withColumn("k", (F.col("id") * 31) % 5_000)
    numbered = with_arrival_index(rows, ["k"], folder=str(tmp_path / "arrival"))
    assert numbered.where(F.col("k") != F.col("arrival")).count() == 0
    assert numbered.count() == 5_000


def test_plans(spark, tmp_path):
    root = str(tmp_path / "index")
    index = index_of(spark, capture()).withColumns({"crawl": F.lit("C1"), "subset": F.lit("warc")})
    index.write.partitionBy("crawl", "subset").parquet(root)

    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    selected = plan(select_captures(scan_index(spark, root, "C1"), "x.com", limit=5))
    assert selected.count("WindowGroupLimit") == 2
    assert "TakeOrderedAndProject" in selected
    for pushed in ("EqualTo(fetch_status,200)", "EqualTo(url_host_registered_domain,x.com)"):
        assert pushed in selected
    pruned = plan(open_index(spark, root).where("crawl = 'C1' AND subset = 'warc'").select("url"))
    assert "PartitionFilters: [isnotnull(crawl" in pruned
    assert "ReadSchema: struct<url:string>" in pruned


def test_index_paths(spark, tmp_path):
    assert index_location("s3://b/t/", "C1") == ("s3://b/t", "s3://b/t/crawl=C1/subset=warc")
    given = "s3://b/t/crawl=C2/subset=warc"
    assert index_location(given + "/", "C1") == ("s3://b/t", given)
    assert index_location("s3://b/t/crawl=C2", "C1") == ("s3://b/t", "s3://b/t/crawl=C2")
    assert index_location("/t/subset=warc", "C1") == ("/t", "/t/subset=warc")

    root = str(tmp_path / "index")
    rows = [("a", "C1", "warc"), ("b", "C2", "warc"), ("c", "C2", "robotstxt")]
    spark.createDataFrame(rows, "url string, crawl string, subset string").write.partitionBy(
        "crawl", "subset"
    ).parquet(root)
    assert scan_index(spark, root + "/", "C2").collect() == [("b", "C2", "warc")]
    assert scan_index(spark, root + "/crawl=C1/subset=warc", "C2").collect() == [("a", "C1", "warc")]
    assert scan_index(spark, root, "C2", "robotstxt").count() == 1
    assert sorted(open_index(spark, root + "/crawl=C1/").collect()) == [("a", "C1", "warc")]
    assert latest_crawl(spark, root).first().crawl == "C2"
    assert latest_crawl(spark, root + "/crawl=C1/").first().crawl == "C2"


def test_the_latest_crawl_is_found_without_opening_a_file(spark, tmp_path):
    for crawl in ("2024-05", "2024-10"):
        folder = tmp_path / f"crawl={crawl}" / "subset=warc"
        folder.mkdir(parents=True)
        (folder / "part-0.parquet").write_bytes(b"no parquet")
    assert latest_crawl(spark, str(tmp_path)).first().crawl == "2024-10"


def test_latest_crawl_of_nothing_fails(spark, tmp_path):
    with pytest.raises(ValueError, match="no crawl"):
        latest_crawl(spark, str(tmp_path))


def test_object_store_options():
    anonymous = object_store_options("s3://bucket/t/", {})
    assert anonymous == {
        "fs.s3a.bucket.bucket.requester.pays.enabled": "true",
        "fs.s3a.bucket.bucket.endpoint.region": "us-east-1",
        "fs.s3a.bucket.bucket.aws.credentials.provider": "org.apache.hadoop.fs.s3a.AnonymousAWSCredentialsProvider",
    }
    assert len(object_store_options("s3a://bucket/t/", {"AWS_PROFILE": "p"})) == 2
    assert object_store_options("/local/path", {}) == {}
    with pytest.raises(ValueError):
        object_store_options("s3:///t", {})


@pytest.mark.parametrize(
    "site, host",
    [
        ("https://WWW.Example.com/a?b", "www.example.com"),
        ("Example.com/path", "example.com"),
        (" .example.com. ", "example.com"),
        ("https://user@a.com:8080/x", "user@a.com:8080"),
        ("www.a.com:8080", "www.a.com:8080"),
        ("//a.com/x", "a.com"),
        ("a.com?q=1", "a.com"),
    ],
)
def test_normalize_host(site, host):
    assert normalize_host(site) == host


@pytest.mark.parametrize("site", ["", " ", "https://", "/path", "..."])
def test_a_site_needs_a_host(site):
    with pytest.raises(ValueError):
        normalize_host(site)


def test_pattern_list():
    assert pattern_list(None) == []
    assert pattern_list("a") == ["a"]
    assert pattern_list(("a", "b")) == ["a", "b"]


def test_scopes(spark):
    assert scope_patterns("https://www.amazon.com")[0] == "www.amazon.com"
    assert scope_patterns("https://www.amazon.com", "domain")[0] == "amazon.com"
    urls = [
        "https://www.amazon.com",
        "http://www.amazon.com/deals/x",
        "https://www.amazon.com/dealsx",
        "https://smile.amazon.com/deals",
        "https://amazon.com/",
        "https://notamazon.com/",
        "https://www.amazon.com/deals\n",
        "https://wwwxamazon.com/",
    ]
    table = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "id int, url string")

    def within(url, scope):
        pattern = scope_patterns(url, scope)[1]
        return [r.id for r in matching_urls(table, pattern).orderBy("id").collect()]

    assert within("https://www.amazon.com", "host") == [0, 1, 2]
    assert within("www.amazon.com/deals/", "host") == [1]
    assert within("https://www.amazon.com/", "domain") == [0, 1, 2, 3, 4]
    assert within("https://www.amazon.com/deals", "domain") == [1, 3]
    for bad in (("", "host"), ("https:///x", "domain"), ("a.com", "page")):
        with pytest.raises(ValueError):
            scope_patterns(*bad)


RAW = (
    "url string, fetch_time string, content_mime_detected string, warc_filename string, "
    "warc_record_offset bigint, warc_record_length bigint"
)


def test_pointers_of_raw_names_and_text_times(spark):
    rows = spark.createDataFrame([("u", "2024-01-03 04:05:06", "text/html", "f", 1, 2)], RAW)
    assert to_pointers(rows).collect() == [("u", "20240103040506", "text/html", "f", 1, 2)]


def test_pointers_of_canonical_names(spark):
    rows = spark.sql(
        "SELECT 'u' url, timestamp'2024-01-02 00:00:00Z' timestamp, 'm' mime, 'f' filename, "
        "'12' offset, 3 length, null warc_filename"
    )
    assert to_pointers(rows).collect() == [("u", "20240102000000", "m", "f", 12, 3)]


def test_the_first_name_present_wins_even_if_null(spark):
    rows = spark.sql("SELECT 'u' url, null mime, 'm' content_mime_detected, 'f' filename, 1 offset, 2 length")
    assert to_pointers(rows).collect() == [("u", "", None, "f", 1, 2)]


@pytest.mark.parametrize(
    "columns",
    [
        "'' url, 'f' filename, 1 offset, 2 length",
        "null url, 'f' filename, 1 offset, 2 length",
        "'u' url, 7 filename, 1 offset, 2 length",
        "'u' url, 'f' filename, 'x' offset, 2 length",
        "'u' url, 'f' filename, 1 offset, null length",
        "'u' url, 'f' filename, 1 offset",
        "'u' url, 'f' filename, null offset, null warc_record_offset, 2 length",
    ],
)
def test_bad_pointers_fail(spark, columns):
    with pytest.raises((ValueError, PySparkException), match="selection must return"):
        to_pointers(spark.sql(f"SELECT {columns}")).collect()


def test_custom_query(spark):
    index = index_of(spark, capture("u1"), capture("u2"))
    query = "SELECT url, warc_filename FROM ccindex;"
    assert select_with_query(index, query, 1).count() == 1
    assert select_with_query(index, query).count() == 2
    with pytest.raises(ValueError):
        select_with_query(index, "  ")
    with pytest.raises(AnalysisException):
        select_with_query(index, "SELECT nothing FROM ccindex")
