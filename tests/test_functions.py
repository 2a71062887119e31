
import random
import re

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from crawltable.functions import columns as C
from crawltable.functions.bodies import body_text, charset_name, utc_date, visible_text
from crawltable.functions.sites import normalize_host, split_site
from crawltable.operators.extract import html_text


def column_values(spark, values, function):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v string")
    return [r[0] for r in rows.orderBy("id").select(function(F.col("v"))).collect()]


def test_timestamp14(spark):
    rows = spark.sql(
        "SELECT timestamp'2024-01-02 03:04:05.9+02:00' a, timestamp_ntz'2024-03-10 02:30:00' b, "
        "date'2024-01-02' c, 20240102030405678L d, cast(null as timestamp) e, "
        "'2024-01-03T04:05:06+09:00' f, '2024' g, timestamp'1969-12-31 23:59:59Z' h, "
        "timestamp'2024-11-03 06:30:00Z' i"
    )
    stamps = rows.select(*(C.timestamp14(F.col(f.name), f.dataType).alias(f.name) for f in rows.schema))
    assert stamps.first() == (
        "20240102010405", "20240310023000", "2024-01-02", "20240102030405", "",
        "20240103040506", "2024", "19691231235959", "20241103063000",
    )


CHARSETS = {
    "text/html; charset=windows-1252": "windows-1252",
    "text/html;CHARSET = utf-16 ;x=1": "utf-16",
    "text/html; charset=; charset=b": "b",
    "text/html; charset=a+b": "a b",
    "text/html; charset=%75tf-8": "utf-8",
    'text/html; charset="utf-8"': '"utf-8"',
    "text/html; x&charset=k": "k",
    "text/html; charset": "utf-8",
    "text/html; charset=a=b": "a=b",
    "text/html": "utf-8",
    "": "utf-8",
}


def test_charset(spark):
    assert column_values(spark, CHARSETS, C.charset_of) == list(CHARSETS.values())
    assert [charset_name(v) for v in CHARSETS] == list(CHARSETS.values())


def test_content_type(spark):
    rows = spark.sql("SELECT * FROM VALUES ('h', 'r'), ('', 'r'), (null, 'r'), ('', null), (null, '') AS t(h, r)")
    kinds = [r[0] for r in rows.select(C.content_type(F.col("h"), F.col("r"))).collect()]
    assert kinds == ["h", "r", "r", "", ""]


DATES = {
    "2024-01-01T00:00:00Z": "2024-01-01T00:00:00Z",
    "2024-01-01T00:00:00.5Z": "2024-01-01T00:00:00.500000Z",
    "2024-01-01T00:00:00.123456789Z": "2024-01-01T00:00:00.123456Z",
    "2024-01-01T00:00:00.000Z": "2024-01-01T00:00:00Z",
    "2024-01-01T01:00:00+02:00": "2023-12-31T23:00:00Z",
    "2024-01-01T01:00:00-0530": "2024-01-01T06:30:00Z",
    "2024-01-01T01:00+02": "2023-12-31T23:00:00Z",
    "20240101T000000Z": "2024-01-01T00:00:00Z",
    "2024-01-01 10:20": "2024-01-01T10:20:00Z",
    "2024-01-01": "2024-01-01T00:00:00Z",
    "2024-03-10T02:30:00": "2024-03-10T02:30:00Z",
    "2024-13-01T00:00:00Z": "2024-13-01T00:00:00Z",
    "yesterday": "yesterday",
    "2024": "2024",
    "": "",
}


def test_warc_date(spark):
    assert column_values(spark, DATES, C.warc_date) == list(DATES.values())
    assert [utc_date(v) for v in DATES] == list(DATES.values())
    assert column_values(spark, [None], C.warc_date) == [""]


def test_host_key(spark):
    sites = ["https://A.com:80/x?y", "A.com/x", " .a.com. ", "a.com?x", "//a.com"]
    hosts = ["a.com:80", "a.com", "a.com", "a.com", "a.com"]
    assert column_values(spark, sites, C.host_key) == hosts
    with pytest.raises(PySparkException, match="without a host"):
        column_values(spark, ["/path"], C.host_key)


PAGES = {
    "<!doctype html><style>p { top: 0 }</style><ul><li>one</li> <li> two<i>three</i></ul>": "one two three",
    "<title> A  b </title><p>c&amp;d &eacute;": "A  b c&d é",
    "<script>var t='<p>x</p>';</script>y<!-- z -->": "y",
    "a<noscript>b<p>c": "a",
    "a</style>b<NOSCRIPT>c</NoScript >d": "a b d",
    "<noscript><noscript>a</noscript>b</noscript>c": "c",
    "1 < 2 & 3": "1 < 2 & 3",
    "  x  ": "x",
    "": "",
}


def test_visible_text():
    assert {page: visible_text(page) for page in PAGES} == PAGES


@given(st.text(alphabet="<>/!-&; abscript\"'=", max_size=60))
def test_text_pieces_are_stripped_and_never_fail(markup):
    text = visible_text(markup)
    assert text == text.strip()


def test_body_text():
    assert body_text("é<p>".encode("latin-1"), "text/plain; charset=latin-1") == "é<p>"
    assert body_text("é<p>".encode("latin-1"), "TEXT/HTML; charset=latin-1") == "é"
    assert body_text(b"\xff<a>b</a>", "application/xml") == "� b"
    assert body_text("か".encode("shift_jis"), "text/plain; charset=shift_jis") == "か"
    assert body_text(b"x", 'text/html; charset="utf-8"') == "x"
    with pytest.raises(LookupError):
        body_text(b"x", "text/html; charset=nonsense")


def test_html_text_takes_binary_and_text_columns(spark):
    rows = spark.createDataFrame(
        [(1, b"<p>a\xe9", "text/html; charset=latin-1"), (2, b" plain ", None), (3, None, "text/html")],
        "id int, body binary, kind string",
    )
    texts = html_text(rows, "body", "kind").orderBy("id").collect()
    assert [r.text for r in texts] == ["aé", " plain ", None]
    assert texts[0].asDict().keys() == {"id", "body", "kind", "text"}
    plain = spark.createDataFrame([("<p>a", "text/html")], "body string, kind string")
    assert html_text(plain, "body", "kind").first().text == "a"


def test_an_unknown_charset_fails_the_job(spark):
    rows = spark.createDataFrame([(b"a", "text/html; charset=nonsense")], "body binary, kind string")
    with pytest.raises(PySparkException, match="nonsense"):
        html_text(rows, "body", "kind").collect()


def test_only_bodies_go_through_python(spark):
    rows = spark.createDataFrame([("<p>a", "text/html", 1)], "body string, kind string, extra int")
    plan = html_text(rows, "body", "kind")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"ArrowEvalPython \[extract\(body#\d+, ", plan) and "extra#" in plan
    assert not re.search(r"extract\([^)]*extra#", plan)


def both_forms(spark, values, column, plain):
    def attempt(value):
        try:
            return plain(value)
        except ValueError:
            return None

    rows = spark.createDataFrame([(n, v) for n, v in enumerate(values)], "n int, v string")
    rows = rows.orderBy("n").select(column(F.col("v")).alias("found")).collect()
    assert [r.found for r in rows] == [attempt(v) for v in values]


def random_texts(parts, n, seed):
    pick = random.Random(seed)
    return ["".join(pick.choices(parts, k=pick.randint(0, 9))) for _ in range(n)]


def test_both_forms_of_charset_agree(spark):
    parts = [
        "charset", "Charset", "=", "=", ";", "&", " ", "\t", "\n", "\xa0", "\u2003", "latin-1", "utf-16", "a", "+",
        "%", "%2", "%zz", "%20", "%63harset", "%C3%A9", "%3D", "%3b", "é", "\x1f", "text/html",
    ]
    values = random_texts(parts, 3000, 1) + ["text/html;\tcharset=latin-1", "charset=\tutf-16", "charset=a%20b%zz", "charset=%"]
    assert charset_name(values[-4]) == "latin-1" and charset_name(values[-2]) == "a b%zz"
    both_forms(spark, values, C.charset_of, charset_name)


def test_both_forms_of_host_agree(spark):
    parts = ["a.com", "WWW.", ".", " ", "\t", "\n", "\x0b", "\xa0", "\u3000", "/", "//", "?", "#", "http:", ":80", "u@", "é", "x"]
    values = random_texts(parts, 3000, 2) + [". a.com .", "\ta.com\n", "..a.com.."]
    known = {". a.com .": " a.com ", "\ta.com\n": "a.com", "..a.com..": "a.com"}
    for value, host in known.items():
        assert normalize_host(value) == host
    fit = [v for v in values if re.search(r"[^\s./?#]", re.sub(r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//", "", v.strip()))]
    fit = [v for v in fit if split_site(v)[0].strip().strip(".")]
    assert len(fit) > 1500
    both_forms(spark, fit, C.host_key, normalize_host)
