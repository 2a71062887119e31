"""Column expressions; all of them stay inside the JVM."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters that Python's str.strip() takes for white space.
WHITE_SPACE = r"[\x09-\x0D\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, rf"\A{WHITE_SPACE}+|{WHITE_SPACE}+\z", "")


def _utc_text(time: Column) -> Column:
    """``2024-01-02 03:04:05[.6]`` in UTC, whatever the session zone is."""
    seconds = (F.unix_micros(time) / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return (epoch + F.make_dt_interval(secs=seconds)).cast("string")


def timestamp14(value: Column, data_type: T.DataType) -> Column:
    """``yyyyMMddHHmmss`` in UTC of a time, or the first 14 digits of a text.

    Texts with fewer digits are kept and null gives the empty text. Times without
    a zone count as UTC.
    """
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        text = _utc_text(value) if isinstance(data_type, T.TimestampType) else value.cast("string")
        stamp = F.translate(F.substring(text, 1, 19), "- :", "")
    else:
        text = value.cast("string")
        digits = F.regexp_replace(text, "[^0-9]", "")
        stamp = F.when(F.length(digits) >= 14, F.substring(digits, 1, 14)).otherwise(text)
    return F.coalesce(stamp, F.lit(""))


def url_host(url: Column) -> Column:
    """Lower-case host of an absolute URL, without user part and port."""
    return F.lower(
        F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    )


def host_key(site: Column) -> Column:
    """Column form of ``normalize_host``; a row without a host fails."""
    rest = F.regexp_replace(stripped(site), r"\A(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//", "")
    host = F.lower(F.btrim(stripped(F.regexp_extract(rest, r"\A([^/?#]*)", 1)), F.lit(".")))
    return F.when(host != "", host).otherwise(F.raise_error(F.lit("site without a host")))


def content_type(http_value: Column, record_value: Column) -> Column:
    """HTTP header unless empty, else the archive record's, else the empty text."""
    return F.coalesce(F.nullif(http_value, F.lit("")), record_value, F.lit(""))


def charset_of(content_type: Column) -> Column:
    """First non-blank ``charset`` parameter, URL-decoded; ``utf-8`` without one.

    A per cent sign that begins no escape stands for itself.
    """

    def decoded(text: Column) -> Column:
        return stripped(F.url_decode(F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25")))

    def charset(parameter: Column) -> Column:
        name = F.substring_index(parameter, "=", 1)
        value = decoded(F.regexp_extract(parameter, r"(?s)=(.*)", 1))
        return F.when((F.lower(decoded(name)) == "charset") & (value != ""), value)

    found = F.filter(F.transform(F.split(content_type, "[;&]"), charset), lambda c: c.isNotNull())
    return F.coalesce(F.try_element_at(found, F.lit(1)), F.lit("utf-8"))


def warc_date(text: Column) -> Column:
    """ISO date and time as UTC with a ``Z``; text that is none is kept.

    The fraction is shown only where it is not zero, always with six digits. Each step
    uses the one before once, and the usual form is its own result.
    """
    usual = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"
    shape = (
        r"^(\d{4})-?(\d{2})-?(\d{2})"
        r"(?:[^0-9](\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d{1,6})\d*)?)?)?"
        r"(Z|[+-]\d{2}(?::?\d{2})?)?)?$"
    )
    # Parts that are not given leave a gap, which is filled next.
    iso = F.regexp_replace(F.when(text.rlike(shape), text), shape, "$1-$2-$3T$4:$5:$6.$7$8")
    for gap, filled in (("T:", "T00:"), ("::", ":00:"), (":.", ":00.")):
        iso = F.replace(iso, F.lit(gap), F.lit(filled))
    iso = F.regexp_replace(iso, r"[.](?=[^0-9]|$)", ".0")
    iso = F.regexp_replace(iso, r"([.][0-9]+)$", "$1Z")
    utc = F.replace(_utc_text(iso.try_cast("timestamp")), F.lit(" "), F.lit("T"))
    padded = F.regexp_replace(F.regexp_replace(utc, r"([.]\d+)$", "$1" + "0" * 5), r"([.]\d{6})\d*$", "$1")
    return F.coalesce(
        F.when(text.rlike(usual), text).otherwise(F.concat(padded, F.lit("Z"))), text, F.lit("")
    )
