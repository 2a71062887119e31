"""Texts that sort as the values of a column do, whatever its type."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LOWEST = -(1 << 63)


def sortable(value: Column, kind: T.DataType) -> Column:
    """A text never null; null values come first, structs are compared field by field."""
    if isinstance(kind, T.StructType):
        given = F.concat(F.lit(""), *(sortable(value[f.name], f.dataType) for f in kind.fields))
    elif isinstance(kind, (T.StringType, T.VarcharType, T.CharType)):
        # Ended by two zeros, so that what follows a text does not count for its order.
        given = F.concat(F.replace(value, F.lit("\0"), F.lit("\0\1")), F.lit("\0\0"))
    else:
        given = F.lpad(F.hex(_number(value, kind).bitwiseXOR(F.lit(_LOWEST))), 16, "0")
    return F.when(value.isNull(), "0").otherwise(F.concat(F.lit("1"), given))


def _number(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        return value.cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), value)
    raise TypeError(f"rows cannot be ordered by a {kind.simpleString()}")
