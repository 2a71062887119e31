"""Columns by names that may hold dots, colons, spaces or backticks."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def named(*path: str) -> Column:
    """A column, or a field within one."""
    return F.col(".".join(map(quoted, path)))
