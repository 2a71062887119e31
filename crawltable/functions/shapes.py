"""Types of columns that are found in rows, whatever order the rows come in.

A type is joined with another by its structure: null gives way to anything, also inside
lists and structs, whole numbers widen to fractions, and structs have the fields of
both. Joining is commutative and associative, so it does not matter how rows are
batched. Fields of nested structs are in alphabetical order for the same reason.
"""

from collections.abc import Iterable
from functools import reduce

import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

_LEAVES = {
    bool: T.BooleanType(),
    int: T.LongType(),
    float: T.DoubleType(),
    str: T.StringType(),
    bytes: T.BinaryType(),
}


def shape_of(value) -> T.DataType:
    """Type of one value; an empty list or mapping says nothing about what is in it."""
    if value is None:
        return T.NullType()
    if type(value) in _LEAVES:
        return _LEAVES[type(value)]
    if isinstance(value, dict):
        return _struct({name: shape_of(item) for name, item in value.items()})
    if isinstance(value, (list, tuple)):
        return T.ArrayType(joined(map(shape_of, value)))
    return from_arrow_type(pa.infer_type([value]))


def joined(shapes: Iterable[T.DataType]) -> T.DataType:
    return reduce(_join, shapes, T.NullType())


def _struct(fields: dict[str, T.DataType]) -> T.DataType:
    if not fields:
        return T.NullType()
    return T.StructType([T.StructField(name, fields[name]) for name in sorted(fields)])


def _join(one: T.DataType, two: T.DataType) -> T.DataType:
    if one == two or isinstance(two, T.NullType):
        return one
    if isinstance(one, T.NullType):
        return two
    if {type(one), type(two)} == {T.LongType, T.DoubleType}:
        return T.DoubleType()
    if isinstance(one, T.ArrayType) and isinstance(two, T.ArrayType):
        return T.ArrayType(_join(one.elementType, two.elementType))
    if isinstance(one, T.StructType) and isinstance(two, T.StructType):
        left, right = ({f.name: f.dataType for f in s} for s in (one, two))
        return _struct({n: joined(s[n] for s in (left, right) if n in s) for n in left | right})
    raise TypeError(f"{one.simpleString()} and {two.simpleString()}")


def settled(shape: T.DataType) -> T.DataType:
    """The type to store: what is null throughout becomes text."""
    if isinstance(shape, T.NullType):
        return T.StringType()
    if isinstance(shape, T.ArrayType):
        return T.ArrayType(settled(shape.elementType))
    if isinstance(shape, T.StructType):
        return T.StructType([T.StructField(f.name, settled(f.dataType)) for f in shape])
    return shape


def table_schema(declared: T.StructType | None, found: T.StructType, key: str) -> T.StructType:
    """Columns of a table: the declared ones as they are, then the others that rows have.

    The key must be among them and is never null.
    """
    known = declared.names if declared else []
    columns = [*(declared or ()), *(f for f in found if f.name not in known)]
    if key not in (f.name for f in columns):
        raise ValueError(f"the rows lack the key column {key!r}")
    return T.StructType(
        [T.StructField(f.name, settled(f.dataType), f.nullable and f.name != key) for f in columns]
    )
