"""Column types a table stores, and how any Spark type gets there.

Stored types are BIGINT, DOUBLE, STRING and, if asked for, arrays and booleans. Each rule
is one built-in expression, so a whole frame is coerced by a single projection.
"""

from __future__ import annotations

import logging
from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

logger = logging.getLogger(__name__)

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATS = (T.FloatType, T.DoubleType)
_TEXT = (T.StringType, T.CharType, T.VarcharType)


def nan_to_null(column: Column) -> Column:
    """NaN becomes NULL, infinities stay."""
    return F.nanvl(column.cast("double"), F.lit(None).cast("double"))


def _has_nested_record(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_nested_record(kind.elementType)
    return isinstance(kind, (T.StructType, T.MapType, T.BinaryType))


def _as_text(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.BinaryType):
        return F.base64(column)
    if _has_nested_record(kind):
        return F.to_json(column)
    return column.cast("string")


def _kept_element(kind: T.DataType) -> T.DataType:
    """Type an array element has once cleaned."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_kept_element(kind.elementType))
    if isinstance(kind, _INTEGERS):
        return T.LongType()
    if isinstance(kind, _FLOATS):
        return T.DoubleType()
    if isinstance(kind, T.BooleanType):
        return T.BooleanType()
    return T.StringType()


def clean_array(column: Column, kind: T.ArrayType) -> Column:
    """Keep an array; NaN and the word ``nan`` inside it become NULL."""
    inner = kind.elementType
    if isinstance(inner, T.ArrayType):
        return F.transform(column, lambda x: clean_array(x, inner))
    if isinstance(inner, _INTEGERS):
        return column if isinstance(inner, T.LongType) else column.cast("array<bigint>")
    if isinstance(inner, T.BooleanType):
        return column
    if isinstance(inner, _FLOATS):
        wide = column if isinstance(inner, T.DoubleType) else column.cast("array<double>")
        # Most arrays hold no NaN; those skip the element-wise rewrite.
        return F.when(
            F.array_contains(wide, F.lit(float("nan"))), F.transform(wide, nan_to_null)
        ).otherwise(wide)
    if isinstance(inner, _TEXT):
        return F.when(
            F.array_contains(column, F.lit("nan")),
            F.transform(column, lambda x: F.nullif(x, F.lit("nan"))),
        ).otherwise(column)
    return F.transform(column, lambda x: _as_text(x, inner))


def coerced(
    column: Column, kind: T.DataType, keep_arrays: bool = False, keep_bool: bool = False
) -> Column:
    """The stored form of one column."""
    if isinstance(kind, T.LongType):
        return column
    if isinstance(kind, _INTEGERS):
        return column.cast("bigint")
    if isinstance(kind, _FLOATS):
        return nan_to_null(column)
    if isinstance(kind, _TEXT):
        return column
    if isinstance(kind, T.BooleanType) and keep_bool:
        return column
    if isinstance(kind, T.ArrayType) and keep_arrays:
        return clean_array(column, kind)
    return _as_text(column, kind)


def coerce(
    df: DataFrame,
    keep_arrays: bool = False,
    keep_bool: bool = False,
    keep: Collection[str] = (),
    as_is: Collection[str] = (),
) -> DataFrame:
    """Coerce every column of ``df`` in one projection.

    Arrays and booleans become text unless kept, all of them or those named in ``keep``;
    columns named in ``as_is`` are left alone.
    """
    columns = []
    for f in df.schema.fields:
        if f.name in as_is:
            columns.append(F.col(f"`{f.name}`"))
            continue
        kept = f.name in keep
        column = coerced(F.col(f"`{f.name}`"), f.dataType, keep_arrays or kept, keep_bool or kept)
        columns.append(column.alias(f.name))
    return df.select(*columns)


def stored_type(kind: T.DataType, keep_arrays: bool = False, keep_bool: bool = False) -> T.DataType:
    """Type a column of type ``kind`` is stored as."""
    if isinstance(kind, _INTEGERS):
        return T.LongType()
    if isinstance(kind, _FLOATS):
        return T.DoubleType()
    if isinstance(kind, T.BooleanType) and keep_bool:
        return T.BooleanType()
    if isinstance(kind, T.ArrayType) and keep_arrays:
        return _kept_element(kind)
    return T.StringType()


def sql_type(kind: T.DataType) -> str:
    """Name of a stored type as table definitions write it."""
    if isinstance(kind, T.ArrayType):
        return f"array({sql_type(kind.elementType)})"
    return "varchar" if isinstance(kind, T.StringType) else kind.simpleString()


def derive_schema(
    schema: T.StructType, keep_arrays: bool = False, keep_bool: bool = False
) -> tuple[list[str], list[str]]:
    """Names and type names a frame of this schema is stored with."""
    names, types = [], []
    for field in schema.fields:
        name = sql_type(stored_type(field.dataType, keep_arrays, keep_bool))
        if name == "varchar" and not isinstance(field.dataType, _TEXT):
            logger.info("column %r (%s) is stored as varchar", field.name, field.dataType.simpleString())
        names.append(field.name)
        types.append(name)
    return names, types
