"""Loading into a declared schema, with or without rejecting rows."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidetable.operators.coerce import clean_array, nan_to_null
from tidetable.operators.timecols import TIME_TEXT

# Type names table definitions may use, and their Spark names.
TYPE_NAMES = {"varchar": "string", "text": "string", "long": "bigint", "integer": "int", "real": "float"}

REJECTED, REASON, ROW = "_rejected", "_reason", "_row"


def declared_type(text: str) -> T.DataType:
    """Spark type for a declared type name such as ``varchar`` or ``array(bigint)``."""
    name = re.sub(r"varchar\s*\(\s*\d+\s*\)", "varchar", text.strip().lower())
    name = re.sub(r"\w+", lambda m: TYPE_NAMES.get(m.group(), m.group()), name)
    while re.search(r"\b(array|map)\s*\(", name):
        # Innermost array(...) or map(...) first.
        changed = re.sub(r"\b(array|map)\s*\(((?:[^()]|\([\d, ]+\))*)\)", r"\1<\2>", name)
        if changed == name:
            break
        name = changed
    return T.DataType.fromDDL(name)


def declared_schema(names: Sequence[str], types: Sequence[str]) -> T.StructType:
    """Schema from parallel lists of names and types; unequal lengths raise."""
    if len(names) != len(types):
        raise ValueError(f"{len(names)} column names but {len(types)} column types")
    return T.StructType([T.StructField(n, declared_type(t)) for n, t in zip(names, types)])


def _check_columns(df: DataFrame, schema: T.StructType, evolve: bool) -> list[str]:
    extra = [c for c in df.columns if c not in schema.names and c != TIME_TEXT]
    if extra and not evolve:
        raise ValueError(f"columns not in the declared schema: {', '.join(extra)}")
    return extra


def converted(column: Column, source: T.DataType, target: T.DataType, lenient: bool = False) -> Column:
    """A column in its declared type, NaN as NULL there too; a column of that type stays as it is.

    A bad value raises, or becomes NULL if ``lenient``.
    """
    if source != target:
        column = column.try_cast(target) if lenient else column.cast(target)
    if isinstance(target, (T.FloatType, T.DoubleType)):
        return nan_to_null(column).cast(target)
    if isinstance(target, T.ArrayType) and _floats_inside(target):
        return clean_array(column, target).cast(target)
    return column


def _floats_inside(kind: T.ArrayType) -> bool:
    inner = kind.elementType
    return _floats_inside(inner) if isinstance(inner, T.ArrayType) else isinstance(inner, (T.FloatType, T.DoubleType))


def conform(df: DataFrame, schema: T.StructType, evolve: bool = False) -> DataFrame:
    """Select and cast to ``schema`` by name; absent columns are NULL, bad values raise."""
    extra = _check_columns(df, schema, evolve)
    columns = [
        (
            converted(F.col(f"`{f.name}`"), df.schema[f.name].dataType, f.dataType)
            if f.name in df.columns
            else F.lit(None).cast(f.dataType)
        ).alias(f.name)
        for f in schema.fields
    ]
    return df.select(*columns, *[F.col(f"`{c}`") for c in extra])


def _loses(column: Column, source: T.DataType, target: T.DataType) -> Column | None:
    """Whether a value changes in its declared type, where types of numbers or times can tell.

    Single precision is exempt: hardly any double survives it unchanged.
    """
    if isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType):
        if _loses(column, source.elementType, target.elementType) is None:
            return None
    elif isinstance(target, T.FloatType) or not (
        (isinstance(source, T.NumericType) and isinstance(target, T.NumericType))
        or (isinstance(source, (T.TimestampType, T.TimestampNTZType)) and isinstance(target, T.DateType))
    ):
        return None
    back = column.try_cast(target).cast(source)
    return F.coalesce(back != column, F.lit(False))


def _nulls_in(array: Column) -> Column:
    return F.size(F.filter(array, lambda x: x.isNull()))


def conform_checked(df: DataFrame, schema: T.StructType, evolve: bool = False) -> DataFrame:
    """Like :func:`conform`, but mark rows that cannot be stored instead of failing.

    A row is rejected when a value does not read as its declared type, or only by losing a
    part of it (1.7 as BIGINT), or ``time`` is NULL.
    Such rows carry the reason and the row as JSON; the other rows carry NULL there.
    """
    # Columns are named, not bound, so those made for one frame serve all frames of its schema.
    key = (df.sparkSession.sparkContext.applicationId, df.schema.json(), schema.json(), evolve)
    if key not in _checked:
        while len(_checked) >= _MOST_CHECKED:
            _checked.pop(next(iter(_checked)))
        _checked[key] = _checked_columns(df, schema, evolve)
    return df.select(*_checked[key])


#: The columns of :func:`conform_checked` for the schemas that it met last.
_checked: dict[tuple, list[Column]] = {}
_MOST_CHECKED = 16


def _checked_columns(df: DataFrame, schema: T.StructType, evolve: bool) -> list[Column]:
    extra = _check_columns(df, schema, evolve)
    columns, tests = [], []
    for f in schema.fields:
        if f.name not in df.columns:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        source = F.col(f"`{f.name}`")
        if df.schema[f.name].dataType == f.dataType:
            columns.append(source)
        else:
            kind = df.schema[f.name].dataType
            target = source.try_cast(f.dataType)
            columns.append(converted(source, kind, f.dataType, lenient=True).alias(f.name))
            bad = source.isNotNull() & target.isNull()
            loses = _loses(source, kind, f.dataType)
            if loses is not None:
                bad = bad | loses
            if isinstance(f.dataType, T.ArrayType):
                # A bad element turns NULL inside an array that itself survives.
                worse = _nulls_in(target) > _nulls_in(source)
                bad = bad | F.coalesce(worse, F.lit(False))
            tests.append((bad, f"{f.name} is not {f.dataType.simpleString()}"))
    if "time" in df.columns:
        tests.append((F.col("time").isNull(), "time is null"))
    elif "time" in schema.names:
        tests.append((F.lit(True), "time is null"))
    rejected = reduce(or_, [bad for bad, _ in tests], F.lit(False))
    reason = F.concat_ws("; ", *[F.when(bad, F.lit(text)) for bad, text in tests])
    cells = {c: F.col(f"`{c}`") for c in df.columns}
    if TIME_TEXT in cells:
        cells["time"] = cells.pop(TIME_TEXT)
    original = F.to_json(F.struct(*[cell.alias(c) for c, cell in cells.items()]))
    return [
        *columns,
        *[F.col(f"`{c}`") for c in extra],
        rejected.alias(REJECTED),
        F.when(rejected, reason).alias(REASON),
        F.when(rejected, original).alias(ROW),
    ]
