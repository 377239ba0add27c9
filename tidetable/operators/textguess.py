"""Guess column types from text, the way a CSV reader would."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Cell texts pandas.read_csv reads as missing.
MISSING_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
# Cell texts pandas.read_csv reads as booleans.
BOOLEAN_WORDS = ["True", "TRUE", "true", "False", "FALSE", "false"]

_INTEGER = r"^\s*[+-]?\d+\s*$"
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_INFINITY = r"^\s*[+-]?(inf|Inf|INF|infinity|Infinity|INFINITY)\s*$"


def _present(column: Column) -> Column:
    return F.when(~column.isin(MISSING_WORDS), column)


def guess_text_types(df: DataFrame) -> DataFrame:
    """Turn text columns into numbers or booleans where every cell reads as one.

    Lossy on purpose: ``"00012"`` becomes ``12`` and missing-value words become NULL. The
    types come from one aggregate over the text columns; no CSV file is written.
    """
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not names:
        return df
    counts = []
    for i, name in enumerate(names):
        cell = _present(F.col(f"`{name}`"))
        fits = cell.try_cast("bigint").isNotNull()
        integer = cell.rlike(_INTEGER)
        number = (cell.rlike(_NUMBER) & (~integer | fits)) | cell.rlike(_INFINITY)
        counts += [
            F.count(cell).alias(f"n{i}"),
            F.count(F.when(integer & fits, 1)).alias(f"i{i}"),
            F.count(F.when(number, 1)).alias(f"d{i}"),
            F.count(F.when(cell.isin(BOOLEAN_WORDS), 1)).alias(f"b{i}"),
        ]
    found = df.agg(*counts).first()
    out = df
    for i, name in enumerate(names):
        total = found[f"n{i}"]
        cell = _present(F.col(f"`{name}`"))
        if total and found[f"i{i}"] == total:
            cell = cell.cast("bigint")
        elif total and found[f"d{i}"] == total:
            cell = cell.cast("double")
        elif total and found[f"b{i}"] == total:
            cell = F.lower(cell).cast("boolean")
        out = out.withColumn(name, cell)
    return out
