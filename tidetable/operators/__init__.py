"""Transformations from DataFrame to DataFrame."""

from tidetable.operators.buckets import aggregate, bucket_aggregate, resample, value_counts
from tidetable.operators.coerce import clean_array, coerce, derive_schema, nan_to_null
from tidetable.operators.declared import conform, conform_checked, declared_schema
from tidetable.operators.names import normalise_name, normalise_names
from tidetable.operators.rowindex import add_row_index
from tidetable.operators.shape import drop_null_columns, key_first, pivot_result, shape_result
from tidetable.operators.textguess import guess_text_types
from tidetable.operators.timecols import (
    build_time,
    convert_time,
    format_dates,
    parse_dates,
    shift_timezone,
)

__all__ = [
    "add_row_index",
    "aggregate",
    "bucket_aggregate",
    "build_time",
    "clean_array",
    "coerce",
    "conform",
    "conform_checked",
    "convert_time",
    "declared_schema",
    "derive_schema",
    "drop_null_columns",
    "format_dates",
    "guess_text_types",
    "key_first",
    "nan_to_null",
    "normalise_name",
    "normalise_names",
    "parse_dates",
    "pivot_result",
    "resample",
    "shape_result",
    "shift_timezone",
    "value_counts",
]
