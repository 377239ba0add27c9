"""Time functions as columns and as SQL functions."""

from tidetable.functions.patterns import parse_pattern, strftime
from tidetable.functions.sqlfuncs import register_time_functions
from tidetable.functions.timefuncs import (
    as_epoch,
    epoch_format,
    epoch_trunc,
    in_time_range,
    to_epoch,
)

__all__ = [
    "as_epoch",
    "epoch_format",
    "epoch_trunc",
    "in_time_range",
    "parse_pattern",
    "register_time_functions",
    "strftime",
    "to_epoch",
]
