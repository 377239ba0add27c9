"""strftime formats expressed with Spark's own date functions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Strftime directive -> Spark datetime pattern.
PATTERN_OF = {
    "%Y": "yyyy",
    "%y": "yy",
    "%m": "MM",
    "%d": "dd",
    "%H": "HH",
    "%I": "hh",
    "%M": "mm",
    "%S": "ss",
    "%f": "SSSSSS",
    "%p": "a",
    "%j": "DDD",
    "%b": "MMM",
    "%B": "MMMM",
    "%a": "EEE",
    "%A": "EEEE",
    "%z": "xx",
}
# Strftime directives that stand for several others.
SHORTHAND = {"%F": "%Y-%m-%d", "%T": "%H:%M:%S", "%R": "%H:%M", "%D": "%m/%d/%y"}
# Parsing accepts one or two digits for these unless another number follows directly.
LENIENT = {"%m": "M", "%d": "d", "%H": "H", "%I": "h", "%M": "m", "%S": "s", "%j": "D"}
NUMERIC = {"%Y", "%y", "%m", "%d", "%H", "%I", "%M", "%S", "%f", "%j"}


def _pieces(fmt: str) -> list[tuple[bool, str]]:
    """Split a strftime format into ``(True, directive)`` and ``(False, literal text)``."""
    for short, full in SHORTHAND.items():
        fmt = re.sub(f"(?<!%)((?:%%)*){short}", rf"\g<1>{full}", fmt)
    out: list[tuple[bool, str]] = []
    for part in re.findall(r"%.?|[^%]+", fmt, flags=re.DOTALL):
        if part == "%":
            raise ValueError(f"format ends in a lone %: {fmt!r}")
        if part[0] == "%" and part != "%%":
            out.append((True, part))
            continue
        text = "%" if part == "%%" else part
        if out and not out[-1][0]:
            text = out.pop()[1] + text
        out.append((False, text))
    return out


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'" if text else ""


def parse_pattern(fmt: str) -> str:
    """Spark pattern that reads text written in the strftime format ``fmt``."""
    pieces = _pieces(fmt)
    out = []
    for i, (directive, piece) in enumerate(pieces):
        if directive:
            if piece not in PATTERN_OF or piece in ("%a", "%A"):
                raise ValueError(f"directive {piece} cannot be parsed")
            joined = any(d and p in NUMERIC for d, p in (*pieces[max(i - 1, 0) : i], *pieces[i + 1 : i + 2]))
            out.append(PATTERN_OF[piece] if joined else LENIENT.get(piece, PATTERN_OF[piece]))
        else:
            out.append(_quoted(piece))
    return "".join(out)


def strftime(stamp: Column, fmt: str) -> Column:
    """Format a timestamp column with a strftime format."""
    # Directives without a Spark pattern letter; weeks follow the C library's rules.
    day_of_week = F.dayofweek(stamp) - F.lit(1)
    computed = {
        "%w": day_of_week.cast("string"),
        "%u": (F.weekday(stamp) + F.lit(1)).cast("string"),
        "%s": F.unix_seconds(stamp).cast("string"),
        "%V": F.lpad(F.weekofyear(stamp).cast("string"), 2, "0"),
        "%G": F.extract(F.lit("YEAROFWEEK"), stamp).cast("string"),
        "%U": F.lpad(F.floor((F.dayofyear(stamp) + F.lit(6) - day_of_week) / F.lit(7)).cast("string"), 2, "0"),
        "%W": F.lpad(F.floor((F.dayofyear(stamp) + F.lit(6) - F.weekday(stamp)) / F.lit(7)).cast("string"), 2, "0"),
        "%Z": F.lit(""),
    }
    parts: list[Column] = []
    pattern = ""
    for directive, piece in _pieces(fmt):
        if directive and piece in computed:
            if pattern:
                parts.append(F.date_format(stamp, pattern))
                pattern = ""
            parts.append(computed[piece])
        elif directive and piece in PATTERN_OF:
            pattern += PATTERN_OF[piece]
        elif directive:
            raise ValueError(f"directive {piece} is not supported")
        else:
            pattern += _quoted(piece)
    if pattern:
        parts.append(F.date_format(stamp, pattern))
    return parts[0] if len(parts) == 1 else F.concat(*parts) if parts else F.lit("")
