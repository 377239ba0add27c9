"""Column names a table accepts."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable

from pyspark.sql import DataFrame

_FORBIDDEN = re.compile("[^a-zA-Z0-9]")


def normalise_name(name: object) -> str:
    """ASCII letters and digits in lower case; every other character becomes one ``_``."""
    return _FORBIDDEN.sub("_", str(name)).lower()


def normalised(names: Iterable[object]) -> list[str]:
    """Normalise all names; raise ``ValueError`` listing those that end up the same."""
    groups: dict[str, list[str]] = defaultdict(list)
    out = []
    for name in names:
        new = normalise_name(name)
        groups[new].append(str(name))
        out.append(new)
    clashes = {new: old for new, old in groups.items() if len(old) > 1}
    if clashes:
        shown = "; ".join(f"{', '.join(map(repr, old))} -> {new}" for new, old in clashes.items())
        raise ValueError(f"column names clash after normalising: {shown}")
    return out


def normalise_names(df: DataFrame) -> DataFrame:
    """Rename all columns to their normalised names."""
    return df.toDF(*normalised(df.columns))
