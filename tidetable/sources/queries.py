"""Running SQL text with bound parameters and a join strategy."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tidetable.operators.shape import evaluated_once, key_first
from tidetable.operators.timecols import parse_dates
from tidetable.session import isolated_session
from tidetable.sinks.csvfile import write_csv

OPTIONS = ("db", "result_url")

# Largest side "broadcast" sends to every executor: by the size AQE measures in memory, and,
# before that is known, by the much smaller size of compressed files.
BROADCAST_LIMIT = 256 * 1024 * 1024
PLANNED_LIMIT = 32 * 1024 * 1024

# What SQL text consists of, as far as placeholders are concerned; the rest is one character each.
_TOKEN = re.compile(
    r"""
    (?P<raw>\b[rR](?:'[^']*'|"[^"]*"))
  | (?P<text>'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.|"")*")
  | (?P<name>`(?:[^`]|``)*`)
  | (?P<line>--(?:\\\n|[^\n])*)
  | (?P<block>/\*)
  | (?P<open>['"`])
  | \{(?P<placeholder>[A-Za-z_]\w*)\}
  | (?<![:\w]):(?P<marker>[A-Za-z_]\w*)
    """,
    re.S | re.X,
)
_PLACEHOLDER = re.compile(r"\{([A-Za-z_]\w*)\}")


def _block_end(text: str, at: int) -> int:
    """Where a block comment that begins at ``at`` ends; such comments may hold others."""
    depth = 0
    for mark in re.finditer(r"/\*|\*/", text[at:]):
        depth += 1 if mark.group() == "/*" else -1
        if not depth:
            return at + mark.end()
    raise ValueError("a comment of the query is not closed")


def _bound_literal(literal: str, used: list[str]) -> str:
    """A text literal with placeholders inside as its parts joined to the bound values."""
    begin = literal.index(literal[-1])
    prefix, quote = literal[:begin], literal[-1]
    pieces = _PLACEHOLDER.split(literal[begin + 1 : -1])
    if len(pieces) == 1:
        return literal
    used += pieces[1::2]
    parts = [
        f"CAST(:{p} AS STRING)" if i % 2 else f"{prefix}{quote}{p}{quote}" for i, p in enumerate(pieces) if i % 2 or p
    ]
    if len(parts) == 1:
        return f":{pieces[1]}"
    return f"concat({', '.join(parts)})"


def _bind(text: str) -> tuple[str, list[str]]:
    """The query with parameter markers for its placeholders, and the names of all its parameters."""
    out, used, at = [], [], 0
    while (token := _TOKEN.search(text, at)) is not None:
        out.append(text[at : token.start()])
        end = token.end()
        kind = token.lastgroup
        if kind == "block":
            end = _block_end(text, token.start())
            out.append(text[token.start() : end])
        elif kind == "open":
            raise ValueError(f"a {token.group()} of the query is not closed")
        elif kind in ("raw", "text"):
            out.append(_bound_literal(token.group(), used))
        elif kind == "name" and _PLACEHOLDER.search(token.group()):
            raise ValueError(f"a placeholder cannot be a part of the name {token.group()}; use IDENTIFIER({{name}})")
        elif kind in ("placeholder", "marker"):
            used.append(token.group(kind))
            out.append(f":{token.group(kind)}")
        else:
            out.append(token.group())
        at = end
    return "".join(out) + text[at:], used


def bind_placeholders(text: str) -> str:
    """Rewrite ``{name}``, ``'{name}'`` and ``'%{name}%'`` placeholders with ``:name`` parameter markers.

    Values are then bound, not spliced, in literals of either quote and raw ones too. Comments and
    quoted names are left as they are. A table or column name goes into ``IDENTIFIER({name})``.
    """
    return _bind(text)[0]


def bound_query(text: str, params: Mapping[str, object]) -> str:
    """The query with markers; a parameter without a value, or a value without a place, raises ``ValueError``."""
    bound, used = _bind(text)
    missing = sorted(set(used) - set(params))
    if missing:
        raise ValueError(f"no value for {', '.join(missing)}")
    unused = sorted(set(params) - set(used))
    if unused:
        raise ValueError(f"the query has no place for {', '.join(unused)}")
    return bound


def join_settings(join: str | None, broadcast_limit: int = BROADCAST_LIMIT) -> dict[str, str]:
    """Session settings for a join strategy.

    ``partitioned`` never broadcasts. ``broadcast`` lets Spark broadcast any side it finds
    to be within the limit, at planning time or from the sizes AQE has measured; a bigger
    side is joined by shuffle. ``None`` leaves the choice to the session.
    """
    if join is None:
        return {}
    if join not in ("broadcast", "partitioned"):
        raise ValueError(f"join must be 'broadcast' or 'partitioned', not {join!r}")
    sides = (min(PLANNED_LIMIT, broadcast_limit), broadcast_limit) if join == "broadcast" else (-1, -1)
    return {
        "spark.sql.autoBroadcastJoinThreshold": str(sides[0]),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(sides[1]),
    }


def run_query(
    spark: SparkSession,
    text: str,
    params: Mapping[str, object] | None = None,
    join: str | None = None,
    index_col: str | None = None,
    parse: Sequence[str] | Mapping[str, str] | None = None,
    **options: object,
) -> DataFrame:
    """Run SQL and return its rows as a lazy frame.

    ``params`` fills ``:name`` markers or ``{name}`` placeholders, each of which must have a value
    and each value a place. Options: ``db`` is the
    database unqualified names belong to; ``result_url`` also writes the rows as CSV
    there. An unknown option raises. With ``db`` or ``join`` the query gets a session of
    its own, in which only catalog tables, files and global views are known.
    """
    unknown = [o for o in options if o not in OPTIONS]
    if unknown:
        raise ValueError(f"unknown option: {', '.join(unknown)}; known are {', '.join(OPTIONS)}")
    session = spark
    if join is not None or options.get("db"):
        session = isolated_session(spark, join_settings(join))
    if options.get("db"):
        session.catalog.setCurrentDatabase(str(options["db"]))
    if params:
        rows = session.sql(bound_query(text, params), args=dict(params))
    else:
        rows = session.sql(text)
    if options.get("result_url"):
        # Written once with its types; the CSV and the frame returned have the same rows.
        rows = evaluated_once(rows, "query")
        write_csv(rows, str(options["result_url"]))
    return key_first(parse_dates(rows, parse), index_col)
