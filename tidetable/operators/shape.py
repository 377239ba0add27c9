"""Shaping a query result: null columns, key column, pivot."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidetable.operators.timecols import TIME, convert_time, shift_timezone
from tidetable.session import written

_FLOATS = (T.FloatType, T.DoubleType)


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def _presence(df: DataFrame) -> list[Column]:
    """For each column of ``df`` the number of values that it holds, named by place."""
    counts = []
    for i, name in enumerate(df.columns):
        value = _col(name)
        if isinstance(df.schema[name].dataType, _FLOATS):
            value = F.when(~F.isnan(value), value)
        counts.append(F.count(value).alias(f"n{i}"))
    return counts


def _nodes(tree) -> Iterator:
    """A plan or expression of the planner and all below it."""
    yield tree
    children = tree.children()
    for i in range(children.size()):
        yield from _nodes(children.apply(i))


def _name(node) -> str:
    return node.getClass().getSimpleName()


def _is_scan(df: DataFrame) -> bool:
    """Whether the frame is columns and rows picked from files, so that reading it again is cheap and
    gives the same: no functions of the user's, nothing that differs from one evaluation to the next."""
    for node in _nodes(df._jdf.queryExecution().analyzed()):
        if _name(node) == "LogicalRelation":
            if _name(node.relation()) != "HadoopFsRelation":
                return False
            continue
        if _name(node) not in ("Project", "Filter", "SubqueryAlias", "View"):
            return False
        expressions = node.expressions()
        for i in range(expressions.size()):
            expression = expressions.apply(i)
            if not expression.deterministic() or any("UDF" in _name(e) or "Subquery" in _name(e) for e in _nodes(expression)):
                return False
    return True


def evaluated_once(df: DataFrame, tag: str) -> DataFrame:
    """``df`` itself if it only reads files, else its rows written to the shared folder."""
    return df if _is_scan(df) else written(df, tag)


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Drop columns that hold no value in any row; NaN counts as none.

    All rows decide. An input that is more than a scan of files is written to the shared folder and
    counted in that same pass, so it is evaluated once.
    """
    if not df.columns:
        return df
    if _is_scan(df):
        present = df.agg(*_presence(df)).first().asDict()
    else:
        seen = Observation()
        df = written(df.observe(seen, *_presence(df)), "present")
        present = seen.get
    return df.select(*[_col(c) for i, c in enumerate(df.columns) if present[f"n{i}"]])


def key_first(df: DataFrame, key: str | Sequence[str] | None) -> DataFrame:
    """Move the key column(s) to the front (C11)."""
    if key is None:
        return df
    keys = [key] if isinstance(key, str) else list(key)
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"no such column: {', '.join(missing)}")
    return df.select(*[_col(c) for c in [*keys, *[c for c in df.columns if c not in keys]]])


def split_columns(schema: T.StructType) -> tuple[str, list[str], list[str]]:
    """Row key, dimensions and measures of a result.

    The first column is the key. Of the others, text columns and those named ``*_id`` are
    dimensions, the rest measures.
    """
    key, *rest = schema.fields
    dimensions = [
        f.name for f in rest if f.name.endswith("_id") or isinstance(f.dataType, T.StringType)
    ]
    return key.name, dimensions, [f.name for f in rest if f.name not in dimensions]


def pivot_result(
    df: DataFrame, values: Sequence[object] | None = None, other: str = "error"
) -> DataFrame:
    """Turn dimensions into columns, one row per key.

    With several dimensions their values are joined by ``_``; with several measures the
    columns are named ``<value>_<measure>``. Two rows for the same cell raise, and so do
    columns of the same name. ``values`` lists the dimension values (tuples for several
    dimensions) and saves the job that finds them; a row with any other value raises, or is
    left out with ``other="drop"``. No dimension: the frame comes back unchanged.
    """
    if other not in ("error", "drop"):
        raise ValueError(f"other must be 'error' or 'drop', not {other!r}")
    key, dimensions, measures = split_columns(df.schema)
    if not dimensions:
        return df
    if not measures:
        raise ValueError("nothing to pivot: every column is a key or a dimension")
    texts = [_col(d).cast("string") for d in dimensions]
    # Each text is preceded by its length, so values holding the separator stay apart.
    cell = "_cell"
    marks = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    mark = F.concat(*marks)
    single = []
    for m in measures:
        clash = F.raise_error(F.lit("pivot: duplicate entries for one cell")).cast(df.schema[m].dataType)
        single.append(F.when(F.count(F.lit(1)) > 1, clash).otherwise(F.first(_col(m))).alias(m))
    if values is None:
        limit = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
        if not _is_scan(df):
            # The cells are made once; columns and rows of the result both come from them.
            cells = df.groupBy(_col(key), *[t.alias(d) for t, d in zip(texts, dimensions, strict=True)]).agg(*single)
            df = written(cells, "pivot")
        found = df.select(*texts).distinct().limit(limit + 1).collect()
        if len(found) > limit:
            raise ValueError(f"more than {limit} dimension values; raise spark.sql.pivotMaxValues")
        combos = sorted((tuple(r) for r in found), key=lambda t: [(v is None, v or "") for v in t])
    else:
        combos = [tuple(v) if isinstance(v, (tuple, list)) else (v,) for v in values]
        combos = [tuple(None if x is None else str(x) for x in t) for t in combos]
    labels = ["_".join("null" if x is None else x for x in t) for t in combos]
    if len(measures) > 1:
        labels = [f"{label}_{m}" for label in labels for m in measures]
    clashing = sorted(n for n, times in Counter(n.lower() for n in [key, *labels]).items() if times > 1)
    if clashing:
        raise ValueError(f"columns of the pivot share a name: {', '.join(clashing)}")

    wanted = ["".join("-" if x is None else f"{len(x)}:{x}" for x in t) for t in combos]
    if other == "error":
        unlisted = F.raise_error(F.concat(F.lit("pivot: a dimension value is not among those listed: "), mark))
        mark = F.when(mark.isin(wanted), mark).otherwise(unlisted.cast("string"))
    wide = (
        df.select(_col(key), mark.alias(cell), *[_col(m) for m in measures])
        .groupBy(_col(key))
        .pivot(cell, wanted)
        .agg(*single)
    )
    return wide.toDF(key, *labels)


def shape_result(
    df: DataFrame,
    dropna: bool = False,
    pivot: bool = False,
    timezone: str | None = None,
    values: Sequence[object] | None = None,
) -> DataFrame:
    """Prepare a result for reading: convert ``time``, drop empty columns, then pivot or
    bring ``time`` to the front, and show it in ``timezone``."""
    out = convert_time(df)
    if dropna:
        out = drop_null_columns(out)
    if pivot:
        out = pivot_result(out, values)
    elif TIME in out.columns:
        out = key_first(out, TIME)
    return shift_timezone(out, timezone) if TIME in out.columns else out
