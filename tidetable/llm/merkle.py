"""Merkle manifest of a table, and a persistent version of the tree for every tampered row.

A leaf is the digest of a row's fields. Per group (a language) the leaves stand in ascending id;
as long as there are several nodes, every 8 consecutive ones (the last run may be shorter, even
one) become the digest of their digests. The groups' subroots, in order, make the root alike.

The tree is built in aligned blocks of 8 ** 4 nodes, a task's group each, so that a round of one
shuffle makes four levels and leaves a 4096th of the nodes. Then each block gets its ``above``: the
siblings and places from its node up to the root, handed down round by round; it is shared by all
of the block's leaves. A tampered leaf makes a version by path copying: within its block only the
ancestors are copied, all other nodes are those of the first version, and the copies go on through
``above``, again one node a level. So versions never meet in an upper node's task, however many
there are, and every block continues its own.

Rows are ordered by their group (null first, then by the bytes of its text), id (null first) and
leaf; rows of one id are leaves of their own, equal ones are equal leaves, which are told apart by
place only. Null fields enter a leaf as ``-``. A row is only ever read for its leaf, so very long
texts cost one digest. A lone leaf is its group's subroot, a lone subroot the root. An empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidetable.llm.frames import sort_tasks, stored

FAN = 8
#: Levels of an aligned block.
LEVELS = 4
#: Hexadecimal digits of a digest.
WIDTH = 64

#: The fields of a document's leaf, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_POSITION_BITS = 33
_TOP = -1

NODES = "group long, pos long, n long, digest string"
ABOVE = "group long, pos long, subroot string, siblings string, places array<int>, sizes array<int>"
ROWS = (
    "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string, "
    "tampered boolean, copies array<string>"
)
_nodes_arrow = pa.schema([("group", pa.int64()), ("pos", pa.int64()), ("n", pa.int64()), ("digest", pa.string())])
_steps = [("siblings", pa.string()), ("places", pa.list_(pa.int32())), ("sizes", pa.list_(pa.int32()))]
_above_arrow = pa.schema([("group", pa.int64()), ("pos", pa.int64()), ("subroot", pa.string()), *_steps])
_rows_arrow = pa.schema(
    [(n, pa.string()) for n in ("leaf", "subroot", "proof_sha256", "folded_root")]
    + [("tampered", pa.bool_()), ("copies", pa.list_(pa.string()))]
).insert(0, pa.field("doc_id", pa.int64()))


def joined_digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Digest of a row's fields, each ``-`` if null, else its bytes' number, a colon and its text."""
    texts = [f.cast("string") for f in fields]
    parts = [F.concat(F.octet_length(t).cast("string"), F.lit(":"), t) for t in texts]
    return F.sha2(F.concat(*[F.coalesce(p, F.lit("-")) for p in parts]).cast("binary"), 256)


def levels_above(n: int, most: int) -> int:
    """Levels above ``n`` nodes until one is left, but at most ``most``."""
    levels = 0
    while n > 1 and levels < most:
        n, levels = -(-n // FAN), levels + 1
    return levels


def raised(digests: list[str], levels: int) -> list[list[str]]:
    """For each level the joined digests of its runs; last the one node that is left, if levels are whole."""
    layers = []
    for _ in range(levels):
        runs = ["".join(digests[i : i + FAN]) for i in range(0, len(digests), FAN)]
        layers.append(runs)
        digests = [joined_digest(r) for r in runs]
    return [*layers, digests]


def steps(layers: list[list[str]], at: int) -> tuple[str, list[int], list[int]]:
    """Siblings of the node at ``at``, level by level, with its place in each run and the run's size."""
    siblings, places, sizes = [], [], []
    for runs in layers[:-1]:
        run, place = runs[at // FAN], at % FAN
        siblings.append(run[: WIDTH * place] + run[WIDTH * (place + 1) :])
        places.append(place)
        sizes.append(len(run) // WIDTH)
        at //= FAN
    return "".join(siblings), places, sizes


def path_copies(digest: str, siblings: str, places: Sequence[int], sizes: Sequence[int]) -> list[str]:
    """The new ancestors of a node that has become ``digest``, from the lowest one up."""
    copies, at = [], 0
    for place, size in zip(places, sizes, strict=True):
        cut = at + WIDTH * place
        end = at + WIDTH * (size - 1)
        digest = joined_digest(siblings[at:cut] + digest + siblings[cut:end])
        copies.append(digest)
        at = end
    return copies


def numbered(df: DataFrame, keys: Sequence[Column], name: str) -> DataFrame:
    """``df`` with its place in the order of ``keys``, written to the shared folder.

    One range shuffle; equal keys are spread by the row's place in the input, so that no key fills
    a task. The starting points are one count for each task.
    """
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    keys = [*keys, F.col("_tie")]
    ordered = tied.repartitionByRange(sort_tasks(df), *keys).sortWithinPartitions(*keys).drop("_tie")
    slots = stored(ordered.withColumn("_slot", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright(F.col("_slot"), _POSITION_BITS)
    sizes = slots.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    position = F.col("_slot").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    placed = slots.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return placed.withColumn(name, F.col("_start") + position).drop("_slot", "_start")


def grouped_leaves(leaves: DataFrame) -> DataFrame:
    """Leaves (group_key, doc_id, leaf, ...) with ``group`` (the place of the group's first leaf among
    all, so that groups stand in order), ``pos`` in the group and the group's size ``n``."""
    order = [F.col(c).asc_nulls_first() for c in ("group_key", "doc_id", "leaf")]
    placed = numbered(leaves, order, "place")
    # A group's rows are counted by task first, so that the rows meet small keys only.
    spans = placed.groupBy("_part", "group_key").agg(F.min("place").alias("first"), F.count("*").alias("rows"))
    groups = spans.groupBy("group_key").agg(F.min("first").alias("group"), F.sum("rows").alias("n"))
    same = F.col("s.group_key").eqNullSafe(F.col("g.group_key"))
    spans = spans.alias("s").join(groups.alias("g"), same).select("s._part", "s.group_key", "group", "n")
    here = (F.col("l._part") == F.col("s._part")) & F.col("l.group_key").eqNullSafe(F.col("s.group_key"))
    kept = [F.col(f"l.`{c}`") for c in leaves.columns]
    return placed.alias("l").join(spans.alias("s"), here).select(
        *kept, "group", (F.col("place") - F.col("group")).alias("pos"), "n"
    )


def _block(levels: int) -> Column:
    return F.call_function("div", F.col("pos"), F.lit(FAN**levels).cast("bigint")).alias("block")


def _raise_block(key: tuple, nodes: pa.Table, levels: int) -> pa.Table:
    nodes = nodes.sort_by("pos")
    n = nodes.column("n")[0].as_py()
    last = raised(nodes.column("digest").to_pylist(), levels_above(n, levels))[-1]
    group, block = (k.as_py() for k in key)
    row = {"group": [group], "pos": [block], "n": [-(-n // FAN**levels)], "digest": last}
    return pa.table(row, schema=_nodes_arrow)


def rounds_of_nodes(nodes: DataFrame, levels: int = LEVELS) -> list[DataFrame]:
    """The nodes (group, pos, n, digest) of every round, from the given ones to one node a group."""

    def raise_block(key: tuple, nodes: pa.Table) -> pa.Table:
        return _raise_block(key, nodes, levels)

    rounds = [nodes]
    while (rounds[-1].agg(F.max("n")).first()[0] or 0) > 1:
        blocks = rounds[-1].select("group", "pos", "n", "digest").groupBy("group", _block(levels))
        rounds.append(stored(blocks.applyInArrow(raise_block, NODES), "nodes"))
    return rounds


def _hand_down(nodes: pa.Table, above: pa.Table, levels: int) -> pa.Table:
    nodes, up = nodes.sort_by("pos"), above.to_pylist()[0]
    layers = raised(nodes.column("digest").to_pylist(), levels_above(nodes.column("n")[0].as_py(), levels))
    rows = []
    for at, pos in enumerate(nodes.column("pos").to_pylist()):
        siblings, places, sizes = steps(layers, at)
        rows.append(
            {"group": up["group"], "pos": pos, "subroot": up["subroot"], "siblings": siblings + up["siblings"]}
            | {"places": places + up["places"], "sizes": sizes + up["sizes"]}
        )
    return pa.Table.from_pylist(rows, schema=_above_arrow)


def handed_down(rounds: list[DataFrame], above: DataFrame, levels: int = LEVELS) -> DataFrame:
    """What is above each node of ``rounds[0]``, from what is above the one node of each group."""

    def hand_down(nodes: pa.Table, above: pa.Table) -> pa.Table:
        return _hand_down(nodes, above, levels)

    for nodes in reversed(rounds):
        blocks = nodes.select("group", "pos", "n", "digest").groupBy("group", _block(levels))
        upper = above.groupBy("group", F.col("pos").alias("block"))
        above = stored(blocks.cogroup(upper).applyInArrow(hand_down, ABOVE), "above")
    return above


def _leaf_versions(leaves: pa.Table, above: pa.Table, levels: int) -> pa.Table:
    leaves, up = leaves.sort_by("pos"), above.to_pylist()[0]
    digests = leaves.column("leaf").to_pylist()
    layers = raised(digests, levels_above(leaves.column("n")[0].as_py(), levels))
    proofs, folded, copied = [], [], []
    for at, (leaf, changed) in enumerate(zip(digests, leaves.column("changed").to_pylist(), strict=True)):
        siblings, places, sizes = steps(layers, at)
        siblings += up["siblings"]
        new = leaf if changed is None else changed
        copies = path_copies(new, siblings, places + up["places"], sizes + up["sizes"])
        proofs.append(joined_digest(siblings))
        folded.append(copies[-1] if copies else new)
        copied.append(copies if changed is not None else None)
    n = len(digests)
    tampered = leaves.column("changed").is_valid()
    columns = [leaves.column("doc_id"), digests, [up["subroot"]] * n, proofs, folded, tampered, copied]
    return pa.table(dict(zip(_rows_arrow.names, columns, strict=True)), schema=_rows_arrow)


def manifest(leaves: DataFrame, levels: int = LEVELS) -> tuple[DataFrame, str | None]:
    """The tree over ``leaves`` (group_key, doc_id, leaf, changed: the tampered leaf or null).

    Returns one row a leaf (``ROWS``: subroot, digest of its siblings, the root that its version has,
    and the nodes that the version copied, if tampered) and the root, None of an empty table.
    """
    placed = stored(grouped_leaves(stored(leaves, "leaves")), "placed")
    bottom = placed.select("group", "pos", "n", F.col("leaf").alias("digest"))
    rounds = rounds_of_nodes(bottom, levels)
    subroots = numbered(rounds[-1].select("group", "digest"), [F.col("group")], "rank").drop("_part")
    n_groups = subroots.count()
    top = stored(
        subroots.select(
            F.lit(_TOP).cast("long").alias("group"), F.col("rank").alias("pos"),
            F.lit(n_groups).cast("long").alias("n"), "digest", F.col("group").alias("of"),
        ),
        "subroots",
    )
    top_rounds = rounds_of_nodes(top, levels)
    found = top_rounds[-1].select("digest").head(1)
    root = found[0].digest if found else None
    spark = leaves.sparkSession
    start = spark.createDataFrame([(_TOP, 0, None, "", [], [])], ABOVE)
    over_subroots = handed_down(top_rounds[:-1], start, levels)
    below = F.col("t.pos") == F.col("a.pos")
    over_groups = over_subroots.alias("a").join(top.alias("t"), below).select(
        F.col("t.of").alias("group"), F.lit(0).cast("long").alias("pos"), F.col("t.digest").alias("subroot"),
        "siblings", "places", "sizes",
    )
    over_blocks = handed_down(rounds[1:-1], over_groups, levels)

    def leaf_versions(leaves: pa.Table, above: pa.Table) -> pa.Table:
        return _leaf_versions(leaves, above, levels)

    blocks = placed.select("group", "pos", "n", "doc_id", "leaf", "changed").groupBy("group", _block(levels))
    upper = over_blocks.groupBy("group", F.col("pos").alias("block"))
    return blocks.cogroup(upper).applyInArrow(leaf_versions, ROWS), root


def document_leaves(docs: DataFrame, tampered: Column, text: Column) -> DataFrame:
    """Leaves of documents, with the leaf that a ``tampered`` row has once its text is ``text``."""
    fields = {c: F.col(c) for c in FIELDS}
    changed = leaf_digest(list((fields | {"text": text}).values()))
    return docs.select(
        F.col("lang").cast("string").alias("group_key"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf_digest(list(fields.values())).alias("leaf"),
        F.when(tampered, changed).alias("changed"),
    )


def verified_versions(docs: DataFrame, tampered: Column, text: Column, levels: int = LEVELS) -> DataFrame:
    """Every document's leaf, subroot, root, proof, the root of its version and whether it is the root;
    ``copies`` are the nodes that a tampered document's version does not share."""
    rows, root = manifest(document_leaves(docs, tampered, text), levels)
    root = F.lit(root).cast("string")
    return rows.select(
        "doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == root).alias("verified"), "tampered", "copies",
    )


def copied_nodes(versions: DataFrame) -> DataFrame:
    """The nodes that versions do not share: version (the tampered document), level (1 above the
    leaves), digest."""
    return versions.where("tampered").select(
        F.col("doc_id").alias("version"), F.posexplode("copies").alias("at", "digest")
    ).select("version", (F.col("at") + 1).alias("level"), "digest")
