"""SimHash near-duplicates: 64-bit fingerprints, linked at few differing bits by pigeonring filtering.

A fingerprint is cut into 4 segments on a ring. If two fingerprints differ in at most 3 bits, then
from some segment on, every chain of consecutive segments stays within its proportional budget:
no difference in 1 segment, at most 1 in 2, 2 in 3 and 3 in all 4. So either the first two
segments are equal, or the first, a half of the second and a half of the third are. These 5 cases
from 4 starts are 20 keys of 32 bits; pairs that share a key are held against the chain budgets
and then against the full Hamming distance.

Equal fingerprints are one node of the graph, whatever their number. Tasks emit a tree of links
for each component they see, never all pairs, and the trees are joined by star contraction.

Null texts and texts without words have fingerprint zero, which is linked like any other; null
ids are carried but never name a component that has another id; repeated rows are nodes of the
same component; an empty table has no components.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidetable.llm.components import connected_components
from tidetable.llm.frames import row_struct, stored, text_runs, whole_text

DISTANCE = 3
SEGMENTS = 4
SHINGLE = 3
SEED = 42

#: Rows of one key that are compared pair by pair; beyond, each row's neighbours are looked up.
MOST_COMPARED = 50_000

_hash = partial(xxhash.xxh64_intdigest, seed=SEED)


def fingerprint(text: str, shingle: int = SHINGLE, at_once: int = 1 << 16) -> int:
    """The SimHash of a text's word shingles, repeats included; 0 for a text without words."""
    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = iter([b" ".join(words)])
        total = 1
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
        total = len(words) - shingle + 1
    counts = np.zeros(64, np.int64)
    for begin in range(0, total, at_once):
        n = min(at_once, total - begin)
        hashes = np.fromiter(map(_hash, (g for g, _ in zip(grams, range(n), strict=False))), np.uint64, n)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, shingle: int = SHINGLE, keyed: bool = False) -> DataFrame:
    """``doc_id`` and ``fp`` (the fingerprint as a signed long) of each row of ``docs``; ``keyed``: and
    ``text_key``, a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_runs(batches):
            found = [fingerprint(t, shingle) for t in batch.column("text").to_pylist()]
            values = np.array(found, np.uint64).view(np.int64)
            keys = {"text_key": batch.column("text_key")} if keyed else {}
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "fp": pa.array(values), **keys})

    texts = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    if keyed:
        texts = texts.withColumn("text_key", F.xxhash64("text"))
    return texts.mapInArrow(run, "doc_id long, fp long" + (", text_key long" if keyed else ""))


def ring_keys(fp: Column) -> Column:
    """The 20 keys of a fingerprint: start and case in the high bits, 32 fingerprint bits below."""
    low = F.lit(0xFFFFFFFF)
    keys = []
    for start in range(SEGMENTS):
        turn = 16 * start
        turned = fp if turn == 0 else F.shiftleft(fp, turn).bitwiseOR(F.shiftrightunsigned(fp, 64 - turn))
        top = F.shiftrightunsigned(turned, 32).bitwiseAND(low)
        first = F.shiftrightunsigned(turned, 48).bitwiseAND(F.lit(0xFFFF))
        cases = [top]
        for second in (40, 32):
            for third in (24, 16):
                a = F.shiftrightunsigned(turned, second).bitwiseAND(F.lit(0xFF))
                b = F.shiftrightunsigned(turned, third).bitwiseAND(F.lit(0xFF))
                cases.append(F.shiftleft(first, 16).bitwiseOR(F.shiftleft(a, 8)).bitwiseOR(b))
        for case, bits in enumerate(cases):
            tag = (start * len(cases) + case) << 32
            keys.append(bits.bitwiseOR(F.lit(tag)))
    return F.array(*keys)


def chain_holds(differing: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Whether the chain of segments from ``start`` stays within its proportional budgets."""
    held = np.ones(len(differing), bool)
    total = np.zeros(len(differing), np.int64)
    for length in range(1, SEGMENTS + 1):
        place = (48 - 16 * ((start + length - 1) % SEGMENTS)).astype(np.uint64)
        total += np.bitwise_count((differing >> place) & np.uint64(0xFFFF))
        held &= total <= length * DISTANCE // SEGMENTS
    return held


def linked(a: np.ndarray, b: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which pairs differ in few enough bits, seen from the segment that their key starts at."""
    differing = a ^ b
    held = chain_holds(differing, start)
    held[held] = np.bitwise_count(differing[held]) <= DISTANCE
    return held


def neighbours(fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All linked pairs of one large group, by looking up each fingerprint with 1 to 3 bits changed.

    The work grows with the group, not with its square.
    """
    ordered = np.unique(fps)
    free = [np.uint64(1) << np.uint64(k) for k in range(64) if len(np.unique((ordered >> np.uint64(k)) & np.uint64(1))) > 1]
    changes = [m for i, x in enumerate(free) for m in (x, *(x | y | z for j, y in enumerate(free[i + 1 :], i + 1) for z in (y, *free[j + 1 :])))]
    for change in changes:
        other = ordered ^ change
        at = np.minimum(np.searchsorted(ordered, other), len(ordered) - 1)
        hit = (ordered[at] == other) & (ordered < other)
        if hit.any():
            yield ordered[hit], other[hit]


def pairs_of(keys: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs among rows sorted by key that share a key."""
    begins = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[begins, len(keys)])
    left, right = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for k in np.flatnonzero(sizes > MOST_COMPARED):
        for a, b in neighbours(fps[begins[k] : begins[k] + sizes[k]]):
            left.append(a)
            right.append(b)
    small = np.repeat((sizes > 1) & (sizes <= MOST_COMPARED), sizes)
    keys, fps = keys[small], fps[small]
    rest = np.arange(len(keys))
    step = 1
    while len(rest):
        rest = rest[rest + step < len(keys)]
        rest = rest[keys[rest] == keys[rest + step]]
        if len(rest):
            hit = linked(fps[rest], fps[rest + step], (keys[rest] >> 32) // 5)
            left.append(fps[rest[hit]])
            right.append(fps[rest[hit] + step])
        step += 1
    return np.concatenate(left), np.concatenate(right)


def forest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The components of some links as stars: every node but a component's root, and the root."""
    nodes, ends = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = ends[: len(left)], ends[len(left) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def fingerprint_links(distinct: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` between the fingerprints in column ``fp``, enough to join every component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64), np.zeros(0, np.uint64)]
        for batch in batches:
            keys = np.concatenate([held[0], batch.column("key").to_numpy()])
            fps = np.concatenate([held[1], batch.column("fp").to_numpy().view(np.uint64)])
            # The last key's rows may go on in the next batch.
            cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            held = [keys[cut:], fps[cut:]]
            yield from star(keys[:cut], fps[:cut])
        yield from star(*held)

    def star(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(keys):
            node, root = forest(*pairs_of(keys, fps))
            if len(node):
                yield pa.RecordBatch.from_pydict({"a": pa.array(node.view(np.int64)), "b": pa.array(root.view(np.int64))})

    keyed = distinct.select("fp", F.explode(ring_keys(F.col("fp"))).alias("key")).select("key", "fp")
    return keyed.repartition("key").sortWithinPartitions("key").mapInArrow(run, "a long, b long")


def near_duplicate_groups(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id`` for each row of ``docs`` (doc_id, text)."""
    prints = stored(with_fingerprints(docs, shingle), "fingerprints")
    return prints.join(fingerprint_components(prints), "fp").select("doc_id", "fp", "component_id")


def fingerprint_components(prints: DataFrame) -> DataFrame:
    """``fp``, its component's ``root`` and ``component_id``, the smallest ``doc_id`` in it."""
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = connected_components(fingerprint_links(distinct))
    placed = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    smallest = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    return placed.join(smallest, "root").select("fp", "root", "component_id")


def one_of_each_group(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with one document of each group: that of the smallest id, once if it is repeated.

    Of several texts of that id in one group the one with the smallest hash stays; texts of one
    id in different groups are different documents. Rows without an id can't be named by one and
    stay.
    """
    named = docs.where(F.col("doc_id").isNotNull())
    prints = stored(with_fingerprints(named, shingle, keyed=True), "fingerprints")
    first = prints.join(fingerprint_components(prints), "fp").where("doc_id = component_id")
    kept = first.groupBy("root", F.col("doc_id").alias("kept_id")).agg(F.min("text_key").alias("kept_key"))
    rows = named.select(
        row_struct(docs).alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64(whole_text()).alias("key")
    )
    here = (F.col("id") == F.col("kept_id")) & (F.col("key") == F.col("kept_key"))
    stay = rows.join(kept, here, "left_semi").dropDuplicates(["id", "key"]).select("row.*")
    return stay.unionByName(docs.where(F.col("doc_id").isNull()))
