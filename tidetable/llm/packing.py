"""Best-fit packing of documents into sequences: patterns of few lengths, fitted to the histogram.

Documents are cut into pieces of at most ``size`` tokens. The histogram of the pieces' lengths,
at most ``size`` numbers, is all that the driver sees: there all patterns of one to ``MOST_IN``
lengths that fill a sequence exactly are enumerated, their repeat counts are fitted to the
histogram by non-negative least squares, rounded, and what they leave over is packed by best fit,
longest first. The pieces of each length are then numbered where they are, and a piece's number
tells its sequence and its place.

Null texts have no tokens but the end id. Repeated rows are documents of their own. An empty table
has no sequences.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidetable.llm.encoding import WORD_BPE, piece_encoder
from tidetable.llm.frames import stored, text_runs, whole_text

SIZE = 2048
#: Documents in a fitted pattern.
MOST_IN = 3
#: Part of the fitted counts that patterns are repeated by.
SHARE = 0.7
#: Pieces in a part, of which those of one length are numbered in one task, and the most parts.
NUMBERED, MOST_PARTS = 5_000, 4_096

PIECE = "doc_id long, piece int, start long, length int, ids_crc32 long"
_piece_arrow = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()), ("ids_crc32", pa.int64())]
)


def token_pieces(docs: DataFrame, size: int = SIZE, tokenizer: str = WORD_BPE, end_id: int = 0) -> DataFrame:
    """The pieces of all documents (doc_id, text) with their end ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_runs(batches):
            ids, counts = piece_encoder(tokenizer).encode(batch.column("text"))
            ends = np.cumsum(counts)
            ids = np.insert(ids, ends, np.uint32(end_id)).astype("<u4")
            counts = counts + 1
            begins = np.cumsum(counts) - counts
            pieces = -(-counts // size)
            owner = np.repeat(np.arange(len(counts)), pieces)
            number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            lengths = np.minimum(size, counts[owner] - number * size)
            at = begins[owner] + number * size
            raw = memoryview(ids).cast("B")
            sums = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), lengths.tolist(), strict=True)]
            columns = [batch.column("doc_id").take(pa.array(owner)), number, number * size, lengths, sums]
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, _piece_arrow, strict=True)],
                schema=_piece_arrow,
            )

    return docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")).mapInArrow(cut, PIECE)


def full_patterns(lengths: np.ndarray, size: int = SIZE, most: int = MOST_IN) -> np.ndarray:
    """All patterns of up to 3 of the given lengths with the sum ``size``: rows of lengths, longest
    first, 0 where there is none."""
    present = np.zeros(size + 1, bool)
    present[lengths] = True
    rows = [np.array([[size, 0, 0]])] if present[size] else []
    known = np.flatnonzero(present[: size + 1])
    known = known[(known > 0) & (known < size)]
    if most >= 2:
        pair = known[(2 * known >= size) & present[size - known]]
        rows.append(np.stack([pair, size - pair, 0 * pair], axis=1))
    if most >= 3:
        for a in known[3 * known >= size].tolist():
            b = known[(known <= a) & (2 * known >= size - a) & (known < size - a)]
            b = b[present[size - a - b]]
            rows.append(np.stack([np.full(len(b), a), b, size - a - b], axis=1))
    return np.concatenate(rows) if rows else np.zeros((0, 3), np.int64)


def fitted_counts(patterns: np.ndarray, histogram: np.ndarray, rounds: int = 12, steps: int = 400) -> np.ndarray:
    """Repeat counts x >= 0 that bring the patterns' lengths close to the histogram, in least squares.

    A length's error weighs by the square of its share of a sequence: what is left over of long
    lengths is hard to place, and short ones fill the gaps.

    The patterns in use grow round by round: of those that begin with the same length the one
    with the largest gradient joins. Then the counts of all in use are fitted by accelerated
    projected gradients, and those at zero leave. So few patterns carry large counts, which
    rounding hardly changes.
    """
    x = np.zeros(len(patterns))
    if not len(patterns):
        return x
    weight = (np.arange(len(histogram)) / (len(histogram) - 1)) ** 2
    target = histogram.astype(float)
    target[0] = 0
    order = np.argsort(patterns[:, 0], kind="stable")
    groups = np.flatnonzero(np.r_[True, np.diff(patterns[order, 0]) != 0])
    used = np.zeros(len(patterns), bool)
    filled = patterns > 0

    def lengths_of(rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return np.bincount(rows.ravel(), np.repeat(counts, rows.shape[1]), minlength=len(target)) * (np.arange(len(target)) > 0)

    for _ in range(rounds):
        rest = weight * (target - lengths_of(patterns, x))
        gain = (rest[patterns] * filled).sum(axis=1)
        best = np.maximum.reduceat(gain[order], groups)
        size = np.diff(np.r_[groups, len(order)])
        joins = order[(gain[order] == np.repeat(best, size)) & (gain[order] > 1e-6 * max(1.0, target.max()))]
        joins = joins[~used[joins]]
        if not len(joins):
            break
        used[joins] = True
        some = np.flatnonzero(used)
        rows = patterns[some]
        # No eigenvalue is larger than the largest sum of a row of A'A.
        every = weight * lengths_of(rows, np.ones(len(rows)))
        step = 1 / max(1e-9, float((every[rows] * filled[some]).sum(axis=1).max()))
        y = old = x[some]
        t = 1.0
        for _ in range(steps):
            slope = ((weight * (lengths_of(rows, y) - target))[rows] * filled[some]).sum(axis=1)
            new = np.maximum(0, y - step * slope)
            t_next = (1 + (1 + 4 * t * t) ** 0.5) / 2
            y = new + (t - 1) / t_next * (new - old)
            old, t = new, t_next
        x[some] = old
        used[some] = old > 0
    return x


def rounded_patterns(
    patterns: np.ndarray, counts: np.ndarray, left: np.ndarray, share: float = SHARE
) -> list[tuple[tuple[int, ...], int]]:
    """Whole repeat counts, largest first, never more than the histogram ``left`` has; it is reduced.

    Only a share of each count is taken, so that enough of all lengths is left to fill gaps with.
    """
    out = []
    for k in np.argsort(-counts, kind="stable").tolist():
        if share * counts[k] < 1:
            break
        lengths = tuple(n for n in patterns[k].tolist() if n)
        need = {n: lengths.count(n) for n in lengths}
        times = min(int(share * counts[k]), *(int(left[n]) // c for n, c in need.items()))
        if times > 0:
            out.append((lengths, times))
            for n, c in need.items():
                left[n] -= times * c
    return out


def best_fit(left: np.ndarray, size: int = SIZE) -> list[tuple[tuple[int, ...], int]]:
    """Pack the rest of a histogram, longest first, each into the fullest sequences with room for it.

    Equal sequences are one entry with a count, so the work grows with the number of different
    lengths and not with that of pieces.
    """
    free: dict[int, list[list]] = {}
    rooms: list[int] = []

    def put(room: int, lengths: tuple[int, ...], times: int) -> None:
        if room not in free:
            free[room] = []
            insort(rooms, room)
        free[room].append([lengths, times])

    for n in range(len(left) - 1, 0, -1):
        rest = int(left[n])
        while rest:
            i = bisect_left(rooms, n)
            if i == len(rooms):
                each = size // n
                if rest >= each:
                    put(size - each * n, (n,) * each, rest // each)
                if rest % each:
                    put(size - rest % each * n, (n,) * (rest % each), 1)
                break
            room = rooms[i]
            lengths, times = free[room].pop()
            if not free[room]:
                del free[room], rooms[i]
            each = room // n
            if rest >= each:
                whole = min(times, rest // each)
                put(room - each * n, lengths + (n,) * each, whole)
                rest -= whole * each
                times -= whole
            else:
                put(room - rest * n, lengths + (n,) * rest, 1)
                rest, times = 0, times - 1
            if times:
                put(room, lengths, times)
    return [(tuple(lengths), times) for entries in free.values() for lengths, times in entries]


def packing_plan(histogram: np.ndarray, size: int = SIZE) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths and how many sequences are made of each; together they use the whole histogram."""
    left = histogram.copy()
    patterns = full_patterns(np.flatnonzero(left), size)
    plan = rounded_patterns(patterns, fitted_counts(patterns, left), left)
    return plan + best_fit(left, size)


def slots_of(plan: list[tuple[tuple[int, ...], int]], size: int = SIZE) -> dict[str, np.ndarray]:
    """For each length, runs of its pieces' numbers: the first one's key, sequence and offset, sorted by key.

    A key is the length times 2^48 and the number.
    """
    keys, sequences, offsets = [], [], []
    at = np.zeros(size + 1, np.int64)
    sequence = 0
    for lengths, times in plan:
        offset = 0
        for n in lengths:
            keys.append((n << 48) + int(at[n]))
            sequences.append(sequence)
            offsets.append(offset)
            at[n] += times
            offset += n
        sequence += times
    order = np.argsort(np.array(keys, np.int64), kind="stable")
    return {
        "key": np.array(keys, np.int64)[order],
        "sequence": np.array(sequences, np.int64)[order],
        "offset": np.array(offsets, np.int64)[order],
    }


def packed(docs: DataFrame, size: int = SIZE, tokenizer: str = WORD_BPE, end_id: int = 0) -> DataFrame:
    """A row for each piece of ``docs`` (doc_id, text): doc_id, piece, start, length, ids_crc32 and
    where it is packed: sequence_id and offset."""
    pieces = stored(token_pieces(docs, size, tokenizer, end_id), "pieces")
    # A length that a third of all pieces have is numbered in parts, by hash.
    parts = min(1 + pieces.count() // NUMBERED, MOST_PARTS)
    dealt = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)))
    counts = dealt.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = stored(
        counts.select("length", "part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "bases"
    )
    histogram = np.zeros(size + 1, np.int64)
    for row in bases.groupBy("length").agg(F.sum("n").alias("n")).collect():  # ``size`` rows at most
        histogram[row["length"]] = row["n"]
    slots = slots_of(packing_plan(histogram, size), size)

    inside = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    # Its rows compress so well that a small file of them would be a large broadcast.
    numbered = dealt.join(bases.drop("n").hint("merge"), ["length", "part"]).withColumn(
        "number", F.col("base") + F.row_number().over(inside) - 1
    )
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = (batch.column("length").to_numpy().astype(np.int64) << 48) + batch.column("number").to_numpy()
            slot = np.searchsorted(slots["key"], key, "right") - 1
            sequence = slots["sequence"][slot] + key - slots["key"][slot]
            arrays = [batch.column(c) for c in columns]
            arrays[3] = arrays[3].cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(sequence), pa.array(slots["offset"][slot])], names=[*columns, "sequence_id", "offset"]
            )

    return numbered.select(*columns, "number").mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
