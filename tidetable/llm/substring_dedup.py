"""Substring deduplication by relative Lempel-Ziv parsing of documents against all earlier text.

Every window of ``WINDOW`` words is a place of the reference. Windows are indexed in blocks: a
block is a run of windows of one document whose smallest hash of ``GRAM`` words is the same, and
is filed under that hash, so equal windows always meet in the same place of the index, however
the documents around them differ. Each document is then factored greedily: of the matches with
earlier text that begin at or before the current word the one that reaches furthest is taken,
matches being joined into long factors where both sides go on. Since each window is looked up by
itself, windows that cross a factor's boundary are checked too. Factors have ``WINDOW`` words at
least; the words they cover are the duplicate spans.

A task resolves the windows that repeat within its own run of texts and files only first ones, so
a passage in a third of all documents reaches the index once a run of texts and not once a
document. Hashes under which more than ``HOT_SHARE`` of all blocks would meet are found first, in a
pass of its own; windows under them are filed one by one under their own hashes, so no place of the
index grows with a common phrase. What meets in a place is matched bit by bit, of which only first
windows are kept, so a task holds no more than the distinct windows of one place.

Words are runs of anything but ASCII white space. Hashes have 64 bits for the block and 48 more
for the window. Null texts have no words. A row without an id is kept whole and no reference,
since it is before or after no other. Rows that repeat an id are one document and should have one
text; each gets its result. An empty table has an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidetable.llm.encoding import mixed
from tidetable.llm.frames import stored, text_runs, whole_text

WINDOW = 20
GRAM = 10
#: Text that a task looks through at once, in bytes.
RUN = 8 << 20
#: A key is hot if it has this share of all blocks, and so many at least; there are 1 / ``HOT_SHARE`` hot keys at most.
HOT_SHARE, HOT_LEAST = 1e-6, 100
#: A run of texts reports its keys of so many blocks, and those of windows that repeat in it.
REPORTED = 3
#: Bytes of one key's windows that are held until they are matched.
MOST_HELD = 16 << 20
#: Up to so many ids of partly removed documents (8 bytes each) are broadcast to find their texts.
MOST_BROADCAST = 1_000_000

#: Kinds of rows: windows for the index, factors found within a run, a document's size and hash.
BLOCK, FACTORS, DOCUMENT = 0, 1, 2

_step = np.uint64(0x9E3779B97F4A7C15)
_factor = np.dtype([("begin", "<i4"), ("end", "<i4"), ("source", "<i8"), ("source_begin", "<i4")])
_filed = "kind int, key long, doc_id long, pos int, payload binary"
_filed_arrow = pa.schema(
    [("kind", pa.int32()), ("key", pa.int64()), ("doc_id", pa.int64()), ("pos", pa.int32()), ("payload", pa.binary())]
)


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` word hashes, unmixed."""
    n = len(words) - size + 1
    out = np.zeros(max(n, 0), np.uint64)
    for j in range(size if n > 0 else 0):
        out = out * _step + words[j : j + n]
    return out


def window_hashes(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For all windows: their hash, and the smallest hash of the grams inside."""
    n = len(words) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    grams = mixed(gram_hashes(words, GRAM))
    size = WINDOW - GRAM + 1
    low, width = grams, 1
    while 2 * width <= size:
        low = np.minimum(low[: len(low) - width], low[width:])
        width *= 2
    low = np.minimum(low[:n], low[size - width : size - width + n])
    return mixed(gram_hashes(words, WINDOW)), low


def joined_factors(doc: np.ndarray, pos: np.ndarray, source: np.ndarray, source_pos: np.ndarray):
    """Window matches, sorted by document and place, as factors: where each begins, and its last match."""
    goes_on = (
        (doc[1:] == doc[:-1])
        & (pos[1:] == pos[:-1] + 1)
        & (source[1:] == source[:-1])
        & (source_pos[1:] == source_pos[:-1] + 1)
    )
    begins = np.flatnonzero(np.r_[True, ~goes_on])
    return begins, np.r_[begins[1:], len(doc)] - 1


def first_matches(group: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows with equal windows in equal groups: the rows after their group's first, and that first row."""
    order = np.lexsort((pos, doc, group))
    g = group[order]
    begins = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.zeros(0, np.int64)
    first = np.repeat(order[begins], np.diff(np.r_[begins, len(g)]))
    later = (doc[order] != doc[first]) | (pos[order] != pos[first])
    return order[later], first[later]


class RunWindows:
    """The windows of a run of texts, and which of them repeat an earlier one of the run."""

    def __init__(self, ids: list[int | None], words: list[list[bytes]]):
        hashes, starts, owners, total = [], [], [], 0
        for i, w in zip(ids, words, strict=True):
            if i is not None and len(w) >= WINDOW:
                hashes.append(np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w)))
                starts.append(total)
                owners.append(i)
                total += len(w)
        whole, low = window_hashes(np.concatenate([np.zeros(0, np.uint64), *hashes]))
        sizes = np.array([len(h) - WINDOW + 1 for h in hashes], np.int64)
        base = np.array(starts, np.int64)
        at = np.repeat(base - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        self.doc = np.repeat(np.array(owners, np.int64), sizes)
        self.pos = at - np.repeat(base, sizes)
        self.whole, self.low = whole[at], low[at]
        self.later, self.first = first_matches(self.whole, self.doc, self.pos)
        fresh = np.ones(len(self.whole), bool)
        fresh[self.later] = False
        self.kept = np.flatnonzero(fresh)

    def cuts(self, kept: np.ndarray) -> np.ndarray:
        """Where among some first windows a block begins."""
        breaks = (
            (np.diff(kept) != 1)
            | (self.doc[kept[1:]] != self.doc[kept[:-1]])
            | (self.low[kept[1:]] != self.low[kept[:-1]])
        )
        return np.flatnonzero(np.r_[True, breaks]) if len(kept) else np.zeros(0, np.int64)


def reported_keys(run: RunWindows) -> pa.RecordBatch:
    """Numbers of blocks by key, of the keys that may be hot; under key 0 that of all blocks."""
    begins = run.kept[run.cuts(run.kept)]
    keys, counts = np.unique(run.low[begins], return_counts=True)
    repeated = np.isin(keys, run.low[run.first])
    told = (counts >= REPORTED) | repeated
    keys, counts = np.r_[np.uint64(0), keys[told]], np.r_[len(begins), counts[told]]
    return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts.astype(np.int64))], names=["key", "n"])


def look_through(ids: list[int | None], texts: list[str], hot: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """The rows that a run of texts files: its first windows in blocks, factors within it, sizes.

    Windows under the ``hot`` keys (in order) are blocks of their own, under their own hashes.
    """
    rows: list[tuple] = []
    words = [text.encode().split() for text in texts]
    for i, w in zip(ids, words, strict=True):
        digest = hashlib.sha256(b" ".join(w)).digest()
        rows.append((DOCUMENT, xxhash.xxh3_64_intdigest(digest) >> 1, i, len(w), digest))
    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _filed_arrow)], schema=_filed_arrow)
    run = RunWindows(ids, words)
    del words
    if len(run.later):
        back = np.argsort(run.later)
        yield filed_factors(run.doc, run.pos, run.later[back], run.first[back])
    is_hot = held_in(run.low[run.kept], hot)
    kept = run.kept[~is_hot]
    cuts = run.cuts(kept)
    if len(cuts):
        begins = kept[cuts]
        yield filed(BLOCK, run.low[begins].view(np.int64), run.doc[begins], run.pos[begins], packed(run.whole[kept], cuts))
    kept = run.kept[is_hot]
    if len(kept):
        keys = mixed(run.whole[kept] + _step * run.low[kept]).view(np.int64)
        yield filed(BLOCK, keys, run.doc[kept], run.pos[kept], packed(run.whole[kept], np.arange(len(kept))))


def held_in(values: np.ndarray, ordered: np.ndarray | None) -> np.ndarray:
    """Which values are among the ordered ones."""
    if ordered is None or not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def packed(whole: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Windows as binary values of 6 bytes each, one value for each block."""
    raw = np.ascontiguousarray(whole, "<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
    offsets = pa.array(np.r_[cuts, len(whole)] * 6, pa.int32())
    return pa.Array.from_buffers(pa.binary(), len(cuts), [None, offsets.buffers()[1], pa.py_buffer(raw)])


def filed_factors(doc: np.ndarray, pos: np.ndarray, later: np.ndarray, first: np.ndarray) -> pa.RecordBatch:
    """The matches of some windows with first ones as rows of factors, one for each run of a document."""
    begins, lasts = joined_factors(doc[later], pos[later], doc[first], pos[first])
    found = np.zeros(len(begins), _factor)
    found["begin"], found["end"] = pos[later[begins]], pos[later[lasts]] + WINDOW
    found["source"], found["source_begin"] = doc[first[begins]], pos[first[begins]]
    of = doc[later[begins]]
    cuts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
    payloads = [found[a:b].tobytes() for a, b in zip(cuts, np.r_[cuts[1:], len(of)], strict=True)]
    keys = mixed(of[cuts].astype(np.uint64)).view(np.int64)
    return filed(FACTORS, keys, of[cuts], np.zeros(len(cuts), np.int32), payloads)


def filed(kind: int, keys: np.ndarray, docs: np.ndarray, pos: np.ndarray, payload) -> pa.RecordBatch:
    columns = [np.full(len(keys), kind), keys, docs, pos, payload]
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, _filed_arrow, strict=True)],
        schema=_filed_arrow,
    )


def unpacked(blocks: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The row, document, place and 48 bits of each window in some blocks."""
    payload = blocks.column("payload")
    sizes = pa.compute.binary_length(payload).to_numpy() // 6
    raw = np.frombuffer(b"".join(payload.to_pylist()), np.uint8).reshape(-1, 6)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :6] = raw
    row = np.repeat(np.arange(blocks.num_rows), sizes)
    inside = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return row, blocks.column("doc_id").to_numpy()[row], blocks.column("pos").to_numpy()[row] + inside, wide.view("<u8")[:, 0]


def match_blocks(blocks: pa.RecordBatch) -> pa.RecordBatch | None:
    """Factors between blocks of the same key, a row each; rows come sorted by key and keys whole."""
    key = blocks.column("key").to_numpy()
    same = key[1:] == key[:-1]
    shared = np.flatnonzero(np.r_[False, same] | np.r_[same, False])
    if not len(shared):
        return None
    key = key[shared]
    row, doc, pos, windows = unpacked(blocks.take(pa.array(shared)))
    # 16 bits of the key's own number tell the keys of a batch apart beside the window's 48.
    number = np.cumsum(np.r_[0, key[1:] != key[:-1]]).astype(np.uint64)
    out = []
    for part in range(0, int(number[-1]) + 1, 1 << 16):
        within = (number[row] >= part) & (number[row] < part + (1 << 16))
        group = ((number[row[within]] - np.uint64(part)) << np.uint64(48)) | windows[within]
        at = np.flatnonzero(within)
        later, first = first_matches(group, doc[at], pos[at])
        out.append((at[later], at[first]))
    later, first = (np.concatenate(x) for x in zip(*out, strict=True))
    if not len(later):
        return None
    order = np.lexsort((pos[later], doc[later]))
    return filed_factors(doc, pos, later[order], first[order])


def first_blocks(blocks: pa.RecordBatch) -> tuple[pa.RecordBatch | None, pa.RecordBatch]:
    """Factors between blocks that all have one key, and blocks of the windows that come first."""
    _, doc, pos, windows = unpacked(blocks)
    later, first = first_matches(windows, doc, pos)
    fresh = np.ones(len(doc), bool)
    fresh[later] = False
    order = np.lexsort((pos[later], doc[later]))
    factors = filed_factors(doc, pos, later[order], first[order]) if len(later) else None
    kept = np.flatnonzero(fresh)
    kept = kept[np.lexsort((pos[kept], doc[kept]))]
    goes_on = (doc[kept[1:]] == doc[kept[:-1]]) & (pos[kept[1:]] == pos[kept[:-1]] + 1)
    cuts = np.flatnonzero(np.r_[True, ~goes_on])
    keys = np.full(len(cuts), blocks.column("key")[0].as_py())
    return factors, filed(BLOCK, keys, doc[kept[cuts]], pos[kept[cuts]], packed(windows[kept], cuts))


def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Matches the blocks of a partition sorted by key; the other rows pass.

    Of a key that goes on from batch to batch only first windows are kept as soon as more than
    ``MOST_HELD`` bytes are held.
    """
    held: list[pa.RecordBatch] = []
    size, most = 0, MOST_HELD
    for batch in batches:
        kind = batch.column("kind").to_numpy()
        if (kind != BLOCK).any():
            yield batch.take(pa.array(np.flatnonzero(kind != BLOCK)))
            batch = batch.take(pa.array(np.flatnonzero(kind == BLOCK)))
        if not batch.num_rows:
            continue
        key = batch.column("key").to_numpy()
        last = int(np.flatnonzero(key != key[-1])[-1]) + 1 if (key != key[-1]).any() else 0
        if held and (last or held[0].column("key")[0].as_py() != key[0]):
            whole = pa.concat_batches([*held, batch.slice(0, last)])
            held, size, most = [], 0, MOST_HELD
            if (found := match_blocks(whole)) is not None:
                yield found
        elif last and (found := match_blocks(batch.slice(0, last))) is not None:
            yield found
        held.append(batch.slice(last))
        size += held[-1].column("payload").nbytes
        if size > most:
            found, kept = first_blocks(pa.concat_batches(held))
            held, size = [kept], kept.column("payload").nbytes
            # Twice what is left, so that a place of many distinct windows is not gone through too often.
            most = max(MOST_HELD, 2 * size)
            if found is not None:
                yield found
    if held and (found := match_blocks(pa.concat_batches(held))) is not None:
        yield found


def greedy_parse(factors: np.ndarray) -> np.ndarray:
    """The factors that a greedy parse takes: always the one that reaches furthest."""
    if len(factors) < 2:
        return factors
    factors = factors[np.lexsort((factors["begin"], factors["begin"] - factors["source_begin"], factors["source"]))]
    # Matches of one source that go on or overlap in step are one long factor.
    goes_on = (
        (factors["source"][1:] == factors["source"][:-1])
        & (factors["begin"][1:] - factors["source_begin"][1:] == factors["begin"][:-1] - factors["source_begin"][:-1])
        & (factors["begin"][1:] <= factors["end"][:-1] - WINDOW + 1)
    )
    cuts = np.flatnonzero(np.r_[True, ~goes_on])
    ends = np.maximum.reduceat(factors["end"], cuts)
    factors = factors[cuts]
    factors["end"] = ends
    factors = factors[np.lexsort((-factors["end"], factors["begin"]))]
    taken, at, best, i = [], -1, None, 0
    while i < len(factors) or best is not None:
        if i < len(factors) and (best is None or factors["begin"][i] <= at):
            if best is None:
                at = max(at, int(factors["begin"][i]))
            if best is None or factors["end"][i] > factors["end"][best]:
                best = i
            i += 1
            continue
        if factors["end"][best] > at:
            taken.append(best)
            at = int(factors["end"][best])
        best = None
    return factors[taken]


def hot_keys(texts: DataFrame, share: float = HOT_SHARE, least: int = HOT_LEAST) -> np.ndarray:
    """The keys, in order, that more than ``share`` of all blocks would be filed under; 1 / ``share`` at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_runs(batches, RUN):
            words = [text.encode().split() for text in batch.column("text").to_pylist()]
            yield reported_keys(RunWindows(batch.column("doc_id").to_pylist(), words))

    counts = stored(texts.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "keys")
    total = counts.where("key = 0").head(1)
    most = max(least, share * (total[0].n if total else 0))
    found = counts.where((F.col("key") != 0) & (F.col("n") > most)).select("key").toArrow()
    return np.sort(found.column("key").to_numpy().view(np.uint64))


def parse(docs: DataFrame) -> DataFrame:
    """A row for each row of ``docs`` (doc_id, text): n_words, the hash of all its words joined by
    spaces, and its factors (begin, end, source, source_begin) in order; already stored."""

    texts = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    hot = docs.sparkSession.sparkContext.broadcast(hot_keys(texts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_runs(batches, RUN):
            yield from look_through(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), hot.value)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = []
            for parts in batch.column("payloads").to_pylist():
                found = greedy_parse(np.frombuffer(b"".join(parts or []), _factor))
                chosen.append([dict(zip(_factor.names, map(int, f), strict=True)) for f in found])
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in ("doc_id", "n_words", "digest")] + [pa.array(chosen, factors)], names=["doc_id", "n_words", "digest", "factors"])

    factors = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("source", pa.int64()), ("source_begin", pa.int32())]))
    indexed = texts.mapInArrow(run, _filed).repartition("key").sortWithinPartitions("key")
    rows = stored(indexed.mapInArrow(resolve, _filed).select("kind", "doc_id", "pos", "payload"), "matches")
    sizes = rows.where(F.col("kind") == DOCUMENT).select(
        "doc_id", F.col("pos").cast("long").alias("n_words"), F.col("payload").alias("digest")
    )
    found = rows.where(F.col("kind") == FACTORS).groupBy("doc_id").agg(F.collect_list("payload").alias("payloads"))
    return stored(
        sizes.join(found, "doc_id", "left").mapInArrow(
            choose,
            "doc_id long, n_words long, digest binary,"
            " factors array<struct<begin:int,end:int,source:long,source_begin:int>>",
        ),
        "parse",
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` without the words that its factors cover: doc_id, n_words, n_removed and
    kept_sha256, the hash of the kept words joined by spaces (lower-case hex)."""
    covered = F.aggregate(
        "factors",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("to")),
        lambda s, f: F.struct(
            (s["n"] + F.greatest(f["end"] - F.greatest(f["begin"], s["to"]), F.lit(0))).alias("n"),
            F.greatest(s["to"], f["end"]).alias("to"),
        ),
        lambda s: s["n"],
    )
    parsed = parse(docs).withColumn("n_removed", covered)
    whole = parsed.where((F.col("n_removed") == 0) | (F.col("n_removed") == F.col("n_words")))
    settled = whole.select(
        "doc_id",
        "n_words",
        "n_removed",
        F.when(F.col("n_removed") == 0, F.lower(F.hex("digest")))
        .otherwise(F.lit(hashlib.sha256(b"").hexdigest()))
        .alias("kept_sha256"),
    )
    cut = kept_texts(docs, parsed)
    return settled.unionByName(
        cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
    )


def kept_texts(docs: DataFrame, parsed: DataFrame) -> DataFrame:
    """The kept words, joined by spaces, of the documents of which a part is removed."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_runs(batches):
            kept = []
            for text, factors in zip(batch.column("text").to_pylist(), batch.column("factors").to_pylist(), strict=True):
                words = text.encode().split()
                free = np.ones(len(words), bool)
                for f in factors:
                    free[f["begin"] : f["end"]] = False
                kept.append(b" ".join(words[i] for i in np.flatnonzero(free).tolist()).decode())
            names = ["doc_id", "n_words", "n_removed"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(kept, pa.string())], names=[*names, "kept"])

    partly = parsed.where("n_removed > 0 and n_removed < n_words").dropDuplicates(["doc_id"])
    texts = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    if parsed.where("n_removed > 0 and n_removed < n_words").count() <= MOST_BROADCAST:
        texts = texts.join(F.broadcast(partly.select("doc_id")), "doc_id", "left_semi")
    return texts.join(partly.select("doc_id", "n_words", "n_removed", "factors"), "doc_id").mapInArrow(
        keep, "doc_id long, n_words long, n_removed long, kept string"
    )
