"""Ranked lexical search of a set of items in all documents, by accumulators inside skipping merges.

Documents are tokenised once into forward rows, their number of terms and the counts of the terms
that some item holds. These give the statistics and, a block of documents at a time, inverted
lists. In a block an item's short lists are added term by term into accumulators; the summed
accumulators are then one more list, with the largest sum as its bound, beside the long lists. Only
documents of lists whose bounds together can reach the item's tenth best score are looked at; in
the other lists, from the highest bound down, only what still can reach it is looked up, all else is
skipped. The tenth best score grows from block to block. A task returns its best documents of each
item, and the best of all tasks' are ranked.

Items are searched in blocks of at most ``QUERY_BYTES`` of distinct terms, with one pass over the
forward rows each, so neither a task nor the driver holds more; items with the same terms are
searched once. A task returns at most ``k`` rows an item.

Terms are maximal runs of digits, letters and non-ASCII characters; only A-Z are lower-cased. Null
and empty texts have no term and are not found, nor do they count; items without terms, or with no
document that scores above 0, have no rows. Texts are tokenised in runs, so very long ones need
little memory. Rows that repeat an id are documents or items of their own; documents without an id
come last among equal scores. An empty table on either side gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidetable.llm.frames import stored, text_runs

K = 10
#: Bytes of items' distinct terms that are searched in one pass.
QUERY_BYTES = 16 << 20
#: Postings that a block of documents has at most, but for a single longer one, and the first block's.
BLOCK_POSTINGS, FIRST_POSTINGS = 2_000_000, 50_000
#: A list is short if it has at most this share of the block's documents.
SHORT = 1 / 16
#: Bytes of a text that are split into terms at once.
RUN_BYTES = 1 << 20

#: The score is w * (TF * tf div (TF_SCALE * tf + LENGTH_SCALE * m)).
TF, TF_SCALE, LENGTH_SCALE = 1_000_000_000, 1000, 8
#: M is BASE - SLOPE + SLOPE * n * N div L.
BASE, SLOPE = 100, 75

#: Bytes that are no part of a term become spaces, A-Z lower case.
_BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)
_FORWARD = "doc_id long, n long, terms array<int>, counts array<int>"
_forward_arrow = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))]
)
_ITEMS = "item long, terms array<string>, counts array<int>"
_items_arrow = pa.schema([("item", pa.int64()), ("terms", pa.list_(pa.string())), ("counts", pa.list_(pa.int32()))])
_FOUND = "item long, doc_id long, score long"
_found_arrow = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def term_counts(text: str, run: int = RUN_BYTES) -> Counter[bytes]:
    """How often each term occurs in a text."""
    raw = text.encode().translate(_BYTES)
    if len(raw) <= run:
        return Counter(raw.split())
    counts: Counter[bytes] = Counter()
    begin = 0
    while begin < len(raw):
        end = raw.find(b" ", begin + run)
        end = len(raw) if end < 0 else end
        counts.update(raw[begin:end].split())
        begin = end
    return counts


def item_terms(items: DataFrame) -> DataFrame:
    """``item``, distinct terms and their counts, of items with a term (``item``, ``text``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_runs(batches):
            rows = []
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
                counts = sorted(term_counts(text or "").items())
                if counts:
                    terms = [t.decode() for t, _ in counts]
                    rows.append({"item": item, "terms": terms, "counts": [c for _, c in counts]})
            yield pa.RecordBatch.from_pylist(rows, schema=_items_arrow)

    return items.select(F.col("item").cast("long"), F.col("text").cast("string")).mapInArrow(run, _ITEMS)


def forward_rows(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Number of terms, and ids and counts of those in ``vocabulary``, of each document that has a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.keys()
        for batch in text_runs(batches):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                counts = term_counts(text or "")
                if counts:
                    held = sorted((vocabulary[t], counts[t]) for t in known & counts.keys())
                    rows.append((doc_id, counts.total(), [t for t, _ in held], [c for _, c in held]))
            columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _forward_arrow, strict=True)], schema=_forward_arrow
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _FORWARD)


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Best:
    """The ``k`` best documents of an item so far: highest score, then smallest id, missing ids last."""

    def __init__(self, k: int):
        self.k = k
        self.scores = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int64)
        self.missing = np.zeros(0, bool)

    @property
    def least(self) -> int:
        """The score that a further document must reach."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        scores = np.concatenate([self.scores, scores])
        ids, missing = np.concatenate([self.ids, ids]), np.concatenate([self.missing, missing])
        order = np.lexsort((ids, missing, -scores))[: self.k]
        self.scores, self.ids, self.missing = scores[order], ids[order], missing[order]


class Block:
    """The inverted lists of a block of documents, with what each term adds to each document's score."""

    def __init__(self, rows: list[pa.RecordBatch], weights: np.ndarray, n_docs: int, n_terms: int):
        table = pa.Table.from_batches(rows).combine_chunks()
        ids = table.column("doc_id").combine_chunks()
        self.missing = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy()
        lengths = SLOPE * table.column("n").to_numpy().astype(np.int64) * n_docs // n_terms + BASE - SLOPE
        terms = table.column("terms").combine_chunks()
        self.size = len(self.ids)
        docs = np.repeat(np.arange(self.size), terms.value_lengths().to_numpy())
        flat = terms.flatten().to_numpy()
        counts = table.column("counts").combine_chunks().flatten().to_numpy().astype(np.int64)
        order = np.argsort(flat, kind="stable")
        flat, counts, self.docs = flat[order], counts[order], docs[order]
        self.adds = weights[flat] * (TF * counts // (TF_SCALE * counts + LENGTH_SCALE * lengths[self.docs]))
        starts = np.flatnonzero(np.diff(flat, prepend=-1))
        ends = np.append(starts[1:], len(flat))
        bounds = np.maximum.reduceat(self.adds, starts) if len(starts) else starts
        self.lists = {
            t: (a, b, m) for t, a, b, m in zip(flat[starts].tolist(), starts.tolist(), ends.tolist(), bounds.tolist(), strict=True)
        }

    def search(self, query: list[tuple[int, int]], best: Best) -> None:
        """Add the block's best documents for a query of (term, times)."""
        lists = [(*self.lists[t], times) for t, times in query if t in self.lists]
        short = [x for x in lists if x[1] - x[0] <= SHORT * self.size]
        merged = [(bound * times, self.docs[a:b], self.adds[a:b], times) for a, b, bound, times in lists if b - a > SHORT * self.size]
        least = best.least
        if short:
            sums = np.zeros(self.size, np.int64)
            for a, b, _, times in short:
                sums[self.docs[a:b]] += times * self.adds[a:b]
            held = np.flatnonzero(sums)
            if len(held):
                sums = sums[held]
                merged.append((int(sums.max()), held, sums, 1))
                if len(sums) >= best.k:
                    # What the accumulators hold is a part of the score at least.
                    least = max(least, int(np.partition(sums, -best.k)[-best.k]))
        merged = [x for x in merged if x[0] > 0]
        merged.sort(key=lambda x: x[0])
        reach = np.cumsum([x[0] for x in merged])
        # Lists that cannot reach the least score even together are only looked up.
        only_looked_up = int(np.searchsorted(reach, least, side="left"))
        scores = np.zeros(self.size, np.int64)
        for _, docs, adds, times in merged[only_looked_up:]:
            scores[docs] += times * adds
        found = np.flatnonzero(scores)
        scores = scores[found]
        for at in range(only_looked_up - 1, -1, -1):
            able = scores + reach[at] >= least
            found, scores = found[able], scores[able]
            if not len(found):
                return
            _, docs, adds, times = merged[at]
            place = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
            scores += np.where(docs[place] == found, times * adds[place], 0)
        able = scores >= least
        if able.any():
            found, scores = found[able], scores[able]
            best.add(scores, self.ids[found], self.missing[found])


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Forward rows cut into blocks by their number of postings; the first ones are smaller."""
    block: list[pa.RecordBatch] = []
    held, most = 0, FIRST_POSTINGS
    for batch in batches:
        sizes = np.cumsum(batch.column("terms").value_lengths().to_numpy())
        begin = done = 0
        while begin < batch.num_rows:
            end = max(begin + (not block), int(np.searchsorted(sizes, done + most - held, side="right")))
            if end > begin:
                block.append(batch.slice(begin, end - begin))
                held += int(sizes[end - 1]) - done
                begin, done = end, int(sizes[end - 1])
            if begin < batch.num_rows:
                yield block
                block, held, most = [], 0, min(4 * most, BLOCK_POSTINGS)
    if block:
        yield block


def search_rows(
    forward: DataFrame, queries: dict[tuple[tuple[int, int], ...], list[int]], weights: np.ndarray, n_docs: int, n_terms: int, k: int
) -> DataFrame:
    """Each task's ``k`` best documents of every item; ``queries`` are the items by their (term, times)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in queries]
        for rows in blocks_of(b for b in batches if b.num_rows):
            block = Block(rows, weights, n_docs, n_terms)
            for query, found in zip(queries, best, strict=True):
                block.search(query, found)
        for items, found in zip(queries.values(), best, strict=True):
            ids = pa.array(found.ids, pa.int64(), mask=found.missing)
            for item in items if len(found.ids) else ():
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(ids)), ids, pa.array(found.scores)], schema=_found_arrow)

    return forward.mapInArrow(run, _FOUND)


def ranked(docs: DataFrame, items: DataFrame, k: int = K, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """The ``k`` highest-scoring documents (doc_id, text) of each item (item_id, text): item_id, rank
    from 1, doc_id, score."""
    spark = docs.sparkSession
    named = stored(items.select("item_id", "text").withColumn("item", F.monotonically_increasing_id()), "items")
    terms = stored(item_terms(named), "item-terms")
    size = F.aggregate("terms", F.lit(0).cast("long"), lambda n, t: n + F.octet_length(t) + 8)
    total = terms.agg(F.sum(size).alias("n")).first().n or 0
    parts = max(1, math.ceil(total / query_bytes))
    found = spark.createDataFrame([], _FOUND)
    for part in range(parts if total else 0):
        rows = terms.where(F.pmod(F.hash("item"), F.lit(parts)) == part).collect()
        if not rows:
            continue
        vocabulary = {t.encode(): i for i, t in enumerate(sorted({t for r in rows for t in r.terms}))}
        queries: dict[tuple[tuple[int, int], ...], list[int]] = {}
        for r in rows:
            query = tuple((vocabulary[t.encode()], c) for t, c in zip(r.terms, r.counts, strict=True))
            queries.setdefault(query, []).append(r.item)
        forward = stored(forward_rows(docs, vocabulary), "forward")
        sums = forward.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
        if not sums.docs:
            break
        weights = np.zeros(len(vocabulary), np.int64)
        for r in forward.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
            weights[r.t] = term_weight(sums.docs, r["count"])
        found = found.unionByName(search_rows(forward, queries, weights, sums.docs, sums.terms, k))
    found = stored(found, "found")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return top.join(named.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
