"""Language identification by bit-sliced Bloom filters of character n-grams.

One table of bit masks holds a Bloom filter for every language: the masks at an n-gram's places,
taken together with AND, tell all languages whose filter contains it. A text's languages are
counted over all its n-grams; from each count goes what the filter's own rate of false positives
explains, and the largest rest decides. The score is that rest's share of the n-grams.

The filters are fitted on a sample of labelled rows of at most ``PER_LANGUAGE`` rows or so a
language, drawn by a hash of the id. An n-gram belongs to the languages in which a share of the
sample's documents contain it, if that is no small part of its share in the language where it is
most usual; so a stray sentence in another language doesn't blur the filters.

Texts are lower-cased; runs of anything but letters are one space. Null texts and texts without a
letter are ``und`` with score 0, as are all texts if nothing was labelled. Between equal counts
the language with more labelled rows decides, then the name. Rows with a null id are neither held
out nor learned from; repeated rows are predicted alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidetable.llm.encoding import mixed
from tidetable.llm.frames import row_struct, stored, text_runs, whole_text

SIZES = (3, 4)
#: Labelled rows of a language that the filters are fitted on, about.
PER_LANGUAGE = 4_000
#: Share of a language's documents that contain its n-grams, and least number of them (1 if it has one).
LEAST_SHARE, LEAST_DOCS = 0.002, 2
#: Part of an n-gram's largest share in a language that its share in another must have.
LEAST_PART = 0.2
#: Places of the table, and places an n-gram has.
PLACES, HASHES = 1 << 20, 4

#: Code points of a text that are taken at once; longer ones are cut into such runs.
RUN = 1 << 20

UNKNOWN = "und"

_odd = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def grams_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all n-grams of some texts, the text of each, and which texts have a letter."""
    lowered = [f" {t.lower()} " if t else "" for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "replace"), np.uint32)
    sizes = np.fromiter(map(len, lowered), np.int64, len(lowered))
    of = np.repeat(np.arange(len(texts)), sizes)
    letter = letters()[codes]
    any_letter = np.bincount(of[letter], minlength=len(texts)) > 0
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
    codes, of = np.where(letter, codes, 32)[keep].astype(np.uint64), of[keep]
    hashes, owners = [], []
    for n in SIZES:
        if len(codes) < n:
            continue
        value = np.full(len(codes) - n + 1, n, np.uint64)
        for j in range(n):
            value = value * _odd + codes[j : len(codes) - n + 1 + j]
        inside = of[n - 1 :] == of[: len(of) - n + 1]
        hashes.append(mixed(value[inside]))
        owners.append(of[: len(of) - n + 1][inside])
    none = np.zeros(0, np.int64)
    return np.concatenate([none.astype(np.uint64), *hashes]), np.concatenate([none, *owners]), any_letter


def run_grams(text: str, run: int | None = None) -> Iterator[np.ndarray]:
    """The hashes of one text's n-grams in runs of so many code points, each n-gram in one of them.

    They are those of :func:`grams_of`, for texts too long to be taken at once.
    """
    run = run or RUN
    lowered = f" {text.lower()} "
    tail = np.zeros(0, np.uint64)
    after_letter = True
    for begin in range(0, len(lowered), run):
        codes = np.frombuffer(lowered[begin : begin + run].encode("utf-32-le", "replace"), np.uint32)
        letter = letters()[codes]
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        keep[0] |= after_letter
        after_letter = bool(letter[-1])
        new = np.where(letter, codes, 32)[keep].astype(np.uint64)
        held = np.concatenate([tail, new])
        for n in SIZES:
            # Those that end in the new part; the tail has at most what the longest of them needs.
            first = max(0, len(tail) - n + 1)
            count = len(held) - n + 1 - first
            if count > 0:
                value = np.full(count, n, np.uint64)
                for j in range(n):
                    value = value * _odd + held[first + j : first + j + count]
                yield mixed(value)
        tail = held[-(max(SIZES) - 1) :]


def distinct_grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of some texts and the text of each; of a long text each n-gram once."""
    hashes, of, _ = grams_of([t if t and len(t) <= RUN else None for t in texts])
    parts, owners = [hashes], [of]
    for k, text in enumerate(texts):
        if text and len(text) > RUN:
            found = np.zeros(0, np.uint64)
            for grams in run_grams(text):
                found = np.union1d(found, grams)
            parts.append(found)
            owners.append(np.full(len(found), k))
    return np.concatenate(parts), np.concatenate(owners)


def places_of(hashes: np.ndarray) -> Iterator[np.ndarray]:
    """The table places of n-grams, one array for each hash."""
    first = hashes & np.uint64(0xFFFFFFFF)
    second = (hashes >> np.uint64(32)) | np.uint64(1)
    for k in range(HASHES):
        yield ((first + np.uint64(k) * second) % np.uint64(PLACES)).astype(np.int64)


@dataclass
class LanguageFilters:
    """The languages in the order that breaks ties, the table of masks, and each filter's false positives.

    ``table`` has a row a place and a column for every 64 languages.
    """

    languages: list[str]
    table: np.ndarray
    false_rate: np.ndarray

    def hits(self, hashes: np.ndarray, of: np.ndarray, n_texts: int) -> np.ndarray:
        """For each text the number of its n-grams that each language's filter contains."""
        masks = None
        for place in places_of(hashes):
            found = self.table[place]
            masks = found if masks is None else masks & found
        hits = np.zeros((n_texts, len(self.languages)))
        width = 8 * self.table.dtype.itemsize
        for k in range(len(self.languages)):
            has = (masks[:, k // width] >> self.table.dtype.type(k % width)) & self.table.dtype.type(1)
            hits[:, k] = np.bincount(of[has.astype(bool)], minlength=n_texts)
        return hits

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language and score of each text, and its number of n-grams."""
        hashes, of, any_letter = grams_of([t if t and len(t) <= RUN else None for t in texts])
        totals = np.bincount(of, minlength=len(texts))
        hits = self.hits(hashes, of, len(texts))
        for k, text in enumerate(texts):
            if text and len(text) > RUN:
                any_letter[k] = any(map(str.isalpha, text.lower()))
                for grams in run_grams(text):
                    totals[k] += len(grams)
                    hits[k] += self.hits(grams, np.zeros(len(grams), np.int64), 1)[0]
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), totals
        rest = (hits - totals[:, None] * self.false_rate) / (1 - self.false_rate)
        best = rest.argmax(axis=1)
        score = np.clip(rest[np.arange(len(texts)), best] / np.maximum(totals, 1), 0, 1)
        named = [self.languages[k] if has else UNKNOWN for k, has in zip(best.tolist(), any_letter.tolist(), strict=True)]
        return named, np.where(any_letter, score, 0.0), totals


def held_out() -> Column:
    """Whether a document is kept from fitting, by the checksum of its id."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit_filters(docs: DataFrame, per_language: int = PER_LANGUAGE) -> LanguageFilters:
    """Filters from the labelled rows of ``docs`` (doc_id, text, lang) that aren't held out."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes, key=lambda lang: (-sizes[lang], lang))
    if not languages:
        return LanguageFilters([], np.zeros((PLACES, 1), np.uint8), np.zeros(0))
    number = F.create_map(*[F.lit(x) for k, lang in enumerate(languages) for x in (lang, k)])
    share = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, per_language / sizes[lang]))])
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < (1 << 20) * share[F.col("lang")]
    sample = labelled.where(drawn).select(number[F.col("lang")].alias("language"), whole_text().alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_runs(batches):
            hashes, of = distinct_grams(batch.column("text").to_pylist())
            # Each document counts an n-gram once.
            order = np.lexsort((hashes, of))
            hashes, of = hashes[order], of[order]
            first = np.r_[True, (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])][: len(hashes)]
            language = batch.column("language").to_numpy()[of[first]]
            hashes = hashes[first]
            order = np.lexsort((hashes, language))
            hashes, language = hashes[order], language[order]
            begins = np.flatnonzero(np.r_[True, (hashes[1:] != hashes[:-1]) | (language[1:] != language[:-1])][: len(hashes)])
            yield pa.RecordBatch.from_pydict(
                {
                    "gram": pa.array(hashes[begins].view(np.int64)),
                    "language": pa.array(language[begins].astype(np.int32)),
                    "n": pa.array(np.diff(np.r_[begins, len(hashes)])),
                }
            )
            counts = np.bincount(batch.column("language").to_numpy(), minlength=len(languages))
            # The n-gram 0 stands for the documents themselves.
            yield pa.RecordBatch.from_pydict(
                {
                    "gram": pa.array(np.zeros(len(languages), np.int64)),
                    "language": pa.array(np.arange(len(languages), dtype=np.int32)),
                    "n": pa.array(counts),
                }
            )

    counted = stored(
        sample.mapInArrow(count, "gram long, language int, n long").groupBy("gram", "language").agg(F.sum("n").alias("n")),
        "grams",
    )
    drawn_docs = {r["language"]: r["n"] for r in counted.where("gram = 0").collect()}
    sampled = F.create_map(*[F.lit(x) for k in range(len(languages)) for x in (k, float(max(1, drawn_docs.get(k, 0))))])
    part = F.col("n") / sampled[F.col("language")]
    largest = F.max("share").over(Window.partitionBy("gram"))
    kept = (
        counted.where((F.col("gram") != 0) & (F.col("n") >= F.least(F.lit(LEAST_DOCS), sampled[F.col("language")])))
        .select("gram", "language", part.alias("share"))
        .where(F.col("share") >= LEAST_SHARE)
        .select("gram", "language", "share", largest.alias("largest"))
        .where(F.col("share") >= LEAST_PART * F.col("largest"))
        .select("gram", "language")
        .toArrow()  # bounded by the sample: each kept n-gram is in a fixed share of its documents
    )
    return build_filters(languages, kept.column("gram").to_numpy().view(np.uint64), kept.column("language").to_numpy())


def build_filters(languages: list[str], grams: np.ndarray, owner: np.ndarray) -> LanguageFilters:
    """The table of n-grams and the number of the language that each belongs to."""
    kind = next((t for t in (np.uint8, np.uint16, np.uint32) if 8 * t().itemsize >= len(languages)), np.uint64)
    width = 8 * kind().itemsize
    table = np.zeros((PLACES, -(-len(languages) // width)), kind)
    for k in range(len(languages)):
        bit = kind(1) << kind(k % width)
        for place in places_of(grams[owner == k]):
            table[place, k // width] |= bit
    filled = [((table[:, k // width] >> kind(k % width)) & kind(1)).mean() for k in range(len(languages))]
    return LanguageFilters(languages, table, np.minimum(np.array(filled) ** HASHES, 0.99))


def with_language(docs: DataFrame, filters: LanguageFilters, keep: list[str] | None = None) -> DataFrame:
    """``lang_pred``, ``score`` and ``n_grams`` of each row, whose columns (or those to keep) are in
    the struct ``row``; only the text decides."""
    model = docs.sparkSession.sparkContext.broadcast(filters)  # a table of fixed size
    packed = docs.select(row_struct(docs if keep is None else docs.select(*keep)).alias("row"), F.col("text").cast("string").alias("text"))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_runs(batches):
            lang, score, n = model.value.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(n, pa.int64())],
                names=["row", "lang_pred", "score", "n_grams"],
            )

    found = [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("n_grams", T.LongType())]
    schema = T.StructType([packed.schema["row"], *(T.StructField(name, kind) for name, kind in found)])
    return packed.mapInArrow(predict, schema)


def languages(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred, score and n_grams for every row of ``docs`` (doc_id, text, lang)."""
    filters = fit_filters(docs, per_language)
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    found = with_language(rows, filters, ["doc_id", "held_out"])
    return found.select("row.doc_id", "row.held_out", "lang_pred", "score", "n_grams")


def with_known_language(docs: DataFrame, least_score: float, per_language: int = PER_LANGUAGE) -> DataFrame:
    """``docs`` without the rows that have no language: ``und``, or a score under ``least_score``."""
    marked = with_language(docs, fit_filters(docs, per_language))
    return marked.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score)).select("row.*")
