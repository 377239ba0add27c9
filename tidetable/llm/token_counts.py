"""Exact token counts at every prefix of a text, by dynamic programming over byte-pair tokens.

A sequence of tokens is the encoding of its text exactly when every two neighbours are the
encoding of theirs. So the encoding of a prefix is the encoding of a shorter prefix and one more
token that goes with its last one; each prefix needs only its last token and its count. A text is
the sequence of its words as the vocabulary's pattern cuts them, and the tables of distinct words
are kept by the worker.

Null texts are empty: no tokens, and the empty prefix fits any budget. Repeated rows stay
repeated, an empty table gives an empty result; null ids stay null.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidetable.llm.encoding import BYTE_BPE, LONE_SPACES, PieceTable, text_bytes, tokenizer_path
from tidetable.llm.frames import text_runs, whole_text

# Fixed values of the public byte-level vocabularies: the pattern that cuts text into words,
# and the bytes that stand for themselves in the token strings.
WORDS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
LONG_ENDINGS = ("'re", "'ve", "'ll")
SELF_SHOWN = (range(33, 127), range(161, 173), range(174, 256))

#: Bounds of the worker's tables of token pairs and of words.
MOST_PAIRS, MOST_WORDS = 1_000_000, 400_000

_words = regex.compile(WORDS)
_white = regex.compile(r"\p{White_Space}+")

SUMMARY = "doc_id long, n_bytes long, n_tokens long, budget_chars long"


def byte_of_sign() -> dict[str, int]:
    """The byte that each sign of a token string stands for."""
    shown = {b for r in SELF_SHOWN for b in r}
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class PrefixCounter(PieceTable):
    """Counts tokens at every code point of texts, for a byte-level vocabulary file.

    Where white space stands beside a space, the end of a prefix may change the word before it;
    there a text is not cut into pieces.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            saved = json.load(f)
        self.added = [t["content"] for t in saved["added_tokens"]]
        sign, vocab = byte_of_sign(), saved["model"]["vocab"]
        added = set(self.added)
        self.ids = {bytes(sign[c] for c in t): i for t, i in vocab.items() if t not in added}
        self.bytes = {i: b for b, i in self.ids.items()}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(saved["model"]["merges"]):
            self.merges[vocab[a], vocab[b]] = rank, vocab[a + b]
        #: Finds at every end of a text the tokens that end there, bytes written as latin-1 signs.
        self.suffixes = ahocorasick.Automaton()
        for raw, i in self.ids.items():
            self.suffixes.add_word(raw.decode("latin-1"), (len(raw), i))
        self.suffixes.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.words: dict[str, list[int]] = {}
        super().__init__(LONE_SPACES, self.added)

    def merged(self, raw: bytes) -> list[int]:
        """The ids of ``raw`` by merging its bytes, lowest rank first."""
        ids = [self.ids[raw[i : i + 1]] for i in range(len(raw))]
        while len(ids) > 1:
            found = [(self.merges[p][0], k) for k, p in enumerate(zip(ids, ids[1:], strict=False)) if p in self.merges]
            if not found:
                break
            _, k = min(found)
            ids[k : k + 2] = [self.merges[ids[k], ids[k + 1]][1]]
        return ids

    def go_together(self, left: int, right: int) -> bool:
        """Whether the two tokens are the encoding of their bytes; -1 on the left is the text's begin."""
        if left < 0:
            fits = self.merged(self.bytes[right]) == [right]
        else:
            fits = self.merged(self.bytes[left] + self.bytes[right]) == [left, right]
        if len(self.pairs) > MOST_PAIRS:
            self.pairs.clear()
        self.pairs[left, right] = fits
        return fits

    def byte_counts(self, raw: bytes) -> list[int]:
        """Token counts of all prefixes of one word, the empty one first."""
        last, counts = [-1] * (len(raw) + 1), [0] * (len(raw) + 1)
        known = self.pairs.get
        for at, (size, token) in self.suffixes.iter(raw.decode("latin-1")):
            end = at + 1
            if not counts[end]:
                fits = known((last[end - size], token))
                if fits is None:
                    fits = self.go_together(last[end - size], token)
                if fits:
                    last[end], counts[end] = token, counts[end - size] + 1
        return counts

    def word_counts(self, word: str) -> list[int]:
        """Counts after each code point of one word."""
        known = self.words.get(word)
        if known is None:
            raw = word.encode()
            known = self.byte_counts(raw)[1:]
            if len(raw) != len(word):
                known = [known[i] for i in range(len(raw)) if i + 1 == len(raw) or raw[i + 1] & 0xC0 != 0x80]
            if word in LONG_ENDINGS:
                known = [known[0], 2, known[2]]  # cut short, the pattern takes its signs apart
            if len(self.words) > MOST_WORDS:
                self.words.clear()
            self.words[word] = known
        return known

    def plain_counts(self, text: str) -> list[int]:
        """Counts after each code point of a text without special strings."""
        out: list[int] = []
        base, before = 0, ""
        for word in _words.findall(text):
            inner = self.word_counts(word)
            begin = len(out)
            out += [base + n for n in inner]
            if before and _white.match(word[0]) and _white.fullmatch(before):
                # A prefix that ends here ends in one run of white space.
                joined = self.word_counts(before + word[0])[-1]
                out[begin] = base - self.word_counts(before)[-1] + joined
            base += inner[-1]
            before = word
        return out

    def text_counts(self, text: str) -> list[int]:
        """Counts after each code point; a special string is one token once it is complete."""
        out: list[int] = []
        base, rest = 0, text
        while found := [(rest.find(s), s) for s in self.added if s in rest]:
            at, special = min(found)
            out += [base + n for n in self.plain_counts(rest[:at] + special[:-1])]
            base = (out[len(out) - len(special)] if at else base) + 1
            out.append(base)
            rest = rest[at + len(special) :]
        return out + [base + n for n in self.plain_counts(rest)]

    def learn(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = [self.plain_counts(p.decode()) for p in pieces]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes

    def prefix_counts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The counts after each code point of all texts in a row, and the texts' code points."""
        data, bounds = text_bytes(column)
        starts, stops = self.pieces(data, bounds)
        found = self.look_up(data, starts, stops)
        counts, sizes = self.values(found)
        after = np.cumsum(sizes)
        totals = np.r_[0, np.cumsum(counts[after - 1], dtype=np.int64)] if len(after) else np.zeros(1, np.int64)
        pieces = np.searchsorted(starts, bounds)
        bases = totals[:-1] - np.repeat(totals[pieces[:-1]], np.diff(pieces))
        counts = counts + np.repeat(bases, sizes)
        chars = np.diff(np.r_[0, after][pieces])
        if len(held := self.held_special(data, bounds)):
            rows = np.split(counts, np.cumsum(chars)[:-1])
            for k in held.tolist():
                rows[k] = np.array(self.text_counts(column[k].as_py()), np.int64)
            counts, chars = np.concatenate(rows), np.array([len(r) for r in rows])
        return counts, chars


@lru_cache(maxsize=2)
def prefix_counter(name: str) -> PrefixCounter:
    """The worker's counter for a vocabulary file."""
    return PrefixCounter(tokenizer_path(name))


def count_tokens(docs: DataFrame, budget: int, tokenizer: str = BYTE_BPE) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): its bytes, its tokens, and how many code points
    its longest prefix of at most ``budget`` tokens has, all read from its table of prefix counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_runs(batches):
            counter = prefix_counter(tokenizer)
            counts, chars = counter.prefix_counts(batch.column("text"))
            ends = np.cumsum(chars)
            tokens = np.where(chars > 0, counts[np.maximum(ends - 1, 0)], 0) if len(counts) else chars
            places = np.arange(1, len(counts) + 1) - np.repeat(ends - chars, chars)
            filled = np.flatnonzero(chars)
            fitting = np.zeros(len(chars), np.int64)
            if len(filled):
                fits = np.where(counts <= budget, places, 0)
                fitting[filled] = np.maximum.reduceat(fits, (ends - chars)[filled])
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_bytes": pa.compute.cast(pa.compute.binary_length(batch.column("text")), pa.int64()),
                    "n_tokens": pa.array(tokens, pa.int64()),
                    "budget_chars": pa.array(fitting, pa.int64()),
                }
            )

    return docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")).mapInArrow(count, SUMMARY)


def prefix_tables(docs: DataFrame, tokenizer: str = BYTE_BPE) -> DataFrame:
    """``doc_id`` and ``counts``: the token count after each code point of the text.

    :func:`tokens_before` and :func:`longest_within` read it without encoding again.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_runs(batches, 1 << 20):
            counter = prefix_counter(tokenizer)
            counts, chars = counter.prefix_counts(batch.column("text"))
            tables = pa.ListArray.from_arrays(np.r_[0, np.cumsum(chars)].astype(np.int32), counts.astype(np.int32))
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "counts": tables}
            )

    return docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")).mapInArrow(
        count, "doc_id long, counts array<int>"
    )


def tokens_before(counts: Column, chars: Column | int) -> Column:
    """Tokens of the prefix of so many code points; of the whole text where it is shorter."""
    n = F.least(F.lit(chars) if isinstance(chars, int) else chars, F.size(counts))
    return F.when(n <= 0, F.lit(0)).otherwise(F.element_at(counts, F.greatest(n, F.lit(1))))


def longest_within(counts: Column, budget: Column | int) -> Column:
    """Code points of the longest prefix of at most ``budget`` tokens."""
    most = F.lit(budget) if isinstance(budget, int) else budget
    places = F.sequence(F.lit(0), F.size(counts))
    return F.array_max(
        F.filter(places, lambda i: (i == 0) | (F.element_at(counts, F.greatest(i, F.lit(1))) <= most))
    )
