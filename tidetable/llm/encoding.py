"""Token ids of whole texts from a tokenizer file, with each distinct piece encoded once.

The library decides every id. A text is cut only where the tokenizer itself never joins the two
sides, the pieces repeat, and so most of them come from a table that the worker keeps. All of
this runs on a record batch's bytes at once; only new pieces become Python strings.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"

#: Bound of a worker's table: pieces, their values and the longest piece that is kept.
MOST_PIECES, MOST_VALUES, LONGEST = 2_000_000, 16_000_000, 64

#: Where a text may be cut: at ASCII white space, which is dropped; before a space that no white
#: space follows; or before such a space that none comes before either. All are also cut between
#: an ASCII letter and a punctuation mark, and the last two after a single line end before a letter.
WORDS, SPACES, LONE_SPACES = "words", "spaces", "lone spaces"

_white = np.zeros(256, bool)
_white[[9, 10, 11, 12, 13, 32]] = True
_letter, _mark = np.zeros(256, bool), np.zeros(256, bool)
_letter[65:91] = _letter[97:123] = True
_mark[33:48] = _mark[58:65] = _mark[91:97] = _mark[123:127] = True
_odd = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values spread over all bits, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_byte_hash = mixed(np.arange(1, 257, dtype=np.uint64) * _odd)


def tokenizer_path(name: str) -> str:
    """Where the vocabulary file lies on this machine; a name with a slash is a path already."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without nulls, and where each text begins; the end comes last."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def powers(n: int) -> np.ndarray:
    return np.multiply.accumulate(np.r_[np.uint64(1), np.full(max(n, 1) - 1, _odd)])


class PieceTable:
    """Values (a few numbers) of the pieces of texts, kept by the hash of a piece's bytes.

    A subclass says what the values of new pieces are, and of texts that hold a special string,
    which are not cut.
    """

    def __init__(self, cut: str, special: list[str]):
        self.cut, self.special = cut, [s.encode() for s in special]
        self.power = powers(1 << 12)
        self.forget()

    def learn(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        raise NotImplementedError

    def forget(self) -> None:
        self.mask = (1 << 22) - 1
        self.keys = np.zeros(self.mask + 1, np.uint64)
        self.at = np.zeros(self.mask + 1, np.int32)
        self.count = self.used = 0
        self.flat = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 14, np.int64)
        self.sizes = np.zeros(1 << 14, np.int32)

    def pieces(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the pieces of all texts begin and end."""
        n = len(data)
        if self.cut == WORDS:
            inside = ~_white[data]
            edge = np.zeros(n + 1, bool)
            edge[bounds] = True
            edge[1:n] |= _mark[data[1:]] & _letter[data[:-1]]
            begins = inside & (edge[:n] | ~np.r_[True, inside[:-1]])
            ends = inside & (edge[1:] | ~np.r_[inside[1:], True])
            return np.flatnonzero(begins), np.flatnonzero(ends) + 1
        padded = np.r_[data, np.full(3, 32, np.uint8)]
        b1, b2 = padded[1 : n + 1], padded[2 : n + 2]
        # White space beyond ASCII begins with C2, or with E1 to E3 and one of three bytes.
        late = (b2 == 0x80) | (b2 == 0x81) | (b2 == 0x9A)
        blank_after = _white[b1] | ((b1 == 0xC2) & ((b2 == 0x85) | (b2 == 0xA0))) | ((b1 >= 0xE1) & (b1 <= 0xE3) & late)
        begins = (data == 32) & ~blank_after
        if self.cut == LONE_SPACES:
            padded = np.r_[np.full(3, 65, np.uint8), data]
            b1, b2, b3 = padded[2 : n + 2], padded[1 : n + 1], padded[:n]
            late = (b2 == 0x80) | (b2 == 0x81) | (b2 == 0x9A)
            begins &= ~(_white[b1] | ((b2 == 0xC2) & ((b1 == 0x85) | (b1 == 0xA0))) | ((b3 >= 0xE1) & (b3 <= 0xE3) & late))
        # A space that ends a text is part of its last piece.
        last = bounds[1:][bounds[1:] > bounds[:-1]] - 1
        begins[last] = False
        begins[1:] |= _mark[data[1:]] & _letter[data[:-1]]
        begins[2:] |= _letter[data[2:]] & (data[1:-1] == 10) & (_mark | _letter)[data[:-2]]
        begins[bounds[:-1][bounds[1:] > bounds[:-1]]] = True
        starts = np.flatnonzero(begins)
        return starts, np.r_[starts[1:], n][: len(starts)]

    def hashes(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        sizes = stops - starts
        total = int(sizes.sum())
        if not total:
            return np.zeros(0, np.uint64)
        if (longest := int(sizes.max())) > len(self.power):
            self.power = powers(2 * longest)
        first = np.cumsum(sizes) - sizes
        inside = np.arange(total) - np.repeat(first, sizes)
        low, high = int(starts[0]), int(stops[-1])
        kept = data[low:high] if total == high - low else data[inside + np.repeat(starts, sizes)]
        sums = np.add.reduceat(_byte_hash[kept] * self.power[inside], first)
        return np.maximum(mixed(sums + sizes.astype(np.uint64) * _odd), np.uint64(1))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash's piece, -1 where it is not known."""
        found = np.full(len(hashes), -1, np.int64)
        rest = np.arange(len(hashes))
        place = (hashes & np.uint64(self.mask)).astype(np.int64)
        while len(rest):
            held = self.keys[place]
            hit = held == hashes[rest]
            found[rest[hit]] = self.at[place[hit]]
            on = ~hit & (held != 0)
            rest, place = rest[on], (place[on] + 1) & self.mask
        return found

    def keep(self, hashes: np.ndarray, numbers: np.ndarray) -> None:
        place = (hashes & np.uint64(self.mask)).astype(np.int64)
        while len(hashes):
            free = self.keys[place] == 0
            self.keys[place[free]] = hashes[free]
            won = self.keys[place] == hashes
            self.at[place[won]] = numbers[won]
            hashes, numbers, place = hashes[~won], numbers[~won], (place[~won] + 1) & self.mask

    def add(self, hashes: np.ndarray, pieces: list[bytes]) -> np.ndarray:
        """Learn new pieces; their numbers. Long ones are not kept beyond this batch."""
        values, sizes = self.learn(pieces)
        while self.count + len(pieces) > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.sizes = np.concatenate([self.sizes, np.zeros_like(self.sizes)])
        while self.used + len(values) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        numbers = np.arange(self.count, self.count + len(pieces))
        self.flat[self.used : self.used + len(values)] = values
        self.sizes[numbers] = sizes
        self.starts[numbers] = self.used + np.cumsum(sizes) - sizes
        self.count += len(pieces)
        self.used += len(values)
        short = np.fromiter(map(len, pieces), np.int64, len(pieces)) <= LONGEST
        self.keep(hashes[short], numbers[short])
        return numbers

    def look_up(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray, some: int = 1 << 20) -> np.ndarray:
        """The numbers of all pieces, looked up in runs of a bounded number."""
        if self.count > MOST_PIECES or self.used > MOST_VALUES:
            self.forget()
        parts = [self.numbers(data, starts[i : i + some], stops[i : i + some]) for i in range(0, len(starts), some)]
        return np.concatenate([np.zeros(0, np.int64), *parts])

    def numbers(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        hashes = self.hashes(data, starts, stops)
        found = self.find(hashes)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new, first, back = np.unique(hashes[missing], return_index=True, return_inverse=True)
            which = missing[first]
            low = int(starts[0])
            raw = data[low : int(stops[-1])].tobytes()
            begins, ends = (starts[which] - low).tolist(), (stops[which] - low).tolist()
            found[missing] = self.add(new, [raw[a:b] for a, b in zip(begins, ends, strict=True)])[back]
        return found

    def values(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of numbered pieces in a row, and how many each has."""
        sizes = self.sizes[found].astype(np.int64)
        after = np.cumsum(sizes)
        total = int(after[-1]) if len(after) else 0
        return self.flat[np.repeat(self.starts[found] - (after - sizes), sizes) + np.arange(total)], sizes

    def held_special(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Numbers of the texts that hold a special string."""
        held: set[int] = set()
        for special in self.special:
            near = (data[:-1] == special[0]) & (data[1:] == special[1])
            for text in np.unique(np.searchsorted(bounds, np.flatnonzero(near), "right") - 1).tolist():
                if special in data[bounds[text] : bounds[text + 1]].tobytes():
                    held.add(text)
        return np.array(sorted(held), np.int64)


class PieceEncoder(PieceTable):
    """Encodes texts as the library does, without added special tokens.

    A tokenizer that drops white space is cut at it, a byte-level one before single spaces.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        tokens = map(self.tokenizer.id_to_token, range(size))
        #: Which tokens begin with a space, as byte-level vocabularies write it.
        self.begins = np.array([t is not None and t.startswith("Ġ") for t in tokens])
        self.line_end = self.tokenizer.token_to_id("Ċ")
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        super().__init__(WORDS if '"behavior":"Removed"' in self.tokenizer.to_str() else SPACES, special)

    def apart(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of strings encoded one by one: all in a row, and how many each has."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes

    def learn(self, pieces: list[bytes], group: int = 100) -> tuple[np.ndarray, np.ndarray]:
        """Ids of new pieces, many to a string where their ids can be told apart again."""
        texts = [p.decode() for p in pieces]
        if self.cut == WORDS:
            parts = [self.together(texts[i : i + group]) for i in range(0, len(texts), group)]
            return tuple(np.concatenate(x) for x in zip(*parts, strict=True))
        spaced = np.array([t[0] == " " and t.rfind(" ") == 0 and len(t) > 1 for t in texts])
        bare = np.array([not any(c.isspace() for c in t) for t in texts])
        groups = [
            ([texts[k] for k in np.flatnonzero(spaced).tolist()], "", group),
            ([texts[k] for k in np.flatnonzero(bare).tolist()], "\n", group),
            ([texts[k] for k in np.flatnonzero(~spaced & ~bare).tolist()], "", 1),
        ]
        which = np.where(spaced, 0, np.where(bare, 1, 2))
        sizes = np.zeros(len(texts), np.int64)
        found = [self.joined(*g) for g in groups]
        for k, (_, part) in enumerate(found):
            sizes[which == k] = part
        out, of = np.zeros(int(sizes.sum()), np.uint32), np.repeat(which, sizes)
        for k, (ids, _) in enumerate(found):
            out[of == k] = ids
        return out, sizes

    def joined(self, texts: list[str], between: str, group: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of strings encoded ``group`` at a time: each begins with the only space in it, or has
        no white space and stands alone on a line."""
        if group == 1 or not texts:
            return self.apart(texts)
        ids, per_line = self.apart([between.join(texts[i : i + group]) for i in range(0, len(texts), group)])
        if not between:
            begins = np.flatnonzero(self.begins[ids])
            sizes = np.diff(begins, append=len(ids))
        else:
            ends = np.r_[ids == self.line_end]
            begins = np.zeros(len(ids) + 1, bool)
            begins[np.r_[0, np.cumsum(per_line)]] = True
            begins[1:] |= ends
            sizes = np.diff(np.flatnonzero(begins)) - np.add.reduceat(ends, np.flatnonzero(begins)[:-1])
            ids = ids[~ends]
        if len(sizes) != len(texts) or (len(sizes) and sizes.min() < 1) or sizes.sum() != len(ids):
            return self.apart(texts)
        return ids, sizes

    def together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
        begins = np.cumsum([0, *(len(w) + 1 for w in words)])
        at = np.fromiter((a for a, _ in found.offsets), np.int64, len(found.ids))
        return np.array(found.ids, np.uint32), np.diff(np.searchsorted(at, begins))

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a string column in a row, and how many each text has."""
        data, bounds = text_bytes(column)
        starts, stops = self.pieces(data, bounds)
        found = self.look_up(data, starts, stops)
        ids, sizes = self.values(found)
        after = np.r_[0, np.cumsum(sizes)]
        counts = np.diff(after[np.searchsorted(starts, bounds)])
        if len(held := self.held_special(data, bounds)):
            # A special string also ends a run of spaces before it, and must not be cut itself.
            rows = np.split(ids, np.cumsum(counts)[:-1])
            for k in held.tolist():
                rows[k], _ = self.apart([column[k].as_py()])
            ids, counts = np.concatenate(rows), np.array([len(r) for r in rows])
        return ids, counts


@lru_cache(maxsize=4)
def piece_encoder(name: str) -> PieceEncoder:
    """The worker's encoder for a tokenizer file."""
    return PieceEncoder(tokenizer_path(name))
