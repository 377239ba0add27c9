"""Tokenizing operators against the library itself: pieces, prefix counts, token files, packing."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidetable.llm import packing, token_counts, token_files
from tidetable.llm.encoding import BYTE_BPE, WORD_BPE, piece_encoder, tokenizer_path
from tidetable.llm.frames import find_code

DATA = "/root/testdata/sf0.001"
ODD = [
    "", " ", "  ", "a  b", "a \n b\n c", " a", "a ", "x<|endoftext|> y\n <|endoftext|>z", "é é ΟΔΟΣ Σ. İ",
    "\x1c a\x85b\xa0c 　 d", "a\n b", "\n\n a", "it's  don't 's we'll've", "́a ́b", "汉字 漢 字", "A.B,C!\nD",
]


@pytest.fixture(scope="module")
def library():
    return {name: Tokenizer.from_file(tokenizer_path(name)) for name in (BYTE_BPE, WORD_BPE)}


@pytest.fixture(scope="module")
def docs(spark):
    """The driver's documents and rows with nulls, empty and long texts, ties and other columns."""
    find_code(spark)
    real = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang")
    extra = [(5000 + i, t, "x") for i, t in enumerate(ODD)]
    extra += [(None, "no id", None), (6000, None, None), (6001, "long word " * 30_000, "y"), (7, "again", "z"), (7, "again", "z")]
    return real.unionByName(spark.createDataFrame(extra, "doc_id long, text string, lang string"))


@pytest.mark.parametrize("name", [BYTE_BPE, WORD_BPE])
def test_pieces_give_the_library_ids(library, name):
    rng = np.random.default_rng(5)
    signs = [*" \n\t'sAé1.<|", "　", "\xa0", "<|endoftext|>"]
    texts = ODD + ["".join(rng.choice(signs, 12)) for _ in range(1500)]
    for _ in range(2):  # the second time from the table
        ids, counts = piece_encoder(name).encode(pa.array(texts))
        got = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
        assert got == [e.ids for e in library[name].encode_batch(texts, add_special_tokens=False)]


def test_prefix_counts_are_exact(library):
    rng = np.random.default_rng(6)
    signs = [*" \n\t'sAé1.r汉\xa0", "'re", "'ll", "<|endoftext|>"]
    texts = ODD + ["".join(rng.choice(signs, 12)) for _ in range(150)]
    counts, chars = token_counts.prefix_counter(BYTE_BPE).prefix_counts(pa.array(texts))
    for text, got in zip(texts, np.split(counts, np.cumsum(chars)[:-1]), strict=True):
        prefixes = [text[: i + 1] for i in range(len(text))]
        assert got.tolist() == [len(e.ids) for e in library[BYTE_BPE].encode_batch(prefixes, add_special_tokens=False)]


def test_count_tokens(spark, docs, library):
    rows = token_counts.count_tokens(docs, 20).collect()
    want = defaultdict(list)
    for r in docs.collect():
        n = len(library[BYTE_BPE].encode(r.text or "", add_special_tokens=False).ids)
        want[r.doc_id].append((len((r.text or "").encode()), n))
    got = defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.n_bytes, r.n_tokens))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    tables = token_counts.prefix_tables(docs.where("doc_id between 5000 and 5020"))
    asked = tables.select(
        "doc_id",
        token_counts.longest_within(F.col("counts"), 20).alias("chars"),
        token_counts.tokens_before(F.col("counts"), 3).alias("three"),
        token_counts.tokens_before(F.col("counts"), 10**6).alias("all"),
    )
    summary = {r.doc_id: r for r in rows}
    for r in asked.collect():
        text = ODD[r.doc_id - 5000]
        assert r.chars == summary[r.doc_id].budget_chars and r["all"] == summary[r.doc_id].n_tokens
        assert r.three == len(library[BYTE_BPE].encode(text[:3], add_special_tokens=False).ids)
    assert token_counts.count_tokens(docs.limit(0), 5).count() == 0


def test_blocks_round_trip():
    rng = np.random.default_rng(7)
    for ids in (
        np.zeros(0, np.uint32),
        np.array([5], np.uint32),
        np.full(3000, 2**32 - 1, np.uint32),
        rng.integers(0, 2**32, 5000, np.uint32),
        np.where(rng.random(4096) < 0.02, 50_000, rng.integers(0, 9, 4096)).astype(np.uint32),
    ):
        blocks = token_files.encode_blocks(ids) if len(ids) else []
        starts = np.cumsum([0, *map(len, blocks)])[:-1]
        back = token_files.decode_blocks(b"".join(blocks), starts) if blocks else ids
        assert back[: len(ids)].tolist() == ids.tolist()


def test_token_files(spark, docs, library, tmp_path):
    rows = token_files.tokens_round_trip(docs)
    assert rows.columns[:4] == ["doc_id", "start", "n_tokens", "ids_crc32"]
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in rows.collect())
    texts = defaultdict(list)
    for r in docs.collect():
        texts[r.doc_id].append(library[BYTE_BPE].encode(r.text or "", add_special_tokens=False).ids + [0])
    at = 0
    ids = [i for _, i, _, _ in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    for start, doc_id, n, crc in got:
        assert start == at
        sums = [(len(t), zlib.crc32(np.array(t, "<u4").tobytes())) for t in texts[doc_id]]
        assert (n, crc) in sums
        at += n
    assert token_files.tokens_round_trip(docs.limit(0)).count() == 0


def test_token_ranges(tmp_path):
    path = str(tmp_path / "x.pfor")
    ids = np.random.default_rng(8).integers(0, 50_000, 10_000).astype(np.uint32)
    with pa.OSFile(path, "wb") as sink:
        writer = token_files.TokenWriter(sink)
        writer.add([1, None], ids[:4000], np.array([3000, 1000]))
        writer.add([2], ids[4000:], np.array([6000]))
        writer.close()
    with pa.OSFile(path) as source:
        reader = token_files.TokenReader(source)
        assert reader.doc_ids == [1, None, 2] and reader.firsts.tolist() == [0, 3000, 4000]
        for first, n in ((0, 10_000), (1023, 2), (9_999, 1), (5000, 0), (1024, 1024)):
            assert reader.read(first, n).tolist() == ids[first : first + n].tolist()


def test_packing(spark, docs, library):
    rows = packing.packed(docs, size=256).collect()
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    total = sum(r.length for r in rows)
    assert len(sequences) <= 1.01 * total / 256 + 1
    for r in docs.where("doc_id < 40 and doc_id <> 7 or doc_id = 6000").collect():
        ids = library[WORD_BPE].encode(r.text or "", add_special_tokens=False).ids + [0]
        cut = [ids[i : i + 256] for i in range(0, len(ids), 256)]
        mine = sorted(pieces[r.doc_id], key=lambda p: p.piece)
        assert [(p.piece, p.start, p.length) for p in mine] == [(k, 256 * k, len(c)) for k, c in enumerate(cut)]
        assert [p.ids_crc32 for p in mine] == [zlib.crc32(np.array(c, "<u4").tobytes()) for c in cut]
    assert len(pieces[None]) == 1 and len(pieces[7]) >= 3
    assert packing.packed(docs.limit(0)).count() == 0


def test_plan_uses_the_whole_histogram():
    rng = np.random.default_rng(9)
    for spread in (np.r_[np.zeros(1), rng.integers(0, 40, 64)], np.eye(65)[40] * 999, np.eye(65)[64] * 7, np.zeros(65)):
        histogram = spread.astype(np.int64)
        used = np.zeros_like(histogram)
        plan = packing.packing_plan(histogram, 64)
        for lengths, times in plan:
            assert sum(lengths) <= 64 and times > 0
            for n in lengths:
                used[n] += times
        assert used.tolist() == histogram.tolist()
        tokens = int((histogram * np.arange(65)).sum())
        alone = sum(t for _, t in packing.best_fit(histogram.copy(), 64))
        assert tokens / 64 <= sum(t for _, t in plan) <= 1.01 * alone + 1
    patterns = packing.full_patterns(np.array([3, 5, 8, 10]), 16)
    assert sorted(map(tuple, patterns.tolist())) == [(8, 5, 3), (8, 8, 0), (10, 3, 3)]
