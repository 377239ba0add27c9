"""Token ids in binary files of patched frame-of-reference blocks.

A file holds blocks of 1024 ids, then an index. A block stores the smallest id, and every id's
distance from it in as many bits as a given share of the distances needs; the others, its
exceptions, stand in a list of places and distances. The index gives the place of every block
and, for every document, its id and its first token, so any token range is read without the rest.

All numbers are little-endian::

    block   least u32 | width u8 | exceptions u16 | packed distances | places u16... | distances u32...
    footer  block places u64... | document ids i64... | id present u8... | first tokens u64...
    tail    blocks u64 | documents u64 | tokens u64 | place of the footer u64 | b"PFORIDS1"

Null texts are empty documents, null ids are kept as null, repeated rows are repeated documents;
an empty table makes no files and no rows.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidetable.llm.encoding import BYTE_BPE, piece_encoder
from tidetable.llm.frames import open_store, sort_tasks, stored, text_runs, whole_text, work_path

BLOCK = 1024
#: Share of a block's distances that its width must hold.
SHARE = 0.95
MAGIC = b"PFORIDS1"
_head, _tail = struct.Struct("<IBH"), struct.Struct("<QQQQ8s")

MANIFEST = "file string, docs long, tokens long, first_id long, first_tie long"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long, file string, position long"


def bit_lengths(values: np.ndarray) -> np.ndarray:
    """Bits that each unsigned 32-bit value needs."""
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)


def pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of unsigned values as rows of packed bytes, ``width`` bits a value."""
    size = 2 if width <= 16 else 4
    bits = np.unpackbits(np.ascontiguousarray(values, f"<u{size}").view(np.uint8), bitorder="little")
    kept = bits.reshape(*values.shape, 8 * size)[:, :, :width]
    return np.packbits(kept.reshape(len(values), -1), axis=1, bitorder="little")


def unpack_bits(packed: np.ndarray, width: int, count: int) -> np.ndarray:
    """The reverse of :func:`pack_bits`, for rows of ``count`` values."""
    bits = np.unpackbits(packed, axis=1, bitorder="little")[:, : width * count]
    size = 2 if width <= 16 else 4
    wide = np.zeros((len(packed), count, 8 * size), np.uint8)
    wide[:, :, :width] = bits.reshape(len(packed), count, width)
    return np.packbits(wide.reshape(len(packed), -1), axis=1, bitorder="little").view(f"<u{size}")


def encode_blocks(ids: np.ndarray, share: float = SHARE) -> list[bytes]:
    """Whole blocks of ids as bytes; a shorter last block is filled up with its smallest id."""
    short = -len(ids) % BLOCK
    if short:
        tail = ids[len(ids) - len(ids) % BLOCK :]
        ids = np.concatenate([ids, np.full(short, tail.min(), ids.dtype)])
    rows = ids.reshape(-1, BLOCK)
    least = rows.min(axis=1)
    far = (rows - least[:, None]).astype(np.uint32)
    needs = bit_lengths(far)
    at = min(BLOCK - 1, int(np.ceil(share * BLOCK)) - 1)
    widths = np.partition(needs, at, axis=1)[:, at]
    packed: list = [b""] * len(rows)
    for width in np.unique(widths):
        which = np.flatnonzero(widths == width)
        for k, line in zip(which, pack_bits(far[which], int(width)), strict=True):
            packed[k] = line.tobytes()
    over = needs > widths[:, None]
    out = []
    for k, line in enumerate(packed):
        places = np.flatnonzero(over[k])
        head = _head.pack(int(least[k]), int(widths[k]), len(places))
        out.append(head + line + places.astype("<u2").tobytes() + far[k, places].astype("<u4").tobytes())
    return out


def decode_blocks(data: bytes, starts: np.ndarray) -> np.ndarray:
    """Ids of the blocks that begin at ``starts`` in ``data``, in that order."""
    heads = [_head.unpack_from(data, s) for s in starts]
    out = np.empty((len(starts), BLOCK), np.uint32)
    raw = np.frombuffer(data, np.uint8)
    widths = np.array([h[1] for h in heads])
    for width in np.unique(widths):
        size, which = int(width) * BLOCK // 8, np.flatnonzero(widths == width)
        lines = np.stack([raw[starts[k] + _head.size : starts[k] + _head.size + size] for k in which])
        out[which] = unpack_bits(lines, int(width), BLOCK)
    for k, (least, width, odd) in enumerate(heads):
        if odd:
            at = int(starts[k]) + _head.size + int(width) * BLOCK // 8
            places = np.frombuffer(data, "<u2", odd, at)
            out[k, places] = np.frombuffer(data, "<u4", odd, at + 2 * odd)
        out[k] += np.uint32(least)
    return out.reshape(-1)


class TokenWriter:
    """Writes one file; ids go out as soon as a block of them is full."""

    def __init__(self, sink, share: float = SHARE):
        self.sink, self.share = sink, share
        self.rest = np.zeros(0, np.uint32)
        self.place = self.tokens = 0
        # Numbers of the footer as they will be stored, 17 bytes a document.
        self.blocks, self.firsts = array("Q"), array("Q")
        self.doc_ids, self.present = array("q"), bytearray()

    def add(self, doc_ids: list[int | None], ids: np.ndarray, counts: np.ndarray) -> None:
        """Documents with all their ids in a row and each one's number of ids."""
        self.doc_ids.extend(0 if i is None else i for i in doc_ids)
        self.present.extend(i is not None for i in doc_ids)
        self.firsts.frombytes((self.tokens + np.cumsum(counts) - counts).astype(np.uint64).tobytes())
        self.tokens += len(ids)
        held = np.concatenate([self.rest, ids])
        whole = len(held) - len(held) % BLOCK
        self.put(held[:whole])
        self.rest = held[whole:]

    def put(self, ids: np.ndarray) -> None:
        for at in range(0, len(ids), 256 * BLOCK):
            for block in encode_blocks(ids[at : at + 256 * BLOCK], self.share):
                self.blocks.append(self.place)
                self.place += self.sink.write(block) or len(block)

    def close(self) -> None:
        if len(self.rest):
            self.put(self.rest)
        footer = [
            np.array(self.blocks, "<u8"),
            np.array(self.doc_ids, "<i8"),
            np.array(self.present, np.uint8),
            np.array(self.firsts, "<u8"),
        ]
        for part in footer:
            self.sink.write(part.tobytes())
        self.sink.write(_tail.pack(len(self.blocks), len(self.doc_ids), self.tokens, self.place, MAGIC))
        self.sink.close()


class TokenReader:
    """Reads one file: its index at once, its tokens by range."""

    def __init__(self, source):
        self.source = source
        end = source.size()
        n_blocks, n_docs, self.tokens, self.footer, magic = _tail.unpack(
            source.read_at(_tail.size, end - _tail.size)
        )
        if magic != MAGIC:
            raise ValueError("not a token file")
        raw = source.read_at(end - _tail.size - self.footer, self.footer)
        self.blocks = np.frombuffer(raw, "<u8", n_blocks)
        at = 8 * n_blocks
        ids = np.frombuffer(raw, "<i8", n_docs, at)
        present = np.frombuffer(raw, np.uint8, n_docs, at + 8 * n_docs)
        self.firsts = np.frombuffer(raw, "<u8", n_docs, at + 9 * n_docs).astype(np.int64)
        self.doc_ids = [int(i) if p else None for i, p in zip(ids, present, strict=True)]

    def read(self, first: int, count: int) -> np.ndarray:
        """``count`` ids from the token numbered ``first``; only the blocks that hold them are read."""
        if count <= 0:
            return np.zeros(0, np.uint32)
        a, b = first // BLOCK, (first + count - 1) // BLOCK + 1
        begin = int(self.blocks[a])
        end = int(self.blocks[b]) if b < len(self.blocks) else self.footer
        ids = decode_blocks(self.source.read_at(end - begin, begin), self.blocks[a:b].astype(np.int64) - begin)
        return ids[first - a * BLOCK : first - a * BLOCK + count]


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str = BYTE_BPE,
    end_id: int = 0,
    share: float = SHARE,
) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write one file a partition, ids ascending over all files.

    Returns the manifest, already stored: a row for each file of a task that succeeded, with its
    numbers of documents and tokens and the sort key of its first document. A repeated task
    writes a file of another name, which the manifest leaves out.
    """
    ordered = (
        docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(sort_tasks(docs), "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = first = None
        for batch in text_runs(batches):
            ids, counts = piece_encoder(tokenizer).encode(batch.column("text"))
            if writer is None:
                store, path = open_store(folder)
                name = f"{uuid.uuid4().hex}.pfor"
                writer = TokenWriter(store.open_output_stream(f"{path}/{name}"), share)
                first = batch.slice(0, 1).to_pylist()[0]
            ends = np.cumsum(counts)
            with_end = np.insert(ids, ends, np.uint32(end_id))
            writer.add(batch.column("doc_id").to_pylist(), with_end, counts + 1)
        if writer is not None:
            writer.close()
            row = [name, len(writer.doc_ids), writer.tokens, first["doc_id"], first["tie"]]
            fields = ["file", "docs", "tokens", "first_id", "first_tie"]
            yield pa.RecordBatch.from_pylist([dict(zip(fields, row, strict=True))], schema=manifest_schema)

    manifest_schema = pa.schema(
        [("file", pa.string())] + [(n, pa.int64()) for n in ("docs", "tokens", "first_id", "first_tie")]
    )
    return stored(ordered.mapInArrow(write, MANIFEST), "manifest")


def read_token_files(manifest: DataFrame, folder: str, at_once: int = 1 << 20) -> DataFrame:
    """A row for each document in the files: doc_id, its start in the whole sequence, its number
    of tokens, the crc32 of them all as unsigned 32-bit integers, its file and position there."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_store(folder)
        for name, before in ((r["file"], r["base"]) for batch in batches for r in batch.to_pylist()):
            with store.open_input_file(f"{path}/{name}") as source:
                reader = TokenReader(source)
                ends = np.append(reader.firsts[1:], reader.tokens)
                begin = 0
                while begin < len(ends):
                    base = int(reader.firsts[begin])
                    after = max(begin + 1, int(np.searchsorted(ends, base + at_once, "right")))
                    sums = []
                    if after == begin + 1:
                        sums.append(crc_of_range(reader, base, int(ends[begin]), at_once))
                    else:
                        ids = reader.read(base, int(ends[after - 1]) - base).astype("<u4")
                        for a, b in zip(reader.firsts[begin:after], ends[begin:after], strict=True):
                            sums.append(zlib.crc32(ids[a - base : b - base]))
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": pa.array(reader.doc_ids[begin:after], pa.int64()),
                            "start": pa.array(reader.firsts[begin:after] + before, pa.int64()),
                            "n_tokens": pa.array((ends - reader.firsts)[begin:after], pa.int64()),
                            "ids_crc32": pa.array(sums, pa.int64()),
                            "file": pa.array([name] * (after - begin), pa.string()),
                            "position": pa.array(reader.firsts[begin:after], pa.int64()),
                        }
                    )
                    begin = after

    before = Window.orderBy(F.asc_nulls_first("first_id"), "first_tie").rowsBetween(Window.unboundedPreceding, -1)
    bases = manifest.select("file", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    return bases.repartition(max(1, manifest.count()), "file").mapInArrow(read, READ)


def crc_of_range(reader: TokenReader, begin: int, end: int, at_once: int) -> int:
    """The crc32 of a token range, read in parts, so that a huge document never lies whole in memory."""
    value = 0
    for at in range(begin, end, at_once):
        value = zlib.crc32(reader.read(at, min(at_once, end - at)).astype("<u4").tobytes(), value)
    return value


def tokens_round_trip(docs: DataFrame, tokenizer: str = BYTE_BPE, end_id: int = 0) -> DataFrame:
    """Write ``docs`` as token files, read them back and place every document in the whole sequence.

    The columns are those of :func:`read_token_files`.
    """
    folder = work_path(docs.sparkSession, "tokens")
    manifest = write_token_files(docs, folder, tokenizer, end_id)
    return read_token_files(manifest, folder)
