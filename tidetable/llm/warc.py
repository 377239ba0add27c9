"""WARC archives with an index: records are written with their places, then read by byte range.

Pages of the same payload (its SHA-256) of ``SMALL`` bytes or more are stored once, as the
response of the smallest page id; the others are revisit records that refer to it. Each record is
a gzip member of its own. Writing yields the index: file, offset, length, URL, digest. Reading
takes any rows of an index, sorts their byte ranges in each file, reads neighbouring ranges at
once and parses the records.

A null html is an empty payload, a null URL is left out of the record; an empty table makes no
archive and no rows. Rows that repeat a page id are records of their own: of those with the
smallest id one is the response (by URL, then any), the rest refer to that id. Rows without an id
come after all others; a revisit of a response without id refers to null.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidetable.llm.frames import open_store, stored, text_runs, work_path

SMALL = 100
#: Byte ranges with at most so many bytes between them are read at once, up to ``MOST_READ``.
GAP, MOST_READ = 64 << 10, 8 << 20

INDEX = "page_id long, file string, offset long, length long, url string, digest string, record_type string"
RECORD = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long,"
    " url string, payload binary"
)
_index_arrow = pa.schema(
    [("page_id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]
    + [(n, pa.string()) for n in ("url", "digest", "record_type")]
)
_record_arrow = pa.schema(
    [("page_id", pa.int64()), ("payload_bytes", pa.int64())]
    + [("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
    + [("url", pa.string()), ("payload", pa.binary())]
)
_line = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)\r\n")


def record_bytes(page: dict) -> bytes:
    """One record, uncompressed. ``page``: page_id, url, payload, digest, size, record_type, refers_to."""
    revisit = page["record_type"] == "revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    http += b"Content-Length: %d\r\n\r\n" % page["size"]
    block = http if revisit else http + page["payload"]
    fields = [
        ("WARC-Type", page["record_type"]),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, 'page:' + str(page['page_id']))}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha256:{page['digest']}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
        ("X-Payload-Length", str(page["size"])),
    ]
    if page["page_id"] is not None:
        fields.append(("X-Page-ID", str(page["page_id"])))
    if page["url"] is not None:
        fields.append(("WARC-Target-URI", quote(page["url"], safe="!#$%&'()*+,/:;=?@[]~")))
    if revisit:
        fields.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        if page["refers_to"] is not None:
            target = uuid.uuid5(uuid.NAMESPACE_URL, "page:" + str(page["refers_to"]))
            fields.append(("WARC-Refers-To", f"<urn:uuid:{target}>"))
            fields.append(("X-Refers-To-Page", str(page["refers_to"])))
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """The page of one uncompressed record; its payload is checked against its digest."""
    if not raw.startswith(b"WARC/1.1\r\n"):
        raise ValueError("not a WARC record")
    end = raw.index(b"\r\n\r\n")
    head = {k.decode().lower(): v.decode() for k, v in _line.findall(raw[10 : end + 2])}
    block = raw[end + 4 : end + 4 + int(head["content-length"])]
    kind, digest = head["warc-type"], head["warc-payload-digest"].removeprefix("sha256:")
    payload = None
    if kind == "response":
        payload = block[block.index(b"\r\n\r\n") + 4 :]
        if hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"payload of {head['warc-record-id']} differs from its digest")
    number = {n: int(head[n]) if n in head else None for n in ("x-page-id", "x-refers-to-page")}
    return {
        "page_id": number["x-page-id"],
        "payload_bytes": len(payload) if payload is not None else int(head["x-payload-length"]),
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": number["x-refers-to-page"],
        "url": head.get("warc-target-uri"),
        "payload": payload,
    }


def record_plan(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) as payloads with their digests, each after a row (``rank`` 0)
    that tells what it refers to if other pages have its payload; partitioned and sorted to be written.

    Only ids and digests are grouped. A payload moves once.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    source = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"))
    sized = source.withColumn("digest", F.sha2("payload", 256)).withColumn("size", F.octet_length("payload").cast("long"))
    # An id that is null sorts last.
    key = F.struct(F.col("page_id").isNull().alias("nameless"), "page_id", "url")
    large = stored(sized.where(F.col("size") >= SMALL).select("digest", key.alias("key")), "digests")
    first = large.groupBy("digest").agg(F.min("key").alias("first"), F.count("*").alias("n")).where("n > 1")
    told = large.join(first, "digest").select(
        "key.page_id",
        "key.url",
        F.lit(None).cast("binary").alias("payload"),
        "digest",
        F.lit(0).cast("long").alias("size"),
        F.col("first.page_id").alias("refers_to"),
        F.col("key").eqNullSafe(F.col("first")).alias("is_first"),
        F.lit(0).alias("rank"),
    )
    written = sized.select("*", F.lit(None).cast("long").alias("refers_to"), F.lit(True).alias("is_first"), F.lit(1).alias("rank"))
    return (
        written.unionByName(told)
        .repartition("page_id", "url", "digest")
        .sortWithinPartitions("page_id", "url", "digest", "rank")
    )


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives in ``folder``; the stored index of their records."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink, name, at = None, f"{uuid.uuid4().hex}.warc.gz", 0
        told: dict | None = None
        for batch in text_runs(batches, column="payload"):
            rows = []
            for page in batch.to_pylist():
                if page["rank"] == 0:
                    told = page
                    continue
                page["record_type"] = "response"
                if told is not None and all(told[n] == page[n] for n in ("page_id", "url", "digest")):
                    if not told["is_first"]:
                        page["record_type"], page["refers_to"] = "revisit", told["refers_to"]
                    # Of rows that repeat id, URL and payload the first one met is the response.
                    told = told | {"is_first": False}
                raw = zlib_member(record_bytes(page))
                if sink is None:
                    store, path = open_store(folder)
                    sink = store.open_output_stream(f"{path}/{name}", compression=None)
                sink.write(raw)
                rows.append(
                    {n: page[n] for n in ("page_id", "url", "digest", "record_type")}
                    | {"file": name, "offset": at, "length": len(raw)}
                )
                at += len(raw)
            yield pa.RecordBatch.from_pylist(rows, schema=_index_arrow)
        if sink is not None:
            sink.close()

    return stored(record_plan(pages).mapInArrow(write, INDEX), "index")


def zlib_member(raw: bytes) -> bytes:
    """``raw`` as one gzip member."""
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def coalesced(ranges: list[tuple[int, int]], gap: int = GAP, most: int = MOST_READ) -> list[tuple[int, int, int]]:
    """Sorted (offset, length) ranges as reads: begin, end and how many ranges each holds."""
    reads: list[tuple[int, int, int]] = []
    for offset, length in ranges:
        if reads and offset <= reads[-1][1] + gap and offset + length - reads[-1][0] <= most:
            begin, end, n = reads[-1]
            reads[-1] = (begin, max(end, offset + length), n + 1)
        else:
            reads.append((offset, offset + length, 1))
    return reads


def read_records(index: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records that rows of an index (file, offset, length) name, read from the archives."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_store(folder)
        source = name = None
        for batch in batches:
            ranges = list(zip(*(batch.column(n).to_pylist() for n in ("file", "offset", "length")), strict=True))
            begin = 0
            while begin < len(ranges):
                same = [r[1:] for r in ranges[begin:] if r[0] == ranges[begin][0]]
                if ranges[begin][0] != name:
                    if source is not None:
                        source.close()
                    name = ranges[begin][0]
                    source = store.open_input_file(f"{path}/{name}")
                for low, high, n in coalesced(same):
                    data = source.read_at(high - low, low)
                    records = []
                    for offset, length in same[:n]:
                        part = data[offset - low : offset - low + length]
                        records.append(parse_record(zlib.decompress(part, 31)))
                        if not with_payload:
                            records[-1]["payload"] = None
                    same = same[n:]
                    begin += n
                    yield pa.RecordBatch.from_pylist(records, schema=_record_arrow)
        if source is not None:
            source.close()

    # Ranges of one file lie together and in order, files are dealt over all tasks.
    files = max(1, index.select("file").distinct().count())
    dealt = index.select("file", "offset", "length").repartition(files, "file").sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(read, RECORD)


def archived(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives under the shared folder and read all their records back."""
    folder = work_path(pages.sparkSession, "warc")
    return read_records(write_archives(pages, folder), folder, with_payload=False).drop("payload")
