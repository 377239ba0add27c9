"""Benchmark decontamination: find where documents repeat windows of benchmark items.

Words are runs of digits, letters a-z (A-Z are lower-cased) and all code points beyond ASCII. A
window is ``width`` consecutive words of an item; an item of fewer words is one window. The
hashes of all windows form one side of a join with the hashes of all document windows of the same
lengths, and each hit is then verified against the row's own words by the digest of the window's
words. Hits carry size, hash and digest only; the items of the windows found come in at the end,
once for each distinct set of windows.

DataFrame operations only. The windows' side, 80 bytes a window whatever its words and items, is
broadcast while the benchmark stays under ``MOST_BROADCAST`` windows and joined by a shuffle beyond
it. Null texts have no words, are hit nowhere and hit nothing; rows of one id, or without one, are
kept apart by their texts, and repeated rows are judged alike; an empty benchmark leaves all
documents clean.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidetable.llm.frames import row_struct, stored, whole_text

WIDTH = 13
#: More windows than this are joined by a shuffle; at 80 bytes each, 8 MB at most are broadcast.
MOST_BROADCAST = 100_000

_between = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_upper, _lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def benchmark_words(text: Column) -> Column:
    """The words of a text as the contamination rule takes them."""
    return F.array_remove(F.split(F.translate(text, _upper, _lower), _between), "")


def windows_of(words: Column, width: Column | int) -> Column:
    """The first word's index (from 0) of every window of so many words."""
    width = F.lit(width) if isinstance(width, int) else width
    last = F.size(words) - width
    return F.when((last >= 0) & (width > 0), F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def window_digest(window: Column) -> Column:
    """Digest of a window's words; no word holds a space, so it tells windows apart by their words."""
    return F.sha2(F.array_join(window, " ").cast("binary"), 256)


def item_windows(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """The windows of all items: size, hash, digest and an item that holds the window, each once."""
    items = benchmark.select(F.col("item_id"), benchmark_words(whole_text()).alias("words"))
    sized = items.withColumn("size", F.least(F.lit(width), F.size("words"))).where("size > 0")
    each = sized.select(
        "item_id", "size", "words", F.explode(windows_of(F.col("words"), F.col("size"))).alias("at")
    ).select("item_id", "size", F.slice("words", F.col("at") + 1, F.col("size")).alias("window"))
    return each.select(
        "size", F.xxhash64("window").alias("hash"), window_digest(F.col("window")).alias("digest"),
        F.col("item_id").cast("string").alias("item"),
    ).distinct()


def row_key() -> Column:
    """A hash of a row's id and text, under which its hits are gathered."""
    return F.xxhash64(F.col("doc_id").cast("string"), whole_text())


def hashed_window(size: int) -> Callable[[Column], Column]:
    """The window of so many of the column ``words`` at a place."""
    return lambda at: F.struct(
        F.lit(size).alias("size"), at.alias("at"), F.xxhash64(F.slice("words", at + 1, size)).alias("hash")
    )


def window_hits(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """For each row's key with window hashes in common with the benchmark, the places to verify."""
    wanted = windows.select("size", "hash", "digest").distinct()
    counts = wanted.groupBy("size").count().collect()  # a row for each window length, ``width`` at most
    sizes = sorted(r["size"] for r in counts)
    small = sum(r["count"] for r in counts) <= MOST_BROADCAST
    # One row a window keeps Generate's rows narrow: the words themselves stay behind.
    hashed = [F.transform(windows_of(F.col("words"), size), hashed_window(size)) for size in sizes]
    none = F.array().cast("array<struct<size:int,at:int,hash:bigint>>")
    found = F.concat(*hashed) if hashed else none
    return (
        docs.select(row_key().alias("key"), benchmark_words(whole_text()).alias("words"))
        .select("key", F.explode(found).alias("w"))
        .select("key", F.col("w.at").alias("at"), F.col("w.size").alias("size"), F.col("w.hash").alias("hash"))
        .join(F.broadcast(wanted) if small else wanted, ["size", "hash"])
        .groupBy("key")
        .agg(F.collect_set(F.struct("at", "size", "digest")).alias("hits"))
    )


def marked_rows(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """The rows of ``docs`` with all their columns in a struct ``row`` and what was found in each:
    n_words, hit_spans (word begin and end, merged, in order), n_hit, contaminated (a twentieth of the
    words hit, at least one) and the digests of the windows found, in order."""
    hits = window_hits(docs, windows)
    none = F.array().cast("array<struct<at:int,size:int,digest:string>>")
    keyed = docs.select(row_struct(docs).alias("row"), row_key().alias("own_key"))
    rows = keyed.join(hits, F.col("own_key") == F.col("key"), "left").select(
        "row", benchmark_words(whole_text("row.text")).alias("words"), F.coalesce("hits", none).alias("hits")
    )
    true_hits = F.filter(
        "hits", lambda h: window_digest(F.slice("words", h["at"] + 1, h["size"])) == h["digest"]
    )
    spans = F.array_sort(
        F.transform("hits", lambda h: F.struct(h["at"].alias("begin"), (h["at"] + h["size"]).alias("end")))
    )
    marked = rows.withColumn("hits", true_hits).select(
        "row",
        F.size("words").cast("long").alias("n_words"),
        merged_spans(spans).alias("hit_spans"),
        F.array_sort(F.array_distinct("hits.digest")).alias("digests"),
    )
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return marked.withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    )


def with_items(marked: DataFrame, windows: DataFrame) -> DataFrame:
    """Marked rows, which must be stored, with the items (sorted as strings) that hold the windows found
    in place of the windows' digests."""
    named = marked.withColumn("found", F.when(F.size("digests") > 0, F.sha2(F.array_join("digests", ""), 256)))
    sets = named.where("found IS NOT NULL").select("found", "digests").distinct()
    items = (
        sets.select("found", F.explode("digests").alias("digest"))
        .join(windows.select("digest", "item"), "digest")
        .groupBy("found")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    none = F.array().cast("array<string>")
    joined = named.join(items, "found", "left").drop("found", "digests")
    return joined.withColumn("items", F.coalesce("items", none))


def benchmark_windows(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    return stored(item_windows(benchmark, width), "windows")


def mark_contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """The rows of ``docs`` in a struct ``row`` with n_words, hit_spans, n_hit, contaminated and items."""
    windows = benchmark_windows(benchmark, width)
    return with_items(stored(marked_rows(docs, windows), "marked"), windows)


def contamination_counts(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """Like :func:`mark_contamination`, with the rows' ids instead of the whole rows."""
    windows = benchmark_windows(benchmark, width)
    counts = marked_rows(docs, windows).select("row.doc_id", "n_words", "n_hit", "contaminated", "digests")
    return with_items(stored(counts, "counts"), windows)


def merged_spans(spans: Column) -> Column:
    """Sorted spans with overlapping and touching ones made one."""
    kind = "array<struct<begin:int,end:int>>"
    done = F.array().cast(kind)
    state = F.struct(done.alias("done"), F.lit(-1).alias("begin"), F.lit(-1).alias("end"))

    def closed(s: Column) -> Column:
        last = F.array(F.struct(s["begin"].alias("begin"), s["end"].alias("end")))
        return F.when(s["begin"] < 0, s["done"]).otherwise(F.concat(s["done"], last))

    def step(s: Column, x: Column) -> Column:
        apart = (x["begin"] > s["end"]) | (s["begin"] < 0)
        return F.struct(
            F.when(apart, closed(s)).otherwise(s["done"]).alias("done"),
            F.when(apart, x["begin"]).otherwise(s["begin"]).alias("begin"),
            F.when(apart, x["end"]).otherwise(F.greatest(s["end"], x["end"])).alias("end"),
        )

    return F.aggregate(spans, state, step, closed)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` without its contaminated documents; the others stay as they are."""
    return marked_rows(docs, benchmark_windows(benchmark, width)).where(~F.col("contaminated")).select("row.*")


def without_hit_words(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with the text of hit documents replaced by its words that no window covers, joined by spaces."""
    marked = marked_rows(docs, benchmark_windows(benchmark, width))
    words = benchmark_words(whole_text("row.text"))
    free = F.filter(words, lambda w, i: ~F.exists("hit_spans", lambda s: (i >= s["begin"]) & (i < s["end"])))
    text = F.when(F.col("n_hit") > 0, F.array_join(free, " ")).otherwise(F.col("row.text"))
    return marked.select(*[text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])
