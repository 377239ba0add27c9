"""SpotSigs fingerprints: chains of content words that follow common-word anchors.

A word is a run of letters, marks and digits, lower-cased. The most frequent words of all texts are
the anchors: as many as make up ``COMMON`` of all words, ``MOST_ANCHORS`` at most. Wherever
content words follow one, the anchor and the next ``CHAIN`` content words, common ones between
them passed over, are a signature. The begin of a text is an anchor too. Where no anchor comes
within ``CHAIN`` content words, each further one up to the next anchor begins a signature as well,
so that every content word is in one, in any language, in lists and in code. A text of common
words only has one signature of them all, so every text has a fingerprint: the set of its
signatures' hashes. Two sets are alike by their Jaccard index. The query takes it of all its
pairs; only callers of ``likeness`` with a wanted likeness skip pairs by their sets' lengths.

DataFrame operations only. A null text is empty; texts without words have the empty chain as
their signature and are alike; null ids come last in descending order and repeated ids follow
each other by the hash of their texts; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidetable.llm.frames import stored, whole_text

CHAIN = 3
#: Share of all words that the anchors make up, and the most anchors.
COMMON, MOST_ANCHORS = 0.3, 500
#: Rows that share a place in the order, and the most places; a place is a sort in one task.
ROWS, MOST_PLACES = 2_000, 20_000
#: Ids drawn for each place to find where places begin.
DRAWN = 50

# Common words of English, French, German and Spanish, for texts without a corpus.
ANCHORS = (
    "a an and are as at be by for from has have he her his if in is it its not of on or she that the their"
    " there they this to was we were which will with you your"
    " au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur mais ne nous ou par pas"
    " pour que qui sa se ses son sur un une vous"
    " als auch auf aus bei das dem den der die ein eine einem einen einer es für ich im ist mit nach nicht noch"
    " sich sie sind so und von vor war wie wir zu zum zur"
    " al como con del el ella ellos era esta este fue las lo los más muy o para pero por su sus también y ya"
).split()


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}]+"), "")


def common_words(docs: DataFrame) -> list[str]:
    """The anchors of a corpus, from the words of all its rows."""
    words = docs.select(F.explode(words_of(whole_text())).alias("word"))
    counts = stored(words.groupBy("word").agg(F.count("*").alias("n")), "words")
    total = counts.agg(F.sum("n").alias("n")).first()["n"] or 0
    anchors, held = [], 0
    for r in counts.orderBy(F.desc("n"), "word").limit(MOST_ANCHORS).collect():
        if held + r.n > COMMON * total:
            break
        anchors.append(r.word)
        held += r.n
    return anchors


def with_signatures(rows: DataFrame, text: str, name: str, anchors: list[str] = ANCHORS) -> DataFrame:
    """``rows`` with the sorted distinct signature hashes of a text column."""
    words, content = f"{name}_words", f"{name}_content"
    some_word = words_of(F.col(text))
    places = F.sequence(F.lit(0), F.size(words) - 1)
    no_place = F.array().cast("array<int>")

    def word(place: Column) -> Column:
        return F.when(place >= 0, F.get(F.col(words), place))

    def signature(place: Column, k: Column) -> Column:
        chain = [word(place)] + [word(F.get(F.col(content), k + j)) for j in range(1, CHAIN)]
        follows_anchor = (k == 0) | (place - F.get(F.col(content), k - 1) > 1)
        # As many places as content words back: no anchor between.
        far_from_one = (k >= CHAIN) & (place - F.get(F.col(content), k - CHAIN) == CHAIN)
        return F.when(follows_anchor | far_from_one, F.xxhash64(F.coalesce(word(place - 1), F.lit("^")), *chain))

    found = F.filter(F.transform(content, signature), lambda s: s.isNotNull())
    alone = F.array(F.xxhash64(F.lit("^"), F.col(words)))
    return (
        rows.withColumn(words, some_word)
        .withColumn(
            content,
            F.when(F.size(words) > 0, F.filter(places, lambda i: ~F.get(F.col(words), i).isin(list(anchors)))).otherwise(no_place),
        )
        .withColumn(name, F.when(F.size(content) > 0, F.array_sort(F.array_distinct(found))).otherwise(alone))
        .drop(words, content)
    )


def length_partition(signatures: Column, at_least: float) -> Column:
    """The partition of a set's length: sets of that likeness lie in the same or the next one."""
    return F.floor(F.log(F.size(signatures).cast("double")) / F.log(F.lit(1 / at_least)))


def likeness(a: Column, b: Column, at_least: float = 0.0) -> Column:
    """The Jaccard index of two sets; 0 where their lengths rule ``at_least`` out."""
    shared = F.size(F.array_intersect(a, b))
    exact = shared / (F.size(a) + F.size(b) - shared)
    if not at_least:
        return exact
    apart = F.abs(length_partition(a, at_least) - length_partition(b, at_least)) > 1
    short = F.least(F.size(a), F.size(b)) < at_least * F.greatest(F.size(a), F.size(b))
    return F.when(apart | short, F.lit(0.0)).otherwise(exact)


def fingerprint(signatures: Column) -> Column:
    """A digest of a signature set: equal for equal sets."""
    return F.sha2(F.array_join(F.transform(signatures, lambda s: s.cast("string")), ","), 256)


def place_of(ident: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds lie below ``ident``, looked up in two steps."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    coarse = F.array(*[F.lit(b) for b in bounds[step - 1 :: step]])
    fine = F.array(*[F.array(*[F.lit(b) for b in bounds[i : i + step]]) for i in range(0, len(bounds), step)])
    first = F.size(F.filter(coarse, lambda b: b < ident))
    last = F.coalesce(F.size(F.filter(F.get(fine, first), lambda b: b < ident)), F.lit(0))
    return first * step + F.greatest(last, F.lit(0))


def with_next_text(docs: DataFrame, anchors: list[str]) -> DataFrame:
    """doc_id, text (null as empty), their signatures, and those of the next row in descending id
    order, after the last of which comes the first.

    Rows are dealt by id into places that are sorted one by one. The first row of each place
    stands in the place before it as well, so nothing but these few is looked at twice.
    """
    rows = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    keyed = rows.select(
        "doc_id", "text", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("ident"), F.xxhash64("text").alias("tie")
    )
    n = docs.count()
    places = min(max(n // ROWS, 1), MOST_PLACES)
    bounds: list[int] = []
    if places > 1:
        # A few ids a place, drawn by hash, tell well enough where to divide; all rows are dealt.
        drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(min(1.0, DRAWN * places / n) * (1 << 30))
        shares = [i / places for i in range(1, places)]
        quantiles = F.percentile_approx(F.col("doc_id").cast("long"), shares, 10 * places)
        bounds = sorted(set(docs.where(drawn).agg(quantiles.alias("b")).first()["b"] or []))
    keyed = keyed.withColumn("place", place_of(F.col("ident"), bounds))

    # Of each place the largest id, from the ids alone; then the texts of these few rows.
    heads = stored(keyed.groupBy("place").agg(F.max("ident").alias("head")), "heads")
    higher = F.lead("place").over(Window.orderBy("place"))
    lowest = F.min("place").over(Window.partitionBy())
    heads = heads.select(
        F.coalesce(higher, lowest).alias("goes_to"), F.col("place").alias("head_place"), F.col("head").alias("head_ident")
    )
    copies = (
        keyed.join(F.broadcast(heads), (F.col("place") == F.col("head_place")) & (F.col("ident") == F.col("head_ident")))
        .groupBy(F.col("goes_to").alias("place"))
        .agg(F.min_by("text", "tie").alias("text"), F.max("ident").alias("ident"), F.min("tie").alias("tie"))
        .select(F.lit(None).cast("long").alias("doc_id"), "text", "ident", "tie", "place")
    )
    both = keyed.withColumn("own", F.lit(1)).unionByName(copies.withColumn("own", F.lit(0)))
    together = with_signatures(both.repartition("place"), "text", "signatures", anchors)
    after = Window.partitionBy("place").orderBy(F.desc("own"), F.desc("ident"), "tie")
    return (
        together.withColumn("next_text", F.lead("text").over(after))
        .withColumn("next_signatures", F.lead("signatures").over(after))
        .where("own = 1")
        .select("doc_id", "text", "signatures", "next_text", "next_signatures")
    )


def edited_and_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and its likeness to that and to the next text.

    The edited text ends in as many code points of the next one's begin as half its length,
    or in all of the next text if it is shorter.
    """
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half)
    )
    anchors = common_words(docs)
    following = with_next_text(docs, anchors).withColumn("edited", edited)
    rows = with_signatures(following, "edited", "edited_signatures", anchors)
    return rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("signatures")).alias("fingerprint"),
        fingerprint(F.col("edited_signatures")).alias("edited_fingerprint"),
        likeness(F.col("signatures"), F.col("edited_signatures")).alias("near_edited"),
        likeness(F.col("signatures"), F.col("next_signatures")).alias("near_next"),
    )
