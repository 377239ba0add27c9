"""Personal data: found by pattern, and terms that give it away found by information content.

The protected entities are the e-mail addresses, IP addresses, card and phone numbers in the
texts. A term is a run of letters in the context of an entity, the ``REACH`` words on either
side of it that no digit or @ is part of. Over the whole corpus, with N contexts' worth of words,

    p(entity) = contexts of the entity / N
    p(term) = occurrences of the term / N
    p(entity, term) = contexts of the entity that hold the term / N

and the term's disclosure of the entity is the pointwise mutual information over the entity's
information, log(p(entity, term) / (p(entity) p(term))) / -log p(entity): 1 where the term stands
beside the entity alone, 0 where it tells nothing. Every occurrence of an entity gives a context,
save that rows of one whole text count as one between them and a line that a text repeats counts
where it first stands, so that copies and repeated lines are no evidence; fewer than ``SUPPORT``
contexts are none either. Words and occurrences of terms are counted in the same lines of the
same texts. In a context of its
entity a term of disclosure ``GENERALISE`` or more is replaced by ``[TERM]``, one of ``REMOVE`` or
more is left out.

DataFrame operations only. Null texts are empty and hold nothing; null ids and repeated rows are
kept, each row with its own spans; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidetable.llm.frames import prefix_sums, row_struct, stored, whole_text

KINDS = ("email", "ip", "card", "phone")
TERM = "term"

REACH = 8
SUPPORT = 3
GENERALISE, REMOVE = 0.8, 0.95
#: Code points of a chunk of text; contexts are looked for in the next chunks before the whole text.
CHUNK = 512
#: Up to so many candidate terms (some 50 bytes each) are broadcast for their counts.
MOST_BROADCAST = 500_000

_local = "A-Za-z0-9._%+-"
# The possessive forms match what the plain ones do, since no part can take signs that the next
# part begins with; a match can only begin where its run of signs or the last match ends.
PATTERNS = {
    "email": rf"(?:\G|(?<![{_local}]))[{_local}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Signs without which a text has no match.
NEEDED = {"email": "@", "ip": ".", "card": None, "phone": "+"}

_byte = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_letters, _others = r"[\p{L}\p{M}]", r"[^\p{L}\p{M}]"
_span = "struct<kind:int,start:int,end:int,entity:bigint,first:boolean>"
# A run of letters after what is passed over: white space, whole words with a digit or @, other signs.
_run = rf"\G(?:\s++|(?<!\S)(?=[^\s@0-9]*+[@0-9])\S++|[^\s\p{{L}}\p{{M}}]++)*+({_letters}++)"


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    values = F.transform(F.reverse(F.split(digits, "")), lambda d: F.try_to_number(d, F.lit("9")).cast("int"))
    doubled = F.transform(
        values, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)
    )
    return F.aggregate(doubled, F.lit(0), lambda s, d: s + F.coalesce(d, F.lit(0))) % 10 == 0


def holds(kind: str, match: Column) -> Column:
    """Whether a match of a kind's pattern is one of its kind."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)
    return {
        "email": F.lit(True),
        "ip": match.rlike(rf"^{_byte}(?:\.{_byte}){{3}}$"),
        "card": n.between(16, 19) & luhn(digits),
        "phone": n.between(8, 15),
    }[kind]


def found_spans(kind: str, text: str = "text") -> tuple[Column, Column]:
    """The parts of a text between a kind's matches, and the matches; null if there can be none."""
    needed = NEEDED[kind]
    possible = F.lit(True) if needed is None else F.contains(F.col(text), F.lit(needed))
    return (
        F.when(possible, F.split(F.col(text), PATTERNS[kind], -1)),
        F.when(possible, F.regexp_extract_all(F.col(text), F.lit(PATTERNS[kind]), F.lit(0))),
    )


def placed_spans(kind: str, parts: Column, matches: Column, starts: Column, breaks: Column, lines: Column) -> Column:
    """The array of a kind's spans, from the parts, the matches, the sums of the lengths and of the
    line breaks before, and the hashes of the lines; ``first`` where the line stands first in its text."""
    number = F.lit(KINDS.index(kind))

    def span(m: Column, i: Column) -> Column:
        start = F.get(starts, i) + F.length(F.get(parts, i))
        line = F.get(breaks, i) + line_breaks(F.get(parts, i))
        return F.struct(
            number.alias("kind"),
            start.alias("start"),
            (start + F.length(m)).alias("end"),
            F.xxhash64(number, normal(kind, m)).alias("entity"),
            (F.array_position(lines, F.get(lines, line)) == line + 1).alias("first"),
        )

    spans = F.transform(matches, lambda m, i: F.when(holds(kind, m), span(m, i)))
    return F.coalesce(F.filter(spans, lambda s: s.isNotNull()), F.array().cast(f"array<{_span}>"))


def words_before(chunks: Column, start: Column) -> Column:
    """The text's last ``REACH`` words before a place, the last one up to the place, and what parts them."""
    at = F.floor(start / CHUNK).cast("int")

    def turned(n: Column) -> Column:
        near = F.left(F.coalesce(F.get(chunks, at), F.lit("")), start % CHUNK)
        return F.reverse(F.concat(F.array_join(F.slice(chunks, at - n + 1, n), ""), near))

    def whole(n: Column) -> Column:
        return F.regexp_extract(turned(n), rf"^\s*+(?:\S++\s++){{{REACH}}}", 0)

    one, more = F.least(at, F.lit(1)), F.least(at, F.lit(16))
    rest = F.regexp_extract(turned(at), rf"^\s*+(?:\S++\s++){{0,{REACH - 1}}}+\S*+", 0)
    return F.reverse(F.when(whole(one) != "", whole(one)).when(whole(more) != "", whole(more)).otherwise(rest))


def words_after(chunks: Column, end: Column) -> Column:
    """The text's first ``REACH`` words after a place, the first one from the place on, and what parts them."""
    at = F.floor(end / CHUNK).cast("int")

    def ahead(n: Column) -> Column:
        near = F.substring(F.coalesce(F.get(chunks, at), F.lit("")), end % CHUNK + 1, F.lit(CHUNK))
        return F.concat(near, F.array_join(F.slice(chunks, at + 2, n), ""))

    def whole(n: Column) -> Column:
        return F.regexp_extract(ahead(n), rf"^(?:\s*+\S++){{{REACH}}}(?=\s)", 0)

    one, more = F.lit(1), F.lit(16)
    rest = F.regexp_extract(ahead(F.size(chunks)), rf"^(?:\s*+\S++){{0,{REACH}}}+", 0)
    return F.when(whole(one) != "", whole(one)).when(whole(more) != "", whole(more)).otherwise(rest)


def letter_runs(side: Column) -> Column:
    """The runs of letters in the words that no digit or @ is part of, each with what it skips before."""
    pieces, runs = (F.regexp_extract_all(side, F.lit(_run), F.lit(k)) for k in (0, 1))
    return F.zip_with(pieces, runs, lambda p, r: F.struct((F.length(p) - F.length(r)).alias("skip"), r.alias("run")))


def with_contexts(spans: Column, chunks: Column) -> Column:
    """The spans with the letter runs of the words on either side, and where these words begin."""

    def context(s: Column) -> Column:
        before = F.transform(F.array(words_before(chunks, s["start"])), lambda w: F.struct(
            (s["start"] - F.length(w)).alias("begin"), letter_runs(w).alias("runs")
        ))
        after = F.struct(s["end"].alias("begin"), letter_runs(words_after(chunks, s["end"])).alias("runs"))
        names = ("kind", "start", "end", "entity", "first")
        return F.struct(*[s[c].alias(c) for c in names], F.get(before, F.lit(0)).alias("left"), after.alias("right"))

    return F.transform(spans, context)


def normal(kind: str, match: Column) -> Column:
    """The entity that a match names, however it is written."""
    return F.lower(match) if kind in ("email", "ip") else F.regexp_replace(match, "[^0-9]", "")


def new_lines(text: str = "text") -> Column:
    """The text without the lines that it holds before already."""
    return F.array_join(F.array_distinct(F.split(F.col(text), "\n", -1)), "\n")


def line_breaks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))


def text_key(text: str = "text") -> Column:
    """A digest of the whole text: equal for copies only."""
    return F.unhex(F.sha2(F.col(text).cast("binary"), 256))


def copied_texts(base: DataFrame) -> DataFrame:
    """``text_key`` and ``copies`` of the texts that several rows hold; stored."""
    counted = base.groupBy("text_key").agg(F.count("*").alias("copies"))
    return stored(counted.where("copies > 1"), "copies")


def weighed(rows: DataFrame, copies: DataFrame) -> DataFrame:
    """``rows`` with ``weight``, which all rows of one text_key share: 1 between them."""
    few = copies.count() <= MOST_BROADCAST
    joined = rows.join(F.broadcast(copies) if few else copies, "text_key", "left")
    return joined.withColumn("weight", F.lit(1.0) / F.coalesce("copies", F.lit(1))).drop("copies", "text_key")


def base_spans(docs: DataFrame) -> DataFrame:
    """A row for each row of ``docs``: doc_id, row_key, text_key, n_words and for each kind its spans, stored."""
    texts = docs.select("doc_id", whole_text().alias("text")).select("doc_id", "text", row_key().alias("row_key"))
    words = F.size(F.array_remove(F.split(new_lines(), f"{_others}+"), ""))
    keyed = ["doc_id", "row_key", "text_key", "n_words"]
    lines = F.transform(F.split(F.col("text"), "\n", -1), lambda line: F.xxhash64(line))
    looked = texts.select(
        "doc_id", "row_key", "text", text_key().alias("text_key"), words.cast("long").alias("n_words"), lines.alias("lines"), *_parts_and_matches()
    )
    steps = {
        kind: F.transform(f"{kind}_matches", _step_of(F.col(f"{kind}_parts"))) for kind in KINDS
    }
    breaks = {  # no match holds a line break
        kind: F.transform(f"{kind}_matches", _breaks_of(F.col(f"{kind}_parts"))) for kind in KINDS
    }
    sums = [prefix_sums(steps[kind]).alias(f"{kind}_starts") for kind in KINDS]
    placed = looked.select("*", *sums, *[prefix_sums(breaks[kind]).alias(f"{kind}_breaks") for kind in KINDS])
    names = ("parts", "matches", "starts", "breaks")
    spans = [placed_spans(kind, *[F.col(f"{kind}_{c}") for c in names], F.col("lines")).alias(kind) for kind in KINDS]
    found = placed.select(*keyed, "text", *spans)
    some = F.size(F.concat(*KINDS)) > 0
    cut = F.regexp_extract_all("text", F.lit(rf"(?s).{{1,{CHUNK}}}"), F.lit(0))
    chunks = F.when(some, cut).otherwise(F.array().cast("array<string>"))
    found = found.select(*keyed, *KINDS, chunks.alias("chunks"))
    return stored(found.select(*keyed, *[with_contexts(F.col(k), F.col("chunks")).alias(k) for k in KINDS]), "spans")


def _parts_and_matches() -> list[Column]:
    found = {kind: found_spans(kind) for kind in KINDS}
    return [c.alias(f"{kind}_{name}") for kind in KINDS for c, name in zip(found[kind], ("parts", "matches"), strict=True)]


def _step_of(parts: Column):
    """Code points from one match's end to the next one's."""
    return lambda m, i: F.length(F.get(parts, i)) + F.length(m)


def _breaks_of(parts: Column):
    return lambda m, i: line_breaks(F.get(parts, i))


def row_key() -> Column:
    """A number for the row's id and text."""
    return F.xxhash64("doc_id", "text")


def context_terms(base: DataFrame) -> DataFrame:
    """The terms in the contexts of all entities: row_key, entity, weight, term, start, end; stored.

    Where a term stands in a context once more, and in a context that doesn't count, it has no weight.
    """
    counts = F.when(F.col("e.first"), F.col("weight")).otherwise(0.0)
    entities = base.select("row_key", "weight", F.explode(F.concat(*KINDS)).alias("e"))
    entities = entities.select("row_key", counts.alias("weight"), "e.*")

    def placed(side: str) -> Column:
        runs, begin = F.col(f"{side}.runs"), F.col(f"{side}.begin")
        starts = prefix_sums(F.transform(runs, lambda r: r["skip"] + F.length(r["run"])))

        def term(r: Column, s: Column) -> Column:
            start = begin + s + r["skip"]
            return F.struct(F.lower(r["run"]).alias("term"), start.alias("start"), (start + F.length(r["run"])).alias("end"))

        return F.zip_with(runs, starts, term)

    listed = entities.select("row_key", "entity", "weight", F.concat(placed("left"), placed("right")).alias("terms"))
    listed = listed.withColumn("names", F.transform("terms", lambda t: t["term"]))
    terms = listed.select("row_key", "entity", "weight", "names", F.posexplode("terms").alias("k", "t")).select(
        "row_key",
        "entity",
        F.when(F.array_position("names", F.col("t.term")) == F.col("k") + 1, F.col("weight")).otherwise(0.0).alias("weight"),
        "t.*",
    )
    return stored(terms, "terms")


def disclosing_terms(
    docs: DataFrame, base: DataFrame, terms: DataFrame, copies: DataFrame, support: int = SUPPORT
) -> DataFrame:
    """``entity``, ``term`` and the term's ``disclosure`` of it, for all pairs with enough contexts."""
    together = F.round(F.sum("weight")).cast("long")
    pairs = terms.groupBy("entity", "term").agg(together.alias("together")).where(F.col("together") >= support)
    pairs = stored(pairs, "pairs")
    contexts = (
        base.select("weight", F.explode(F.concat(*KINDS)).alias("e"))
        .where("e.first")
        .groupBy("e.entity")
        .agg(F.round(F.sum("weight")).cast("long").alias("contexts"))
    )
    wanted = stored(pairs.select("term").distinct(), "wanted")
    n_wanted = wanted.count()
    if n_wanted:
        texts = weighed(docs.select(whole_text().alias("text")).withColumn("text_key", text_key()), copies)
        words = texts.select("weight", F.explode(F.split(F.lower(new_lines()), f"{_others}+")).alias("term"))
        n = F.round(F.sum("weight")).cast("long").alias("n")
        if n_wanted <= MOST_BROADCAST:
            counts = words.join(F.broadcast(wanted), "term").groupBy("term").agg(n)
        else:
            counts = words.groupBy("term").agg(n).join(wanted, "term")
    else:
        counts = wanted.withColumn("n", F.lit(0).cast("long"))  # no pair to judge, so nothing to count
    total = base.agg((F.coalesce(F.round(F.sum(F.col("n_words") * F.col("weight"))), F.lit(0.0)) / (2 * REACH)).alias("windows"))
    scored = pairs.join(contexts, "entity").join(counts, "term").join(F.broadcast(total))
    n = F.greatest(F.col("windows"), 2 * F.col("contexts"))
    shared = F.log2(F.col("together") * n / (F.col("contexts") * F.greatest("n", "together")))
    return scored.select("entity", "term", (shared / F.log2(n / F.col("contexts"))).alias("disclosure"))


def personal_spans(
    docs: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE, support: int = SUPPORT
) -> DataFrame:
    """A row for each row of ``docs`` (doc_id, text): doc_id, row_key, for each kind the array of its
    spans (start, end), and ``terms``: the spans of disclosing terms with ``removed`` for each."""
    base = base_spans(docs)
    copies = copied_texts(base)
    base = weighed(base, copies)
    terms = context_terms(base)
    judged = disclosing_terms(docs, base, terms, copies, support).where(F.col("disclosure") >= generalise)
    given_away = (
        terms.join(judged, ["entity", "term"])
        .groupBy("row_key", "start", "end")
        .agg((F.max("disclosure") >= remove).alias("removed"))
        .groupBy("row_key")
        .agg(F.array_sort(F.collect_list(F.struct("start", "end", "removed"))).alias("terms"))
    )
    none = F.array().cast("array<struct<start:int,end:int,removed:boolean>>")
    plain = [
        F.transform(kind, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias(kind)
        for kind in KINDS
    ]
    return base.join(given_away, "row_key", "left").select(
        "doc_id", "row_key", *plain, F.coalesce("terms", none).alias("terms")
    )


def written_spans(kind: str, name: str) -> Column:
    """The spans of a column as strings of kind, start and end."""
    return F.transform(
        kind, lambda s: F.concat_ws(":", F.lit(name), s["start"].cast("string"), s["end"].cast("string"))
    )


def sanitised(
    docs: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE, support: int = SUPPORT
) -> DataFrame:
    """``docs`` with entities replaced by their kind, terms that give them away generalised or left out.

    Rows without such spans stay as they are; ``n_chars``, where there is such a column, follows
    the text.
    """
    spans = personal_spans(docs, generalise, remove, support)
    marked = [F.transform(kind, _shown_as(f"[{kind.upper()}]")) for kind in KINDS]
    marked.append(
        F.transform(
            "terms",
            lambda s: F.struct(
                s["start"].alias("start"), s["end"].alias("end"), F.when(s["removed"], "").otherwise("[TERM]").alias("shown")
            ),
        )
    )
    masks = (
        spans.select("row_key", F.array_sort(F.concat(*marked)).alias("masks"))
        .where(F.size("masks") > 0)
        .dropDuplicates(["row_key"])
    )
    keyed = docs.select(row_struct(docs).alias("row"), whole_text().alias("text"), F.col("doc_id")).select(
        "row", "text", row_key().alias("key")
    )
    joined = keyed.join(masks, keyed["key"] == masks["row_key"], "left").withColumn(
        "new", F.when(F.col("masks").isNotNull(), masked(F.col("text"), F.col("masks")))
    )
    changed = {"text": F.col("new"), "n_chars": F.length("new")}
    out = []
    for c in docs.columns:
        old = F.col("row")[c]
        if c in changed:
            new = changed[c].cast(docs.schema[c].dataType)
            old = F.when(F.col("masks").isNotNull(), new).otherwise(old)
        out.append(old.alias(c))
    return joined.select(*out)


def _shown_as(label: str):
    return lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(label).alias("shown"))


def masked(text: Column, masks: Column) -> Column:
    """The text with each mask's span shown as it says; of overlapping masks the first one shows."""
    start = F.struct(F.array().cast("array<string>").alias("parts"), F.lit(0).alias("at"))

    def step(s: Column, m: Column) -> Column:
        before = F.substring(text, s["at"] + 1, F.greatest(m["start"] - s["at"], F.lit(0)))
        shown = F.when(m["start"] >= s["at"], m["shown"]).otherwise("")
        return F.struct(
            F.concat(s["parts"], F.array(F.concat(before, shown))).alias("parts"),
            F.greatest(s["at"], m["end"]).alias("at"),
        )

    return F.aggregate(
        masks, start, step, lambda s: F.concat(F.array_join(s["parts"], ""), F.substring(text, s["at"] + 1, F.length(text)))
    )
