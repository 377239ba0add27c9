"""The registered queries of the corpus operators: each one applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidetable.llm.decontaminate import contamination_counts
from tidetable.llm.frames import table
from tidetable.llm.langid import languages
from tidetable.llm.merkle import verified_versions
from tidetable.llm.packing import packed
from tidetable.llm.pii import KINDS, personal_spans, written_spans
from tidetable.llm.ranked_search import ranked
from tidetable.llm.simhash import near_duplicate_groups
from tidetable.llm.spotsigs import edited_and_next
from tidetable.llm.substring_dedup import deduplicated
from tidetable.llm.token_counts import count_tokens
from tidetable.llm.token_files import tokens_round_trip
from tidetable.llm.url_rules import judged
from tidetable.llm.warc import archived

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op1_disclosure_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = personal_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.array_join(F.concat(*[written_spans(kind, kind) for kind in KINDS]), ",")
    everything = F.array_join(F.concat(*[written_spans(k, k) for k in KINDS], written_spans("terms", "term")), ",")
    return spans.select(
        "doc_id",
        *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        everything.alias("spans"),
    )


def op2_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op3_language_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(table(spark, sf_dir, "documents"))


def op4_relative_lz_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(table(spark, sf_dir, "documents"))


def op5_benchmark_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = contamination_counts(docs, table(spark, sf_dir, "benchmark"))
    return marked.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_tokens(table(spark, sf_dir, "documents"), budget=1024)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"), "budget_chars")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens_round_trip(table(spark, sf_dir, "documents")).select("doc_id", "start", "n_tokens", "ids_crc32")


def op8_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_and_next(table(spark, sf_dir, "documents"))


def op9_pigeonring_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_duplicate_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_indexed_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = archived(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    urls = judged(table(spark, sf_dir, "pages").select("page_id", "url"))
    return urls.select("row.page_id", "host", "path", "rule", "verdict", "evidence")


def op12_merkle_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    versions = verified_versions(table(spark, sf_dir, "documents"), tampered, F.translate("text", _UPPER, _LOWER))
    return versions.select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", F.size("copies").alias("n_copied")
    ).withColumn("n_copied", F.when(F.col("n_copied") >= 0, F.col("n_copied")))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ranked(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_disclosure_pii,
        op2_pattern_packing,
        op3_language_filters,
        op4_relative_lz_dedup,
        op5_benchmark_windows,
        op6_token_counts,
        op7_token_files,
        op8_spotsigs,
        op9_pigeonring_simhash,
        op10_indexed_warc,
        op11_url_rules,
        op12_merkle_versions,
        op13_ranked_search,
    )
}

_BENCHMARK_WORDS = (
    f"list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), "
    r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
)
_TERMS = (
    f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)


def _field(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(CAST(octet_length(encode({text})) AS VARCHAR) || ':' || {text}, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


# CRC-32 of a number's digits, bit by bit.
_CRC32 = (
    "xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
    "lambda c: CAST(ord(c) AS BIGINT))), lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], "
    "lambda v, turn: xor(v >> 1, 3988292384 * (v & 1)))))"
)


def _tree(name: str, nodes: str) -> str:
    """All levels above ``nodes`` (g, pos, digest, n), eight to one."""
    return f"""{name} AS (
    SELECT g, CAST(0 AS BIGINT) AS level, pos, digest, n FROM {nodes}
    UNION ALL
    SELECT g, level + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), (n + 7) // 8
    FROM {name} WHERE n > 1 GROUP BY g, level, pos // 8, n)"""


def _fold(name: str, start: str, tree: str) -> str:
    """The changed path of each row of ``start`` (r, g, pos, digest) up a tree."""
    return f"""{name} AS (
    SELECT r, g, CAST(0 AS BIGINT) AS level, pos, digest FROM {start}
    UNION ALL
    SELECT f.r, f.g, f.level + 1, f.pos // 8,
        sha256(string_agg(CASE WHEN t.pos = f.pos THEN f.digest ELSE t.digest END, '' ORDER BY t.pos))
    FROM {name} f JOIN {tree} t ON t.g = f.g AND t.level = f.level AND t.pos // 8 = f.pos // 8 AND t.n > 1
    GROUP BY f.r, f.g, f.level, f.pos // 8)"""


def _siblings(name: str, start: str, tree: str) -> str:
    return f"""{name} AS (
    SELECT r, string_agg(t.digest, '' ORDER BY t.level, t.pos) AS digests
    FROM {start} s JOIN {tree} t ON t.g = s.g AND t.n > 1
        AND t.pos // 8 = s.pos // CAST(8 ** (t.level + 1) AS BIGINT) AND t.pos <> s.pos // CAST(8 ** t.level AS BIGINT)
    GROUP BY r)"""


#: SQL with the same rows, where SQL can express them.
ORACLE_SQL: dict[str, str] = {
    "op4_relative_lz_dedup": r"""
WITH docs AS (
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
    FROM documents),
windows AS (
    SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS w
    FROM docs, unnest(range(1, len(words) - 18)) t(i)),
later AS (
    SELECT doc_id, i FROM (
        SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS n FROM windows) WHERE n > 1),
removed AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM later),
gone AS (SELECT doc_id, list(p) AS places FROM removed GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed,
    sha256(array_to_string(
        list_filter(words, lambda x, k: NOT list_contains(coalesce(places, []), k)), ' ')) AS kept_sha256
FROM docs LEFT JOIN gone USING (doc_id)""",
    "op5_benchmark_windows": f"""
WITH docs AS (SELECT doc_id, {_BENCHMARK_WORDS} AS words FROM documents),
items AS (SELECT item_id, {_BENCHMARK_WORDS} AS words FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, n, array_to_string(words[i:i + n - 1], ' ') AS w
    FROM (SELECT item_id, words, least(13, len(words)) AS n FROM items WHERE len(words) > 0),
        unnest(range(1, len(words) - n + 2)) t(i)),
hits AS (
    SELECT doc_id, i, n, item_id
    FROM (SELECT doc_id, n, i, array_to_string(words[i:i + n - 1], ' ') AS w
        FROM docs, (SELECT DISTINCT n FROM windows), unnest(range(1, len(words) - n + 2)) t(i))
    JOIN windows USING (n, w)),
words_hit AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items_hit AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM docs LEFT JOIN words_hit USING (doc_id) LEFT JOIN items_hit USING (doc_id)""",
    "op10_indexed_warc": """
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS bytes, sha256(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT digest, min(page_id) AS first FROM p WHERE bytes >= 100 GROUP BY digest)
SELECT page_id, CAST(bytes AS BIGINT) AS payload_bytes, digest AS payload_digest,
    CASE WHEN coalesce(first, page_id) = page_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (digest)""",
    "op11_url_rules": rf"""
WITH read AS (
    SELECT row_number() OVER () AS r, page_id, coalesce(url, '') AS url,
        CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages),
parts AS (
    SELECT r, page_id, translate(url, '{_UPPER}', '{_LOWER}') AS text,
        translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM read),
listed AS (
    SELECT r, max(struct_pack(size := length(h || p), rule := h || p, verdict := v)) AS l
    FROM parts, (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
        ('allow', 'com', '/fr/'), ('block', 'com', '/de/')) AS rules(v, h, p)
    WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY r),
words AS (
    SELECT *, list_filter(regexp_split_to_array(translate(path, '{_UPPER}', '{_LOWER}'), '[^\p{{L}}\p{{N}}]+'),
        lambda w: w <> '') AS words
    FROM parts),
tokens AS (
    SELECT r, page_id, host, path, l.rule AS rule, l.verdict AS verdict, list_distinct(list_concat(
        list_transform(list_filter([regexp_extract(text, '^([a-z0-9+.-]*)://', 1)], lambda x: x <> ''), lambda x: 'scheme:' || x),
        list_transform(list_filter([split_part(host, '.', -1)], lambda x: x <> ''), lambda x: 'tld:' || x),
        list_transform(list_filter(regexp_split_to_array(host, '[^\p{{L}}\p{{N}}]+'), lambda x: x <> ''), lambda x: 'host:' || x),
        list_transform(words, lambda w: CASE WHEN regexp_full_match(w, '[0-9]+') THEN 'path:#' ELSE 'path:' || w END),
        list_transform(list_filter(words, lambda w: regexp_full_match(w, '[0-9]+')), lambda w: 'digit:' || w[1]),
        list_transform(list_filter(list_transform(string_split(regexp_extract(text, '^[^?#]*\?([^#]*)', 1), '&'),
            lambda x: split_part(x, '=', 1)), lambda x: x <> ''), lambda x: 'query:' || x),
        CASE WHEN contains(text, '#') THEN ['fragment'] ELSE [] END)) AS tokens
    FROM words LEFT JOIN listed USING (r)),
totals AS (
    SELECT n, greatest(0.01::DOUBLE, least(1::DOUBLE, 5::DOUBLE / n)) AS support, blocked::DOUBLE / n AS share FROM (
        SELECT count(*) AS n, count(*) FILTER (WHERE verdict = 'block') AS blocked FROM tokens WHERE verdict IS NOT NULL)),
known AS (
    SELECT token, urls, abs(blocked::DOUBLE / urls - share) AS telling FROM (
        SELECT token, count(*) AS urls, count(*) FILTER (WHERE verdict = 'block') AS blocked
        FROM (SELECT verdict, unnest(tokens) AS token FROM tokens WHERE verdict IS NOT NULL) GROUP BY token), totals
    WHERE urls >= support * n),
kept AS (
    SELECT r, verdict, list_sort(list(token ORDER BY telling DESC, urls DESC, token DESC)[1:8]) AS tokens
    FROM (SELECT r, verdict, unnest(tokens) AS token FROM tokens WHERE verdict IS NOT NULL) JOIN known USING (token)
    GROUP BY r, verdict),
sets AS (
    SELECT verdict, list_filter(tokens, lambda t, i: (mask >> (i - 1)) & 1 = 1) AS tokens
    FROM kept, unnest(range(1, CAST(2 ** len(tokens) AS BIGINT))) t(mask)),
rules AS (
    SELECT tokens, verdict, told::DOUBLE / alone AS confidence, told::DOUBLE / n AS support FROM (
        SELECT tokens, verdict, count(*) AS told, sum(count(*)) OVER (PARTITION BY tokens) AS alone
        FROM sets GROUP BY tokens, verdict), totals
    WHERE told >= ceil(totals.support * n) AND told::DOUBLE / alone >= 0.8),
weaker AS (
    SELECT DISTINCT a.tokens, a.verdict FROM rules a, unnest(a.tokens) u(t) JOIN rules b
        ON b.verdict = a.verdict AND b.tokens = list_filter(a.tokens, lambda x: x <> t) AND b.confidence >= a.confidence),
best AS (
    SELECT r, max(struct_pack(confidence, support, size := len(m.tokens), verdict := m.verdict,
        evidence := array_to_string(m.tokens, ' '))) AS b
    FROM tokens t JOIN (SELECT * FROM rules ANTI JOIN weaker USING (tokens, verdict)) m ON list_has_all(t.tokens, m.tokens)
    WHERE t.verdict IS NULL GROUP BY r)
SELECT page_id, host, path, rule, coalesce(verdict, b.verdict, 'allow') AS verdict, b.evidence AS evidence
FROM tokens LEFT JOIN best USING (r)""",
    "op12_merkle_versions": f"""
WITH RECURSIVE d AS (
    SELECT row_number() OVER () AS r, doc_id, lang, {_leaf('text')} AS leaf,
        CASE WHEN {_CRC32} % 3 = 0 THEN {_leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} END AS changed
    FROM documents),
placed AS (
    SELECT r, doc_id, lang, leaf, changed, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g,
        row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
        count(*) OVER (PARTITION BY lang) AS n
    FROM d),
leaves AS (SELECT g, pos, leaf AS digest, n FROM placed),
{_tree("tree", "leaves")},
subroots AS (SELECT 0 AS g, g AS pos, digest, count(*) OVER () AS n FROM tree WHERE n = 1),
{_tree("top", "subroots")},
root AS (SELECT digest AS root FROM top WHERE n = 1),
low AS (SELECT r, g, pos, coalesce(changed, leaf) AS digest FROM placed),
{_fold("low_fold", "low", "tree")},
middle AS (
    SELECT f.r, 0 AS g, f.g AS pos, f.digest FROM low_fold f JOIN tree t ON t.g = f.g AND t.level = f.level AND t.n = 1),
{_fold("top_fold", "middle", "top")},
folded AS (SELECT f.r, f.digest FROM top_fold f JOIN top t ON t.level = f.level AND t.n = 1),
{_siblings("low_siblings", "low", "tree")},
{_siblings("top_siblings", "middle", "top")},
depth AS (SELECT t.g, t.level + u.level AS levels FROM tree t, top u WHERE t.n = 1 AND u.n = 1)
SELECT doc_id, leaf, s.digest AS subroot, root,
    sha256(coalesce(a.digests, '') || coalesce(b.digests, '')) AS proof_sha256, f.digest AS folded_root,
    f.digest = root AS verified, CASE WHEN changed IS NOT NULL THEN CAST(levels AS INT) END AS n_copied
FROM placed p JOIN subroots s ON s.pos = p.g JOIN folded f USING (r) JOIN depth ON depth.g = p.g
LEFT JOIN low_siblings a USING (r) LEFT JOIN top_siblings b USING (r), root""",
    "op13_ranked_search": f"""
WITH held AS (SELECT r, doc_id, len(words) AS n, words FROM (
    SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS words FROM documents) WHERE len(words) > 0),
totals AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM held),
counts AS (
    SELECT r, doc_id, n, word, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(words) AS word FROM held) GROUP BY ALL),
asked AS (
    SELECT i, item_id, word, count(*) AS times FROM (
        SELECT row_number() OVER () AS i, item_id, unnest({_TERMS}) AS word FROM benchmark) GROUP BY ALL),
weights AS (
    SELECT word, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
    FROM (SELECT word, count(*) AS df FROM counts GROUP BY word), totals),
scores AS (
    SELECT i, item_id, r, doc_id, CAST(sum(times * w
        * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
    FROM asked JOIN weights USING (word) JOIN counts USING (word), totals GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS INT) AS rank
    FROM scores WHERE score > 0) WHERE rank <= 10""",
}
