"""URL rules, Merkle versions and ranked search against brute force, with odd rows."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidetable.llm import merkle, ranked_search, url_rules
from tidetable.llm.frames import find_code

DATA = "/root/testdata/sf0.001"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWERED = str.maketrans(UPPER, UPPER.lower())


# --- URL rules ---


def brute_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    host = re.match(r"[^/?#]*", rest).group()
    return host.translate(LOWERED), re.match(r"[^?#]*", rest[len(host) :]).group()


def brute_listed(host, path, rules=url_rules.RULES):
    fits = [
        (len(h) + len(p), h + p, verdict)
        for verdict, h, p in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[1:] if fits else (None, None)


def brute_rules(labelled, support, confidence, most, least):
    """Rules from (tokens, verdict) by counting every combination."""
    n = len(labelled)
    support = max(support, min(1.0, least / n))
    count = math.ceil(support * n)
    share = sum(v == "block" for _, v in labelled) / n
    urls, blocked = Counter(), Counter()
    for tokens, verdict in labelled:
        urls.update(tokens)
        blocked.update(tokens if verdict == "block" else ())
    known = {t for t, c in urls.items() if c >= support * n}
    both, alone = Counter(), Counter()
    for tokens, verdict in labelled:
        kept = sorted((t for t in tokens if t in known), key=lambda t: (abs(blocked[t] / urls[t] - share), urls[t], t))[-most:]
        for size in range(1, len(kept) + 1):
            for part in itertools.combinations(sorted(kept), size):
                alone[part] += 1
                both[part, verdict] += 1
    rules = {k: (c / alone[k[0]], c / n) for k, c in both.items() if c >= count and c / alone[k[0]] >= confidence}
    return {
        (part, verdict): figures
        for (part, verdict), figures in rules.items()
        if not any(
            (less := tuple(t for t in part if t != out), verdict) in rules and rules[less, verdict][0] >= figures[0]
            for out in part
        )
    }


ODD_URLS = [
    None, "", "no scheme at all", "http://", "HTTP://Example.ORG/en/1?x", "https://example.org", "https://org/", "https://a.b.example.org/es/",
    "https://notexample.org/es/1", "ftp://user@WWW.EXAMPLE.COM:80/de/1", "https://x.com/de/?q=1#f", "https://x.com/De/1", "https://x.com?de=/de/",
    "https://x.com/fr/\nline", "x://y://com/fr/", "https://münchen.com/de/" + "a" * 100_000, "https://x.com/fr/a", "https://x.com/fr/a",
]


@pytest.fixture(scope="module")
def pages(spark):
    find_code(spark)
    real = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url")
    odd = spark.createDataFrame([(10_000 + i, u) for i, u in enumerate(ODD_URLS)] + [(None, "https://x.org/a")], real.schema)
    return real.unionByName(odd)


def test_urls_are_judged(spark, pages):
    wide = pages.withColumns({n: F.concat(F.lit("v"), "page_id") for n in ("row", "host", "tokens", "verdict", "a.b", "index")})
    rows = url_rules.judged(wide, most_tokens=6).collect()
    assert len(rows) == pages.count()
    for r in rows:
        host, path = brute_parts(r.row.url)
        rule, verdict = brute_listed(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.row["a.b"] == (None if r.row.page_id is None else f"v{r.row.page_id}")
        if rule is not None:
            assert r.verdict == verdict and r.evidence is None


def test_mined_rules_and_their_use(spark, pages):
    host, path = url_rules.host_and_path(F.col("url"))
    read = pages.select("page_id", url_rules.url_tokens(F.col("url")).alias("tokens"), url_rules.listed_rule(host, path).alias("l"))
    source = [(r.page_id, sorted(r.tokens), r.l and r.l.verdict) for r in read.collect()]
    labelled = [(t, v) for _, t, v in source if v is not None]
    want = brute_rules(labelled, 0.03, 0.8, 6, 5)
    found = url_rules.mined_rules(
        read.where("l IS NOT NULL").select("tokens", F.col("l.verdict").alias("verdict")), 0.03, 0.8, 6, 5
    ).collect()
    assert {(tuple(r.tokens), r.verdict): (r.confidence, r.support) for r in found} == want and len(want) > 5
    counts = Counter(t for tokens, _ in labelled for t in tokens)
    assert all(r.key == min(r.tokens, key=lambda t: (counts[t], t)) for r in found)
    verdicts = {r.row.page_id: (r.verdict, r.evidence) for r in url_rules.judged(pages, support=0.03, most_tokens=6).collect()}
    for page_id, tokens, verdict in source:
        if verdict is None:
            fits = [(*f, len(p), v, " ".join(p)) for (p, v), f in want.items() if set(p) <= set(tokens)]
            assert verdicts[page_id] == (max(fits)[3:] if fits else ("allow", None))


def test_url_rules_without_labels(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_rules.judged(empty).collect() == []
    one = spark.createDataFrame([(1, "https://a.net/x")], "page_id long, url string")
    assert [(r.verdict, r.rule, r.evidence) for r in url_rules.judged(one).collect()] == [("allow", None, None)]
    assert url_rules.judged(one, rules=()).first().verdict == "allow"


def test_url_tokens(spark):
    df = spark.createDataFrame([("HTTPS://www.Cheap-Pills.example.com/de/123-a/x.html?q=1&r#top",)], "u string")
    assert sorted(df.select(url_rules.url_tokens(F.col("u"))).first()[0]) == [
        "digit:1", "fragment", "host:cheap", "host:com", "host:example", "host:pills", "host:www", "path:#", "path:a", "path:de",
        "path:html", "path:x", "query:q", "query:r", "scheme:https", "tld:com",
    ]


# --- Merkle versions ---


def joined(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_leaf(r, text):
    fields = (r.doc_id, r.source, r.lang, r.n_chars, text)
    return joined("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def brute_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([joined("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def is_tampered(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0


def brute_versions(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r.lang, []).append(r)
    langs = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    for lang in langs:
        groups[lang].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, brute_leaf(r, r.text)))
    trees = {lang: brute_levels([brute_leaf(r, r.text) for r in groups[lang]]) for lang in langs}
    top = brute_levels([trees[lang][-1][0] for lang in langs])
    root = top[-1][0] if langs else None
    out = []
    for g, lang in enumerate(langs):
        for i, r in enumerate(groups[lang]):
            node = leaf = trees[lang][0][i]
            if is_tampered(r.doc_id):
                node = brute_leaf(r, r.text and r.text.translate(LOWERED))
            proof, copies = "", []
            for levels, at in ((trees[lang], i), (top, g)):
                for level in levels[:-1]:
                    run, place = list(level[at // 8 * 8 : at // 8 * 8 + 8]), at % 8
                    proof += "".join(run[:place] + run[place + 1 :])
                    run[place] = node
                    node, at = joined("".join(run)), at // 8
                    copies.append(node)
            copies = copies if is_tampered(r.doc_id) else None
            out.append((r.doc_id, leaf, trees[lang][-1][0], root, joined(proof), node, node == root, copies))
    return out


def versions(docs, levels=merkle.LEVELS):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return merkle.verified_versions(docs, tampered, F.translate("text", UPPER, UPPER.lower()), levels)


def shown(rows):
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified, r.copies) for r in rows), key=str)


ODD_DOCS = [
    (9000, None, "en", "s", 0), (9001, "", None, None, None), (9002, "Tie", "zz", "s", 3), (9002, "Tie", "zz", "s", 3), (9002, "other", "zz", "s", 5),
    (None, "No Id", "zz", "s", 5), (None, "No Id", "zz", "s", 5), (9003, "Lone", "ü", "s", 4), (9004, "Wörd " * 60_000, "en", "s", 1), (9005, "x", "", "s", 1),
]


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_merkle_versions(spark, levels):
    find_code(spark)
    real = spark.read.parquet(f"{DATA}/documents.parquet")
    docs = real.unionByName(spark.createDataFrame(ODD_DOCS, "doc_id long, text string, lang string, source string, n_chars long"))
    clashing = docs.withColumns({n: F.lit("v") for n in ("group", "pos", "leaf", "a.b", "n", "group_key")})
    got = versions(clashing, levels).collect()
    assert shown(got) == sorted(brute_versions(docs.collect()), key=str)
    changed = [r for r in got if r.tampered]
    assert any(not r.verified for r in changed) and all(r.verified for r in got if not r.tampered)


def test_merkle_small_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    assert versions(spark.createDataFrame([], schema)).collect() == []
    for n in (1, 2, 9, 65):
        docs = spark.createDataFrame([(i, f"Text {i}", "en", "s", 6) for i in range(n)], schema)
        assert shown(versions(docs, 1).collect()) == sorted(brute_versions(docs.collect()), key=str)
    lone = spark.createDataFrame([(i, "A", str(i), "s", 1) for i in range(20)], schema)
    rows = versions(lone, 1)
    assert shown(rows.collect()) == sorted(brute_versions(lone.collect()), key=str)
    copies = merkle.copied_nodes(rows).collect()
    assert len(copies) == 2 * sum(is_tampered(i) for i in range(20)) and {c.level for c in copies} == {1, 2}


# --- ranked search ---


def brute_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWERED))


def brute_ranking(docs, items, k=10):
    held = [(r.doc_id, Counter(brute_terms(r.text))) for r in docs]
    held = [(d, c, c.total()) for d, c in held if c]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item in items:
        scores = []
        for doc_id, c, n in held:
            m = 100 - 75 + (75 * n * n_docs) // n_terms
            score = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t, times in Counter(brute_terms(item.text)).items()
                if t in c
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id, score))
        for rank, s in enumerate(sorted(scores, key=lambda s: s[:3])[:k], 1):
            out.append((item.item_id, rank, s[3], s[4]))
    return sorted(out, key=str)


SEARCHED = [
    (7000, None), (7001, ""), (7002, "... !!"), (7003, "THE the ÉTÉ été 42 a_b"), (7004, "same same twins"), (7004, "same same twins"),
    (7005, "same same twins"), (None, "same same twins"), (7006, "the " * 400_000 + "needle"), (7007, "z" * 200_000),
]
ASKED = [(1, "The needle, the été"), (2, None), (3, "--"), (4, "same twins"), (4, "same twins"), (5, "nowhere-to-be-found"), (6, "a_b 42 z" + "z" * 199_999)]


@pytest.mark.parametrize("query_bytes", [ranked_search.QUERY_BYTES, 70_000])
def test_ranking(spark, query_bytes):
    find_code(spark)
    real = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    docs = real.unionByName(spark.createDataFrame(SEARCHED, real.schema)).repartition(3)
    items = spark.read.parquet(f"{DATA}/benchmark.parquet").limit(12).unionByName(spark.createDataFrame(ASKED, "item_id long, text string"))
    wide = docs.withColumns({n: F.lit("v") for n in ("n", "terms", "item", "a.b")})
    got = ranked_search.ranked(wide, items.withColumn("item", F.lit(1)), query_bytes=query_bytes).collect()
    assert sorted(map(tuple, got), key=str) == brute_ranking(docs.collect(), items.collect())


def test_search_in_small_blocks():
    """Blocks of few postings, lists short and long, and ties, give what all sums give."""
    import random

    import numpy as np
    import pyarrow as pa

    turn = random.Random(5)
    docs = [(i, 10 + i % 7, sorted(turn.sample(range(30), turn.randint(0, 12)))) for i in range(600)]
    columns = [[d for d, _, _ in docs], [n for _, n, _ in docs], [t for _, _, t in docs], [[1 + x % 3 for x in t] for _, _, t in docs]]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, ranked_search._forward_arrow)], schema=ranked_search._forward_arrow
    )
    weights = np.arange(30, dtype=np.int64) * 37 % 11
    for trial in range(40):
        query = [(t, turn.randint(1, 3)) for t in turn.sample(range(30), turn.randint(1, 12))]
        parts = []
        for step in (600, 50, 7):
            best = ranked_search.Best(10)
            for at in range(0, 600, step):
                ranked_search.Block([batch.slice(at, step)], weights, 600, 8000).search(query, best)
            parts.append(list(zip(best.scores.tolist(), best.ids.tolist())))
        want = []
        for i, n, terms in docs:
            m = 25 + 75 * n * 600 // 8000
            score = sum(q * int(weights[t]) * (10**9 * (1 + t % 3) // (1000 * (1 + t % 3) + 8 * m)) for t, q in query if t in terms)
            if score:
                want.append((-score, i))
        want = [(-s, i) for s, i in sorted(want)[:10]]
        assert parts == [want] * 3
    batches = list(ranked_search.blocks_of(iter([batch, batch])))
    assert sum(b.num_rows for block in batches for b in block) == 1200


def test_empty_search(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked_search.ranked(docs, items).collect() == []
    assert ranked_search.ranked(docs.unionByName(spark.createDataFrame([(1, "a")], docs.schema)), items.limit(0)).collect() == []


def test_terms_in_runs():
    text = "Ab cd,EF " * 1000 + "é1 " * 50
    assert ranked_search.term_counts(text, 17) == ranked_search.term_counts(text) == Counter(t.encode() for t in brute_terms(text))


def test_mined_rules_take_every_token(spark):
    # a and b tell nothing alone and rank below the eight fillers, yet together they always block.
    fillers = [f"f{i}" for i in range(8)]
    groups = [(["a", "b"], "block"), (["a"], "allow"), (["b"], "allow"), (["g"], "block")]
    labelled = [(sorted(extra + fillers), verdict) for extra, verdict in groups for _ in range(10)]
    frame = spark.createDataFrame(labelled, "tokens array<string>, verdict string")
    found = url_rules.mined_rules(frame).collect()
    want = brute_rules(labelled, url_rules.SUPPORT, url_rules.CONFIDENCE, 100, url_rules.LEAST_URLS)
    assert {(tuple(r.tokens), r.verdict): (r.confidence, r.support) for r in found} == want
    assert (("a", "b"), "block") in want
