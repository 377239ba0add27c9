"""SimHash groups, substring dedup and SpotSigs against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidetable.llm import simhash, spotsigs, substring_dedup
from tidetable.llm.components import connected_components
from tidetable.llm.frames import find_code

DATA = "/root/testdata/sf0.001"


def documents(spark, extra):
    find_code(spark)
    real = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "source")
    return real.unionByName(spark.createDataFrame(extra, "doc_id long, text string, source string"))


EDGES = [
    (5000, None, "a"), (5001, "", "fp"), (5002, "one", "x"), (5003, "one two", "x"), (5004, "ONE TWO", "x"),
    (None, "no id at all", None), (5005, "same same " * 400, "x"), (5006, "same same " * 400, "x"), (5007, "word " * 50_000, "x"),
    (5008, "tabs\tand\x0bfeeds\x0c here\x1cstays", "x"), (5009, "rep eat", "x"), (5009, "rep eat", "x"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark, EDGES)


def brute_fingerprint(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    root = {i: i for i in range(len(prints))}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


def test_simhash_groups(spark, docs):
    rows = simhash.near_duplicate_groups(docs).collect()
    source = docs.where("doc_id <> 5007 or doc_id is null").collect()
    prints = [brute_fingerprint(r.text) for r in source]
    roots = brute_components(prints)
    smallest = {}
    for r, root in zip(source, roots, strict=True):
        if r.doc_id is not None:
            smallest[root] = min(smallest.get(root, r.doc_id), r.doc_id)
    want = sorted((str(r.doc_id), p, smallest.get(root)) for r, p, root in zip(source, prints, roots, strict=True))
    got = sorted((str(r.doc_id), r.fp & (2**64 - 1), r.component_id) for r in rows if r.doc_id != 5007)
    assert got == want and len(rows) == docs.count()
    assert simhash.near_duplicate_groups(docs.limit(0)).count() == 0


def test_one_document_of_each_group_stays(docs):
    kept = simhash.one_of_each_group(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    groups = {r.component_id for r in simhash.near_duplicate_groups(docs.where("doc_id is not null")).collect()}
    assert sorted(i for i in ids if i is not None) == sorted(groups) and ids.count(None) == 1


def test_texts_of_one_id_in_different_groups_stay(spark):
    words = ["alpha beta gamma delta " * 9, "one two three four five " * 9, "red green blue white " * 9]
    rows = [(1, words[0]), (1, words[1]), (1, words[1]), (2, words[1]), (3, words[2]), (1, words[2])]
    kept = simhash.one_of_each_group(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(tuple(r) for r in kept.collect()) == sorted((1, w) for w in words)


def test_pigeonring_keys_lose_no_link(spark):
    """Fingerprints one to four bits apart, all linked pairs found against a full comparison."""
    rng = random.Random(3)
    prints = []
    for _ in range(150):
        a = rng.getrandbits(64)
        prints.append(a)
        for bits in (1, 2, 3, 4):
            b = a
            for k in rng.sample(range(64), bits):
                b ^= 1 << k
            prints.append(b)
    rows = [(int(np.uint64(p).view(np.int64)),) for p in prints]
    links = simhash.fingerprint_links(spark.createDataFrame(rows, "fp long").distinct())
    roots = {r.node: r.root for r in connected_components(links).collect()}
    found = [roots.get(r[0], r[0]) for r in rows]
    want = brute_components(prints)
    same = {}
    for f, w in zip(found, want, strict=True):
        assert same.setdefault(w, f) == f
    assert len(set(found)) == len(set(want))


def test_large_groups_look_neighbours_up(monkeypatch):
    rng = np.random.default_rng(4)
    fps = np.unique(rng.integers(0, 4096, 300, np.uint64))
    pairs = {(int(min(x, y)), int(max(x, y))) for a, b in simhash.neighbours(fps) for x, y in zip(a, b, strict=True)}
    assert pairs == {
        (int(a), int(b)) for a in fps for b in fps if a < b and int(a ^ b).bit_count() <= 3
    }


def test_connected_components(spark):
    rng = random.Random(1)
    links = [(a, a + 1) for a in range(100, 300)] + [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(250)]
    links += [(7, 7), (8, 9), (9, 8)]
    root = {x: x for link in links for x in link}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root if x != 7}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_removed(rows):
    seen, out = set(), {}
    for doc_id, words in sorted(rows, key=lambda r: r[0]):
        gone = set()
        for p in range(len(words) - 19):
            window = tuple(words[p : p + 20])
            if window in seen:
                gone |= set(range(p, p + 20))
            seen.add(window)
        out[doc_id] = gone
    return out


@pytest.mark.parametrize("all_hot", [False, True])
def test_substring_dedup(spark, docs, monkeypatch, all_hot):
    if all_hot:
        real = substring_dedup.hot_keys
        monkeypatch.setattr(substring_dedup, "hot_keys", lambda texts: real(texts, 0.0, 1))
    rng = random.Random(2)
    common = [f"w{k}" for k in range(60)]
    extra = []
    for k in range(40):
        own = [f"d{k}_{j}" for j in range(rng.randrange(0, 40))]
        a, n = rng.randrange(40), rng.randrange(10, 60)
        text = " ".join(own + common[a : a + n] + own[:5] + common[: rng.randrange(30)])
        extra.append((9000 + (k * 7) % 40, text, "x"))
    monkeypatch.setattr(substring_dedup, "RUN", 4000)  # so that most matches cross runs
    both = docs.unionByName(spark.createDataFrame(extra, "doc_id long, text string, source string"))
    rows = substring_dedup.deduplicated(both).collect()
    assert len(rows) == both.count()
    source = {r.doc_id: (r.text or "").encode().split() for r in both.collect()}
    gone = brute_removed([(i, w) for i, w in source.items() if i is not None])
    for r in rows:
        words, removed = source[r.doc_id], gone.get(r.doc_id, set())
        kept = b" ".join(w for p, w in enumerate(words) if p not in removed)
        assert (r.n_words, r.n_removed, r.kept_sha256) == (len(words), len(removed), hashlib.sha256(kept).hexdigest())
    assert substring_dedup.deduplicated(both.limit(0)).count() == 0


def phrase_runs(n_runs, per_run):
    """Runs of documents that all hold a phrase of 60 words, between words of their own."""
    phrase, turn, runs = [f"p{k}" for k in range(60)], random.Random(8), []
    for r in range(n_runs):
        ids = [1000 * r + k for k in range(per_run)]
        texts = [" ".join([f"o{i}_{j}" for j in range(turn.randrange(5, 40))] + phrase + [f"e{i}_{j}" for j in range(12)]) for i in ids]
        runs.append((ids, texts))
    return runs


def coverage(batches):
    """The words that the factors among some filed rows cover, by document."""
    out = {}
    for batch in batches:
        for kind, doc, payload in zip(*(batch.column(n).to_pylist() for n in ("kind", "doc_id", "payload")), strict=True):
            if kind == substring_dedup.FACTORS:
                for f in np.frombuffer(payload, substring_dedup._factor):
                    assert (f["source"], f["source_begin"]) < (doc, f["begin"])
                    out.setdefault(doc, set()).update(range(f["begin"], f["end"]))
    return out


def filed_rows(runs, hot=None):
    import pyarrow as pa

    rows = pa.Table.from_batches([b for ids, texts in runs for b in substring_dedup.look_through(ids, texts, hot)])
    return rows.sort_by("key")


@pytest.mark.parametrize("most", [0, 500, 1 << 30])
@pytest.mark.parametrize("hot", [False, True])
def test_a_phrase_of_all_documents(monkeypatch, most, hot):
    runs = phrase_runs(40, 5)
    want = brute_removed([(i, t.split()) for ids, texts in runs for i, t in zip(ids, texts)])
    keys = np.unique(np.concatenate([substring_dedup.RunWindows(i, [t.encode().split() for t in x]).low for i, x in runs]))
    monkeypatch.setattr(substring_dedup, "MOST_HELD", most)
    for size in (7, 64, 100_000):
        batches = filed_rows(runs, keys if hot else None).to_batches(size)
        found = coverage(substring_dedup.resolve(iter(batches)))
        assert found == {i: gone for i, gone in want.items() if gone}


def test_hot_keys_keep_places_small(spark):
    """A passage that every document holds between words of its own fills places; split, it fills none."""
    runs = phrase_runs(60, 4)
    rows = [(i, t) for ids, texts in runs for i, t in zip(ids, texts)]
    texts = spark.createDataFrame(rows, "doc_id long, text string").repartition(16)
    hot = substring_dedup.hot_keys(texts, 1e-6, 10)
    assert 0 < len(hot) < 200 and (np.diff(hot.astype(object)) > 0).all()

    def largest(hot):
        filed = filed_rows(runs, hot).to_pandas()
        blocks = filed[filed.kind == substring_dedup.BLOCK]
        return blocks.payload.map(len).groupby(blocks.key).sum().max() // 6

    # Windows that go on into the documents' own words share a key until it is split.
    assert largest(None) > 3 * largest(hot) and largest(hot) <= 60


def test_factors_name_their_source(spark):
    text = " ".join(f"v{k}" for k in range(50))
    rows = [(1, text), (2, "start " + text + " end"), (3, text[: text.index(" v30")] + " x " + text)]
    parsed = substring_dedup.parse(spark.createDataFrame(rows, "doc_id long, text string"))
    factors = {r.doc_id: [tuple(f) for f in r.factors] for r in parsed.collect()}
    assert factors[1] == [] and factors[2] == [(1, 51, 1, 0)]
    words = {i: t.split() for i, t in rows}
    assert {p for a, b, *_ in factors[3] for p in range(a, b)} == set(range(81)) - {30}
    for begin, end, source, at in factors[3]:
        assert (source, at) < (3, begin) and words[source][at : at + end - begin] == words[3][begin:end]


def test_greedy_parse_covers_all():
    rng = np.random.default_rng(5)
    for _ in range(200):
        n = rng.integers(0, 12)
        f = np.zeros(n, substring_dedup._factor)
        f["begin"] = rng.integers(0, 100, n)
        f["end"] = f["begin"] + rng.integers(20, 40, n)
        f["source"] = rng.integers(0, 3, n)
        f["source_begin"] = rng.integers(0, 50, n)
        cover = lambda x: {p for a, b in zip(x["begin"], x["end"], strict=True) for p in range(a, b)}
        assert cover(substring_dedup.greedy_parse(f.copy())) == cover(f)


def test_spotsigs_edited_texts(spark, docs, monkeypatch):
    monkeypatch.setattr(spotsigs, "ROWS", 30)  # so that many places meet
    extra = [(5002, "the big red dog and \U0001f600 tail", "x"), (-4, "the cat sat on the mat", "x"), (6000, "?!", "x")]
    both = docs.where("doc_id <> 5007 or doc_id is null").unionByName(
        spark.createDataFrame(extra, "doc_id long, text string, source string")
    )
    rows = spotsigs.edited_and_next(both).collect()
    order = both.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie")
    ).collect()
    order.sort(key=lambda r: (r.doc_id is None, -(r.doc_id or 0), r.tie))
    assert len(rows) == len(order)
    prints = {}
    for k, r in enumerate(order):
        after = order[(k + 1) % len(order)].text
        n = len(r.text)
        edited = r.text[: n - n // 2] + after[: n // 2]
        digest = hashlib.sha256(edited.encode()).hexdigest()
        mine = [x for x in rows if x.doc_id == r.doc_id and x.n_chars == n and x.edited_sha256 == digest]
        assert mine
        assert prints.setdefault(r.text, mine[0].fingerprint) == mine[0].fingerprint
        assert 0 <= mine[0].near_edited <= 1 and 0 <= mine[0].near_next <= 1
        if after == r.text or edited == r.text:
            assert (mine[0].near_next if after == r.text else mine[0].near_edited) == 1
    assert spotsigs.edited_and_next(both.limit(0)).count() == 0
    alone = spotsigs.edited_and_next(both.limit(1)).first()
    assert alone.near_next == 1


def test_spotsigs_signatures(spark):
    df = spark.createDataFrame([("The big Dog and a cat sat.",), ("of the",), ("",)], "text string")
    got = [r.s for r in spotsigs.with_signatures(df, "text", "s").collect()]
    want = df.limit(1).select(
        F.array_sort(F.array(F.xxhash64(F.lit("the"), F.lit("big"), F.lit("dog"), F.lit("cat")), F.xxhash64(F.lit("a"), F.lit("cat"), F.lit("sat"), F.lit(None).cast("string")))).alias("s")
    )
    assert got[0] == want.first().s and len(got[1]) == len(got[2]) == 1 and got[1] != got[2]
    a, b = F.array(*map(F.lit, range(10))), F.array(*map(F.lit, range(5, 25)))
    pair = spark.range(1).select(spotsigs.likeness(a, b).alias("x"), spotsigs.likeness(a, b, 0.8).alias("y")).first()
    assert pair.x == 5 / 25 and pair.y == 0


def test_spotsigs_cover_texts_without_known_common_words(spark):
    """Finnish-like texts and lists with one begin: each half of a text tells in its fingerprint."""
    begin = "yksi kaksi kolme nelja viisi kuusi "
    texts = [begin + " ".join(f"sana{k}x{i}" for i in range(40)) for k in range(2)] + ["|".join(f"w{i}" for i in range(40)) * 2]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in spotsigs.edited_and_next(docs).collect()}
    assert len({r.fingerprint for r in rows.values()}) == 3
    assert rows[1].near_next < 0.5 and all(r.near_edited < 0.9 for r in rows.values())
    sigs = spotsigs.with_signatures(docs, "text", "s", []).orderBy("doc_id").collect()
    assert len(sigs[0].s) == 1 + 46 - spotsigs.CHAIN


def test_spotsigs_anchors_are_the_corpus_s_common_words(spark):
    texts = [f"ja sana{i} on ja uusi{i} on ja" for i in range(50)] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert spotsigs.common_words(docs.limit(0)) == []
    more = docs.selectExpr("doc_id", "concat(text, ' a', doc_id, ' b', doc_id, ' c', doc_id, ' d', doc_id) AS text")
    assert spotsigs.common_words(more) == ["ja"]
