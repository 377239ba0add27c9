"""Personal data, language filters, decontamination and WARC archives."""

from __future__ import annotations

import gzip
import hashlib
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tidetable.llm import decontaminate, langid, pii, warc
from tidetable.llm.frames import find_code, prefix_sums, work_path

DATA = "/root/testdata/sf0.001"

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    values = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in values) % 10 == 0


def brute_spans(text):
    out = {}
    for kind, pattern in BASE.items():
        out[kind] = []
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m.group().split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }
            if good[kind]:
                out[kind].append((m.start(), m.end()))
    return out


HARD = [
    "a@b.c_d@e.f x@y.z.", "1.2.3.4.5.6.7.8 256.1.1.1 000.0.0.255", "4111 1111 1111 1111 4111-1111-1111-1112",
    "+1 (555) 555-1234 +49.30.123456 +12", "\U0001f600é +1 555 555 1234 a@b.co \U0001f600", None, "", "@@@ a@.b a@b a@b..c",
    "." * 500, "x" * 20_000 + "@" + "y.z" * 3000, "9" * 30_000, "4111 1111 1111 1111 " * 700, "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6",
    "!" * 40_000 + " a@b.cd",
]


@pytest.fixture(scope="module")
def docs(spark):
    find_code(spark)
    real = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang")
    extra = [(5000 + i, t, "kind") for i, t in enumerate(HARD)] + [(None, "b@c.de", None), (1, "again", "x"), (1, "again", "x")]
    return real.unionByName(spark.createDataFrame(extra, "doc_id long, text string, lang string"))


def test_base_spans(docs):
    rows = pii.personal_spans(docs).collect()
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, []).append(brute_spans(r.text))
    assert len(rows) == sum(map(len, texts.values()))
    for r in rows:
        assert {k: [tuple(s) for s in r[k]] for k in pii.KINDS} in texts[r.doc_id]
    assert pii.personal_spans(docs.limit(0)).count() == 0


@pytest.fixture(scope="module")
def letters(spark):
    """A name that stands only beside one address, common words, and copies, which are no evidence."""
    rows = [(i, f"note {i} " + "so we met " * i + f"ask Zorbly about item{i} at zq@x.org or elsewhere") for i in range(12)]
    rows += [(100 + i, "we met at noon to ask about an item or a note elsewhere " * 40) for i in range(40)]
    rows += [(200 + i, "only Quandry knows cc@y.org here") for i in range(9)]
    rows += [(300, "the Wumpel line has dd@z.org in it\n" * 30)]
    return spark.createDataFrame([(i, t, len(t)) for i, t in rows], "doc_id long, text string, n_chars long")


def test_disclosing_terms(letters):
    spans = {r.doc_id: r for r in pii.personal_spans(letters).collect()}
    texts = {r.doc_id: r.text for r in letters.collect()}
    for i in range(12):
        assert [texts[i][s.start : s.end] for s in spans[i].terms] == ["Zorbly"]
    assert all(not spans[i].terms for i in spans if i >= 100)


def test_sanitised(letters):
    out = pii.sanitised(letters)
    assert out.columns == letters.columns
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[0].text == "note 0 ask  about item0 at [EMAIL] or elsewhere" and rows[0].n_chars == len(rows[0].text)
    assert rows[200].text == "only Quandry knows [EMAIL] here"
    assert rows[100] == letters.where("doc_id = 100").first()
    general = pii.sanitised(letters, remove=2.0).where("doc_id = 0").first()
    assert general.text == "note 0 ask [TERM] about item0 at [EMAIL] or elsewhere"


def given_away(spark, texts, **options):
    """The terms found in each text."""
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r.terms for r in pii.personal_spans(df, **options).collect()}
    return [[t[s.start : s.end] for s in rows[i]] for i, t in enumerate(texts)]


OTHERS = ["we met at noon to ask about an item or a note elsewhere " * 40] * 2


def test_equal_contexts_of_different_texts_count(spark):
    signed = [f"letter {'so it goes ' * i}\n\nyours as ever\nQuandry at cc@y.org here\n" for i in range(1, 10)]
    found = given_away(spark, signed + OTHERS)
    assert all("Quandry" in f for f in found[:9]) and found[9:] == [[], []]
    long = "\n".join(f"then number {i} came and {'so ' * (i % 7)} it went on and Quandry wrote from cc@y.org on" for i in range(50))
    assert given_away(spark, [long, *OTHERS])[0].count("Quandry") >= 50


def test_copies_change_no_decision(spark):
    signed = [f"letter {'so it goes ' * i} and then Quandry wrote from cc@y.org about an item\n" for i in range(1, 13)]
    once = given_away(spark, signed + OTHERS)
    assert all("Quandry" in f for f in once[:12])
    assert given_away(spark, signed * 40 + OTHERS * 40) == once[:12] * 40 + [[]] * 80
    repeated = [t * 40 for t in signed]  # the same lines again are no dilution either
    assert all("Quandry" in f for f in given_away(spark, repeated + OTHERS)[:12])


def test_every_letter_run_is_a_term(spark):
    texts = [f"so {'it was ' * i} that {w} wrote from cc@y.org" for w in ("Smith-Jones", "name:Zorbly", "Jane/Doe", "O'Neill,") for i in range(1, 10)]
    found = given_away(spark, [*texts, *OTHERS], generalise=0.05)
    for k, names in enumerate((["Smith", "Jones"], ["name", "Zorbly"], ["Jane", "Doe"], ["O", "Neill"])):
        for i in range(9):
            at = found[9 * k + i].index(names[0])
            assert found[9 * k + i][at : at + 2] == names


def brute_context(text, start, end):
    words = text[:start].split()[-pii.REACH :] + text[end:].split()[: pii.REACH]
    return [t.lower() for w in words if not re.search("[@0-9]", w) for t in re.findall(r"[^\W\d_]+", w)]


def test_contexts_are_words_on_either_side(spark):
    card = "4111 1111 1111 1111"
    texts = [
        f"Zorbly since 2019 pays with {card} or 12 34 coins", "a@x.org, b@x.org Zorbly", "長" * 700 + "，文 a@x.org" + "語" * 9000 + "。後 more",
        " ".join("w" * 100 + "abcdefghijkl"[i] for i in range(12)) + " a@x.org " + " ".join("v" * 1500 + "abcdefghijkl"[i] for i in range(12)),
        "foo1 (b2) a@x.org foo1", " \n " * 600 + "far off" + " " * 9000 + "a@x.org" + "\n" * 600 + "and on", "(Jane) x@y.zz/Doe-Roe " * 300,
        "a@x.org", "so a@x.org", "," * 3000 + "a@x.org" + "!" * 3000 + "Z",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    base = pii.base_spans(docs)
    keys = {r.row_key: r.doc_id for r in base.select("doc_id", "row_key").collect()}
    got, want = [[] for _ in texts], [[] for _ in texts]
    for r in pii.context_terms(base.withColumn("weight", F.lit(1.0))).collect():
        assert texts[keys[r.row_key]][r.start : r.end].lower() == r.term
        got[keys[r.row_key]].append(r.term)
    for i, t in enumerate(texts):
        for found in brute_spans(t).values():
            for start, end in found:
                want[i] += brute_context(t, start, end)
    assert [sorted(x) for x in got] == [sorted(x) for x in want]
    assert "zorbly" in got[0] and got[1].count("zorbly") == 2 and len(got[2]) == 5 and len(got[3]) == 16


def test_overlapping_masks(spark):
    df = spark.createDataFrame([("0123456789",)], "t string")
    masks = F.array(*[F.struct(F.lit(a).alias("start"), F.lit(b).alias("end"), F.lit(s).alias("shown")) for a, b, s in [(1, 5, "A"), (3, 7, "B"), (7, 8, "")]])
    assert df.select(pii.masked(F.col("t"), masks)).first()[0] == "0A89"


def test_prefix_sums(spark):
    values = [(list(range(n)),) for n in (0, 1, 5, 256, 257, 1000)]
    for r in spark.createDataFrame(values, "v array<int>").select("v", prefix_sums(F.col("v")).alias("s")).collect():
        assert r.s == [sum(r.v[:i]) for i in range(len(r.v))]


def test_languages(spark, docs):
    real = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    odd = [(90001, None, "en"), (90002, "123 !! \n", "en"), (90003, "汉字", None), (None, "the dog", "en"), (90004, "a", None), (90005, "the of " * 40_000, "en")]
    rows = langid.languages(real.unionByName(spark.createDataFrame(odd, real.schema))).collect()
    labels = {r.doc_id: r.lang for r in real.collect()}
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert len(held) > 200 and sum(r.lang_pred == labels[r.doc_id] for r in held) >= 0.99 * len(held)
    by = {r.doc_id: r for r in rows}
    assert by[90001].lang_pred == by[90002].lang_pred == "und" and by[90002].score == 0
    assert by[90003].lang_pred in set(labels.values()) and by[90005].lang_pred == "en"
    assert not by[None].held_out and all(0 <= r.score <= 1 for r in rows)
    unlabelled = real.limit(5).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.languages(unlabelled).collect()} == {"und"}
    assert langid.languages(real.limit(0)).count() == 0


def test_only_the_text_decides(spark):
    real = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    filters = langid.fit_filters(real)
    clash = real.limit(20).selectExpr("text", "'x' AS lang", "'s' AS row", "doc_id AS score_")
    a = [r.lang_pred for r in langid.with_language(clash, filters).orderBy("row.score_").collect()]
    b = [r.lang_pred for r in langid.with_language(real.limit(20), filters).orderBy("row.doc_id").collect()]
    assert a == b
    kept = langid.with_known_language(real, 0.3)
    assert kept.columns == real.columns and kept.count() == real.count()


def test_many_languages():
    import numpy as np

    for n in (3, 9, 17, 40, 70):
        names = [f"l{k:02d}" for k in range(n)]
        alphabet = [chr(0x4E00 + 50 * k) for k in range(n)]
        texts = [a * 30 for a in alphabet]
        hashes, of, _ = langid.grams_of(texts)
        filters = langid.build_filters(names, hashes, of)
        assert filters.predict(texts)[0] == names
        assert filters.table.dtype.itemsize * 8 * filters.table.shape[1] >= n
        assert np.all(filters.false_rate < 0.01)


def test_long_texts_are_read_in_runs(monkeypatch):
    import random
    import tracemalloc

    import numpy as np

    turn = random.Random(4)
    texts = ["", "a", " ß", "ΑΣ ΣΑΣ!", "x" * 50, "12 ... 34", None] + [
        "".join(turn.choice("abcde ÉΣ中1.,\n") for _ in range(turn.randrange(400))) for _ in range(40)
    ]
    for text in texts:
        want = sorted(langid.grams_of([text])[0].tolist())
        for run in (1, 2, 3, 7, 64, 10_000):
            if text:
                assert sorted(np.concatenate([np.zeros(0, np.uint64), *langid.run_grams(text, run)]).tolist()) == want
    hashes, of, _ = langid.grams_of(texts)
    filters = langid.build_filters(["one", "two"], hashes, of % 2)
    whole = [x.tolist() if hasattr(x, "tolist") else x for x in filters.predict(texts)]
    monkeypatch.setattr(langid, "RUN", 30)
    assert [x.tolist() if hasattr(x, "tolist") else x for x in filters.predict(texts)] == whole
    found, owner = langid.distinct_grams(texts)
    assert {(k, h) for k, h in zip(owner.tolist(), found.tolist())} == {(k, h) for k, h in zip(of.tolist(), hashes.tolist())}
    monkeypatch.undo()
    tracemalloc.start()
    filters.predict(["words and more words " * 500_000])
    assert tracemalloc.get_traced_memory()[1] < 300e6
    tracemalloc.stop()


def test_a_language_of_one_labelled_row(spark):
    rows = [(k, "und die katze sitzt auf dem dach", "de") for k in range(0, 40)] + [(100, "zqx wvk jjyx qqz xkw", "zz")]
    docs = spark.createDataFrame([r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2], "doc_id long, text string, lang string")
    filters = langid.fit_filters(docs)
    assert filters.predict(["zqx wvk jjyx", "die katze sitzt"])[0] == (["zz", "de"] if docs.where("lang = 'zz'").count() else ["de", "de"])


WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def rule_words(text):
    return WORDS.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


@pytest.fixture(scope="module")
def contaminated(spark):
    item = [f"b{k}" for k in range(30)]
    bench = [(1, " ".join(item)), (2, "Short ITEM here"), (3, None), (4, " ... "), (10, " ".join(item)), (5, "ünï cödé")]
    rows = [
        (1, "own words " * 5 + " ".join(item[3:20]).upper() + "!", "a"), (2, " ".join(item[:12]), "b"), (3, "a short, item: HERE b", "c"),
        (4, None, "d"), (5, "", "e"), (None, "short item here", "f"), (6, " ".join(item[:13]) + " filler" * 2000, "g"),
        (7, "ünï CÖDÉ ünï cödé", "h"), (8, "short item here", "i"), (8, "short item", "j"),
    ]
    return (
        spark.createDataFrame(rows, "doc_id long, text string, windows string"),
        spark.createDataFrame(bench, "item_id long, text string"),
    )


@pytest.mark.parametrize("most", [100_000, 0])
def test_contamination(contaminated, monkeypatch, most):
    docs, bench = contaminated
    monkeypatch.setattr(decontaminate, "MOST_BROADCAST", most)
    windows = {}
    for r in bench.collect():
        words = rule_words(r.text)
        n = min(13, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[i : i + n]), set()).add(str(r.item_id))
    rows = decontaminate.mark_contamination(docs, bench).collect()
    assert len(rows) == docs.count()
    for r in rows:
        words, hit, items = rule_words(r.row.text), set(), set()
        for window, ids in windows.items():
            for i in range(len(words) - len(window) + 1):
                if tuple(words[i : i + len(window)]) == window:
                    hit |= set(range(i, i + len(window)))
                    items |= ids
        assert (r.n_words, r.n_hit, r["items"]) == (len(words), len(hit), sorted(items)), r.row.doc_id
        assert r.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(words))
    assert {r.windows for r in decontaminate.without_contaminated(docs, bench).collect()} == set("bdegj")
    cut = {r.windows: r.text for r in decontaminate.without_hit_words(docs, bench).collect()}
    assert cut["c"] == "a b" and cut["b"] == docs.where("doc_id = 2").first().text
    assert decontaminate.mark_contamination(docs, bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate.mark_contamination(docs.limit(0), bench).count() == 0


def test_items_of_a_window_do_not_travel_with_its_hits(spark):
    """8,000 items share a word that 20 documents hold 200 times; hits are of fixed width."""
    bench = spark.range(8000).selectExpr("id AS item_id", "'shared' AS text")
    docs = spark.range(20).selectExpr("id AS doc_id", "repeat('shared word ', 200) AS text")
    windows = decontaminate.item_windows(bench)
    hits = decontaminate.window_hits(docs, windows)
    assert hits.schema["hits"].dataType.elementType.names == ["at", "size", "digest"]
    assert windows.select("digest").distinct().count() == 1
    rows = decontaminate.contamination_counts(docs, bench).collect()
    want = sorted(str(k) for k in range(8000))
    assert len(rows) == 20 and all((r.n_words, r.n_hit, r["items"]) == (400, 200, want) for r in rows)


def test_rows_of_one_id_are_judged_by_their_own_words(spark):
    bench = spark.createDataFrame([(1, "only here")], "item_id long, text string")
    rows = [(1, "only here"), (1, "nothing at all"), (1, "only here"), (None, "only here"), (None, "clean text"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = decontaminate.contamination_counts(docs, bench).collect()
    assert sorted(map(str, ((r.doc_id, r.n_words, r.n_hit) for r in got))) == sorted(
        map(str, [(1, 2, 2), (1, 3, 0), (1, 2, 2), (None, 2, 2), (None, 2, 0), (None, 0, 0)])
    )


def test_archives(spark):
    find_code(spark)
    real = spark.read.parquet(f"{DATA}/pages.parquet").select("page_id", "url", "html")
    big = "x" * 100
    extra = [
        (10001, None, None), (10002, "u\r\nWARC-Type: x é", "short"), (10003, "http://a", big), (10004, "http://a", big), (10004, "http://a", big),
        (None, "http://b", big), (None, None, "y" * 200), (10005, "http://c", "z" * 99), (10006, "http://c", "z" * 99), (10007, "http://l", "long " * 400_000),
    ]
    pages = real.unionByName(spark.createDataFrame(extra, real.schema))
    folder = work_path(spark, "test-warc")
    index = warc.write_archives(pages, folder)
    rows = warc.read_records(index, folder).collect()
    assert len(rows) == pages.count() == index.count()
    first = {}
    for r in pages.collect():
        raw = (r.html or "").encode()
        if len(raw) >= 100 and r.page_id is not None:
            digest = hashlib.sha256(raw).hexdigest()
            first[digest] = min(first.get(digest, r.page_id), r.page_id)
    payload = {r.page_id: (r.html or "").encode() for r in pages.collect() if r.page_id is not None}
    for r in rows:
        if r.page_id is None:
            continue
        raw = payload[r.page_id]
        digest = hashlib.sha256(raw).hexdigest()
        assert (r.payload_bytes, r.payload_digest) == (len(raw), digest)
        response = first.get(digest, r.page_id)
        assert r.refers_to == (None if response == r.page_id else response)
        assert r.record_type == ("response" if response == r.page_id else "revisit")
        assert r.payload == (raw if r.record_type == "response" else None)
    nameless = [(r.record_type, r.refers_to) for r in rows if r.page_id is None]
    assert sorted(nameless, key=str) == [("response", None), ("revisit", 10003)]
    some = index.where("page_id % 7 = 0")
    assert {r.page_id for r in warc.read_records(some, folder).collect()} == {r.page_id for r in some.collect()}
    one = index.where("page_id = 10003").first()
    store, path = warc.open_store(folder)
    with store.open_input_file(f"{path}/{one.file}") as f:
        assert gzip.decompress(f.read_at(one.length, one.offset)).startswith(b"WARC/1.1\r\nWARC-Type: response")
    assert warc.archived(pages.limit(0)).count() == 0


def test_coalesced_reads():
    assert warc.coalesced([(0, 10), (10, 5), (100, 10)], gap=20, most=1000) == [(0, 15, 2), (100, 110, 1)]
    assert warc.coalesced([(0, 10), (15, 10), (25, 10)], gap=20, most=30) == [(0, 25, 2), (25, 35, 1)]
    assert warc.coalesced([]) == []
