"""The pipeline: each stage's decisions on planted rows, and the whole run."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidetable.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def planted(spark):
    real = spark.read.parquet(f"{SF}/documents.parquet")
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    first = real.where("length(text) > 800").orderBy("doc_id").first()
    rows = [
        (90_001, "4711 0815 !!", "en", "s", 12), (90_002, None, "en", "s", 0), (90_003, first.text, first.lang, "s", first.n_chars),
        (90_004, item, "en", "s", len(item)), (90_005, "The mail that you wrote to jo@example.org was not of use.", "en", "s", 57),
    ]
    return real.unionByName(spark.createDataFrame(rows, real.schema)), first


def test_stages(spark, planted):
    docs, first = planted
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = stage(spark, docs, SF).cache()
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        if name != "packing":
            assert docs.columns == columns
        if name == "personal data":
            assert "[EMAIL]" in docs.where("doc_id = 90005").first().text
    assert not {90_001, 90_002} & kept["language"] and {90_003, 90_004, 90_005} <= kept["language"]
    assert 90_003 not in kept["near duplicates"] and first.doc_id in kept["near duplicates"]
    assert 90_004 not in kept["decontamination"] and 90_005 in kept["decontamination"]
    assert kept["personal data"] == kept["decontamination"] == kept["packing"]
    assert docs.agg(F.max(F.col("offset") + F.col("length"))).first()[0] <= 2048


def test_clashing_columns(spark, planted):
    """Columns with the operators' own names, and with odd ones, pass through unchanged."""
    docs = planted[0].limit(30)
    names = ["row", "key", "masks", "new", "fp", "component_id", "lang_pred", "score", "hits", "words", "a.b", "row_key", "n words"]
    wide = docs.select("*", *[F.concat(F.lit("v"), "doc_id").alias(n) for n in names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, wide, SF)
        assert out.columns == wide.columns, name
        for r in out.collect():
            assert [r[n] for n in names] == [f"v{r.doc_id}"] * len(names)
    assert corpus_pipeline.STAGES[-1][1](spark, wide, SF).count() >= 30


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.count() > 0 and rows.columns[:2] == ["doc_id", "piece"]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near duplicates", "decontamination", "personal data", "packing"]


@pytest.fixture
def small_corpus(spark, tmp_path):
    """A folder of tables with one case of each stage's decisions, null ids and empty texts."""
    body = [f"the {w} was seen by them and then it went on to the old house of {w}" for w in ("fox", "dog", "hen", "cow", "owl")]
    en = [" ".join(f"{b} number {k} {j}" for j, b in enumerate(body)) for k in range(30)]
    item = "seen fox old hen went owl house dog then cow on them number by was it to the and of"
    rows = [(k, t, "en", "s", len(t)) for k, t in enumerate(en)]
    rows += [
        (100, en[3], "en", "s", 1), (101, en[3], "en", "s", 1), (102, "1234 5678", "en", "s", 9), (103, None, "en", "s", 0), (104, "", "en", "s", 0),
        (105, f"the old house {item} was seen", "en", "s", 1), (106, "the house of the man was seen, write to jo@example.org and then go", "en", "s", 1),
        (None, "the house and the owl went on to them", "en", "s", 1), (None, f"it was {item}", None, None, None),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path), rows, item


def test_whole_run_against_brute_force(spark, small_corpus):
    from tokenizers import Tokenizer

    import public_tokenizers
    from tests.llm.test_dedup_ops import brute_components, brute_fingerprint

    folder, rows, item = small_corpus
    docs, outputs = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder).cache()
        outputs[name] = docs.collect()
    texts = lambda name: sorted(str((r.doc_id, r.text)) for r in outputs[name])
    lettered = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    assert texts("language") == sorted(str(r[:2]) for r in lettered)
    named = [r for r in lettered if r[0] is not None]
    roots = brute_components([brute_fingerprint(r[1]) for r in named])
    smallest = {}
    for r, root in zip(named, roots, strict=True):
        smallest[root] = min(r, smallest.get(root, r), key=lambda x: x[0])
    kept = [*smallest.values(), *[r for r in lettered if r[0] is None]]
    assert texts("near duplicates") == sorted(str(r[:2]) for r in kept)
    clean = [r for r in kept if item not in r[1]]
    assert texts("decontamination") == sorted(str(r[:2]) for r in clean) and len(clean) < len(kept)
    masked = [(r[0], r[1].replace("jo@example.org", "[EMAIL]")) for r in clean]
    got = {r.doc_id: r.text for r in outputs["personal data"]}
    assert len(outputs["personal data"]) == len(clean)
    assert "jo@example.org" not in str(got) and got[106].count("[EMAIL]") == 1
    assert sorted(str(d) for d in got) == sorted(str(d) for d, _ in {(d, t) for d, t in masked})
    library = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    lengths = sorted(len(library.encode(r.text, add_special_tokens=False).ids) + 1 for r in outputs["personal data"])
    assert sorted(r.length for r in outputs["packing"]) == lengths
    places = {}
    for r in outputs["packing"]:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in places.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert corpus_pipeline.run(spark, folder).count() == len(outputs["packing"])


def test_run_of_an_empty_table_and_what_it_leaves(spark, small_corpus, tmp_path):
    import os

    from tidetable.session import own_folder

    folder, _, _ = small_corpus
    empty = tmp_path / "empty"
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(str(empty / "documents.parquet"))
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(str(empty / "benchmark.parquet"))
    top = own_folder(spark).removeprefix("file:")
    before = set(os.listdir(top))
    assert corpus_pipeline.run(spark, str(empty)).count() == 0
    assert corpus_pipeline.run(spark, folder).count() > 0
    left = sorted(n.rsplit("-", 1)[0] for n in set(os.listdir(top)) - before)
    assert [n for n in left if "stage" in n] == ["corpus-stage-4", "corpus-stage-4"]


def test_queries_cover_all_operators():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))
    assert set(ORACLE_SQL) <= set(QUERIES)
