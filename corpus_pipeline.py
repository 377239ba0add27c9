"""From raw documents to packed training sequences: five corpus operators one after another.

Every stage works on all rows that the one before kept. The first four return the columns of
``documents``, the last one the packed pieces.

- language: rows in no learned language go (score under ``LEAST_SCORE``, or no letter at all).
- near duplicates: one document of each SimHash group stays, that of the smallest id.
- decontamination: documents that benchmark windows cover to a twentieth or more go.
- personal data: entities are replaced by their kind, terms that give them away generalised.
- packing: the token pieces of what is left, in sequences of at most 2048 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidetable.llm.decontaminate import without_contaminated
from tidetable.llm.frames import find_code, stored, table
from tidetable.llm.langid import with_known_language
from tidetable.llm.packing import packed
from tidetable.llm.pii import sanitised
from tidetable.llm.simhash import one_of_each_group
from tidetable.session import discard

#: Share of a text's n-grams that its language must explain.
LEAST_SCORE = 0.3


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    find_code(spark)
    return with_known_language(docs, LEAST_SCORE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    find_code(spark)
    return one_of_each_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sanitised(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    find_code(spark)
    return packed(docs)


STAGES = [
    ("language", keep_known_languages),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal data", replace_personal_data),
    ("packing", pack_sequences),
]

#: SQL can express neither the language filters nor the tokenizer; tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents``, each stage written before the next one reads it and deleted after."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        last, docs = docs, stored(stage(spark, docs, sf_dir), f"stage-{number}")
        discard(last)
    return docs
