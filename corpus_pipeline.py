"""A corpus pipeline: language, quality, near duplicates, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and drops what its
operator rejects; all but the last keep the columns of ``documents``. The last gives the pieces of
training sequences.

* a document whose language stays unclear goes (as do texts without a letter);
* one that the quality classifier scores below its cut goes;
* of documents whose SimHash fingerprints (3-word shingles) link at 2 or fewer differing bits, the one with
  the smallest id in the linked group stays (op6's operator, no word-similarity check beside it);
* one that holds ten consecutive words of a benchmark item (or a whole shorter item) goes;
* the rest is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hushmark.llm import decontamination, language_id, packing, quality_classifier, simhash
from hushmark.llm.common import table, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_identified(docs, language_id.learn(language_id.training_rows(docs)))


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = quality_classifier.training_labels(table(spark, sf_dir, "labels"))
    return quality_classifier.keep_good(docs, quality_classifier.fit(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, simhash.near_duplicates)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", identify_language),
    ("quality_classifier", classify_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: Models and fingerprints are beyond SQL; the tests hold ``run`` against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
