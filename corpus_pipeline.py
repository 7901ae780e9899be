"""From raw documents to tokens: quality, near-duplicates, benchmark passages, personal data, encoding.

Each stage takes all documents that its predecessor kept, as a Parquet table, and returns those it keeps;
the last one returns the digests of their tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import bpe, decontaminate, pii, pu_classifier, simhash
from corpusmill.llm.common import staged, table
from corpusmill.llm.queries import PSEUDONYM_KEY, vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from these documents and their labels, does not reject."""
    return pu_classifier.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash links, by shingles of four words and at most four differing bits."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.without_items(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms for personal values; their length follows the new text."""
    done = pii.pseudonymise(docs, PSEUDONYM_KEY, count=None)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        done = done.withColumn("n_chars", F.length("text").cast(kind))
    return done


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens and digests of ids and decoded text."""
    return bpe.code_digests(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality),
    ("near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("BPE encoding and decoding", encoding),
]

# the classifier is a trained model, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
