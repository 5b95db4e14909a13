"""From raw documents to encoded training data, in five stages.

Each stage takes the documents that the one before has kept, as files, and its
decisions take effect: what a stage rejects is gone for all later ones. All but
the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmart.llm.common import stage, table
from tripmart.llm.mixing import mixed_documents
from tripmart.llm.quality import good_documents
from tripmart.llm.sigtree import one_of_each_group
from tripmart.llm.toxicity import harmless_documents
from tripmart.llm.wordtable import digests, encode_and_decode


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def keep_harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    return harmless_documents(docs, table(spark, sf_dir, "labels"))


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group with nearly equal shingles."""
    return one_of_each_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the sources' weights ask for."""
    return mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text, a row for each copy in the mix."""
    return digests(encode_and_decode(docs))


STAGES = [
    ("quality classifier", keep_good),
    ("toxicity", keep_harmless),
    ("n-gram Jaccard join", keep_distinct),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", encode),
]

#: The classifiers and the tokenizer have no SQL; a test holds the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder, each reading what the last has written."""
    docs = table(spark, sf_dir, "documents")
    for _, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
