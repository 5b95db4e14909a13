"""The package's registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripmart.llm import mixing, phrases, segments, sigtree
from tripmart.llm.alignment import align
from tripmart.llm.common import table
from tripmart.llm.graph import nearest
from tripmart.llm.lm import score_documents
from tripmart.llm.mixing import mix
from tripmart.llm.phrases import collocations
from tripmart.llm.quality import score_quality
from tripmart.llm.sharding import shard_documents
from tripmart.llm.segments import top_k
from tripmart.llm.sigtree import linked_documents
from tripmart.llm.syncmers import fingerprints
from tripmart.llm.tokens import count_tokens
from tripmart.llm.toxicity import score_toxicity
from tripmart.llm.wordtable import digests, encode_and_decode

Query = Callable[[SparkSession, str], DataFrame]


def _on_documents(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(table(spark, sf_dir, "documents"))


def _with_labels(operator: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Query]:
    return {
        "op1_language_model": _on_documents(score_documents),
        "op2_mixing": _on_documents(mix),
        "op3_jaccard_join": _on_documents(linked_documents),
        "op4_sharding": _on_documents(shard_documents),
        "op5_syncmers": _on_documents(fingerprints),
        "op6_toxicity": _with_labels(score_toxicity),
        "op7_bpe_words": _on_documents(lambda documents: digests(encode_and_decode(documents))),
        "op8_quality": _with_labels(score_quality),
        "op9_token_counts": _on_documents(count_tokens),
        "op10_top_k": lambda spark, sf_dir: top_k(table(spark, sf_dir, "embeddings")),
        "op11_phrases": _on_documents(collocations),
        "op12_alignment": _on_documents(align),
        "op13_nearest": lambda spark, sf_dir: nearest(table(spark, sf_dir, "embeddings")),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_mixing": mixing.SQL,
        "op3_jaccard_join": sigtree.SQL,
        "op10_top_k": segments.SQL,
        "op11_phrases": phrases.SQL,
    }
