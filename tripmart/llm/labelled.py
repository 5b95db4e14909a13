"""Labelled documents to learn from: which rows, how many, and their texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import fold, text_of


def training_labels(labels: DataFrame, label: str, folds: int, held: int) -> DataFrame:
    """`doc_id, label` (0 or 1) of the ids outside the held-out fold, one row each.

    Null ids and null labels are left out; of several labels of one id the
    larger counts.
    """
    doc_id, value = labels["doc_id"], labels[label].cast("int")
    usable = doc_id.isNotNull() & value.isNotNull() & (fold(doc_id, folds) != held)
    return labels.filter(usable).groupBy(doc_id.cast("long").alias("doc_id")).agg(F.max(value).alias("label"))


def training_rows(
    documents: DataFrame, labels: DataFrame, label: str, folds: int, held: int, rows: int, seed: int
) -> DataFrame:
    """`doc_id, text, label` of about `rows` labelled documents, or of all if there are fewer; one row for each id.

    Ids that have a label and a document are taken while a hash of them is small
    enough, so that about as many remain whatever the inputs' sizes. Only the
    labels of these few ids go to the documents, and only ids are exchanged to
    count. Of rows that share an id the one with the least hash of its text is
    learnt from, so repeated ids do not widen the bound.
    """
    texts = documents.select(documents["doc_id"].cast("long").alias("doc_id"), text_of(documents).alias("text"))
    known = training_labels(labels, label, folds, held)
    known = known.join(texts.select("doc_id"), "doc_id", "left_semi")
    n = known.count()
    share = min(1.0, rows / n) if n else 1.0
    place = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(1 << 32))
    few = known.filter(place < int(share * (1 << 32))) if share < 1 else known
    few = F.broadcast(few.withColumnRenamed("doc_id", "id"))  # about `rows` rows, by the share
    found = texts.join(few, texts["doc_id"] == few["id"]).drop("id")
    first = F.min(F.struct(F.xxhash64("text").alias("hash"), F.col("text"))).alias("first")
    return found.groupBy("doc_id", "label").agg(first).select("doc_id", "first.text", "label")
