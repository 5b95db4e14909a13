"""Quality: similarity-weighted votes of the nearest labelled documents among latent-semantic vectors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import fold, ship, text_of
from tripmart.llm.labelled import training_rows

FOLDS, HELD = 3, 1
THRESHOLD = 0.5
#: Labelled documents that vote, about; all if there are fewer.
FIT_ROWS = 6000
SEED = 8
#: Terms: hashed character trigrams, hashed trigrams of character classes, and words that repeat the one before.
LETTERS, CLASSES = 1535, 512
TERMS = LETTERS + CLASSES + 1
#: Dimensions of the latent vectors, and rounds of the power iteration that finds them.
LATENT, ROUNDS = 48, 4
NEIGHBOURS = 15
#: Documents of one product of matrices.
BLOCK = 256


def _classes() -> np.ndarray:
    """Bytes by class: lower and upper case, digits, white space; every other ASCII sign is its own class."""
    table = np.arange(256, dtype=np.uint32)
    table[128:] = ord("a")
    for byte in range(128):
        sign = chr(byte)
        if sign.isalpha():
            table[byte] = ord("a") if sign.islower() else ord("A")
        elif sign.isdigit():
            table[byte] = ord("0")
        elif sign.isspace():
            table[byte] = ord(" ")
    return table


CLASS_OF = _classes()


def terms(text: str) -> np.ndarray:
    """Log of one plus the count of each term of the text."""
    data = np.frombuffer(text.encode(), np.uint8)
    counts = np.zeros(TERMS, np.float32)
    for symbols, first, size in ((data.astype(np.uint32), 0, LETTERS), (CLASS_OF[data], LETTERS, CLASSES)):
        if len(symbols) >= 3:
            mixed = (symbols[:-2] * np.uint32(65599) + symbols[1:-1]) * np.uint32(65599) + symbols[2:]
            mixed = (mixed * np.uint32(2654435761)) >> np.uint32(8)
            counts[first : first + size] = np.bincount(mixed % np.uint32(size), minlength=size)
    words = text.split()
    counts[-1] = sum(map(eq, words, words[1:]))
    return np.log1p(counts)


@dataclass
class Model:
    """Term weights times latent directions, and the labelled documents' vectors of length 1."""

    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    rate: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Share of label 1 among the nearest labelled documents, by cosine; the overall share where none is near."""
        if not len(self.labels):
            return np.full(len(rows), self.rate)
        near = _unit(rows @ self.directions) @ self.vectors.T
        k = min(NEIGHBOURS, len(self.labels))
        found = np.argpartition(-near, k - 1, axis=1)[:, :k]
        votes = np.clip(np.take_along_axis(near, found, axis=1), 0, None).astype(np.float64)
        total = votes.sum(axis=1)
        ones = (votes * self.labels[found]).sum(axis=1)
        return np.where(total > 1e-6, ones / np.maximum(total, 1e-6), self.rate)


def _unit(vectors: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.maximum(lengths, 1e-9)


def fit(train: DataFrame) -> Model:
    """Latent vectors of the training documents (`text, label`).

    Tasks turn texts into term vectors; the driver gets one of fixed size for
    each training document, whose number is bounded. Terms are weighted by
    inverse document frequency and rows scaled to length 1; a power iteration
    from a fixed start finds the leading singular directions.
    """

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [terms(t).astype(np.float16).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.binary()), batch.column(2)], names=["doc_id", "terms", "label"]
            )

    rows = train.select("doc_id", "text", "label").mapInArrow(own, "doc_id long, terms binary, label int").toPandas()
    rows = rows.sort_values(["doc_id", "terms"])
    labels = rows["label"].to_numpy(np.float64)
    rate = float((labels.sum() + 0.5) / (len(labels) + 1))
    if not len(rows):
        return Model(np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), labels, rate)
    matrix = np.empty((len(rows), TERMS), np.float32)
    for i, found in enumerate(rows.pop("terms")):
        matrix[i] = np.frombuffer(found, np.float16)
    frequency = np.count_nonzero(matrix, axis=0)
    weight = (np.log((1 + len(rows)) / (1 + frequency)) + 1).astype(np.float32)
    matrix *= weight
    matrix /= np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-9)
    basis = np.random.default_rng(SEED).standard_normal((TERMS, LATENT + 16)).astype(np.float32)
    for _ in range(ROUNDS):
        basis, _ = np.linalg.qr(matrix.T @ (matrix @ basis))
    _, _, right = np.linalg.svd(matrix @ basis, full_matrices=False)
    directions = (basis @ right.T)[:, :LATENT]
    vectors = _unit(matrix @ directions).astype(np.float32)
    return Model((weight[:, None] * directions).astype(np.float32), vectors, labels, rate)


def quality_score(documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Column:
    """A column of `documents`: the score of the whole text, by voters learnt now. See `score_quality`."""
    spark = documents.sparkSession
    ship(spark)
    model = fit(training_rows(documents, labels, "quality", FOLDS, HELD, fit_rows, SEED))
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        voters, scores = shared.value, [np.empty(0)]
        for at in range(0, len(texts), BLOCK):
            scores.append(voters.score(np.stack([terms(t) for t in texts.slice(at, BLOCK).to_pylist()])))
        return pa.array(np.concatenate(scores), pa.float64())

    return score(text_of(documents))


def score_quality(documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Score every whole text; the voters are labelled documents outside fold 1 of 3.

    `fit_rows` bounds the labelled documents that vote (about so many, chosen by
    a hash of the id), and with it what is broadcast. Every document's cosine to
    every voter is computed, in blocks, and the nearest fifteen vote with the
    weight of their cosine.

    Returns `doc_id, held_out, score, predicted` (1 from a score of 0.5 on).

    Null text counts as empty; texts without terms get the share of label 1. A
    null id is not held out and has no label. Repeated rows are scored alike.
    Null labels are left out; of several labels of one id the larger counts.
    Without labels every score is 0.5.
    """
    held_out = F.coalesce(fold(documents["doc_id"], FOLDS) == HELD, F.lit(False))
    scored = documents.select(
        documents["doc_id"].cast("long").alias("doc_id"),
        held_out.alias("held_out"),
        quality_score(documents, labels, fit_rows).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def good_documents(documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The documents, all columns, that are predicted to be of label 1."""
    return documents.filter(quality_score(documents, labels, fit_rows) >= THRESHOLD)
