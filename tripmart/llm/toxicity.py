"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import fold, ship, text_of
from tripmart.llm.labelled import training_rows

FOLDS, HELD = 4, 2
THRESHOLD = 0.3
#: Labelled documents to learn from, about; all if there are fewer.
FIT_ROWS = 16_000
SEED = 6
#: Lengths of the n-grams, and bits of the hash that names one.
LENGTHS = (3, 4, 5, 6)
BITS = 20
#: A feature must be in so many documents; of these, so many that tell the labels apart best are kept.
MIN_DOCUMENTS = 5
FEATURES = 4096
SMOOTHING = 1.0
#: Strength of the penalty on weights, and most steps of the fit and inside each of them.
PENALTY, STEPS, INNER_STEPS = 1.0, 15, 25
PRIME = np.uint64(0x100000001B3)
SPREAD = np.uint64(0x9E3779B97F4A7C15)


#: Characters of a text that are looked at together.
SLICE = 1 << 20


def grams(text: str, kept: np.ndarray | None = None) -> np.ndarray:
    """The distinct hashes of all n-grams of a text's characters, A to Z in lower case, white space as one space.

    Given `kept`, a table of all hashes, only those of it. A long text is gone through in slices that overlap, so that a task holds some
    sixty bytes for each character of a slice, whatever the text's length.
    """
    words = b" ".join(text.encode().lower().split()).decode()
    data = np.frombuffer(f" {words} ".encode("utf-32-le"), np.uint32)
    if len(data) <= SLICE:
        found = _hashes(data)
        return np.unique(found if kept is None else found[kept[found]])
    seen = np.zeros(1 << BITS, bool)
    for at in range(0, len(data), SLICE):
        seen[_hashes(data[at : at + SLICE + max(LENGTHS) - 1])] = True
    return np.flatnonzero(seen if kept is None else seen & kept)


def _hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of the n-grams of some characters."""
    data = data.astype(np.uint64) + np.uint64(1)
    found, rolling = [], np.zeros(len(data), np.uint64)
    for n in range(1, max(LENGTHS) + 1):
        if len(data) < n:
            break
        rolling = rolling[: len(data) - n + 1] * PRIME + data[n - 1 :]
        if n in LENGTHS:
            found.append((rolling * SPREAD) >> np.uint64(64 - BITS))
    return np.concatenate(found).astype(np.int64) if found else np.empty(0, np.int64)


@dataclass
class Model:
    """Weight of each feature, 0 for those not kept, and the intercept."""

    weights: np.ndarray
    intercept: float

    def __post_init__(self) -> None:
        self.kept = self.weights != 0

    def score(self, text: str) -> float:
        """Probability of label 1: every feature counts once, however often it occurs."""
        features = grams(text, self.kept)
        return float(1 / (1 + np.exp(-(self.intercept + self.weights[features].sum()))))


def _counts(train: DataFrame) -> DataFrame:
    """Documents of either label that have a feature, for features in enough of them, with their log ratio.

    Tasks count their documents in arrays of fixed size and send them on in
    slices; a slice of all tasks is added up in one place.
    """
    size = 1 << BITS
    slices = 16

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        seen = np.zeros((2, size), np.int32)
        some = False
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen[label, grams(text)] += 1
                some = True
        if some:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(slices), pa.int32()),
                    pa.array([s.tobytes() for s in np.split(seen[0], slices)], pa.binary()),
                    pa.array([s.tobytes() for s in np.split(seen[1], slices)], pa.binary()),
                ],
                names=["slice", "zeros", "ones"],
            )

    def add(group: pa.Table) -> pa.Table:
        seen = np.zeros((2, size // slices), np.int64)
        for label, name in enumerate(("zeros", "ones")):
            for counts in group.column(name).to_pylist():
                seen[label] += np.frombuffer(counts, np.int32)
        kept = np.flatnonzero(seen.sum(axis=0) >= MIN_DOCUMENTS)
        first = group.column("slice")[0].as_py() * (size // slices)
        return pa.table({"feature": kept + first, "zeros": seen[0][kept], "ones": seen[1][kept]})

    sent = train.select("text", "label").mapInArrow(count, "slice int, zeros binary, ones binary")
    return sent.groupBy("slice").applyInArrow(add, "feature long, zeros long, ones long")


def fit(train: DataFrame) -> Model:
    """Learn from `text, label`.

    A feature's ratio is the log of its smoothed share of the documents with
    label 1 over that of those with label 0. Kept are the features for which the
    ratio times the difference of the shares is largest; a document's feature is
    worth its ratio if it occurs, and a logistic regression with a penalty on
    the weights is fitted to that. All
    that comes to the driver is bounded by the number of training documents and
    of kept features. Without rows of both labels every text gets the share of
    label 1, or one half without any rows.
    """
    train = train.repartition(8, "doc_id").persist()
    by_label = {r["label"]: r["n"] for r in train.groupBy("label").agg(F.count("*").alias("n")).collect()}
    zeros, ones = by_label.get(0, 0), by_label.get(1, 0)
    rate = (ones + 0.5) / (zeros + ones + 1)
    weights = np.zeros(1 << BITS, np.float64)
    if not zeros or not ones:
        train.unpersist()
        return Model(weights, float(np.log(rate / (1 - rate))))
    share = lambda c, n: (F.col(c) + SMOOTHING) / (n + 2 * SMOOTHING)
    ratio = F.log(share("ones", ones) / share("zeros", zeros))
    apart = ratio * (share("ones", ones) - share("zeros", zeros))
    best = _counts(train).select("feature", ratio.alias("ratio"), apart.alias("apart")).orderBy(F.desc("apart"), "feature")
    chosen = best.limit(FEATURES).toPandas()
    kept = np.zeros(1 << BITS, bool)
    kept[chosen["feature"]] = True

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [grams(t, kept).astype(np.int32).tobytes() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), batch.column(1)], names=["f", "label"])

    rows = train.select("text", "label").mapInArrow(own, "f binary, label int").toPandas()
    train.unpersist()
    ratios = np.zeros(1 << BITS, np.float64)
    ratios[chosen["feature"]] = chosen["ratio"]
    features = [np.frombuffer(f, np.int32) for f in rows["f"]]
    columns = np.concatenate(features).astype(np.int64)
    starts = np.cumsum([0, *map(len, features)])
    slope, intercept = _regress(columns, starts, ratios, rows["label"].to_numpy(np.float64))
    weights[chosen["feature"]] = (slope * ratios)[chosen["feature"]]
    return Model(weights, intercept)


def _regress(
    columns: np.ndarray, starts: np.ndarray, ratios: np.ndarray, labels: np.ndarray
) -> tuple[np.ndarray, float]:
    """Weights and intercept of a penalised logistic regression, by Newton steps solved with conjugate gradients."""
    used, columns = np.unique(columns, return_inverse=True)
    values, n, d = ratios[used][columns], len(labels), len(used)
    rows = np.repeat(np.arange(n), np.diff(starts))

    def forward(x: np.ndarray) -> np.ndarray:
        return np.bincount(rows, values * x[:-1][columns], n) + x[-1]

    def back(y: np.ndarray) -> np.ndarray:
        return np.append(np.bincount(columns, values * y[rows], d), y.sum())

    def loss(x: np.ndarray) -> float:
        margin = forward(x)
        return float(np.logaddexp(0, margin).sum() - labels @ margin + PENALTY / 2 * (x[:-1] @ x[:-1]))

    shrink = np.append(np.full(d, PENALTY), 1e-6)
    x = np.zeros(d + 1)
    best = loss(x)
    for _ in range(STEPS):
        chance = 1 / (1 + np.exp(-forward(x)))
        slope = back(chance - labels) + shrink * x
        weight = chance * (1 - chance)
        way = _conjugate(lambda v, w=weight: back(w * forward(v)) + shrink * v, -slope)
        length = 1.0
        while length > 1e-4 and loss(x + length * way) > loss(x):
            length /= 2
        now = loss(x + length * way)
        if not now < best - 1e-6 * abs(best):
            break
        x, best = x + length * way, now
    whole = np.zeros(len(ratios))
    whole[used] = x[:-1]
    return whole, float(x[-1])


def _conjugate(product: Callable[[np.ndarray], np.ndarray], target: np.ndarray) -> np.ndarray:
    """Solve product(x) = target, roughly."""
    x, left = np.zeros(len(target)), target.copy()
    way, size = left.copy(), left @ left
    goal = 1e-4 * size
    for _ in range(INNER_STEPS):
        if size <= goal:
            break
        moved = product(way)
        length = size / (way @ moved)
        x += length * way
        left -= length * moved
        size, before = left @ left, size
        way = left + size / before * way
    return x


def toxicity_score(documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Column:
    """A column of `documents`: the score of the whole text, by a model learnt now. See `score_toxicity`."""
    spark = documents.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(fit(training_rows(documents, labels, "toxic", FOLDS, HELD, fit_rows, SEED)))

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        own = shared.value
        return pa.array([own.score(t) for t in texts.to_pylist()], pa.float64())

    return score(text_of(documents))


def score_toxicity(documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Score every whole text; learn from labelled documents outside fold 2 of 4.

    `fit_rows` bounds the labelled documents that are learnt from (about so
    many, chosen by a hash of the id); all documents are scored.

    Returns `doc_id, held_out, score, predicted` (1 from a score of 0.3 on).

    Null text counts as empty and gets the intercept's score. A null id is not
    held out and has no label. Repeated rows are scored alike. Null labels are
    left out; of several labels of one id the larger counts. An empty table of
    labels gives every text the score 0.5.
    """
    held_out = F.coalesce(fold(documents["doc_id"], FOLDS) == HELD, F.lit(False))
    scored = documents.select(
        documents["doc_id"].cast("long").alias("doc_id"),
        held_out.alias("held_out"),
        toxicity_score(documents, labels, fit_rows).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def harmless_documents(documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The documents, all columns, that are not predicted to be toxic."""
    return documents.filter(toxicity_score(documents, labels, fit_rows) < THRESHOLD)
