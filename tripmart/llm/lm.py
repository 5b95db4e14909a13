"""Language-model scores by deleted interpolation of n-gram estimates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import fold, ship, stage
from tripmart.llm.packed import (
    bucket_cuts,
    chunked,
    one_array,
    open_sorted,
    open_up,
    packed,
    sizes_for,
    split_words,
    squeeze,
    squeeze_sorted,
    unpacked,
    word_hashes,
)

FOLDS, HELD = 7, 2
ORDER = 2
#: One of so many training documents is deleted: its n-grams are the held-out counts.
DELETED = 8
#: Context counts are told apart by their binary logarithm, up to this.
LOGS = 32
ROUNDS, TOLERANCE = 12, 1e-4
#: No weight of the uniform share falls below this, so that no token is impossible.
FLOOR = 1e-6

END, BEGIN = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _joined(before: np.ndarray, token: np.ndarray, order: int) -> np.ndarray:
    """Hash of an n-gram from that of its beginning and its last token."""
    with np.errstate(over="ignore"):
        x = (before + np.uint64(order)) * MIX[0] ^ token
        x = (x ^ (x >> np.uint64(30))) * MIX[1]
        x = (x ^ (x >> np.uint64(27))) * MIX[2]
    return x ^ (x >> np.uint64(31))


def _grams(texts: pa.Array, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """For each length up to `order`, the n-gram that ends at each token; and where each document's tokens begin.

    Every document ends with the end token. What stands before its first token
    is a run of begin marks.
    """
    places, starts, words = split_words(texts, lower=True)
    n_documents = len(starts) - 1
    tokens = np.full(len(places) + n_documents, END, np.uint64)
    bounds = starts + np.arange(n_documents + 1)
    plain = np.ones(len(tokens), bool)
    plain[bounds[1:] - 1] = False
    tokens[plain] = word_hashes(words)[places]
    grams, begin = [tokens], np.array([BEGIN])
    for n in range(2, order + 1):
        before = np.empty_like(tokens)
        before[1:] = grams[-1][:-1]
        before[bounds[:-1]] = begin
        begin = _joined(begin, BEGIN, n)
        grams.append(_joined(before, tokens, n))
    return grams, bounds


def _bucket_of(counts: np.ndarray) -> np.ndarray:
    """Bucket of positive counts by binary logarithm."""
    return np.minimum(np.log2(np.maximum(counts, 1)).astype(np.int64), LOGS - 1)


def _estimates(
    counts: list[np.ndarray], contexts: list[np.ndarray], total: float, distinct: float
) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each token, and its maximum-likelihood estimates by order, from the uniform one (0) up.

    `counts[o]` is the count of the n-gram with o + 1 tokens, `contexts[o]` that
    of what stands before its last token. The longest context that was seen
    decides the bucket, with its own count.
    """
    n = len(counts[0])
    shares = np.zeros((n, len(counts) + 1))
    shares[:, 0] = 1 / (distinct + 1)
    shares[:, 1] = counts[0] / total if total else 0
    bucket = np.zeros(n, np.int64)
    for o in range(1, len(counts)):
        seen = contexts[o] > 0
        shares[seen, o + 1] = counts[o][seen] / contexts[o][seen]
        bucket[seen] = 1 + (o - 1) * LOGS + _bucket_of(contexts[o][seen])
    return bucket, shares


class _Counts:
    """The counts that came back to a chunk, put at its tokens."""

    def __init__(self, answers: pa.Table, texts: pa.Array, order: int, deleted: bool) -> None:
        grams, self.bounds = _grams(texts, order)
        self.first = self.bounds[:-1]
        self.grams = []
        rows = sorted(answers.to_pylist(), key=lambda r: (r["length"], r["bucket"]))
        for n in range(1, order + 1):
            own = [r for r in rows if r["length"] == n]
            known = np.concatenate([open_up(r["counts"], "<i8", r["n"]) for r in own])
            if deleted:
                known -= np.concatenate([open_up(r["deleted"], "<i8", r["n"]) for r in own])
            _, inverse = np.unique(grams[n - 1], return_inverse=True)
            self.grams.append(known[inverse])
        self.last_grams = grams[-1]

    def contexts(self, documents: int) -> list[np.ndarray]:
        """Count of what stands before each token, by length of the n-gram; begin marks stand before every document."""
        found = [np.zeros(0, np.int64)]
        for counts in self.grams[:-1]:
            before = np.empty_like(counts)
            before[1:] = counts[:-1]
            before[self.first] = documents
            found.append(before)
        return found


def score_documents(documents: DataFrame, order: int = ORDER) -> DataFrame:
    """log10 probability of every whole text under a model learnt from the training documents.

    Tokens are words, A to Z in lower case, and one end after each text. A
    token's probability mixes the maximum-likelihood estimates of the n-grams
    that end in it, of length 1 to `order`, and a uniform share over the known
    tokens and one unknown. The mixing weights are those of the bucket of the
    longest context seen, by its length and count. They are learned by
    expectation-maximisation: of the training documents every eighth is deleted,
    its n-grams are the held-out counts, and estimates come from the rest. The
    scores use estimates from all training documents.

    Training documents are those whose crc32(doc_id) modulo 7 is not 2. Documents
    are dealt into chunks; a chunk asks for the counts of its distinct n-grams,
    buckets of n-grams add up what all chunks have and answer. A word that makes
    up a third of all text is one row of a chunk. Counts come from all documents.

    Returns `doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score`. `base_score` is the add-one unigram score.

    Null text counts as empty: one token, the end. A null id is a training
    document. Repeated rows are documents of their own. Without training
    documents all tokens are unknown, and share one uniform probability. An
    empty table gives no rows.
    """
    ship(documents.sparkSession)
    chunks, buckets = sizes_for(documents)
    crc = F.coalesce(F.crc32(documents["doc_id"].cast("string")), F.lit(0))
    held_out = F.coalesce(fold(documents["doc_id"], FOLDS) == HELD, F.lit(False))
    gone = ~held_out & (F.floor(crc / FOLDS) % DELETED == 0)
    texts = chunked(documents, chunks, held_out=held_out, gone=gone)
    of_deleted = F.when(F.col("gone"), F.col("chunk") + chunks).otherwise(F.col("chunk"))
    texts = packed(texts.withColumn("chunk", of_deleted).drop("gone"))
    answers = stage(_answers(texts, order, chunks, buckets))
    sums = answers.filter("chunk < 0").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "distinct", "ends", "gone", "gone_ends")]
    )
    facts = sums.first().asDict()
    answers = answers.filter("chunk >= 0")
    weights = _learn(texts, answers, order, chunks, facts)
    total, distinct, ends = facts["n"], facts["distinct"], facts["ends"]

    def score(found: pa.Table, group: pa.Table) -> pa.Table:
        group = unpacked(group)
        counts = _Counts(found, one_array(group.column("text")), order, deleted=False)
        bucket, shares = _estimates(counts.grams, counts.contexts(ends), total, distinct)
        chance = np.einsum("ij,ij->i", weights[bucket], shares) if total else shares[:, 0]
        base = np.log10((counts.grams[0] + 1) / (total + distinct + 1))
        known = (counts.grams[0] > 0).astype(np.int64)
        add = lambda x: np.add.reduceat(x, counts.first) if len(counts.first) else x
        return pa.table(
            {
                "doc_id": group.column("doc_id"),
                "held_out": group.column("held_out"),
                "n_tokens": pa.array(np.diff(counts.bounds), pa.int64()),
                "n_known": pa.array(add(known), pa.int64()),
                "train_tokens": pa.array(np.full(len(counts.first), total), pa.int64()),
                "base_score": pa.array(add(base), pa.float64()),
                "score": pa.array(add(np.log10(chance)), pa.float64()),
            }
        )

    return (
        answers.groupBy("chunk")
        .cogroup(texts.groupBy("chunk"))
        .applyInArrow(
            score,
            "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
        )
    )


def _answers(texts: DataFrame, order: int, chunks: int, buckets: int) -> DataFrame:
    """Counts of every chunk's distinct n-grams in the training documents, and rows with what adds up to totals."""

    def ask(group: pa.Table) -> pa.Table:
        chunk, group = group.column("chunk")[0].as_py(), unpacked(group)
        grams, bounds = _grams(one_array(group.column("text")), order)
        trained = np.repeat(~group.column("held_out").to_numpy(), np.diff(bounds))
        rows: dict[str, list] = {k: [] for k in ("chunk", "bucket", "length", "n", "keys", "counts")}
        for length, keys in enumerate(grams, 1):
            distinct, inverse = np.unique(keys, return_inverse=True)
            counts = np.bincount(inverse, trained, len(distinct)).astype("<i8")
            cuts = bucket_cuts(distinct, buckets)
            for b in np.flatnonzero(np.diff(cuts)):
                own = slice(cuts[b], cuts[b + 1])
                values = (chunk, int(b), length, own.stop - own.start, squeeze_sorted(distinct[own]), squeeze(counts[own]))
                for k, v in zip(rows, values, strict=True):
                    rows[k].append(v)
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
        return pa.table({k: pa.array(v, kind) for (k, v), kind in zip(rows.items(), kinds, strict=True)})

    def answer(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        asked = [open_sorted(r["keys"], r["n"]) for r in rows]
        keys = np.unique(np.concatenate(asked))
        places = [np.searchsorted(keys, k) for k in asked]
        counts, deleted = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        for row, at in zip(rows, places, strict=True):
            own = open_up(row["counts"], "<i8", row["n"])
            counts[at] += own
            if row["chunk"] >= chunks:
                deleted[at] += own
        first = rows[0]["length"] == 1
        at_end = keys == END
        totals = {
            "n": int(counts.sum()),
            "distinct": int((counts > 0).sum()),
            "ends": int(counts[at_end].sum()),
            "gone": int(deleted.sum()),
            "gone_ends": int(deleted[at_end].sum()),
        }
        none = squeeze(np.zeros(0, "<i8"))
        out = [
            {
                "chunk": r["chunk"],
                "bucket": r["bucket"],
                "length": r["length"],
                "n": r["n"],
                "counts": squeeze(counts[at]),
                "deleted": squeeze(deleted[at]) if r["chunk"] >= chunks else none,
                **dict.fromkeys(("distinct", "ends", "gone", "gone_ends"), 0),
            }
            for r, at in zip(rows, places, strict=True)
        ]
        if first:
            out.append({"chunk": -1, "bucket": rows[0]["bucket"], "length": 1, "counts": none, "deleted": none, **totals})
        return pa.Table.from_pylist(out, schema=_ANSWER)

    asked = texts.groupBy("chunk").applyInArrow(
        ask, "chunk long, bucket int, length int, n long, keys binary, counts binary"
    )
    return asked.groupBy("length", "bucket").applyInArrow(
        answer,
        "chunk long, bucket int, length int, n long, counts binary, deleted binary,"
        " distinct long, ends long, gone long, gone_ends long",
    )


_ANSWER = pa.schema(
    [("chunk", pa.int64()), ("bucket", pa.int32()), ("length", pa.int32()), ("n", pa.int64())]
    + [("counts", pa.binary()), ("deleted", pa.binary())]
    + [(name, pa.int64()) for name in ("distinct", "ends", "gone", "gone_ends")]
)


def start_weights(order: int) -> np.ndarray:
    """Equal weights of the estimates that each bucket can have: rows are buckets, columns orders from uniform up."""
    weights = np.zeros((1 + (order - 1) * LOGS, order + 1))
    weights[0, :2] = 1 / 2
    for o in range(1, order):
        weights[1 + (o - 1) * LOGS : 1 + o * LOGS, : o + 2] = 1 / (o + 2)
    return weights


def _learn(texts: DataFrame, answers: DataFrame, order: int, chunks: int, facts: dict[str, int]) -> np.ndarray:
    """Weights by bucket, from the deleted documents.

    Their distinct n-grams, with held-out count and estimates, are staged once;
    each round is a pass over them of which every task returns sums by bucket.
    """
    total, ends = facts["n"] - facts["gone"], facts["ends"] - facts["gone_ends"]
    weights = start_weights(order)
    if not facts["gone"] or not total:
        return weights

    def estimates(found: pa.Table, group: pa.Table) -> pa.Table:
        group = unpacked(group)
        counts = _Counts(found, one_array(group.column("text")), order, deleted=True)
        bucket, shares = _estimates(counts.grams, counts.contexts(ends), total, facts["distinct"])
        _, first, times = np.unique(counts.last_grams, return_index=True, return_counts=True)
        return pa.table(
            {
                "n": pa.array([len(first)], pa.int64()),
                "buckets": pa.array([squeeze(bucket[first].astype("<u2"))], pa.binary()),
                "times": pa.array([squeeze(times.astype("<u4"))], pa.binary()),
                "shares": pa.array([shares[first].astype("<f4").tobytes()], pa.binary()),
            }
        )

    held = stage(
        answers.filter(F.col("chunk") >= chunks)
        .groupBy("chunk")
        .cogroup(texts.filter(F.col("chunk") >= chunks).groupBy("chunk"))
        .applyInArrow(estimates, "n long, buckets binary, times binary, shares binary")
    )
    before = None
    for _ in range(ROUNDS):
        sums, loss = _expect(held, weights)
        seen = sums.sum(axis=1) > 0
        weights[seen] = sums[seen] / sums[seen].sum(axis=1, keepdims=True)
        if before is not None and before - loss < TOLERANCE * abs(before):
            break
        before = loss
    weights[:, 0] = np.maximum(weights[:, 0], FLOOR)
    return weights / weights.sum(axis=1, keepdims=True)


def _expect(held: DataFrame, weights: np.ndarray) -> tuple[np.ndarray, float]:
    """Expected uses of each estimate by bucket, and the loss in nats."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, loss = np.zeros_like(weights), 0.0
        for batch in batches:
            for row in batch.to_pylist():
                bucket = open_up(row["buckets"], "<u2", row["n"])
                times = open_up(row["times"], "<u4", row["n"])
                shares = np.frombuffer(row["shares"], "<f4").reshape(row["n"], -1)
                parts = weights[bucket] * shares
                chance = parts.sum(axis=1)
                loss -= float(times @ np.log(chance))
                parts *= (times / chance)[:, None]
                for column in range(parts.shape[1]):
                    sums[:, column] += np.bincount(bucket, parts[:, column], len(sums))
        yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()]), pa.array([loss])], names=["sums", "loss"])

    rows = held.mapInArrow(own, "sums binary, loss double").collect()
    return sum(np.frombuffer(r["sums"]).reshape(weights.shape) for r in rows), sum(r["loss"] for r in rows)
