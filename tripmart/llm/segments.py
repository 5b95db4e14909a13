"""Exact top-k inner products, pruned by segment statistics from coarse to fine."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import ship

SCALE = 256
K = 5
QUERY_STEP = 50
#: Vectors in a packed block, fewer if they are longer than 64 components.
BLOCK = 4096
#: Candidates that a task goes through, and blocks of queries that it does so with.
CELL, ASKED = 1 << 21, 2
#: Small tables are dealt to so many tasks, unless that leaves a task fewer candidates than these.
TASKS, LEAST = 64, 8192
#: Blocks of queries that a task keeps, each with about a kilobyte for a query.
HELD = 32
#: Candidates of a first block that are scored at once, so that there is something to prune by.
SEED = 1024
#: Queries and candidates whose bounds are in memory at once: a megabyte, which stays in a core's cache.
TILE, WIDE = 256, 1024
#: Share of a block's candidates that is gone on with pair by pair; if more are left, the next bound is taken for all.
FEW = 0.02
#: Candidates on which levels are tried, and the number of blocks after which that is done again.
TRIED, AGAIN = 256, 8
#: Sums of products below these are exact in floats and doubles.
EXACT_SINGLE, EXACT = 2**24, 2**53
#: Vectors below this norm have their statistics in floats.
SHORT = 1e15


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def top_k(
    embeddings: DataFrame, k: int = K, query_step: int = QUERY_STEP, scale: int = SCALE
) -> DataFrame:
    """For every `query_step`-th id, the `k` other rows with the highest integer inner product.

    Components become floor(scale * x). With a vector cut into segments of m
    components, mean a and deviation s, an inner product is at most the sum over
    segments of m * (a a' + s s'), which is a lower bound of the distance put in
    other words. Bounds are taken over 1, 2, 4 ... segments, and a pair goes on
    to the next only while its bound reaches the query's k-th best score so far;
    survivors get their exact score. Ties go to the smaller `vec_id`.

    Rows are packed into blocks, in the narrowest integers that hold them, and
    blocks are dealt evenly. A task of the product of both sides goes through
    some candidates with some blocks of queries in memory, and reads both from
    one copy of each side; no row is repeated in an exchange. A query's best rows
    of all tasks meet in a window. There is no group by vector, so copies do no harm.

    Returns `query_id, rank, vec_id, score`.

    Null vectors, vectors with null or non-finite components, and rows with a
    null id take no part. Rows with the query's id are its own, not candidates;
    equal rows are one query, and rows of one id with different vectors are
    queries of their own. Vectors of other length than the query's are no
    candidates. Scores beyond 64 bits are not defined. An empty table gives no
    rows.
    """
    ship(embeddings.sparkSession)
    vec_id = embeddings["vec_id"].cast("long").alias("vec_id")
    vector = F.transform(embeddings["embedding"], lambda x: F.floor(x.cast("double") * scale)).alias("vector")
    usable = finite(F.transform(embeddings["embedding"], lambda x: x.cast("double"))) & embeddings["vec_id"].isNotNull()
    own = vec_id % query_step == 0
    # With rows that are not usable: these numbers only say how work is dealt.
    n, m = embeddings.agg(F.count(vec_id), F.count_if(own)).first()
    rows = embeddings.filter(usable).select(vec_id, vector)
    queries = embeddings.filter(own).filter(usable).select(vec_id, vector)
    queries = queries.distinct().coalesce(-(-m // (8 * BLOCK)) or 1)
    queries = queries.sortWithinPartitions("vec_id", "vector")  # the same blocks however often a task is repeated
    packed = "dim int, block long, ids binary, vectors binary"
    across = -(-m // (ASKED * BLOCK)) or 1
    down = max(-(-n // CELL), min(-(-TASKS // across), -(-n // LEAST)), 1)
    left = rows.mapInArrow(_pack, packed).repartition(down)
    right = queries.mapInArrow(_pack, packed).repartition(across).select(
        F.col("dim").alias("q_dim"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors")
    )
    equal = (F.col("dim") <= F.col("q_dim")) & (F.col("dim") >= F.col("q_dim"))  # not a key that rows are dealt by
    best = left.hint("shuffle_replicate_nl").join(right, equal).mapInArrow(
        lambda batches: _score(batches, k), "query_id long, query_key long, vec_id long, score long"
    )
    rank = F.row_number().over(
        Window.partitionBy("query_id", "query_key").orderBy(F.col("score").desc(), F.col("vec_id"))
    )
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of at most BLOCK vectors of one length."""
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        lists = batch.column(1)
        lengths = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
        for dim in np.unique(lengths):
            own = np.flatnonzero(lengths == dim)
            most = max(1, BLOCK * 64 // max(int(dim), 64))
            for at in range(0, len(own), most):
                part = own[at : at + most]
                block = flat[starts[part][:, None] + np.arange(dim)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([dim], pa.int32()),
                        pa.array([int(ids[part[0]])], pa.int64()),
                        pa.array([ids[part].astype("<i8").tobytes()], pa.binary()),
                        pa.array([block.astype(_narrowest(block)).tobytes()], pa.binary()),
                    ],
                    names=["dim", "block", "ids", "vectors"],
                )


def _narrowest(block: np.ndarray) -> str:
    """The type of least width that holds all components."""
    low, high = block.min(initial=0), block.max(initial=0)
    return next(kind for kind in ("<i2", "<i4", "<i8") if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max)


def _statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """sqrt(m) times mean and deviation of every segment: a dot product of two such rows is the bound."""
    cuts = np.array_split(np.arange(vectors.shape[1]), segments)
    sizes = np.array([len(c) for c in cuts])
    own = np.repeat(np.arange(segments), sizes)
    shares = np.zeros((len(own), segments))
    shares[np.arange(len(own)), own] = 1 / sizes[own]
    means = vectors @ shares
    deviations = np.sqrt((vectors - means[:, own]) ** 2 @ shares)
    return np.concatenate([means, deviations], axis=1) * np.sqrt(np.tile(sizes, 2))


def _places(found: np.ndarray) -> np.ndarray:
    """Where a matrix of truth values, most of them false, is true, as places in its rows put behind each other."""
    flat = found.ravel()
    if flat.size % 8:
        return np.flatnonzero(flat)
    eights = np.flatnonzero(flat.view(np.uint64))
    some, place = np.nonzero(flat.reshape(-1, 8)[eights])
    return eights[some] * 8 + place


def _levels(dim: int) -> list[int]:
    """Numbers of segments, up to segments of four components."""
    levels, segments = [], 1
    while segments <= max(1, dim // 4):
        levels.append(segments)
        segments *= 2
    return levels if dim else []


class _Block:
    """Vectors of one length, packed by `_pack`."""

    def __init__(self, ids: bytes, vectors: bytes, dim: int) -> None:
        self.ids = np.frombuffer(ids, "<i8")
        width = len(vectors) // (len(self.ids) * dim) if dim else 8
        self.vectors = np.frombuffer(vectors, f"<i{width}").reshape(len(self.ids), dim)
        self.segments = _levels(dim)
        self.kinds: dict[type, np.ndarray] = {}
        self.statistics: dict[int, np.ndarray] = {}
        self.norms = np.linalg.norm(self.as_kind(np.float64), axis=1)
        self.longest = self.norms.max(initial=0)

    def as_kind(self, kind: type) -> np.ndarray:
        if kind not in self.kinds:
            self.kinds[kind] = self.vectors.astype(kind)
        return self.kinds[kind]

    def tried(self, level: int, last: int) -> np.ndarray:
        """Statistics of the last vectors at a level."""
        found = _statistics(self.as_kind(np.float64)[-last:], self.segments[level])
        return found.astype(np.float32) if self.longest < SHORT else found

    def level(self, level: int) -> np.ndarray:
        """Statistics of all vectors at a level."""
        if level not in self.statistics:
            self.statistics[level] = self.tried(level, len(self.ids))
        return self.statistics[level]


@lru_cache
def _scratch(kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    return np.empty(TILE * WIDE, kind), np.empty(TILE * WIDE, bool)


def _products(a: np.ndarray, b: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inner products of all rows of both, TILE and WIDE at most, and which reach `least`; the next call overwrites them."""
    values, reach = (x[: len(a) * len(b)].reshape(len(a), len(b)) for x in _scratch(np.result_type(a, b)))
    np.matmul(a, b.T, out=values)
    return values, np.greater_equal(values, least[:, None], out=reach)


class _Best:
    """The best rows so far of a block of queries.

    A query begins at the first level that leaves it few of some candidates of a
    block, or with exact scores if none does; that is tried on every eighth block.
    """

    def __init__(self, asked: _Block, k: int) -> None:
        self.asked, self.ids, self.k = asked, asked.ids, k
        n = len(asked.ids)
        self.top_ids, self.top_scores = np.zeros((n, k), np.int64), np.zeros((n, k), np.int64)
        self.held, self.least = np.zeros(n, np.int64), np.full(n, -np.inf)
        self.start, self.seen = np.zeros(n, np.int64), 0

    def see(self, block: _Block) -> None:
        at, todo, levels = 0, np.arange(len(self.ids)), len(block.segments)
        if (self.held < self.k).any():
            at = min(SEED, len(block.ids))
            self.score_all(block, todo, 0, at)
        if self.seen % AGAIN == 0:
            self.start[:] = levels
            for level in reversed(range(levels)):
                own, theirs = self.asked.level(level), block.tried(level, TRIED)
                reach = own @ theirs.T >= self.need(block, level)[:, None]
                self.start[np.count_nonzero(reach, axis=1) <= FEW * len(theirs)] = level
        self.seen += 1
        for level in range(levels):
            some = todo[self.start[todo] <= level]
            if len(some) and at < len(block.ids):
                q, c, crowded = self.pairs(block, some, at, level)
                todo = np.setdiff1d(todo, some[~crowded[some]], assume_unique=True)
                self.score_pairs(block, q, c, level + 1)
        self.score_all(block, todo, at, len(block.ids))

    def pairs(self, block: _Block, some: np.ndarray, at: int, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of queries and candidates whose bound reaches far enough, and the queries that have too many, without theirs."""
        own, theirs, need = self.asked.level(level), block.level(level), self.need(block, level)
        crowded, found = np.zeros(len(self.ids), bool), [(np.empty(0, np.int64),) * 2]
        for i in range(0, len(some), TILE):
            rows = some[i : i + TILE]
            a, least = own[rows], need[rows]
            for j in range(at, len(block.ids), WIDE):
                _, reach = _products(a, theirs[j : j + WIDE], least)
                if np.count_nonzero(reach) > FEW * reach.size:
                    many = np.count_nonzero(reach, axis=1) > 4 * FEW * reach.shape[1]
                    crowded[rows[many]] = True
                    reach[many] = False
                place, c = np.divmod(_places(reach), reach.shape[1])
                found.append((rows[place], j + c))
        q, c = (np.concatenate(x) for x in zip(*found, strict=True))
        crowded |= np.bincount(q, minlength=len(self.ids)) > FEW * (len(block.ids) - at)
        return q[~crowded[q]], c[~crowded[q]], crowded

    def need(self, block: _Block, level: int) -> np.ndarray:
        """What a bound must reach, less what rounding may take from it."""
        short = [x.longest < SHORT for x in (self.asked, block)]
        slack = (2 * block.segments[level] + 4) * 2.0**-23 if any(short) else 1e-9
        lowest = self.least - slack * self.asked.norms * block.longest - 1e-9
        return np.nextafter(lowest.astype(np.float32), np.float32(-np.inf)) if all(short) else lowest

    def exact_kind(self, block: _Block) -> type:
        """The fastest type in which products of these vectors are exact."""
        limit = 1.001 * self.asked.longest * block.longest
        return np.float32 if limit < EXACT_SINGLE else np.float64 if limit < EXACT else np.int64

    def score_all(self, block: _Block, some: np.ndarray, at: int, end: int) -> None:
        """Take the best of all candidates from `at` to `end` for some queries."""
        kind = self.exact_kind(block)
        own, theirs = self.asked.as_kind(kind), block.as_kind(kind)
        for i in range(0, len(some), TILE):
            rows = some[i : i + TILE]
            a = own[rows]
            for j in range(at, end, WIDE):
                ids = block.ids[j : min(j + WIDE, end)]
                least = self.least[rows]
                scores, reach = _products(a, theirs[j : j + len(ids)], least if kind == np.int64 else least.astype(kind))
                fresh = np.flatnonzero(np.isneginf(least))
                if len(fresh) and len(ids) >= self.k:
                    others = scores[fresh]
                    others[ids == self.ids[rows[fresh]][:, None]] = -np.inf if kind != np.int64 else np.iinfo(kind).min
                    reach[fresh] = others >= np.partition(others, -self.k, axis=1)[:, -self.k, None]
                pairs = _places(reach)
                place, c = np.divmod(pairs, len(ids))
                other = ids[c] != self.ids[rows[place]]
                self.take(rows[place[other]], ids[c[other]], scores.ravel()[pairs[other]].astype(np.int64))

    def score_pairs(self, block: _Block, q: np.ndarray, c: np.ndarray, level: int) -> None:
        """Take the best of the pairs (q[i], c[i]), which have bounds of finer levels first if they are many."""
        dots = lambda a, b, q, c: np.concatenate(
            [np.einsum("ij,ij->i", a[q[i : i + 8192]], b[c[i : i + 8192]]) for i in range(0, len(q), 8192)]
        )
        for finer in range(level, len(block.segments)):
            if len(q) > 4 * len(block.ids):
                kept = dots(self.asked.level(finer), block.level(finer), q, c) >= self.need(block, finer)[q]
                q, c = q[kept], c[kept]
        if len(q):
            kind = self.exact_kind(block)
            scores = dots(self.asked.as_kind(kind), block.as_kind(kind), q, c).astype(np.int64)
            other = (scores >= self.least[q]) & (block.ids[c] != self.ids[q])
            self.take(q[other], block.ids[c[other]], scores[other])

    def take(self, q: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Merge rows into the best of their queries."""
        last, least = self.top_ids[q, self.k - 1], self.top_scores[q, self.k - 1]
        better = (self.held[q] < self.k) | (scores > least) | (scores == least) & (ids < last)
        q, ids, scores = q[better], ids[better], scores[better]
        if not len(q):
            return
        touched = np.unique(q)
        row, place = np.nonzero(np.arange(self.k) < self.held[touched][:, None])
        q = np.concatenate([q, touched[row]])
        ids = np.concatenate([ids, self.top_ids[touched[row], place]])
        scores = np.concatenate([scores, self.top_scores[touched[row], place]])
        order = np.lexsort((ids, -scores, q))
        q, ids, scores = q[order], ids[order], scores[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        best = rank < self.k
        q, rank = q[best], rank[best]
        self.top_ids[q, rank], self.top_scores[q, rank] = ids[best], scores[best]
        np.maximum.at(self.held, q, rank + 1)
        full = touched[self.held[touched] == self.k]
        self.least[full] = self.top_scores[full, self.k - 1]

    def rows(self) -> pa.RecordBatch:
        row, place = np.nonzero(np.arange(self.k) < self.held[:, None])
        columns = (self.ids[row], _keys(self.asked.vectors)[row], self.top_ids[row, place], self.top_scores[row, place])
        return pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in columns], names=["query_id", "query_key", "vec_id", "score"]
        )


def _score(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The best rows of every block of queries that a task meets.

    A task keeps at most HELD blocks of queries. When it meets another, it gives
    out what it has for the one it met longest ago; if that comes back, it begins
    anew, and gives out more rows than it could have, never fewer. The block of
    candidates met last is kept too, as it meets all blocks of queries in turn.
    """
    best: dict[tuple[int, bytes, int], _Best] = {}
    met, block = None, None
    for batch in batches:
        columns = [batch.column(name) for name in ("dim", "ids", "vectors", "q_ids", "q_vectors")]
        for row in range(batch.num_rows):
            dim, ids, vectors, q_ids, q_vectors = (c[row].as_py() for c in columns)
            if met != (dim, ids, vectors):
                met, block = (dim, ids, vectors), _Block(ids, vectors, dim)
            key = (dim, q_ids, hash(q_vectors))
            held = best.pop(key, None)
            if held is None:
                held = _Best(_Block(q_ids, q_vectors, dim), k)
                if len(best) >= HELD:
                    yield best.pop(next(iter(best))).rows()
            best[key] = held  # the last one met stands last
            held.see(block)
    for found in best.values():
        yield found.rows()


def _keys(vectors: np.ndarray) -> np.ndarray:
    """Tell queries of one id apart."""
    weights = np.arange(1, vectors.shape[1] + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (vectors.astype(np.int64).view(np.uint64) * (weights | np.uint64(1))).sum(axis=1, dtype=np.uint64).view(np.int64)


SQL = """
WITH rows AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM rows q JOIN rows c ON len(q.v) = len(c.v) AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
