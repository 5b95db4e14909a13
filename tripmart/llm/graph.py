"""Approximate nearest neighbours by inner product, on robust-pruned directed graphs."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import ship
from tripmart.llm.segments import finite
from tripmart.llm.tables import Stages

K, QUERY_STEP = 20, 20
#: Edges of a node; nodes that a search keeps while building and while answering; nodes gone on from at once.
DEGREE, BUILD_BEAM, BEAM, WIDTH = 28, 48, 96, 4
#: An edge is left out if a kept one leads so many times nearer to its end.
RELAXED = 1.2
#: Vectors of a shard, about. Small tables still get some shards, of so many vectors.
SHARD, FEW, SHARDS = 1 << 16, 2048, 8
#: Rows that a task looks through for repeated ones, queries of a block, cells of the tables of what searches have seen.
FLUSH, BLOCK, SEEN = 1 << 15, 1024, 1 << 25
SEED = 13


def nearest(
    embeddings: DataFrame,
    k: int = K,
    query_step: int = QUERY_STEP,
    degree: int = DEGREE,
    build_beam: int = BUILD_BEAM,
    beam: int = BEAM,
    relaxed: float = RELAXED,
    shard_rows: int = SHARD,
) -> DataFrame:
    """For every `query_step`-th id, about the `k` other rows with the largest inner product.

    Vectors are dealt by a hash into shards of about `shard_rows`. A task builds
    the graph of a shard: greedy searches from a middle vector propose neighbours
    of each vector, and pruning goes through them from the nearest on and leaves
    out those to which a kept one is `relaxed` times nearer, so that kept edges
    lead in different directions. Edges go both ways and are pruned again where
    there are more than `degree`. Two passes; every vector is indexed. For that,
    vectors get a further component that makes all of a shard equally long, so
    that the nearest one has the largest inner product.

    Graphs are staged, a row for each shard. Queries, in blocks, meet every
    shard; a search keeps the best `beam` vectors seen and goes on from those not
    yet gone on from until none is left. What it ends with is scored in double
    precision on the original vectors, and the best of all shards are returned.

    Returns `query_id, rank, vec_id, score`, ties to the smaller `vec_id`.

    Vectors that are null, empty or zero, or hold null or non-finite components,
    and null ids take no part. Equal vectors are one node with all its ids, of
    which only the `k` + 1 smallest can be among the best. Rows that repeat id
    and vector count once; rows with the query's id are its own, not candidates,
    and with other vectors queries of their own. Vectors of another length than
    the query's are no candidates. An empty table gives no rows.
    """
    spark = embeddings.sparkSession
    ship(spark)
    vector = F.transform(embeddings["embedding"], lambda x: x.cast("double"))
    usable = finite(vector) & F.exists(vector, lambda x: x != 0) & embeddings["vec_id"].isNotNull()
    rows = embeddings.filter(usable).select(embeddings["vec_id"].cast("long").alias("vec_id"), vector.alias("vector"))
    n = rows.count()
    shards = max(-(-n // shard_rows), min(SHARDS, -(-n // FEW)), 1)
    kind = "dim int, shard int, ids binary, vectors binary"
    stages = Stages(spark)
    graphs = stages.stage(
        rows.mapInArrow(lambda batches: _dealt(batches, shards), kind)
        .groupBy("dim", "shard")
        .applyInArrow(lambda group: _graph_row(group, degree, build_beam, relaxed, k + 1), _GRAPH)
    )
    asked = rows.filter(F.col("vec_id") % query_step == 0).distinct().mapInArrow(lambda batches: _dealt(batches, 0), kind)
    asked = asked.select("dim", "ids", "vectors", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    met = graphs.join(asked, ["dim", "shard"])
    best = met.mapInArrow(
        lambda batches: _answers(batches, k, beam), "query_id long, query_key long, vec_id long, score double"
    )
    order = [F.col("score").desc(), F.col("vec_id")]
    rank = F.row_number().over(Window.partitionBy("query_id", "query_key").orderBy(*order))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


_NODES = ("base", "starts", "vec_ids", "edges", "entries")
_GRAPH = "dim int, shard int, nodes int, narrow boolean, " + ", ".join(f"{c} binary" for c in _NODES)


def _dealt(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """Rows of one length packed by shard, without those that repeat; blocks in any order if there are no shards."""
    held: dict[int, dict[bytes, int]] = {}
    size = 0

    def packed() -> Iterator[pa.RecordBatch]:
        for dim, rows in held.items():
            dealt: dict[int, list[bytes]] = {}
            for i, (row, key) in enumerate(rows.items()):
                dealt.setdefault(key % shards if shards else -1 - i // BLOCK, []).append(row)
            for shard, own in dealt.items():
                table = np.frombuffer(b"".join(own), np.uint8).reshape(len(own), 8 + 8 * dim)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([dim], pa.int32()),
                        pa.array([shard], pa.int32()),
                        pa.array([table[:, :8].tobytes()], pa.binary()),
                        pa.array([table[:, 8:].tobytes()], pa.binary()),
                    ],
                    names=["dim", "shard", "ids", "vectors"],
                )

    for batch in batches:
        lists = batch.column(1)
        ends = lists.offsets.to_numpy()
        flat = lists.values.to_numpy(zero_copy_only=False).astype("<f8") + 0.0  # no negative zeros
        for i, vec_id in enumerate(batch.column(0).to_numpy().astype("<i8")):
            row = vec_id.tobytes() + flat[ends[i] : ends[i + 1]].tobytes()
            own = held.setdefault(int(ends[i + 1] - ends[i]), {})
            if row not in own:
                own[row] = xxhash.xxh3_64_intdigest(row)
                size += 1
        if size >= FLUSH:
            yield from packed()
            held, size = {}, 0
    yield from packed()


def _table(data: list[bytes], kind: str, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(data), kind).reshape(-1, dim)


def _graph_row(group: pa.Table, degree: int, beam: int, relaxed: float, most: int) -> pa.Table:
    """The graph of a shard as one row: distinct vectors, their least ids, edges and where searches begin."""
    dim, shard = group.column("dim")[0].as_py(), group.column("shard")[0].as_py()
    ids = np.frombuffer(b"".join(group.column("ids").to_pylist()), "<i8")
    vectors = _table(group.column("vectors").to_pylist(), "<f8", dim)
    order = np.lexsort((ids, *vectors.T))
    ids, vectors = ids[order], vectors[order]
    other = np.ones(len(ids), bool)
    other[1:] = (vectors[1:] != vectors[:-1]).any(axis=1)
    node = np.cumsum(other) - 1
    again = np.zeros(len(ids), bool)
    again[1:] = ~other[1:] & (ids[1:] == ids[:-1])  # the same row from several tasks
    ids, node = ids[~again], node[~again]
    first = np.flatnonzero(np.diff(node, prepend=-1))
    kept = np.arange(len(ids)) - first[node] < most
    starts = np.concatenate([[0], np.cumsum(np.bincount(node[kept]))])
    base = vectors[other]
    narrow = base.astype("<f4")
    is_narrow = bool((narrow == base).all())
    graph = Graph.built(narrow, degree, beam, relaxed)
    values = {
        "base": (narrow if is_narrow else base).tobytes(),
        "starts": starts.astype("<i8").tobytes(),
        "vec_ids": ids[kept].astype("<i8").tobytes(),
        "edges": graph.edges.astype("<i4").tobytes(),
        "entries": graph.entries.astype("<i4").tobytes(),
    }
    head = {"dim": pa.array([dim], pa.int32()), "shard": pa.array([shard], pa.int32()), "nodes": pa.array([len(base)], pa.int32())}
    head["narrow"] = pa.array([is_narrow])
    return pa.table({**head, **{c: pa.array([v], pa.binary()) for c, v in values.items()}})


@dataclass
class Graph:
    """Vectors, the edges of each (-1: none), and the nodes at which searches begin."""

    vectors: np.ndarray
    edges: np.ndarray
    entries: np.ndarray

    @classmethod
    def built(cls, vectors: np.ndarray, degree: int, beam: int, relaxed: float) -> Graph:
        """The graph of distinct vectors, by two passes of searches and pruning, in a fixed random order."""
        n = len(vectors)
        squares = np.einsum("ij,ij->i", vectors, vectors)
        longer = np.sqrt(np.maximum(squares.max() - squares, 0))[:, None]
        level = np.concatenate([vectors, longer], axis=1).astype(np.float32)  # all of one length
        middle = int(np.argmax(level @ level.mean(axis=0)))
        graph = cls(level, np.full((n, degree), -1, np.int32), np.array([middle]))
        order = np.random.default_rng(SEED).permutation(n)
        order = np.concatenate([[middle], order[order != middle]])
        for strict in (1.0, relaxed):
            at, step = 1, 1
            while at < n:
                graph._insert(order[at : at + step], beam, strict)
                at += step
                step = min(max(1, at if strict == 1 else n), 1024, max(64, SEEN // n))
        graph._open_up()
        graph.vectors = vectors
        return graph

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each query the best nodes seen (-1: no more), nearest first, their inner products, and nodes gone on from.

        All queries take their steps together, from the `WIDTH` best nodes at
        once. The search of a query ends when its best nodes have all been gone on from.
        """
        m, width = len(queries), self.edges.shape[1]
        seen = np.zeros((m, len(self.vectors)), bool)
        entries = self.entries[:beam]
        seen[:, entries] = True
        ids = np.full((m, beam), -1, np.int64)
        near = np.full((m, beam), -np.inf, np.float32)
        ids[:, : len(entries)] = entries
        near[:, : len(entries)] = queries @ self.vectors[entries].T
        done = ids < 0
        path = [np.tile(entries, (m, 1))]
        active = np.arange(m)
        while len(active):
            i, d = ids[active], done[active]
            picked = np.argsort(d, axis=1, kind="stable")[:, :WIDTH]
            fresh = ~np.take_along_axis(d, picked, axis=1)
            nodes = np.where(fresh, np.take_along_axis(i, picked, axis=1), -1)
            np.put_along_axis(d, picked, True, axis=1)
            gone = np.full((m, nodes.shape[1]), -1, np.int64)
            gone[active] = nodes
            path.append(gone)
            found = np.full((len(active), nodes.shape[1] * width), -1, np.int64)
            for w in range(nodes.shape[1]):  # edges of one node differ, those of two may not
                row = np.flatnonzero(nodes[:, w] >= 0)
                edges = self.edges[nodes[row, w]].astype(np.int64)
                new = (edges >= 0) & ~seen[active[row][:, None], edges]
                found[row, w * width : (w + 1) * width] = np.where(new, edges, -1)
                r, c = np.nonzero(new)
                seen[active[row[r]], edges[r, c]] = True
            r, c = np.nonzero(found >= 0)
            inner = np.full(found.shape, -np.inf, np.float32)
            inner[r, c] = np.einsum("ij,ij->i", self.vectors[found[r, c]], queries[active[r]])
            all_near = np.concatenate([near[active], inner], axis=1)
            best = np.argsort(-all_near, axis=1, kind="stable")[:, :beam]
            near[active] = np.take_along_axis(all_near, best, axis=1)
            ids[active] = np.take_along_axis(np.concatenate([i, found], axis=1), best, axis=1)
            d = np.take_along_axis(np.concatenate([d, found < 0], axis=1), best, axis=1) | (ids[active] < 0)
            done[active] = d
            active = active[~d.all(axis=1)]
        return ids, near, np.concatenate(path, axis=1)

    def _insert(self, nodes: np.ndarray, beam: int, relaxed: float) -> None:
        """Edges from and to some nodes."""
        ids, _, path = self.search(self.vectors[nodes], beam)
        proposed = np.concatenate([ids, path[:, : 2 * beam], self.edges[nodes].astype(np.int64)], axis=1)
        self.edges[nodes] = self._pruned(nodes, proposed, relaxed)
        out = self.edges[nodes]
        row, column = np.nonzero(out >= 0)
        ends, back = out[row, column].astype(np.int64), nodes[row]
        known = (self.edges[ends] == back[:, None]).any(axis=1)
        ends, back = ends[~known], back[~known]
        order = np.argsort(ends, kind="stable")
        ends, back = ends[order], back[order]
        targets, first, times = np.unique(ends, return_index=True, return_counts=True)
        held = self.edges[targets].astype(np.int64)
        free = (held < 0).sum(axis=1)
        fits = times <= free
        place = np.arange(len(ends)) - np.repeat(first, times)
        for some, room in ((fits, int(times[fits].max(initial=0))), (~fits, int(times[~fits].max(initial=0)))):
            own = np.flatnonzero(some)
            for at in range(0, len(own), 256):
                part = own[at : at + 256]
                wide = np.full((len(part), room), -1, np.int64)
                slot = np.full(len(targets), -1)
                slot[part] = np.arange(len(part))
                mine = slot[np.repeat(np.arange(len(targets)), times)]
                wide[mine[mine >= 0], place[mine >= 0]] = back[mine >= 0]
                both = np.concatenate([held[part], wide], axis=1)
                if some is fits:
                    kept = np.argsort(both < 0, axis=1, kind="stable")[:, : self.edges.shape[1]]
                    self.edges[targets[part]] = np.take_along_axis(both, kept, axis=1)
                else:
                    self.edges[targets[part]] = self._pruned(targets[part], both, relaxed)

    def _pruned(self, nodes: np.ndarray, proposed: np.ndarray, relaxed: float) -> np.ndarray:
        """Of the nodes proposed for each, at most `degree`: the nearest, then those that no kept one is much nearer to."""
        degree = self.edges.shape[1]
        result = np.full((len(nodes), degree), -1, np.int32)
        for at in range(0, len(nodes), 128):
            own, some = nodes[at : at + 128], np.sort(proposed[at : at + 128], axis=1)
            some[:, 1:][some[:, 1:] == some[:, :-1]] = -1
            some[some == own[:, None]] = -1
            vectors = self.vectors[some]
            far = ((vectors - self.vectors[own][:, None]) ** 2).sum(axis=2)
            far[some < 0] = np.inf
            order = np.argsort(far, axis=1, kind="stable")[:, : 4 * degree]
            order = order[:, : max(1, int(np.isfinite(far).sum(axis=1).max()))]
            some, far = np.take_along_axis(some, order, axis=1), np.take_along_axis(far, order, axis=1)
            vectors = np.take_along_axis(vectors, order[:, :, None], axis=1)
            square = np.einsum("ijk,ijk->ij", vectors, vectors)
            apart = square[:, :, None] + square[:, None] - 2 * (vectors @ vectors.transpose(0, 2, 1))
            open_ = np.isfinite(far)
            rows = np.arange(len(own))
            for slot in range(degree):
                there = open_.any(axis=1)
                if not there.any():
                    break
                first = open_.argmax(axis=1)
                result[at + rows[there], slot] = some[rows, first][there]
                open_ &= relaxed**2 * apart[rows, first] > far
                open_[rows, first] = False
        return result

    def _open_up(self) -> None:
        """Let searches also begin at nodes that no path from the other beginnings leads to."""
        reached = np.zeros(len(self.edges), bool)
        entries, wave = list(self.entries), np.array(self.entries)
        while True:
            reached[wave] = True
            while len(wave):
                ends = np.unique(self.edges[wave])
                wave = ends[(ends >= 0) & ~reached[ends]]
                reached[wave] = True
            if reached.all():
                break
            wave = np.flatnonzero(~reached)[:1]
            entries.append(wave[0])
        self.entries = np.array(entries)


def _answers(batches: Iterator[pa.RecordBatch], k: int, beam: int) -> Iterator[pa.RecordBatch]:
    """The best rows of a shard for every query of a block."""
    for batch in batches:
        for row in batch.to_pylist():
            dim, n = row["dim"], row["nodes"]
            base = np.frombuffer(row["base"], "<f4" if row["narrow"] else "<f8").reshape(n, dim)
            starts, ids = np.frombuffer(row["starts"], "<i8"), np.frombuffer(row["vec_ids"], "<i8")
            edges = np.frombuffer(row["edges"], "<i4").reshape(n, -1)
            graph = Graph(base.astype(np.float32, copy=False), edges, np.frombuffer(row["entries"], "<i4"))
            query_ids = np.frombuffer(row["ids"], "<i8")
            queries = np.frombuffer(row["vectors"], "<f8").reshape(-1, dim)
            some = max(16, SEEN // n)
            for at in range(0, len(queries), some):
                own_ids, own = query_ids[at : at + some], queries[at : at + some]
                found, _, _ = graph.search(own.astype(np.float32), max(beam, k + 1))
                query, place = np.nonzero(found >= 0)
                node = found[query, place]
                score = inner_products(own[query], base[node].astype(np.float64))
                times = np.diff(starts)[node]
                last = np.cumsum(times)
                vec_id = ids[np.repeat(starts[node] - (last - times), times) + np.arange(times.sum())]
                query, score = np.repeat(query, times), np.repeat(score, times)
                other = vec_id != own_ids[query]
                query, score, vec_id = query[other], score[other], vec_id[other]
                order = np.lexsort((vec_id, -score, query))
                query, score, vec_id = query[order], score[order], vec_id[order]
                first = np.searchsorted(query, query)
                best = np.arange(len(query)) - first < k
                query = query[best]
                keys = np.array([xxhash.xxh3_64_intdigest(v.tobytes()) for v in own], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own_ids[query]), pa.array(keys[query]), pa.array(vec_id[best]), pa.array(score[best])],
                    names=["query_id", "query_key", "vec_id", "score"],
                )


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision, added up from the first component on, so equal rows score alike."""
    total = np.zeros(len(a))
    for i in range(a.shape[1]):
        total += a[:, i] * b[:, i]
    return total
