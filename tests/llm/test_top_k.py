"""op10: how rows are dealt, and the same answers whichever way pairs go."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tripmart.llm import segments
from tripmart.llm.segments import top_k


def test_no_row_is_repeated_on_its_way_to_a_task(spark, monkeypatch):
    """However many cells there are, an exchange gets a block once: a task held all copies of a block of queries before."""
    monkeypatch.setattr(segments, "CELL", 8)
    df = spark.range(400).select(F.col("id").alias("vec_id"), F.array(F.rand(1), F.rand(2)).alias("embedding"))
    plan = top_k(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("CartesianProduct") == 1 and "RoundRobinPartitioning(50)" in plan
    assert "Generate" not in plan and "explode" not in plan and "Join" not in plan


def blocks(ids, vectors):
    rows = pa.RecordBatch.from_arrays([pa.array(ids), pa.array(vectors.tolist(), pa.list_(pa.int64()))], names=["vec_id", "v"])
    return list(segments._pack(iter([rows])))


@pytest.mark.parametrize("few", [0.0, 0.02, 1.0])
@pytest.mark.parametrize("largest,width", [(256, 2), (10**5, 4), (1000, 8)])
def test_bounds_and_types_change_no_answer(monkeypatch, few, largest, width):
    """All pairs scored at once, or pair by pair, in floats, doubles and longs: with copies, near copies and repeated ids."""
    rng = np.random.default_rng(3)
    vectors = rng.integers(-largest, largest, (1700, 13))
    vectors[500:900] = vectors[100] + rng.integers(-largest // 50, largest // 50, (400, 13))
    vectors[900:1000] = vectors[7]
    vectors[0] = 0
    if width == 8:  # longs are needed, and sums of products stay below 2^63
        vectors[:, 3] = rng.integers(-(2**31) - 2**28, 2**31 + 2**28, 1700)
    ids = rng.permutation(1700) - 40
    ids[1000:1020] = ids[:20]
    monkeypatch.setattr(segments, "FEW", few)
    monkeypatch.setattr(segments, "BLOCK", 1200)
    monkeypatch.setattr(segments, "SEED", 30)
    left = blocks(ids, vectors)
    asked = np.arange(0, 1700, 5)
    right = blocks(ids[asked], vectors[asked])
    assert len(left) == 2 and len(left[0].column(3)[0].as_py()) == 1200 * 13 * width

    def met():
        for block in left:
            columns = [block.column(n) for n in ("dim", "ids", "vectors")] + [right[0].column(n) for n in ("ids", "vectors")]
            yield pa.RecordBatch.from_arrays(columns, names=["dim", "ids", "vectors", "q_ids", "q_vectors"])

    found = defaultdict(list)
    for batch in segments._score(met(), 5):
        for r in batch.to_pylist():
            found[r["query_id"], r["query_key"]].append((-r["score"], r["vec_id"]))
    expected = defaultdict(list)
    for i, key in zip(asked, segments._keys(vectors[asked]).tolist(), strict=True):
        scores = vectors @ vectors[i]
        best = np.lexsort((ids, -scores))
        best = best[ids[best] != ids[i]][:5]
        expected[ids[i], key] += [(-s, j) for s, j in zip(scores[best].tolist(), ids[best].tolist(), strict=True)]
    assert {q: sorted(rows) for q, rows in found.items()} == {q: sorted(rows) for q, rows in expected.items()}


def test_places_of_sparse_matrices():
    rng = np.random.default_rng(4)
    for shape in ((3, 5), (8, 16), (1, 8), (0, 8), (4, 1024)):
        found = rng.random(shape) < 0.1
        assert segments._places(found).tolist() == np.flatnonzero(found).tolist()
