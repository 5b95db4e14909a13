"""Placement of equal groups in runs, and the whole assignment, against the heap taken group by group."""

from __future__ import annotations

import hashlib
import heapq
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tripmart.llm import sharding
from tripmart.llm.common import table
from tripmart.llm.sharding import longest_first, place_equal, shard_documents


def one_by_one(heap, size, n):
    picked = []
    for _ in range(n):
        load, shard = heap[0]
        heapq.heapreplace(heap, (load + size, shard))
        picked.append(shard)
    return picked


@pytest.mark.parametrize("seed", range(300))
def test_equal_groups_go_where_the_heap_puts_them(seed):
    rng = random.Random(seed)
    shards = rng.randrange(1, 9)
    heap = [(rng.randrange(rng.choice([1, 5, 40])) * rng.choice([1, 3]), shard) for shard in range(shards)]
    heapq.heapify(heap)
    plain = list(heap)
    for size, n in ((rng.randrange(1, 9), rng.randrange(1, 120)) for _ in range(4)):
        runs = place_equal(heap, size, n)
        assert [cycle[i % len(cycle)] for count, cycle in runs for i in range(count)] == one_by_one(plain, size, n)
        assert sorted(heap) == sorted(plain) and len(runs) <= shards
        assert heap[0] == min(heap)


def test_a_billion_equal_groups_take_few_steps():
    heap = [(10**8, 0), *[(0, shard) for shard in range(1, 40)]]
    heapq.heapify(heap)
    runs = place_equal(heap, 20, 10**9)
    assert len(runs) == 2 and sum(count for count, _ in runs) == 10**9
    loads = [load for load, _ in heap]
    assert max(loads) - min(loads) <= 20 and sum(loads) == 20 * 10**9 + 10**8


def expected_shards(df) -> dict[str, int]:
    groups = defaultdict(int)
    for row in df.select("text").collect():
        groups[hashlib.md5(row["text"].encode()).hexdigest()] += len(row["text"].encode()) + 16
    return dict(longest_first(list(groups.items()), 40))


def found_shards(df) -> list[tuple]:
    """(doc_id, digest of the text, shard) of every document; ids are unique."""
    own = df.select("doc_id", F.md5("text").alias("group"))
    return [tuple(r) for r in shard_documents(df).join(own, "doc_id").select("doc_id", "group", "shard").collect()]


@pytest.mark.parametrize("numbers", [sharding.BROADCAST_NUMBERS, 0])
def test_every_document_of_the_table_is_where_the_heap_puts_it(spark, monkeypatch, numbers):
    monkeypatch.setattr(sharding, "BROADCAST_NUMBERS", numbers)
    df = table(spark, "/root/testdata/sf0.1", "documents").filter("text IS NOT NULL")
    expected, found = expected_shards(df), found_shards(df)
    assert len(found) == df.count()
    assert all(expected[group] == shard for _, group, shard in found)


def test_many_equal_groups_copies_and_one_large_group(spark):
    """A third of the rows are copies, a third are groups of one size."""
    df = spark.range(6000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("the same text"))
        .when(F.col("id") % 3 == 1, F.lpad(F.col("id").cast("string"), 9, "0"))
        .otherwise(F.repeat(F.col("id").cast("string"), (F.col("id") % 50).cast("int") + 1))
        .alias("text"),
    )
    expected = expected_shards(df)
    assert all(expected[group] == shard for _, group, shard in found_shards(df))
