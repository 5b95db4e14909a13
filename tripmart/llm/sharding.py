"""Sharding by longest-processing-time scheduling of groups that stay together."""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tripmart.llm.common import running_totals, stage, text_of

SHARDS = 40
ROW_BYTES = 16
#: Documents of groups of at least 1/LARGE of a shard's mean load never meet in an exchange.
LARGE = 1000
#: Numbers in lists of shards that may be broadcast.
BROADCAST_NUMBERS = 1 << 20


def longest_first(sizes: list[tuple[str, int]], shards: int) -> list[tuple[str, int]]:
    """(name, shard): by falling size, each to the shard with the least load, ties to the smaller shard and name."""
    heap = [(0, shard) for shard in range(shards)]
    placed = []
    for name, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        load, shard = heap[0]
        heapq.heapreplace(heap, (load + size, shard))
        placed.append((name, shard))
    return placed


def place_equal(heap: list[tuple[int, int]], size: int, n: int) -> list[tuple[int, list[int]]]:
    """Put `n` groups of one size on the heap of (load, shard) as `longest_first` would, in few steps.

    Returns (count, cycle) runs: the next `count` groups go to the shards of `cycle`
    in turn. Few groups are placed one by one. Of many, the shards whose load is
    less than one group above the least take one each, in the order of load, and
    again, until their loads reach the next shard's. So there are no more runs than
    shards, however many groups.
    """
    if n <= len(heap):
        cycle = []
        for _ in range(n):
            load, shard = heap[0]
            heapq.heapreplace(heap, (load + size, shard))
            cycle.append(shard)
        return [(n, cycle)]
    runs = []
    while n:
        heap.sort()
        least, first = heap[0]
        active = sum(item < (least + size, first) for item in heap)
        count = n
        if active < len(heap):
            load, shard = heap[active]
            rounds, above = divmod(load - least, size)
            count = min(n, active * (rounds - (not above and shard < first)))
        rounds, rest = divmod(count, active)
        runs.append((count, [shard for _, shard in heap[: min(active, count)]]))
        heap[:active] = [(load + size * (rounds + (i < rest)), shard) for i, (load, shard) in enumerate(heap[:active])]
        n -= count
    heapq.heapify(heap)
    return runs


def _runs(spark: SparkSession, sizes: pa.Table, shards: int) -> tuple[DataFrame, int]:
    """`size, first, count, cycle`: shards of the groups in the order of falling size, from the `first` one on.

    And how many numbers all cycles have.
    """
    heap = [(0, shard) for shard in range(shards)]
    placed, first = [], 0
    for size, n in zip(sizes["size"].to_pylist(), sizes["n"].to_pylist(), strict=True):
        for count, cycle in place_equal(heap, size, n):
            placed.append((size, first, count, cycle))
            first += count
    columns = zip(*placed, strict=True) if placed else ([], [], [], [])
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))
    arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
    runs = spark.createDataFrame(pa.table(arrays, names=["size", "first", "count", "cycle"]))
    return stage(runs), sum(len(cycle) for *_, cycle in placed)


def shard_documents(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Put every document into a shard so that shards have nearly equal bytes.

    Documents with equal text are a group and share a shard. A group's size is
    the sum of its documents' sizes: UTF-8 bytes of the text plus 16. Groups go
    by falling size, ties by the text's MD5, to the shard with the least load,
    ties to the smaller one, through a heap.

    The heap sees distinct sizes and how many groups have each, and places equal
    groups in runs. There are at most sqrt(2 * bytes) distinct sizes in a table of
    so many bytes, as they add up to no more. Groups are numbered in that order
    by a distributed sort and find the run that their number lies in.

    Returns `doc_id, size, text_crc32, law ("bytes"), shard, slot, grown_shard`.
    `slot` numbers a shard's documents from 0 in the order of a hash of the id,
    then id. `grown_shard` is null, as this law ties no document to a shard count.

    Null text counts as empty. Null and repeated ids are documents like others.
    An empty table gives no rows. A group larger than a shard's mean load makes
    its shard larger than the rest, as it may not be split.
    """
    spark, text = documents.sparkSession, text_of(documents)
    rows = stage(
        documents.select(
            documents["doc_id"],
            (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.md5(text).alias("group"),
        )
    )
    groups = stage(rows.groupBy("group").agg(F.sum("size").alias("size")), rows.count())
    sizes = groups.groupBy("size").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("size")).toArrow()
    runs, numbers = _runs(spark, sizes, shards)
    if numbers <= BROADCAST_NUMBERS:  # else Spark joins by size, and splits a size that very many groups have
        runs = F.broadcast(runs)
    ordered = running_totals(groups, [F.desc("size"), F.col("group")], groups.count(), place=F.lit(1))
    turn = F.col("place") - F.col("first")
    placed = stage(
        ordered.join(runs, "size")
        .filter((turn >= 0) & (turn < F.col("count")))
        .select("group", F.col("size").alias("all"), F.get("cycle", F.pmod(turn, F.size("cycle")).cast("int")).alias("shard")),
        groups.count(),
    )
    total = sum(size * n for size, n in zip(sizes["size"].to_pylist(), sizes["n"].to_pylist(), strict=True))
    is_large = F.col("all") * (shards * LARGE) >= F.lit(total)
    large = F.broadcast(placed.filter(is_large).select("group", "shard"))  # at most 1000 * shards rows
    small = placed.filter(~is_large).select("group", "shard")
    of_small = rows.join(large.select("group"), "group", "left_anti").join(small, "group")
    found = rows.join(large, "group").unionByName(of_small).select("doc_id", "size", "text_crc32", "shard")
    order = [F.col("shard"), F.xxhash64("doc_id"), F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    numbered = running_totals(found, order, rows.count(), place=F.lit(1))
    counts = {r["shard"]: r["n"] for r in numbered.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    starts = [sum(counts.get(j, 0) for j in range(i)) for i in range(shards)]
    first = F.element_at(F.array(*[F.lit(x).cast(LongType()) for x in starts]), F.col("shard") + 1)
    return numbered.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("place") - first).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
