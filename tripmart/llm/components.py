"""Connected components of links between long integers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import stage


def components(links: DataFrame, about: int) -> DataFrame:
    """`node, root` of every node of `links` (`a, b`); nodes of one component have the same root.

    In every round a node moves to its neighbour with the least hash, if that is
    less than its own, and links follow. A new hash each round makes a long path
    shrink by a fixed share, and a star shrinks at once. A node with very many
    links is only ever a key of a minimum, which is taken before the exchange,
    or of a join, which Spark splits. Rounds are staged, and the moves are put
    together at the end. `about` is how many nodes there may be, as for `stage`.
    """
    moves = []
    links = stage(links.filter("a <> b").distinct(), about)
    while links.take(1):
        seed = F.lit(len(moves))
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = F.min(F.struct(F.xxhash64("b", seed).alias("hash"), F.col("b"))).alias("least")
        goes = F.when(F.col("least.hash") < F.xxhash64("node", seed), F.col("least.b")).otherwise(F.col("node"))
        move = stage(both.groupBy(F.col("a").alias("node")).agg(least).select("node", goes.alias("to")), about)
        moves.append(move)
        of = lambda end, move=move: move.select(F.col("node").alias(end), F.col("to").alias(f"to_{end}"))
        moved = links.join(of("a"), "a").join(of("b"), "b").filter("to_a <> to_b")
        links = stage(
            moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), about
        )
    spark = links.sparkSession
    if not moves:
        return spark.createDataFrame([], "node long, root long")
    found = moves[0].withColumnRenamed("to", "root")
    for move in moves[1:]:
        later = move.select(F.col("node").alias("root"), F.col("to").alias("next"))
        found = found.join(later, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return stage(found, about)
