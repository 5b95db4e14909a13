"""Dense numbers that a reload repeats."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.schema import quoted
from tripmart.sinks.staging import write_and_read

PART, ROW, START = "__part", "__row", "__start"
#: Bits of a row's place in its part in an increasing id.
ROW_BITS = 33


def numbered(df: DataFrame, column: str, folder: str) -> DataFrame:
    """`df` with numbers from 0 in the order of all its columns, without gaps; nulls come first.

    The same rows get the same numbers however they are partitioned; equal rows
    get different ones, and which of them has which cannot be told. The rows are
    range-sorted and written to `folder`. Rows are counted for each sorted part,
    and a part's numbers begin after those of the parts before it: one figure for
    each part, of which there are as many as shuffle partitions, goes through the
    driver. Where equal rows are cut does not matter, so many of them are spread
    over several parts.
    """
    spark, mid = df.sparkSession, F.monotonically_increasing_id()
    tie = "__tie"  # of equal rows, so that they need not be in one part
    keys = [quoted(c) for c in df.columns]
    placed = df.withColumn(tie, mid).orderBy(*keys, tie).drop(tie)
    places = {PART: F.shiftright(mid, ROW_BITS), ROW: mid.bitwiseAND(F.lit((1 << ROW_BITS) - 1))}
    rows = write_and_read(placed.withColumns(places), folder)
    counts = sorted((r[PART], r["count"]) for r in rows.groupBy(PART).count().collect())
    starts = accumulate((n for _, n in counts[:-1]), initial=0) if counts else ()
    begins = list(zip((part for part, _ in counts), starts, strict=True))
    before = F.broadcast(spark.createDataFrame(begins, f"{PART} long, {START} long"))  # a row for each part
    number = (F.col(START) + F.col(ROW)).alias(column)
    return rows.join(before, PART).select(number, *keys)
