"""Repeated rows found by digests, so that rows which occur once are not shuffled.

A digest of 16 bytes and a count go through the exchange instead of whole rows.
Digests only tell which rows may be repeated: those are compared by whole rows,
so two different rows of one digest both stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tripmart.operators.quality import OCCURRENCES, repeat_rows, row_groups, summarise_groups
from tripmart.schema import quoted
from tripmart.sinks.files import delete_at_exit
from tripmart.sinks.staging import new_folder, write_and_read

#: Bits of each of a digest's two halves.
BITS = 64
#: So many repeated digests, of 16 bytes, are broadcast at most; beyond that whole rows are shuffled.
BROADCAST_DIGESTS = 1 << 20


def one_zero(df: DataFrame) -> DataFrame:
    """Negative zeros made positive, as grouping does."""
    floats = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    columns = [(df[quoted(c)] + F.lit(0).cast(df.schema[c].dataType)) if c in floats else df[quoted(c)] for c in df.columns]
    return df.select(*[v.alias(c) for v, c in zip(columns, df.columns, strict=True)])


def row_digest(df: DataFrame, bits: int = BITS) -> list[Column]:
    """Two hashes of a whole row; rows that are equal as groups, nulls and NaN included, have equal ones."""
    values = [df[quoted(c)] for c in df.columns]
    # A hash leaves nulls out, so where they are is hashed too.
    nulls = F.concat(F.lit(""), *[F.when(v.isNull(), "1").otherwise("0") for v in values])
    halves = [F.xxhash64(F.lit(seed), nulls, *values) for seed in (1, 2)]
    return halves if bits == 64 else [F.pmod(h, F.lit(1 << bits)) for h in halves]


def row_groups_by_digest(
    df: DataFrame,
    count_column: str = OCCURRENCES,
    bits: int = BITS,
    limit: int = BROADCAST_DIGESTS,
    folder: str | None = None,
) -> DataFrame:
    """`row_groups` that shuffles digests, and whole rows only where a digest occurs more than once.

    The digests that occur more than once are found now and kept in `folder`, or
    in the shared folder until Python ends. The input is then read twice, by a
    join with these digests each: rows whose digest is not among them pass
    as they are, with a count of 1, the others are grouped. With more than
    `limit` such digests most rows would be grouped anyway; then all are.
    """
    spark = df.sparkSession
    if folder is None:
        folder = new_folder(spark)
        delete_at_exit(spark, folder)
    df = one_zero(df)
    first, second = row_digest(df, bits)
    counted = df.select(first.alias("first"), second.alias("second")).groupBy("first", "second").count()
    seen = Observation()
    again = counted.filter("count > 1").select("first", "second").observe(seen, F.count(F.lit(1)).alias("n"))
    again = write_and_read(again, folder)
    if seen.get["n"] > limit:
        return row_groups(df, count_column)
    again = F.broadcast(again)
    same = (first == again["first"]) & (second == again["second"])
    once = df.join(again, same, "left_anti").withColumn(count_column, F.lit(1).cast("bigint"))
    return once.unionByName(row_groups(df.join(again, same, "left_semi"), count_column))


def dedup_by_digest(df: DataFrame, **more: int) -> DataFrame:
    """`dedup_rows`, by `row_groups_by_digest`."""
    return row_groups_by_digest(df, **more).drop(OCCURRENCES)


def duplicates_by_digest(df: DataFrame, **more: int) -> DataFrame:
    """`duplicate_rows`, by `row_groups_by_digest`."""
    return repeat_rows(row_groups_by_digest(df, **more).filter(F.col(OCCURRENCES) > 1))


def summary_by_digest(df: DataFrame, **more: int) -> DataFrame:
    """`duplicate_summary`, by `row_groups_by_digest`."""
    return summarise_groups(row_groups_by_digest(df, **more))
