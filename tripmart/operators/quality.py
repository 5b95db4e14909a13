"""Cleaning steps and the counts that describe them.

Every function is lazy and takes and returns DataFrames. Counts over many
columns come from one aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.schema import (
    CURRENCY_COLUMNS,
    REQUIRED_COLUMNS,
    RETENTION_WARNING_PCT,
    quoted,
    resolve,
)

OCCURRENCES = "occurrence_count"

# Copies of one row written by a single task; more are spread over several tasks.
COPIES_PER_TASK_ROW = 100_000


def dedup_rows(df: DataFrame) -> DataFrame:
    """Each distinct row once. Nulls are equal to each other."""
    return df.dropDuplicates()


def row_groups(df: DataFrame, count_column: str = OCCURRENCES) -> DataFrame:
    """Each distinct row once, with the number of times it occurs.

    Copies are counted before the shuffle, so a row that makes up a large
    share of the input sends one record per map task.
    """
    if resolve(df, count_column):
        raise ValueError(f"the input already has a column {count_column!r}")
    keys = [quoted(c) for c in df.columns]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_column))


def repeat_rows(
    groups: DataFrame,
    count_column: str = OCCURRENCES,
    copies_per_row: int = COPIES_PER_TASK_ROW,
) -> DataFrame:
    """Undo `row_groups`: every row as often as its count says.

    Counts are cut into chunks that are spread over the shuffle partitions, so
    the copies of a very frequent row are written by many tasks and never
    gathered in one.
    """
    spark = groups.sparkSession
    columns = [quoted(c) for c in groups.columns if c != count_column]
    chunk, left = "__chunk", "__left"

    last_chunk = F.expr(f"({quoted(count_column)} - 1) div {copies_per_row}")
    copies_left = F.col(count_column) - F.col(chunk) * copies_per_row
    chunks = (
        groups.filter(F.col(count_column) > 0)
        .withColumn(chunk, F.explode(F.sequence(F.lit(0).cast("bigint"), last_chunk)))
        .withColumn(left, F.least(copies_left, F.lit(copies_per_row)).cast("int"))
    )
    # A fixed number keeps AQE from merging chunks that are small only until they are expanded.
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = chunks.repartition(partitions, *columns, chunk)
    copies = F.explode(F.array_repeat(F.lit(True), F.col(left)))
    return spread.withColumn("__copy", copies).select(*columns)


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Every occurrence, the first one included, of each row found more than once.

    Copies of a row are alike, so they are counted and written out again. This
    shuffles each distinct row once; a window over all columns would sort the
    whole input and hold each group in one task.
    """
    repeated = row_groups(df).filter(F.col(OCCURRENCES) > 1)
    return repeat_rows(repeated)


def duplicate_summary(df: DataFrame) -> DataFrame:
    """One row: rows, distinct rows, and the surplus that deduplication removes."""
    return summarise_groups(row_groups(df))


def summarise_groups(groups: DataFrame, count_column: str = OCCURRENCES) -> DataFrame:
    """`duplicate_summary` of an input that is already grouped."""
    rows = F.coalesce(F.sum(count_column), F.lit(0).cast("bigint"))
    distinct = F.count(F.lit(1))
    return groups.agg(
        rows.alias("original_count"),
        distinct.alias("distinct_count"),
        (rows - distinct).alias("duplicate_count"),
    )


def has_required(df: DataFrame, columns: Sequence[str] = REQUIRED_COLUMNS) -> Column:
    """True where none of `columns` is null."""
    condition = F.lit(True)
    for name in columns:
        condition = condition & F.col(quoted(name)).isNotNull()
    return condition


def drop_null_rows(df: DataFrame, columns: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Rows without null in `columns`. NaN is a value and stays.

    Plain IS NOT NULL tests, as these are pushed into the file scan.
    """
    return df.filter(has_required(df, columns))


def null_counts(df: DataFrame, columns: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Rows (column_name, null_count, found); the count is null for an absent column."""
    return _count_per_column(df, columns, "null_count", lambda c: c.isNull())


def negative_counts(df: DataFrame, columns: Sequence[str] = CURRENCY_COLUMNS) -> DataFrame:
    """Rows (column_name, negative_count, found); the count is null for an absent column."""
    return _count_per_column(df, columns, "negative_count", lambda c: c < 0)


def _count_per_column(df: DataFrame, columns: Sequence[str], count_name: str, test) -> DataFrame:
    counts = count_columns(df, columns, "c", test)
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col(f"c{i}").alias(count_name),
            F.lit(resolve(df, name) is not None).alias("found"),
        )
        for i, name in enumerate(columns)
    ]
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def count_columns(df: DataFrame, columns: Sequence[str], prefix: str, test) -> list[Column]:
    """One aggregate per column counting the rows that pass `test`: prefix0, prefix1, ...

    Columns are found ignoring case; an absent one gives null.
    """
    aggregates = []
    for i, name in enumerate(columns):
        actual = resolve(df, name)
        if actual is None:
            count = F.max(F.lit(None).cast("bigint"))
        else:
            count = F.count_if(test(F.col(quoted(actual))))
        aggregates.append(count.alias(f"{prefix}{i}"))
    return aggregates


def abs_amounts(df: DataFrame, columns: Sequence[str] = CURRENCY_COLUMNS) -> DataFrame:
    """Money columns made non-negative; nulls, other columns and the order stay."""
    money = {name.lower() for name in columns}
    return df.select(
        *[
            F.abs(quoted(c)).alias(c) if c.lower() in money else F.col(quoted(c))
            for c in df.columns
        ]
    )


def quality_report(
    raw: DataFrame, clean: DataFrame, warn_below_pct: float = RETENTION_WARNING_PCT
) -> DataFrame:
    """One row: rows before and after cleaning, the share kept, and whether it is low.

    Over files this reads row counts from the footers only. Without any input
    rows the share and the warning are null.
    """
    zero = F.lit(0).cast("bigint")
    before = raw.agg(F.count(F.lit(1)).alias("initial_count"), zero.alias("final_count"))
    after = clean.agg(zero.alias("initial_count"), F.count(F.lit(1)).alias("final_count"))
    counts = before.unionByName(after).agg(
        F.sum("initial_count").alias("initial_count"), F.sum("final_count").alias("final_count")
    )
    return counts.withColumn(
        "retention_pct", F.try_divide(F.col("final_count"), F.col("initial_count")) * 100
    ).withColumn("low_retention", F.col("retention_pct") < warn_below_pct)
