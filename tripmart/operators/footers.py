"""Counts of a month's files from their footers.

A footer has, for each column and row group, the number of nulls and the least
value. Spark's Parquet source answers counts and minima from these alone if
aggregates may be pushed into it, which is a setting of a session of its own here.
Where footers cannot tell, files are scanned, with the same result.
"""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tripmart.operators.quality import count_columns, negative_counts, null_counts
from tripmart.schema import CURRENCY_COLUMNS, REQUIRED_COLUMNS, quoted, resolve

#: Of more files the schemas are not compared one by one; they are scanned.
COMPARED_FILES = 1000


def from_footers(spark: SparkSession, path: str, least: Sequence[str] = ()) -> DataFrame:
    """One row about the Parquet files at `path`, answered by their footers: `rows`, non-null values, minima.

    `n0, n1, ...` are the non-null values of each column in order, and `least0,
    least1, ...` the minima of the columns `least`. Computing it fails where a
    footer lacks a figure, such as the minimum of nulls only or of NaN. Files
    must have one schema: the source finds a column by its place.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    files = own.read.parquet(path)
    return files.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(quoted(c)).alias(f"n{i}") for i, c in enumerate(files.columns)],
        *[F.min(quoted(c)).alias(f"least{i}") for i, c in enumerate(least)],
    )


def null_counts_from_footers(
    spark: SparkSession, path: str, columns: Sequence[str] = REQUIRED_COLUMNS
) -> DataFrame:
    """`null_counts` of the Parquet files at `path`: rows without non-null values, read from footers.

    An absent column has a null count. Files of several schemas, or without these
    figures, are scanned. Footers are read when this is called.
    """
    files = spark.read.parquet(path)
    told = _told(spark, path, files)
    if told is None:
        return null_counts(files, columns)
    nulls = {c: told["rows"] - told[f"n{i}"] for i, c in enumerate(files.columns)}
    return _rows(files, columns, "null_count", nulls)


def negative_counts_from_footers(
    spark: SparkSession, path: str, columns: Sequence[str] = CURRENCY_COLUMNS
) -> DataFrame:
    """`negative_counts` of the Parquet files at `path`, scanning only where a value below 0 can be.

    A column whose minimum is not below 0, or that has nulls only, has no
    negatives. Of the others just those columns are read, in the row groups in
    which one of them has a value below 0. Files of several schemas, columns that
    are no numbers, and footers without minima are scanned whole. Footers are read
    when this is called.
    """
    files = spark.read.parquet(path)
    actual = list(dict.fromkeys(filter(None, (resolve(files, c) for c in columns))))
    if not all(isinstance(files.schema[c].dataType, NumericType) for c in actual):
        return negative_counts(files, columns)
    told = _told(spark, path, files)
    if told is None:
        return negative_counts(files, columns)
    filled = [c for c in actual if told[f"n{files.columns.index(c)}"]]
    told = _told(spark, path, files, filled)
    below = filled if told is None else [c for i, c in enumerate(filled) if told[f"least{i}"] < 0]
    found = dict.fromkeys(actual, 0)
    if below:
        some = files.filter(" OR ".join(f"{quoted(c)} < 0" for c in below))
        counts = some.agg(*count_columns(some, below, "c", lambda c: c < 0)).first()
        found |= dict(zip(below, counts, strict=True))
    return _rows(files, columns, "negative_count", found)


def _told(spark: SparkSession, path: str, files: DataFrame, least: Sequence[str] = ()) -> dict | None:
    """What footers tell, or None where they do not."""
    if not _one_schema(spark, files):
        return None
    try:
        told = from_footers(spark, path, least).first().asDict()
    except (PySparkException, Py4JJavaError):  # a file that cannot be read at all fails again in the scan
        return None
    return told if told["rows"] else None  # without rows there is nothing to save


def _one_schema(spark: SparkSession, files: DataFrame) -> bool:
    paths = files.inputFiles()
    if len(paths) > COMPARED_FILES:
        return False
    return all(spark.read.parquet(p).schema == files.schema for p in paths[1:] + paths[:1]) if len(paths) > 1 else True


def _rows(files: DataFrame, columns: Sequence[str], name: str, counts: dict[str, int]) -> DataFrame:
    found = [(c, counts.get(resolve(files, c)), resolve(files, c) is not None) for c in columns]
    return files.sparkSession.createDataFrame(found, f"column_name string, {name} long, found boolean")
