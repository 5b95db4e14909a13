"""Looking at finished tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tripmart.schema import STAR_TABLES, quoted


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows (table_name, row_count), all tables counted in one job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def table_sample(df: DataFrame, limit: int = 5, order_by: Sequence[str] = ()) -> DataFrame:
    """Some rows of a table: the first by `order_by`, without it whichever come first."""
    return (df.orderBy(*order_by) if order_by else df).limit(limit)


@dataclass(frozen=True)
class TableCheck:
    """What was found under a table's name: sample and row count, or an error."""

    sample: list[Row]
    row_count: int | None
    error: str | None = None


def verify_tables(
    spark: SparkSession,
    schema: str,
    names: Sequence[str] = STAR_TABLES,
    limit: int = 5,
) -> dict[str, TableCheck]:
    """Read back saved tables. A table that cannot be read does not stop the others."""
    checks = {}
    for name in names:
        try:
            table = spark.table(f"{quoted(schema)}.{quoted(name)}")
            checks[name] = TableCheck(table_sample(table, limit).collect(), table.count())
        except PySparkException as error:
            checks[name] = TableCheck([], None, str(error))
    return checks
