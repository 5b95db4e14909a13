"""Lookup dimensions: two fixed code lists and the zone file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmart.schema import PAYMENT_TYPES, RATE_CODES, ZONE_COLUMNS, resolve


def _code_list(spark: SparkSession, codes: list[tuple[int, str]], columns: str) -> DataFrame:
    """Fixed codes as inline values, so that Spark knows how few they are."""
    rows = ", ".join(f"({code}, '{description}')" for code, description in codes)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS codes({columns})")


def dim_payment_type(spark: SparkSession) -> DataFrame:
    return _code_list(spark, PAYMENT_TYPES, "payment_type, payment_type_desc")


def dim_rate_code(spark: SparkSession) -> DataFrame:
    return _code_list(spark, RATE_CODES, "RateCodeID, rate_code_desc")


def dim_taxi_zone(zones: DataFrame) -> DataFrame:
    """Rename the zone lookup's columns; types and further columns stay as they are."""
    found = {resolve(zones, old): new for old, new in ZONE_COLUMNS.items()}
    found.pop(None, None)
    return zones.withColumnsRenamed(found)


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """The zone lookup from its CSV file with header; every column is text."""
    return dim_taxi_zone(spark.read.csv(path, header=True, inferSchema=False))
