from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF_SMALL = "/root/testdata/sf0.001"
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tripmart-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def trips(spark):
    """Raw trips at the smallest scale, as files."""
    import __spark_entry__ as entry

    return entry.trips(spark, SF_SMALL)


@pytest.fixture(scope="session")
def star(spark):
    """The star schema at the smallest scale."""
    import __spark_entry__ as entry

    return entry.star(spark, SF_SMALL)


def rows(df) -> list[tuple]:
    """All rows, in an order that does not depend on the plan."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def dicts(df) -> list[dict]:
    return [r.asDict() for r in df.collect()]
