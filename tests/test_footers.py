"""Counts from the footers of Parquet files, against scans of the same files."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import SF_SMALL, rows
from pyspark.sql import functions as F
from test_plans import plan

import __spark_entry__ as entry
from tripmart import operators as ops
from tripmart.operators import footers
from tripmart.sources import month_path

AMOUNTS = ["fare", "tip", "tax", "Absent"]


@pytest.fixture
def scans(monkeypatch):
    """Names of the scans that were made because footers did not tell."""
    made = []
    for name in ("null_counts", "negative_counts"):
        whole = getattr(footers, name)
        monkeypatch.setattr(footers, name, lambda *a, name=name, whole=whole: made.append(name) or whole(*a))
    return made


def same(spark, path, columns) -> None:
    files = spark.read.parquet(path)
    assert rows(ops.null_counts_from_footers(spark, path, columns)) == rows(ops.null_counts(files, columns))
    assert rows(ops.negative_counts_from_footers(spark, path, columns)) == rows(ops.negative_counts(files, columns))


def test_counts_are_pushed_into_the_source(spark):
    path = month_path(entry.landing(spark, SF_SMALL), *entry.MONTH)
    told = footers.from_footers(spark, path, ["total_amount"])
    told.collect()
    pushed = plan(told)
    assert "PushedAggregation: [COUNT(*)" in pushed and "MIN(total_amount)" in pushed
    assert "COUNT(trip_distance)" in pushed and "PushedAggregation: []" not in pushed


def test_trips(spark, scans):
    path = month_path(entry.landing(spark, SF_SMALL), *entry.MONTH)
    same(spark, path, [*footers.REQUIRED_COLUMNS, *footers.CURRENCY_COLUMNS, "absent"])
    assert scans == []


def test_nulls_only_zeros_and_several_files(spark, tmp_path, scans):
    path = str(tmp_path / "files")
    spark.range(1000).repartition(3).select(
        F.when(F.col("id") % 7 > 0, F.col("id") - 500).alias("fare"),
        F.lit(None).cast("double").alias("tip"),
        F.lit(-0.0).alias("TAX"),
    ).write.parquet(path)
    same(spark, path, AMOUNTS)
    assert scans == []


def test_no_rows(spark, tmp_path, scans):
    path = str(tmp_path / "files")
    spark.range(0).select(F.col("id").alias("fare"), F.col("id").alias("tip")).write.parquet(path)
    same(spark, path, AMOUNTS)


@pytest.mark.parametrize("odd", [[1.0, float("nan"), -2.0], [None, None]])
def test_a_minimum_that_footers_lack_is_scanned_for(spark, tmp_path, odd):
    path = str(tmp_path / "files")
    for values in (odd, [3.0, -1.0, -5.0]):
        frame = spark.createDataFrame([(v, 1.0) for v in values], "fare double, tip double")
        frame.coalesce(1).write.mode("append").parquet(path)
    same(spark, path, AMOUNTS)


def test_files_without_statistics_are_scanned(spark, tmp_path, scans):
    path = str(tmp_path / "one.parquet")
    pq.write_table(pa.table({"fare": [1.0, None, -1.0], "tip": [None, -2.0, 0.0]}), path, write_statistics=False)
    same(spark, path, AMOUNTS)
    assert scans[0] == "null_counts"


def test_files_whose_columns_stand_in_another_order_are_scanned(spark, tmp_path, scans):
    path = str(tmp_path / "files")
    frame = spark.createDataFrame([(1.0, -1.0), (None, -2.0)], "fare double, tip double")
    frame.coalesce(1).write.parquet(path)
    frame.select("tip", "fare").coalesce(1).write.mode("append").parquet(path)
    same(spark, path, AMOUNTS)
    assert scans == ["null_counts", "negative_counts"]


def test_amounts_that_are_no_numbers_are_scanned(spark, tmp_path, scans):
    path = str(tmp_path / "files")
    spark.createDataFrame([("-1",), ("2",)], "fare string").write.parquet(path)
    same(spark, path, AMOUNTS)
    assert scans == ["negative_counts"]


def test_only_row_groups_with_negatives_are_read(spark, tmp_path):
    """A filter on the columns below 0 is what the second scan pushes down."""
    path = str(tmp_path / "one.parquet")
    pq.write_table(pa.table({"fare": [*range(100), *range(-50, 50)], "tip": [1] * 200}), path, row_group_size=100)
    found = {r["column_name"]: r["negative_count"] for r in ops.negative_counts_from_footers(spark, path, AMOUNTS).collect()}
    assert found == {"fare": 50, "tip": 0, "tax": None, "Absent": None}
