from __future__ import annotations

import pytest
from conftest import dicts, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from tripmart import operators as ops
from tripmart.schema import CURRENCY_COLUMNS


@pytest.fixture
def dup3(spark):
    data = [(1, "a", 1.5)] * 3 + [(2, "b", 2.5)] + [(None, None, None)] * 2
    return spark.createDataFrame(data, "id long, name string, amount double").repartition(3)


def test_dedup_treats_nulls_as_equal(dup3):
    assert ops.dedup_rows(dup3).count() == 3


def test_duplicates_hold_every_occurrence(dup3):
    found = rows(ops.duplicate_rows(dup3))
    assert found == sorted([(1, "a", 1.5)] * 3 + [(None, None, None)] * 2, key=repr)
    assert ops.duplicate_rows(dup3).columns == dup3.columns


def test_duplicates_equal_a_window_count(trips):
    window = Window.partitionBy(*trips.columns)
    expected = trips.withColumn("n", F.count(F.lit(1)).over(window)).filter("n > 1").drop("n")
    assert rows(ops.duplicate_rows(trips)) == rows(expected)


def test_no_duplicates_give_an_empty_table(spark):
    df = spark.createDataFrame([(1,), (2,)], "id long")
    assert ops.duplicate_rows(df).count() == 0
    assert dicts(ops.duplicate_summary(df)) == [
        {"original_count": 2, "distinct_count": 2, "duplicate_count": 0}
    ]


@pytest.mark.parametrize("count", [1, 2, 6, 7, 8, 14, 15, 100])
def test_repeat_rows_is_exact_around_chunk_ends(spark, count):
    groups = spark.createDataFrame([("x", count), ("y", 1)], "name string, occurrence_count long")
    copies = ops.repeat_rows(groups, copies_per_row=7).groupBy("name").count().collect()
    assert {r["name"]: r["count"] for r in copies} == {"x": count, "y": 1}


def test_copies_of_a_frequent_row_are_written_by_several_tasks(spark):
    groups = spark.createDataFrame([("x", 10_000)], "name string, occurrence_count long")
    copies = ops.repeat_rows(groups, copies_per_row=100)
    per_task = copies.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(per_task) == 4
    assert sum(r["count"] for r in per_task) == 10_000


def test_zeros_of_either_sign_and_nan_are_equal(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (float("nan"),)], "x double")
    assert ops.dedup_rows(df).count() == 2
    assert [str(r["x"]) for r in ops.duplicate_rows(df).orderBy("x").collect()] == [
        "0.0",
        "0.0",
        "nan",
        "nan",
    ]


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1, 2), (1, 2)], ["a.b", "c`d"])
    assert rows(ops.duplicate_rows(df)) == [(1, 2), (1, 2)]


def test_row_groups_refuse_a_clash(spark):
    with pytest.raises(ValueError, match="already has"):
        ops.row_groups(spark.createDataFrame([(1,)], "Occurrence_Count long"))


def test_duplicate_summary(dup3):
    assert dicts(ops.duplicate_summary(dup3)) == [
        {"original_count": 6, "distinct_count": 3, "duplicate_count": 3}
    ]


def test_duplicate_summary_of_nothing(dup3):
    assert dicts(ops.duplicate_summary(dup3.limit(0))) == [
        {"original_count": 0, "distinct_count": 0, "duplicate_count": 0}
    ]


@pytest.fixture
def nulls(spark):
    data = [(None, 1.0, 1), (1.0, None, 2), (None, None, 3), (1.0, 1.0, None), (float("nan"), 1.0, 5)]
    return spark.createDataFrame(data, "trip_distance double, total_amount double, other int")


def test_only_nulls_in_required_columns_drop_a_row(nulls):
    assert sorted(str(r["other"]) for r in ops.drop_null_rows(nulls).collect()) == ["5", "None"]


def test_required_columns_are_a_parameter(nulls):
    assert ops.drop_null_rows(nulls, ["other"]).count() == 4


def test_null_counts(nulls):
    assert dicts(ops.null_counts(nulls, ["trip_distance", "total_amount", "absent"])) == [
        {"column_name": "trip_distance", "null_count": 2, "found": True},
        {"column_name": "total_amount", "null_count": 2, "found": True},
        {"column_name": "absent", "null_count": None, "found": False},
    ]


@pytest.mark.parametrize("spelling", ["Airport_fee", "airport_fee", "AIRPORT_FEE"])
def test_amounts_whatever_their_case(spark, spelling):
    columns = ["id", *[spelling if c == "airport_fee" else c for c in CURRENCY_COLUMNS]]
    data = [(-1, *[-float(i + 1) for i in range(9)]), (2, *[0.0] * 9), (3, *[None] * 9)]
    schema = "id int, " + ", ".join(f"{c} double" for c in columns[1:])
    df = spark.createDataFrame(data, schema)

    positive = ops.abs_amounts(df)
    assert positive.columns == columns
    assert rows(positive) == sorted(
        [(-1, *[float(i + 1) for i in range(9)]), (2, *[0.0] * 9), (3, *[None] * 9)], key=repr
    )
    assert all(r["negative_count"] == 1 and r["found"] for r in dicts(ops.negative_counts(df)))


def test_absent_currency_column_is_reported(spark):
    df = spark.createDataFrame([(-1.0,), (2.0,)], "fare_amount double")
    found = {r["column_name"]: r for r in dicts(ops.negative_counts(df))}
    assert found["fare_amount"]["negative_count"] == 1
    assert found["tip_amount"] == {
        "column_name": "tip_amount",
        "negative_count": None,
        "found": False,
    }
    assert rows(ops.abs_amounts(df)) == [(1.0,), (2.0,)]


def test_quality_report(spark):
    raw, clean = spark.range(200), spark.range(160)
    assert dicts(ops.quality_report(raw, clean)) == [
        {"initial_count": 200, "final_count": 160, "retention_pct": 80.0, "low_retention": True}
    ]
    assert dicts(ops.quality_report(raw, spark.range(170)))[0]["low_retention"] is False


def test_quality_report_of_nothing(spark):
    assert dicts(ops.quality_report(spark.range(0), spark.range(0))) == [
        {"initial_count": 0, "final_count": 0, "retention_pct": None, "low_retention": None}
    ]
