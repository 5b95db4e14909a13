"""Properties of the plans that keep the queries fast on large data."""

from __future__ import annotations

import re

import pytest
from conftest import SF, rows
from pyspark.sql import functions as F

from tripmart import operators as ops
from tripmart.plans import REPORTS, reports
from tripmart.sources.sample import sample_trips


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scanned(text: str) -> set[str]:
    """Columns read from the first scan of the plan that is printed."""
    return set(re.findall(r"(\w+):", re.search(r"ReadSchema: struct<([^>]*)>", text)[1]))


FACT_COLUMNS_READ = {
    "pickup_boroughs": {"PULocationID", "total_amount"},
    "payment_analysis": {"payment_type", "fare_amount", "tip_amount", "total_amount"},
    "rate_code_analysis": {"RateCodeID", "trip_distance", "total_amount"},
    "payment_by_rate": {"payment_type", "RateCodeID"},
    "busiest_hours": {"tpep_pickup_datetime"},
    "popular_routes": {
        "PULocationID",
        "DOLocationID",
        "trip_distance",
        "trip_duration_minutes",
        "total_amount",
    },
}


@pytest.mark.parametrize("name", FACT_COLUMNS_READ)
def test_reports_read_only_their_columns(star, name):
    assert scanned(plan(REPORTS[name](star))) == FACT_COLUMNS_READ[name]


def test_reports_total_trips_before_any_join(star):
    for report in REPORTS.values():
        lines = plan(report(star)).splitlines()
        fact_scan = next(i for i, line in enumerate(lines) if "fact_trips" in line)
        path = [line for line in lines[:fact_scan]]
        joins = [i for i, line in enumerate(path) if "Join" in line]
        partial = max(i for i, line in enumerate(path) if "partial_count(1)" in line)
        assert all(join < partial for join in joins)


def test_join_key_filters_reach_the_scan(star):
    assert "PushedFilters: [IsNotNull(payment_type)]" in plan(reports.payment_analysis(star))


def test_top_k_is_not_a_global_sort(star):
    for name in ("top_routes_by_revenue", "popular_pickups", "popular_dropoffs", "popular_routes"):
        text = plan(REPORTS[name](star))
        assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_null_filter_reaches_the_scan_below_the_distinct(trips):
    text = plan(ops.clean_trips(trips))
    assert "PushedFilters: [IsNotNull(trip_distance), IsNotNull(total_amount)]" in text
    assert text.count("Exchange") == 1


def test_counts_read_only_their_columns_in_one_pass(trips):
    text = plan(ops.null_counts(trips))
    assert scanned(text) == {"trip_distance", "total_amount"}
    assert text.count("FileScan") == 1
    assert plan(ops.negative_counts(trips)).count("FileScan") == 1


def test_row_counts_read_no_columns(trips, star):
    text = plan(ops.quality_report(trips, star["fact_trips"]))
    assert text.count("ReadSchema: struct<>") == text.count("FileScan") == 2


def test_time_dimension_shuffles_only_the_time(trips):
    exchange = [line for line in plan(ops.dim_time(trips)).splitlines() if "Exchange" in line]
    assert len(exchange) == 1
    assert re.search(r"hashpartitioning\(tpep_pickup_datetime#\d+, \d+\)", exchange[0])


def test_duplicates_need_no_window(trips):
    text = plan(ops.duplicate_rows(trips))
    assert "Window" not in text and "Sort " not in text


def test_no_python_and_no_nested_loops(trips, star):
    frames = [report(star) for report in REPORTS.values()]
    frames += [reports.busiest_hours_by_join(star), ops.table_counts(star)]
    frames += [ops.duplicate_rows(trips), ops.fact_trips(ops.enriched_trips(trips))]
    for text in map(plan, frames):
        for unwanted in ("Python", "CartesianProduct", "NestedLoop"):
            assert unwanted not in text


def test_large_sides_are_not_broadcast(spark, star):
    """Nothing is broadcast by hint, so the size limit rules."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for report in [*REPORTS.values(), reports.busiest_hours_by_join]:
            assert "Broadcast" not in plan(report(star))
        assert rows(reports.busiest_hours_by_join(star)) == rows(reports.busiest_hours(star))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_a_hot_order_is_split_between_tasks(spark, tmp_path):
    """AQE cuts the partition of an order that holds nearly half of the lines."""
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    hot = F.when(F.col("l_linenumber") <= 3, F.lit(7)).otherwise(F.col("l_orderkey"))
    lines = lines.withColumn("l_orderkey", hot.cast("bigint")).repartition(4)
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    for table in ("orders", "customer", "supplier"):
        (tmp_path / f"{table}.parquet").symlink_to(f"{SF}/{table}.parquet")

    adaptive = "spark.sql.adaptive."
    small = {
        f"{adaptive}skewJoin.skewedPartitionThresholdInBytes": "100k",
        f"{adaptive}advisoryPartitionSizeInBytes": "100k",
        f"{adaptive}coalescePartitions.parallelismFirst": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key) for key in small}
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        totals = sample_trips(spark, str(tmp_path)).agg(F.count(F.lit(1)), F.sum("total_amount"))
        assert totals.collect()[0][0] >= lines.count()
        assert "SortMergeJoin(skew=true)" in plan(totals)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_a_hot_key_is_one_record_per_task(spark, star):
    """A third of the trips in one zone and at one time changes only their totals."""
    third = F.col("trip_id") % 3 == 0
    fact = star["fact_trips"].withColumns(
        {
            "PULocationID": F.when(third, F.lit(7)).otherwise(F.col("PULocationID")),
            "tpep_pickup_datetime": F.when(
                third, F.lit("1995-05-05 05:05:05").cast("timestamp_ntz")
            ).otherwise(F.col("tpep_pickup_datetime")),
        }
    )
    hot = {**star, "fact_trips": fact, "dim_time": ops.dim_time(fact)}
    assert reports.popular_pickups(hot).first()["location_id"] == "7"
    assert reports.busiest_hours_by_join(hot).first()["pickup_hour"] == 5
    assert rows(reports.busiest_hours_by_join(hot)) == rows(reports.busiest_hours(hot))
