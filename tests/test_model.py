from __future__ import annotations

from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tripmart import operators as ops
from tripmart.schema import TRIP_COLUMNS
from tripmart.sources import dim_payment_type, dim_rate_code

FACT_COLUMNS = [
    "trip_id",
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "PULocationID",
    "DOLocationID",
    "passenger_count",
    "payment_type",
    "RateCodeID",
    "trip_distance",
    "fare_amount",
    "tip_amount",
    "total_amount",
    "trip_duration_minutes",
    "price_per_mile",
]


def enriched_row(spark, kind="timestamp_ntz", **values):
    row = {
        "tpep_pickup_datetime": "2021-08-01 00:04:06",
        "tpep_dropoff_datetime": "2021-08-01 00:26:07",
        "trip_distance": 3.52,
        "fare_amount": 16.5,
    } | values
    df = spark.createDataFrame(
        [tuple(row.values())],
        "tpep_pickup_datetime string, tpep_dropoff_datetime string, "
        "trip_distance double, fare_amount double",
    )
    for column in ("tpep_pickup_datetime", "tpep_dropoff_datetime"):
        df = df.withColumn(column, F.col(column).cast(kind))
    return ops.enrich_trips(df).first()


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_first_published_trip(spark, kind):
    row = enriched_row(spark, kind)
    assert row["pickup_hour"] == 0
    assert row["pickup_date"] == date(2021, 8, 1)
    assert row["pickup_day_of_week"] == "Sunday"
    assert row["price_per_mile"] == 4.69
    assert row["trip_duration_minutes"] == 22.02


@pytest.mark.parametrize("distance", [0.0, -1.0, None])
def test_no_price_without_distance(spark, distance):
    assert enriched_row(spark, trip_distance=distance)["price_per_mile"] == 0.0


def test_price_needs_a_fare(spark):
    assert enriched_row(spark, fare_amount=None)["price_per_mile"] is None


def test_dropoff_before_pickup(spark):
    row = enriched_row(spark, tpep_dropoff_datetime="2021-08-01 00:01:06")
    assert row["trip_duration_minutes"] == -3.0


def test_parts_of_a_second_are_dropped(spark):
    row = enriched_row(spark, tpep_dropoff_datetime="2021-08-01 00:26:07.900")
    assert row["trip_duration_minutes"] == 22.02


def test_missing_pickup_time(spark):
    row = enriched_row(spark, tpep_pickup_datetime=None)
    assert row["pickup_hour"] is None and row["trip_duration_minutes"] is None


def test_enrichment_keeps_rows_and_adds_five_columns(trips):
    enriched = ops.enrich_trips(trips)
    assert enriched.columns[:19] == TRIP_COLUMNS
    assert len(enriched.columns) == 24
    assert enriched.count() == trips.count()


def test_fact_columns_and_unique_id(trips):
    fact = ops.fact_trips(ops.enriched_trips(trips))
    assert fact.columns == FACT_COLUMNS
    assert not fact.schema["trip_id"].nullable
    count, ids = fact.agg(F.count(F.lit(1)), F.countDistinct("trip_id")).first()
    assert count == ids == 5369


def test_time_dimension_is_unique_and_the_same_from_any_input(trips, star):
    enriched = ops.enriched_trips(trips)
    columns = ["tpep_pickup_datetime", "pickup_hour", "pickup_date", "pickup_day_of_week"]
    expected = rows(enriched.select(columns).distinct())
    assert ops.dim_time(enriched).columns == columns
    assert rows(ops.dim_time(enriched)) == expected
    assert rows(star["dim_time"]) == expected
    assert len({r[0] for r in expected}) == len(expected) == 5368


def test_amounts_are_made_positive_before_the_price(trips):
    assert ops.enriched_trips(trips).filter("price_per_mile < 0 OR total_amount < 0").count() == 0


def test_code_lists(spark):
    payment, rate = dim_payment_type(spark), dim_rate_code(spark)
    assert rows(payment) == [
        (1, "Credit card"),
        (2, "Cash"),
        (3, "No charge"),
        (4, "Dispute"),
        (5, "Unknown"),
        (6, "Voided trip"),
    ]
    assert dict(rows(rate))[99] == "Unknown" and rate.count() == 7
    assert payment.dtypes == [("payment_type", "int"), ("payment_type_desc", "string")]
    assert rate.dtypes == [("RateCodeID", "int"), ("rate_code_desc", "string")]
    assert not any(f.nullable for f in [*payment.schema.fields, *rate.schema.fields])


def test_counts_of_the_sample(trips, star):
    assert trips.count() == 6029
    assert ops.dedup_rows(trips).count() == 6000
    assert ops.duplicate_rows(trips).count() == 58
    assert [r["null_count"] for r in ops.null_counts(trips).collect()] == [98, 549]
    assert {r["column_name"]: r["negative_count"] for r in ops.negative_counts(trips).collect()} == {
        "fare_amount": 144,
        "tip_amount": 136,
        "tolls_amount": 17,
        "extra": 144,
        "mta_tax": 144,
        "improvement_surcharge": 144,
        "congestion_surcharge": 144,
        "airport_fee": 15,
        "total_amount": 131,
    }
    counts = {r["table_name"]: r["row_count"] for r in ops.table_counts(star).collect()}
    assert counts["fact_trips"] == 5369 and counts["dim_time"] == 5368


def test_table_sample(star):
    assert ops.table_sample(star["fact_trips"], 3).count() == 3
    assert ops.table_sample(star["fact_trips"]).columns == star["fact_trips"].columns
