from __future__ import annotations

from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tripmart.sources import (
    MONTH_FOLDER,
    canonical_names,
    canonical_types,
    month_path,
    months_between,
    read_trip_months,
    read_trips,
    read_zones,
)


@pytest.mark.parametrize("month", [8, "8", "08"])
def test_month_path(month):
    assert month_path("/in/", 2021, month) == "/in/yellow_tripdata_2021-08.parquet"
    assert month_path("/in", "2021", month, MONTH_FOLDER) == "/in/year=2021/month=08"


@pytest.mark.parametrize("month", [0, 13])
def test_month_out_of_range(month):
    with pytest.raises(ValueError, match="1 to 12"):
        month_path("/in", 2021, month)


def test_only_the_asked_month_is_read(spark, trips, tmp_path):
    trips.limit(10).write.parquet(f"{tmp_path}/yellow_tripdata_2021-08.parquet")
    trips.limit(20).write.parquet(f"{tmp_path}/yellow_tripdata_2021-09.parquet")
    august = read_trips(spark, str(tmp_path), 2021, 8)
    assert august.count() == 10
    assert august.columns == trips.columns
    assert all("2021-08" in name for name in august.inputFiles())


def test_missing_month_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="2021-07"):
        read_trips(spark, str(tmp_path), 2021, 7)


def test_a_range_of_months_is_the_union_of_its_months(spark, trips, tmp_path):
    kinds = [{}, {"VendorID": "int", "RatecodeID": "bigint"}, {}, {"VendorID": "int", "RatecodeID": "bigint"}]
    months = months_between((2020, 11), (2021, 2))
    assert months == [(2020, 11), (2020, 12), (2021, 1), (2021, 2)]
    for i, ((year, month), casts) in enumerate(zip(months, kinds, strict=True)):
        df = trips.filter(F.col("payment_type") == i).withColumns({c: F.col(c).cast(k) for c, k in casts.items()})
        df = df.withColumnRenamed("airport_fee", "Airport_fee") if i == 2 else df
        df = df.withColumn("more", F.lit(i)) if i == 3 else df
        df.write.parquet(month_path(str(tmp_path), year, month))
    Path(month_path(str(tmp_path), 2021, 3)).write_text("not a file of trips")
    found = read_trip_months(spark, str(tmp_path), months[0], months[-1])
    united = None
    for month in months:
        own = read_trips(spark, str(tmp_path), *month)
        united = own if united is None else united.unionByName(own, allowMissingColumns=True)
    assert found.dtypes == united.dtypes and rows(found) == rows(united)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 4  # every month has another schema but two, and one has a further column
    two = read_trip_months(spark, str(tmp_path), months[0], months[1])
    assert two._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 2
    assert all("2020-1" in name for name in two.inputFiles())


def test_months_of_one_schema_are_one_scan(spark, trips, tmp_path):
    for month in (1, 2, 3):
        trips.limit(month).write.parquet(month_path(str(tmp_path), 2021, month))
    found = read_trip_months(spark, str(tmp_path), (2021, 1), (2021, 3))
    assert found.count() == 6 and found._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    with pytest.raises(FileNotFoundError, match="2021-04.*2021-05"):
        read_trip_months(spark, str(tmp_path), (2021, 1), (2021, 5))
    with pytest.raises(ValueError, match="after"):
        read_trip_months(spark, str(tmp_path), (2021, 2), (2021, 1))


def test_names_get_one_spelling(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3)], ["Airport_fee", "RateCodeID", "Extra_column"])
    assert canonical_names(df).columns == ["airport_fee", "RatecodeID", "Extra_column"]


def test_types_get_one_form(spark, tmp_path):
    df = spark.sql(
        "SELECT CAST(1 AS INT) AS VendorID, CAST(2 AS BIGINT) AS RatecodeID, CAST(NULL AS BIGINT) AS passenger_count,"
        " 5.0D AS PULocationID, '7' AS payment_type, TIMESTAMP '2021-08-01 00:00:00' AS tpep_pickup_datetime, 1 AS extra_one"
    )
    typed = canonical_types(df)
    assert dict(typed.dtypes) == {
        "VendorID": "bigint",
        "RatecodeID": "double",
        "passenger_count": "double",
        "PULocationID": "bigint",
        "payment_type": "bigint",
        "tpep_pickup_datetime": "timestamp",
        "extra_one": "int",
    }
    assert rows(typed.drop("tpep_pickup_datetime")) == [(1, 2.0, None, 5, 7, 1)]


@pytest.mark.parametrize("value", ["1.5D", "'x'", "1e300D"])
def test_a_value_that_does_not_fit_raises(spark, value):
    with pytest.raises(Exception, match="VendorID does not fit"):
        canonical_types(spark.sql(f"SELECT {value} AS VendorID")).collect()


def test_zones_are_text(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text(
        '"LocationID","Borough","Zone","service_zone"\n'
        '1,"EWR","Newark Airport","EWR"\n'
        '2,"Queens","Jamaica Bay, east","Boro Zone"\n'
        "264,,,\n"
    )
    zones = read_zones(spark, str(path))
    assert zones.dtypes == [
        ("location_id", "string"),
        ("borough", "string"),
        ("zone", "string"),
        ("service_zone", "string"),
    ]
    assert rows(zones) == [
        ("1", "EWR", "Newark Airport", "EWR"),
        ("2", "Queens", "Jamaica Bay, east", "Boro Zone"),
        ("264", None, None, None),
    ]
