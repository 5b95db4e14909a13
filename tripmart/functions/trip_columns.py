"""Column expressions derived from a trip. All are built-in and codegen'd."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pickup_hour() -> Column:
    return F.hour("tpep_pickup_datetime")


def pickup_date() -> Column:
    return F.to_date("tpep_pickup_datetime")


def pickup_day_of_week() -> Column:
    """English day name, e.g. Sunday."""
    return F.date_format("tpep_pickup_datetime", "EEEE")


def price_per_mile() -> Column:
    """Fare per mile; 0 when the distance is missing, zero or negative."""
    rate = F.col("fare_amount") / F.col("trip_distance")
    return F.when(F.col("trip_distance") > 0, F.round(rate, 2)).otherwise(F.lit(0.0))


def trip_duration_minutes() -> Column:
    """Minutes from pickup to dropoff in whole seconds; negative if they are swapped."""
    seconds = F.unix_timestamp("tpep_dropoff_datetime") - F.unix_timestamp("tpep_pickup_datetime")
    return F.round(seconds / 60, 2)


def tip_ratio() -> Column:
    """Tip as a share of the fare; null, so left out of averages, without a positive fare."""
    return F.col("tip_amount") / F.when(F.col("fare_amount") > 0, F.col("fare_amount"))


def location_key(column: str) -> Column:
    """Zone ids are text in the lookup and numbers in the trips; bad text matches nothing."""
    return F.col(column).try_cast("bigint")
