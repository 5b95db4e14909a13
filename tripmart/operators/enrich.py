"""Derived trip columns."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tripmart import functions as T


def enrich_trips(df: DataFrame) -> DataFrame:
    """Append pickup hour, date and day name, price per mile and duration."""
    return df.withColumns(
        {
            "pickup_hour": T.pickup_hour(),
            "pickup_date": T.pickup_date(),
            "pickup_day_of_week": T.pickup_day_of_week(),
            "price_per_mile": T.price_per_mile(),
            "trip_duration_minutes": T.trip_duration_minutes(),
        }
    )
