"""The star schema: trip fact and time dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from tripmart import functions as T
from tripmart.operators.enrich import enrich_trips
from tripmart.operators.quality import abs_amounts, dedup_rows, drop_null_rows
from tripmart.schema import FACT_COLUMNS


def dim_time(trips: DataFrame) -> DataFrame:
    """One row per distinct pickup time, with its hour, date and day name.

    The other columns follow from the time, so only the time is shuffled. Any
    frame with the pickup time will do: raw trips, enriched trips or the fact.
    """
    times = trips.select("tpep_pickup_datetime").distinct()
    return times.withColumns(
        {
            "pickup_hour": T.pickup_hour(),
            "pickup_date": T.pickup_date(),
            "pickup_day_of_week": T.pickup_day_of_week(),
        }
    )


def fact_trips(enriched: DataFrame) -> DataFrame:
    """The trip fact. `trip_id` is unique but new on every evaluation: write it once."""
    trips = enriched.withColumnRenamed("RatecodeID", "RateCodeID")
    return trips.withColumn("trip_id", F.monotonically_increasing_id()).select(*FACT_COLUMNS)


def zoneless(trips: DataFrame, time_zone: str) -> DataFrame:
    """Zoned times become the local time of `time_zone`, whatever the session's zone is; others stay.

    Hours and dates of the result are the same in every session. Durations are
    to be taken before: local times jump when clocks change.
    """
    start = F.lit("1970-01-01").cast("timestamp_ntz")

    def local(name: str) -> Column:
        seconds = (F.unix_micros(name).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
        utc = start + F.make_dt_interval(secs=seconds)
        return utc if time_zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(time_zone), utc)

    zoned = [f.name for f in trips.schema.fields if isinstance(f.dataType, TimestampType)]
    return trips.withColumns({name: local(name) for name in zoned}) if zoned else trips


def clean_trips(raw: DataFrame) -> DataFrame:
    """Raw trips without repeated and incomplete rows, amounts made non-negative."""
    return normalise(dedup_rows(raw))


def normalise(distinct_trips: DataFrame) -> DataFrame:
    """`clean_trips` for an input that has no repeated rows."""
    return abs_amounts(drop_null_rows(distinct_trips))


def enriched_trips(raw: DataFrame) -> DataFrame:
    """Raw trips cleaned and with the derived columns."""
    return enrich_trips(clean_trips(raw))
