"""Names and fixed values of the trip mart.

The values below are fixed by the trip-record format and must not change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# Raw trip columns, in file order, in their canonical spelling.
TRIP_COLUMNS = [
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "RatecodeID",
    "store_and_fwd_flag",
    "PULocationID",
    "DOLocationID",
    "payment_type",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    "airport_fee",
]

# Types of the raw trip columns. Times may be with or without zone.
TRIP_TYPES = {
    "VendorID": "bigint",
    "tpep_pickup_datetime": "timestamp_ntz",
    "tpep_dropoff_datetime": "timestamp_ntz",
    "passenger_count": "double",
    "trip_distance": "double",
    "RatecodeID": "double",
    "store_and_fwd_flag": "string",
    "PULocationID": "bigint",
    "DOLocationID": "bigint",
    "payment_type": "bigint",
    "fare_amount": "double",
    "extra": "double",
    "mta_tax": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "improvement_surcharge": "double",
    "total_amount": "double",
    "congestion_surcharge": "double",
    "airport_fee": "double",
}

# Columns of the trip fact, in order.
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

# Columns that must be present in a usable trip.
REQUIRED_COLUMNS = ["trip_distance", "total_amount"]

# Money columns, kept non-negative in the mart.
CURRENCY_COLUMNS = [
    "fare_amount",
    "tip_amount",
    "tolls_amount",
    "extra",
    "mta_tax",
    "improvement_surcharge",
    "congestion_surcharge",
    "airport_fee",
    "total_amount",
]

# Zone lookup columns in the CSV, and their names in the mart.
ZONE_COLUMNS = {
    "LocationID": "location_id",
    "Borough": "borough",
    "Zone": "zone",
    "service_zone": "service_zone",
}

# Payment type codes.
PAYMENT_TYPES = [
    (1, "Credit card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (6, "Voided trip"),
]

# Rate codes.
RATE_CODES = [
    (1, "Standard rate"),
    (2, "JFK"),
    (3, "Newark"),
    (4, "Nassau or Westchester"),
    (5, "Negotiated fare"),
    (6, "Group ride"),
    (99, "Unknown"),
]

# Fixed value: a load that keeps less than this share of its rows deserves a look.
RETENTION_WARNING_PCT = 85.0

# Tables of the star schema.
STAR_TABLES = [
    "dim_time",
    "dim_taxi_zone",
    "dim_payment_type",
    "dim_rate_code",
    "fact_trips",
]


def resolve(df: DataFrame, name: str) -> str | None:
    """The spelling `df` uses for column `name`, ignoring case; None if absent."""
    wanted = name.lower()
    return next((c for c in df.columns if c.lower() == wanted), None)


def quoted(name: str) -> str:
    """`name` as one SQL identifier, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"
