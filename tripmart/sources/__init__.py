from tripmart.sources.lookups import dim_payment_type, dim_rate_code, dim_taxi_zone, read_zones
from tripmart.sources.trips import (
    MONTH_FILE,
    MONTH_FOLDER,
    canonical_names,
    canonical_types,
    month_path,
    months_between,
    read_trip_months,
    read_trips,
)

__all__ = [
    "MONTH_FILE",
    "MONTH_FOLDER",
    "canonical_names",
    "canonical_types",
    "dim_payment_type",
    "dim_rate_code",
    "dim_taxi_zone",
    "month_path",
    "months_between",
    "read_trip_months",
    "read_trips",
    "read_zones",
]
