from tripmart.functions.exact import exact_parts, exact_sums, exact_total, from_limbs, limb_sums
from tripmart.functions.trip_columns import (
    location_key,
    pickup_date,
    pickup_day_of_week,
    pickup_hour,
    price_per_mile,
    tip_ratio,
    trip_duration_minutes,
)

__all__ = [
    "exact_parts",
    "exact_sums",
    "exact_total",
    "from_limbs",
    "limb_sums",
    "location_key",
    "pickup_date",
    "pickup_day_of_week",
    "pickup_hour",
    "price_per_mile",
    "tip_ratio",
    "trip_duration_minutes",
]
