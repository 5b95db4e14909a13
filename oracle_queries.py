"""The registered queries once more, as SQL for DuckDB over the driver's tables.

Written from the definition of each operator, not from the Spark plans: the
reports join the fact to the dimensions row by row, and repeated rows are found
with a window.
"""

from __future__ import annotations

# Code lists, names and order of columns.
PAYMENT_TYPES = """
    SELECT * FROM (VALUES (1, 'Credit card'), (2, 'Cash'), (3, 'No charge'), (4, 'Dispute'),
        (5, 'Unknown'), (6, 'Voided trip')) AS t(payment_type, payment_type_desc)
"""

RATE_CODES = """
    SELECT * FROM (VALUES (1, 'Standard rate'), (2, 'JFK'), (3, 'Newark'),
        (4, 'Nassau or Westchester'), (5, 'Negotiated fare'), (6, 'Group ride'),
        (99, 'Unknown')) AS t(RateCodeID, rate_code_desc)
"""

ZONES = """
    SELECT CAST(n_nationkey AS VARCHAR) AS location_id,
        CASE WHEN n_nationkey <> 24 THEN r_name END AS borough,
        CASE WHEN n_nationkey <> 24 THEN n_name END AS zone,
        CASE WHEN n_nationkey % 2 = 0 THEN 'Yellow Zone' ELSE 'Boro Zone' END AS service_zone
    FROM nation JOIN region ON n_regionkey = r_regionkey
"""

BASE = """
    SELECT *,
        CASE WHEN l_returnflag = 'R' AND l_partkey % 13 = 0 THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END AS sgn,
        CAST(floor(l_extendedprice / 10) AS DOUBLE) / 100 AS amt,
        (l_orderkey * 37 + l_linenumber * 1009 + l_partkey * 13) % 86400 AS start_second
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN supplier ON l_suppkey = s_suppkey
    JOIN customer ON o_custkey = c_custkey
"""

ONCE = """
    SELECT l_orderkey % 200 = 0 AS twice,
        CAST(1 + l_linenumber % 2 AS BIGINT) AS VendorID,
        o_orderdate + to_seconds(start_second) AS tpep_pickup_datetime,
        o_orderdate + to_seconds(start_second + (l_partkey * 7 + l_suppkey * 11) % 5400)
            AS tpep_dropoff_datetime,
        CAST(CASE WHEN l_suppkey % 9 = 7 THEN NULL ELSE l_linenumber % 6 END AS DOUBLE)
            AS passenger_count,
        CASE WHEN l_partkey % 97 = 0 THEN NULL WHEN l_partkey % 41 = 0 THEN 0.0::DOUBLE
            ELSE l_quantity / 4 END AS trip_distance,
        CAST(CASE l_suppkey % 9 WHEN 6 THEN 99 WHEN 7 THEN NULL WHEN 8 THEN 1 WHEN 0 THEN 1
            ELSE l_suppkey % 9 END AS DOUBLE) AS RatecodeID,
        CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
        CAST(CASE WHEN l_suppkey % 50 = 0 THEN 999 ELSE s_nationkey END AS BIGINT) AS PULocationID,
        CAST(c_nationkey AS BIGINT) AS DOLocationID,
        CAST(l_linenumber % 7 AS BIGINT) AS payment_type,
        sgn * amt AS fare_amount,
        sgn * 0.5::DOUBLE AS extra,
        sgn * 0.5::DOUBLE AS mta_tax,
        sgn * amt * l_discount + 0.0::DOUBLE AS tip_amount,
        CASE WHEN l_linenumber = 3 THEN sgn * 6.5::DOUBLE ELSE 0.0::DOUBLE END AS tolls_amount,
        sgn * 0.3::DOUBLE AS improvement_surcharge,
        CASE WHEN l_suppkey % 89 = 0 THEN NULL
            ELSE sgn * (amt + amt * l_discount + 3.8::DOUBLE) END AS total_amount,
        sgn * 2.5::DOUBLE AS congestion_surcharge,
        CASE WHEN l_linenumber = 5 THEN sgn * 1.25::DOUBLE ELSE 0.0::DOUBLE END AS airport_fee
    FROM base
"""

TRIPS = """
    SELECT * EXCLUDE (twice) FROM once
    UNION ALL
    SELECT * EXCLUDE (twice) FROM once WHERE twice
"""

ABSOLUTE = """* REPLACE (
        abs(fare_amount) AS fare_amount, abs(tip_amount) AS tip_amount,
        abs(tolls_amount) AS tolls_amount, abs(extra) AS extra, abs(mta_tax) AS mta_tax,
        abs(improvement_surcharge) AS improvement_surcharge,
        abs(congestion_surcharge) AS congestion_surcharge, abs(airport_fee) AS airport_fee,
        abs(total_amount) AS total_amount)"""

CLEAN = f"""
    SELECT {ABSOLUTE} FROM (SELECT DISTINCT * FROM trips)
    WHERE trip_distance IS NOT NULL AND total_amount IS NOT NULL
"""

# Rounding goes through decimal text, as plain round differs on exact halves.
ENRICHED = """
    SELECT *,
        CAST(hour(tpep_pickup_datetime) AS INT) AS pickup_hour,
        CAST(tpep_pickup_datetime AS DATE) AS pickup_date,
        dayname(tpep_pickup_datetime) AS pickup_day_of_week,
        CASE WHEN trip_distance > 0 THEN CAST(round(CAST(CAST(fare_amount / trip_distance
            AS VARCHAR) AS DECIMAL(38, 18)), 2) AS DOUBLE) ELSE 0.0::DOUBLE END AS price_per_mile,
        round(date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) / 60.0::DOUBLE, 2)
            AS trip_duration_minutes
    FROM clean
"""

DIM_TIME = """
    SELECT DISTINCT tpep_pickup_datetime, pickup_hour, pickup_date, pickup_day_of_week
    FROM enriched
"""

FACT_COLUMNS = """VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, PULocationID, DOLocationID,
    passenger_count, payment_type, RatecodeID AS RateCodeID, trip_distance, fare_amount,
    tip_amount, total_amount, trip_duration_minutes, price_per_mile"""

# Every relation a query may name, each built on the ones before it.
RELATIONS = {
    "base": BASE,
    "once": ONCE,
    "trips": TRIPS,
    "clean": CLEAN,
    "enriched": ENRICHED,
    "dim_time": DIM_TIME,
    "fact": f"SELECT {FACT_COLUMNS} FROM enriched",
    "dim_taxi_zone": ZONES,
    "dim_payment_type": PAYMENT_TYPES,
    "dim_rate_code": RATE_CODES,
}


def _sql(query: str) -> str:
    relations = ",\n".join(f"{name} AS ({body})" for name, body in RELATIONS.items())
    return f"WITH {relations}\n{query}"


def _counts(columns: list[str], test: str, count_name: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} {test}) AS {count_name}, "
        f"true AS found FROM trips"
        for c in columns
    )


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

BUSIEST_HOURS = """
    SELECT pickup_hour, count(*) AS trip_count
    FROM fact f JOIN dim_time t ON f.tpep_pickup_datetime = t.tpep_pickup_datetime
    GROUP BY pickup_hour ORDER BY trip_count DESC, pickup_hour
"""


def _exact_sum(x: str) -> str:
    """The sum by whole numbers and two 40-bit parts of the fraction, each added up as integers."""
    step = "1099511627776::DOUBLE"
    high = f"({x} - trunc({x})) * {step}"
    parts = [f"trunc({x})", f"trunc({high})", f"trunc(({high} - trunc({high})) * {step})"]
    whole, high, low = (f"CAST(sum(CAST({part} AS HUGEINT)) AS DOUBLE)" for part in parts)
    return f"({whole} + ({high} / {step} + {low} / ({step} * {step})))"


def _exact_mean(x: str) -> str:
    return f"{_exact_sum(x)} / count({x})"


def _popular_zones(key: str, count_name: str) -> str:
    return f"""
        SELECT location_id, borough, zone, service_zone, count(*) AS {count_name},
            {_exact_mean("trip_distance")} AS avg_distance, {_exact_mean("fare_amount")} AS avg_fare,
            {_exact_sum("total_amount")} AS total_revenue
        FROM fact JOIN dim_taxi_zone ON {key} = CAST(location_id AS BIGINT)
        GROUP BY location_id, borough, zone, service_zone
        ORDER BY {count_name} DESC, location_id LIMIT 10
    """


QUERIES = {
    "load_trips": "SELECT * FROM trips",
    "dedup_rows": "SELECT DISTINCT * FROM trips",
    "duplicate_rows": """
        SELECT * FROM trips QUALIFY count(*) OVER (PARTITION BY VendorID, tpep_pickup_datetime,
            tpep_dropoff_datetime, passenger_count, trip_distance, RatecodeID, store_and_fwd_flag,
            PULocationID, DOLocationID, payment_type, fare_amount, extra, mta_tax, tip_amount,
            tolls_amount, improvement_surcharge, total_amount, congestion_surcharge,
            airport_fee) > 1
    """,
    "duplicate_summary": """
        SELECT a.n AS original_count, d.n AS distinct_count, a.n - d.n AS duplicate_count
        FROM (SELECT count(*) AS n FROM trips) a,
            (SELECT count(*) AS n FROM (SELECT DISTINCT * FROM trips)) d
    """,
    "drop_null_rows": """
        SELECT * FROM trips WHERE trip_distance IS NOT NULL AND total_amount IS NOT NULL
    """,
    "null_counts": _counts(["trip_distance", "total_amount"], "IS NULL", "null_count"),
    "null_counts_from_footers": _counts(["trip_distance", "total_amount"], "IS NULL", "null_count"),
    "abs_amounts": f"SELECT {ABSOLUTE} FROM trips",
    "negative_counts": _counts(CURRENCY_COLUMNS, "< 0", "negative_count"),
    "negative_counts_from_footers": _counts(CURRENCY_COLUMNS, "< 0", "negative_count"),
    "enrich_trips": "SELECT * FROM enriched",
    "dim_time": "SELECT * FROM dim_time",
    "fact_trips": "SELECT * FROM fact",
    "dim_taxi_zone": "SELECT * FROM dim_taxi_zone",
    "load_by_month": "SELECT * FROM fact",
    "dim_time_by_month": "SELECT * FROM dim_time",
    "table_sample": "SELECT * FROM dim_taxi_zone ORDER BY location_id LIMIT 5",
    "quality_report": """
        SELECT r.n AS initial_count, c.n AS final_count,
            CAST(c.n AS DOUBLE) / r.n * 100 AS retention_pct,
            CAST(c.n AS DOUBLE) / r.n * 100 < 85 AS low_retention
        FROM (SELECT count(*) AS n FROM trips) r, (SELECT count(*) AS n FROM clean) c
    """,
    "pickup_boroughs": """
        SELECT borough AS pickup_borough, count(*) AS trip_count,
            round(avg(total_amount), 2) AS avg_fare, round(sum(total_amount), 2) AS total_revenue
        FROM fact LEFT JOIN dim_taxi_zone ON PULocationID = CAST(location_id AS BIGINT)
        WHERE borough IS NOT NULL
        GROUP BY borough ORDER BY trip_count DESC, pickup_borough
    """,
    "top_routes_by_revenue": """
        SELECT p.zone AS pickup_zone, d.zone AS dropoff_zone, count(*) AS trip_count,
            round(avg(trip_distance), 2) AS avg_distance,
            round(avg(trip_duration_minutes), 2) AS avg_duration,
            round(sum(total_amount), 2) AS total_revenue
        FROM fact
        LEFT JOIN dim_taxi_zone p ON PULocationID = CAST(p.location_id AS BIGINT)
        LEFT JOIN dim_taxi_zone d ON DOLocationID = CAST(d.location_id AS BIGINT)
        WHERE p.zone IS NOT NULL AND d.zone IS NOT NULL
        GROUP BY p.zone, d.zone
        ORDER BY total_revenue DESC, pickup_zone, dropoff_zone LIMIT 10
    """,
    "payment_metrics": """
        SELECT payment_type_desc, count(*) AS trip_count,
            round(avg(trip_distance), 2) AS avg_distance, round(avg(fare_amount), 2) AS avg_fare,
            round(avg(tip_amount), 2) AS avg_tip,
            round(avg(tip_amount / CASE WHEN fare_amount > 0 THEN fare_amount END) * 100, 2)
                AS tip_percentage
        FROM fact f
        LEFT JOIN dim_payment_type t ON f.payment_type = t.payment_type
        GROUP BY payment_type_desc ORDER BY trip_count DESC, payment_type_desc
    """,
    "rate_code_metrics": """
        SELECT rate_code_desc, count(*) AS trip_count,
            round(avg(trip_distance), 2) AS avg_distance,
            round(avg(trip_duration_minutes), 2) AS avg_duration,
            round(avg(price_per_mile), 2) AS avg_price_per_mile,
            round(sum(total_amount), 2) AS total_revenue
        FROM fact f
        LEFT JOIN dim_rate_code r ON f.RateCodeID = r.RateCodeID
        GROUP BY rate_code_desc ORDER BY trip_count DESC, rate_code_desc
    """,
    "busiest_hours": BUSIEST_HOURS,
    "busiest_hours_by_join": BUSIEST_HOURS,
    "busiest_hours_by_buckets": BUSIEST_HOURS,
    "payment_analysis": """
        SELECT t.payment_type, payment_type_desc, count(*) AS trip_count,
            round(avg(fare_amount), 2) AS avg_fare, round(avg(tip_amount), 2) AS avg_tip,
            round(sum(total_amount), 2) AS total_revenue
        FROM fact f JOIN dim_payment_type t ON f.payment_type = t.payment_type
        GROUP BY t.payment_type, payment_type_desc ORDER BY trip_count DESC, t.payment_type
    """,
    "rate_code_analysis": """
        SELECT rate_code_desc, count(*) AS trip_count,
            round(avg(trip_distance), 2) AS avg_distance, round(avg(total_amount), 2) AS avg_fare,
            round(sum(total_amount), 2) AS total_revenue
        FROM fact f JOIN dim_rate_code r ON f.RateCodeID = r.RateCodeID
        GROUP BY rate_code_desc ORDER BY trip_count DESC, rate_code_desc
    """,
    "payment_by_rate": """
        SELECT rate_code_desc, payment_type_desc, count(*) AS count
        FROM fact f
        JOIN dim_payment_type t ON f.payment_type = t.payment_type
        JOIN dim_rate_code r ON f.RateCodeID = r.RateCodeID
        GROUP BY rate_code_desc, payment_type_desc
        ORDER BY rate_code_desc, count DESC, payment_type_desc
    """,
    "popular_pickups": _popular_zones("PULocationID", "pickup_count"),
    "popular_dropoffs": _popular_zones("DOLocationID", "dropoff_count"),
    "popular_routes": f"""
        SELECT PULocationID AS pickup_id, DOLocationID AS dropoff_id, count(*) AS trip_count,
            {_exact_mean("trip_distance")} AS avg_distance,
            {_exact_mean("trip_duration_minutes")} AS avg_duration,
            {_exact_sum("total_amount")} AS total_revenue
        FROM fact GROUP BY PULocationID, DOLocationID
        ORDER BY trip_count DESC, pickup_id, dropoff_id LIMIT 10
    """,
    "table_counts": """
        SELECT 'fact_trips' AS table_name, count(*) AS row_count FROM fact
        UNION ALL SELECT 'dim_time', count(*) FROM dim_time
        UNION ALL SELECT 'dim_taxi_zone', count(*) FROM dim_taxi_zone
        UNION ALL SELECT 'dim_payment_type', count(*) FROM dim_payment_type
        UNION ALL SELECT 'dim_rate_code', count(*) FROM dim_rate_code
    """,
}


REPORTS = [
    "pickup_boroughs",
    "top_routes_by_revenue",
    "payment_metrics",
    "rate_code_metrics",
    "busiest_hours",
    "payment_analysis",
    "rate_code_analysis",
    "payment_by_rate",
    "popular_pickups",
    "popular_dropoffs",
    "popular_routes",
]

QUERIES |= {
    **{f"{name}_from_totals": QUERIES[name] for name in REPORTS},
    "trip_ids": f"""
        SELECT row_number() OVER (ORDER BY tpep_pickup_datetime NULLS FIRST, VendorID NULLS FIRST,
            tpep_dropoff_datetime NULLS FIRST, PULocationID NULLS FIRST, DOLocationID NULLS FIRST,
            passenger_count NULLS FIRST, payment_type NULLS FIRST, RateCodeID NULLS FIRST,
            trip_distance NULLS FIRST, fare_amount NULLS FIRST, tip_amount NULLS FIRST,
            total_amount NULLS FIRST, trip_duration_minutes NULLS FIRST, price_per_mile NULLS FIRST) - 1 AS trip_id, *
        FROM (SELECT {FACT_COLUMNS} FROM enriched)
    """,
    "load_trip_months": QUERIES["load_trips"],
    "dedup_by_digest": QUERIES["dedup_rows"],
    "duplicates_by_digest": QUERIES["duplicate_rows"],
    "summary_by_digest": QUERIES["duplicate_summary"],
    "catalog_reports": f"""
        SELECT 'busiest_hours' AS report, CAST(hour(tpep_pickup_datetime) AS VARCHAR) AS key, count(*) AS trips
        FROM fact GROUP BY hour(tpep_pickup_datetime)
        UNION ALL SELECT 'payment_analysis', payment_type_desc, count(*)
        FROM fact f JOIN dim_payment_type t ON f.payment_type = t.payment_type GROUP BY payment_type_desc
        UNION ALL SELECT 'pickup_boroughs', borough, count(*)
        FROM fact JOIN dim_taxi_zone ON PULocationID = CAST(location_id AS BIGINT)
        WHERE borough IS NOT NULL GROUP BY borough
        UNION ALL SELECT 'table_counts', table_name, row_count FROM ({QUERIES["table_counts"]})
    """,
}


def oracle_sql() -> dict[str, str]:
    return {name: _sql(query) for name, query in QUERIES.items()}
