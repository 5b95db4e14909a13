"""Trip-shaped data derived from order tables, for tests and benchmarks.

The tables `lineitem orders customer supplier nation region` are joined and
their columns mapped to raw trips and to the zone lookup, nulls, negative
amounts, unknown codes and repeated rows included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.schema import TRIP_COLUMNS

# How each trip column follows from the joined order tables.
TRIP_EXPRESSIONS = {
    "VendorID": "CAST(1 + l_linenumber % 2 AS BIGINT)",
    "tpep_pickup_datetime": "o_orderdate + make_dt_interval(0, 0, 0, start_second)",
    "tpep_dropoff_datetime": """
        o_orderdate
        + make_dt_interval(0, 0, 0, start_second + (l_partkey * 7 + l_suppkey * 11) % 5400)""",
    "passenger_count": """
        CAST(CASE WHEN l_suppkey % 9 = 7 THEN NULL ELSE l_linenumber % 6 END AS DOUBLE)""",
    "trip_distance": """
        CASE WHEN l_partkey % 97 = 0 THEN NULL
            WHEN l_partkey % 41 = 0 THEN CAST(0 AS DOUBLE) ELSE l_quantity / 4 END""",
    "RatecodeID": """
        CAST(CASE l_suppkey % 9 WHEN 6 THEN 99 WHEN 7 THEN NULL WHEN 8 THEN 1 WHEN 0 THEN 1
            ELSE l_suppkey % 9 END AS DOUBLE)""",
    "store_and_fwd_flag": "CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END",
    "PULocationID": "CAST(CASE WHEN l_suppkey % 50 = 0 THEN 999 ELSE s_nationkey END AS BIGINT)",
    "DOLocationID": "CAST(c_nationkey AS BIGINT)",
    "payment_type": "CAST(l_linenumber % 7 AS BIGINT)",
    "fare_amount": "sgn * amt",
    "extra": "sgn * CAST(0.5 AS DOUBLE)",
    "mta_tax": "sgn * CAST(0.5 AS DOUBLE)",
    "tip_amount": "sgn * amt * l_discount + CAST(0 AS DOUBLE)",
    "tolls_amount": """
        CASE WHEN l_linenumber = 3 THEN sgn * CAST(6.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END""",
    "improvement_surcharge": "sgn * CAST(0.3 AS DOUBLE)",
    "total_amount": """
        CASE WHEN l_suppkey % 89 = 0 THEN NULL
            ELSE sgn * (amt + amt * l_discount + CAST(3.8 AS DOUBLE)) END""",
    "congestion_surcharge": "sgn * CAST(2.5 AS DOUBLE)",
    "airport_fee": """
        CASE WHEN l_linenumber = 5 THEN sgn * CAST(1.25 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END""",
}


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def sample_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Raw trips derived from the order tables in `folder`.

    Customers meet the orders, not the several times larger line items. Orders
    grow with the lines, so those two are merged in a shuffle, which also
    spreads lines that come in few large row groups; AQE splits the partition
    of a hot order. Broadcasting the others is left to Spark, which checks
    their size.
    """
    lines = _read(spark, folder, "lineitem")
    orders = _read(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customers = _read(spark, folder, "customer").select("c_custkey", "c_nationkey")
    suppliers = _read(spark, folder, "supplier").select("s_suppkey", "s_nationkey")

    located = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    merged = lines.join(located.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    joined = merged.join(
        suppliers, F.col("l_suppkey") == F.col("s_suppkey")
    )
    returned = F.expr("l_returnflag = 'R' AND l_partkey % 13 = 0")
    sign = F.when(returned, F.lit(-1.0)).otherwise(F.lit(1.0))
    amount = F.expr("CAST(floor(l_extendedprice / 10) AS DOUBLE) / 100")
    start = F.expr("(l_orderkey * 37 + l_linenumber * 1009 + l_partkey * 13) % 86400")
    # Every two-hundredth order is delivered twice, as whole-row duplicates.
    copies = F.expr("explode(CASE WHEN l_orderkey % 200 = 0 THEN array(1, 2) ELSE array(1) END)")
    prepared = joined.withColumns({"sgn": sign, "amt": amount, "start_second": start})
    return prepared.withColumn("copy", copies).select(
        *[F.expr(TRIP_EXPRESSIONS[c]).alias(c) for c in TRIP_COLUMNS]
    )


def sample_zones(spark: SparkSession, folder: str) -> DataFrame:
    """The zone dimension derived from nations and regions."""
    nations = _read(spark, folder, "nation")
    regions = _read(spark, folder, "region")
    named = "CASE WHEN n_nationkey = 24 THEN NULL ELSE {} END"
    return nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("string").alias("location_id"),
        F.expr(named.format("r_name")).alias("borough"),
        F.expr(named.format("n_name")).alias("zone"),
        F.expr("CASE WHEN n_nationkey % 2 = 0 THEN 'Yellow Zone' ELSE 'Boro Zone' END").alias(
            "service_zone"
        ),
    )
