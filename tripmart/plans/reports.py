"""The eleven reports over the star schema.

Each takes the tables by name and returns a lazy DataFrame. Trips are first
totalled per foreign key, before any join: the partial aggregation runs in the
scan stage, only totals are shuffled, and a key that holds a large share of the
trips is already one record per task. Joins then meet totals, whose number is
bounded by the keys and not by the trips, so no join touches the fact's rows.
Means are kept as sum and count until the last step, because several keys may
share one description. Sums are exact until then, so figures are the same however
the trips are partitioned. A mart by month can keep totals of each load month;
reports then add these up and do not read the fact.

Sorted reports break ties by their group keys.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart import functions as T

Tables = Mapping[str, DataFrame]


#: What reports add up for each trip, by name.
MEASURES: dict[str, Callable[[], Column]] = {
    "distance": lambda: F.col("trip_distance"),
    "duration": lambda: F.col("trip_duration_minutes"),
    "fare": lambda: F.col("fare_amount"),
    "tip": lambda: F.col("tip_amount"),
    "tip_ratio": T.tip_ratio,
    "price": lambda: F.col("price_per_mile"),
    "revenue": lambda: F.col("total_amount"),
}

#: The sets of keys by which reports total trips.
KEY_SETS = [
    ("PULocationID",),
    ("DOLocationID",),
    ("PULocationID", "DOLocationID"),
    ("payment_type",),
    ("RateCodeID",),
    ("payment_type", "RateCodeID"),
    ("pickup_hour",),
]

#: Table of totals by load month, and its column that tells by which keys.
TOTALS_TABLE, BY = "trip_totals", "by"


def month_totals(fact: DataFrame, months: list[str]) -> DataFrame:
    """Totals of all measures by each set of keys and the columns `months`, to which those of more trips can be added.

    Every trip is read once. It is counted for each set of keys that lies in no
    other before anything is shuffled, so what is shuffled is bounded by the keys
    and not the trips. The other sets add up the totals of one that holds them.
    Sums are in exact parts.
    """
    keys = list(dict.fromkeys(k for own in KEY_SETS for k in own))
    finest = [own for own in KEY_SETS if not any(set(own) < set(other) for other in KEY_SETS)]
    hour = F.when(F.col("tpep_pickup_datetime").isNotNull(), T.pickup_hour())
    rows = fact.select(*months, *[hour.alias(k) if k == "pickup_hour" else k for k in keys], *_measured())
    sets = [[*months, *own] for own in finest]
    names = F.grouping_id()  # a bit for each column that a set does not have
    grouped = rows.groupingSets(sets, *months, *keys).agg(names.alias("set"), *_counts({m: F.col(m) for m in MEASURES}))

    def coarser(whole: tuple[str, ...]) -> Column:
        held = [own for own in KEY_SETS if next(f for f in finest if set(own) <= set(f)) == whole]
        kept = lambda own: [F.when(F.lit(k in own), F.col(k)).alias(k) for k in keys]
        return F.array(*[F.struct(F.lit(",".join(own)).alias(BY), *kept(own)) for own in held])

    bits = {own: sum(1 << (len(keys) - 1 - i) for i, c in enumerate(keys) if c not in own) for own in finest}
    groups = F.coalesce(*[F.when(F.col("set") == bits[own], coarser(own)) for own in finest])
    totals = grouped.select(F.explode(groups).alias("own"), *months, *_summed(MEASURES)).select("own.*", *months, "trips", *_parts())
    added = {c: F.sum(c) for c in ("trips", *_parts())}
    added = [a.cast("decimal(29,0)").alias(c) if c.endswith(("_whole", "_high", "_low")) else a.alias(c) for c, a in added.items()]
    return totals.groupBy(BY, *keys, *months).agg(*added).select(BY, *keys, "trips", *_parts(), *months)


def _counts(values: Mapping[str, Column]) -> list[Column]:
    """Aggregates for trips and measures, from which `_summed` makes the sums in exact parts."""
    return [F.count(F.lit(1)).alias("trips"), *[a for m, v in values.items() for a in (*T.limb_sums(m, v), F.count(v).alias(f"{m}_n"))]]


def _summed(measures: Iterable[str]) -> list[Column]:
    return [F.col("trips"), *[c for m in measures for c in (*T.from_limbs(m), F.col(f"{m}_n"))]]


def _measured() -> list[Column]:
    return [measure().alias(name) for name, measure in MEASURES.items()]


def _parts() -> list[str]:
    return [f"{m}_{part}" for m in MEASURES for part in ("whole", "high", "low", "other", "n")]


def totals_per_key(tables: Tables, keys: list[str], *measures: str) -> DataFrame:
    """Trip count, and sum in exact parts and non-null count of every measure, per key; see `functions.exact`.

    Totals that are kept by load month are added up, if the mart has them; then the fact is not read.
    """
    if TOTALS_TABLE in tables:
        kept = tables[TOTALS_TABLE].filter(F.col(BY) == ",".join(keys))
        parts = [f"{m}_{part}" for m in measures for part in ("whole", "high", "low", "other", "n")]
        return kept.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("trips", *parts)])
    totals = tables["fact_trips"].groupBy(*keys).agg(*_counts({m: MEASURES[m]() for m in measures}))
    return totals.select(*keys, *_summed(measures))


def trip_count() -> Column:
    return F.sum("trips")


def total(measure: str) -> Column:
    return T.exact_total(measure)


def mean(measure: str) -> Column:
    return F.try_divide(T.exact_total(measure), F.sum(f"{measure}_n"))


def _by_payment(totals: DataFrame, tables: Tables, how: str) -> DataFrame:
    codes = tables["dim_payment_type"].withColumnRenamed("payment_type", "code")
    codes = codes.withColumn("key", F.col("code").cast("bigint"))
    return totals.join(codes, totals["payment_type"] == codes["key"], how)


def _by_rate(totals: DataFrame, tables: Tables, how: str) -> DataFrame:
    codes = tables["dim_rate_code"].withColumn("rate_key", F.col("RateCodeID").cast("double"))
    codes = codes.drop("RateCodeID")
    return totals.join(codes, totals["RateCodeID"] == codes["rate_key"], how)


def _zones(tables: Tables, role: str) -> DataFrame:
    """The zone dimension in one role: its columns prefixed, and its id as a number."""
    zones = tables["dim_taxi_zone"]
    return zones.select(
        T.location_key("location_id").alias(f"{role}_key"),
        *[F.col(c).alias(f"{role}_{c}") for c in zones.columns],
    )


def pickup_boroughs(tables: Tables) -> DataFrame:
    """Trips per pickup borough; trips without a known borough are left out."""
    totals = totals_per_key(tables, ["PULocationID"], "revenue")
    zones = _zones(tables, "pickup").filter("pickup_borough IS NOT NULL")
    return (
        totals.join(zones, totals["PULocationID"] == zones["pickup_key"])
        .groupBy("pickup_borough")
        .agg(
            trip_count().alias("trip_count"),
            F.round(mean("revenue"), 2).alias("avg_fare"),
            F.round(total("revenue"), 2).alias("total_revenue"),
        )
        .orderBy(F.desc("trip_count"), "pickup_borough")
    )


def top_routes_by_revenue(tables: Tables, limit: int = 10) -> DataFrame:
    """The zone pairs that earn most."""
    totals = totals_per_key(
        tables,
        ["PULocationID", "DOLocationID"],
        "distance",
        "duration",
        "revenue",
    )
    pickup = _zones(tables, "pickup").filter("pickup_zone IS NOT NULL")
    dropoff = _zones(tables, "dropoff").filter("dropoff_zone IS NOT NULL")
    return (
        totals.join(pickup, totals["PULocationID"] == pickup["pickup_key"])
        .join(dropoff, totals["DOLocationID"] == dropoff["dropoff_key"])
        .groupBy("pickup_zone", "dropoff_zone")
        .agg(
            trip_count().alias("trip_count"),
            F.round(mean("distance"), 2).alias("avg_distance"),
            F.round(mean("duration"), 2).alias("avg_duration"),
            F.round(total("revenue"), 2).alias("total_revenue"),
        )
        .orderBy(F.desc("total_revenue"), "pickup_zone", "dropoff_zone")
        .limit(limit)
    )


def payment_metrics(tables: Tables) -> DataFrame:
    """Mean trip figures per payment type; unknown codes form a null group.

    `tip_percentage` is the mean of each trip's tip share, not the ratio of sums.
    """
    totals = totals_per_key(
        tables,
        ["payment_type"],
        "distance",
        "fare",
        "tip",
        "tip_ratio",
    )
    return (
        _by_payment(totals, tables, "left")
        .groupBy("payment_type_desc")
        .agg(
            trip_count().alias("trip_count"),
            F.round(mean("distance"), 2).alias("avg_distance"),
            F.round(mean("fare"), 2).alias("avg_fare"),
            F.round(mean("tip"), 2).alias("avg_tip"),
            F.round(mean("tip_ratio") * 100, 2).alias("tip_percentage"),
        )
        .orderBy(F.desc("trip_count"), "payment_type_desc")
    )


def rate_code_metrics(tables: Tables) -> DataFrame:
    """Trip figures per rate code; unknown codes form a null group."""
    totals = totals_per_key(
        tables,
        ["RateCodeID"],
        "distance",
        "duration",
        "price",
        "revenue",
    )
    return (
        _by_rate(totals, tables, "left")
        .groupBy("rate_code_desc")
        .agg(
            trip_count().alias("trip_count"),
            F.round(mean("distance"), 2).alias("avg_distance"),
            F.round(mean("duration"), 2).alias("avg_duration"),
            F.round(mean("price"), 2).alias("avg_price_per_mile"),
            F.round(total("revenue"), 2).alias("total_revenue"),
        )
        .orderBy(F.desc("trip_count"), "rate_code_desc")
    )


def busiest_hours(tables: Tables) -> DataFrame:
    """Trips per pickup hour, straight from the fact.

    The hour follows from the pickup time, which is also the key of `dim_time`,
    so the join is not needed: see `busiest_hours_by_join`.
    """
    if TOTALS_TABLE in tables:
        hours = totals_per_key(tables, ["pickup_hour"]).filter("pickup_hour IS NOT NULL")
        return hours.select("pickup_hour", F.col("trips").alias("trip_count")).orderBy(F.desc("trip_count"), "pickup_hour")
    return (
        tables["fact_trips"]
        .filter("tpep_pickup_datetime IS NOT NULL")
        .groupBy(T.pickup_hour().alias("pickup_hour"))
        .agg(F.count(F.lit(1)).alias("trip_count"))
        .orderBy(F.desc("trip_count"), "pickup_hour")
    )


def busiest_hours_by_join(tables: Tables) -> DataFrame:
    """Trips per pickup hour, with the hour looked up in `dim_time`.

    Both sides of the join can be large. Trips are counted per time first, which
    leaves both sides unique on the key; neither is broadcast by hint.
    """
    per_time = tables["fact_trips"].groupBy("tpep_pickup_datetime").agg(F.count(F.lit(1)).alias("trips"))
    hours = tables["dim_time"].select("tpep_pickup_datetime", "pickup_hour")
    return (
        per_time.join(hours, "tpep_pickup_datetime")
        .groupBy("pickup_hour")
        .agg(trip_count().alias("trip_count"))
        .orderBy(F.desc("trip_count"), "pickup_hour")
    )


def payment_analysis(tables: Tables) -> DataFrame:
    """Trips and money per known payment type."""
    totals = totals_per_key(
        tables,
        ["payment_type"],
        "fare",
        "tip",
        "revenue",
    )
    return (
        _by_payment(totals, tables, "inner")
        .groupBy(F.col("code").alias("payment_type"), "payment_type_desc")
        .agg(
            trip_count().alias("trip_count"),
            F.round(mean("fare"), 2).alias("avg_fare"),
            F.round(mean("tip"), 2).alias("avg_tip"),
            F.round(total("revenue"), 2).alias("total_revenue"),
        )
        .orderBy(F.desc("trip_count"), "payment_type")
    )


def rate_code_analysis(tables: Tables) -> DataFrame:
    """Trips and money per known rate code. `avg_fare` is the mean total amount."""
    totals = totals_per_key(tables, ["RateCodeID"], "distance", "revenue")
    return (
        _by_rate(totals, tables, "inner")
        .groupBy("rate_code_desc")
        .agg(
            trip_count().alias("trip_count"),
            F.round(mean("distance"), 2).alias("avg_distance"),
            F.round(mean("revenue"), 2).alias("avg_fare"),
            F.round(total("revenue"), 2).alias("total_revenue"),
        )
        .orderBy(F.desc("trip_count"), "rate_code_desc")
    )


def payment_by_rate(tables: Tables) -> DataFrame:
    """Trips per known rate code and payment type."""
    totals = totals_per_key(tables, ["payment_type", "RateCodeID"])
    return (
        _by_rate(_by_payment(totals, tables, "inner"), tables, "inner")
        .groupBy("rate_code_desc", "payment_type_desc")
        .agg(trip_count().alias("count"))
        .orderBy("rate_code_desc", F.desc("count"), "payment_type_desc")
    )


def popular_pickups(tables: Tables, limit: int = 10) -> DataFrame:
    """The zones where most trips start, with unrounded figures."""
    return _popular_zones(tables, "PULocationID", "pickup_count", limit).select(
        "location_id",
        "pickup_count",
        "borough",
        "zone",
        "service_zone",
        "avg_distance",
        "avg_fare",
        "total_revenue",
    )


def popular_dropoffs(tables: Tables, limit: int = 10) -> DataFrame:
    """The zones where most trips end, with unrounded figures."""
    return _popular_zones(tables, "DOLocationID", "dropoff_count", limit)


def _popular_zones(tables: Tables, key: str, count_name: str, limit: int) -> DataFrame:
    totals = totals_per_key(
        tables,
        [key],
        "distance",
        "fare",
        "revenue",
    )
    zones = tables["dim_taxi_zone"].withColumn("key", T.location_key("location_id"))
    return (
        totals.join(zones, totals[key] == zones["key"])
        .groupBy("location_id", "borough", "zone", "service_zone")
        .agg(
            trip_count().alias(count_name),
            mean("distance").alias("avg_distance"),
            mean("fare").alias("avg_fare"),
            total("revenue").alias("total_revenue"),
        )
        .orderBy(F.desc(count_name), "location_id")
        .limit(limit)
    )


def popular_routes(tables: Tables, limit: int = 10) -> DataFrame:
    """The pairs of location ids with most trips, with unrounded figures."""
    totals = totals_per_key(
        tables,
        ["PULocationID", "DOLocationID"],
        "distance",
        "duration",
        "revenue",
    )
    return (
        totals.groupBy(F.col("PULocationID").alias("pickup_id"), F.col("DOLocationID").alias("dropoff_id"))
        .agg(
            trip_count().alias("trip_count"),
            mean("distance").alias("avg_distance"),
            mean("duration").alias("avg_duration"),
            total("revenue").alias("total_revenue"),
        )
        .orderBy(F.desc("trip_count"), "pickup_id", "dropoff_id")
        .limit(limit)
    )


REPORTS: dict[str, Callable[[Tables], DataFrame]] = {
    "pickup_boroughs": pickup_boroughs,
    "top_routes_by_revenue": top_routes_by_revenue,
    "payment_metrics": payment_metrics,
    "rate_code_metrics": rate_code_metrics,
    "busiest_hours": busiest_hours,
    "payment_analysis": payment_analysis,
    "rate_code_analysis": rate_code_analysis,
    "payment_by_rate": payment_by_rate,
    "popular_pickups": popular_pickups,
    "popular_dropoffs": popular_dropoffs,
    "popular_routes": popular_routes,
}


def all_reports(tables: Tables) -> dict[str, DataFrame]:
    """Every report by name, each still lazy."""
    return {name: report(tables) for name, report in REPORTS.items()}
