from __future__ import annotations

from collections import Counter

import pytest
from conftest import dicts, rows
from pyspark.sql import functions as F

from tripmart.plans import REPORTS, all_reports, reports
from tripmart.sources import dim_payment_type, dim_rate_code


def column(df, name):
    return [r[name] for r in df.collect()]


def counts(df, key, count="trip_count"):
    return {r[key]: r[count] for r in df.collect()}


@pytest.fixture(scope="module")
def small(spark):
    """Five trips with unknown codes, and two zones that share a name."""
    trips = [
        # time, pickup, dropoff, payment, rate, distance, fare, tip, total, minutes, price
        ("2021-08-01 10:00:00", 1, 2, 1, 1.0, 2.0, 10.0, 2.0, 12.0, 10.0, 5.0),
        ("2021-08-01 10:00:00", 2, 3, 1, 1.0, 4.0, 20.0, 1.0, 21.0, 20.0, 5.0),
        ("2021-08-02 10:30:00", 3, 3, 0, None, 1.0, 0.0, 5.0, 5.0, 5.0, 0.0),
        ("2021-08-02 11:00:00", 999, 1, 2, 2.0, None, 7.0, 0.0, 7.0, 7.0, 0.0),
        (None, None, 1, None, 99.0, 3.0, 9.0, 0.0, None, None, 3.0),
    ]
    fact = spark.createDataFrame(
        trips,
        "tpep_pickup_datetime string, PULocationID long, DOLocationID long, payment_type long, "
        "RateCodeID double, trip_distance double, fare_amount double, tip_amount double, "
        "total_amount double, trip_duration_minutes double, price_per_mile double",
    ).withColumn("tpep_pickup_datetime", F.col("tpep_pickup_datetime").cast("timestamp_ntz"))
    zones = [
        ("1", "Queens", "Corona", "Boro Zone"),
        ("2", "Queens", "Corona", "Boro Zone"),
        ("3", "Bronx", None, "Boro Zone"),
        ("4", None, "Nowhere", None),
        ("n/a", "Bronx", "Bad id", None),
    ]
    from tripmart.operators import dim_time

    return {
        "fact_trips": fact,
        "dim_time": dim_time(fact),
        "dim_payment_type": dim_payment_type(spark),
        "dim_rate_code": dim_rate_code(spark),
        "dim_taxi_zone": spark.createDataFrame(
            zones, "location_id string, borough string, zone string, service_zone string"
        ),
    }


def test_boroughs_merge_zones(small):
    assert rows(reports.pickup_boroughs(small)) == [
        ("Bronx", 1, 5.0, 5.0),
        ("Queens", 2, 16.5, 33.0),
    ]


def test_routes_need_both_zone_names(small):
    assert rows(reports.top_routes_by_revenue(small)) == [("Corona", "Corona", 1, 2.0, 10.0, 12.0)]


def test_payment_metrics_average_each_trips_tip_share(small):
    found = {r["payment_type_desc"]: r for r in dicts(reports.payment_metrics(small))}
    assert found["Credit card"]["tip_percentage"] == 12.5  # (2/10 + 1/20) / 2, not 3/30
    assert found["Cash"]["avg_distance"] is None
    # The null group joins an unknown code and a missing one; a zero fare has no tip share.
    assert found[None]["trip_count"] == 2
    assert found[None]["tip_percentage"] == 0.0


def test_rate_code_metrics_keep_unknown_codes(small):
    found = counts(reports.rate_code_metrics(small), "rate_code_desc")
    assert found == {"Standard rate": 2, "JFK": 1, "Unknown": 1, None: 1}


def test_inner_reports_drop_unknown_codes(small):
    assert counts(reports.payment_analysis(small), "payment_type") == {1: 2, 2: 1}
    assert counts(reports.rate_code_analysis(small), "rate_code_desc") == {
        "Standard rate": 2,
        "JFK": 1,
        "Unknown": 1,
    }
    assert rows(reports.payment_by_rate(small)) == [
        ("JFK", "Cash", 1),
        ("Standard rate", "Credit card", 2),
    ]


def test_mean_of_nothing_but_nulls_is_null(small):
    found = {r["rate_code_desc"]: r for r in dicts(reports.rate_code_analysis(small))}
    assert found["Unknown"]["avg_fare"] is None
    assert found["Unknown"]["total_revenue"] is None


def test_hours_leave_out_missing_times(small):
    assert rows(reports.busiest_hours(small)) == [(10, 3), (11, 1)]
    assert rows(reports.busiest_hours_by_join(small)) == [(10, 3), (11, 1)]


def test_popular_zones(small):
    pickups = dicts(reports.popular_pickups(small))
    assert list(pickups[0]) == [
        "location_id",
        "pickup_count",
        "borough",
        "zone",
        "service_zone",
        "avg_distance",
        "avg_fare",
        "total_revenue",
    ]
    assert [r["location_id"] for r in pickups] == ["1", "2", "3"]
    dropoffs = dicts(reports.popular_dropoffs(small))
    assert list(dropoffs[0])[4] == "dropoff_count"
    assert [(r["location_id"], r["dropoff_count"]) for r in dropoffs] == [("1", 2), ("3", 2), ("2", 1)]


def test_popular_routes_keep_unknown_locations(small):
    routes = dicts(reports.popular_routes(small))
    assert (None, 1) in {(r["pickup_id"], r["dropoff_id"]) for r in routes}
    assert len(routes) == 5


def test_limits_are_parameters(star):
    assert reports.popular_routes(star, 3).count() == 3
    assert reports.top_routes_by_revenue(star, 1000).count() > 10


def test_every_report_is_there(star):
    assert len(REPORTS) == 11
    assert list(all_reports(star)) == list(REPORTS)


# Relations that hold between the reports whatever the data.


@pytest.fixture(scope="module")
def fact_count(star):
    return star["fact_trips"].count()


def test_hours_sum_to_the_fact(star, fact_count):
    assert sum(column(reports.busiest_hours(star), "trip_count")) == fact_count


def test_hours_with_and_without_join(star):
    assert rows(reports.busiest_hours(star)) == rows(reports.busiest_hours_by_join(star))


def test_boroughs_and_the_unknown_sum_to_the_fact(star, fact_count):
    known = star["dim_taxi_zone"].filter("borough IS NOT NULL").select("location_id")
    unknown = star["fact_trips"].join(
        known, F.col("PULocationID") == F.col("location_id").cast("bigint"), "left_anti"
    )
    total = sum(column(reports.pickup_boroughs(star), "trip_count"))
    assert total + unknown.count() == fact_count


@pytest.mark.parametrize(
    "left, inner, key, shared",
    [
        ("payment_metrics", "payment_analysis", "payment_type_desc", ["avg_fare", "avg_tip"]),
        ("rate_code_metrics", "rate_code_analysis", "rate_code_desc", ["avg_distance", "total_revenue"]),
    ],
)
def test_left_and_inner_reports_agree(star, fact_count, left, inner, key, shared):
    all_groups = {r[key]: r for r in dicts(REPORTS[left](star))}
    known = {r[key]: r for r in dicts(REPORTS[inner](star))}
    missing = all_groups.pop(None)["trip_count"]
    assert missing == fact_count - sum(r["trip_count"] for r in known.values())
    for description, row in known.items():
        for name in ["trip_count", *shared]:
            assert all_groups[description][name] == row[name]


def test_cross_report_sums_to_trips_with_both_codes(star):
    both = (
        star["fact_trips"]
        .filter("payment_type BETWEEN 1 AND 6 AND RateCodeID IN (1, 2, 3, 4, 5, 6, 99)")
        .count()
    )
    assert sum(column(reports.payment_by_rate(star), "count")) == both


def test_route_pairs_by_id_and_by_name_agree(star):
    zones = {int(r["location_id"]): r["zone"] for r in star["dim_taxi_zone"].collect()}
    by_name = Counter()
    for r in reports.popular_routes(star, 10_000).collect():
        pickup, dropoff = zones.get(r["pickup_id"]), zones.get(r["dropoff_id"])
        if pickup and dropoff:
            by_name[pickup, dropoff] += r["trip_count"]
    found = reports.top_routes_by_revenue(star, 10_000).collect()
    assert {(r["pickup_zone"], r["dropoff_zone"]): r["trip_count"] for r in found} == by_name


def test_unused_zone_joins_change_nothing(star):
    """Left joins to a unique key whose columns are not used can be left out."""
    zones = star["dim_taxi_zone"].select(F.col("location_id").cast("bigint").alias("id"))
    assert zones.count() == zones.distinct().count()
    fact = star["fact_trips"]
    joined = fact.join(zones.withColumnRenamed("id", "p"), F.col("PULocationID") == F.col("p"), "left")
    joined = joined.join(zones.withColumnRenamed("id", "d"), F.col("DOLocationID") == F.col("d"), "left")
    for name in ("payment_metrics", "rate_code_metrics"):
        assert rows(REPORTS[name](star)) == rows(REPORTS[name]({**star, "fact_trips": joined}))


def test_sorted_as_promised(star):
    for name in ("pickup_boroughs", "payment_metrics", "busiest_hours", "rate_code_analysis"):
        found = column(REPORTS[name](star), "trip_count")
        assert found == sorted(found, reverse=True)
    cross = [(r["rate_code_desc"], -r["count"]) for r in reports.payment_by_rate(star).collect()]
    assert cross == sorted(cross)
    revenue = column(reports.top_routes_by_revenue(star), "total_revenue")
    assert revenue == sorted(revenue, reverse=True)
