"""Fact and time dimension in buckets of the pickup time."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL, rows
from pyspark.sql import functions as F
from test_plans import plan

import __spark_entry__ as entry
from tripmart.plans import open_star, reports, run
from tripmart.sinks import by_buckets, register_all

TIME = "tpep_pickup_datetime"


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def below_the_join(text: str) -> str:
    lines = text.splitlines()
    return "\n".join(lines[next(i for i, line in enumerate(lines) if "Join" in line) :])


def test_the_join_shuffles_neither_side(spark, star, no_broadcast):
    tables = entry.bucketed(spark, SF_SMALL)
    joined = reports.busiest_hours_by_join(tables)
    assert "Exchange" not in below_the_join(plan(joined))
    assert "Exchange" in below_the_join(plan(reports.busiest_hours_by_join(star)))
    assert rows(joined) == rows(reports.busiest_hours(star))


def test_the_tables_hold_the_same_rows(spark, star):
    tables = entry.bucketed(spark, SF_SMALL)
    assert rows(tables["dim_time"]) == rows(star["dim_time"])
    assert rows(tables["fact_trips"].drop("trip_id")) == rows(star["fact_trips"].drop("trip_id"))
    assert tables["fact_trips"].select("trip_id").distinct().count() == star["fact_trips"].count()


def load(spark, base, schema, buckets):
    source = entry.landing(spark, SF_SMALL)
    run(spark, source, f"{source}/zones", *entry.MONTH, base, schema=schema, time_buckets=buckets)
    return open_star(spark, schema=schema)


def buckets_of(spark, name) -> str | None:
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Num Buckets'").first()
    return found and found["data_type"]


def test_loads_may_change_the_buckets(spark, star, tmp_path, no_broadcast):
    base = str(tmp_path / "mart")
    expected = rows(reports.busiest_hours(star))
    for buckets in (3, 5, None, 2):
        tables = load(spark, base, "rebucketed", buckets)
        assert buckets_of(spark, "rebucketed.fact_trips") == (buckets and str(buckets))
        joined = reports.busiest_hours_by_join(tables)
        assert ("Exchange" in below_the_join(plan(joined))) == (buckets is None)
        assert rows(joined) == expected
    assert not [t.name for t in spark.catalog.listTables("rebucketed") if t.name.startswith("writing_")]
    spark.sql("DROP TABLE rebucketed.fact_trips")
    register_all(spark, base, "rebucketed")
    assert buckets_of(spark, "rebucketed.fact_trips") == "2"
    assert rows(reports.busiest_hours(open_star(spark, base_path=base))) == expected


def test_a_hot_time_is_written_by_several_tasks_and_changes_only_its_total(spark):
    trips = spark.range(30_000).select(
        F.col("id").alias("trip_id"),
        F.when(F.col("id") % 3 > 0, F.lit("2021-08-01 05:00:00").cast("timestamp_ntz"))
        .when(F.col("id") % 9 > 0, F.timestamp_seconds("id").cast("timestamp_ntz"))
        .alias(TIME),
    )
    dealt = by_buckets(trips, TIME, 8, spread="trip_id").withColumn("task", F.spark_partition_id())
    hot = dealt.filter(f"hour({TIME}) = 5 AND year({TIME}) = 2021").groupBy("task").count().collect()
    assert len(hot) > 3 and max(r["count"] for r in hot) < 10_000
    written = dealt.withColumn("bucket", F.pmod(F.hash(TIME), F.lit(8))).select("task", "bucket").distinct().count()
    assert written <= 2 * 8


def test_buckets_that_cannot_be(spark, tmp_path):
    source = entry.landing(spark, SF_SMALL)
    for more in ({}, {"schema": "s", "by_month": True}, {"schema": "s", "fmt": "delta"}):
        with pytest.raises(ValueError, match="buckets"):
            run(spark, source, f"{source}/zones", *entry.MONTH, str(tmp_path), time_buckets=4, **more)
    with pytest.raises(ValueError, match="buckets"):
        run(spark, source, f"{source}/zones", *entry.MONTH, str(tmp_path), schema="s", time_buckets=0)
