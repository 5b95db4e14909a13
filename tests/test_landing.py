"""What the queries' input costs to build."""

from __future__ import annotations

from collections import Counter

from conftest import SF_SMALL
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tripmart.sources import month_path, read_trip_months, read_trips
from tripmart.sources.sample import sample_trips


def test_the_tables_are_joined_once(spark, monkeypatch):
    evaluated = spark.sparkContext.accumulator(0)

    def seen(distance):
        evaluated.add(1)
        return distance

    def counted(session, folder):
        return sample_trips(session, folder).withColumn("trip_distance", F.udf(seen, "double")("trip_distance"))

    monkeypatch.setattr(entry, "sample_trips", counted)
    folder = f"{SF_SMALL}/."  # another folder to the cache of landings
    root = entry.landing(spark, folder)
    split = entry.halves(spark, folder)
    raw = read_trips(spark, root, *entry.MONTH)
    assert evaluated.value == raw.count() > 0

    rows = lambda df: Counter(map(tuple, df.collect()))
    assert rows(raw) == rows(sample_trips(spark, SF_SMALL))
    assert rows(read_trip_months(spark, split, entry.MONTH, entry.NEIGHBOUR)) == rows(raw)
    late = read_trips(spark, root, *entry.NEIGHBOUR)
    assert rows(late) == rows(read_trips(spark, split, *entry.NEIGHBOUR))
    types = dict(spark.read.parquet(month_path(root, *entry.NEIGHBOUR)).dtypes)
    assert (types["VendorID"], types["passenger_count"]) == ("int", "bigint")
