"""Sums that do not depend on how rows are partitioned."""

from __future__ import annotations

import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tripmart.functions import exact_sums, exact_total, from_limbs, limb_sums
from tripmart.plans import reports


def total(df):
    return df.agg(*exact_sums("x", "x")).select(exact_total("x", again=False).alias("t")).first()["t"]


@pytest.mark.parametrize("report", [reports.popular_pickups, reports.popular_dropoffs, reports.popular_routes])
def test_unrounded_reports_are_the_same_under_any_partitioning(spark, star, report):
    found = []
    for n in (1, 7, 64):
        fact = star["fact_trips"].repartition(n, F.rand(n))
        found.append([tuple(r) for r in report({**star, "fact_trips": fact}).collect()])
    assert found[0] == found[1] == found[2]


def test_sums_are_exact(spark):
    source = random.Random(1)
    values = [source.uniform(-1, 1) * 10 ** source.randint(-6, 15) for _ in range(3000)]
    values += [-v for v in values[:2000]] + [0.1] * 1000 + [1e18, -1e18, -0.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    found = {total(df.repartition(n)) for n in (1, 7, 64)}
    assert len(found) == 1
    assert found.pop() == pytest.approx(math.fsum(values), rel=1e-15)


def test_sums_of_sums(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), (F.col("id") * 0.1).alias("x"))
    by_key = df.groupBy("k").agg(*exact_sums("x", "x"))
    assert by_key.agg(exact_total("x").alias("t")).first()["t"] == total(df)
    assert len(rows(by_key)) == 7


@pytest.mark.parametrize(
    "values, wanted",
    [([], None), ([None], None), ([None, 2.5], 2.5), ([1e300, 1.0], 1e300), ([math.inf, 1.0], math.inf), ([5e-324], 0.0)],
)
def test_odd_values(spark, values, wanted):
    assert total(spark.createDataFrame([(v,) for v in values], "x double")) == wanted


def test_not_a_number(spark):
    for values in ([math.nan, 1.0], [math.inf, -math.inf]):
        assert math.isnan(total(spark.createDataFrame([(v,) for v in values], "x double")))


def test_limbs_give_the_same_sums(spark):
    source = random.Random(2)
    odd = [None, math.nan, math.inf, -math.inf, 1e300, -(2.0**62), 2.0**62, 2.0**61, -(2.0**61) - 512, -0.0, 5e-324]
    values = [source.uniform(-1, 1) * 10 ** source.randint(-12, 18) for _ in range(2000)] + odd
    df = spark.createDataFrame([(i % 97, v) for i, v in enumerate(values)], "k int, x double")
    df = df.union(df.select(F.lit(-1), F.lit(None).cast("double")))
    wanted = df.groupBy("k").agg(*exact_sums("x", "x"))
    found = df.groupBy("k").agg(*limb_sums("x", "x")).select("k", *from_limbs("x"))
    assert found.dtypes == wanted.dtypes
    assert str(rows(found)) == str(rows(wanted))  # NaN is not equal to itself


def test_totals_of_months_are_those_of_each_set_of_keys(spark, star):
    fact = star["fact_trips"].limit(3000).withColumns({"m": F.col("VendorID") % 2, "pickup_hour": F.hour("tpep_pickup_datetime")})
    for c in ("PULocationID", "payment_type", "RateCodeID", "fare_amount"):
        fact = fact.withColumn(c, F.when(F.col("trip_id") % 11 != len(c) % 11, F.col(c)))
    found = reports.month_totals(fact.drop("pickup_hour"), ["m"])
    for keys in reports.KEY_SETS:
        sums = [a for m, v in reports.MEASURES.items() for a in (*exact_sums(m, v()), F.count(v()).alias(f"{m}_n"))]
        wanted = fact.groupBy(*keys, "m").agg(F.count(F.lit(1)).alias("trips"), *sums)
        own = found.filter(F.col("by") == ",".join(keys)).select(wanted.columns)
        assert own.dtypes == wanted.dtypes and rows(own) == rows(wanted)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert len(found.select("by").distinct().collect()) == 7
    scan = plan[plan.index("Expand") :]
    assert scan.splitlines()[0].count("spark_grouping_id") == 1 and scan.splitlines()[0].count("], [") == 3  # between three sets and the names
    assert "partial_sum(cast" not in plan.split("Exchange")[-1]  # no decimals beside the trips
