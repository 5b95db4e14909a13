from __future__ import annotations

import re
import sys
from pathlib import Path

import load_month
import pytest
from conftest import SF_SMALL, rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from tripmart.operators import duplicate_rows, verify_tables
from tripmart.operators.numbering import numbered
from tripmart.plans import load, open_star, pipeline, reports, run
from tripmart.plans.pipeline import prepare_times
from tripmart.schema import STAR_TABLES, TRIP_TYPES
from tripmart.sinks import tables, versions
from tripmart.sinks import (
    append_missing,
    path_exists,
    read_saved,
    register_all,
    replace_partition,
    save_table,
    save_tables,
    shared_folder,
    staging_folder,
    use_schema,
    write_and_read,
)
from tripmart.sources import MONTH_FOLDER
from tripmart.sources.sample import sample_zones


@pytest.fixture(scope="module")
def landing(spark, trips, tmp_path_factory):
    """Two months of trips, the first also in folder layout, and a zone file."""
    root = tmp_path_factory.mktemp("landing")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    early = trips.filter(F.col("tpep_pickup_datetime") < cut)
    late = trips.filter(F.col("tpep_pickup_datetime") >= cut)
    early.write.parquet(f"{root}/yellow_tripdata_2021-08.parquet")
    early.write.parquet(f"{root}/year=2021/month=08")
    late.write.parquet(f"{root}/yellow_tripdata_2021-09.parquet")
    zones = sample_zones(spark, SF_SMALL).select(
        F.col("location_id").alias("LocationID"),
        F.col("borough").alias("Borough"),
        F.col("zone").alias("Zone"),
        "service_zone",
    )
    zones.coalesce(1).write.csv(f"{root}/zones", header=True)
    return str(root)


def test_one_month_from_file_to_tables(spark, landing, tmp_path):
    base = str(tmp_path / "mart")
    result = run(spark, landing, f"{landing}/zones", 2021, 8, base, schema="mart_one")
    raw = spark.read.parquet(f"{landing}/yellow_tripdata_2021-08.parquet")

    quality = result.quality
    assert quality.initial_count == raw.count()
    assert quality.distinct_count == raw.distinct().count()
    assert quality.duplicate_count == quality.initial_count - quality.distinct_count > 0
    assert quality.final_count == result.tables["fact_trips"].count()
    assert quality.retention_pct == quality.final_count / quality.initial_count * 100
    assert quality.low_retention is (quality.retention_pct < 85)
    distinct = raw.distinct()
    assert quality.null_counts["total_amount"] == distinct.filter("total_amount IS NULL").count()
    complete = distinct.filter("trip_distance IS NOT NULL AND total_amount IS NOT NULL")
    assert quality.negative_counts["airport_fee"] == complete.filter("airport_fee < 0").count()

    assert set(result.tables) == {*STAR_TABLES, "duplicate_trips"}
    assert rows(result.tables["duplicate_trips"]) == rows(duplicate_rows(raw))
    assert len(result.reports) == 11 and all(r.count() > 0 for r in result.reports.values())

    checks = verify_tables(spark, "mart_one")
    assert {name: check.row_count for name, check in checks.items()} == {
        name: result.tables[name].count() for name in STAR_TABLES
    }
    assert all(len(check.sample) == 5 and check.error is None for check in checks.values())

    # The saved tables answer plain SQL, with ids of different types compared as they are.
    use_schema(spark, "mart_one")
    zones = spark.sql("""
        SELECT location_id, count(*) AS pickup_count FROM mart_one.fact_trips
        JOIN mart_one.dim_taxi_zone ON PULocationID = location_id GROUP BY location_id
    """)
    hours = spark.sql("""
        SELECT pickup_hour, count(*) AS trip_count FROM mart_one.fact_trips
        JOIN mart_one.dim_time USING (tpep_pickup_datetime) GROUP BY pickup_hour
    """)
    use_schema(spark, "default")
    popular = result.reports["popular_pickups"].select("location_id", "pickup_count")
    assert set(rows(popular)) <= set(rows(zones))
    assert rows(hours) == rows(result.reports["busiest_hours"])


def test_trip_ids_of_a_saved_fact_stay(spark, landing, tmp_path):
    fact = run(spark, landing, f"{landing}/zones", 2021, 8, str(tmp_path / "m")).tables["fact_trips"]
    assert rows(fact) == rows(fact)
    assert fact.count() == fact.select("trip_id").distinct().count()


def test_repeatable_ids(spark, trips, tmp_path):
    zones, found = sample_zones(spark, SF_SMALL), []
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for i, n in enumerate((1, 9)):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            raw = trips.repartition(n, F.rand(i))
            found.append(load(spark, raw, zones, str(tmp_path / str(i)), repeatable_ids=True).tables["fact_trips"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert rows(found[0]) == rows(found[1])
    fact = found[1].orderBy("trip_id").collect()
    assert [r["trip_id"] for r in fact] == list(range(len(fact)))
    assert [r["tpep_pickup_datetime"] for r in fact] == sorted(r["tpep_pickup_datetime"] for r in fact)


def test_numbers_of_equal_rows_and_of_none(spark, tmp_path):
    df = spark.range(1000).select(F.when(F.col("id") % 3 > 0, 5).alias("x"), F.lit(None).cast("string").alias("a b"))
    found = numbered(df.repartition(7), "n", f"{tmp_path}/a").orderBy("n").collect()
    assert [r["n"] for r in found] == list(range(1000))
    assert [r["x"] for r in found] == [None] * 334 + [5] * 666
    assert numbered(df.limit(0), "n", f"{tmp_path}/b").collect() == []


def test_next_month_replaces_the_last(spark, landing, tmp_path):
    base = str(tmp_path / "mart")
    first = run(spark, landing, f"{landing}/zones", 2021, 8, base).quality.final_count
    second = run(spark, landing, f"{landing}/zones", 2021, 9, base).quality.final_count
    assert first != second
    assert read_saved(spark, f"{base}/fact_trips").count() == second


def test_months_side_by_side(spark, landing, tmp_path):
    base, zones = str(tmp_path / "mart"), f"{landing}/zones"
    options = {"schema": "mart_months", "by_month": True}
    first = run(spark, landing, zones, 2021, 8, base, **options).quality.final_count
    second = run(spark, landing, zones, 2021, 9, base, **options).quality.final_count
    again = run(spark, landing, zones, 2021, 8, base, pattern=MONTH_FOLDER, **options)
    assert again.quality.final_count == first

    fact = spark.table("mart_months.fact_trips")
    assert {r["trip_month"]: r["count"] for r in fact.groupBy("trip_month").count().collect()} == {
        8: first,
        9: second,
    }
    ids = fact.select("trip_year", "trip_month", "trip_id")
    assert ids.distinct().count() == first + second

    times = spark.table("mart_months.dim_time")
    expected = fact.select("tpep_pickup_datetime").distinct()
    assert rows(times.select("tpep_pickup_datetime")) == rows(expected)
    hours = again.reports["busiest_hours"]
    assert sum(r["trip_count"] for r in hours.collect()) == first + second
    # Duplicates are kept per month as well.
    assert spark.table("mart_months.duplicate_trips").select("trip_month").distinct().count() == 2


def test_a_month_is_a_partition_of_the_scan(spark, landing, tmp_path):
    base = str(tmp_path / "mart")
    run(spark, landing, f"{landing}/zones", 2021, 8, base, by_month=True)
    fact = read_saved(spark, f"{base}/fact_trips").filter("trip_year = 2021 AND trip_month = 8")
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(trip_year" in plan


def test_an_emptied_month_loses_its_rows(spark, trips, tmp_path):
    base, zones = str(tmp_path / "mart"), sample_zones(spark, SF_SMALL)
    load(spark, trips, zones, base, "mart_emptied", load_month=(2021, 8))
    load(spark, trips, zones, base, "mart_emptied", load_month=(2021, 9))
    load(spark, trips.limit(0), zones, base, "mart_emptied", load_month=(2021, 8))
    for name in ("fact_trips", "duplicate_trips"):
        months = spark.table(f"mart_emptied.{name}").select("trip_month").distinct()
        assert rows(months) == [(9,)]


def test_months_do_not_mix_with_a_plain_table(spark, trips, tmp_path):
    base, zones = str(tmp_path / "mart"), sample_zones(spark, SF_SMALL)
    load(spark, trips.limit(10), zones, base)
    with pytest.raises(ValueError, match="without partitions"):
        load(spark, trips.limit(10), zones, base, load_month=(2021, 8))


def test_a_load_takes_few_jobs(spark, trips, tmp_path):
    zones = sample_zones(spark, SF_SMALL)
    context = spark.sparkContext
    for group, month in (("plain", None), ("by month", (2021, 8))):
        context.setJobGroup(group, group)
        load(spark, trips, zones, str(tmp_path / group), "mart_jobs", load_month=month)
        assert len(context.statusTracker().getJobIdsForGroup(group)) <= 15
    context.setJobGroup("tests", "tests")


def test_empty_month(spark, trips, tmp_path):
    zones = sample_zones(spark, SF_SMALL)
    result = load(spark, trips.limit(0), zones, str(tmp_path / "mart"))
    assert result.quality.initial_count == 0
    assert result.quality.retention_pct is None and result.quality.low_retention is None
    assert result.tables["fact_trips"].count() == 0
    assert result.tables["dim_time"].count() == 0


def test_missing_month_stops_the_run(spark, landing, tmp_path):
    with pytest.raises(FileNotFoundError):
        run(spark, landing, f"{landing}/zones", 2021, 7, str(tmp_path / "mart"))


def test_hours_of_zoned_times_are_the_same_in_every_session(spark, trips, landing, tmp_path):
    zoned = trips.limit(500).withColumns(
        {c: F.col(c).cast("timestamp") for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime")}
    )
    zoned.write.parquet(f"{landing}/yellow_tripdata_2021-10.parquet")
    expected = None
    for loaded_in, read_in in (("UTC", "UTC"), ("UTC", "America/New_York"), ("Asia/Tokyo", "UTC")):
        spark.conf.set("spark.sql.session.timeZone", loaded_in)
        try:
            base = str(tmp_path / f"{loaded_in}-{read_in}".replace("/", "-"))
            run(spark, landing, f"{landing}/zones", 2021, 10, base)
            assert spark.conf.get("spark.sql.session.timeZone") == loaded_in
            spark.conf.set("spark.sql.session.timeZone", read_in)
            tables = open_star(spark, base_path=base)
            assert tables["fact_trips"].schema["tpep_pickup_datetime"].dataType == TimestampNTZType()
            direct, joined = rows(reports.busiest_hours(tables)), rows(reports.busiest_hours_by_join(tables))
            expected = expected or direct
            assert direct == joined == expected
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_durations_of_zoned_times_across_a_clock_change(spark, tmp_path):
    raw = zoned_trip(spark, "2021-11-07 05:30:00", "2021-11-07 06:30:00")  # clocks go back at 06:00 UTC
    zones = sample_zones(spark, SF_SMALL)
    fact = load(spark, raw, zones, str(tmp_path), time_zone="America/New_York").tables["fact_trips"]
    found = fact.select("tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_duration_minutes").first()
    assert [str(x) for x in found] == ["2021-11-07 01:30:00", "2021-11-07 01:30:00", "60.0"]


def zoned_trip(spark, pickup, dropoff):
    values = {c: f"CAST(1 AS {kind})" for c, kind in TRIP_TYPES.items()}
    values["tpep_pickup_datetime"] = f"TIMESTAMP '{pickup}Z'"
    values["tpep_dropoff_datetime"] = f"TIMESTAMP '{dropoff}Z'"
    return spark.sql("SELECT " + ", ".join(f"{v} AS {c}" for c, v in values.items()))


# No load may lose saved data


def saved_rows(spark, base):
    return {name: read_saved(spark, f"{base}/{name}").count() for name in ("fact_trips", "dim_time")}


@pytest.fixture
def months(spark, landing, tmp_path):
    """A mart of two months, and its row counts."""
    base = str(tmp_path / "mart")
    for month in (8, 9):
        run(spark, landing, f"{landing}/zones", 2021, month, base, schema="mart_kept", by_month=True)
    return base, saved_rows(spark, base)


def test_a_plain_load_does_not_replace_months(spark, landing, months):
    base, before = months
    with pytest.raises(ValueError, match="holds partitions"):
        run(spark, landing, f"{landing}/zones", 2021, 8, base)
    assert saved_rows(spark, base) == before


def failing(spark, trips):
    """Trips whose last one cannot be computed."""
    bad = F.when(F.col("total_amount") > 0, F.raise_error("broken").cast("double")).otherwise(F.col("fare_amount"))
    return trips.withColumn("fare_amount", bad)


def test_a_load_that_fails_midway_keeps_the_old_rows(spark, trips, months, tmp_path):
    base, before = months
    zones = sample_zones(spark, SF_SMALL)
    with pytest.raises(Exception, match="broken"):
        load(spark, failing(spark, trips), zones, base, load_month=(2021, 8))
    assert saved_rows(spark, base) == before
    plain = str(tmp_path / "plain")
    load(spark, trips, zones, plain)
    before = saved_rows(spark, plain)
    with pytest.raises(Exception, match="broken"):
        load(spark, failing(spark, trips), zones, plain)
    with pytest.raises(Exception, match="broken"):
        save_table(failing(spark, trips), "fact_trips", plain)
    assert saved_rows(spark, plain) == before
    assert all(len(list(Path(plain, name).iterdir())) == 1 for name in (*STAR_TABLES, "duplicate_trips"))


def test_lookups_are_checked_before_the_fact_is_replaced(spark, trips, tmp_path):
    base, zones = str(tmp_path / "mart"), sample_zones(spark, SF_SMALL)
    load(spark, trips, zones, base)
    before = saved_rows(spark, base)
    with pytest.raises(ValueError, match="would change"):
        load(spark, trips.limit(90), zones.withColumn("more", F.lit(1)), base)
    assert saved_rows(spark, base) == before


def test_a_load_without_a_needed_column_starts_no_job(spark, trips, tmp_path):
    zones = sample_zones(spark, SF_SMALL)
    spark.sparkContext.setJobGroup("refused", "refused")
    with pytest.raises(AnalysisException):
        load(spark, trips.drop("tip_amount"), zones, str(tmp_path))
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("refused")
    spark.sparkContext.setJobGroup("tests", "tests")


def test_months_of_other_types_are_refused(spark, trips, months):
    base, before = months
    with pytest.raises(ValueError, match="would change"):
        load(spark, trips.withColumn("VendorID", F.col("VendorID").cast("int")), sample_zones(spark, SF_SMALL), base,
             load_month=(2021, 10))
    assert saved_rows(spark, base) == before


# The time dimension by month of pickup


def test_times_follow_the_fact(spark, trips, tmp_path):
    base, zones = str(tmp_path / "mart"), sample_zones(spark, SF_SMALL)

    def agree():
        fact = read_saved(spark, f"{base}/fact_trips").select("tpep_pickup_datetime").distinct()
        times = read_saved(spark, f"{base}/dim_time")
        assert rows(times.select("tpep_pickup_datetime")) == rows(fact)

    late = trips.filter("tpep_pickup_datetime >= TIMESTAMP_NTZ '1997-01-01'")
    load(spark, trips, zones, base, "mart_times", load_month=(2021, 8))
    load(spark, late.limit(700), zones, base, "mart_times", load_month=(2021, 9))  # times that the other month has
    agree()
    load(spark, trips.limit(50), zones, base, "mart_times", load_month=(2021, 8))  # a smaller month
    agree()
    load(spark, trips.limit(0), zones, base, "mart_times", load_month=(2021, 9))
    agree()
    assert spark.table("mart_times.dim_time").count() == read_saved(spark, f"{base}/dim_time").count()


def test_only_the_months_that_change_are_read(spark, trips, tmp_path):
    base, zones = str(tmp_path / "mart"), sample_zones(spark, SF_SMALL)
    load(spark, trips, zones, base, load_month=(2021, 8))
    one = trips.filter("date_trunc('month', tpep_pickup_datetime) = '1995-03-01'")
    fact = load(spark, one, zones, str(tmp_path / "one")).tables["fact_trips"]
    prepared = prepare_times(fact, {"trip_year": 2021, "trip_month": 9}, base)
    plan = prepared.rows._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*pickup_year[^]]*1995[^]]*pickup_month", plan)
    assert prepared.added == [{"pickup_year": 1995, "pickup_month": 3}]


# One switch for all tables


def told(tables):
    """What two reports say, of which one joins the time dimension; they agree within one load."""
    hours = rows(reports.busiest_hours(tables))
    assert hours == rows(reports.busiest_hours_by_join(tables))
    return hours, {name: tables[name].count() for name in STAR_TABLES}


@pytest.mark.parametrize("by_month", [False, True])
def test_a_load_that_fails_anywhere_shows_the_old_tables_or_the_new(spark, trips, tmp_path, monkeypatch, by_month):
    """Every call that changes files or the catalog fails once, before and after it has done its work."""
    zones, month = sample_zones(spark, SF_SMALL), {"load_month": (2021, 8)} if by_month else {}
    expected = []
    for i, n in enumerate((300, 700)):
        load(spark, trips.limit(n), zones, str(tmp_path / f"alone{i}"), **month)
        expected.append(told(open_star(spark, base_path=str(tmp_path / f"alone{i}"))))
    places = [(versions, "move_new", False), (tables, "register_table", False)]
    if not by_month:
        places += [(versions, "move_new", True), (versions, "write_text", True), (versions, "delete_path", False)]
    seen = set()
    for at, (module, name, after) in enumerate(places):
        base, schema = str(tmp_path / f"mart{at}{after}"), f"mart_fails_{int(by_month)}_{at}_{int(after)}"
        load(spark, trips.limit(300), zones, base, schema, **month)
        begun = open_star(spark, base_path=base)
        work = getattr(module, name)

        def broken(*args, work=work, after=after, **more):
            if after:
                work(*args, **more)
            raise OSError("broken")

        monkeypatch.setattr(module, name, broken)
        try:
            load(spark, trips.limit(700), zones, base, schema, **month)
        except OSError:
            pass
        monkeypatch.undo()
        found = told(open_star(spark, base_path=base))
        assert found in expected
        seen.add((name, after, expected.index(found)))
        assert told(begun) == expected[0]  # a reader that had begun goes on with its tables
        register_all(spark, base, schema)
        assert told(open_star(spark, schema=schema)) == found
    assert {("move_new", False, 0), ("register_table", False, 1)} <= seen
    assert by_month or ("move_new", True, 1) in seen


@pytest.mark.parametrize("lost", ["fact_trips", "duplicate_trips", "trip_groups"])
def test_a_load_in_which_a_step_loses_a_row_is_refused(spark, trips, tmp_path, monkeypatch, lost):
    base, zones = str(tmp_path), sample_zones(spark, SF_SMALL)
    load(spark, trips.limit(300), zones, base)
    before = saved_rows(spark, base)
    if lost == "fact_trips":
        whole = pipeline.enrich_trips
        monkeypatch.setattr(pipeline, "enrich_trips", lambda df: whole(df).filter("NOT VendorID <=> 1"))
    elif lost == "duplicate_trips":
        whole = pipeline.repeat_rows
        monkeypatch.setattr(pipeline, "repeat_rows", lambda df: whole(df).limit(3))
    else:  # files of the staged groups go after they were observed
        whole = pipeline.write_and_read
        monkeypatch.setattr(pipeline, "write_and_read", lambda df, path: whole(df, path).limit(5))
    with pytest.raises(ValueError, match="should have"):
        load(spark, trips, zones, base)
    assert saved_rows(spark, base) == before
    assert all(len(list(Path(base, name).iterdir())) == 1 for name in (*STAR_TABLES, "duplicate_trips"))


def test_old_versions_go_with_the_load_after_next(spark, tmp_path):
    base = str(tmp_path)
    for n in (1, 2, 3, 4):
        save_tables({"one": spark.range(n), "two": spark.range(n)}, base)
        assert len(list(Path(base, "one").iterdir())) == min(n, 2)
    assert len([f for f in Path(base, "_loads").iterdir() if f.suffix == ".json"]) == 2
    (Path(base, "one") / "__version=left-by-a-process-that-died").mkdir()
    save_table(spark.range(9), "one", base)
    assert read_saved(spark, f"{base}/one").count() == 9 and read_saved(spark, f"{base}/two").count() == 4
    assert len(list(Path(base, "one").iterdir())) == 2 and len(list(Path(base, "two").iterdir())) == 1


def test_a_switch_that_another_load_has_overtaken_fails(spark, tmp_path):
    base = str(tmp_path)
    save_table(spark.range(3), "t", base)
    before = versions.current(spark, base)
    save_table(spark.range(4), "t", base)
    with pytest.raises(Exception, match="(?i)exist"):
        versions.switch(spark, base, before, before.tables)
    assert read_saved(spark, f"{base}/t").count() == 4


def test_partitions_of_many_versions_are_one_scan(spark, tmp_path):
    base, kept = str(tmp_path), {}
    for i, part in enumerate([1, 2, 3, 2, 4, 2]):
        kept[part] = i
        df = spark.range(5).withColumn("i", F.lit(i))
        whole = replace_partition(df, {"p": part}, "parts", base, "sink_parts")
        for found in (whole, spark.table("sink_parts.parts"), read_saved(spark, f"{base}/parts")):
            assert rows(found.select("p", "i").distinct()) == sorted(kept.items())
            assert found.count() == 5 * len(kept) and found.columns == ["id", "i", "p"]
    plan = whole.filter("p = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan and "Union" not in plan


def test_files_that_no_load_has_listed_are_refused(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/old")
    with pytest.raises(ValueError, match="not a version"):
        save_table(spark.range(2), "old", str(tmp_path))


def test_open_star_runs_no_job(spark, trips, tmp_path):
    load(spark, trips.limit(100), sample_zones(spark, SF_SMALL), str(tmp_path))
    spark.sparkContext.setJobGroup("opening", "opening")
    open_star(spark, base_path=str(tmp_path))
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("opening")
    spark.sparkContext.setJobGroup("tests", "tests")
    with pytest.raises(FileNotFoundError, match="no table"):
        open_star(spark, base_path=str(tmp_path / "nowhere"))


# Totals by load month


def test_reports_from_totals_equal_those_from_trips(spark, trips, tmp_path):
    base, zones = str(tmp_path), sample_zones(spark, SF_SMALL)
    half = F.col("tpep_pickup_datetime") < F.lit("1995-01-01").cast("timestamp_ntz")

    def said(tables):
        return {name: rows(report) for name, report in reports.all_reports(tables).items()}

    def agree():
        held = open_star(spark, base_path=base)
        from_trips = {name: df for name, df in held.items() if name != "trip_totals"}
        assert "trip_totals" in held and said(held) == said(from_trips)
        for name, report in reports.all_reports(held).items():
            assert "fact_trips" not in report._jdf.queryExecution().executedPlan().toString(), name

    def add(raw, month, **more):
        return load(spark, raw, zones, base, "mart_totals", load_month=(2021, month), **more)

    add(trips.filter(half), 8)
    assert "trip_totals" not in open_star(spark, base_path=base)
    add(trips.filter(~half), 9, keep_totals=True)  # also makes those of the month before
    agree()
    add(trips.limit(700), 8)  # replaced
    result = add(trips.limit(0), 9)  # emptied
    agree()
    hours = reports.busiest_hours(open_star(spark, schema="mart_totals"))
    assert rows(hours) == rows(result.reports["busiest_hours"])
    assert result.tables["trip_totals"].select("trip_month").distinct().collect()[0][0] == 8
    expected = {",".join(keys) for keys in reports.KEY_SETS}
    assert {r["by"] for r in result.tables["trip_totals"].select("by").distinct().collect()} == expected


# Catalog entries


def test_a_catalog_entry_outlives_a_load(spark, landing, tmp_path, caplog):
    base, options = str(tmp_path / "mart"), {"schema": "mart_entry", "by_month": True}
    run(spark, landing, f"{landing}/zones", 2021, 8, base, **options)
    spark.sql("ALTER TABLE mart_entry.fact_trips SET TBLPROPERTIES ('note' = 'kept')")
    spark.sql("COMMENT ON TABLE mart_entry.dim_payment_type IS 'codes'")
    run(spark, landing, f"{landing}/zones", 2021, 9, base, **options)
    assert "kept" in str(spark.sql("SHOW TBLPROPERTIES mart_entry.fact_trips").collect())
    assert spark.catalog.getTable("mart_entry.dim_payment_type").description == "codes"
    assert rows(spark.table("mart_entry.fact_trips").select("trip_month").distinct()) == [(8,), (9,)]


def test_no_scan_for_partitions(spark, landing, tmp_path, monkeypatch):
    said = []
    plain = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: said.append(text) or plain(self, text, *a, **k))
    run(spark, landing, f"{landing}/zones", 2021, 8, str(tmp_path), schema="mart_said", by_month=True)
    run(spark, landing, f"{landing}/zones", 2021, 9, str(tmp_path), schema="mart_said", by_month=True)
    assert any("ADD IF NOT EXISTS" in text for text in said)
    assert not any("MSCK" in text.upper() for text in said)


# The job script


def test_the_job_prints_every_row(spark, landing, tmp_path, monkeypatch, capsys):
    job = ["load_month.py", "--schema", "mart_job"]
    load_args = ["--source", landing, "--zones", f"{landing}/zones", "--year", "2021", "--month", "9"]
    monkeypatch.setattr(sys, "argv", [*job, *load_args, "--target", str(tmp_path)])
    load_month.main()
    first = capsys.readouterr().out
    monkeypatch.setattr(sys, "argv", [*job, "--reports-only"])
    load_month.main()
    second = capsys.readouterr().out
    for name, report in reports.all_reports(open_star(spark, "mart_job")).items():
        for said in (first, second):
            block = said.split(f"\n{name}\n")[1].split("\n\n")[0].splitlines()
            lines = [" ".join(map(str, row)).split() for row in report.collect()]
            assert [line.split() for line in block[1 : len(lines) + 1]] == lines
    assert reports.busiest_hours(open_star(spark, "mart_job")).count() > 10
    monkeypatch.setattr(sys, "argv", job)
    with pytest.raises(SystemExit):
        load_month.main()


def test_reports_on_months_of_different_types(spark):
    import __spark_entry__ as entry

    def said(tables):
        return {name: rows(report) for name, report in reports.all_reports(tables).items()}

    assert said(entry.months(spark, SF_SMALL)) == said(entry.star(spark, SF_SMALL))


# Reports without a load


def test_open_star(spark, landing, tmp_path):
    base = str(tmp_path / "mart")
    loaded = run(spark, landing, f"{landing}/zones", 2021, 8, base, schema="mart_open")
    expected = {name: rows(report) for name, report in loaded.reports.items()}
    for tables in (open_star(spark, schema="mart_open"), open_star(spark, base_path=base)):
        assert {name: rows(report) for name, report in reports.all_reports(tables).items()} == expected
    with pytest.raises(ValueError, match="schema or a base path"):
        open_star(spark)


# Sinks


def test_save_makes_views_and_catalog_tables(spark, tmp_path):
    tables = {"t_one": spark.range(3), "t_two": spark.range(4)}
    save_tables(tables, str(tmp_path), schema="sink_test")
    assert spark.sql("SELECT count(*) AS n FROM sink_test.t_two").first()["n"] == 4
    assert spark.catalog.tableExists("t_one")
    assert not spark.catalog.getTable("sink_test.t_one").isTemporary
    current = spark.catalog.currentDatabase()
    use_schema(spark, "sink_test")
    assert spark.catalog.currentDatabase() == "sink_test"
    use_schema(spark, current)


def test_overwrite_may_change_columns(spark, tmp_path):
    save_table(spark.range(3), "changing", str(tmp_path), schema="sink_test")
    save_table(spark.range(2).selectExpr("id", "'x' AS name"), "changing", str(tmp_path), "sink_test")
    assert spark.table("sink_test.changing").columns == ["id", "name"]


def test_fixed_columns_are_kept(spark, tmp_path):
    base = str(tmp_path)
    save_table(spark.range(3), "fixed", base, schema_change=False)
    save_table(spark.range(2), "fixed", base, schema_change=False)
    with pytest.raises(ValueError, match="would change"):
        save_table(spark.range(2).selectExpr("id AS other"), "fixed", base, schema_change=False)
    assert read_saved(spark, f"{base}/fixed").count() == 2


def test_a_new_location_replaces_the_old(spark, tmp_path):
    save_table(spark.range(3), "moving", f"{tmp_path}/a", schema="sink_test")
    save_table(spark.range(5), "moving", f"{tmp_path}/it's b", schema="sink_test")
    assert spark.table("sink_test.moving").count() == 5
    assert read_saved(spark, f"{tmp_path}/a/moving").count() == 3


def test_managed_tables_are_left_alone(spark, tmp_path):
    spark.sql("CREATE SCHEMA IF NOT EXISTS sink_test")
    spark.range(3).write.saveAsTable("sink_test.owned")
    with pytest.raises(ValueError, match="managed"):
        save_table(spark.range(5), "owned", str(tmp_path), schema="sink_test")
    assert spark.table("sink_test.owned").count() == 3
    spark.sql("DROP TABLE sink_test.owned")


@pytest.mark.parametrize("fmt", ["orc", "json"])
def test_other_formats(spark, tmp_path, fmt):
    save_table(spark.range(3), f"as_{fmt}", str(tmp_path), schema="sink_test", fmt=fmt)
    assert rows(spark.table(f"sink_test.as_{fmt}")) == [(0,), (1,), (2,)]


def test_append_missing_keeps_the_key_unique(spark, tmp_path):
    base = str(tmp_path)

    def keys(*values):
        return spark.createDataFrame([(v,) for v in values], "k long")

    append_missing(keys(1, 2, None), "k", "keys", base)
    append_missing(keys(2, 3, None), "k", "keys", base)
    assert rows(append_missing(keys(3), "k", "keys", base)) == [(1,), (2,), (3,), (None,)]


def test_verify_goes_on_after_an_error(spark, tmp_path):
    save_table(spark.range(3), "present", str(tmp_path), schema="sink_test")
    checks = verify_tables(spark, "sink_test", ["absent", "present"], limit=2)
    assert checks["absent"].row_count is None and "absent" in checks["absent"].error
    assert checks["present"].row_count == 3 and len(checks["present"].sample) == 2


# Staging


def test_staging_is_deleted_even_after_an_error(spark):
    with pytest.raises(RuntimeError), staging_folder(spark) as folder:
        assert folder.startswith(shared_folder(spark))
        assert write_and_read(spark.range(3), f"{folder}/numbers").count() == 3
        raise RuntimeError
    assert not path_exists(spark, folder)


def test_a_load_leaves_no_staging(spark, trips, tmp_path):
    before = set(Path(shared_folder(spark)).iterdir())
    load(spark, trips.limit(10), sample_zones(spark, SF_SMALL), str(tmp_path / "mart"))
    assert set(Path(shared_folder(spark)).iterdir()) == before


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        sparkContext = Context
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session)
    Context.master = "local[2]"
    assert "tripmart-" in shared_folder(Session)
