"""One month of trips, from raw file to saved star schema and reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripmart.operators.digests import row_groups_by_digest
from tripmart.operators.enrich import enrich_trips
from tripmart.operators.model import dim_time, fact_trips, normalise, zoneless
from tripmart.operators.numbering import numbered
from tripmart.operators.quality import (
    OCCURRENCES,
    count_columns,
    has_required,
    repeat_rows,
)
from tripmart.plans.reports import TOTALS_TABLE, all_reports, month_totals
from tripmart.schema import (
    CURRENCY_COLUMNS,
    FACT_COLUMNS,
    REQUIRED_COLUMNS,
    RETENTION_WARNING_PCT,
    STAR_TABLES,
    quoted,
)
from tripmart.sinks import (
    Prepared,
    by_buckets,
    check_catalog,
    check_columns,
    check_layout,
    discard,
    partition_filter,
    prepare_bucketed,
    prepare_partition,
    prepare_partitions,
    prepare_table,
    put_in_place,
    read_all,
    read_saved,
    rows_in_files,
    staging_folder,
    table_path,
    write_and_read,
)
from tripmart.sinks.tables import SELF_DESCRIBING
from tripmart.sources import (
    MONTH_FILE,
    dim_payment_type,
    dim_rate_code,
    read_trips,
    read_zones,
)

DUPLICATES_TABLE = "duplicate_trips"

PICKUP_TIME = "tpep_pickup_datetime"

# Partition columns of the by-month mart: of fact and duplicates, and of the time dimension.
LOAD_MONTH = ("trip_year", "trip_month")
PICKUP_MONTH = ("pickup_year", "pickup_month")

# The columns of the fact, in the order by which repeatable ids count: by pickup time first.
TRIP_ORDER = sorted(
    (c for c in FACT_COLUMNS if c != "trip_id"), key=lambda c: (c != "tpep_pickup_datetime", FACT_COLUMNS.index(c))
)


@dataclass(frozen=True)
class LoadQuality:
    """What cleaning found in one load. Shares are None without any input rows."""

    initial_count: int
    distinct_count: int
    duplicate_count: int
    final_count: int
    retention_pct: float | None
    low_retention: bool | None
    null_counts: dict[str, int | None]
    negative_counts: dict[str, int | None]


@dataclass(frozen=True)
class PipelineResult:
    """Saved tables by name, and the load's quality."""

    tables: dict[str, DataFrame]
    quality: LoadQuality

    @property
    def reports(self) -> dict[str, DataFrame]:
        """All reports by name, each still lazy."""
        return all_reports(self.tables)


def run(
    spark: SparkSession,
    source: str,
    zones_path: str,
    year: int | str,
    month: int | str,
    base_path: str,
    schema: str | None = None,
    fmt: str = "parquet",
    by_month: bool = False,
    pattern: str = MONTH_FILE,
    time_zone: str | None = "UTC",
    repeatable_ids: bool = False,
    keep_totals: bool = False,
    time_buckets: int | None = None,
) -> PipelineResult:
    """Load the trips of one month from the folder `source` and save the star schema.

    A load replaces the tables of the one before. With `by_month` the fact and
    the duplicates are partitioned by load month and only that month is
    replaced, the time dimension is partitioned by month of pickup and keeps
    exactly the fact's times, and (trip_year, trip_month, trip_id) identifies a
    trip. A plain load refuses to replace months, and the other way round.

    Zoned times become local times of `time_zone` (None: the session's zone), so
    that hours and dates are the same in every later session. With
    `repeatable_ids` a trip's id follows from the load's trips alone, and with
    `time_buckets` fact and time dimension are joined without a shuffle, see `load`.
    """
    raw = read_trips(spark, source, year, month, pattern)
    load_month = (int(year), int(month)) if by_month else None
    zones = read_zones(spark, zones_path)
    return load(
        spark, raw, zones, base_path, schema, fmt, load_month, time_zone, repeatable_ids, keep_totals, time_buckets
    )


def load(
    spark: SparkSession,
    raw: DataFrame,
    zones: DataFrame,
    base_path: str,
    schema: str | None = None,
    fmt: str = "parquet",
    load_month: tuple[int, int] | None = None,
    time_zone: str | None = "UTC",
    repeatable_ids: bool = False,
    keep_totals: bool = False,
    time_buckets: int | None = None,
) -> PipelineResult:
    """`run` for raw trips and zones that are already DataFrames.

    Columns, types and layout are checked before the first row is written. Rows
    that occur once pass without a shuffle; distinct rows with their counts go to
    a staging table. The quality figures are observed in that write; duplicates
    and the fact are column-pruned scans of it. The rows that the writes of these
    observe and those in their files are compared, so a step that loses one is refused. The time
    dimension comes from the written fact.
    All tables are complete before one move switches to them, so a reader sees
    all tables of one load. Loads into one base path must not overlap.

    `trip_id` is increasing and unique, but differs from load to load. With
    `repeatable_ids` it is the trip's place, from 0, in the order of all the
    fact's columns: the same trips get the same ids however they are partitioned.
    That costs a range sort of the fact, which is then stored in that order.

    With `keep_totals` a mart by month has a further table: what reports add up,
    for each load month. It is replaced with its month, made for all months by
    the first load that asks for it, and kept by every load from then on.

    With `time_buckets` the files of fact and time dimension are dealt into that
    many buckets by pickup time, and the catalog's tables say so: a join of both
    through the catalog then shuffles neither. A bucket is read by one task, so
    there should be several per core, and one time that has a large share of all
    trips makes one long task; its trips are written by several. This is for
    plain loads with a `schema`, as nothing but the catalog knows of buckets.
    """
    if time_buckets is not None and (schema is None or load_month is not None):
        raise ValueError("buckets need a catalog schema and a load without months")
    if time_buckets is not None and (time_buckets < 1 or fmt in SELF_DESCRIBING):
        raise ValueError(f"{time_buckets} buckets of {fmt} files cannot be written")
    time_zone = time_zone or spark.conf.get("spark.sql.session.timeZone")
    partition = dict(zip(LOAD_MONTH, load_month, strict=True)) if load_month else None
    lookups = {
        "dim_payment_type": dim_payment_type(spark),
        "dim_rate_code": dim_rate_code(spark),
        "dim_taxi_zone": zones,
    }
    _check(raw, lookups, base_path, schema, fmt, partition, time_zone)

    prepared: list[Prepared] = []
    try:
        with staging_folder(spark) as staging:
            seen = Observation("trip_groups")
            found = row_groups_by_digest(raw, folder=f"{staging}/digests")
            groups = write_and_read(found.observe(seen, *_figures(found)), f"{staging}/trip_groups")
            quality, repeated = _quality(seen.get), seen.get["repeated"]
            duplicates = zoneless(repeat_rows(groups.filter(F.col(OCCURRENCES) > 1)), time_zone)
            fact = _fact(groups.drop(OCCURRENCES), time_zone)
            if repeatable_ids:
                fact = numbered(fact.select(*TRIP_ORDER), "trip_id", f"{staging}/sorted").select(*FACT_COLUMNS)
            if time_buckets:  # before the rows are observed, as the cuts of ranges read them once more
                fact = by_buckets(fact, PICKUP_TIME, time_buckets, spread="trip_id")
            wanted = {DUPLICATES_TABLE: repeated, "fact_trips": quality.final_count}
            seen_written = {}
            for name, df in {
                DUPLICATES_TABLE: duplicates,
                "fact_trips": fact,
            }.items():
                seen_written[name] = Observation(name)
                df = df.observe(seen_written[name], F.count(F.lit(1)).alias("rows"))
                if time_buckets and name == "fact_trips":
                    prepared.append(prepare_bucketed(df, PICKUP_TIME, time_buckets, name, base_path, schema, fmt))
                elif partition is None:
                    prepared.append(prepare_table(df, name, base_path, fmt))
                else:
                    prepared.append(prepare_partition(df, partition, name, base_path, fmt))
            if all(p.version for p in prepared):  # formats with their own log write later
                places = {p.name: (fmt, f"{base_path.rstrip('/')}/{p.version}") for p in prepared}
                places["trip_groups"] = "parquet", f"{staging}/trip_groups"
                counts = rows_in_files(spark, places)
                observed = {name: seen.get["rows"] for name, seen in seen_written.items()}
                observed["trip_groups"] = wanted["trip_groups"] = quality.distinct_count
                for name in places:
                    if not wanted[name] == observed[name] == counts[name]:
                        raise ValueError(
                            f"{name} should have {wanted[name]} rows; {observed[name]} were written"
                            f" and its files have {counts[name]}"
                        )
        fact = prepared[-1].read()
        if time_buckets:
            times = by_buckets(dim_time(fact), PICKUP_TIME, time_buckets)
            prepared.append(prepare_bucketed(times, PICKUP_TIME, time_buckets, "dim_time", base_path, schema, fmt))
        elif partition is None:
            prepared.append(prepare_table(dim_time(fact), "dim_time", base_path, fmt))
        else:
            prepared.append(prepare_times(fact, partition, base_path, fmt))
        if partition is not None and (keep_totals or read_saved(spark, table_path(base_path, TOTALS_TABLE), fmt)):
            prepared.append(prepare_totals(fact, partition, base_path, fmt))
        prepared += [prepare_table(df, name, base_path, fmt) for name, df in lookups.items()]
    except BaseException:
        discard(prepared)
        raise
    return PipelineResult(put_in_place(prepared, schema), quality)


def open_star(
    spark: SparkSession, schema: str | None = None, base_path: str | None = None, fmt: str = "parquet"
) -> dict[str, DataFrame]:
    """The saved star schema by table name, from a catalog schema or from its folder, for reports without a load.

    From a folder all tables are of one load. No job is run to find their
    columns. Totals by load month are among the tables if the mart keeps them.
    """
    if (schema is None) == (base_path is None):
        raise ValueError("give a schema or a base path")
    if schema is not None:
        there = [n for n in (TOTALS_TABLE,) if spark.catalog.tableExists(f"{quoted(schema)}.{quoted(n)}")]
        return {name: spark.table(f"{quoted(schema)}.{quoted(name)}") for name in (*STAR_TABLES, *there)}
    return read_all(spark, base_path, STAR_TABLES, fmt, optional=(TOTALS_TABLE,))


def _fact(distinct_trips: DataFrame, time_zone: str) -> DataFrame:
    return zoneless(fact_trips(enrich_trips(normalise(distinct_trips))), time_zone)


def _check(
    raw: DataFrame,
    lookups: dict[str, DataFrame],
    base_path: str,
    schema: str | None,
    fmt: str,
    partition: dict[str, int] | None,
    time_zone: str,
) -> None:
    """Everything that can be refused without reading trips."""
    spark = raw.sparkSession
    check_catalog(spark, schema, (*STAR_TABLES, DUPLICATES_TABLE))
    columns = {"fact_trips": _fact(raw, time_zone), DUPLICATES_TABLE: zoneless(raw, time_zone)}
    for name in (*columns, "dim_time"):
        check_layout(spark, name, base_path, fmt, partitioned=partition is not None)
    for name, df in lookups.items():
        check_layout(spark, name, base_path, fmt)
        check_columns(df, name, base_path, fmt)
    if partition is not None:
        for name, df in columns.items():
            labelled = df.withColumns({c: F.lit(value) for c, value in partition.items()})
            check_columns(labelled, name, base_path, fmt)


def prepare_times(fact: DataFrame, partition: dict[str, int], base_path: str, fmt: str = "parquet") -> Prepared:
    """The months of the time dimension that a load month changes.

    `fact` has the new trips of the load month. Times that only the month's old
    trips had go, unless another load month has them too: those are looked for
    in the range of these times only. Of the saved dimension just the months of
    pickup are read in which something comes or goes.
    """
    spark, time = fact.sparkSession, F.col("tpep_pickup_datetime")
    new = dim_time(fact).withColumns({"pickup_year": F.year(time), "pickup_month": F.month(time)})
    saved_fact = read_saved(spark, table_path(base_path, "fact_trips"), fmt)
    saved = read_saved(spark, table_path(base_path, "dim_time"), fmt)
    if saved is None and saved_fact is None:
        return prepare_partitions(new, PICKUP_MONTH, None, "dim_time", base_path, fmt)
    gone = None
    if saved_fact is not None:
        this_load = partition_filter([partition])
        old = saved_fact.filter(this_load).select(time).distinct()
        gone = _without(old, new)
        span = gone.agg(F.min(time).alias("low"), F.max(time).alias("high"), F.count("*").alias("n")).first()
        others = saved_fact.filter(f"NOT ({this_load})").select(time)
        near = time.between(F.lit(span["low"]), F.lit(span["high"])) if span["low"] is not None else F.lit(False)
        gone = _without(gone, others.filter(near | time.isNull())) if span["n"] else None
    months = new.select(*PICKUP_MONTH)
    if gone is not None:
        months = months.union(gone.select(F.year(time), F.month(time)))
    replaced = [r.asDict() for r in months.distinct().collect()]
    times = new
    if saved is not None:
        kept = saved.filter(partition_filter(replaced)).select(new.columns)
        times = new.union(_without(_without(kept, gone) if gone is not None else kept, new))
    return prepare_partitions(times, PICKUP_MONTH, replaced, "dim_time", base_path, fmt)


def prepare_totals(fact: DataFrame, partition: dict[str, int], base_path: str, fmt: str = "parquet") -> Prepared:
    """The totals of a load month, whose new trips are in `fact`; of all months if none are saved yet."""
    spark, months = fact.sparkSession, list(partition)
    own = fact.withColumns({c: F.lit(value) for c, value in partition.items()})
    if read_saved(spark, table_path(base_path, TOTALS_TABLE), fmt) is not None:
        return prepare_partition(month_totals(own, months).drop(*months), partition, TOTALS_TABLE, base_path, fmt)
    saved = read_saved(spark, table_path(base_path, "fact_trips"), fmt)
    if saved is not None:
        own = own.unionByName(saved.filter(f"NOT ({partition_filter([partition])})").select(own.columns))
    return prepare_partitions(month_totals(own, months), months, None, TOTALS_TABLE, base_path, fmt)


def _without(times: DataFrame, others: DataFrame) -> DataFrame:
    """Rows of `times` whose pickup time `others` does not have."""
    known = others.select(F.col("tpep_pickup_datetime").alias("__known"))
    return times.join(known, times["tpep_pickup_datetime"].eqNullSafe(known["__known"]), "left_anti")


def _figures(groups: DataFrame) -> list[Column]:
    """All figures of a load over its distinct rows, as aggregates that are observed while they are written."""
    complete, occurrences = has_required(groups), F.col(OCCURRENCES)
    return [
        F.coalesce(F.sum(occurrences), F.lit(0)).alias("initial"),
        F.count(F.lit(1)).alias("distinct"),
        F.coalesce(F.sum(F.when(occurrences > 1, occurrences)), F.lit(0)).alias("repeated"),
        F.count_if(complete).alias("final"),
        *count_columns(groups, REQUIRED_COLUMNS, "null", lambda c: c.isNull()),
        *count_columns(groups, CURRENCY_COLUMNS, "negative", lambda c: complete & (c < 0)),
    ]


def _quality(counts: dict[str, int]) -> LoadQuality:
    """A load's figures from what was observed."""
    initial, distinct, final = counts["initial"], counts["distinct"], counts["final"]
    kept = final / initial * 100 if initial else None
    return LoadQuality(
        initial_count=initial,
        distinct_count=distinct,
        duplicate_count=initial - distinct,
        final_count=final,
        retention_pct=kept,
        low_retention=None if kept is None else kept < RETENTION_WARNING_PCT,
        null_counts={c: counts[f"null{i}"] for i, c in enumerate(REQUIRED_COLUMNS)},
        negative_counts={c: counts[f"negative{i}"] for i, c in enumerate(CURRENCY_COLUMNS)},
    )
