"""Writing tables and registering them in the catalog.

A table is first written whole to a version folder that nothing reads yet. When
everything of a load is complete, one file that lists the folders of all tables
is put in place (see `versions`), and the catalog follows it. Two loads into one
base path must not overlap.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from tripmart.schema import quoted
from tripmart.sinks import versions
from tripmart.sinks.files import delete_path, folders_at, holds_files, path_exists
from tripmart.sinks.versions import Manifest, Saved

# Formats that keep their own columns, versions and partitions beside the data.
SELF_DESCRIBING = ("delta", "iceberg")

# Fixed value: how Hive layouts write a null partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def table_path(base_path: str, name: str) -> str:
    """The one place where table `name` lies under `base_path`."""
    return f"{base_path.rstrip('/')}/{name}"


def read_saved(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The table whose place is `path`, as the last load has left it, or None if there is none."""
    if fmt in SELF_DESCRIBING:
        return spark.read.format(fmt).load(path) if path_exists(spark, path) else None
    base_path, _, name = path.rstrip("/").rpartition("/")
    saved = versions.current(spark, base_path).tables.get(name)
    return versions.read_version(spark, base_path, name, saved) if saved else None


def read_all(
    spark: SparkSession, base_path: str, names: Iterable[str], fmt: str = "parquet", optional: Iterable[str] = ()
) -> dict[str, DataFrame]:
    """Several tables of one base path, all as the same load has left them, and the `optional` ones that are there."""
    if fmt in SELF_DESCRIBING:
        there = [name for name in optional if path_exists(spark, table_path(base_path, name))]
        return {name: spark.read.format(fmt).load(table_path(base_path, name)) for name in (*names, *there)}
    held = versions.current(spark, base_path).tables
    names = [*names, *(name for name in optional if name in held)]
    if missing := [name for name in names if name not in held]:
        raise FileNotFoundError(f"no table {', '.join(missing)} under {base_path}")
    return {name: versions.read_version(spark, base_path, name, held[name]) for name in names}


@dataclass(frozen=True)
class Prepared:
    """A table, or partitions of it, complete in a version folder; `parts` are its folders by partition."""

    rows: DataFrame
    name: str
    base_path: str
    fmt: str
    parts: dict[str, str] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()
    added: list[dict[str, object]] = field(default_factory=list)
    removed: list[dict[str, object]] = field(default_factory=list)
    version: str | None = None
    buckets: tuple[str, int] | None = None

    @property
    def path(self) -> str:
        return table_path(self.base_path, self.name)

    def read(self) -> DataFrame:
        """The prepared rows as written; rows of self-describing formats are written only by `put_in_place`."""
        return versions.read_version(self.rows.sparkSession, self.base_path, self.name, self.saved()) if self.version else self.rows

    def saved(self, before: Saved | None = None) -> Saved:
        """The whole table with what was prepared in it."""
        written = {self.version: len(self.parts)}
        new = Saved(self.fmt, self.rows.schema.json(), self.partition_by, self.parts, written, self.buckets)
        if not self.partition_by or before is None:
            return new
        gone = {_folder(p) for p in (*self.added, *self.removed)}
        parts = {**{k: v for k, v in before.parts.items() if k not in gone}, **self.parts}
        return replace(new, parts=parts, written=before.written | written)


def check_layout(
    spark: SparkSession, name: str, base_path: str, fmt: str = "parquet", partitioned: bool = False
) -> None:
    """Refuse a plain table where partitions lie, and partitions where a plain table lies."""
    path = table_path(base_path, name)
    if fmt in SELF_DESCRIBING:
        if not partitioned and any("=" in folder for folder in folders_at(spark, path, 1)):
            raise ValueError(f"{path} holds partitions, which a plain load would delete; choose another folder")
        return
    if holds_files(spark, path, "part-*"):
        raise ValueError(f"{path} holds files that are not a version of a table; choose another folder")
    saved = versions.current(spark, base_path).tables.get(name)
    if saved and partitioned and not saved.partition_by:
        raise ValueError(f"{path} holds a table without partitions; choose another folder")
    if saved and not partitioned and saved.partition_by:
        raise ValueError(f"{path} holds partitions, which a plain load would delete; choose another folder")


def check_columns(df: DataFrame, name: str, base_path: str, fmt: str = "parquet") -> None:
    """Refuse to replace a saved table, or a part of it, by one of other columns or types."""
    path = table_path(base_path, name)
    old = read_saved(df.sparkSession, path, fmt)

    def columns(df: DataFrame) -> list[tuple[str, str]]:
        return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]

    if old is not None and columns(old) != columns(df):
        raise ValueError(f"columns of {path} would change: {columns(old)} to {columns(df)}")


def check_catalog(spark: SparkSession, schema: str | None, names: Iterable[str]) -> None:
    """Refuse a catalog schema that has managed tables of these names."""
    for name in names if schema is not None else ():
        _registered(spark, f"{quoted(schema)}.{quoted(name)}")


def prepare_table(df: DataFrame, name: str, base_path: str, fmt: str = "parquet") -> Prepared:
    """Write a whole table as a new version."""
    if fmt in SELF_DESCRIBING:
        return Prepared(df, name, base_path, fmt)
    folder, path = versions.new_version(base_path, name)
    _write(df.write.format(fmt), df.sparkSession, path)
    return Prepared(df, name, base_path, fmt, {"": folder}, version=folder)


def by_buckets(df: DataFrame, column: str, buckets: int, spread: str | None = None) -> DataFrame:
    """`df` dealt so that each task writes few buckets of `column`.

    With `spread`, a column that tells rows of one value apart, rows are cut into
    ranges of bucket and `spread`: a value with a large share of the rows is
    written by several tasks. A table that is unique on `column` does without.
    """
    if spread is None:
        return df.repartition(buckets, quoted(column))
    bucket = F.pmod(F.hash(quoted(column)), F.lit(buckets))
    return df.repartitionByRange(buckets, bucket, F.col(quoted(spread)))


def prepare_bucketed(
    df: DataFrame, column: str, buckets: int, name: str, base_path: str, schema: str, fmt: str = "parquet"
) -> Prepared:
    """Write a whole table as a new version whose files are bucketed by `column`.

    Only the catalog tells readers about buckets, so the files are written
    through a catalog table of `schema` that goes when they are complete.
    """
    spark = df.sparkSession
    if fmt in SELF_DESCRIBING:
        raise ValueError(f"{fmt} tables cannot be bucketed")
    folder, path = versions.new_version(base_path, name)
    create_schema(spark, schema)
    table = f"{quoted(schema)}.{quoted('writing_' + folder.rpartition('=')[2])}"
    try:
        spark.sql(
            f"CREATE TABLE {table} ({df.schema.toDDL()}) USING {fmt}"
            f" CLUSTERED BY ({quoted(column)}) INTO {buckets} BUCKETS LOCATION '{_literal(path)}'"
        )
        df.write.insertInto(table)
    except BaseException:
        delete_path(spark, path)
        raise
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    return Prepared(df, name, base_path, fmt, {"": folder}, version=folder, buckets=(column, buckets))


def prepare_partition(
    df: DataFrame, partition: Mapping[str, int], name: str, base_path: str, fmt: str = "parquet"
) -> Prepared:
    """Write one partition of a table as a new version, even if `df` is empty.

    Its values are constants, so the write needs no shuffle or sort.
    """
    labelled = df.withColumns({c: F.lit(value) for c, value in partition.items()})
    by, added = tuple(partition), [dict(partition)]
    if fmt in SELF_DESCRIBING:
        return Prepared(labelled, name, base_path, fmt, {}, by, added)
    folder, path = versions.new_version(base_path, name)
    own = _folder(partition)
    _write(df.write.format(fmt), df.sparkSession, path, own)
    return Prepared(labelled, name, base_path, fmt, {own: f"{folder}/{own}"}, by, added, version=folder)


def prepare_partitions(
    df: DataFrame,
    partition_by: Sequence[str],
    replaced: Iterable[Mapping[str, int | None]] | None,
    name: str,
    base_path: str,
    fmt: str = "parquet",
) -> Prepared:
    """Write the partitions in `replaced` as a new version; those without rows will be removed.

    None: the table is new, and has the partitions that `df` has.
    """
    by = tuple(partition_by)
    if replaced is None and fmt in SELF_DESCRIBING:
        replaced = [r.asDict() for r in df.select(*by).distinct().collect()]
    replaced = None if replaced is None else [dict(p) for p in replaced]
    if fmt in SELF_DESCRIBING:
        return Prepared(df, name, base_path, fmt, {}, by, replaced)
    folder, path = versions.new_version(base_path, name)
    _write(df.write.format(fmt).partitionBy(*by), df.sparkSession, path)
    written = set(folders_at(df.sparkSession, path, len(by)))
    replaced = [_values(f) for f in sorted(written)] if replaced is None else replaced
    added = [p for p in replaced if _folder(p) in written]
    removed = [p for p in replaced if _folder(p) not in written]
    parts = {_folder(p): f"{folder}/{_folder(p)}" for p in added}
    return Prepared(df, name, base_path, fmt, parts, by, added, removed, folder)


def _write(writer: DataFrameWriter, spark: SparkSession, version: str, part: str = "") -> None:
    """Write a version, or a part of it, and leave nothing if that fails."""
    try:
        writer.save(f"{version}/{part}".rstrip("/"))
    except BaseException:
        delete_path(spark, version)
        raise


def put_in_place(prepared: Sequence[Prepared], schema: str | None = None) -> dict[str, DataFrame]:
    """Switch to what was prepared, all tables at once, and return the whole tables as read back.

    They must be of one base path. Formats with their own log are written one by
    one before. If the switch does not happen, what was prepared is deleted.
    """
    spark, base_path = prepared[0].rows.sparkSession, prepared[0].base_path
    try:
        for p in prepared:
            if p.fmt in SELF_DESCRIBING:
                _overwrite(p)
        before = versions.current(spark, base_path)
        new = {p.name: p.saved(before.tables.get(p.name)) for p in prepared if p.version}
        now = versions.switch(spark, base_path, before, before.tables | new) if new else before
    except BaseException:
        discard(prepared)
        raise
    found = {p.name: publish(p, now, schema) for p in prepared}
    if new:
        versions.clean(spark, base_path, now, before)
    return found


def _overwrite(prepared: Prepared) -> None:
    writer = prepared.rows.write.format(prepared.fmt).mode("overwrite")
    if prepared.partition_by:
        chosen = " OR ".join(f"({_condition(p)})" for p in prepared.added)
        writer = writer.option("replaceWhere", chosen).partitionBy(*prepared.partition_by)
    else:
        writer = writer.option("overwriteSchema", "true")
    writer.save(prepared.path)


def discard(prepared: Iterable[Prepared]) -> None:
    """Delete what was prepared and is not in place."""
    for p in prepared:
        if p.version:
            spark = p.rows.sparkSession
            if not versions.current(spark, p.base_path).folders() & set(p.parts.values()):
                delete_path(spark, f"{p.base_path.rstrip('/')}/{p.version}")


def save_tables(
    tables: Mapping[str, DataFrame],
    base_path: str,
    schema: str | None = None,
    fmt: str = "parquet",
    schema_change: bool = True,
) -> dict[str, DataFrame]:
    """Overwrite tables under `base_path`, all at once, and return them as read back.

    A temp view is made per table and, given a `schema`, an external catalog
    table. `schema_change=False` refuses to replace a table of other columns.
    """
    for name, df in tables.items():
        check_layout(df.sparkSession, name, base_path, fmt)
        check_catalog(df.sparkSession, schema, [name])
        if not schema_change:
            check_columns(df, name, base_path, fmt)
    prepared: list[Prepared] = []
    try:
        for name, df in tables.items():
            prepared.append(prepare_table(df, name, base_path, fmt))
    except BaseException:
        discard(prepared)
        raise
    return put_in_place(prepared, schema) if prepared else {}


def save_table(
    df: DataFrame,
    name: str,
    base_path: str,
    schema: str | None = None,
    fmt: str = "parquet",
    schema_change: bool = True,
) -> DataFrame:
    """`save_tables` for one table."""
    return save_tables({name: df}, base_path, schema, fmt, schema_change)[name]


def replace_partition(
    df: DataFrame,
    partition: Mapping[str, int],
    name: str,
    base_path: str,
    schema: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Replace one partition of a table and return the whole table; columns and types must stay."""
    check_layout(df.sparkSession, name, base_path, fmt, partitioned=True)
    check_catalog(df.sparkSession, schema, [name])
    labelled = df.withColumns({c: F.lit(value) for c, value in partition.items()})
    check_columns(labelled, name, base_path, fmt)
    return put_in_place([prepare_partition(df, partition, name, base_path, fmt)], schema)[name]


def append_missing(
    df: DataFrame,
    key: str,
    name: str,
    base_path: str,
    schema: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Add to a saved plain table the rows whose key it lacks, so the key stays unique.

    `df` must be unique on `key` itself and have the table's columns. Running it
    twice adds nothing. The whole table is compared and written as a new version:
    for a table that grows with every load, replace the partitions that a load
    touches instead.
    """
    path = table_path(base_path, name)
    check_layout(df.sparkSession, name, base_path, fmt)
    check_catalog(df.sparkSession, schema, [name])
    saved = read_saved(df.sparkSession, path, fmt)
    if saved is not None:
        check_columns(df, name, base_path, fmt)
        known = saved.select(F.col(quoted(key)).alias("__known"))
        # Null-safe equality is still a hash or merge join, and finds a null key again.
        missing = df.join(known, df[quoted(key)].eqNullSafe(known["__known"]), "left_anti")
        df = saved.unionByName(missing)
    return put_in_place([prepare_table(df, name, base_path, fmt)], schema)[name]


def publish(prepared: Prepared, now: Manifest, schema: str | None = None) -> DataFrame:
    """Read back what is in place, as temp view and catalog table too."""
    spark, name, saved = prepared.rows.sparkSession, prepared.name, now.tables.get(prepared.name)
    if prepared.fmt in SELF_DESCRIBING:
        whole = read_written(prepared.rows, prepared.path, prepared.fmt)
    else:
        whole = versions.read_version(spark, prepared.base_path, name, saved)
    whole.createOrReplaceTempView(name)
    if schema is not None and prepared.fmt in SELF_DESCRIBING:
        register_table(whole, schema, name, prepared.path, prepared.fmt, prepared.partition_by)
    elif schema is not None:
        register_saved(whole, schema, name, prepared.base_path, saved)
    return whole


def register_saved(whole: DataFrame, schema: str, name: str, base_path: str, saved: Saved) -> None:
    """Point `schema.name` at the folders of a version."""
    base = base_path.rstrip("/")
    if saved.partition_by:
        places = {folder: f"{base}/{place}" for folder, place in saved.parts.items()}
        register_table(whole, schema, name, table_path(base, name), saved.fmt, saved.partition_by, places)
    else:
        register_table(whole, schema, name, f"{base}/{saved.parts['']}", saved.fmt, buckets=saved.buckets)


def register_all(spark: SparkSession, base_path: str, schema: str) -> None:
    """Point a catalog schema at the tables of a base path as the last load has left them.

    For a schema that has fallen behind: a load that ended between its switch
    and the catalog, or one without a schema.
    """
    now = versions.current(spark, base_path)
    check_catalog(spark, schema, now.tables)
    for name, saved in now.tables.items():
        register_saved(versions.read_version(spark, base_path, name, saved), schema, name, base_path, saved)


def read_written(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """The files at `path` with the columns of `df`, which was written there."""
    reader = df.sparkSession.read.format(fmt)
    return (reader if fmt in SELF_DESCRIBING else reader.schema(df.schema)).load(path)


def create_schema(spark: SparkSession, schema: str, location: str | None = None) -> None:
    where = f" LOCATION '{_literal(location)}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted(schema)}{where}")


def use_schema(spark: SparkSession, schema: str) -> None:
    """Make `schema` the one that plain table names refer to."""
    spark.catalog.setCurrentDatabase(schema)


def register_table(
    saved: DataFrame,
    schema: str,
    name: str,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    places: Mapping[str, str] | None = None,
    buckets: tuple[str, int] | None = None,
) -> None:
    """Point `schema.name` at the files of `saved` in `path`, and its partitions at their `places`.

    An external table of that name stays, with its comment, grants and
    statistics, while columns, format, partitioning and buckets are the same: its
    location is altered if need be, and so are those of partitions. Nobody scans
    for partitions, and none is missing while its location changes. Otherwise
    the table is registered anew. A managed table owns its files and is left alone.
    """
    spark, places = saved.sparkSession, places or {}
    create_schema(spark, schema)
    table, where = f"{quoted(schema)}.{quoted(name)}", f"LOCATION '{_literal(path)}'"
    known = _registered(spark, table)
    plain = fmt not in SELF_DESCRIBING
    wanted = [(f.name, f.dataType.simpleString()) for f in saved.schema.fields]
    same = known and known["columns"] == wanted and known["provider"] == fmt
    same = same and known["partition_by"] == list(partition_by) and (not partition_by or known["at"](path))
    same = same and known["buckets"] == buckets
    if known and not same:
        spark.sql(f"DROP TABLE {table}")
    if same and not known["at"](path):
        spark.sql(f"ALTER TABLE {table} SET {where}")
    if not same:
        columns = f"({saved.schema.toDDL()})" if plain else ""
        by = ", ".join(map(quoted, partition_by))
        partitions = f"PARTITIONED BY ({by})" if plain and partition_by else ""
        clustered = f"CLUSTERED BY ({quoted(buckets[0])}) INTO {buckets[1]} BUCKETS" if buckets else ""
        spark.sql(f"CREATE TABLE {table} {columns} USING {fmt} {partitions} {clustered} {where}")
    if plain and partition_by:
        _move_partitions(spark, table, places)
    spark.catalog.refreshTable(table)


def _move_partitions(spark: SparkSession, table: str, places: Mapping[str, str]) -> None:
    """Make a catalog table's partitions those of `places`."""
    held = {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    located = lambda f: f"PARTITION ({_spec(_values(f))}) LOCATION '{_literal(places[f])}'"
    if new := " ".join(located(f) for f in places if f not in held):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {new}")
    for folder in held & set(places):
        at = f"PARTITION ({_spec(_values(folder))})"
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {at}").filter("col_name = 'Location'").first()
        if described is None or not described["data_type"].endswith(places[folder].rpartition(f"{versions.VERSION}=")[2]):
            spark.sql(f"ALTER TABLE {table} {at} SET LOCATION '{_literal(places[folder])}'")
    for folder in held - set(places):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({_spec(_values(folder))})")


def _registered(spark: SparkSession, table: str) -> dict | None:
    """Columns, format, partitioning, buckets and place of an external catalog table."""
    if not spark.catalog.tableExists(table):
        return None
    if spark.catalog.getTable(table).tableType == "MANAGED":
        raise ValueError(f"{table} is a managed table; choose another schema or drop it")
    # Columns come first, then sections that begin with a line of their own.
    parts: dict[str, list[tuple[str, str]]] = {"": []}
    section = ""
    for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect():
        if row["col_name"].startswith("# ") and row["col_name"] != "# col_name":
            section = row["col_name"]
            parts[section] = []
        elif row["col_name"] and row["col_name"] != "# col_name":
            parts[section].append((row["col_name"], row["data_type"]))
    facts = dict(parts["# Detailed Table Information"])
    place = spark._jvm.org.apache.hadoop.fs.Path(facts["Location"]).toUri().getPath()
    return {
        "columns": parts[""],
        "partition_by": [name for name, _ in parts.get("# Partition Information", [])],
        "provider": facts["Provider"].lower(),
        "buckets": (facts["Bucket Columns"][2:-2], int(facts["Num Buckets"])) if "Num Buckets" in facts else None,
        "at": lambda path: spark._jvm.org.apache.hadoop.fs.Path(path).toUri().getPath() == place,
    }


def _folder(partition: Mapping[str, object]) -> str:
    return "/".join(f"{c}={NULL_PARTITION if v is None else v}" for c, v in partition.items())


def _values(folder: str) -> dict[str, object]:
    pairs = (part.split("=", 1) for part in folder.split("/"))
    return {c: None if v == NULL_PARTITION else v for c, v in pairs}


def _spec(partition: Mapping[str, object]) -> str:
    return ", ".join(f"{quoted(c)} = {'null' if v is None else v}" for c, v in partition.items())


def _condition(partition: Mapping[str, object]) -> str:
    return " AND ".join(f"{quoted(c)} <=> {'null' if v is None else v}" for c, v in partition.items())


def partition_filter(partitions: Iterable[Mapping[str, object]]) -> str:
    """A condition on partition columns alone, so that only these partitions are read."""
    return " OR ".join(f"({_condition(p)})" for p in partitions) or "false"


def _literal(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")
