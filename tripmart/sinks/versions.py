"""What the tables under a base path consist of, as one file that a load replaces in one move.

Each load writes its tables to version folders that nothing reads yet. Then one
small file, the next in number, lists for every table the folders that it
consists of. It is written beside and renamed to its name, which is the switch
of all tables at once: a reader sees the tables of the file before or of this
one. The folders that only older files name are deleted by the load after next,
so a reader that has begun can go on while one load switches.
"""

from __future__ import annotations

import json
import uuid
import warnings
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructType

from tripmart.sinks.files import delete_path, file_names, folders_at, move_new, read_text, write_text

#: Folder of the files; readers of data ignore names with an underscore in front.
LOADS = "_loads"
#: How version folders are called: like a partition, so that one scan can read partitions of several.
VERSION = "__version"


@dataclass(frozen=True)
class Saved:
    """A table: its format, columns, partitioning, and the folder of each partition, relative to the base path.

    A table without partitions has one folder, under ''. `written` tells how
    many partitions a version was written with, `buckets` by what column and
    into how many buckets its files are dealt.
    """

    fmt: str
    schema: str
    partition_by: tuple[str, ...] = ()
    parts: dict[str, str] = field(default_factory=dict)
    written: dict[str, int] = field(default_factory=dict)
    buckets: tuple[str, int] | None = None

    @property
    def columns(self) -> StructType:
        return StructType.fromJson(json.loads(self.schema))


@dataclass(frozen=True)
class Manifest:
    """All tables of a base path after the load of this number; 0 is before the first."""

    number: int = 0
    tables: dict[str, Saved] = field(default_factory=dict)

    def folders(self) -> set[str]:
        return {folder for saved in self.tables.values() for folder in saved.parts.values()}


def new_version(base_path: str, name: str) -> tuple[str, str]:
    """A folder for the next version of a table: relative to the base path, and whole."""
    folder = f"{name}/{VERSION}={uuid.uuid4().hex}"
    return folder, f"{base_path.rstrip('/')}/{folder}"


def current(spark: SparkSession, base_path: str) -> Manifest:
    """The tables as the last load has left them."""
    numbers = _numbers(spark, base_path)
    return _read(spark, base_path, numbers[-1]) if numbers else Manifest()


def switch(spark: SparkSession, base_path: str, before: Manifest, tables: dict[str, Saved]) -> Manifest:
    """Make `tables` the current ones, all at once. Fails if another load has switched since `before`."""
    new = Manifest(before.number + 1, tables)
    text = json.dumps({name: asdict(saved) for name, saved in tables.items()}, indent=1)
    folder = f"{base_path.rstrip('/')}/{LOADS}"
    beside = f"{folder}/.new-{uuid.uuid4().hex}"
    write_text(spark, beside, text)
    try:
        move_new(spark, beside, f"{folder}/{new.number:010d}.json")
    finally:
        delete_path(spark, beside)
    return new


def read_version(spark: SparkSession, base_path: str, name: str, saved: Saved) -> DataFrame:
    """A table as a manifest has it. Columns are known, so no job infers them."""
    base, columns = base_path.rstrip("/"), saved.columns
    if not saved.parts:
        return spark.createDataFrame([], columns)
    reader = spark.read.format(saved.fmt)
    if not saved.partition_by:
        return reader.schema(columns).load(f"{base}/{saved.parts['']}")
    whole = _live_counts(saved)
    folders = sorted(
        {v if whole[v] == saved.written.get(v) else part for part in saved.parts.values() for v in [_version_of(part)]}
    )
    reader = reader.schema(StructType([*columns.fields]).add(VERSION, StringType()))
    found = reader.option("basePath", f"{base}/{name}").load([f"{base}/{f}" for f in folders])
    return found.select(*[found[f"`{c}`"] for c in columns.fieldNames()])


def clean(spark: SparkSession, base_path: str, now: Manifest, before: Manifest) -> None:
    """Delete what neither of the last two manifests names. Loads into a base path must not overlap."""
    base, kept = base_path.rstrip("/"), now.folders() | before.folders()
    versions = {_version_of(folder) for folder in kept}
    try:
        for number in _numbers(spark, base):
            if number < before.number:
                for folder in _read(spark, base, number).folders() - kept:
                    delete_path(spark, f"{base}/{folder}")
                delete_path(spark, f"{base}/{LOADS}/{number:010d}.json")
        for name in now.tables:
            for folder in folders_at(spark, f"{base}/{name}", 1, hidden=True):
                if folder.startswith(f"{VERSION}=") and f"{name}/{folder}" not in versions:
                    delete_path(spark, f"{base}/{name}/{folder}")
    except (Py4JError, OSError) as error:  # the load itself is complete
        warnings.warn(f"old versions under {base} could not be deleted: {error}", stacklevel=2)


def _version_of(folder: str) -> str:
    """The version folder that a folder is, or lies in."""
    return "/".join(folder.split("/")[:2])


def _live_counts(saved: Saved) -> dict[str, int]:
    counts: dict[str, int] = {}
    for folder in saved.parts.values():
        counts[_version_of(folder)] = counts.get(_version_of(folder), 0) + 1
    return counts


def _numbers(spark: SparkSession, base_path: str) -> list[int]:
    names = file_names(spark, f"{base_path.rstrip('/')}/{LOADS}")
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _read(spark: SparkSession, base_path: str, number: int) -> Manifest:
    held = json.loads(read_text(spark, f"{base_path.rstrip('/')}/{LOADS}/{number:010d}.json"))
    return Manifest(number, {name: _saved(**facts) for name, facts in held.items()})


def _saved(partition_by: list[str], buckets: list | None = None, **facts) -> Saved:
    """A table as a manifest's file has it, whose lists stand for tuples."""
    return Saved(partition_by=tuple(partition_by), buckets=tuple(buckets) if buckets else None, **facts)
