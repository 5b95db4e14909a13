"""Tables that live for one run, in the folder the cluster shares.

A written table cuts the lineage: what follows reads files, only the columns it
needs, and a lost executor costs no more than its own tasks.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripmart.sinks.files import delete_path
from tripmart.sinks.tables import read_written


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir or set by setCheckpointDir.

    Without one, a temporary folder serves a local master. On a cluster the
    executors would not share it, so that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder().name


@lru_cache(maxsize=1)
def _local_folder() -> tempfile.TemporaryDirectory:
    return tempfile.TemporaryDirectory(prefix="tripmart-")


def new_folder(spark: SparkSession) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/tripmart-{uuid.uuid4().hex}"


@contextmanager
def staging_folder(spark: SparkSession) -> Iterator[str]:
    """A new folder in the shared one, deleted with its content at the end."""
    folder = new_folder(spark)
    try:
        yield folder
    finally:
        delete_path(spark, folder)


def write_and_read(df: DataFrame, path: str) -> DataFrame:
    """Write `df` as Parquet and continue from the files."""
    df.write.mode("errorifexists").parquet(path)
    return read_written(df, path)


def rows_in_files(spark: SparkSession, places: dict[str, tuple[str, str]]) -> dict[str, int]:
    """Rows in the files of folders, by name: `places` has the format and the folder of each, whose last part is unique.

    One scan for each format, which reads no column. Writes observe what their
    tasks put out; files tell what is there if tasks were repeated.
    """
    found = {}
    for fmt in {kind for kind, _ in places.values()}:
        own = {name: folder for name, (kind, folder) in places.items() if kind == fmt}
        files = spark.read.format(fmt).schema("none_ int").option("recursiveFileLookup", True).load(list(own.values()))
        within = {name: F.contains(F.col("file_path"), F.lit(f.rpartition("=")[2])) for name, f in own.items()}
        seen = Observation()
        counts = [F.count_if(inside).alias(name) for name, inside in within.items()]
        files.select("_metadata.file_path").observe(seen, *counts).write.format("noop").mode("overwrite").save()
        found |= seen.get
    return found
