"""Paths on whatever file system they name: HDFS, an object store, local disk."""

from __future__ import annotations

import atexit
from collections.abc import Callable
from contextlib import suppress

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at `path`."""
    hadoop_path, file_system = _resolve(spark, path)
    return file_system.exists(hadoop_path)


def holds_files(spark: SparkSession, path: str, pattern: str) -> bool:
    """Whether the folder at `path` directly holds files named like `pattern`."""
    hadoop_path, file_system = _resolve(spark, f"{path}/{pattern}")
    return bool(file_system.globStatus(hadoop_path))


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete the file or folder at `path`, if there is one."""
    _deletion(spark, path)()


def folders_at(spark: SparkSession, path: str, depth: int, hidden: bool = False) -> list[str]:
    """Names of the folders `depth` levels below `path`, relative to it, without hidden ones unless asked for."""
    hadoop_path, file_system = _resolve(spark, path)
    found = [("", hadoop_path)]
    for _ in range(depth):
        below = []
        for name, folder in found:
            for status in file_system.listStatus(folder) if file_system.exists(folder) else ():
                own = status.getPath().getName()
                if status.isDirectory() and (hidden or own[0] not in "._"):
                    below.append((f"{name}/{own}".lstrip("/"), status.getPath()))
        found = below
    return [name for name, _ in found]


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in a folder; none if there is no such folder."""
    hadoop_path, file_system = _resolve(spark, folder)
    statuses = file_system.listStatus(hadoop_path) if file_system.exists(hadoop_path) else ()
    return [s.getPath().getName() for s in statuses if s.isFile()]


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    hadoop_path, file_system = _resolve(spark, path)
    stream = file_system.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, with the folders above it."""
    hadoop_path, file_system = _resolve(spark, path)
    stream = file_system.create(hadoop_path, False)
    stream.write(text.encode())
    stream.close()


def move_new(spark: SparkSession, path: str, target: str) -> None:
    """Rename a file to a name that must be free; one step on file systems that can rename."""
    jvm = spark._jvm
    source, _ = _resolve(spark, path)
    goal, file_system = _resolve(spark, target)
    uri = file_system.makeQualified(goal).toUri()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(uri, spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    context.rename(file_system.makeQualified(source), file_system.makeQualified(goal), options)


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Delete `path` when Python ends, even if the session has been stopped by then."""
    delete = _deletion(spark, path)

    def at_exit() -> None:
        with suppress(Py4JError, OSError):
            delete()

    atexit.register(at_exit)


def _resolve(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def _deletion(spark: SparkSession, path: str) -> Callable[[], None]:
    hadoop_path, file_system = _resolve(spark, path)
    return lambda: file_system.delete(hadoop_path, True)
