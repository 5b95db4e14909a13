"""Staged tables of one operator that are deleted as soon as nothing reads them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmart.sinks import delete_at_exit, new_folder, write_and_read
from tripmart.sinks.files import delete_path


#: Spark's setting by which a finished query gives its shuffle files free at once, and not when they are collected.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Stages:
    """Writes tables to the shared folder. What is dropped is deleted now, everything else when Python ends.

    The exchanges that lead to a table are not read again once it is written, so
    their files go with the write. While it runs they stay, for executors that are lost.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.folders: dict[int, tuple[DataFrame, str]] = {}

    def stage(self, df: DataFrame) -> DataFrame:
        """Write `df` and go on from its files."""
        folder = new_folder(self.spark)
        delete_at_exit(self.spark, folder)
        before = self.spark.conf.get(CLEANUP, None)
        if before is not None:  # a version of Spark that has it
            self.spark.conf.set(CLEANUP, "true")
        try:
            read = write_and_read(df, folder)
        finally:
            if before is not None:
                self.spark.conf.set(CLEANUP, before)
        self.folders[id(read)] = (read, folder)
        return read

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that no frame still to be computed reads."""
        for table in tables:
            if held := self.folders.pop(id(table), None):
                delete_path(self.spark, held[1])
