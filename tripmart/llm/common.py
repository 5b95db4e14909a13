"""What the operators share: staged tables, ranks and prefix sums over sorted rows, word tests."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.sinks import delete_at_exit, new_folder, write_and_read

#: One word is a run of these: anything but space, tab, line feed, vertical tab, form feed and return.
WORD = r"[^\x20\x09-\x0D]+"
#: What stands between words.
BLANK = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Narrow rows of one file, at least.
FILE_ROWS = 500_000


def stage(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Write `df` to a new table in the shared folder and go on from its files.

    Readers see the same rows however often a task is repeated. The table is
    deleted when Python ends, as the result may still be read until then.

    Given that there are about `rows` narrow rows, they go to few files. What
    `df` does after its last exchange is then done by as few tasks.
    """
    if rows is not None:
        df = df.coalesce(4 + rows // FILE_ROWS)
    spark = df.sparkSession
    folder = new_folder(spark)
    delete_at_exit(spark, folder)
    return write_and_read(df, folder)


#: Bytes of a batch of rows that goes to a Python worker, where the session sets nothing.
BATCH_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this library to the Python workers, once per application, and bound what they get at once.

    Functions that run there are found by name, and a worker need not have the
    library's folder on its path. The archive lies in the shared folder. Batches
    of texts are bounded by their bytes, unless the session has set a bound.
    """
    context = spark.sparkContext
    if not context.getConf().contains(BATCH_SETTING) and spark.conf.get(BATCH_SETTING) == _default_batch(spark):
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, source.relative_to(root.parent))
    folder = new_folder(spark)
    delete_at_exit(spark, folder)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{root.name}.zip")
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    stream.write(packed.getvalue())
    stream.close()
    context.addPyFile(path.toString())
    _shipped.add(context.applicationId)


def _default_batch(spark: SparkSession) -> str:
    """The batch bound of a session in which nothing has been set."""
    return spark.newSession().conf.get(BATCH_SETTING)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(documents: DataFrame) -> Column:
    """The text, with null read as empty."""
    return F.coalesce(documents["text"].cast("string"), F.lit(""))


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; null for a null id."""
    return F.crc32(doc_id.cast("string")) % folds


def lower_ascii(text: Column) -> Column:
    """A to Z in lower case, all other characters as they are."""
    return F.translate(text, UPPER, LOWER)


def text_bytes(documents: DataFrame) -> int:
    """Bytes of all texts together."""
    total = documents.select(F.sum(F.octet_length(text_of(documents))).alias("n")).first()
    return total["n"] or 0


def running_totals(df: DataFrame, order: Sequence[Column], about: int | None = None, **values: Column) -> DataFrame:
    """`df` sorted by `order`, with the totals of each value over all rows before a row.

    The rows are range-sorted and staged; totals per sorted part, one row each,
    give what lies before a part, and a window inside the part gives the rest.
    No part depends on a key's rows being together, so a hot key is spread over
    as many parts as its share asks for. Integer totals do not depend on where
    the parts begin. `about` is how many rows there are, as for `stage`. Ties in `order` come in any order, and must not matter.
    """
    mid = F.monotonically_increasing_id()
    rows = stage(
        df.withColumns({f"{name}_": value.cast("long") for name, value in values.items()})
        .orderBy(*order)
        .withColumns({"part_": F.shiftright(mid, 33), "row_": mid}),
        about,
    )
    parts = rows.groupBy("part_").agg(*[F.sum(f"{name}_").alias(f"{name}_all_") for name in values])
    before = Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    starts = parts.select(
        "part_", *[F.coalesce(F.sum(f"{name}_all_").over(before), F.lit(0)).alias(f"{name}_start_") for name in values]
    )
    inside = Window.partitionBy("part_").orderBy("row_").rowsBetween(Window.unboundedPreceding, -1)
    inner = {f"{name}_inner_": F.coalesce(F.sum(f"{name}_").over(inside), F.lit(0)) for name in values}
    total = {name: F.col(f"{name}_start_") + F.col(f"{name}_inner_") for name in values}
    return rows.withColumns(inner).join(starts, "part_").select(*df.columns, *[c.alias(n) for n, c in total.items()])
