"""Monthly trip files."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructType

from tripmart.schema import TRIP_COLUMNS, TRIP_TYPES, quoted

# Fixed value: naming pattern of the published monthly files.
MONTH_FILE = "yellow_tripdata_{year:04d}-{month:02d}.parquet"

# Pattern of a landing folder in Hive layout.
MONTH_FOLDER = "year={year:04d}/month={month:02d}"


def month_path(root: str, year: int | str, month: int | str, pattern: str = MONTH_FILE) -> str:
    """Where the trips of one month lie. `month` may be 1, "1" or "01"."""
    year, month = int(year), int(month)
    if not 1 <= month <= 12:
        raise ValueError(f"month must be 1 to 12, got {month}")
    return f"{root.rstrip('/')}/{pattern.format(year=year, month=month)}"


def canonical_names(df: DataFrame) -> DataFrame:
    """Give the known trip columns one spelling, as it drifts between months.

    Only renames: unknown columns, types and the column order stay.
    """
    spelling = {c.lower(): c for c in TRIP_COLUMNS}
    renames = {c: spelling[c.lower()] for c in df.columns if spelling.get(c.lower(), c) != c}
    return df.withColumnsRenamed(renames) if renames else df


def canonical_types(df: DataFrame) -> DataFrame:
    """Give the known trip columns one type, as it drifts between months.

    Nulls stay; a value that the type cannot hold raises instead of becoming
    null. Zoned times stay zoned, unknown columns stay as they are.
    """
    columns = {}
    for field in df.schema.fields:
        kind, wanted = field.dataType.simpleString(), TRIP_TYPES.get(field.name)
        if wanted is None or kind == wanted or (wanted == "timestamp_ntz" and kind == "timestamp"):
            continue
        value = F.col(quoted(field.name))
        cast = value.try_cast(wanted)
        fits = cast.isNotNull()
        if isinstance(field.dataType, NumericType) and wanted in ("bigint", "double"):
            fits = fits & cast.try_cast(kind).eqNullSafe(value)
        message = F.concat(F.lit(f"{field.name} does not fit {wanted}: "), value.cast("string"))
        columns[field.name] = F.when(value.isNull() | fits, cast).otherwise(F.raise_error(message).cast(wanted))
    return df.withColumns(columns) if columns else df


def read_trips(
    spark: SparkSession,
    root: str,
    year: int | str,
    month: int | str,
    pattern: str = MONTH_FILE,
) -> DataFrame:
    """The raw trips of one month, known columns in their canonical types.

    Only that month's path is listed and scanned. A missing month raises, and so
    does, when it is read, a value that does not fit its column's type.
    """
    path = month_path(root, year, month, pattern)
    try:
        return canonical_types(canonical_names(spark.read.parquet(path)))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no trips for {int(year):04d}-{int(month):02d}: {path}") from error


def months_between(first: tuple[int, int], last: tuple[int, int]) -> list[tuple[int, int]]:
    """All (year, month) from `first` to `last`, both included."""
    start, end = (year * 12 + month - 1 for year, month in (first, last))
    return [(n // 12, n % 12 + 1) for n in range(start, end + 1)]


def read_trip_months(
    spark: SparkSession,
    root: str,
    first: tuple[int, int],
    last: tuple[int, int],
    pattern: str = MONTH_FILE,
) -> DataFrame:
    """The raw trips of all months from `first` to `last`, known columns in their canonical types.

    The same rows as the months read one by one and united; columns that a month
    lacks are null there. Months whose files have the same columns and types are
    one scan, so the plan grows with the number of schemas and not of months.
    Only the months' paths are listed. A month that is missing raises, unless
    `first` lies after `last`, which is an error too.
    """
    paths = [month_path(root, year, month, pattern) for year, month in months_between(first, last)]
    if not paths:
        raise ValueError(f"{first} lies after {last}")
    alike: dict[str, list[str]] = {}
    missing = []
    for path in paths:
        try:
            alike.setdefault(spark.read.parquet(path).schema.json(), []).append(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            missing.append(path)
    if missing:
        raise FileNotFoundError(f"no trips: {', '.join(missing)}")
    whole = None
    for schema, own in alike.items():
        found = spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(*own)
        found = canonical_types(canonical_names(found))
        whole = found if whole is None else whole.unionByName(found, allowMissingColumns=True)
    return whole
