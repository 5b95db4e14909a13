"""Load one month of trips, then show its quality, its tables and all reports, every row of them.

With --reports-only nothing is loaded: the reports come from what the schema has.

spark-submit --py-files tripmart.zip load_month.py --source hdfs:///landing \\
    --zones hdfs:///landing/zones.csv --year 2021 --month 8 \\
    --target hdfs:///mart --schema trips
"""

from __future__ import annotations

import argparse
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession

from tripmart import all_reports, open_star, run
from tripmart.operators import verify_tables
from tripmart.sources import MONTH_FILE


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Load one month of trips.")
    parser.add_argument("--source", help="folder of the monthly files")
    parser.add_argument("--zones", help="zone lookup, CSV with header")
    parser.add_argument("--year")
    parser.add_argument("--month", help="1 or 01")
    parser.add_argument("--target", help="folder of the saved tables")
    parser.add_argument("--schema", required=True, help="catalog schema of the saved tables")
    parser.add_argument("--format", default="parquet")
    parser.add_argument("--pattern", default=MONTH_FILE, help="path of a month in the source")
    parser.add_argument("--by-month", action="store_true", help="keep the other months")
    parser.add_argument("--reports-only", action="store_true", help="report on the saved schema")
    args = parser.parse_args()
    needed = ("source", "zones", "year", "month", "target")
    if not args.reports_only and (missing := [f"--{n}" for n in needed if getattr(args, n) is None]):
        parser.error(f"a load needs {', '.join(missing)}")
    return args


def show(report: DataFrame) -> None:
    """Print every row; reports have one for each code, hour or borough, or as many as they are limited to."""
    rows = report.collect()
    widths = [max(len(str(v)) for v in column) for column in zip(report.columns, *rows, strict=True)]
    for row in (report.columns, *rows):
        print("  ".join(str(v).ljust(width) for v, width in zip(row, widths, strict=True)).rstrip())


def main() -> None:
    args = arguments()
    spark = SparkSession.builder.appName("tripmart-load").getOrCreate()
    if not args.reports_only:
        result = run(
            spark,
            args.source,
            args.zones,
            args.year,
            args.month,
            args.target,
            args.schema,
            args.format,
            args.by_month,
            args.pattern,
        )
        for name, value in asdict(result.quality).items():
            print(f"{name}: {value}")
    for name, report in all_reports(open_star(spark, args.schema)).items():
        print(f"\n{name}")
        show(report)
    for name, check in verify_tables(spark, args.schema).items():
        print(f"{name}: {check.error or f'{check.row_count:,} rows'}")


if __name__ == "__main__":
    main()
