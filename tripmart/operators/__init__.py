from tripmart.operators.digests import (
    dedup_by_digest,
    duplicates_by_digest,
    row_digest,
    row_groups_by_digest,
    summary_by_digest,
)
from tripmart.operators.enrich import enrich_trips
from tripmart.operators.footers import negative_counts_from_footers, null_counts_from_footers
from tripmart.operators.model import clean_trips, dim_time, enriched_trips, fact_trips
from tripmart.operators.quality import (
    abs_amounts,
    dedup_rows,
    drop_null_rows,
    duplicate_rows,
    duplicate_summary,
    negative_counts,
    null_counts,
    quality_report,
    repeat_rows,
    row_groups,
)
from tripmart.operators.tables import table_counts, table_sample, verify_tables

__all__ = [
    "dedup_by_digest",
    "duplicates_by_digest",
    "row_digest",
    "row_groups_by_digest",
    "summary_by_digest",
    "abs_amounts",
    "clean_trips",
    "dedup_rows",
    "dim_time",
    "drop_null_rows",
    "duplicate_rows",
    "duplicate_summary",
    "enrich_trips",
    "enriched_trips",
    "fact_trips",
    "negative_counts",
    "negative_counts_from_footers",
    "null_counts",
    "null_counts_from_footers",
    "quality_report",
    "repeat_rows",
    "row_groups",
    "table_counts",
    "table_sample",
    "verify_tables",
]
