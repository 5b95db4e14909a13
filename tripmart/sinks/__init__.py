from tripmart.sinks.files import delete_at_exit, delete_path, path_exists
from tripmart.sinks.staging import new_folder, rows_in_files, shared_folder, staging_folder, write_and_read
from tripmart.sinks.tables import (
    Prepared,
    append_missing,
    by_buckets,
    check_catalog,
    check_columns,
    check_layout,
    create_schema,
    discard,
    partition_filter,
    prepare_bucketed,
    prepare_partition,
    prepare_partitions,
    prepare_table,
    put_in_place,
    read_all,
    read_saved,
    register_all,
    register_table,
    replace_partition,
    save_table,
    save_tables,
    table_path,
    use_schema,
)

__all__ = [
    "Prepared",
    "append_missing",
    "by_buckets",
    "check_catalog",
    "check_columns",
    "check_layout",
    "create_schema",
    "delete_at_exit",
    "delete_path",
    "discard",
    "new_folder",
    "partition_filter",
    "path_exists",
    "prepare_bucketed",
    "prepare_partition",
    "prepare_partitions",
    "prepare_table",
    "put_in_place",
    "read_all",
    "read_saved",
    "register_all",
    "register_table",
    "replace_partition",
    "rows_in_files",
    "save_table",
    "save_tables",
    "shared_folder",
    "staging_folder",
    "table_path",
    "use_schema",
    "write_and_read",
]
