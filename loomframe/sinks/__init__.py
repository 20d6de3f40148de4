from loomframe.sinks.files import (
    replace_partitions,
    scratch_dir,
    write_csv,
    write_lines,
    write_parquet,
    write_partitioned,
    write_files,
)
from loomframe.sinks.tables import (
    count_rows,
    create_table,
    describe,
    drop_database,
    drop_table,
    ensure_database,
    list_tables,
    preview,
    register_external,
    replace_table,
    write_bucketed,
)

__all__ = [
    "count_rows",
    "create_table",
    "describe",
    "drop_database",
    "drop_table",
    "ensure_database",
    "list_tables",
    "preview",
    "register_external",
    "replace_partitions",
    "replace_table",
    "scratch_dir",
    "write_bucketed",
    "write_csv",
    "write_lines",
    "write_parquet",
    "write_partitioned",
    "write_files",
]
