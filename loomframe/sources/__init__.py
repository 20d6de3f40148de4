from loomframe.sources.files import (
    drop_header,
    parse_delimited,
    read_csv,
    read_dir,
    read_lines,
    read_with_rejects,
    sequence,
    split_malformed,
    with_source_file,
)

__all__ = [
    "drop_header",
    "parse_delimited",
    "read_csv",
    "read_dir",
    "read_lines",
    "read_with_rejects",
    "sequence",
    "split_malformed",
    "with_source_file",
]
