"""Reading vendor files and lake tables, and writing them."""

from quotelake.sources.buckets import BucketedTable
from quotelake.sources.files import (
    csv_headers,
    dated_files,
    file_date,
    read_csv_by_header,
    read_csv_strings,
    read_envelope_rows,
    read_header_rows,
    read_json_envelope,
    read_json_strings,
    with_dense_row_id,
    with_row_id,
)
from quotelake.sources.lake import (
    append_table,
    drop_partitions,
    latest_partition,
    list_partitions,
    pending_partitions,
    pending_values,
    processed_values,
    read_latest,
    read_partitioned,
    record_processed,
    replace_partitions,
    write_partitions,
    write_table,
)
from quotelake.sources.schemas import read_rename_map, string_schema

__all__ = [
    "BucketedTable",
    "append_table",
    "csv_headers",
    "dated_files",
    "drop_partitions",
    "file_date",
    "latest_partition",
    "list_partitions",
    "pending_partitions",
    "pending_values",
    "processed_values",
    "read_csv_by_header",
    "read_csv_strings",
    "read_envelope_rows",
    "read_header_rows",
    "read_json_envelope",
    "read_json_strings",
    "read_latest",
    "read_partitioned",
    "read_rename_map",
    "record_processed",
    "replace_partitions",
    "string_schema",
    "with_dense_row_id",
    "with_row_id",
    "write_partitions",
    "write_table",
]
