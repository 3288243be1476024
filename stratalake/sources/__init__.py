"""Sources and sinks: schemas, dated snapshots, paged sources, tables."""

from .paged import HttpPages, PagedReadError, paged_errors, parse_records, raw_pages, read_paged, stream_pages
from .schema import load_schema, parse_type, schema_from_fields, with_field
from .sinks import prepare_partitions, read_table, write_json, write_partitioned, write_table
from .snapshots import (
    LABEL_COL,
    clean_snapshots,
    current_label,
    label_of,
    label_time,
    latest_snapshot,
    latest_snapshot_path,
    newest_label_value,
    read_latest_snapshot,
    read_snapshots,
    snapshot_files,
    snapshot_labels,
    split_damaged,
    write_run,
    write_snapshot,
    write_snapshots,
)
from .storage import scratch_path, shared_dir

__all__ = [
    "HttpPages",
    "LABEL_COL",
    "clean_snapshots",
    "snapshot_files",
    "split_damaged",
    "write_run",
    "PagedReadError",
    "paged_errors",
    "current_label",
    "label_of",
    "label_time",
    "latest_snapshot",
    "latest_snapshot_path",
    "load_schema",
    "parse_records",
    "parse_type",
    "prepare_partitions",
    "raw_pages",
    "stream_pages",
    "read_latest_snapshot",
    "newest_label_value",
    "snapshot_labels",
    "read_paged",
    "read_snapshots",
    "read_table",
    "schema_from_fields",
    "scratch_path",
    "shared_dir",
    "with_field",
    "write_json",
    "write_partitioned",
    "write_snapshot",
    "write_snapshots",
    "write_table",
]
