"""Scans, sinks, schemas and manifests."""

from . import versioned
from .clustered import file_ranges, write_clustered
from .files import (
    BadRecordBudgetExceeded,
    Landing,
    UnknownFields,
    read_csv,
    read_ndjson,
    scan_csv,
    scan_ndjson,
    with_file_path,
    with_partition_date,
)
from .manifest import load_manifest, manifest_from_ddl, read_manifest, scan_manifest
from .schema import drop_fields, schema_from_json, schema_to_json, tag_of
from .tables import (
    copy_table,
    export_csv,
    insert_absent,
    list_tables,
    read_config_json,
    read_exclusions,
    read_seed_columns,
    register_views,
    update_where,
    view_id,
    write_table,
)

__all__ = [
    "BadRecordBudgetExceeded",
    "Landing",
    "UnknownFields",
    "scan_csv",
    "scan_manifest",
    "scan_ndjson",
    "versioned",
    "copy_table",
    "drop_fields",
    "export_csv",
    "file_ranges",
    "insert_absent",
    "list_tables",
    "load_manifest",
    "manifest_from_ddl",
    "read_config_json",
    "read_csv",
    "read_exclusions",
    "read_manifest",
    "read_ndjson",
    "read_seed_columns",
    "register_views",
    "schema_from_json",
    "schema_to_json",
    "tag_of",
    "update_where",
    "view_id",
    "with_file_path",
    "with_partition_date",
    "write_clustered",
    "write_table",
]
