"""Keeps analytic tables in step with a document store's change feed, on Spark."""

from tidemark.operators.drift import field_paths, field_rejects, undeclared_fields
from tidemark.operators.evolve import align_to_schema, dropped_fields, merge_types
from tidemark.operators.flatten import flatten, flatten_levels
from tidemark.operators.idhash import hash_mapping_merge, id_hash_mapping
from tidemark.operators.latest import keep_latest, max_seq_per_key
from tidemark.operators.merge import MergeCounts, merge, merge_colocated, merge_parts, replace_children
from tidemark.operators.parse import parse_docs, quarantine, unwrap_dates
from tidemark.plans.loads import RunError, apply_changes, changes_to_rows, initial_load, merge_into, run, snapshot_to_rows
from tidemark.plans.spec import CollectionSpec
from tidemark.session import tune
from tidemark.sources.envelope import read_changes, read_full_load
from tidemark.sources.ledger import read_unprocessed, record_files, unprocessed_files
from tidemark.sources.onread import OnReadTable
from tidemark.sources.tables import (
    BucketTable,
    drop_database,
    drop_table,
    newest_row,
    register_parquet,
    save_table,
    table_exists,
)
from tidemark.streaming.changes import stream_changes

__all__ = [
    "BucketTable",
    "CollectionSpec",
    "MergeCounts",
    "OnReadTable",
    "RunError",
    "align_to_schema",
    "apply_changes",
    "changes_to_rows",
    "drop_database",
    "drop_table",
    "dropped_fields",
    "field_paths",
    "field_rejects",
    "flatten",
    "flatten_levels",
    "hash_mapping_merge",
    "id_hash_mapping",
    "initial_load",
    "keep_latest",
    "max_seq_per_key",
    "merge",
    "merge_colocated",
    "merge_into",
    "merge_parts",
    "merge_types",
    "newest_row",
    "parse_docs",
    "quarantine",
    "read_changes",
    "read_full_load",
    "read_unprocessed",
    "record_files",
    "register_parquet",
    "replace_children",
    "run",
    "save_table",
    "snapshot_to_rows",
    "stream_changes",
    "table_exists",
    "tune",
    "undeclared_fields",
    "unprocessed_files",
    "unwrap_dates",
]
