"""Writers."""

from tallyline.sinks.bucketed import BucketedState
from tallyline.sinks.files import (
    assert_unique,
    create_table,
    duplicate_keys,
    load_table,
    merge_table,
    write_csv,
    write_single_csv,
)
from tallyline.sinks.jdbc import append_jdbc, overwrite_jdbc, upsert_jdbc, upsert_statement
from tallyline.sinks.snapshot import Snapshot
from tallyline.sinks.workspace import scratch_dir

__all__ = [
    "BucketedState",
    "Snapshot",
    "append_jdbc",
    "assert_unique",
    "create_table",
    "duplicate_keys",
    "load_table",
    "merge_table",
    "overwrite_jdbc",
    "scratch_dir",
    "upsert_jdbc",
    "upsert_statement",
    "write_csv",
    "write_single_csv",
]
