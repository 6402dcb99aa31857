"""Readers."""

from tallyline.sources.readers import (
    as_changes,
    read_changes,
    read_pages,
    read_snapshot_files,
    read_state_jdbc,
    read_statements_csv,
)

__all__ = [
    "as_changes",
    "read_changes",
    "read_pages",
    "read_snapshot_files",
    "read_state_jdbc",
    "read_statements_csv",
]
