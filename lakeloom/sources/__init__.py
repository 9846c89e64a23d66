"""Sources: landing-folder listing and reads (L1-L7), catalog tables."""

from lakeloom.sources.landing import (
    enforce_schema,
    latest_folders,
    list_landing_files,
    newest_folders,
    read_full_snapshot,
    read_incremental,
    read_landing_folders,
    walk_newest_folders,
)
from lakeloom.sources.tables import read_table, table_exists

__all__ = [
    "enforce_schema", "latest_folders", "list_landing_files", "newest_folders", "read_full_snapshot",
    "read_incremental", "read_landing_folders", "walk_newest_folders", "read_table", "table_exists",
]
