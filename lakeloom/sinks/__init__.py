"""Sinks: versioned overwrite (M4, M6), upsert write-back (M1, M2, M3) and the
load history with merge metrics (M5, T3)."""

from lakeloom.sinks.history import (
    append_history,
    history_view,
    last_load,
    latest_entries,
    read_history,
    table_history,
)
from lakeloom.sinks.tables import LoadResult, overwrite_table, prune_versions, upsert_table, write_version
from lakeloom.sinks.versions import read_version, restore, versions
from lakeloom.sinks.views import rows_table

__all__ = [
    "LoadResult", "append_history", "history_view", "last_load", "latest_entries", "overwrite_table",
    "prune_versions", "read_history", "read_version", "restore", "rows_table", "table_history", "upsert_table", "versions",
    "write_version",
]
