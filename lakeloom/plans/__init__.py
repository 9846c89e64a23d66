"""Load flows (R1a-d) and the multi-table run with its report."""

from lakeloom.plans.loads import (
    load_clean_full,
    load_clean_incremental,
    load_raw_full,
    load_raw_incremental,
    load_table,
    prepare,
)
from lakeloom.plans.runner import dependency_levels, outcome_counts, run_loads, run_state

__all__ = [
    "dependency_levels", "load_clean_full", "load_clean_incremental", "load_raw_full",
    "load_raw_incremental", "load_table", "outcome_counts", "prepare", "run_loads", "run_state",
]
