"""Registered queries over the generated tables and their DuckDB oracles."""

from lakeloom.workloads.oracle import ORACLE_SQL
from lakeloom.workloads.queries import QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
