"""Catalog table scans (L8 raw table, L9 clean lookup) with projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def read_table(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """``spark.table(name)`` keeping ``columns`` in the given order. The
    projection reaches the Parquet scan as its read schema."""
    df = spark.table(name)
    if columns:
        missing = [c for c in columns if c not in df.columns]
        if missing:
            raise ValueError(f"{name}: columns not found: {missing}")
        df = df.select(*columns)
    return df
