"""Catalog calls that the sinks share."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import SparkSession

#: Table property of every table the sinks create.
OWNED = "lakeloom.sink"
#: Marks in the names of definitions: set aside, not yet switched in, behind a stable view.
_ASIDE = "__old_"
_STAGE = "__stage_"
_ROWS = "__rows_"


def _quote(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def _split(name: str) -> tuple[str | None, str]:
    parts = name.split(".")
    return (".".join(parts[:-1]) or None, parts[-1])


def _exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(_quote(name))


def _details(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_quote(name)}").collect()
    return {r[0]: r[1] for r in rows if r[0] in ("Provider", "Type", "Table Properties", "Location", "View Text")}


def _siblings(spark: SparkSession, name: str, mark: str) -> list[str]:
    """Definitions beside ``name`` that carry ``mark``, oldest first."""
    db, tbl = _split(name)
    where = f" IN {_quote(db)}" if db else ""
    if db and not spark.catalog.databaseExists(db):
        return []
    rows = spark.sql(f"SHOW TABLES{where} LIKE '{tbl}{mark}*'").collect()
    own = re.compile(re.escape(tbl + mark) + r"\d+_[0-9a-f]{8}", re.I)
    return sorted(f"{db + '.' if db else ''}{r['tableName']}" for r in rows if own.fullmatch(r["tableName"]))


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    """Properties of this package."""
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {_quote(name)}").collect()
            if r["key"].startswith("lakeloom.")}


def _set_properties(spark: SparkSession, name: str, properties: Mapping[str, str]) -> None:
    if properties:
        text = ", ".join("'{}' = '{}'".format(k, v.replace("\\", "\\\\").replace("'", "\\'"))
                         for k, v in properties.items())
        spark.sql(f"ALTER TABLE {_quote(name)} SET TBLPROPERTIES ({text})")
