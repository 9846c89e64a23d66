"""Stable views over version tables, and rows in ranges of their key's hash.

With ``stable_view`` the name that readers use is a view; the rows are in a
version table beside it (``<name>__rows_<version>``). A write defines the next
version table, marks of the load included, and then points the view at it with
one ``ALTER VIEW ... AS``. Readers find the old rows or the new ones, never no
table, and the marks switch with the rows. The version table shown before stays
defined until the next switch, so a query that has just looked the view up still
finds it; a write that dies before the switch leaves a definition that the next
one drops.

With ``hash_ranges`` the version table is partitioned by a column that the view
does not show: the key's hash modulo the number of ranges. A key never leaves
its range, so an upsert into a table without partition columns reads and
rewrites the ranges of its keys only, and looks for them nowhere else. Rows with
a NULL key match nothing and are spread by a hash of the whole row.
"""

from __future__ import annotations

import json
from collections.abc import Collection, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.sinks.catalog import _ROWS, _details, _exists, _properties, _quote, _set_properties, _siblings

#: The column of the hash range.
RANGE = "_range"
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def rows_table(spark: SparkSession, name: str) -> str | None:
    """The version table that the stable view ``name`` shows; None if ``name``
    is no such view."""
    if not _exists(spark, name):
        return None
    d = _details(spark, name)
    if d.get("Type", "").upper() != "VIEW" or "lakeloom.view=" not in d.get("Table Properties", ""):
        return None
    return name + _ROWS + d["View Text"].rstrip("`").rpartition(_ROWS)[2]


def layout_note(ranges: int, keys: Sequence[str]) -> str:
    return json.dumps([ranges, *keys])


def layout(spark: SparkSession, rows: str | None) -> tuple[int, tuple[str, ...]] | None:
    """Number of ranges and key of a version table in hash ranges."""
    text = _properties(spark, rows).get("lakeloom.ranges") if rows else None
    if text is None:
        return None
    n, *keys = json.loads(text)
    return n, tuple(keys)


def with_range(df: DataFrame, keys: Sequence[str], ranges: int, schema: T.StructType | None = None) -> DataFrame:
    """``df`` with its hash range; keys count as the types of ``schema``, whole
    numbers of every width alike."""
    if RANGE in df.columns:
        raise ValueError(f"a table in hash ranges cannot have a column {RANGE}")
    types = {k: (schema or df.schema)[k].dataType for k in keys}
    key = F.xxhash64(*[F.col(k).cast("long" if isinstance(t, _WHOLE) else t) for k, t in types.items()])
    hashable = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return df.withColumn(RANGE, F.pmod(F.when(null, F.xxhash64(*hashable)).otherwise(key), F.lit(ranges)).cast("int"))


def switch_view(spark: SparkSession, name: str, rows: str, shown: str | None,
                notes: Mapping[str, str] | None = None, without: Collection[str] = ()) -> None:
    """Let the view ``name`` show ``rows`` instead of ``shown`` (none: make the
    view). The new version table takes the old one's properties of this
    package but for those in ``without``, and ``notes``."""
    kept = {k: v for k, v in (_properties(spark, shown) if shown else {}).items() if k not in without}
    kept |= {f"lakeloom.{k}": v for k, v in (notes or {}).items()}
    kept["lakeloom.shown"] = "view"
    _set_properties(spark, rows, kept)
    hidden = {RANGE} if "lakeloom.ranges" in kept else set()
    columns = ", ".join(f"`{c}`" for c in spark.table(rows).columns if c not in hidden)
    text = f"SELECT {columns} FROM {_quote(rows)}"
    if shown:
        spark.sql(f"ALTER VIEW {_quote(name)} AS {text}")
    else:
        spark.sql(f"CREATE VIEW {_quote(name)} TBLPROPERTIES ('lakeloom.view' = '1') AS {text}")
    for left in _siblings(spark, name, _ROWS):
        if left.lower() not in {rows.lower(), (shown or "").lower()}:
            spark.sql(f"DROP TABLE IF EXISTS {_quote(left)}")
