"""Footer-schema check of landing files.

``ignoreCorruptFiles`` lets a load survive a truncated or non-Parquet file,
but it also swallows *type drift*: a file whose column changed from ``long``
to ``string`` cannot be decoded with the table schema, so the reader skips it
and the rows vanish without a message. This check reads only the footer of
each listed file (a few KB, never the data pages) and compares its column
types with the expected schema.

It runs inside the tasks: the file listing is a DataFrame, and
``mapInPandas`` hands each task a batch of paths whose footers it opens with
pyarrow. Only the files that fail come back to the driver.

A column type is accepted when Spark reads it without changing its meaning:
the same type, a wider integer, an integer or float read as double when no
digits are lost, a decimal (or integer) that fits the target precision and
scale, a date read as ``timestamp_ntz``, any microsecond / millisecond (or
INT96) timestamp read as a timestamp, and string / binary read as either.
Anything else is drift, including reads Spark performs but which change the
value (an int32 read as byte, a date read as its day number). A column the
file lacks is not drift: it reads as NULL.

Statuses: ``ok``; ``wider`` (drift that a wider column type would hold without
loss, see :func:`widened_schema`); ``drift``; ``unreadable`` (the bytes are not a valid
Parquet file, which ``ignoreCorruptFiles`` would skip too); ``unchecked``
(the file cannot be reached from Python: no pyarrow file system for the
scheme, no HDFS library, credentials, network). When there is an unchecked file
the whole read runs without ``ignoreCorruptFiles``: Spark's reader then raises
instead of skipping a file that nobody looked at.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from urllib.parse import quote, unquote

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lakeloom.functions.widening import wider_type

OK, DRIFT, UNREADABLE, UNCHECKED, WIDER = "ok", "drift", "unreadable", "unchecked", "wider"
CHECK_SCHEMA = "path string, status string, detail string"

# Decimal digits an integer of each Arrow type can hold.
_INT_DIGITS = {"int8": 3, "int16": 5, "int32": 10, "int64": 19,
               "uint8": 3, "uint16": 5, "uint32": 10, "uint64": 20}
# Spark integer types and the Arrow integer types they hold without loss.
_INT_TARGETS = {
    T.ByteType: {"int8"},
    T.ShortType: {"int8", "int16", "uint8"},
    T.IntegerType: {"int8", "int16", "int32", "uint8", "uint16"},
    T.LongType: {"int8", "int16", "int32", "int64", "uint8", "uint16", "uint32"},
}


def compatible(arrow_type, physical: str, target: T.DataType) -> bool:
    """Whether a file column of ``arrow_type`` reads losslessly as ``target``."""
    import pyarrow as pa
    import pyarrow.types as pt

    name = str(arrow_type)
    if pa.types.is_dictionary(arrow_type):
        return compatible(arrow_type.value_type, physical, target)
    for spark_type, ok in _INT_TARGETS.items():
        if isinstance(target, spark_type):
            return name in ok
    if isinstance(target, T.DoubleType):
        return pt.is_floating(arrow_type) or name in ("int8", "int16", "int32", "uint8",
                                                      "uint16", "uint32")
    if isinstance(target, T.FloatType):
        return pt.is_float32(arrow_type)
    if isinstance(target, T.DecimalType):
        whole = target.precision - target.scale
        if pt.is_integer(arrow_type):
            return _INT_DIGITS.get(name, 99) <= whole
        if pt.is_decimal(arrow_type):
            return (arrow_type.scale <= target.scale
                    and arrow_type.precision - arrow_type.scale <= whole)
        return False
    if isinstance(target, (T.StringType, T.BinaryType)):
        return (pt.is_string(arrow_type) or pt.is_large_string(arrow_type)
                or pt.is_binary(arrow_type) or pt.is_large_binary(arrow_type))
    if isinstance(target, T.BooleanType):
        return pt.is_boolean(arrow_type)
    if isinstance(target, T.DateType):
        return pt.is_date32(arrow_type)
    if isinstance(target, (T.TimestampType, T.TimestampNTZType)):
        if pt.is_timestamp(arrow_type):
            return arrow_type.unit in ("ms", "us") or physical == "INT96"
        return isinstance(target, T.TimestampNTZType) and pt.is_date32(arrow_type)
    # nested or other types: require the same Spark type name
    return name == target.simpleString()


def file_type(arrow_type) -> T.DataType | None:
    """The Spark type of a numeric or date file column, None for others."""
    import pyarrow.types as pt
    if pt.is_dictionary(arrow_type):
        return file_type(arrow_type.value_type)
    if pt.is_decimal(arrow_type):
        return T.DecimalType(arrow_type.precision, arrow_type.scale) if arrow_type.precision <= 38 else None
    if pt.is_date32(arrow_type):
        return T.DateType()
    return {"int8": T.ByteType(), "int16": T.ShortType(), "int32": T.IntegerType(), "int64": T.LongType(),
            "uint8": T.ShortType(), "uint16": T.IntegerType(), "uint32": T.LongType(),
            "uint64": T.DecimalType(20, 0), "float": T.FloatType(), "double": T.DoubleType()}.get(str(arrow_type))


_URI_SAFE = ":/@!$&'()*+,;=-._~"


def uri_form(path: str) -> str:
    """``path`` with the characters a URI escapes percent-encoded (spaces,
    ``%`` ...), as ``_metadata.file_path`` shows a file listed as ``path``."""
    return quote(path, safe=_URI_SAFE)


def _filesystem(path: str, cache: dict | None):
    """``(FileSystem, path inside it)``. Within a task one file system per
    scheme and authority is built (for object stores that is a client with
    its own connection setup) and reused for the other files under it."""
    import pyarrow.fs as pafs
    m = re.match(r"^([a-zA-Z][a-zA-Z0-9+.-]*:(?://[^/]*)?)(.*)$", path)
    if not m:                                   # a plain local path
        return pafs.LocalFileSystem(), path
    root, rest = m.group(1), unquote(uri_form(m.group(2)))
    if cache is not None and root in cache:
        fs, head = cache[root]
        return fs, head + rest
    fs, inner = pafs.FileSystem.from_uri(uri_form(path))   # pyarrow wants an encoded URI
    if cache is not None and inner.endswith(rest):
        cache[root] = (fs, inner[:len(inner) - len(rest)])
    return fs, inner


def check_file(path: str, schema: T.StructType, cache: dict | None = None,
               widen: bool = False) -> tuple[str, str, str]:
    """``(path, status, detail)`` for one file. With ``widen``, drift that wider
    columns would hold is ``wider``, its detail the columns' types as JSON.

    ``unreadable`` only when the bytes are not a valid Parquet file (no
    magic bytes, truncated footer): what ``ignoreCorruptFiles`` would skip.
    When the file cannot be reached from Python at all (no pyarrow file
    system for the scheme, no HDFS client library, credentials, network, a
    file gone since the listing) the status is ``unchecked`` and the file is
    read as usual, so Spark's own reader decides; a check that cannot look
    must never drop data.
    """
    import pyarrow as pa
    import pyarrow.parquet as pq
    try:
        fs, inner = _filesystem(path, cache)
    except Exception as e:
        return path, UNCHECKED, f"{type(e).__name__}: {str(e)[:200]}"
    try:
        md = pq.read_metadata(inner, filesystem=fs)
    except pa.ArrowInvalid as e:
        return path, UNREADABLE, str(e)[:200]
    except Exception as e:
        return path, UNCHECKED, f"{type(e).__name__}: {str(e)[:200]}"
    arrow = md.schema.to_arrow_schema()
    physical = {md.schema.column(i).name: md.schema.column(i).physical_type
                for i in range(md.num_columns)}
    problems, wide = [], {}
    for f in schema.fields:
        idx = arrow.get_field_index(f.name)
        if idx < 0:
            continue
        at = arrow.field(idx).type
        if not compatible(at, physical.get(f.name, ""), f.dataType):
            own = file_type(at) if widen else None
            common = wider_type(own, f.dataType) if own is not None else None
            if common is not None and compatible(at, physical.get(f.name, ""), common):
                wide[f.name] = common.jsonValue()
            else:
                problems.append(f"{f.name}: file {at} vs {f.dataType.simpleString()}")
    if wide and not problems:
        return path, WIDER, json.dumps(wide, sort_keys=True)
    return (path, DRIFT, "; ".join(problems)) if problems else (path, OK, "")


def check_footers(files: DataFrame, schema: T.StructType, path_col: str = "path", widen: bool = False) -> DataFrame:
    """One ``(path, status, detail)`` row per file of ``files``; the footers
    are opened by the tasks that hold the paths."""
    from lakeloom.session import ship_package
    ship_package(files.sparkSession)
    schema_json = schema.json()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        expected = T.StructType.fromJson(json.loads(schema_json))
        cache: dict = {}
        for pdf in batches:
            rows = [check_file(p, expected, cache, widen) for p in pdf[path_col]]
            yield pd.DataFrame(rows, columns=["path", "status", "detail"])

    return files.select(path_col).mapInPandas(run, CHECK_SCHEMA)


def widened_schema(schema: T.StructType, found: Iterable[str]) -> T.StructType:
    """``schema`` with the column types that hold it and all of ``found`` (the
    details of ``wider`` files); raises where a column has no such type."""
    types = {f.name: f.dataType for f in schema.fields}
    for detail in found:
        for name, value in json.loads(detail).items():
            other = T._parse_datatype_json_value(value)
            common = wider_type(types[name], other)
            if common is None:
                raise ValueError(f"landing files hold {name} as {types[name].simpleString()} and as "
                                 f"{other.simpleString()}, which no type holds without loss")
            types[name] = common
    return T.StructType([T.StructField(f.name, types[f.name], f.nullable, f.metadata) for f in schema.fields])


def failing_files(files: DataFrame, schema: T.StructType,
                  widen: bool = False) -> tuple[list[tuple[str, str, str]], int]:
    """The files that drifted or cannot be read (only these reach the
    driver), and the number of files that could not be looked at. With
    ``widen`` also one row, without a path, for each kind of ``wider`` file."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F
    seen = Observation()
    checked = check_footers(files, schema, widen=widen)
    if widen:
        failing = F.col("status").isin(DRIFT, UNREADABLE)
        kinds = (checked.filter(failing | F.col("status").isin(WIDER, UNCHECKED))
                 .groupBy("status", F.when(failing, F.col("path")).alias("path"),
                          F.when(F.col("status") != UNCHECKED, F.col("detail")).alias("detail"))
                 .agg(F.count(F.lit(1)).alias("n")).collect())
        return ([(r["path"], r["status"], r["detail"]) for r in kinds if r["status"] != UNCHECKED],
                sum(r["n"] for r in kinds if r["status"] == UNCHECKED))
    checked = checked.observe(seen, F.count(F.when(F.col("status") == UNCHECKED, 1)).alias("unchecked"))
    bad = checked.filter(F.col("status").isin(DRIFT, UNREADABLE)).collect()
    return [(r["path"], r["status"], r["detail"]) for r in bad], int(seen.get["unchecked"] or 0)
