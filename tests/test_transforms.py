import datetime as dt

import pytest
from pyspark.sql import types as T

from lakeloom.functions import alias_columns, apply_transforms, cast_columns, derive_ymd
from lakeloom.spec import TableSpec


def spec(**kw):
    kw.setdefault("target", "t")
    kw.setdefault("source", "s")
    return TableSpec(**kw)


def test_cast_malformed_becomes_null_and_missing_skipped(spark, caplog):
    df = spark.createDataFrame([("12", "x"), ("abc", "y")], "a string, b string")
    out = cast_columns(df, spec(cast_map={"a": "long", "nope": "int"}))
    assert out.schema["a"].dataType == T.LongType()
    assert [r.a for r in out.orderBy("b").collect()] == [12, None]
    assert "nope" in caplog.text


def test_cast_empty_map_is_identity(spark):
    df = spark.createDataFrame([("1",)], "a string")
    assert cast_columns(df, spec()) is df


def test_cast_strict_raises(spark):
    df = spark.createDataFrame([("abc",)], "a string")
    with pytest.raises(Exception):
        cast_columns(df, spec(cast_map={"a": "long"}, strict_cast=True)).collect()


def test_alias_copies_overwrites_and_chains(spark):
    df = spark.createDataFrame([(1, 2)], "a long, b long")
    out = alias_columns(df, spec(alias_columns=(("a", "b"), ("b", "c"), ("c", "d"))))
    assert out.columns == ["a", "b", "c", "d"]
    assert tuple(out.first()) == (1, 1, 1, 1)


def test_alias_missing_source_raises(spark):
    df = spark.createDataFrame([(1,)], "a long")
    with pytest.raises(ValueError, match="cannot copy"):
        alias_columns(df, spec(alias_columns={"zz": "a"}))


def test_derive_ymd_uses_timestamp_when_no_partition_ts(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 9, 23, 30),)], "ts timestamp_ntz")
    out = derive_ymd(df, spec(timestamp="ts"))
    r = out.first()
    assert (r.year, r.month, r.date) == (2024, 3, dt.date(2024, 3, 9))
    assert [out.schema[c].dataType for c in ("year", "month", "date")] == [
        T.IntegerType(), T.IntegerType(), T.DateType()]


def test_derive_ymd_prefers_partition_timestamp(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), dt.datetime(2023, 5, 2))],
                               "ts timestamp_ntz, created timestamp_ntz")
    r = derive_ymd(df, spec(timestamp="ts", partition_timestamp="created")).first()
    assert (r.year, r.month) == (2023, 5)


def test_derive_ymd_noop_and_missing(spark):
    df = spark.createDataFrame([(1,)], "a long")
    assert derive_ymd(df, spec()) is df
    with pytest.raises(ValueError, match="cannot derive"):
        derive_ymd(df, spec(timestamp="ts"))


def test_transform_chain_order_and_bare_string(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 2, 1), "7")], "ts timestamp_ntz, k string")
    cfg = {"bronze_table": "x", "load_type": "FULL", "table_category": "DIMENSION",
           "timestamp_col": "ts", "partition_timestamp_col": "ts", "requires_transform": True,
           "transform_config": {"type": "CAST_COLUMNS", "cast_map": {"k": "int"}}}
    s = TableSpec.from_dict(cfg)
    assert s.transforms == ("CAST_COLUMNS",)
    out = apply_transforms(df, s)
    assert out.columns == ["ts", "k"] and out.first().k == 7


def test_unknown_transform_errors_or_skips(spark):
    df = spark.createDataFrame([(1,)], "a long")
    with pytest.raises(ValueError, match="Unknown transform"):
        apply_transforms(df, spec(transforms=("NOPE",)))
    out = apply_transforms(df, spec(transforms=("NOPE",), on_unknown_transform="skip"))
    assert out.columns == ["a"]


def test_requires_transform_false_is_identity(spark):
    df = spark.createDataFrame([(1,)], "a long")
    assert apply_transforms(df, spec(transforms=("DERIVE_YMD",), requires_transform=False,
                                     timestamp="a")) is df


def test_incremental_spec_needs_key_and_timestamp():
    with pytest.raises(ValueError):
        TableSpec(target="t", source="s", load_type="INCREMENTAL", key=("k",))


def test_unknown_config_keys_are_reported(caplog):
    cfg = {"bronze_table": "x", "load_type": "FULL", "dedup_col": ["k"],
           "transform_config": {"type": "DERIVE_YMD", "cast_mapp": {}}}
    TableSpec.from_dict(cfg)
    assert "dedup_col" in caplog.text and "transform_config.cast_mapp" in caplog.text


def test_dictionary_form_takes_per_table_settings(caplog):
    cfg = {"gold_table": "g", "bronze_table": "b", "load_type": "INCREMENTAL",
           "dedup_cols": ["k"], "timestamp_col": "ts", "fixed_partition": True,
           "tiebreak": ["id"], "prune_partition_col": "date", "schema_drift": "error"}
    s = TableSpec.from_dict(cfg)
    assert s.fixed_partition and s.tiebreak == ("id",) and s.prune_partition_col == "date"
    assert s.schema_drift == "error" and "not understood" not in caplog.text
