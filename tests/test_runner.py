import datetime as dt
import uuid

import pytest

from lakeloom.plans import dependency_levels, outcome_counts, run_loads
from lakeloom.sinks import overwrite_table
from lakeloom.spec import LookupSpec, TableSpec

D = dt.datetime


def test_report_isolates_failures_and_skips_disabled(spark):
    spark.createDataFrame([(1, D(2024, 1, 1)), (1, D(2024, 1, 2))], "k long, ts timestamp_ntz") \
        .createOrReplaceTempView("runner_src")
    specs = [
        TableSpec(target="runner_ok", source="runner_src", key=("k",), timestamp="ts"),
        TableSpec(target="runner_off", source="runner_src", enabled=False),
        TableSpec(target="runner_bad", source="runner_src", load_type="WHATEVER"),
        {"gold_table": "runner_dict", "bronze_table": "runner_missing", "load_type": "FULL",
         "table_category": "FACT", "columns": ["k"]},
    ]
    rep = {r.table_name: r for r in run_loads(spark, specs).collect()}
    assert set(rep) == {"runner_ok", "runner_bad", "runner_dict"}
    assert rep["runner_ok"].status == "SUCCESS" and rep["runner_ok"].row_count == 1
    assert rep["runner_bad"].status == "FAILED" and "neither INCREMENTAL nor FULL" in rep["runner_bad"].error
    assert rep["runner_dict"].status == "FAILED"
    c = outcome_counts(run_loads(spark, specs)).first()
    assert (c.total, c.success, c.failed) == (3, 1, 2)


def test_all_disabled_gives_empty_report(spark):
    assert run_loads(spark, [TableSpec(target="x", source="y", enabled=False)]).count() == 0


def test_lookup_dependency_order(spark):
    dim = TableSpec(target="dep_dim", source="dep_dim_src")
    fact = TableSpec(target="dep_fact", source="dep_fact_src", transforms=("PRICE_REVENUE",),
                     lookup=LookupSpec("dep_dim", "shop_id", "price", "sales", "ts"))
    other = TableSpec(target="dep_other", source="dep_fact_src")
    levels = dependency_levels([fact, other, dim])
    assert [sorted(s.target for s in lv) for lv in levels] == [["dep_dim", "dep_other"], ["dep_fact"]]
    with pytest.raises(ValueError, match="cycle"):
        dependency_levels([TableSpec(target="a", source="b", lookup=LookupSpec("b", "k")),
                           TableSpec(target="b", source="a", lookup=LookupSpec("a", "k"))])


def test_dependent_tables_load_in_one_run(spark):
    overwrite_table(spark.createDataFrame([(1, 5.0, D(2024, 1, 1))],
                                          "shop_id long, price double, ts timestamp_ntz"), "dep_dim_raw")
    overwrite_table(spark.createDataFrame([(1, 2.0), (2, 1.0)], "shop_id long, sales double"),
                    "dep_fact_raw")
    dim = TableSpec(target="dep_dim2", source="dep_dim_raw")
    fact = TableSpec(target="dep_fact2", source="dep_fact_raw", transforms=("PRICE_REVENUE",),
                     lookup=LookupSpec("dep_dim2", "shop_id", "price", "sales", "ts"))
    rep = run_loads(spark, [fact, dim])
    assert {r.status for r in rep.collect()} == {"SUCCESS"}
    got = sorted((r.shop_id, r.revenue) for r in spark.table("dep_fact2").collect())
    assert got == [(1, 10.0), (2, 0.0)]


def test_dictionary_configs_run_both_hops(spark, tmp_base):
    """Raw hop from a landing folder, then clean hop, both as plain dicts."""
    import os

    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("shop_id", T.LongType()),
                           T.StructField("created_at", T.TimestampType()),
                           T.StructField("sales", T.DoubleType())])
    for h, rows in (("3", [(1, 1.0), (2, 2.0)]), ("4", [(1, 5.0)])):
        folder = os.path.join(tmp_base, "dict_shop_sales", "2024", "01", "02", h)
        os.makedirs(folder)
        ts = pa.array([D(2024, 1, 2, int(h))] * len(rows), pa.timestamp("us", tz="UTC"))
        pq.write_table(pa.table({"shop_id": pa.array([r[0] for r in rows], pa.int64()),
                                 "created_at": ts, "sales": [r[1] for r in rows]}),
                       os.path.join(folder, "part.parquet"))
    raw = {"bronze_table": "dict_shop_sales", "load_type": "INCREMENTAL", "table_category": "FACT",
           "schema": schema, "dedup_cols": ["shop_id"], "timestamp_col": "created_at",
           "partition_timestamp_col": "created_at", "requires_transform": True,
           "transform_config": {"type": ["DERIVE_YMD"]}}
    spec = TableSpec.from_dict(raw, landing_base=tmp_base)
    assert spec.update_op == ">=" and spec.partition_cols == ("year", "month", "date")
    rep = run_loads(spark, [raw], landing_base=tmp_base).first()
    assert (rep.status, rep.row_count, rep.inserted) == ("SUCCESS", 2, 2)
    clean = {"gold_table": "dict_fact_sales", "bronze_table": "dict_shop_sales",
             "load_type": "INCREMENTAL", "table_category": "FACT",
             "columns": ["shop_id", "created_at", "sales"], "dedup_cols": ["shop_id"],
             "timestamp_col": "created_at", "partition_timestamp_col": "created_at",
             "partition_cols": ["year", "month", "date"], "requires_transform": True,
             "transform_config": {"type": "DERIVE_YMD"}}
    assert TableSpec.from_dict(clean).update_op == ">"
    assert run_loads(spark, [clean]).first().status == "SUCCESS"
    got = sorted((r.shop_id, r.sales) for r in spark.table("dict_fact_sales").collect())
    assert got == [(1, 5.0), (2, 2.0)]


def test_scale_conf_bounds_reducers():
    from lakeloom.session import scale_conf
    big = scale_conf(100 * 2**40)
    assert big["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "100000"
    assert scale_conf(2**30)["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "200"
    assert scale_conf(200 * 2**30)["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "800"


def test_history_failure_does_not_fail_the_load(spark, monkeypatch, caplog):
    import lakeloom.plans.loads as loads

    def broken(*a, **k):
        raise OSError("history store unavailable")
    monkeypatch.setattr(loads, "append_history", broken)
    spark.createDataFrame([(1, D(2024, 1, 1))], "k long, ts timestamp_ntz") \
        .createOrReplaceTempView("hist_fail_src")
    rep = run_loads(spark, [TableSpec(target="hist_fail_t", source="hist_fail_src",
                                      key=("k",), timestamp="ts")]).first()
    assert rep.status == "SUCCESS" and spark.table("hist_fail_t").count() == 1
    assert "history entry was not written" in caplog.text


def test_a_run_goes_on_where_it_stopped(spark, monkeypatch):
    from lakeloom.plans import runner
    from lakeloom.spec import TableSpec
    loaded, broken = [], {"dim"}

    def load(_, s):
        loaded.append(s.target)
        if s.target in broken:
            raise RuntimeError("not today")
        return type("R", (), dict(source_rows=len(loaded), inserted=0, updated=0, skipped_files=0,
                                  partitions_rewritten=None))

    def table(target, source, **kw):
        return TableSpec(target=target, source=source, **kw)

    monkeypatch.setattr(runner, "load_table", load)
    run = f"night/{uuid.uuid4().hex}"
    specs = [table("raw", "landing"), table("clean", "raw"), table("dim", "elsewhere"), table("fact", "dim")]

    def call(specs, run=run):
        loaded.clear()
        report = {r.table_name: (r.status, r.row_count) for r in runner.run_loads(spark, specs, run_id=run).collect()}
        return sorted(loaded), report

    done, report = call(specs)
    assert done == ["clean", "dim", "raw"] and report["fact"][0] == "FAILED"
    assert call(specs)[0] == ["dim"]                       # still broken: nothing else is loaded
    broken.clear()
    done, second = call(specs)
    assert done == ["dim", "fact"] and {s for s, _ in second.values()} == {"SUCCESS"}
    assert second["raw"] == report["raw"] and second["clean"] == report["clean"]
    assert call(specs)[0] == []
    # a changed configuration loads its table and what reads it
    assert call([specs[0].with_(n_folders=5), *specs[1:]])[0] == ["clean", "raw"]
    # another run starts from nothing
    assert call(specs, run=f"other-{uuid.uuid4().hex}")[0] == ["clean", "dim", "fact", "raw"]
    assert runner.run_state(spark, run).filter("status = 'SUCCESS'").count() == 4
