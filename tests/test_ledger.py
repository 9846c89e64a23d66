"""File ledger, arrival watermark and finished snapshots."""

import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.plans import loads
from lakeloom.plans.loads import load_clean_incremental, load_raw_full, load_raw_incremental
from lakeloom.sinks.tables import get_note
from lakeloom.sources import ledger as ledger_module
from lakeloom.sources.landing import complete_snapshot
from lakeloom.spec import TableSpec

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                       T.StructField("v", T.StringType())])


def deliver(base, hour, ids, v="a", name="part-0.parquet", day=1, at=None, id_type=pa.int64()):
    folder = os.path.join(base, "tbl", "2024", "1", str(day), str(hour))
    os.makedirs(folder, exist_ok=True)
    when = at or dt.datetime(2024, 1, day, hour)
    path = os.path.join(folder, name)
    pq.write_table(pa.table({"id": pa.array([str(i) if id_type == pa.string() else i for i in ids], id_type),
                             "ts": pa.array([when] * len(ids), pa.timestamp("us")), "v": [v] * len(ids)}), path)
    return path


def spec(name, base, **kw):
    kw = {"n_folders": 2, "schema_drift": "exclude", **kw}
    return TableSpec(target=name, source="tbl", load_type="INCREMENTAL", schema=SCHEMA, key=("id",), timestamp="ts",
                     update_op=">=", landing_base=base, **kw)


def ids(spark, name):
    return sorted(r.id for r in spark.table(name).select("id").collect())


def test_late_file_in_an_older_folder_is_loaded_once(spark, tmp_base, monkeypatch):
    for h in range(5):
        deliver(tmp_base, h, [h])
    s = spec("ledger_late", tmp_base)
    load_raw_incremental(spark, s, n_folders=None, record=False)
    deliver(tmp_base, 1, [100], name="late.parquet")
    deliver(tmp_base, 5, [5])
    read = []
    real = ledger_module.read_landing_folders
    monkeypatch.setattr(ledger_module, "read_landing_folders",
                        lambda sp, paths, *a, **k: (read.append([os.path.basename(os.path.dirname(p)) for p in paths]),
                                                    real(sp, paths, *a, **k))[1])
    assert load_raw_incremental(spark, s, record=False).source_rows == 2
    assert ids(spark, "ledger_late") == [0, 1, 2, 3, 4, 5, 100]
    assert load_raw_incremental(spark, s, record=False).source_rows == 0
    assert [sorted(x) for x in read] == [["1", "5"]]              # each new file once, nothing again


def test_first_load_reads_the_newest_folders_only(spark, tmp_base):
    for h in range(4):
        deliver(tmp_base, h, [h])
    s = spec("ledger_first", tmp_base)
    load_raw_incremental(spark, s, record=False)
    assert ids(spark, "ledger_first") == [2, 3]
    deliver(tmp_base, 0, [50], name="late.parquet")
    load_raw_incremental(spark, s, record=False)
    assert ids(spark, "ledger_first") == [2, 3, 50]               # older files stay out, later ones do not


def test_left_out_file_is_looked_at_again_until_mended(spark, tmp_base, monkeypatch):
    deliver(tmp_base, 1, [1])
    bad = deliver(tmp_base, 1, [9], name="bad.parquet", id_type=pa.string())
    s = spec("ledger_left_out", tmp_base)
    assert load_raw_incremental(spark, s, record=False).skipped_files == 1
    deliver(tmp_base, 2, [2])
    looked = []
    real = ledger_module.screen_files
    monkeypatch.setattr(ledger_module, "screen_files", lambda files, *a, **k: (
        looked.append(sorted(os.path.basename(r.path) for r in files.collect())), real(files, *a, **k))[1])
    r = load_raw_incremental(spark, s, record=False)
    assert (r.source_rows, r.skipped_files) == (1, 1) and looked == [["bad.parquet", "part-0.parquet"]]
    r = load_raw_incremental(spark, s, record=False)              # only the bad file is open
    assert (r.source_rows, r.skipped_files) == (0, 1) and looked[-1] == ["bad.parquet"]
    os.utime(deliver(tmp_base, 1, [9], name="bad.parquet"), (2e9, 2e9))
    assert bad.endswith("bad.parquet")
    assert load_raw_incremental(spark, s, record=False).source_rows == 1
    assert ids(spark, "ledger_left_out") == [1, 2, 9]


def test_file_written_again_is_loaded_again(spark, tmp_base):
    path = deliver(tmp_base, 1, [1], "old")
    s = spec("ledger_again", tmp_base)
    load_raw_incremental(spark, s, record=False)
    deliver(tmp_base, 1, [1, 2], "new")
    os.utime(path, (2e9, 2e9))
    load_raw_incremental(spark, s, record=False)
    assert {r.id: r.v for r in spark.table("ledger_again").collect()} == {1: "new", 2: "new"}


def test_entry_of_a_failed_load_does_not_count(spark, tmp_base, monkeypatch):
    deliver(tmp_base, 1, [1])
    s = spec("ledger_failed", tmp_base)
    load_raw_incremental(spark, s, record=False)
    deliver(tmp_base, 2, [2])
    with monkeypatch.context() as m:
        m.setattr(loads, "upsert_table", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("merge died")))
        with pytest.raises(RuntimeError, match="merge died"):
            load_raw_incremental(spark, s, record=False)
    assert load_raw_incremental(spark, s, record=False).source_rows == 1
    assert ids(spark, "ledger_failed") == [1, 2]


def test_ledger_is_compacted_and_starts_again_with_its_table(spark, tmp_base, monkeypatch):
    monkeypatch.setattr(ledger_module, "COMPACT", 2)
    s = spec("ledger_compact", tmp_base)
    for h in range(6):
        deliver(tmp_base, h, [h])
        assert load_raw_incremental(spark, s, record=False).source_rows == 1
    book = ledger_module.open_ledger(spark, s.target, f"{tmp_base}/tbl", lambda k: get_note(spark, s.target, k))
    assert len(book.finished()) <= 3 and book.entries().filter("status = 'loaded'").count() == 6
    assert load_raw_incremental(spark, s, record=False).source_rows == 0
    spark.sql("DROP TABLE ledger_compact")
    assert load_raw_incremental(spark, s, record=False).source_rows == 2       # the newest two folders


def test_late_days_bound_the_listing(spark, tmp_base):
    for d in (1, 9, 10):
        deliver(tmp_base, 3, [d], day=d)
    s = spec("ledger_days", tmp_base, late_days=1, n_folders=None)
    load_raw_incremental(spark, s, record=False)
    assert ids(spark, "ledger_days") == [9, 10]
    deliver(tmp_base, 1, [90], name="late.parquet", day=9)
    deliver(tmp_base, 1, [20], name="late.parquet", day=2)
    load_raw_incremental(spark, s, record=False)
    assert ids(spark, "ledger_days") == [9, 10, 90]


def test_empty_and_missing_landing(spark, tmp_base):
    s = spec("ledger_none", tmp_base)
    with pytest.raises(ValueError, match="no hour folder"):
        load_raw_incremental(spark, s, record=False)
    os.makedirs(os.path.join(tmp_base, "tbl", "2024", "1", "1", "3"))
    with pytest.raises(ValueError, match="no Parquet file"):
        load_raw_incremental(spark, s, record=False)
    with pytest.raises(ValueError, match="no Parquet file"):
        load_raw_incremental(spark, s, n_folders=None, record=False)


def test_arrival_watermark_lets_late_and_edited_rows_pass(spark, tmp_base):
    raw = spec("arrival_raw_t", tmp_base, load_col="load_no", n_folders=None)
    clean = TableSpec(target="arrival_clean_t", source="arrival_raw_t", load_type="INCREMENTAL", key=("id",),
                      timestamp="ts", arrival_col="load_no")
    by_time = clean.with_(target="by_time_clean_t", arrival_col=None, columns=("id", "ts", "v"))

    def step():
        load_raw_incremental(spark, raw, record=False)
        a = load_clean_incremental(spark, clean, record=False)
        load_clean_incremental(spark, by_time, record=False)
        return a.source_rows

    deliver(tmp_base, 5, [1, 2], "first")
    assert step() == 2
    deliver(tmp_base, 6, [3], "newer")
    assert step() == 1                                            # only what the second load brought
    deliver(tmp_base, 7, [4], "late", at=dt.datetime(2024, 1, 1, 2))
    deliver(tmp_base, 7, [1], "edited", name="edit.parquet", at=dt.datetime(2024, 1, 1, 5, 30))
    deliver(tmp_base, 7, [3], "stale", name="stale.parquet", at=dt.datetime(2024, 1, 1, 1))
    assert step() == 2                                            # the stale row never reached raw
    got = {r.id: r.v for r in spark.table("arrival_clean_t").collect()}
    assert got == {1: "edited", 2: "first", 3: "newer", 4: "late"}
    assert {r.id: r.v for r in spark.table("by_time_clean_t").collect()} == {1: "first", 2: "first", 3: "newer"}
    assert "load_no" not in spark.table("arrival_clean_t").columns
    assert load_clean_incremental(spark, clean, record=False).source_rows == 0


def test_arrival_bounds_reach_the_scan(spark, tmp_base):
    deliver(tmp_base, 1, [1])
    raw = spec("arrival_raw_p", tmp_base, load_col="load_no")
    load_raw_incremental(spark, raw, record=False)
    clean = TableSpec(target="arrival_clean_p", source="arrival_raw_p", load_type="INCREMENTAL", key=("id",),
                      timestamp="ts", arrival_col="load_no")
    load_clean_incremental(spark, clean, record=False)
    deliver(tmp_base, 2, [2])
    load_raw_incremental(spark, raw, record=False)
    df = loads._arrived(spark, spark.table("arrival_raw_p"), clean, {})
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(load_no" in plan and "LessThanOrEqual(load_no" in plan


def test_finished_snapshots(spark, tmp_base):
    base = os.path.join(tmp_base, "tbl")
    for h, n in ((1, 3), (2, 5), (3, 1)):
        deliver(tmp_base, h, range(n))
    # no folder says that it is finished: the newest one counts
    assert complete_snapshot(spark, base)[0].endswith("/3")
    with pytest.raises(ValueError, match="no finished"):
        complete_snapshot(spark, base, marker="_SUCCESS")
    open(os.path.join(base, "2024", "1", "1", "2", "_SUCCESS"), "w").close()
    assert complete_snapshot(spark, base)[0].endswith("/2")
    open(os.path.join(base, "2024", "1", "1", "1", "DONE"), "w").close()
    assert complete_snapshot(spark, base, marker="DONE")[0].endswith("/1")
    for h in (1, 2):
        for f in os.listdir(os.path.join(base, "2024", "1", "1", str(h))):
            os.utime(os.path.join(base, "2024", "1", "1", str(h), f), (1e9, 1e9))
    assert complete_snapshot(spark, base, settle=10)[0].endswith("/2")
    full = TableSpec(target="finished_t", source="tbl", load_type="FULL", schema=SCHEMA, key=("id",), landing_base=tmp_base,
                     snapshot_mode="latest_folder", load_col="load_no")
    load_raw_full(spark, full, record=False)
    assert ids(spark, "finished_t") == list(range(5))
    assert spark.table("finished_t").select("load_no").distinct().count() == 1
    first = int(get_note(spark, "finished_t", "load"))
    load_raw_full(spark, full.with_(snapshot_marker="DONE"), record=False)
    assert ids(spark, "finished_t") == [0, 1, 2] and spark.table("finished_t").agg(F.min("load_no")).first()[0] > first
