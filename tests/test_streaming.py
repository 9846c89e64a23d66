import datetime as dt
import os

from lakeloom.operators import latest_per_key
from lakeloom.session import scratch_path
from lakeloom.sinks.history import table_history
from lakeloom.spec import YMD_COLUMNS, TableSpec
from lakeloom.streaming import start_landing_stream
from lakeloom.workloads.queries import EVENTS_SCHEMA, stage_landing


def test_stream_equals_batch(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    base = scratch_path(spark, "stream-test")
    stage_landing(ev, f"{base}/ev", "ts")
    spec = TableSpec(target="stream_eq", source="ev", load_type="INCREMENTAL", schema=EVENTS_SCHEMA,
                     key=("user_id", "event_type"), timestamp="ts", tiebreak=("event_id",),
                     update_op=">=", landing_base=base)
    q = start_landing_stream(spark, spec, max_files_per_trigger=100, record=False)
    q.awaitTermination()
    assert q.exception() is None
    got = spark.table("stream_eq")
    want = latest_per_key(ev, ["user_id", "event_type"], "ts", ["event_id"])
    assert got.count() == want.count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_stream_archives_processed_files(spark):
    import glob
    import os
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    base = scratch_path(spark, "stream-archive")
    stage_landing(ev, f"{base}/ev", "ts", one_file_per_folder=True)
    before = len(glob.glob(f"{base}/ev/*/*/*/*/*.parquet"))
    spec = TableSpec(target="stream_archived", source="ev", load_type="INCREMENTAL",
                     schema=EVENTS_SCHEMA, key=("user_id", "event_type"), timestamp="ts",
                     tiebreak=("event_id",), update_op=">=", landing_base=base)
    q = start_landing_stream(spark, spec, max_files_per_trigger=50, record=False,
                             clean_source="archive", archive_dir=f"{base}/archive")
    q.awaitTermination()
    assert q.exception() is None
    want = latest_per_key(ev, ["user_id", "event_type"], "ts", ["event_id"])
    got = spark.table("stream_archived")
    assert got.count() == want.count() and got.exceptAll(want.select(*got.columns)).count() == 0
    archived = [p for p in glob.glob(f"{base}/archive/**/*.parquet", recursive=True)]
    left = len(glob.glob(f"{base}/ev/*/*/*/*/*.parquet"))
    assert archived and left < before and len(archived) + left == before
    assert not os.path.commonpath([f"{base}/archive", f"{base}/ev"]).endswith("/ev")


def test_stream_newest_delivery_wins_ties(spark, tmp_base):
    import datetime as dt
    import os

    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                           T.StructField("v", T.StringType())])
    ts = pa.array([dt.datetime(2024, 1, 1)], pa.timestamp("us"))
    for h, v in (("10", "newer"), ("9", "older")):
        folder = os.path.join(tmp_base, "tbl", "2024", "1", "1", h)
        os.makedirs(folder)
        pq.write_table(pa.table({"id": pa.array([1], pa.int64()), "ts": ts, "v": [v]}),
                       os.path.join(folder, "f.parquet"))
    spec = TableSpec(target="stream_ties", source="tbl", load_type="INCREMENTAL", schema=schema,
                     key=("id",), timestamp="ts", update_op=">=", landing_base=tmp_base)
    q = start_landing_stream(spark, spec, record=False,
                             checkpoint=os.path.join(tmp_base, "ckpt"))
    q.awaitTermination()
    assert q.exception() is None
    assert [r.v for r in spark.table("stream_ties").collect()] == ["newer"]
    assert spark.table("stream_ties").columns[:3] == ["id", "ts", "v"]


def test_stream_out_of_order_delivery_equals_batch(spark):
    """Newest hours arrive first (file modification times reversed): the
    merge guard, not arrival order, decides the result."""
    import glob
    import os

    from pyspark.sql import functions as F
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet") \
        .filter(F.col("ts") < F.lit("2024-01-04").cast("timestamp_ntz"))
    base = scratch_path(spark, "stream-reversed")
    stage_landing(ev, f"{base}/ev", "ts", one_file_per_folder=True)
    files = sorted(glob.glob(f"{base}/ev/*/*/*/*/*.parquet"),
                   key=lambda p: [int(x.split("=")[1]) for x in p.split("/")[-5:-1]])
    t0 = 1_700_000_000
    for i, path in enumerate(reversed(files)):          # newest hour gets the oldest mtime
        os.utime(path, (t0 + i, t0 + i))
    spec = TableSpec(target="stream_reversed", source="ev", load_type="INCREMENTAL",
                     schema=EVENTS_SCHEMA, key=("user_id", "event_type"), timestamp="ts",
                     tiebreak=("event_id",), update_op=">=", landing_base=base)
    q = start_landing_stream(spark, spec, max_files_per_trigger=max(1, len(files) // 5),
                             record=False)
    q.awaitTermination()
    assert q.exception() is None and len(q.recentProgress) >= 5
    got = spark.table("stream_reversed")
    want = latest_per_key(ev, ["user_id", "event_type"], "ts", ["event_id"])
    assert got.count() == want.count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_fresh_checkpoint_at_the_same_place_loads_new_files(spark, tmp_base):
    import shutil

    from tests.test_ledger import deliver, ids, spec
    s = spec("stream_restarted", f"{tmp_base}/in", schema_drift="error")
    checkpoint = f"{tmp_base}/checkpoint"

    def drain():
        q = start_landing_stream(spark, s, checkpoint=checkpoint, max_files_per_trigger=1, record=False)
        q.awaitTermination()
        assert q.exception() is None

    for h in range(4):
        deliver(f"{tmp_base}/in", h, [h])
    drain()
    shutil.rmtree(checkpoint)
    for h in range(4):
        os.remove(f"{tmp_base}/in/tbl/2024/1/1/{h}/part-0.parquet")
    deliver(f"{tmp_base}/in", 5, [50])
    drain()
    assert ids(spark, "stream_restarted") == [0, 1, 2, 3, 50]


def test_replayed_batch_is_merged_once(spark, tmp_base):
    """A batch whose epoch the target already holds (the process died after the
    merge, before the checkpoint's commit) is not merged again."""
    import glob

    from tests.test_ledger import deliver, spec
    s = spec("stream_replayed", f"{tmp_base}/in", schema_drift="error")
    checkpoint = f"{tmp_base}/checkpoint"
    deliver(f"{tmp_base}/in", 1, [1, 2])
    start_landing_stream(spark, s, checkpoint=checkpoint).awaitTermination()
    for f in glob.glob(f"{checkpoint}/commits/*") + glob.glob(f"{checkpoint}/commits/.*"):
        os.remove(f)                                     # the commit is lost
    q = start_landing_stream(spark, s, checkpoint=checkpoint)
    q.awaitTermination()
    assert q.exception() is None
    assert table_history(spark, s.target).count() == 1 and spark.table(s.target).count() == 2


def test_redelivery_rewrites_nothing(spark, tmp_base):
    from tests.test_ledger import deliver, spec
    s = spec("stream_states", f"{tmp_base}/in", schema_drift="error", partition_cols=YMD_COLUMNS,
             transforms=("DERIVE_YMD",))

    def drain():
        q = start_landing_stream(spark, s, drop_replays=True)
        q.awaitTermination()
        assert q.exception() is None
        return table_history(spark, s.target).first()

    deliver(f"{tmp_base}/in", 1, [1] * 200 + [2, 3], "a")
    assert drain().operation == "CREATE"
    deliver(f"{tmp_base}/in", 1, [1] * 200 + [2, 3], "a", name="again.parquet")
    last = drain()
    assert (last.operation, last.source_rows, last.partitions_rewritten) == ("MERGE", 0, 0)
    # an older row, the same time with another value, and a newer one
    deliver(f"{tmp_base}/in", 1, [1], "older", name="older.parquet", at=dt.datetime(2023, 1, 1))
    deliver(f"{tmp_base}/in", 1, [2], "fixed", name="zfixed.parquet")
    deliver(f"{tmp_base}/in", 4, [3], "newer")
    assert drain().partitions_rewritten == 1
    assert {r.id: r.v for r in spark.table(s.target).collect()} == {1: "a", 2: "fixed", 3: "newer"}
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_state_passes_null_keys_and_null_times(spark, tmp_base):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from tests.test_ledger import spec
    s = spec("stream_nulls", f"{tmp_base}/in", schema_drift="error")
    folder = f"{tmp_base}/in/tbl/2024/1/1/1"
    os.makedirs(folder)
    rows = pa.table({"id": pa.array([None, 5, 6], pa.int64()),
                     "ts": pa.array([dt.datetime(2024, 1, 1), None, dt.datetime(2024, 1, 1)], pa.timestamp("us")),
                     "v": ["n", "t", "x"]})
    for name in ("one", "two"):
        pq.write_table(rows, f"{folder}/{name}.parquet")
        q = start_landing_stream(spark, s, drop_replays=True, record=False)
        q.awaitTermination()
        assert q.exception() is None
    assert sorted(str(r.id) for r in spark.table(s.target).collect()) == ["5", "6", "None", "None"]


def test_state_calls_grow_with_buckets_not_keys():
    """One call settles all keys of a bucket, exactly by key."""
    import numpy as np
    import pandas as pd

    from lakeloom.streaming import newest_state

    class State:
        exists, get = False, None

        def update(self, value):
            self.exists, self.get = True, value

    def sent(state, *rows):
        cols = ["v", *newest_state._MARKS]
        frames = [pd.DataFrame([r], columns=cols) for r in rows]
        out = list(newest_state._newer((7,), iter(frames), state))
        return [v for f in out for v in f["v"]]

    def row(v, key, t, null=False):
        return (v, t, hash((v, key)) % (1 << 62), key, -key, null, 7)

    state = State()
    many = [row(f"a{k}", k, 10) for k in range(300)]
    assert len(sent(state, *many, row("n", 1, 10, True))) == 301
    # again: nothing but the NULL key; older, as new with another value, newer
    assert sent(state, *many, row("n", 1, 10, True)) == ["n"]
    assert sent(state, row("old", 5, 9), row("fixed", 5, 10), row("new", 6, 11), row("first", 900, 1)) == ["fixed", "new", "first"]
    assert sent(state, *many[:5], *many[7:], many[5], many[6], row("fixed", 5, 10), row("new", 6, 11)) == []
    assert len(np.frombuffer(state.get[0], dtype="<i8")) == 4 * 302


def test_stream_state_has_one_group_a_bucket(spark, tmp_base):
    """Forty times as many keys as buckets keep a state row a bucket, and a
    second delivery of all of them passes nothing."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    from tests.test_ledger import spec
    s = spec("stream_buckets", f"{tmp_base}/in", schema_drift="error")
    folder = f"{tmp_base}/in/tbl/2024/1/1/1"
    os.makedirs(folder)
    rows = pa.table({"id": pa.array(range(4000), pa.int64()),
                     "ts": pa.array([dt.datetime(2024, 1, 1)] * (4000), pa.timestamp("us")),
                     "v": ["x"] * (4000)})
    for name, passed in (("one", 4000), ("two", 0)):
        pq.write_table(rows, f"{folder}/{name}.parquet")
        q = start_landing_stream(spark, s, drop_replays=True, state_buckets=100)
        q.awaitTermination()
        assert q.exception() is None
        states = [o["numRowsTotal"] for p in q.recentProgress for o in p["stateOperators"]]
        assert states and max(states) <= 100
        last = table_history(spark, s.target).first()
        assert last.source_rows == passed
    assert spark.table(s.target).count() == 4000
