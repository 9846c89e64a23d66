import datetime as dt
import random

import pytest

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakeloom.operators import guarded_upsert
from lakeloom.sinks import upsert_table
from lakeloom.sinks.history import last_load, latest_entries, read_history, append_history

D = dt.datetime
SCHEMA = "k long, ts timestamp_ntz, v string"


def merged(spark, t, s, op, null_keys="salt"):
    out = guarded_upsert(spark.createDataFrame(t, SCHEMA), spark.createDataFrame(s, SCHEMA),
                         ["k"], "ts", op, null_keys=null_keys)
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_equal_timestamps(spark):
    t, s = [(1, D(2024, 1, 1), "old")], [(1, D(2024, 1, 1), "new")]
    assert merged(spark, t, s, ">=") == [(1, D(2024, 1, 1), "new", "update")]
    assert merged(spark, t, s, ">") == [(1, D(2024, 1, 1), "old", "keep")]


def test_null_key_inserted_and_null_ts_kept(spark):
    t = [(None, D(2024, 1, 1), "tn"), (2, None, "t2"), (3, D(2024, 1, 1), "t3")]
    s = [(None, D(2024, 1, 5), "sn"), (2, D(2024, 1, 5), "s2"), (3, None, "s3")]
    out = merged(spark, t, s, ">")
    assert (None, D(2024, 1, 1), "tn", "keep") in out
    assert (None, D(2024, 1, 5), "sn", "insert") in out
    assert (2, None, "t2", "keep") in out
    assert (3, D(2024, 1, 1), "t3", "keep") in out
    assert len(out) == 4


def test_target_only_columns(spark):
    t = spark.createDataFrame([(1, D(2024, 1, 1), "a", "x")], SCHEMA + ", extra string")
    s = spark.createDataFrame([(1, D(2024, 1, 2), "b"), (2, D(2024, 1, 2), "c")], SCHEMA)
    rows = {r.k: r for r in guarded_upsert(t, s, ["k"], "ts", ">").collect()}
    assert rows[1].v == "b" and rows[1].extra == "x"
    assert rows[2].extra is None and rows[2].action == "insert"


def model(t, s, op):
    """Reference model of the merge in plain Python."""
    gt = (lambda a, b: a > b) if op == ">" else (lambda a, b: a >= b)
    out, matched_s = [], set()
    for tr in t:
        hit = [sr for sr in s if tr[0] is not None and sr[0] == tr[0]]
        if hit:
            matched_s.add(hit[0][0])
            sr = hit[0]
            if sr[1] is not None and tr[1] is not None and gt(sr[1], tr[1]):
                out.append(sr + ("update",))
                continue
        out.append(tr + ("keep",))
    tkeys = {tr[0] for tr in t if tr[0] is not None}
    out += [sr + ("insert",) for sr in s if sr[0] is None or sr[0] not in tkeys]
    return sorted(out, key=repr)


rows_st = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)),
                             st.one_of(st.none(), st.integers(0, 3)),
                             st.sampled_from(["a", "b", "c"])), max_size=12)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(t=rows_st, s=rows_st, op=st.sampled_from([">", ">="]))
def test_matches_model(spark, t, s, op):
    def uniq(rows):  # one row per non-NULL key, as after dedup
        seen, out = set(), []
        for k, d, v in rows:
            if k is None or k not in seen:
                seen.add(k)
                out.append((k, None if d is None else D(2024, 1, 1 + d), v))
        return out
    t, s = uniq(t), uniq(s)
    want = model(t, s, op)
    assert merged(spark, t, s, op) == want
    assert merged(spark, t, s, op, null_keys="split") == want


def test_upsert_table_idempotent_and_counts(spark):
    rnd = random.Random(7)
    base = [(i, D(2024, 1, 1 + rnd.randrange(5)), f"v{i}") for i in range(50)]
    batch = [(i, D(2024, 1, 1 + rnd.randrange(9)), f"w{i}") for i in range(30, 70)]
    name = "ups_idem"
    upsert_table(spark.createDataFrame(base, SCHEMA), name, ["k"], "ts", ">")
    r1 = upsert_table(spark.createDataFrame(batch, SCHEMA), name, ["k"], "ts", ">")
    assert r1.operation == "MERGE" and r1.inserted == 20
    assert r1.rows_written == 50 + r1.inserted == spark.table(name).count()
    before = sorted(map(tuple, spark.table(name).collect()))
    r2 = upsert_table(spark.createDataFrame(batch, SCHEMA), name, ["k"], "ts", ">")
    assert (r2.inserted, r2.updated) == (0, 0)
    assert sorted(map(tuple, spark.table(name).collect())) == before


def test_update_moves_row_between_partitions(spark):
    schema = SCHEMA + ", date date"
    name = "ups_move"
    t = spark.createDataFrame([(1, D(2024, 1, 1), "a", dt.date(2024, 1, 1)),
                               (2, D(2024, 1, 1), "b", dt.date(2024, 1, 1))], schema)
    upsert_table(t, name, ["k"], "ts", ">", partition_cols=["date"])
    s = spark.createDataFrame([(1, D(2024, 1, 3), "a2", dt.date(2024, 1, 3))], schema)
    upsert_table(s, name, ["k"], "ts", ">", partition_cols=["date"])
    got = sorted((r.k, r.date) for r in spark.table(name).collect())
    assert got == [(1, dt.date(2024, 1, 3)), (2, dt.date(2024, 1, 1))]


def test_failed_merge_leaves_target(spark):
    name = "ups_fail"
    upsert_table(spark.createDataFrame([(1, D(2024, 1, 1), "a")], SCHEMA), name, ["k"], "ts")
    bad = spark.createDataFrame([(1, D(2024, 1, 2), "b", 1)], SCHEMA + ", zz long")
    try:
        upsert_table(bad, name, ["k"], "ts")
    except ValueError:
        pass
    assert [r.v for r in spark.table(name).collect()] == ["a"]


def test_bucketed_target_is_not_shuffled(spark):
    name = "ups_bucketed"
    t = spark.createDataFrame([(i, D(2024, 1, 1), "a") for i in range(40)], SCHEMA)
    upsert_table(t, name, ["k"], "ts", buckets=4)
    s = spark.createDataFrame([(i, D(2024, 1, 2), "b") for i in range(30, 60)], SCHEMA)
    # the mode upsert_table uses for a bucketed target: join on the key alone
    m = guarded_upsert(spark.table(name), s, ["k"], "ts", null_keys="split")
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1   # only the batch side
    # the salted default reads each side once and needs no union
    salted = guarded_upsert(spark.table(name), s, ["k"], "ts")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "Union" not in salted and salted.count("Exchange hashpartitioning") == 2
    r = upsert_table(s, name, ["k"], "ts", buckets=4)
    assert (r.inserted, r.updated) == (20, 10)


def test_history_latest_entry(spark, tmp_base):
    from lakeloom.sinks.tables import LoadResult
    for i in range(3):
        append_history(spark, LoadResult("h_t", "MERGE", "p", 5, inserted=i), root=tmp_base)
    append_history(spark, LoadResult("db.h_u", "CREATE", "q", 7, inserted=7), root=tmp_base)
    assert last_load(spark, "h_t", root=tmp_base)["inserted"] == 2
    assert last_load(spark, "db.h_u", root=tmp_base)["operation"] == "CREATE"
    append_history(spark, LoadResult("db.h_u", "MERGE", "r", 3, partitions_rewritten=2), root=tmp_base)
    assert last_load(spark, "db.h_u", root=tmp_base)["partitions_rewritten"] == 2
    assert last_load(spark, "other", root=tmp_base) is None
    assert latest_entries(read_history(spark, tmp_base)).count() == 2
    one = read_history(spark, tmp_base).filter("table_name = 'h_t'")
    assert "PartitionFilters: [isnotnull(table_name" in \
        one._jdf.queryExecution().executedPlan().toString()
    assert read_history(spark, tmp_base).columns[0] == "table_name"
    from lakeloom.sinks import history_view, table_history
    assert [r.inserted for r in table_history(spark, "h_t", tmp_base).collect()] == [2, 1, 0]
    v = history_view(spark, "hist_v", tmp_base)
    assert spark.sql(f"SELECT max(inserted) AS m FROM {v} WHERE table_name = 'db.h_u'").first().m == 7


def test_partition_scope_rewrites_only_touched(spark):
    schema = SCHEMA + ", date date"
    name = "ups_scope"
    rows = [(i, D(2024, 1, 1 + i % 5), f"v{i}", dt.date(2024, 1, 1 + i % 5)) for i in range(50)]
    upsert_table(spark.createDataFrame(rows, schema), name, ["k"], "ts", partition_cols=["date"])
    # key 0 lives in 2024-01-01 (alone with 5, 10, ...); move every key of 01-05 to 01-09
    moved = [(i, D(2024, 1, 9), f"m{i}", dt.date(2024, 1, 9)) for i in range(4, 50, 5)]
    r = upsert_table(spark.createDataFrame(moved, schema), name, ["k"], "ts",
                     partition_cols=["date"])
    assert r.partitions_rewritten == 1 and r.updated == 10 and r.inserted == 0
    parts = sorted(x[0] for x in spark.sql(f"SHOW PARTITIONS {name}").collect())
    assert parts == [f"date=2024-01-0{d}" for d in (1, 2, 3, 4, 9)]     # 01-05 emptied, dropped
    got = {x.k: x.date for x in spark.table(name).collect()}
    assert len(got) == 50 and got[4] == dt.date(2024, 1, 9) and got[3] == dt.date(2024, 1, 4)
    # a batch touching one partition reads only that partition of the target
    again = spark.createDataFrame([(3, D(2024, 1, 10), "z", dt.date(2024, 1, 4))], schema)
    r2 = upsert_table(again, name, ["k"], "ts", partition_cols=["date"])
    assert r2.partitions_rewritten == 1 and r2.rows_written == 10
    assert spark.table(name).count() == 50


@pytest.mark.parametrize("partitioned", [False, True])
def test_batch_order_independent(spark, partitioned):
    rnd = random.Random(11)
    days = rnd.sample(range(1, 28), 27)          # distinct timestamps across all batches
    base = [(i, D(2024, 1, days.pop()), f"b{i}") for i in range(0, 8)]
    a = [(i, D(2024, 1, days.pop()), f"a{i}") for i in range(4, 12)]
    b = [(i, D(2024, 1, days.pop()), f"c{i}") for i in range(6, 14) if days]
    schema = SCHEMA + ", date date"

    def with_date(rows):
        return spark.createDataFrame([r + (r[1].date(),) for r in rows], schema)

    finals = []
    for order in ((a, b), (b, a)):
        name = f"ups_order_{int(partitioned)}_{len(finals)}"
        parts = ["date"] if partitioned else None
        upsert_table(with_date(base), name, ["k"], "ts", ">", partition_cols=parts)
        for batch in order:
            upsert_table(with_date(batch), name, ["k"], "ts", ">", partition_cols=parts)
        finals.append(sorted(map(tuple, spark.table(name).select("k", "ts", "v").collect())))
    assert finals[0] == finals[1]
    newest = {}
    for k, ts, v in base + a + b:
        if k not in newest or ts > newest[k][0]:
            newest[k] = (ts, v)
    assert finals[0] == sorted((k, ts, v) for k, (ts, v) in newest.items())


def test_batch_scope_for_fixed_partitions(spark):
    # the partition follows the key's creation day, which never changes
    schema = "k long, created date, ts timestamp_ntz, v string"
    base = [(i, dt.date(2024, 1, 1 + i % 4), D(2024, 2, 1), f"b{i}") for i in range(40)]
    batch = [(i, dt.date(2024, 1, 1 + i % 4), D(2024, 2, 2), f"n{i}") for i in range(36, 48, 4)]
    results = {}
    for scope in ("auto", "batch"):
        name = f"ups_fixed_{scope}"
        upsert_table(spark.createDataFrame(base, schema), name, ["k"], "ts", ">",
                     partition_cols=["created"])
        r = upsert_table(spark.createDataFrame(batch, schema), name, ["k"], "ts", ">",
                         partition_cols=["created"], scope=scope)
        assert (r.inserted, r.updated, r.partitions_rewritten) == (2, 1, 1)
        results[scope] = sorted(map(tuple, spark.table(name).collect()))
    assert results["auto"] == results["batch"] and len(results["batch"]) == 42
    with pytest.raises(ValueError, match="scope"):
        upsert_table(spark.createDataFrame(batch, schema), "ups_fixed_auto", ["k"], "ts",
                     scope="partial")


def test_two_part_name_creates_database(spark):
    df = spark.createDataFrame([(1, D(2024, 1, 1), "a")], SCHEMA)
    r = upsert_table(df, "lakeloom_newdb.t", ["k"], "ts")
    assert r.operation == "CREATE" and spark.catalog.databaseExists("lakeloom_newdb")
    r = upsert_table(df.selectExpr("k", "ts + INTERVAL 1 DAY AS ts", "'b' AS v"),
                     "lakeloom_newdb.t", ["k"], "ts")
    assert r.updated == 1 and spark.table("lakeloom_newdb.t").first().v == "b"


def test_same_schema_overwrite_switches_location(spark):
    from lakeloom.sinks import overwrite_table
    df = spark.createDataFrame([(1, D(2024, 1, 1), "a")], SCHEMA)
    p1 = overwrite_table(df, "switch_t").path
    p2 = overwrite_table(df.selectExpr("k + 1 AS k", "ts", "v"), "switch_t").path
    loc = [r[1] for r in spark.sql("DESCRIBE TABLE EXTENDED switch_t").collect() if r[0] == "Location"]
    assert p1 != p2 and loc[0].rstrip("/").endswith(p2.rstrip("/").split(":")[-1])
    assert [r.k for r in spark.table("switch_t").collect()] == [2]
    # a different schema replaces the definition
    overwrite_table(df.selectExpr("k", "v"), "switch_t")
    assert spark.table("switch_t").columns == ["k", "v"]
    r = upsert_table(df.selectExpr("k", "'b' AS v"), "switch_t", ["k"], "v", ">")
    assert r.updated == 1 and spark.table("switch_t").first().v == "b"


def test_salted_upsert_with_map_column(spark):
    schema = "k long, ts timestamp_ntz, attrs map<string,string>"
    t = spark.createDataFrame([(1, D(2024, 1, 1), {"a": "1"}), (None, D(2024, 1, 1), {"b": "2"})],
                              schema)
    s = spark.createDataFrame([(1, D(2024, 1, 2), {"a": "9"}), (None, D(2024, 1, 3), {})], schema)
    rows = sorted((r.k, r.action) for r in guarded_upsert(t, s, ["k"], "ts").collect()
                  if r.k is not None)
    assert rows == [(1, "update")]
    assert guarded_upsert(t, s, ["k"], "ts").filter("k IS NULL").count() == 2


def test_failed_create_registers_nothing(spark):
    from pyspark.sql import functions as F
    bad = spark.createDataFrame([(1, D(2024, 1, 1), "a")], SCHEMA).withColumn(
        "v", F.when(F.col("k") > 0, F.raise_error(F.lit("boom"))).otherwise(F.col("v")))
    with pytest.raises(Exception):
        upsert_table(bad, "ups_never_created", ["k"], "ts")
    assert not spark.catalog.tableExists("ups_never_created")


def test_concurrent_history_appends_all_land(spark, tmp_base):
    from concurrent.futures import ThreadPoolExecutor

    from lakeloom.sinks.tables import LoadResult
    names = [f"db.conc_{i % 3} x/y" for i in range(12)]          # odd characters too
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda n: append_history(spark, LoadResult(n, "MERGE", "p", 1), root=tmp_base),
                      names))
    hist = read_history(spark, tmp_base)
    assert hist.count() == 12
    assert sorted({r.table_name for r in hist.collect()}) == sorted(set(names))
    assert last_load(spark, "db.conc_1 x/y", root=tmp_base)["source_rows"] == 1
