"""A write that dies at any catalog call, then runs again, loses nothing."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import types as T

from lakeloom.plans import runner
from lakeloom.sinks import upsert_table
from lakeloom.sinks.tables import prune_versions
from lakeloom.spec import TableSpec

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                       T.StructField("v", T.StringType()), T.StructField("date", T.StringType())])


def rows(n, day, v, date=None):
    return [(k, dt.datetime(2024, 1, day), v, date or f"d{k % 3}") for k in range(n)]


class Crash(Exception):
    pass


def failing_sql(monkeypatch, spark, at):
    """Make the ``at``-th catalog change fail; returns the calls seen."""
    seen = []
    real = type(spark).sql

    def sql(self, text, *a, **kw):
        if text.lstrip().upper().startswith(("ALTER", "DROP", "CREATE TABLE")):
            seen.append(text)
            if len(seen) == at:
                raise Crash(text)
        return real(self, text, *a, **kw)

    monkeypatch.setattr(type(spark), "sql", sql)
    return seen


@pytest.mark.parametrize("parts", [None, ["date"]])
@pytest.mark.parametrize("scope", ["full", "auto"])
@pytest.mark.parametrize("at", range(1, 8))
def test_failed_swap_then_retry(spark, monkeypatch, parts, scope, at):
    name = f"crash_{uuid.uuid4().hex[:8]}"
    upsert_table(spark.createDataFrame(rows(12, 1, "old"), SCHEMA), name, ["k"], "ts", partition_cols=parts)
    # keys 0..5 get newer rows, some of them in another partition; 12, 13 are new
    new = rows(6, 2, "new", "d1") + [(12, dt.datetime(2024, 1, 2), "new", "d9"), (13, dt.datetime(2024, 1, 2), "new", "d1")]
    batch = spark.createDataFrame(new, SCHEMA)
    with monkeypatch.context() as m:
        failing_sql(m, spark, at)
        try:
            upsert_table(batch, name, ["k"], "ts", ">", partition_cols=parts, scope=scope)
        except Crash:
            pass
    upsert_table(batch, name, ["k"], "ts", ">", partition_cols=parts, scope=scope)
    got = sorted((r.k, r.v, r.date) for r in spark.table(name).collect())
    want = sorted([(k, "old", f"d{k % 3}") for k in range(6, 12)] + [(r[0], r[2], r[3]) for r in new])
    assert got == want
    left = [r.tableName for r in spark.sql(f"SHOW TABLES LIKE '{name}*'").collect()]
    assert left == [name]


def test_foreign_tables_are_left_alone(spark):
    name = f"foreign_{uuid.uuid4().hex[:8]}"
    spark.createDataFrame(rows(5, 1, "theirs"), SCHEMA).write.format("orc").saveAsTable(name)
    with pytest.raises(ValueError, match="did not create"):
        upsert_table(spark.createDataFrame(rows(2, 2, "ours"), SCHEMA), name, ["k"], "ts")
    assert {r.v for r in spark.table(name).collect()} == {"theirs"} and spark.table(name).count() == 5


def test_prune_keeps_every_registered_location(spark):
    name = f"prune_{uuid.uuid4().hex[:8]}"
    upsert_table(spark.createDataFrame(rows(9, 1, "a"), SCHEMA), name, ["k"], "ts", partition_cols=["date"])
    for day in (2, 3, 4):
        upsert_table(spark.createDataFrame([(0, dt.datetime(2024, 1, day), f"v{day}", "d0")], SCHEMA), name, ["k"], "ts")
    gone = prune_versions(spark, name, keep=0)
    assert len(gone) == 2                       # the folders of days 2 and 3
    spark.catalog.refreshTable(name)
    got = {r.k: r.v for r in spark.table(name).collect()}
    assert got == {0: "v4"} | {k: "a" for k in range(1, 9)}


def spec(target, source, lookup=None):
    return TableSpec(target=target, source=source, load_type="FULL", key=("k",), timestamp="ts")


def test_faulty_configurations_do_not_stop_the_run(spark, monkeypatch):
    order = []

    def load(_, s):
        order.append(s.target)
        if s.target == "dim":
            raise RuntimeError("no dim today")
        return type("R", (), dict(source_rows=1, inserted=0, updated=0, skipped_files=0, partitions_rewritten=None))

    monkeypatch.setattr(runner, "load_table", load)
    report = {(r.table_name, r.status, r.error) for r in runner.run_loads(spark, [
        spec("clean", "raw"), spec("raw", "landing"), spec("twice", "x"), spec("twice", "y"),
        spec("a", "b"), spec("b", "a"), spec("dim", "elsewhere"), spec("fact", "dim")]).collect()}
    status = {(t, s) for t, s, _ in report}
    assert {("raw", "SUCCESS"), ("clean", "SUCCESS"), ("twice", "FAILED"), ("a", "FAILED"), ("b", "FAILED"),
            ("dim", "FAILED"), ("fact", "FAILED")} == status
    assert order.index("raw") < order.index("clean") and "fact" not in order
    assert any(t == "fact" and "skipped: dim" in e for t, _, e in report)
