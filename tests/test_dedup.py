import datetime as dt

from lakeloom.operators import latest_per_key, latest_value
from lakeloom.plans.loads import prepare
from lakeloom.spec import TableSpec

D = dt.datetime


def test_timestamp_beats_null_and_all_null_group_keeps_one(spark):
    df = spark.createDataFrame(
        [(1, None, "a"), (1, D(2024, 1, 1), "b"), (2, None, "c"), (2, None, "d")],
        "k long, ts timestamp_ntz, v string")
    out = {r.k: r.v for r in latest_per_key(df, ["k"], "ts").collect()}
    assert out[1] == "b" and out[2] in ("c", "d") and len(out) == 2


def test_equal_timestamps_resolved_by_tiebreak(spark):
    df = spark.createDataFrame([(1, D(2024, 1, 1), i) for i in range(20)],
                               "k long, ts timestamp_ntz, seq long").repartition(4)
    for _ in range(3):
        assert latest_per_key(df, ["k"], "ts", ["seq"]).first().seq == 19


def test_null_keys_form_one_group(spark):
    df = spark.createDataFrame([(None, D(2024, 1, 1)), (None, D(2024, 1, 2))],
                               "k long, ts timestamp_ntz")
    rows = latest_per_key(df, ["k"], "ts").collect()
    assert len(rows) == 1 and rows[0].ts == D(2024, 1, 2)


def test_date_timestamp_becomes_timestamp_ntz(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 2)), (1, dt.date(2024, 1, 3))],
                               "k long, d date")
    out = latest_per_key(df, ["k"], "d")
    assert out.schema["d"].dataType.typeName() == "timestamp_ntz"
    assert out.first().d == D(2024, 1, 3)


def test_no_timestamp_or_no_key_leaves_rows(spark):
    df = spark.createDataFrame([(1, 1), (1, 1)], "k long, v long")
    assert prepare(df, TableSpec(target="t", source="s", key=("k",))).count() == 2
    assert prepare(df, TableSpec(target="t", source="s", timestamp="v")).count() == 2
    assert prepare(df, TableSpec(target="t", source="s", key=("k",),
                                 dedup_without_timestamp=True)).count() == 1


def test_partial_window_limit_before_shuffle(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = latest_per_key(df, ["user_id", "event_type"], "ts")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_latest_value_drops_null_keys(spark):
    df = spark.createDataFrame([(None, 5.0, D(2024, 1, 1)), (1, 2.0, D(2024, 1, 1)),
                                (1, 3.0, D(2024, 1, 2))], "k long, p double, ts timestamp_ntz")
    rows = latest_value(df, "k", "p", "ts", alias="lp").collect()
    assert [(r.k, r.lp) for r in rows] == [(1, 3.0)]


def test_dedup_moves_before_transforms_only_when_legal(spark):
    df = spark.createDataFrame([(1, D(2024, 1, 1), "7"), (1, D(2024, 1, 2), "8")],
                               "k long, ts timestamp_ntz, c string")
    s = TableSpec(target="t", source="s", key=("k",), timestamp="ts",
                  transforms=("DERIVE_YMD", "CAST_COLUMNS"), cast_map={"c": "int"})
    out = prepare(df, s).collect()
    assert len(out) == 1 and out[0].c == 8 and out[0].date == dt.date(2024, 1, 2)
    # a transform that rewrites the timestamp keeps dedup after the transforms
    s2 = TableSpec(target="t", source="s", key=("k",), timestamp="ts",
                   transforms=("ALIAS_COLUMNS",), alias_columns={"c": "ts"})
    out2 = prepare(df.withColumn("c", df.ts.cast("string")), s2).collect()
    assert len(out2) == 1


def test_enrichment_runs_on_deduplicated_facts(spark):
    from lakeloom.sinks import overwrite_table
    from lakeloom.spec import LookupSpec
    overwrite_table(spark.createDataFrame([(1, 5.0, D(2024, 1, 1)), (1, 7.0, D(2024, 1, 3))],
                                          "shop_id long, price double, created date"), "dd_dim")
    facts = spark.createDataFrame([(1, D(2024, 1, 1), 2.0), (1, D(2024, 1, 2), 3.0),
                                   (None, D(2024, 1, 2), 4.0)],
                                  "shop_id long, ts timestamp_ntz, sales double")
    spec = TableSpec(target="t", source="s", key=("shop_id",), timestamp="ts",
                     transforms=("PRICE_REVENUE",),
                     lookup=LookupSpec("dd_dim", "shop_id", "price", "sales", "created"))
    out = prepare(facts, spec)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # the fact-side window sits below the join: one row per key enters it
    join_at, window_at = plan.find("Join LeftOuter"), plan.rfind("Window [row_number()")
    assert 0 <= join_at < window_at
    got = sorted(((r.shop_id, r.sales, r.price, r.revenue) for r in out.collect()), key=repr)
    assert got == sorted([(1, 3.0, 7.0, 21.0), (None, 4.0, 0.0, 0.0)], key=repr)


def test_ties_resolve_by_row_content(spark):
    from lakeloom.operators.dedup import exact_duplicates_removed
    rows = [(1, D(2024, 1, 1), "a", {"x": 1}), (1, D(2024, 1, 1), "c", {"y": 2}),
            (1, D(2024, 1, 1), "b", {})]
    schema = "k long, ts timestamp_ntz, v string, m map<string,int>"
    for perm in ([0, 1, 2], [2, 1, 0], [1, 0, 2]):
        df = spark.createDataFrame([rows[i] for i in perm], schema).repartition(3)
        assert [r.v for r in latest_per_key(df, ["k"], "ts").collect()] == ["c"]
        assert [r.v for r in exact_duplicates_removed(df, ["k"]).collect()] == ["c"]
