"""Registered queries: one per operator / flow of the inventory.

Each builder takes ``(spark, sf_dir)``, reads the generated tables under
``sf_dir`` (whole tables, no row caps), and returns a DataFrame whose columns
match the DuckDB statement of the same key in
:mod:`lakeloom.workloads.oracle`. Builders that exercise a sink or a landing
folder first stage the data they need *with Spark* under a fresh folder of
``spark.checkpoint.dir`` and return the table read back.

Stand-ins (the generated tables are not the reference's tables):
fact = ``events`` (user_id -> shop_id, value -> daily_sales, ts ->
created_at); price lookup = ``orders`` (o_custkey -> shop_id, null for every
third customer, whose facts stay unmatched; o_totalprice -> price, o_orderdate
-> creation_timestamp); dirty keys =
``lineitem`` by (l_orderkey, l_linenumber); snapshot = ``customer``;
no-timestamp table = ``nation``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions.transforms import alias_columns, apply_transforms, cast_columns, derive_ymd, \
    register_transform
from lakeloom.operators.dedup import latest_per_key, latest_value
from lakeloom.operators.enrich import price_revenue
from lakeloom.operators.upsert import action_counts, guarded_upsert
from lakeloom.operators.watermark import (
    after_date_watermark,
    after_watermark,
    high_watermark,
    watermark_frame,
)
from lakeloom.plans.loads import load_clean_full, load_clean_incremental, load_raw_full, \
    load_raw_incremental, prepare
from lakeloom.plans.runner import outcome_counts, run_loads
from lakeloom.session import scratch_path
from lakeloom.sinks.history import latest_entries, table_history
from lakeloom.sinks.tables import overwrite_table, upsert_table
from lakeloom.sinks.versions import read_version, restore, versions
from lakeloom.sources.landing import read_full_snapshot, read_incremental, read_landing_folders
from lakeloom.sources.tables import read_table
from lakeloom.spec import FULL, INCREMENTAL, YMD_COLUMNS, LookupSpec, TableSpec
from lakeloom.streaming.file_stream import start_landing_stream

EVENT_COLS = ("event_id", "ts", "user_id", "event_type", "value", "props")
EVENT_KEY = ("user_id", "event_type")
# The "previous load" boundary and the start of the overlapping new batch.
SPLIT_TS = "2024-01-20 00:00:00"
BATCH_TS = "2024-01-19 00:00:00"

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])
CUSTOMER_SCHEMA = T.StructType([
    T.StructField("c_custkey", T.LongType()),
    T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()),
    T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_mktsegment", T.StringType()),
])
LINEITEM_TIEBREAK = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
                     "l_tax", "l_returnflag", "l_linestatus")


# --------------------------------------------------------------------------- inputs
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_inputs(spark: SparkSession, sf_dir: str, names=("events", "orders")) -> None:
    """Expose generated tables as session views so loads read them by name."""
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)


def _uniq(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a daily-sales fact."""
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").alias("created_at"), F.col("user_id").alias("shop_id"),
        "event_type", F.col("value").alias("daily_sales"))


def price_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as the listing dimension holding a price per shop; every third
    customer's key is NULL, so that shops without a price exist."""
    return (table(spark, sf_dir, "orders")
            .select("o_orderkey", F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey")).alias("shop_id"),
                    F.col("o_totalprice").alias("price"),
                    F.col("o_orderdate").alias("creation_timestamp")))


LOOKUP = LookupSpec(table="", key="shop_id", price_col="price", sales_col="daily_sales",
                    order_col="creation_timestamp", tiebreak=("o_orderkey",))


def _hour_parts(ts: Column) -> dict[str, Column]:
    return {"y": F.year(ts), "m": F.month(ts), "d": F.dayofmonth(ts), "h": F.hour(ts)}


def stage_landing(df: DataFrame, base: str, ts_col: str, one_file_per_folder: bool = False,
                  mode: str = "append") -> None:
    """Write ``df`` into hour folders ``{base}/y=../m=../d=../h=../`` (one
    Spark job). Folder names are unpadded numbers, which the landing reader
    orders numerically."""
    parts = _hour_parts(F.col(ts_col))
    staged = df.withColumns(parts)
    if one_file_per_folder:
        staged = staged.repartition(*[F.col(c) for c in parts])
    staged.write.mode(mode).partitionBy(*parts).parquet(base)


def _nullify_user(df: DataFrame) -> DataFrame:
    """Make NULL business keys: every tenth user id becomes NULL."""
    return df.withColumn("user_id", F.when(F.col("user_id") % 10 != 0, F.col("user_id")))


def _upsert_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    ev = table(spark, sf_dir, "events")
    t = latest_per_key(ev.filter(F.col("ts") < F.lit(SPLIT_TS).cast("timestamp_ntz")),
                       EVENT_KEY, "ts", ["event_id"])
    s = latest_per_key(ev.filter(F.col("ts") >= F.lit(BATCH_TS).cast("timestamp_ntz")),
                       EVENT_KEY, "ts", ["event_id"])
    return _nullify_user(t), _nullify_user(s)


# --------------------------------------------------------------------------- queries
def q_scan_projection(spark, sf_dir):
    register_inputs(spark, sf_dir, ("events",))
    return read_table(spark, "events", ["event_id", "ts", "user_id", "event_type", "value"])


def q_schema_enforced_read(spark, sf_dir):
    schema = T.StructType([
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.DecimalType(20, 0)),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("channel", T.StringType()),
    ])
    return read_landing_folders(spark, [f"{sf_dir.rstrip('/')}/events.parquet"], schema)


def q_landing_latest_folders(spark, sf_dir):
    base = scratch_path(spark, "landing-latest")
    stage_landing(table(spark, sf_dir, "events"), base, "ts", one_file_per_folder=True)
    return read_incremental(spark, base, EVENTS_SCHEMA, 2)


def q_landing_full_snapshot(spark, sf_dir):
    base = scratch_path(spark, "landing-full")
    stage_landing(table(spark, sf_dir, "events"), base, "ts", one_file_per_folder=True)
    return read_full_snapshot(spark, base, EVENTS_SCHEMA, "latest_file")


def q_landing_corrupt_tolerance(spark, sf_dir):
    junk = scratch_path(spark, "landing-junk")
    # a folder of text files that are not Parquet at all
    table(spark, sf_dir, "nation").select(F.col("n_name").alias("value")).write.text(junk)
    good = f"{sf_dir.rstrip('/')}/events.parquet"
    return read_landing_folders(spark, [good, junk], EVENTS_SCHEMA, ignore_corrupt_files=True,
                                only_parquet_suffix=False)


def q_cast_columns(spark, sf_dir):
    spec = TableSpec(target="cast", source="orders", cast_map={
        "o_custkey": "int", "o_orderpriority": "int", "no_such_column": "long"})
    return cast_columns(table(spark, sf_dir, "orders"), spec)


def q_alias_columns(spark, sf_dir):
    spec = TableSpec(target="alias", source="orders", alias_columns=(
        ("o_orderkey", "o_custkey"), ("o_totalprice", "price"), ("price", "list_price")))
    return alias_columns(table(spark, sf_dir, "orders"), spec)


def q_derive_ymd(spark, sf_dir):
    spec = TableSpec(target="ymd", source="events", timestamp="ts")
    return derive_ymd(table(spark, sf_dir, "events"), spec)


def q_transform_chain(spark, sf_dir):
    spec = TableSpec(target="chain", source="orders", partition_timestamp="o_orderdate",
                     transforms=("DERIVE_YMD", "CAST_COLUMNS", "ALIAS_COLUMNS"),
                     cast_map={"o_custkey": "int"}, alias_columns={"o_orderdate": "order_ts"})
    return apply_transforms(table(spark, sf_dir, "orders"), spec)


def q_dedup_latest(spark, sf_dir):
    return latest_per_key(table(spark, sf_dir, "events"), EVENT_KEY, "ts", ["event_id"])


def q_dedup_no_timestamp(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    spec = TableSpec(target="nation", source="nation", key=("n_nationkey",))
    return prepare(n.unionByName(n), spec)


def q_dedup_exact_copies(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    spec = TableSpec(target="nation", source="nation", key=("n_nationkey",),
                     dedup_without_timestamp=True)
    return prepare(n.unionByName(n), spec)


def q_dedup_date_timestamp(spark, sf_dir):
    """A date used as the dedup timestamp is ranked (and kept) as a
    timestamp without time zone: the newest order of each customer."""
    spec = TableSpec(target="latest_order", source="orders", key=("o_custkey",),
                     timestamp="o_orderdate", tiebreak=("o_orderkey",))
    return prepare(table(spark, sf_dir, "orders"), spec)


def q_latest_price(spark, sf_dir):
    return latest_value(table(spark, sf_dir, "orders"), "o_custkey", "o_totalprice",
                        "o_orderdate", ["o_orderkey"], alias="listing_price")


def q_dedup_dirty_keys(spark, sf_dir):
    return latest_per_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"],
                          "l_shipdate", LINEITEM_TIEBREAK)


def q_price_revenue(spark, sf_dir):
    fact = table(spark, sf_dir, "events").select(
        "event_id", "ts", F.col("user_id").alias("shop_id"), "event_type",
        F.col("value").alias("daily_sales"), "props")
    return price_revenue(fact, price_lookup(spark, sf_dir), LOOKUP)


def q_watermark_max(spark, sf_dir):
    loaded = table(spark, sf_dir, "events").filter(F.col("ts") < F.lit(SPLIT_TS).cast("timestamp_ntz"))
    return watermark_frame(loaded, "ts")


def q_incremental_filter(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    wm = high_watermark(ev.filter(F.col("ts") < F.lit(SPLIT_TS).cast("timestamp_ntz")), "ts")
    return after_watermark(ev, "ts", wm)


def q_incremental_filter_pruned(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    raw = _uniq("raw_events_by_date")
    spec = TableSpec(target=raw, source="events", timestamp="ts")
    overwrite_table(derive_ymd(ev, spec), raw, partition_cols=YMD_COLUMNS)
    wm = high_watermark(ev.filter(F.col("ts") < F.lit(SPLIT_TS).cast("timestamp_ntz")), "ts")
    return after_watermark(spark.table(raw), "ts", wm, prune_col="date").select(*EVENT_COLS)


def q_date_watermark_filter(spark, sf_dir):
    """rows whose date partition is after the last loaded date; the
    predicate is on the partition column, so whole partitions are skipped."""
    ev = table(spark, sf_dir, "events")
    raw = _uniq("raw_events_by_day")
    spec = TableSpec(target=raw, source="events", timestamp="ts")
    overwrite_table(derive_ymd(ev, spec), raw, partition_cols=YMD_COLUMNS)
    loaded = spark.table(raw).filter(F.col("ts") < F.lit(SPLIT_TS).cast("timestamp_ntz"))
    wm = high_watermark(loaded, "date")
    return after_date_watermark(spark.table(raw), "date", wm).select(*EVENT_COLS, "date")


def q_upsert_gt(spark, sf_dir):
    t, s = _upsert_sides(spark, sf_dir)
    return guarded_upsert(t, s, EVENT_KEY, "ts", ">")


def q_upsert_ge(spark, sf_dir):
    t, s = _upsert_sides(spark, sf_dir)
    return guarded_upsert(t, s, EVENT_KEY, "ts", ">=")


def q_upsert_metrics(spark, sf_dir):
    return action_counts(q_upsert_gt(spark, sf_dir))


def q_latest_load_history(spark, sf_dir):
    hist = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("table_name"), F.col("o_orderdate").alias("ts"),
        F.col("o_orderstatus").alias("operation"), F.col("o_orderkey").alias("load_id"),
        F.col("o_totalprice").alias("rows_written"))
    return latest_entries(hist, tiebreak=("load_id",))


def q_create_on_missing(spark, sf_dir):
    name = _uniq("created_events")
    src = latest_per_key(table(spark, sf_dir, "events"), EVENT_KEY, "ts", ["event_id"])
    upsert_table(src, name, EVENT_KEY, "ts", ">")
    return spark.table(name)


def q_full_overwrite_partitioned(spark, sf_dir):
    name = _uniq("overwritten")
    overwrite_table(table(spark, sf_dir, "orders"), name)        # a different schema first
    spec = TableSpec(target=name, source="events", timestamp="ts")
    overwrite_table(derive_ymd(table(spark, sf_dir, "events"), spec), name,
                    partition_cols=YMD_COLUMNS)
    return spark.table(name)


def _events_raw_spec(target: str, base: str) -> TableSpec:
    return TableSpec(target=target, source="events_landing", load_type=INCREMENTAL,
                     category="FACT", schema=EVENTS_SCHEMA, key=EVENT_KEY, timestamp="ts",
                     partition_timestamp="ts", partition_cols=YMD_COLUMNS,
                     transforms=("DERIVE_YMD",), tiebreak=("event_id",), update_op=">=",
                     landing_base=base)


def q_raw_incremental_e2e(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    base = scratch_path(spark, "landing-raw")
    spec = _events_raw_spec(_uniq("raw_events"), base)
    split = F.lit(SPLIT_TS).cast("timestamp_ntz")
    stage_landing(ev.filter(F.col("ts") < split), f"{base}/events_landing", "ts",
                  one_file_per_folder=True)
    load_raw_incremental(spark, spec, n_folders=None)             # backfill: every folder
    stage_landing(ev.filter(F.col("ts") >= split), f"{base}/events_landing", "ts",
                  one_file_per_folder=True)
    load_raw_incremental(spark, spec, n_folders=2)                # every hour since the backfill
    return spark.table(spec.target)


def q_raw_full_e2e(spark, sf_dir):
    cust = table(spark, sf_dir, "customer")
    base = scratch_path(spark, "landing-snap")
    at = {"y": F.lit(2024), "m": F.lit(1), "d": F.lit(2)}
    # an older snapshot (hour 9, balances zeroed) and the newest one (hour 10)
    (cust.withColumn("c_acctbal", F.lit(0.0)).withColumns({**at, "h": F.lit(9)})
     .write.partitionBy("y", "m", "d", "h").parquet(f"{base}/customer"))
    (cust.withColumns({**at, "h": F.lit(10)})
     .write.mode("append").partitionBy("y", "m", "d", "h").parquet(f"{base}/customer"))
    spec = TableSpec(target=_uniq("raw_customer"), source="customer", load_type=FULL,
                     schema=CUSTOMER_SCHEMA, key=("c_custkey",), transforms=("CAST_COLUMNS",),
                     cast_map={"c_nationkey": "long"}, landing_base=base,
                     snapshot_mode="latest_folder")
    load_raw_full(spark, spec)
    return spark.table(spec.target)


def q_clean_incremental_e2e(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    raw = _uniq("raw_events")
    ymd = TableSpec(target=raw, source="events", timestamp="ts")
    overwrite_table(derive_ymd(ev.filter(F.col("ts") < F.lit(SPLIT_TS).cast("timestamp_ntz")), ymd),
                    raw, partition_cols=YMD_COLUMNS)
    spec = TableSpec(target=_uniq("clean_events"), source=raw, load_type=INCREMENTAL,
                     category="FACT", columns=EVENT_COLS, key=EVENT_KEY, timestamp="ts",
                     partition_timestamp="ts", partition_cols=YMD_COLUMNS,
                     transforms=("DERIVE_YMD",), tiebreak=("event_id",), update_op=">",
                     prune_partition_col="date")
    load_clean_incremental(spark, spec)                           # creates the target
    overwrite_table(derive_ymd(ev, ymd), raw, partition_cols=YMD_COLUMNS)   # raw grows
    load_clean_incremental(spark, spec)                           # rows after the watermark
    return spark.table(spec.target)


def _fact_spec(target: str, source: str, lookup: str, load_type: str) -> TableSpec:
    return TableSpec(target=target, source=source, load_type=load_type, category="FACT",
                     columns=("event_id", "created_at", "shop_id", "event_type", "daily_sales"),
                     key=("shop_id", "event_type"), timestamp="created_at",
                     partition_cols=YMD_COLUMNS, transforms=("DERIVE_YMD", "PRICE_REVENUE"),
                     lookup=LookupSpec(lookup, "shop_id", "price", "daily_sales",
                                       "creation_timestamp", ("o_orderkey",)),
                     tiebreak=("event_id",))


def q_clean_incremental_enriched(spark, sf_dir):
    """R1c with J3: the rows after the watermark get their price and revenue
    and are merged into the fact table."""
    raw_fact, dim = _uniq("raw_fact"), _uniq("dim_listing")
    ev = facts(spark, sf_dir)
    overwrite_table(price_lookup(spark, sf_dir), dim)
    spec = _fact_spec(_uniq("fact_sales"), raw_fact, dim, INCREMENTAL)
    overwrite_table(ev.filter(F.col("created_at") < F.lit(SPLIT_TS).cast("timestamp_ntz")), raw_fact)
    load_clean_incremental(spark, spec)
    overwrite_table(ev, raw_fact)
    load_clean_incremental(spark, spec)
    return spark.table(spec.target)


def q_load_history(spark, sf_dir):
    """M5: two loads record themselves; their entries read back."""
    ev, raw = table(spark, sf_dir, "events"), _uniq("raw_events")
    spec = TableSpec(target=_uniq("recorded_events"), source=raw, load_type=INCREMENTAL,
                     columns=EVENT_COLS, key=EVENT_KEY, timestamp="ts", tiebreak=("event_id",))
    overwrite_table(ev.filter(F.col("ts") < F.lit(SPLIT_TS).cast("timestamp_ntz")), raw)
    load_clean_incremental(spark, spec)
    overwrite_table(ev, raw)
    load_clean_incremental(spark, spec)
    return table_history(spark, spec.target).select("operation", "source_rows", "inserted", "updated", "deleted")


def q_run_two_hops(spark, sf_dir):
    """R2: a clean table and the raw table it reads, in one run."""
    base = scratch_path(spark, "landing-hops")
    stage_landing(table(spark, sf_dir, "events"), f"{base}/events_landing", "ts", one_file_per_folder=True)
    raw = _events_raw_spec(_uniq("raw_events"), base).with_(n_folders=None)
    clean = TableSpec(target=_uniq("clean_events"), source=raw.target, load_type=INCREMENTAL,
                      category="FACT", columns=EVENT_COLS, key=EVENT_KEY, timestamp="ts",
                      partition_cols=YMD_COLUMNS, transforms=("DERIVE_YMD",), tiebreak=("event_id",))
    run_loads(spark, [clean, raw])
    return spark.table(clean.target)


def q_landing_missing_base(spark, sf_dir):
    """A landing base that does not exist fails its own table only; an
    hour folder without a Parquet file counts as a folder and adds no row."""
    base = scratch_path(spark, "landing-missing")
    stage_landing(table(spark, sf_dir, "events"), f"{base}/events_landing", "ts", one_file_per_folder=True)
    (table(spark, sf_dir, "nation").select(F.col("n_name").alias("value"))
     .write.text(f"{base}/events_landing/y=2100/m=1/d=1/h=0"))
    names = {"present": _uniq("landing_present"), "missing": _uniq("landing_missing")}
    report = run_loads(spark, [_events_raw_spec(names["present"], base),
                               _events_raw_spec(names["missing"], f"{base}/nowhere")])
    return _renamed(report, names).select("table_name", "status", "row_count")


def q_custom_transform(spark, sf_dir):
    """A transform that a user registers."""
    register_transform("FLAG_HIGH_VALUE", lambda df, spec: df.withColumn("high_value", F.col("value") > 50),
                       lambda spec: {"high_value"})
    spec = TableSpec(target="flagged", source="events", key=EVENT_KEY, timestamp="ts",
                     transforms=("FLAG_HIGH_VALUE",), tiebreak=("event_id",))
    return prepare(table(spark, sf_dir, "events"), spec)


def _renamed(report: DataFrame, names: dict[str, str]) -> DataFrame:
    """The report under fixed table names."""
    name = F.col("table_name")
    for fixed, own in names.items():
        name = F.when(F.col("table_name") == own, fixed).otherwise(name)
    return report.withColumn("table_name", name)


def q_clean_full_e2e(spark, sf_dir):
    raw_fact, dim = _uniq("raw_fact"), _uniq("dim_listing")
    overwrite_table(facts(spark, sf_dir), raw_fact)
    overwrite_table(price_lookup(spark, sf_dir), dim)
    spec = _fact_spec(_uniq("fact_sales"), raw_fact, dim, FULL)
    load_clean_full(spark, spec)
    return spark.table(spec.target)


def _late(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Events of the first load, of later hours, and those whose files arrive
    last although their hours are old."""
    ev = table(spark, sf_dir, "events")
    old, late = F.col("ts") < F.lit(SPLIT_TS).cast("timestamp_ntz"), F.col("event_id") % 7 == 3
    return ev.filter(old & ~late), ev.filter(~old), ev.filter(old & late)


def q_landing_late_files(spark, sf_dir):
    """L3: files that arrive in hour folders older than the newest one loaded
    are loaded, each once; a last load finds nothing."""
    first, later, late = _late(spark, sf_dir)
    base = scratch_path(spark, "landing-late")
    spec = _events_raw_spec(_uniq("late_events"), base)
    stage_landing(first, f"{base}/events_landing", "ts", one_file_per_folder=True)
    load_raw_incremental(spark, spec, n_folders=None)
    stage_landing(late, f"{base}/events_landing", "ts", one_file_per_folder=True)
    stage_landing(later, f"{base}/events_landing", "ts", one_file_per_folder=True)
    load_raw_incremental(spark, spec, n_folders=2)
    again = load_raw_incremental(spark, spec, n_folders=2)
    return spark.table(spec.target).withColumn("rows_read_again", F.lit(again.source_rows).cast("long"))


def q_clean_arrival_watermark(spark, sf_dir):
    """F1 by arrival: a third batch, older than the clean table's newest row,
    reaches it because raw rows carry the number of the load that wrote them."""
    base = scratch_path(spark, "landing-arrival")
    raw = _events_raw_spec(_uniq("arrival_raw"), base).with_(load_col="load_no", n_folders=None)
    clean = TableSpec(target=_uniq("arrival_clean"), source=raw.target, load_type=INCREMENTAL, category="FACT",
                      columns=EVENT_COLS, key=EVENT_KEY, timestamp="ts", partition_cols=YMD_COLUMNS,
                      transforms=("DERIVE_YMD",), tiebreak=("event_id",), arrival_col="load_no")
    for batch in _late(spark, sf_dir):
        stage_landing(batch, f"{base}/events_landing", "ts", one_file_per_folder=True)
        load_raw_incremental(spark, raw)
        load_clean_incremental(spark, clean)
    return spark.table(clean.target)


def q_landing_snapshot_complete(spark, sf_dir):
    """L4: the newest folder holds a part of an export that has not finished
    (no ``_SUCCESS``); the finished snapshot before it is read."""
    cust = table(spark, sf_dir, "customer")
    base = scratch_path(spark, "landing-unfinished")
    cust.withColumn("c_acctbal", F.lit(0.0)).write.parquet(f"{base}/customer/2024/1/2/9")
    cust.write.parquet(f"{base}/customer/2024/1/2/10")
    (cust.filter(F.col("c_custkey") % 10 == 0).write
     .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{base}/customer/2024/1/2/11"))
    spec = TableSpec(target=_uniq("finished_customer"), source="customer", load_type=FULL, schema=CUSTOMER_SCHEMA,
                     key=("c_custkey",), landing_base=base, snapshot_mode="latest_folder")
    load_raw_full(spark, spec)
    return spark.table(spec.target)


def _drained(query) -> None:
    query.awaitTermination()
    if query.exception():
        raise RuntimeError(str(query.exception()))


def q_stream_redelivery(spark, sf_dir):
    """ST1 with keyed state: every file is delivered again and new ones with
    it; then everything once more, which rewrites no partition."""
    first, later, late = _late(spark, sf_dir)
    base = scratch_path(spark, "landing-redelivery")
    spec = _events_raw_spec(_uniq("redelivered_events"), base)
    for batch in (first.unionByName(late), first.unionByName(late).unionByName(later)):
        stage_landing(batch, f"{base}/events_landing", "ts", one_file_per_folder=True)
        _drained(start_landing_stream(spark, spec, drop_replays=True))
    stage_landing(later.unionByName(first), f"{base}/events_landing", "ts", one_file_per_folder=True)
    _drained(start_landing_stream(spark, spec, drop_replays=True))
    last = table_history(spark, spec.target).limit(1).select(F.col("partitions_rewritten").alias("replay_rewrote"))
    return spark.table(spec.target).crossJoin(last)


def q_stream_restart(spark, sf_dir):
    """ST1: a stream that starts over with a fresh checkpoint at the same place
    loads the files that came meanwhile."""
    first, later, late = _late(spark, sf_dir)
    base = scratch_path(spark, "landing-restart")
    spec = _events_raw_spec(_uniq("restarted_events"), base)
    checkpoint = scratch_path(spark, "restart-checkpoint")
    stage_landing(first, f"{base}/events_landing", "ts", one_file_per_folder=True)
    _drained(start_landing_stream(spark, spec, checkpoint=checkpoint, max_files_per_trigger=200, record=False))
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(checkpoint)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    stage_landing(later.unionByName(late), f"{base}/events_landing", "ts", one_file_per_folder=True)
    _drained(start_landing_stream(spark, spec, checkpoint=checkpoint, record=False))
    return spark.table(spec.target)


def _report_specs(ok: str) -> list[TableSpec]:
    return [
        TableSpec(target=ok, source="events", load_type=FULL, category="FACT", columns=EVENT_COLS,
                  key=EVENT_KEY, timestamp="ts", tiebreak=("event_id",)),
        TableSpec(target="report_disabled", source="events", enabled=False),
        TableSpec(target="report_missing_source", source="no_such_table_anywhere"),
        TableSpec(target="report_bad_type", source="events", load_type="DELTA"),
    ]


def q_run_outcomes(spark, sf_dir):
    """A3: tables loaded / succeeded / failed in one run. One table per
    region; a region without nations has no source."""
    nations, made = table(spark, sf_dir, "nation"), _uniq("outcome")
    keys = [r[0] for r in table(spark, sf_dir, "region").select("r_regionkey").collect()]
    for k in (r[0] for r in nations.select("n_regionkey").distinct().collect()):
        nations.filter(F.col("n_regionkey") == k).createOrReplaceTempView(f"{made}_nations_{k}")
    specs = [TableSpec(target=f"{made}_{k}", source=f"{made}_nations_{k}", load_type=FULL) for k in keys]
    return outcome_counts(run_loads(spark, [*specs, *_report_specs("")[2:]]))


def q_run_report(spark, sf_dir):
    register_inputs(spark, sf_dir, ("events",))
    names = {"report_events_latest": _uniq("report_events")}
    report = run_loads(spark, _report_specs(names["report_events_latest"]), max_workers=2)
    return _renamed(report, names).select("table_name", "status", "row_count", "load_type", "category")


def q_stream_upsert(spark, sf_dir):
    base = scratch_path(spark, "landing-stream")
    stage_landing(table(spark, sf_dir, "events"), f"{base}/events_landing", "ts",
                  one_file_per_folder=True)
    spec = _events_raw_spec(_uniq("stream_events"), base)
    q = start_landing_stream(spark, spec, max_files_per_trigger=250, record=False)
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    return spark.table(spec.target)


def q_upsert_fixed_partition(spark, sf_dir):
    """Upsert into a target partitioned by order year, which never changes
    for an order: only the batch's own year partitions are read and
    rewritten, and the target is not scanned to locate its keys."""
    orders = table(spark, sf_dir, "orders").withColumn("o_year", F.year("o_orderdate"))
    cut = F.lit("1998-01-01").cast("date")
    name = _uniq("orders_by_year")
    base = orders.filter(F.col("o_orderdate") < cut).withColumn(
        "version_ts", F.col("o_orderdate").cast("timestamp_ntz"))
    upsert_table(base, name, ["o_orderkey"], "version_ts", ">", partition_cols=["o_year"])
    # open orders re-delivered a month later with a new price, plus new 1998 orders
    batch = (orders.filter((F.col("o_orderstatus") == "O") | (F.col("o_orderdate") >= cut))
             .withColumn("o_totalprice", F.col("o_totalprice") * 1.1)
             .withColumn("version_ts", F.date_add("o_orderdate", 30).cast("timestamp_ntz")))
    upsert_table(batch, name, ["o_orderkey"], "version_ts", ">", partition_cols=["o_year"],
                 scope="batch")
    return spark.table(name)


def q_upsert_key_index(spark, sf_dir):
    """J2/M2 with the key locator: re-priced orders of two customers' years
    and new ones; only partitions that can hold their keys are looked at."""
    orders = table(spark, sf_dir, "orders").withColumn("o_year", F.year("o_orderdate")) \
        .withColumn("version_ts", F.col("o_orderdate").cast("timestamp_ntz"))
    name = _uniq("orders_indexed")
    old = F.col("o_orderdate") < F.lit("1998-01-01").cast("date")
    upsert_table(orders.filter(old), name, ["o_orderkey"], "version_ts", ">", partition_cols=["o_year"], key_index=True)
    batch = (orders.filter(~old | ((F.col("o_orderkey") % 50 == 1) & F.col("o_year").isin(1994, 1996)))
             .withColumn("o_totalprice", F.col("o_totalprice") * 2)
             .withColumn("version_ts", F.col("version_ts") + F.expr("INTERVAL 1 DAY")))
    for part in (F.col("o_year") == 1994, F.col("o_year") != 1994):
        upsert_table(batch.filter(part), name, ["o_orderkey"], "version_ts", ">", partition_cols=["o_year"],
                     key_index=True)
    return spark.table(name)


def q_upsert_hash_ranges(spark, sf_dir):
    """M1/M2 into a table without partition columns, laid out in ranges of the
    key's hash behind a stable view: re-priced and new orders, then the same
    batch in more ranges, then late rows that the guard keeps out."""
    orders = table(spark, sf_dir, "orders").withColumn("version_ts", F.col("o_orderdate").cast("timestamp_ntz"))
    name = _uniq("orders_ranges")
    old = F.col("o_orderdate") < F.lit("1998-01-01").cast("date")
    upsert_table(orders.filter(old), name, ["o_orderkey"], "version_ts", ">", hash_ranges=16)
    batch = (orders.filter(~old | (F.col("o_orderkey") % 50 == 1))
             .withColumn("o_totalprice", F.col("o_totalprice") * 2)
             .withColumn("version_ts", F.col("version_ts") + F.expr("INTERVAL 1 DAY")))
    upsert_table(batch.filter(old), name, ["o_orderkey"], "version_ts", ">")
    upsert_table(batch.filter(~old), name, ["o_orderkey"], "version_ts", ">", hash_ranges=32)
    upsert_table(orders.withColumn("o_totalprice", F.lit(0.0).cast(orders.schema["o_totalprice"].dataType)), name,
                 ["o_orderkey"], "version_ts", ">")
    return spark.table(name)


def q_stable_view_switch(spark, sf_dir):
    """M4/M6 behind a stable view: replaced with another schema, then merged
    by date partition."""
    name = _uniq("events_view")
    overwrite_table(table(spark, sf_dir, "orders"), name, stable_view=True)      # a different schema first
    ev = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    latest = latest_per_key(ev, ["user_id"], "ts", ["event_id"])
    overwrite_table(latest.filter(F.col("user_id") % 3 != 0), name, partition_cols=["day"])
    upsert_table(latest.filter(F.col("user_id") % 3 == 0), name, ["user_id"], "ts", ">", partition_cols=["day"])
    return spark.table(name)


def q_landing_schema_drift(spark, sf_dir):
    """The newest hour also holds a file whose ``user_id`` became text.
    With ``exclude`` the load skips that file and reports it; with ``error``
    the load fails; neither loses rows silently."""
    ev = table(spark, sf_dir, "events")
    base = scratch_path(spark, "landing-drift")
    stage_landing(ev, f"{base}/events_landing", "ts", one_file_per_folder=True)
    newest = ev.agg(F.max(F.date_trunc("hour", "ts")).alias("h"))
    drifted = (ev.join(newest, F.date_trunc("hour", ev["ts"]) == newest["h"], "left_semi")
               .withColumn("user_id", F.col("user_id").cast("string")))
    stage_landing(drifted, f"{base}/events_landing", "ts", one_file_per_folder=True)
    names = {"drift_excluded": _uniq("drift_excluded"), "drift_fatal": _uniq("drift_fatal")}
    specs = [_events_raw_spec(names[name], base).with_(schema_drift=mode)
             for name, mode in (("drift_excluded", "exclude"), ("drift_fatal", "error"))]
    report = _renamed(run_loads(spark, specs, max_workers=2), names)
    return report.select("table_name", "status", "row_count", "skipped_files")


def q_landing_schema_widen(spark, sf_dir):
    """D10 with ``widen``: the first hours hold ``user_id`` as int and ``value``
    as float, later ones as long and double; both load whole, and the target's
    columns become wider without rewriting its older partitions."""
    ev = table(spark, sf_dir, "events")
    cut = F.lit(SPLIT_TS).cast("timestamp_ntz")
    narrow = {"user_id": F.col("user_id").cast("int"), "value": F.col("value").cast("float")}
    base = scratch_path(spark, "landing-widen")
    schema = T.StructType([{"user_id": T.StructField("user_id", T.IntegerType()),
                            "value": T.StructField("value", T.FloatType())}.get(f.name, f) for f in EVENTS_SCHEMA])
    spec = _events_raw_spec(_uniq("widened_events"), base).with_(schema=schema, schema_drift="widen", n_folders=None)
    for batch in (ev.filter(F.col("ts") < cut).withColumns(narrow), ev.filter(F.col("ts") >= cut)):
        stage_landing(batch, f"{base}/events_landing", "ts", one_file_per_folder=True)
        load_raw_incremental(spark, spec)
    return spark.table(spec.target)


def q_version_restore(spark, sf_dir):
    """M5: two loads and a bad third one; the first is read again, the second
    is made the table's state."""
    ev, raw = table(spark, sf_dir, "events"), _uniq("raw_events")
    spec = TableSpec(target=_uniq("restored_events"), source=raw, load_type=INCREMENTAL, columns=EVENT_COLS,
                     key=EVENT_KEY, timestamp="ts", tiebreak=("event_id",), partition_cols=YMD_COLUMNS,
                     transforms=("DERIVE_YMD",))
    first = ev.filter(F.col("ts") < F.lit(SPLIT_TS).cast("timestamp_ntz"))
    bad = ev.withColumn("value", F.lit(-1.0)).withColumn("ts", F.col("ts") + F.expr("INTERVAL 40 DAYS"))
    for source in (first, ev, bad):
        overwrite_table(source, raw)
        load_clean_incremental(spark, spec)
    entries = [r["version"] for r in versions(spark, spec.target).select("version").collect()]
    restore(spark, spec.target, entries[1])
    states = (("first", read_version(spark, spec.target, entries[2])), ("restored", spark.table(spec.target)))
    one, two = (df.withColumn("state", F.lit(s)) for s, df in states)
    return one.unionByName(two)


def q_run_resume(spark, sf_dir):
    """A run in which one table's source is missing, and the same run
    again after it came: the table and its reader load, the rest does not."""
    register_inputs(spark, sf_dir, ("events",))
    names = {n: _uniq(n) for n in ("resume_events", "resume_orders", "resume_reader")}
    late = _uniq("late_orders")
    specs = [TableSpec(target=names["resume_events"], source="events", columns=EVENT_COLS, key=EVENT_KEY,
                       timestamp="ts", tiebreak=("event_id",)),
             TableSpec(target=names["resume_orders"], source=late),
             TableSpec(target=names["resume_reader"], source=names["resume_orders"])]
    run = _uniq("run")
    run_loads(spark, specs, run_id=run)
    table(spark, sf_dir, "orders").createOrReplaceTempView(late)
    report = run_loads(spark, specs, run_id=run)
    loads = [table_history(spark, n).select("table_name") for n in names.values()]
    counts = loads[0].union(loads[1]).union(loads[2]).groupBy("table_name").agg(F.count(F.lit(1)).alias("loads"))
    return _renamed(report.join(counts, "table_name", "left"), names).select("table_name", "status", "row_count", "loads")


def q_revenue_latest_facts(spark, sf_dir):
    """Flagship: columns -> DERIVE_YMD -> latest per key -> PRICE_REVENUE."""
    spec = TableSpec(target="flagship", source="facts", key=("shop_id", "event_type"),
                     timestamp="created_at", transforms=("DERIVE_YMD",), tiebreak=("event_id",))
    fact = prepare(facts(spark, sf_dir), spec)
    return price_revenue(fact, price_lookup(spark, sf_dir), LOOKUP)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_projection": q_scan_projection,
    "schema_enforced_read": q_schema_enforced_read,
    "landing_latest_folders": q_landing_latest_folders,
    "landing_full_snapshot": q_landing_full_snapshot,
    "landing_corrupt_tolerance": q_landing_corrupt_tolerance,
    "landing_schema_drift": q_landing_schema_drift,
    "cast_columns": q_cast_columns,
    "alias_columns": q_alias_columns,
    "derive_ymd": q_derive_ymd,
    "transform_chain": q_transform_chain,
    "dedup_latest": q_dedup_latest,
    "dedup_no_timestamp": q_dedup_no_timestamp,
    "dedup_exact_copies": q_dedup_exact_copies,
    "dedup_date_timestamp": q_dedup_date_timestamp,
    "latest_price": q_latest_price,
    "dedup_dirty_keys": q_dedup_dirty_keys,
    "price_revenue": q_price_revenue,
    "watermark_max": q_watermark_max,
    "incremental_filter": q_incremental_filter,
    "incremental_filter_pruned": q_incremental_filter_pruned,
    "date_watermark_filter": q_date_watermark_filter,
    "upsert_gt": q_upsert_gt,
    "upsert_ge": q_upsert_ge,
    "upsert_metrics": q_upsert_metrics,
    "upsert_fixed_partition": q_upsert_fixed_partition,
    "upsert_key_index": q_upsert_key_index,
    "upsert_hash_ranges": q_upsert_hash_ranges,
    "stable_view_switch": q_stable_view_switch,
    "latest_load_history": q_latest_load_history,
    "create_on_missing": q_create_on_missing,
    "full_overwrite_partitioned": q_full_overwrite_partitioned,
    "raw_incremental_e2e": q_raw_incremental_e2e,
    "raw_full_e2e": q_raw_full_e2e,
    "clean_incremental_e2e": q_clean_incremental_e2e,
    "clean_full_e2e": q_clean_full_e2e,
    "clean_incremental_enriched": q_clean_incremental_enriched,
    "load_history": q_load_history,
    "landing_missing_base": q_landing_missing_base,
    "custom_transform": q_custom_transform,
    "run_two_hops": q_run_two_hops,
    "run_report": q_run_report,
    "run_outcomes": q_run_outcomes,
    "stream_upsert": q_stream_upsert,
    "stream_redelivery": q_stream_redelivery,
    "stream_restart": q_stream_restart,
    "landing_late_files": q_landing_late_files,
    "landing_snapshot_complete": q_landing_snapshot_complete,
    "clean_arrival_watermark": q_clean_arrival_watermark,
    "landing_schema_widen": q_landing_schema_widen,
    "version_restore": q_version_restore,
    "run_resume": q_run_resume,
    "revenue_latest_facts": q_revenue_latest_facts,
}
