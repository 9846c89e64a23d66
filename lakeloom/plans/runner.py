"""Run many table loads (R2) and report them.

Tables are loaded in dependency order: a table whose PRICE_REVENUE lookup is
another configured table waits for it. Tables of the same level run as
concurrent Spark jobs from a small thread pool (Spark schedules their tasks on
the shared executors). A failing table becomes a FAILED row; the others go on.

With a ``run_id`` each table's row is kept as soon as the table is done, under
``{warehouse}/_runs/run_id=<id>``. A later call with the same id (after a failure
was mended, or the driver died) loads only what is open: tables that failed or
were skipped or never reached, tables whose configuration changed, and tables
that read one of these.
"""

from __future__ import annotations

import hashlib
import logging
import time
import uuid
from collections import Counter
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import fields
from typing import Any
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.operators.dedup import latest_per_key
from lakeloom.plans.loads import load_table
from lakeloom.session import warehouse_root
from lakeloom.spec import TableSpec, as_spec

log = logging.getLogger("lakeloom.runner")

REPORT_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("load_type", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("inserted", T.LongType()),
    T.StructField("updated", T.LongType()),
    T.StructField("error", T.StringType()),
    T.StructField("skipped_files", T.LongType()),
    T.StructField("partitions_rewritten", T.LongType()),
])


def dependencies(specs: Sequence[TableSpec]) -> dict[str, set[str]]:
    """Configured targets that each target reads: its lookup table, and its
    source where that is a table loaded in the same run."""
    targets = {s.target for s in specs}
    return {s.target: ({s.source, s.lookup.table if s.lookup else s.source} & targets) - {s.target}
            for s in specs}


def dependency_levels(specs: Sequence[TableSpec]) -> list[list[TableSpec]]:
    """Group specs into levels; every table that a spec reads and that is
    itself a configured target sits in an earlier level. Cycles raise."""
    by_target = {s.target: s for s in specs}
    deps = dependencies(specs)
    levels, done = [], set()
    while len(done) < len(specs):
        ready = [s for s in specs if s.target not in done and deps[s.target] <= done]
        if not ready:
            raise ValueError(f"lookup dependency cycle among {sorted(set(by_target) - done)}")
        levels.append(ready)
        done |= {s.target for s in ready}
    return levels


def _describe_jobs(spark: SparkSession, text: str | None, pool: str | None = None) -> None:
    """Label this thread's Spark jobs (event log, job listings) and, when the
    cluster schedules FAIR, give them their own pool so tables loading at the
    same time share the executors instead of queueing behind the first job.
    Needs a SparkContext (not available under Spark Connect)."""
    try:
        sc = spark.sparkContext
        sc.setJobDescription(text)
        if pool and spark.conf.get("spark.scheduler.mode", "FIFO").upper() == "FAIR":
            sc.setLocalProperty("spark.scheduler.pool", pool)
    except Exception:  # Spark Connect: no SparkContext on the client
        pass


def _one(spark: SparkSession, cfg: TableSpec | Mapping[str, Any], spec_kw: dict) -> tuple:
    name = cfg.target if isinstance(cfg, TableSpec) else cfg.get("gold_table") or cfg.get("bronze_table")
    load_type = cfg.load_type if isinstance(cfg, TableSpec) else cfg.get("load_type")
    category = cfg.category if isinstance(cfg, TableSpec) else cfg.get("table_category")
    _describe_jobs(spark, f"lakeloom load {name} ({load_type})", pool=f"lakeloom-{name}")
    try:
        spec = as_spec(cfg, **spec_kw)
        r = load_table(spark, spec)
        return (spec.target, "SUCCESS", r.source_rows, load_type, category, r.inserted,
                r.updated, None, r.skipped_files, r.partitions_rewritten)
    except Exception as e:  # isolate the table; the report carries the reason
        log.error("load of %s failed: %s", name, e)
        return (name, "FAILED", 0, load_type, category, 0, 0, f"{type(e).__name__}: {e}", 0, None)


def _failed(spec: TableSpec, reason: str) -> tuple:
    log.error("load of %s failed: %s", spec.target, reason)
    return (spec.target, "FAILED", 0, spec.load_type, spec.category, 0, 0, reason, 0, None)


#: One row of a run's state: the report row, when it was written, and which
#: configuration it is about.
STATE_SCHEMA = T.StructType([*REPORT_SCHEMA.fields, T.StructField("config", T.StringType()),
                             T.StructField("done_at", T.TimestampType()), T.StructField("seq", T.LongType())])


def _config_mark(spec: TableSpec) -> str:
    text = "\n".join(f"{f.name}={getattr(spec, f.name)!r}" for f in fields(spec))
    return hashlib.sha256(text.encode()).hexdigest()


def _run_folder(spark: SparkSession, run_id: str, root: str | None = None) -> str:
    return f"{(root or warehouse_root(spark)).rstrip('/')}/_runs/run_id={quote(run_id, safe='')}"


def run_state(spark: SparkSession, run_id: str, root: str | None = None) -> DataFrame:
    """The newest kept row of each table of a run."""
    try:
        rows = (spark.read.schema(STATE_SCHEMA).option("recursiveFileLookup", "true")
                .parquet(_run_folder(spark, run_id, root)))
    except Exception as e:  # nothing kept yet
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        rows = spark.createDataFrame([], STATE_SCHEMA)
    return latest_per_key(rows, ["table_name"], "done_at", ["seq"], normalise=False)


def _keep(spark: SparkSession, run_id: str, row: tuple, config: str | None) -> None:
    """Keep a table's row. A row that cannot be written only makes the table
    load again, which the guard and the versions make harmless."""
    tag = f"{int(time.time() * 1000)}_{uuid.uuid4().hex[:8]}"
    try:
        (spark.createDataFrame([(*row, config)], T.StructType(STATE_SCHEMA.fields[:-2]))
         .withColumn("done_at", F.current_timestamp()).withColumn("seq", F.lit(time.time_ns()))
         .coalesce(1).write.mode("errorifexists").parquet(f"{_run_folder(spark, run_id)}/row_{tag}"))
    except Exception as e:
        log.warning("run %s: the row of %s was not kept: %s", run_id, row[0], e)


def _finished_before(spark: SparkSession, run_id: str, specs: Sequence[TableSpec]) -> dict[str, tuple]:
    """Rows of the tables that an earlier call of this run has loaded as they
    are configured now, and that read no table which is still open."""
    marks = {s.target: _config_mark(s) for s in specs}
    kept = {r["table_name"]: r for r in run_state(spark, run_id).filter("status = 'SUCCESS'").collect()}
    done = {t for t, mark in marks.items() if t in kept and kept[t]["config"] == mark}
    deps = dependencies(specs)
    while again := {t for t in done if deps[t] - done}:
        done -= again
    return {t: tuple(kept[t][f] for f in REPORT_SCHEMA.fieldNames()) for t in done}


def run_loads(spark: SparkSession, configs: Iterable[TableSpec | Mapping[str, Any]],
              max_workers: int = 4, run_id: str | None = None, **spec_kw) -> DataFrame:
    """Load every enabled table; return one report row per table.

    Tables that read another table of the run wait for it. One faulty
    configuration never stops the others: duplicates of a target, members of
    a cycle, and tables that read a table which failed are reported FAILED
    with the reason, and the rest is loaded. With a ``run_id`` tables that an
    earlier call of the same run has loaded are not loaded again; the report
    shows the rows they had.
    """
    items = [c for c in configs
             if (c.enabled if isinstance(c, TableSpec) else c.get("isLoad", True))]
    specs, broken = [], []
    for c in items:
        try:
            specs.append(as_spec(c, **spec_kw))
        except Exception:
            broken.append(c)       # reported as FAILED by _one below
    rows = [_one(spark, c, spec_kw) for c in broken]
    # two configurations of one target would overwrite each other: both fail
    often = {t for t, n in Counter(s.target for s in specs).items() if n > 1}
    rows += [_failed(s, "another configuration has the same target") for s in specs if s.target in often]
    specs = [s for s in specs if s.target not in often]
    deps = dependencies(specs)
    bad = often | {r[0] for r in rows}
    before = _finished_before(spark, run_id, specs) if run_id else {}
    rows += before.values()
    left = [s for s in specs if s.target not in before]

    def load(s: TableSpec) -> tuple:
        row = _one(spark, s, spec_kw)
        if run_id:
            _keep(spark, run_id, row, _config_mark(s))
        return row

    while left:
        open_ = {s.target for s in left}
        ready = [s for s in left if not deps[s.target] & open_]
        if not ready:
            rows += [_failed(s, f"dependency cycle among {sorted(open_)}") for s in left]
            break
        reads = {s.target: {s.source, s.lookup.table if s.lookup else s.source} & bad for s in ready}
        skipped = [s for s in ready if reads[s.target]]
        rows += [_failed(s, f"skipped: {', '.join(sorted(reads[s.target]))} failed in this run") for s in skipped]
        run = [s for s in ready if not reads[s.target]]
        if run:
            with ThreadPoolExecutor(max_workers=max(1, min(max_workers, len(run)))) as pool:
                done = list(pool.map(load, run))
            rows += done
            bad |= {r[0] for r in done if r[1] != "SUCCESS"}
        bad |= {s.target for s in skipped}
        left = [s for s in left if s not in ready]
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def outcome_counts(report: DataFrame) -> DataFrame:
    """A3: tables total / succeeded / failed."""
    return report.agg(F.count(F.lit(1)).alias("total"),
                      F.sum(F.when(F.col("status") == "SUCCESS", 1).otherwise(0)).alias("success"),
                      F.sum(F.when(F.col("status") != "SUCCESS", 1).otherwise(0)).alias("failed"))
