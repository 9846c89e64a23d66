"""ST1: landing files -> latest row per key -> guarded upsert, as a stream.

The polling "read the newest N hour folders again" loop becomes a Parquet file
source with a checkpoint: every landing file is processed exactly once per
checkpoint, however late it arrives. The file source orders new files by
modification time, not by folder name, so correctness comes from the merge
guard (``source.ts >= target.ts`` keeps the newest row whatever the batch
order), never from arrival order. Each micro-batch is deduplicated and merged
inside ``foreachBatch``. The checkpoint belongs to the target (by default it is
derived from its name). The last merged epoch is a property of the target that
switches together with the rows, under the id that the checkpoint gives its
query: a batch replayed after a failure is not merged again, and a fresh
checkpoint, also one at the same place, starts its own count and loads every
file anew.

``drop_replays`` adds keyed state (:mod:`lakeloom.streaming.newest_state`): rows
that are no newer than what the stream has seen of their key leave before the
merge, so a re-delivery rewrites no partition.

A file that does not fit the schema, or is not Parquet, fails the batch and the
checkpoint does not advance, so no file is marked done unread. Only
``schema_drift="off"`` or ``"exclude"`` hands such files to Spark's
``ignoreCorruptFiles``, which skips them.

The file source lists the watched tree on every trigger and remembers every
file it has processed. Over years of hourly folders both grow without bound,
so ``clean_source`` (Spark's ``cleanSource``) can archive or delete each file
once its batch is committed, keeping the watched tree to the files not yet
loaded. It changes the landing area, so it is opt-in. ``max_file_age`` bounds
the remembered-file log: files whose modification time is older than that,
counted from the newest file, are ignored (Spark's own default is seven days),
so set it above the longest delay of a delivery.
"""

from __future__ import annotations

import json
from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lakeloom.plans.loads import _layout, _landing, _partitions, prepare, upsert_scope
from lakeloom.session import warehouse_root
from lakeloom.sinks.history import append_history
from lakeloom.sinks.tables import get_note, upsert_table
from lakeloom.sources.landing import ORDER_COL, PARQUET_GLOB, enforce_schema, landing_order
from lakeloom.spec import TableSpec
from lakeloom.streaming.newest_state import BUCKETS, newest_only, state_store


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """Id of the streaming query that owns the checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def start_landing_stream(spark: SparkSession, spec: TableSpec, *, checkpoint: str | None = None,
                         available_now: bool = True, processing_time: str | None = None,
                         max_files_per_trigger: int | None = None,
                         clean_source: str | None = None, archive_dir: str | None = None,
                         max_file_age: str | None = None, drop_replays: bool = False,
                         state_buckets: int = BUCKETS, record: bool = True) -> StreamingQuery:
    """Start the stream; with ``available_now`` it drains what is there and stops.

    ``clean_source``: ``"archive"`` (move processed files under
    ``archive_dir``, which must lie outside the landing base) or ``"delete"``.
    ``state_buckets``: state rows of ``drop_replays`` (of one checkpoint always the same).
    """
    if not spec.dedups:
        raise ValueError(f"{spec.target}: a streaming upsert needs key and timestamp")
    reader = (spark.readStream.schema(spec.schema)
              .option("recursiveFileLookup", "true")
              .option("pathGlobFilter", PARQUET_GLOB)
              .option("ignoreCorruptFiles", str(
                  spec.ignore_corrupt_files and spec.schema_drift in ("off", "exclude")).lower()))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if max_file_age:
        reader = reader.option("maxFileAge", max_file_age)
    if clean_source:
        if clean_source not in ("archive", "delete"):
            raise ValueError("clean_source must be 'archive' or 'delete'")
        if clean_source == "archive" and not archive_dir:
            raise ValueError("clean_source='archive' needs archive_dir")
        reader = reader.option("cleanSource", clean_source)
        if archive_dir:
            reader = reader.option("sourceArchiveDir", archive_dir)
    order = (ORDER_COL,) if spec.newest_file_wins else ()
    stream = reader.parquet(_landing(spec))
    if order:   # within a micro-batch, equal timestamps go to the newest delivery
        stream = stream.withColumn(ORDER_COL, landing_order())
    stream = enforce_schema(stream, spec.schema, keep=order)

    checkpoint = checkpoint or f"{warehouse_root(spark)}/_streams/{spec.target}"
    if drop_replays:
        stream = newest_only(stream, spec.key, spec.timestamp, ignore=order, buckets=state_buckets)

    def merge_batch(batch: DataFrame, epoch_id: int) -> None:
        mark = f"epoch.{_query_id(spark, checkpoint)}"
        done = get_note(spark, spec.target, mark)
        if done is not None and epoch_id <= int(done):
            return                      # a replay of a batch that was merged
        prepared = prepare(batch, spec, order)
        res = upsert_table(prepared, spec.target, spec.key, spec.timestamp, spec.update_op,
                           partition_cols=_partitions(spec, prepared), buckets=spec.buckets,
                           scope=upsert_scope(spec), key_index=spec.key_index, notes={mark: str(epoch_id)},
                           **_layout(spec))
        # the batch runs in a cloned session: the caller's one has its own cache
        spark.catalog.refreshTable(spec.target)
        if record:
            append_history(batch.sparkSession, res)

    w = (stream.writeStream.foreachBatch(merge_batch)
         .option("checkpointLocation", checkpoint))
    if drop_replays:
        w = w.outputMode("update")
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    with state_store(spark) if drop_replays else nullcontext():
        return w.start()
