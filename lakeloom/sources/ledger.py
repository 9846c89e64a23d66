"""Ledger of landing files: which files a target has taken, exactly.

One Parquet folder per load under ``{warehouse}/_landing_ledger/{target}/{base}``
holds ``(path, length, modified, status)`` of the files of that load. A file is
done when the ledger holds it with the same length and modification time, so
the files to load are the landing listing anti-joined with the ledger: a late
file in any older hour folder is found, a file written again is loaded again,
and nothing is read twice.

Statuses: ``loaded``; ``before`` (there at the first load, but older than the
folders it was asked to read); ``left out`` (failed the footer check: it stays
open, so every load looks at its footer again and reads it once it is mended).

A load writes its entry first and names it in a property of the target that
switches together with the rows. Entries newer than that name belong to loads
that did not finish: they do not count, and the next load removes them. A target
that was dropped has no name, so its ledger starts again. Every ``COMPACT``
entries the next one holds the whole ledger (without files that have left the
landing area), and older ones go.
"""

from __future__ import annotations

import hashlib
import re
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.session import scratch_path, warehouse_root
from lakeloom.sources.landing import LEVELS, _hadoop_fs, folders_of_days, list_landing_files, newest_folders, \
    read_landing_folders, screen_files

LOADED, BEFORE, LEFT_OUT = "loaded", "before", "left out"
COMPACT = 64
SCHEMA = T.StructType([T.StructField("path", T.StringType()), T.StructField("length", T.LongType()),
                       T.StructField("modified", T.LongType()), T.StructField("status", T.StringType())])
_ENTRY = re.compile(r"(\d{14}_[0-9a-f]{8})(_whole)?")


def files_of(listing: DataFrame) -> DataFrame:
    """``path, length, modified`` of the Parquet files of a landing listing."""
    return listing.filter("is_parquet").select("path", "length", F.unix_millis("modificationTime").alias("modified"))


@dataclass(frozen=True)
class Ledger:
    spark: SparkSession
    folder: str
    key: str                       # property of the target that names the last finished entry
    last: str | None               # its value: None before the first load

    def _names(self) -> list[str]:
        fs, root = _hadoop_fs(self.spark, self.folder)
        if not fs.exists(root):
            return []
        return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(root)) if _ENTRY.fullmatch(n))

    def _remove(self, names: list[str]) -> None:
        for n in names:
            fs, path = _hadoop_fs(self.spark, f"{self.folder}/{n}")
            fs.delete(path, True)

    def finished(self) -> list[str]:
        """Entries that count, oldest first; those of unfinished loads are removed."""
        names = self._names()
        open_ = [n for n in names if self.last is None or n > self.last]
        self._remove(open_)
        own = [n for n in names if n not in open_]
        whole = [i for i, n in enumerate(own) if n.endswith("_whole")]
        return own[whole[-1]:] if whole else own

    def entries(self) -> DataFrame:
        own = self.finished()
        if not own:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(*[f"{self.folder}/{n}" for n in own])

    def open_files(self, files: DataFrame) -> DataFrame:
        """``files`` (``path, length, modified``) that no finished load has taken."""
        done = self.entries().filter(F.col("status") != LEFT_OUT).select("path", "length", "modified").distinct()
        return files.join(done, ["path", "length", "modified"], "left_anti")

    def write(self, rows: DataFrame, files: DataFrame) -> str:
        """Write the entry of a load; returns its name, for the property."""
        own = self.finished()
        name = f"{int(time.time() * 1000):014d}_{uuid.uuid4().hex[:8]}"
        if self.last and name <= self.last:                     # a clock that went back
            name = f"{int(self.last[:14]) + 1:014d}_{uuid.uuid4().hex[:8]}"
        if len(own) >= COMPACT:
            rows = rows.unionByName(self.entries().join(files.select("path"), "path", "left_semi")
                                    .select(*SCHEMA.fieldNames())).distinct()
            name += "_whole"
        rows.select(*SCHEMA.fieldNames()).write.mode("errorifexists").parquet(f"{self.folder}/{name}")
        return name

    def tidy(self, last: str) -> None:
        """Remove entries that a finished whole one has taken over."""
        if last.endswith("_whole"):
            self._remove([n for n in self._names() if n < last])


def open_ledger(spark: SparkSession, target: str, base: str, last_of, root: str | None = None) -> Ledger:
    """The ledger of ``target`` for landing folder ``base``; ``last_of(key)``
    reads a property of the target."""
    tag = hashlib.sha256(base.rstrip("/").encode()).hexdigest()[:16]
    key = f"ledger.{tag}"
    folder = f"{(root or warehouse_root(spark)).rstrip('/')}/_landing_ledger/{target}/{tag}"
    return Ledger(spark, folder, key, last_of(key))


def read_new_files(spark: SparkSession, ledger: Ledger, base: str, schema: T.StructType, n_folders: int | None, *,
                   late_days: int | None = None, ignore_corrupt_files: bool = True, with_order: bool = False,
                   drift: str = "off", skipped: list | None = None) -> tuple[DataFrame | None, DataFrame, DataFrame]:
    """L3: the rows of all files that ``ledger`` does not hold yet (None: no
    such file), the rows of this load's entry, and the files listed.

    The first load reads the ``n_folders`` newest hour folders (None: all) and
    enters the other files as seen before. ``late_days`` bounds the listing to
    the newest folder's day and that many days before it. The listing is
    written once, so what is entered is what is read. Paths of new files reach
    the driver (Spark's reader holds them there as well), but for a first load
    of everything, which reads the base.
    """
    skipped = [] if skipped is None else skipped
    before = len(skipped)
    first = ledger.last is None
    chosen = newest_folders(spark, base, 1 if n_folders is None or not first else n_folders)
    if not chosen:
        raise ValueError(f"{base} holds no hour folder to load")
    some = folders_of_days(spark, base, late_days) if late_days is not None else None
    path = scratch_path(spark, "landing-files")
    files_of(list_landing_files(spark, base, some)).write.parquet(f"{path}/all")
    files = spark.read.schema(T.StructType(SCHEMA.fields[:3])).parquet(f"{path}/all")
    ledger.open_files(files).write.parquet(f"{path}/open")
    fresh = spark.read.schema(files.schema).parquet(f"{path}/open")
    own = fresh
    if first and n_folders is not None:
        if not any(fs for _, fs in chosen):
            raise ValueError(f"the newest hour folders of {base} hold no Parquet file")
        hours = ["/".join(folder.rstrip("/").split("/")[-len(LEVELS):]) for folder, _ in chosen]
        own = fresh.filter(F.regexp_extract("path", r"([^/]+/[^/]+/[^/]+/[^/]+)/[^/]+$", 1).isin(hours))
    drop = screen_files(own, schema, drift, skipped, allow_none=not first)
    failing = [p for p, _, _ in skipped[before:]]
    left_out = F.col("path").isin(failing) if failing else F.lit(False)
    entry = own.withColumn("status", F.when(left_out, LEFT_OUT).otherwise(LOADED))
    if first and n_folders is not None:
        entry = entry.unionByName(fresh.join(own.select("path"), "path", "left_anti").withColumn("status", F.lit(BEFORE)))
    opts = dict(ignore_corrupt_files=ignore_corrupt_files and not drop.unchecked, with_order=with_order)
    if first and n_folders is None and some is None:
        if own.isEmpty():
            raise ValueError(f"{base} holds no Parquet file")
        return read_landing_folders(spark, [base], drop.schema or schema, recursive=True, exclude=drop, **opts), entry, files
    paths = [r["path"] for r in own.select("path").collect() if r["path"] not in drop]
    if first and not paths:
        raise ValueError(f"{base} holds no Parquet file to load")
    return (read_landing_folders(spark, sorted(paths), drop.schema or schema, **opts) if paths else None), entry, files
