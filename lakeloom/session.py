"""Session settings and the shared scratch location.

Nothing here hard-codes a machine-local folder for cluster runs: scratch data
(staged landing files, streaming checkpoints, table versions of the examples)
goes under ``spark.checkpoint.dir``, which a cluster points at shared storage.
Only when that setting is absent (local tests) do we create one in /tmp.
"""

from __future__ import annotations

import io
import os
import re
import tempfile
import threading
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every load relies on. AQE re-plans joins and aggregations from
# measured shuffle sizes: it coalesces small partitions, splits skewed join
# partitions and turns a sort-merge join into a broadcast join only after the
# build side's real size is known to be under the threshold.
ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def scale_conf(shuffle_bytes: int, partition_bytes: int = 256 << 20,
               max_partitions: int = 100_000) -> dict[str, str]:
    """Shuffle sizing for a job expected to shuffle ``shuffle_bytes``.

    Adaptive execution starts from ``initialPartitionNum`` partitions and
    coalesces them to ``advisoryPartitionSizeInBytes``: starting high keeps
    every reducer's input bounded at 100 TB scale (the default of 200 would
    give reducers of hundreds of GB), while small stages still collapse to a
    few tasks. Skew splitting and rebalanced writes use the same target size.
    """
    n = max(200, min(max_partitions, -(-shuffle_bytes // partition_bytes)))
    return {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
    }


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "lakeloom", extra: dict | None = None,
                  shuffle_bytes: int | None = None) -> SparkSession:
    """Create (or fetch) a session with the adaptive settings applied.

    ``master`` and ``shuffle_partitions`` are for local runs; on a cluster
    leave them unset so the cluster's own configuration applies, and pass
    ``shuffle_bytes`` (the largest expected shuffle) to size partitions.
    Beyond 25 TB of shuffle the partition count stays at ``scale_conf``'s
    ``max_partitions`` and reducers grow past 256 MB; raise both there.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(ADAPTIVE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if shuffle_bytes:
        conf.update(scale_conf(shuffle_bytes))
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


_SHIP_LOCK = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per context.

    Only the footer check runs Python inside tasks; its function is pickled by
    reference to this package, so the executors need the package. It is
    zipped in memory, written under ``spark.checkpoint.dir`` (shared storage
    on a cluster) through the Hadoop file system, and distributed with
    ``addPyFile``, which also reaches executors added later. A Spark Connect
    client uploads it as a Python artifact instead. A cluster that installs
    the package on its executors gets the same code either way.
    """
    try:
        sc = spark.sparkContext
    except Exception:       # Spark Connect: no SparkContext on the client
        sc = None
    holder = sc if sc is not None else spark
    with _SHIP_LOCK:                # loads of one run may start in parallel threads
        if not getattr(holder, "_lakeloom_shipped", False):
            _ship(spark, sc)
            holder._lakeloom_shipped = True


def _package_zip() -> bytes:
    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    return buf.getvalue()


def _ship(spark: SparkSession, sc) -> None:
    data = _package_zip()
    if sc is None:
        with tempfile.TemporaryDirectory(prefix="lakeloom-artifact-") as d:
            local = os.path.join(d, "lakeloom.zip")
            with open(local, "wb") as f:
                f.write(data)
            spark.addArtifacts(local, pyfile=True)
        return
    target = f"{scratch_path(spark, 'pyfiles')}/lakeloom.zip"
    path = sc._jvm.org.apache.hadoop.fs.Path(target)
    out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    sc.addPyFile(target)


_LOCAL_DIRS: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared scratch folder: ``spark.checkpoint.dir``, else the folder
    given to ``setCheckpointDir``, else (a ``local`` master only) a temporary
    folder of this application. Anywhere else an unset folder is an error: a
    machine-local one would not be seen by the executors."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:       # Spark Connect: no SparkContext on the client
        sc = None
    if not d and sc is not None:
        d = sc.getCheckpointDir()
    if not d:
        master = spark.conf.get("spark.master", "")
        if sc is None or not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all "
                               "executors share")
        with _SHIP_LOCK:
            d = _LOCAL_DIRS.get(sc.applicationId)
            if d is None:
                d = _LOCAL_DIRS[sc.applicationId] = tempfile.mkdtemp(prefix="lakeloom-ckpt-")
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint location."""
    return f"{ensure_checkpoint_dir(spark)}/lakeloom/{name}-{uuid.uuid4().hex[:12]}"


def warehouse_root(spark: SparkSession) -> str:
    """Where table versions are written: ``lakeloom.warehouse`` or scratch."""
    root = spark.conf.get("lakeloom.warehouse", None)
    if root:
        return root.rstrip("/")
    return f"{ensure_checkpoint_dir(spark)}/lakeloom/warehouse"
