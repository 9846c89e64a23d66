"""Landing files: ``{base}/{year}/{month}/{day}/{hour}/*.parquet``.

Folders are ranked by their numeric year / month / day / hour values, so
unpadded names ("9" < "10") order correctly; a level may also be written
``name=value``. Finding the newest N hour folders walks the tree top down
through the cluster's Hadoop file system: list the years, enter the newest,
list its months, and so on, backing up only when a branch holds fewer than N
hours. An hourly load therefore lists a handful of directories, not every
file the landing area has accumulated over years. Hidden entries (``_`` or
``.`` prefix) are skipped as Spark's file index skips them.

Where the JVM gateway is not available (Spark Connect) the same answer comes
from a listing DataFrame (``binaryFile`` source, ``path`` only, so file
contents are never read). A backfill over every folder reads the base
recursively and uses the listing DataFrame for its file checks, so the file
list stays in Spark.
"""

from __future__ import annotations

import datetime as dt
import logging
import re
import time
from collections.abc import Collection, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.sources.drift import WIDER, failing_files, uri_form, widened_schema

log = logging.getLogger("lakeloom.landing")

DRIFT_MODES = ("off", "report", "exclude", "error", "widen")
PARQUET_GLOB = "*.[pP][aA][rR][qQ][uU][eE][tT]"
LEVELS = ("y", "m", "d", "h")
ORDER_COL = "_landing_order"

LISTING_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("folder", T.StringType()),
    T.StructField("file_name", T.StringType()),
    *[T.StructField(f"{lv}_name", T.StringType()) for lv in LEVELS],
    T.StructField("is_parquet", T.BooleanType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
])

_SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?"


def _strip_scheme(c: Column) -> Column:
    return F.regexp_replace(c, _SCHEME, "")


def _level_value(name: Column) -> Column:
    """Folder name ``2024`` or ``year=2024`` -> ``2024``."""
    return F.regexp_extract(name, r"^(?:[^=/]*=)?([^/]*)$", 1)


def _sort_key(name: Column) -> Column:
    """Numeric names compare as numbers, others as text (after numbers)."""
    v = _level_value(name)
    return F.lpad(F.coalesce(v.try_cast("long").cast("string"), F.concat(F.lit("~"), v)), 20, "0")


def folder_order(y: Column, m: Column, d: Column, h: Column) -> Column:
    """A string that sorts folders newest-last by (year, month, day, hour)."""
    return F.concat_ws("/", _sort_key(y), _sort_key(m), _sort_key(d), _sort_key(h))


def _base_pattern(base: str) -> str:
    plain = re.sub(_SCHEME, "", base.rstrip("/"))
    return "^" + re.escape(plain) + r"/([^/]+)/([^/]+)/([^/]+)/([^/]+)/([^/]+)$"


def list_landing_files(spark: SparkSession, base: str, folders: Sequence[str] | None = None) -> DataFrame:
    """Every file exactly four folder levels below ``base`` (with
    ``folders``: of these hour folders only).

    Missing ``base`` -> empty listing. Other errors (permissions, I/O)
    propagate rather than looking like "no files".
    """
    try:
        raw = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
               .load(base if folders is None else list(folders)).select("path", "modificationTime", "length"))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame([], LISTING_SCHEMA)
        raise
    pat = _base_pattern(base)
    p = _strip_scheme(F.col("path"))
    parts = {lv: F.regexp_extract(p, pat, i + 1) for i, lv in enumerate(LEVELS)}
    fname = F.regexp_extract(p, pat, 5)
    folder = F.regexp_extract(F.col("path"), r"^(.*)/[^/]+$", 1)
    return (raw.select(
        "path", folder.alias("folder"), fname.alias("file_name"),
        *[parts[lv].alias(f"{lv}_name") for lv in LEVELS],
        F.lower(F.col("path")).endswith(".parquet").alias("is_parquet"),
        "modificationTime", "length")
        .filter(F.col("file_name") != ""))


_HIDDEN = ("_", ".")


def _name_key(name: str) -> tuple:
    """Python twin of :func:`_sort_key`: numbers by value, before other text."""
    v = name.split("=", 1)[1] if "=" in name else name
    try:
        return (0, int(v), "")
    except ValueError:
        return (1, 0, v)


def _hadoop_fs(spark: SparkSession, base: str):
    """``(FileSystem, Path)`` for ``base`` through the JVM gateway, or None
    when there is no gateway (Spark Connect)."""
    try:
        sc = spark.sparkContext
        jvm, conf = sc._jvm, sc._jsc.hadoopConfiguration()
    except Exception:
        return None
    if jvm is None:
        return None
    path = jvm.org.apache.hadoop.fs.Path(base)
    return path.getFileSystem(conf), path


def walk_newest_folders(spark: SparkSession, base: str, n: int,
                        since: str | None = None) -> list[tuple[str, list[str]]] | None:
    """L2/T1 as a top-down walk: the ``n`` newest hour folders, newest first,
    each with its Parquet files (suffix compared case-insensitively), and with
    ``since`` (``y/m/d/h``) every other folder not older than that one. An empty
    hour folder counts as a folder. None when there is no JVM gateway."""
    got = _hadoop_fs(spark, base)
    if got is None:
        return None
    fs, root = got
    if not fs.exists(root):
        return []
    out: list[tuple[str, list[str]]] = []
    oldest = folder_key(since) if since else None

    def visit(path, key: tuple) -> None:
        entries = [st for st in fs.listStatus(path)
                   if not st.getPath().getName().startswith(_HIDDEN)]
        if len(key) == len(LEVELS):
            files = sorted(st.getPath().toString() for st in entries
                           if st.isFile() and st.getPath().getName().lower().endswith(".parquet"))
            out.append((path.toString(), files))
            return
        dirs = sorted((st for st in entries if st.isDirectory()),
                      key=lambda st: _name_key(st.getPath().getName()), reverse=True)
        for st in dirs:
            at = (*key, _name_key(st.getPath().getName()))
            if len(out) >= n and (oldest is None or at < oldest[:len(at)]):
                return
            visit(st.getPath(), at)

    visit(root, ())
    return out


def newest_folders(spark: SparkSession, base: str, n: int,
                   since: str | None = None) -> list[tuple[str, list[str]]]:
    """The ``n`` newest hour folders, and every other one not older than
    ``since``, with their Parquet files: the walk, or the listing DataFrame
    when there is no JVM gateway (that listing only sees folders holding at
    least one file)."""
    walked = walk_newest_folders(spark, base, n, since)
    if walked is not None:
        return walked
    listing = list_landing_files(spark, base)
    chosen = [f for f, _ in latest_folders(listing, n)]
    if since:
        order = folder_order(*[F.col(f"{lv}_name") for lv in LEVELS])
        newer = listing.filter(order >= folder_order(*[F.lit(name) for name in since.split("/")]))
        chosen += [f for f, _ in latest_folders(newer, None) if f not in chosen]
    files: dict[str, list[str]] = {f: [] for f in chosen}
    for r in (listing.filter(F.col("folder").isin(chosen) & F.col("is_parquet"))
              .select("folder", "path").collect()):
        files[r["folder"]].append(r["path"])
    return [(f, sorted(files[f])) for f in chosen]


def folder_of(path: str) -> str:
    """``y/m/d/h`` of a landing file's path."""
    return "/".join(path.split("/")[-len(LEVELS) - 1:-1])


def folder_key(folder: str) -> tuple:
    """Sort key of ``y/m/d/h``."""
    return tuple(_name_key(name) for name in folder.split("/"))


def folders_of_days(spark: SparkSession, base: str, days: int) -> list[str] | None:
    """The hour folders of the newest one's day and the ``days`` before it;
    None when folders are not named by numbers."""
    newest = newest_folder(spark, base)
    if newest is None:
        return []
    levels = [_name_key(name) for name in newest.split("/")]
    if any(kind for kind, _, _ in levels):
        return None
    try:
        day = dt.date(*[n for _, n, _ in levels[:3]]) - dt.timedelta(days=days)
    except ValueError:
        return None
    return [f for f, _ in newest_folders(spark, base, 1, f"{day.year}/{day.month}/{day.day}/0")]


def newest_folder(spark: SparkSession, base: str) -> str | None:
    """``y/m/d/h`` of the newest hour folder, None when there is none."""
    found = newest_folders(spark, base, 1)
    return folder_of(f"{found[0][0].rstrip('/')}/") if found else None


def _paths_frame(spark: SparkSession, paths: Sequence[str], per_task: int = 256) -> DataFrame:
    """A DataFrame of file paths, spread so each task opens ~``per_task``."""
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    return df.repartition(-(-len(paths) // per_task)) if len(paths) > per_task else df


def latest_folders(listing: DataFrame, n: int | None) -> list[tuple[str, int]]:
    """The ``n`` newest hour folders as ``(folder, parquet_files)``,
    newest first; ``n=None`` returns every folder. Only folder names cross to
    the driver, one row each."""
    order = folder_order(*[F.col(f"{lv}_name") for lv in LEVELS])
    folders = (listing.groupBy("folder", *[f"{lv}_name" for lv in LEVELS])
               .agg(F.sum(F.col("is_parquet").cast("int")).alias("n_parquet"))
               .withColumn("_o", order).orderBy(F.col("_o").desc()))
    if n is not None:
        folders = folders.limit(n)
    return [(r["folder"], int(r["n_parquet"])) for r in folders.select("folder", "n_parquet").collect()]


def enforce_schema(df: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """The schema's fields in schema order (extra file columns dropped,
    absent ones NULL because the reader was given the schema)."""
    return df.select(*[f.name for f in schema.fields], *keep)


def read_landing_folders(spark: SparkSession, paths: Sequence[str], schema: T.StructType, *,
                         ignore_corrupt_files: bool = True, with_order: bool = False,
                         only_parquet_suffix: bool = True, recursive: bool = False,
                         exclude: Collection[str] = ()) -> DataFrame:
    """Read Parquet files (or folders of them) with a fixed schema.

    ``ignoreCorruptFiles`` is set on this read only. ``with_order`` adds
    ``_landing_order`` (folder and file name of each row's file) so equal
    timestamps can be resolved in favour of the newest delivery.
    ``exclude``: files to leave out. The filter is on ``_metadata.file_path``,
    which Spark applies while listing, so excluded files are never opened.
    """
    r = spark.read.schema(schema).option("ignoreCorruptFiles", str(ignore_corrupt_files).lower())
    if only_parquet_suffix:
        r = r.option("pathGlobFilter", PARQUET_GLOB)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    df = r.parquet(*paths)
    if exclude:
        forms = sorted({f for p in exclude for f in (p, uri_form(p))})
        df = df.filter(~F.col("_metadata.file_path").isin(forms))
    if with_order:
        return enforce_schema(df.withColumn(ORDER_COL, landing_order()), schema,
                              keep=(ORDER_COL,))
    return enforce_schema(df, schema)


def landing_order() -> Column:
    """Delivery order of a row's file: its hour folder (numeric) then its
    file name, so the newest delivery sorts last. Batch and streaming file
    sources both expose ``_metadata.file_path``."""
    fp = _strip_scheme(F.col("_metadata.file_path"))
    segs = [F.element_at(F.split(fp, "/"), -i) for i in (5, 4, 3, 2, 1)]
    return F.concat_ws("/", folder_order(*segs[:4]), segs[4])


class Screened(set):
    """Paths to leave out; ``unchecked`` files could not be looked at;
    ``schema`` is wider than the one asked for (mode ``widen``)."""

    def __init__(self, paths=(), unchecked: int = 0, schema: T.StructType | None = None):
        super().__init__(paths)
        self.unchecked = unchecked
        self.schema = schema


def screen_files(files: DataFrame, schema: T.StructType, drift: str = "exclude",
                 skipped: list | None = None, allow_none: bool = False) -> set[str]:
    """Check the footers of ``files`` (listing rows) against ``schema``.

    ``off``: no check. ``report``: log and record failing files, read all.
    ``exclude``: leave failing files out. ``error``: raise if any fails.
    ``widen``: files with wider numbers (a long where the schema says int, ...)
    make the columns wider, for all files read; raise if any other fails.
    Returns the paths to leave out (only failing files reach the driver).
    Failing files are appended to ``skipped`` as ``(path, status, detail)``.
    Unless ``allow_none``, it is an error to leave every file out.
    """
    if drift not in DRIFT_MODES:
        raise ValueError(f"drift must be one of {DRIFT_MODES}, got {drift!r}")
    if drift == "off":
        return Screened()
    bad, unchecked = failing_files(files, schema, widen=drift == "widen")
    wide = [detail for _, status, detail in bad if status == WIDER]
    bad = [b for b in bad if b[1] != WIDER]
    if unchecked:
        log.warning("%d landing file(s) could not be opened for the footer check; they are read "
                    "without ignoreCorruptFiles, so a file that does not fit fails the load", unchecked)
    wider = widened_schema(schema, wide) if wide else None
    if wider is not None:
        log.warning("landing files with wider columns: read as %s", wider.simpleString())
    if not bad:
        return Screened(unchecked=unchecked, schema=wider)
    if skipped is not None:
        skipped.extend(bad)
    for path, status, detail in bad[:20]:
        log.warning("landing file %s: %s %s", path, status, detail)
    if drift in ("error", "widen"):
        raise ValueError(f"{len(bad)} landing file(s) do not match the schema, "
                         f"e.g. {bad[0][0]}: {bad[0][1]} {bad[0][2]}")
    if drift == "report":
        return Screened(unchecked=unchecked)
    drop = Screened((p for p, _, _ in bad), unchecked=unchecked)
    if not allow_none and files.count() <= len(drop):
        raise ValueError(f"No readable parquet files left after the schema check "
                         f"({len(drop)} skipped)")
    return drop


def read_incremental(spark: SparkSession, base: str, schema: T.StructType, n_folders: int | None = 2,
                     *, ignore_corrupt_files: bool = True, with_order: bool = False,
                     drift: str = "off", skipped: list | None = None,
                     since: str | None = None) -> DataFrame:
    """L3: all Parquet files of the ``n_folders`` newest hour folders, and of
    every other folder not older than ``since`` (``y/m/d/h``).

    Raises when there is no folder or the chosen folders hold no Parquet
    file. ``n_folders=None`` reads every folder (a backfill): then the base
    is scanned recursively and no folder or file list passes through the
    driver (files excluded by the footer check are filtered out by path).
    """
    opts = dict(ignore_corrupt_files=ignore_corrupt_files, with_order=with_order)
    if n_folders is None:
        parquet = list_landing_files(spark, base).filter(F.col("is_parquet"))
        if not parquet.limit(1).collect():
            raise ValueError(f"{base} holds no Parquet file")
        drop = screen_files(parquet, schema, drift, skipped)
        opts["ignore_corrupt_files"] &= not drop.unchecked
        return read_landing_folders(spark, [base], drop.schema or schema, recursive=True, exclude=drop, **opts)
    folders = newest_folders(spark, base, n_folders, since)
    if not folders:
        raise ValueError(f"{base} holds no hour folder to load")
    paths = [p for _, fs in folders for p in fs]
    if not paths:
        raise ValueError(f"the newest hour folders of {base} hold no Parquet file")
    drop = screen_files(_paths_frame(spark, paths), schema, drift, skipped)
    opts["ignore_corrupt_files"] &= not drop.unchecked
    return read_landing_folders(spark, [p for p in paths if p not in drop], drop.schema or schema, **opts)


#: Folders that are looked at for a completion marker when none is named.
MARKER_LOOKBACK = 8
DEFAULT_MARKER = "_SUCCESS"


def _has_marker(spark: SparkSession, folder: str, marker: str) -> bool:
    got = _hadoop_fs(spark, f"{folder.rstrip('/')}/{marker}")
    if got is None:
        raise ValueError("completion markers are hidden files, which need the JVM gateway to be seen")
    return got[0].exists(got[1])


def _last_change(spark: SparkSession, folder: str) -> int:
    """Newest modification time of a folder's files, hidden ones included, in ms."""
    fs, path = _hadoop_fs(spark, folder)
    return max([st.getModificationTime() for st in fs.listStatus(path)], default=0)


def complete_snapshot(spark: SparkSession, base: str, marker: str | None = None,
                      settle: float | None = None) -> tuple[str, list[str]]:
    """L4: the newest *finished* hour folder and its Parquet files.

    ``marker``: the file name an export writes last; the newest folder that
    holds it is taken. ``settle``: minutes without a change after which a
    folder counts as finished (for exports without a marker). With neither, a
    newest folder without ``_SUCCESS`` is passed over only if one of the
    ``MARKER_LOOKBACK`` newest folders has it (then the export does write it);
    where no folder does, the newest one is taken.
    """
    newest = newest_folders(spark, base, 1)
    if not newest:
        raise ValueError(f"{base} holds no snapshot folder")
    if marker is None and settle is None:
        if not newest[0][1] or _hadoop_fs(spark, base) is None or _has_marker(spark, newest[0][0], DEFAULT_MARKER):
            return newest[0]
        for folder, files in newest_folders(spark, base, MARKER_LOOKBACK)[1:]:
            if files and _has_marker(spark, folder, DEFAULT_MARKER):
                log.warning("snapshot folder %s has no %s and is taken for unfinished; reading %s",
                            newest[0][0], DEFAULT_MARKER, folder)
                return folder, files
        return newest[0]
    now, n, seen = time.time() * 1000, 4, 0
    while True:
        found = newest_folders(spark, base, n)
        for folder, files in found[seen:]:
            if files and (marker is None or _has_marker(spark, folder, marker)) and \
                    (settle is None or now - _last_change(spark, folder) >= settle * 60_000):
                return folder, files
        if len(found) < n:
            raise ValueError(f"{base} holds no finished snapshot folder")
        seen, n = len(found), n * 4


def read_full_snapshot(spark: SparkSession, base: str, schema: T.StructType,
                       mode: str = "latest_file", *, ignore_corrupt_files: bool = True,
                       with_order: bool = False, drift: str = "off",
                       skipped: list | None = None, marker: str | None = None,
                       settle: float | None = None) -> DataFrame:
    """The newest finished folder (:func:`complete_snapshot`); then its
    greatest file name (``latest_file``) or all its Parquet files
    (``latest_folder``)."""
    folder, files = complete_snapshot(spark, base, marker, settle)
    if not files:
        raise ValueError(f"snapshot folder {folder} holds no Parquet file")
    paths = files if mode == "latest_folder" else [max(files)]
    if len(files) > len(paths):
        log.warning("snapshot folder %s holds %d Parquet files; mode %s reads only %s",
                    folder, len(files), mode, paths[0])
    drop = screen_files(_paths_frame(spark, paths), schema, drift, skipped)
    return read_landing_folders(spark, [p for p in paths if p not in drop], drop.schema or schema,
                                ignore_corrupt_files=ignore_corrupt_files and not drop.unchecked,
                                with_order=with_order)
