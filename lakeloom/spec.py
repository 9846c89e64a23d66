"""Table specifications.

A :class:`TableSpec` is the typed form of one table's load metadata: where the
rows come from, how they are keyed and ordered, which named transforms run, and
how the target is written. :meth:`TableSpec.from_dict` accepts the plain
dictionary form (``bronze_table`` / ``gold_table`` / ``dedup_cols`` /
``transform_config`` ...) so existing configuration lists keep working.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
import logging
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql.types import StructType

log = logging.getLogger("lakeloom.spec")

FULL = "FULL"
INCREMENTAL = "INCREMENTAL"
LOAD_TYPES = (FULL, INCREMENTAL)

# Names of the year / month / date columns written by DERIVE_YMD.
YMD_COLUMNS = ("year", "month", "date")

# The key names of the dictionary configuration form, as
# existing configuration lists spell them (table entry, then its
# "transform_config" entry). They are read as they are.
CONFIG_KEYS = (
    "bronze_table", "gold_table", "load_type", "table_category", "isLoad", "schema",
    "columns", "dedup_cols", "timestamp_col", "partition_timestamp_col", "partition_cols",
    "requires_transform", "transform_config",
)
TRANSFORM_CONFIG_KEYS = (
    "type", "cast_map", "alias_columns", "join_table", "join_key", "price_col", "sales_col",
)
# Default column names of the PRICE_REVENUE lookup (the price
# column, the fact's sales column, and the lookup column that decides the
# newest row) and the default table category.
DEFAULT_PRICE_COL = "price"
DEFAULT_SALES_COL = "daily_sales"
DEFAULT_ORDER_COL = "creation_timestamp"
DEFAULT_CATEGORY = "DIMENSION"

# Our own additions to the dictionary form (not in existing lists): optional
# per-table settings that map one to one onto TableSpec fields.
EXTRA_CONFIG_KEYS = (
    "tiebreak", "fixed_partition", "prune_partition_col", "date_watermark_col",
    "watermark_inclusive", "watermark_lookback", "schema_drift", "n_folders", "snapshot_mode",
    "buckets", "dedup_without_timestamp", "strict_cast", "on_unknown_transform", "update_op",
    "key_index", "stable_view", "hash_ranges", "catch_up", "late_days", "load_col", "arrival_col", "snapshot_marker", "snapshot_settle",
)
EXTRA_TRANSFORM_CONFIG_KEYS = ("order_col", "order_tiebreak")


@dataclass(frozen=True)
class LookupSpec:
    """Enrichment lookup for PRICE_REVENUE.

    ``table``: catalog name of the lookup (a table of the *target* layer).
    ``key``: join column present in both sides. ``price_col``: value copied
    from the lookup's newest row per key. ``sales_col``: fact column multiplied
    by that price. ``order_col``: the lookup column that decides "newest".
    ``tiebreak``: extra lookup columns (descending) that make ties deterministic.
    """

    table: str
    key: str
    price_col: str = DEFAULT_PRICE_COL
    sales_col: str = DEFAULT_SALES_COL
    order_col: str = DEFAULT_ORDER_COL
    tiebreak: tuple[str, ...] = ()


@dataclass(frozen=True)
class TableSpec:
    """Load metadata for one target table.

    Source side: ``source`` is a catalog table (clean hop) or the landing
    folder name under ``landing_base`` (raw hop, then ``schema`` is required).

    Row identity: ``key`` (business key), ``timestamp`` (newest wins; also the
    incremental watermark and the upsert guard column), ``tiebreak`` (extra
    descending order columns for equal timestamps).

    Target side: ``partition_cols`` for the written table, ``update_op``
    (``">"`` or ``">="``) for the upsert guard, ``buckets`` to bucket the
    target by ``key`` so later upserts read it without a shuffle,
    ``fixed_partition`` when a key's partition never changes (partitions
    derived from an immutable creation time), so an upsert rewrites the
    batch's partitions without scanning the target for its keys.
    """

    target: str
    source: str
    load_type: str = FULL
    category: str = DEFAULT_CATEGORY
    columns: tuple[str, ...] | None = None
    schema: StructType | None = None
    key: tuple[str, ...] = ()
    timestamp: str | None = None
    partition_timestamp: str | None = None
    partition_cols: tuple[str, ...] | None = None
    enabled: bool = True
    requires_transform: bool = True
    transforms: tuple[str, ...] = ()
    cast_map: tuple[tuple[str, str], ...] = ()
    alias_columns: tuple[tuple[str, str], ...] = ()
    lookup: LookupSpec | None = None
    tiebreak: tuple[str, ...] = ()
    update_op: str = ">"
    on_unknown_transform: str = "error"
    dedup_without_timestamp: bool = False
    strict_cast: bool = False
    # incremental filter options
    watermark_inclusive: bool = False
    watermark_lookback: str | None = None
    prune_partition_col: str | None = None
    date_watermark_col: str | None = None
    # landing options
    landing_base: str | None = None
    n_folders: int | None = 2
    catch_up: bool = True            # keep a ledger and read every file it does not hold
    late_days: int | None = None     # list only this many days before the newest folder (None: all)
    load_col: str | None = None      # raw: stamp rows with the number of the load that wrote them
    arrival_col: str | None = None   # clean: the source's load_col, used as the watermark
    snapshot_mode: str = "latest_file"
    snapshot_marker: str | None = None      # a file that only finished snapshot folders hold
    snapshot_settle: float | None = None    # minutes without a change that finish a folder
    ignore_corrupt_files: bool = True
    newest_file_wins: bool = True
    schema_drift: str = "error"      # footer check: off | report | exclude | error | widen (also the target)
    # target layout
    buckets: int | None = None
    fixed_partition: bool = False      # a key's partition never changes -> upsert scope "batch"
    key_index: bool = False            # keep bitmaps of the keys of each partition for upserts
    stable_view: bool = False          # readers' name is a view that one catalog call switches
    hash_ranges: int | None = None     # no partition columns: ranges of the key's hash (behind such a view)
    options: Mapping[str, Any] = field(default_factory=dict)

    def __post_init__(self):
        for name in ("key", "tiebreak", "transforms"):
            v = getattr(self, name)
            if isinstance(v, str):
                object.__setattr__(self, name, (v,))
            elif v is None:
                object.__setattr__(self, name, ())
            else:
                object.__setattr__(self, name, tuple(v))
        for name in ("columns", "partition_cols"):
            v = getattr(self, name)
            if v is not None:
                object.__setattr__(self, name, tuple(v) or None)
        for name in ("cast_map", "alias_columns"):
            v = getattr(self, name)
            if isinstance(v, Mapping):
                v = tuple(v.items())
            object.__setattr__(self, name, tuple(tuple(p) for p in (v or ())))
        if self.update_op not in (">", ">="):
            raise ValueError(f"update_op must be '>' or '>=', got {self.update_op!r}")
        if self.on_unknown_transform not in ("error", "skip"):
            raise ValueError("on_unknown_transform must be 'error' or 'skip'")
        if self.schema_drift not in ("off", "report", "exclude", "error", "widen"):
            raise ValueError("schema_drift must be off, report, exclude, error or widen")
        if self.snapshot_mode not in ("latest_file", "latest_folder"):
            raise ValueError("snapshot_mode must be 'latest_file' or 'latest_folder'")
        if self.hash_ranges and (self.partition_cols or self.buckets or not self.key):
            raise ValueError(f"{self.target}: hash_ranges need a key, and neither partition_cols nor buckets")
        if self.load_type == INCREMENTAL and not (self.key and self.timestamp):
            raise ValueError(
                f"{self.target}: an INCREMENTAL load needs both key and timestamp")

    # -- derived properties -------------------------------------------------
    @property
    def ymd_source(self) -> str | None:
        """Column DERIVE_YMD reads: partition timestamp, else timestamp."""
        return self.partition_timestamp or self.timestamp

    @property
    def active_transforms(self) -> tuple[str, ...]:
        return self.transforms if self.requires_transform else ()

    @property
    def dedups(self) -> bool:
        """Latest-row-per-key runs only with both a key and a timestamp."""
        return bool(self.key) and bool(self.timestamp)

    def with_(self, **changes) -> TableSpec:
        return replace(self, **changes)

    # -- dictionary form ------------------------------------------------------
    @classmethod
    def from_dict(cls, cfg: Mapping[str, Any], *, source_db: str | None = None,
                  target_db: str | None = None, landing_base: str | None = None,
                  **overrides) -> TableSpec:
        """Build a spec from the dictionary configuration form.

        With ``gold_table`` present the entry describes the clean hop (source
        is the raw table, guard ``>``); otherwise the raw hop (source is the
        landing folder ``{landing_base}/{bronze_table}``, guard ``>=``, and the
        table is partitioned by year/month/date when a partition timestamp is
        set).
        """
        unknown = sorted(set(cfg) - set(CONFIG_KEYS) - set(EXTRA_CONFIG_KEYS))
        tc = dict(cfg.get("transform_config") or {})
        unknown += sorted(f"transform_config.{k}" for k in
                          set(tc) - set(TRANSFORM_CONFIG_KEYS) - set(EXTRA_TRANSFORM_CONFIG_KEYS))
        if unknown:
            log.warning("%s: configuration keys not understood, ignored: %s",
                        cfg.get("gold_table") or cfg.get("bronze_table"), unknown)
        types = tc.get("type") or ()
        if isinstance(types, str):
            types = (types,)
        lookup = None
        if "PRICE_REVENUE" in types or tc.get("join_table"):
            jt = tc["join_table"]
            lookup = LookupSpec(
                table=f"{target_db}.{jt}" if target_db else jt,
                key=tc["join_key"], price_col=tc.get("price_col", DEFAULT_PRICE_COL),
                sales_col=tc.get("sales_col", DEFAULT_SALES_COL),
                order_col=tc.get("order_col", DEFAULT_ORDER_COL),
                tiebreak=tuple(tc.get("order_tiebreak") or ()))
        clean = "gold_table" in cfg
        bronze = cfg["bronze_table"]
        pts = cfg.get("partition_timestamp_col")
        if clean:
            target = cfg["gold_table"]
            source = f"{source_db}.{bronze}" if source_db else bronze
            parts = cfg.get("partition_cols")
            op = ">"
        else:
            target = bronze
            source = bronze
            parts = YMD_COLUMNS if pts else None
            op = ">="
        kw = dict(
            target=f"{target_db}.{target}" if target_db else target,
            source=source,
            load_type=cfg.get("load_type", FULL),
            category=cfg.get("table_category", DEFAULT_CATEGORY),
            columns=cfg.get("columns"),
            schema=cfg.get("schema"),
            key=tuple(cfg.get("dedup_cols") or ()),
            timestamp=cfg.get("timestamp_col"),
            partition_timestamp=pts,
            partition_cols=parts,
            enabled=cfg.get("isLoad", True),
            requires_transform=cfg.get("requires_transform", False),
            transforms=tuple(types),
            cast_map=tuple((tc.get("cast_map") or {}).items()),
            alias_columns=tuple((tc.get("alias_columns") or {}).items()),
            lookup=lookup,
            update_op=op,
            landing_base=landing_base,
        )
        kw.update({k: cfg[k] for k in EXTRA_CONFIG_KEYS if k in cfg})
        kw.update(overrides)
        return cls(**kw)


def as_spec(obj: TableSpec | Mapping[str, Any], **kw) -> TableSpec:
    return obj if isinstance(obj, TableSpec) else TableSpec.from_dict(obj, **kw)


def as_tuple(v: str | Sequence[str] | None) -> tuple[str, ...]:
    if v is None:
        return ()
    if isinstance(v, str):
        return (v,)
    return tuple(v)
