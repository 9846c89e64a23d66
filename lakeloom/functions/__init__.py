"""Column transforms (CAST_COLUMNS, ALIAS_COLUMNS, DERIVE_YMD) and the
named-transform registry that applies them in configured order."""

from lakeloom.functions.transforms import (
    TRANSFORMS,
    alias_columns,
    apply_transforms,
    cast_columns,
    derive_ymd,
    register_transform,
    transform_writes,
)

__all__ = [
    "TRANSFORMS", "alias_columns", "apply_transforms", "cast_columns", "derive_ymd",
    "register_transform", "transform_writes",
]
