"""Relational operators of a load: dedup, enrichment, watermark, upsert."""

from lakeloom.operators.dedup import latest_per_key, latest_value, normalise_timestamp
from lakeloom.operators.enrich import price_revenue
from lakeloom.operators.upsert import action_counts, guarded_upsert
from lakeloom.operators.watermark import (
    after_date_watermark,
    after_watermark,
    high_watermark,
    watermark_frame,
)

__all__ = [
    "action_counts", "after_date_watermark", "after_watermark", "guarded_upsert",
    "high_watermark", "latest_per_key", "latest_value", "normalise_timestamp",
    "price_revenue", "watermark_frame",
]
