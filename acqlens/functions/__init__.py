"""Column-level building blocks (all built-in Spark expressions, no UDFs)."""
from acqlens.functions.channel import (CANONICAL_CHANNELS, CHANNEL_ALIASES, CHANNEL_TYPES, ORGANIC,
                                       channel_type, is_paid, standardize_channel)
from acqlens.functions.dates import (day_diff, is_weekend, ntz, plus_days, plus_minutes, to_second,
                                     us_week_of_year)
from acqlens.functions.keys import campaign_key
from acqlens.functions.ratios import nullif_ratio, ratio
from acqlens.functions.skan import cv_band, is_crowd_anonymized
from acqlens.functions.taxonomy import to_backend_event

__all__ = [
    "CANONICAL_CHANNELS", "CHANNEL_ALIASES", "CHANNEL_TYPES", "ORGANIC", "campaign_key", "channel_type",
    "cv_band", "day_diff", "is_crowd_anonymized", "is_paid", "is_weekend", "ntz", "nullif_ratio",
    "plus_days", "plus_minutes", "ratio", "standardize_channel", "to_backend_event", "to_second",
    "us_week_of_year",
]
