"""Channel canonicalisation (media source / network source -> canonical channel)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Alias spellings per canonical channel, compared after lower(trim(x)).
# They must equal the reference's vocabulary for identical results.
CHANNEL_ALIASES: dict[str, tuple[str, ...]] = {
    "Meta": ("meta", "facebook", "facebook ads", "fb", "instagram"),
    "Google Ads": ("google ads", "googleadwords", "google", "adwords", "uac"),
    "TikTok": ("tiktok", "tiktok ads", "bytedance"),
    "Apple Search Ads": ("apple search ads", "asa", "apple"),
    "organic": ("organic", "", "none"),
}
ORGANIC = "organic"
CANONICAL_CHANNELS = ("Meta", "Google Ads", "TikTok", "Apple Search Ads", "organic")

# Channel -> channel type of the channel dimension.
CHANNEL_TYPES: dict[str, str] = {
    "organic": "Organic",
    "Apple Search Ads": "Search",
    "Google Ads": "Search/Display",
    "Meta": "Social",
    "TikTok": "Social",
}
OTHER_CHANNEL_TYPE = "Other"


def standardize_channel(col: Column | str) -> Column:
    """Canonical channel name; NULL/blank/'none' -> organic; unknown names pass through unchanged."""
    c = F.col(col) if isinstance(col, str) else col
    norm = F.lower(F.trim(c))
    out = None
    for canonical, aliases in CHANNEL_ALIASES.items():
        cond = norm.isin(*aliases)
        if canonical == ORGANIC:
            cond = cond | c.isNull()
        out = F.when(cond, F.lit(canonical)) if out is None else out.when(cond, F.lit(canonical))
    return out.otherwise(c)


def is_paid(channel: Column | str) -> Column:
    c = F.col(channel) if isinstance(channel, str) else channel
    return F.when(c == ORGANIC, 0).otherwise(1)


def channel_type(channel: Column | str) -> Column:
    c = F.col(channel) if isinstance(channel, str) else channel
    out = None
    for ch, kind in CHANNEL_TYPES.items():
        out = F.when(c == ch, kind) if out is None else out.when(c == ch, kind)
    return out.otherwise(OTHER_CHANNEL_TYPE)
