"""Composite keys of the star schema."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def campaign_key(channel: Column | str, campaign: Column | str) -> Column:
    """``channel|campaign``; a NULL campaign contributes '' (so NULL -> 'organic|'), never a NULL key."""
    ch = F.col(channel) if isinstance(channel, str) else channel
    ca = F.col(campaign) if isinstance(campaign, str) else campaign
    return F.concat(ch, F.lit("|"), F.coalesce(ca, F.lit("")))
