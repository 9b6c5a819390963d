"""Dimensions of the star schema (channel, campaign, geo, date)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acqlens.functions.channel import channel_type, is_paid
from acqlens.functions.dates import is_weekend, us_week_of_year

# Country names (Slovenian, as the reference's dimension labels them) and the region.
COUNTRY_NAMES = {
    "SI": "Slovenija",
    "DE": "Nemčija",
    "AT": "Avstrija",
    "HR": "Hrvaška",
    "IT": "Italija",
}
REGION = "EU"


def dim_channel(stg_installs: DataFrame, stg_spend: DataFrame) -> DataFrame:
    channels = (stg_installs.select("channel").unionByName(stg_spend.select("channel"))
                .filter(F.col("channel").isNotNull()).distinct())
    return channels.select(
        F.col("channel").alias("channel_key"), "channel",
        is_paid("channel").alias("is_paid"),
        channel_type("channel").alias("channel_type"))


def dim_campaign(stg_installs: DataFrame, stg_spend: DataFrame) -> DataFrame:
    campaigns = (stg_installs.select("channel", "campaign")
                 .unionByName(stg_spend.select("channel", "campaign"))
                 .filter(F.col("campaign").isNotNull()).distinct())
    return campaigns.select(
        F.concat("channel", F.lit("|"), "campaign").alias("campaign_key"),
        "channel", "campaign", is_paid("channel").alias("is_paid"))


def country_name(code: str = "country_code"):
    c = F.col(code)
    out = None
    for k, v in COUNTRY_NAMES.items():
        out = F.when(c == k, v) if out is None else out.when(c == k, v)
    return out.otherwise(c)


def dim_geo(stg_installs: DataFrame, stg_spend: DataFrame) -> DataFrame:
    geos = (stg_installs.select("country_code").unionByName(stg_spend.select("country_code"))
            .filter(F.col("country_code").isNotNull()).distinct())
    return geos.select("country_code", country_name().alias("country_name"), F.lit(REGION).alias("region"))


def activity_bounds(stg_installs: DataFrame, stg_events: DataFrame, backend_times: DataFrame,
                    stg_spend: DataFrame) -> DataFrame:
    """One row (min_d, max_d) over every activity date of the four sources."""
    days = (stg_installs.select(F.to_date("install_time").alias("d"))
            .unionByName(stg_events.select(F.to_date("event_time").alias("d")))
            .unionByName(backend_times.select(F.to_date("event_time").alias("d")))
            .unionByName(stg_spend.select(F.col("spend_date").alias("d"))))
    return days.agg(F.min("d").alias("min_d"), F.max("d").alias("max_d"))


def date_spine(bounds: DataFrame) -> DataFrame:
    """Gap-free days from min_d to max_d: one input row expands to one row per day."""
    return (bounds.filter(F.col("min_d").isNotNull())
            .select(F.explode(F.sequence("min_d", "max_d", F.expr("INTERVAL 1 DAY"))).alias("date_day")))


def calendar_columns(spine: DataFrame) -> DataFrame:
    d = F.col("date_day")
    return spine.select(
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        us_week_of_year(d).alias("week_of_year"),
        is_weekend(d).alias("is_weekend"),
    )


def dim_date(stg_installs: DataFrame, stg_events: DataFrame, backend_times: DataFrame,
             stg_spend: DataFrame) -> DataFrame:
    """Calendar over the observed activity range.

    ``backend_times`` is any frame with the backend ``event_time`` column; min/max are the same on the
    raw, de-duplicated or attributed backend rows, so the cheapest one can be passed.
    """
    return calendar_columns(date_spine(activity_bounds(stg_installs, stg_events, backend_times, stg_spend)))
