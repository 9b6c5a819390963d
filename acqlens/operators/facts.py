"""Fact tables keyed onto the dimensions."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acqlens.functions.keys import campaign_key


def fct_installs(stg_installs: DataFrame) -> DataFrame:
    return stg_installs.select(
        "appsflyer_id",
        F.col("channel").alias("channel_key"),
        campaign_key("channel", "campaign").alias("campaign_key"),
        "campaign", "country_code", "install_date", "platform", "is_paid",
        F.lit(1).alias("install_count"))


def fct_events(stg_events: DataFrame) -> DataFrame:
    return stg_events.select(
        "appsflyer_id",
        F.col("channel").alias("channel_key"),
        campaign_key("channel", "campaign").alias("campaign_key"),
        "country_code", "event_date", "event_name", "platform", "event_revenue",
        F.lit(1).alias("event_count"),
        F.when(F.col("event_name") == "af_purchase", 1).otherwise(0).alias("is_purchase"),
        F.when(F.col("event_name") == "af_subscribe", 1).otherwise(0).alias("is_subscribe"))


def fct_spend(stg_spend: DataFrame) -> DataFrame:
    return stg_spend.select(
        "spend_date",
        F.col("channel").alias("channel_key"),
        campaign_key("channel", "campaign").alias("campaign_key"),
        "country_code", "impressions", "clicks", "network_installs", "cost")
