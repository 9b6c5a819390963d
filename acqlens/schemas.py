"""Typed contracts of the four raw (bronze) sources."""
from __future__ import annotations

from pyspark.sql.types import (DateType, DecimalType, IntegerType, ShortType, StringType, StructField,
                               StructType, TimestampNTZType)

MONEY_EVENT = DecimalType(12, 2)   # event / backend revenue
MONEY_COST = DecimalType(14, 2)    # spend cost, deltas
MONEY_SUM = DecimalType(38, 2)     # any sum of money in a mart

RAW_APPSFLYER = StructType([
    StructField("appsflyer_id", StringType(), False),
    StructField("media_source", StringType()),
    StructField("campaign", StringType()),
    StructField("af_adset", StringType()),
    StructField("af_ad", StringType()),
    StructField("install_time", TimestampNTZType()),
    StructField("attributed_touch_time", TimestampNTZType()),
    StructField("attributed_touch_type", StringType()),
    StructField("event_name", StringType()),
    StructField("event_revenue", MONEY_EVENT),
    StructField("event_time", TimestampNTZType()),
    StructField("country_code", StringType()),
    StructField("platform", StringType()),
])

RAW_SINGULAR = StructType([
    StructField("date", DateType(), False),
    StructField("source", StringType()),
    StructField("campaign", StringType()),
    StructField("country", StringType()),
    StructField("impressions", IntegerType()),
    StructField("clicks", IntegerType()),
    StructField("installs", IntegerType()),
    StructField("cost", MONEY_COST),
])

RAW_SKAN = StructType([
    StructField("ad_network_id", StringType()),
    StructField("source_identifier", StringType()),
    StructField("conversion_value", ShortType()),
    StructField("postback_sequence_index", ShortType()),
    StructField("redownload", IntegerType()),
])

RAW_BACKEND = StructType([
    StructField("user_id", StringType(), False),
    StructField("event", StringType()),
    StructField("revenue", MONEY_EVENT),
    StructField("event_time", TimestampNTZType()),
])

LOADED_AT = "_loaded_at"
