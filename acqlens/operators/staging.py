"""Silver layer: cleaned, typed, de-duplicated and attributed source rows."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acqlens.functions.channel import is_paid, standardize_channel
from acqlens.functions.dates import plus_days, round_to_second
from acqlens.functions.skan import cv_band, is_crowd_anonymized
from acqlens.functions.taxonomy import INSTALL_EVENT, REVENUE_EVENTS
from acqlens.schemas import MONEY_COST, MONEY_EVENT

# Fixed value: an event later than this many days after the install is "late".
LATE_EVENT_DAYS = 21


def stg_appsflyer(raw_appsflyer: DataFrame) -> DataFrame:
    """Install directory: one row per device with canonical channel, geo and platform."""
    src = raw_appsflyer.filter(F.col("event_name") == INSTALL_EVENT)
    channel = standardize_channel("media_source")
    return src.select(
        "appsflyer_id",
        channel.alias("channel"),
        "campaign", "af_adset", "af_ad",
        round_to_second(F.col("install_time").cast("timestamp_ntz")).alias("install_time"),
        F.to_date(round_to_second(F.col("install_time").cast("timestamp_ntz"))).alias("install_date"),
        "attributed_touch_time", "attributed_touch_type",
        F.upper("country_code").alias("country_code"),
        F.lower("platform").alias("platform"),
    ).withColumn("is_paid", is_paid("channel"))


def stg_appsflyer_events(raw_appsflyer: DataFrame) -> DataFrame:
    """In-app revenue events as reported by the attribution provider."""
    src = raw_appsflyer.filter(F.col("event_name").isin(*REVENUE_EVENTS) & F.col("event_revenue").isNotNull())
    return src.select(
        "appsflyer_id",
        standardize_channel("media_source").alias("channel"),
        "campaign", "event_name",
        F.col("event_revenue").cast(MONEY_EVENT).alias("event_revenue"),
        round_to_second(F.col("event_time").cast("timestamp_ntz")).alias("event_time"),
        F.to_date(round_to_second(F.col("event_time").cast("timestamp_ntz"))).alias("event_date"),
        F.to_date("install_time").alias("install_date"),
        F.upper("country_code").alias("country_code"),
        F.lower("platform").alias("platform"),
    )


def stg_singular(raw_singular: DataFrame) -> DataFrame:
    """Network-reported daily spend; grain stays date x channel x campaign x country."""
    return raw_singular.select(
        F.col("date").cast("date").alias("spend_date"),
        standardize_channel("source").alias("channel"),
        "campaign",
        F.upper("country").alias("country_code"),
        "impressions", "clicks",
        F.col("installs").alias("network_installs"),
        F.col("cost").cast(MONEY_COST).alias("cost"),
    )


def stg_skan(raw_skan: DataFrame) -> DataFrame:
    """Privacy postbacks; a withheld (NULL) conversion value is kept and banded 'unknown'."""
    return raw_skan.select(
        "ad_network_id",
        F.col("source_identifier").alias("campaign"),
        "conversion_value",
        is_crowd_anonymized("conversion_value").alias("is_crowd_anonymized"),
        cv_band("conversion_value").alias("cv_band"),
        "postback_sequence_index", "redownload",
    )


BACKEND_DEDUP_KEYS = ("user_id", "event", "event_time")


def is_late(event_time: str, install_time: str) -> Column:
    return F.col(install_time).isNotNull() & (F.col(event_time) > plus_days(install_time, LATE_EVENT_DAYS))


def backend_dedup(raw_backend: DataFrame, *also: Column) -> DataFrame:
    """One row per (user_id, event, event_time), keeping the highest revenue (NULL revenue last); ``also``:
    further aggregates over the rows that a kept row stands for.

    Written as a grouped ``max``: the keep-the-top-row rule of a ``row_number()`` window over these
    keys, but planned as a hash aggregate with a map-side partial step, so duplicate-heavy (hot)
    keys collapse before the shuffle.
    """
    rows = (raw_backend
            .select("user_id", "event", F.col("revenue").cast(MONEY_EVENT).alias("revenue"),
                    round_to_second(F.col("event_time").cast("timestamp_ntz")).alias("event_time"))
            .groupBy(*BACKEND_DEDUP_KEYS)
            .agg(F.max("revenue").alias("revenue"), *also))
    first = ["user_id", "event", "revenue", "event_time"]
    return rows.select(*first, *[c for c in rows.columns if c not in first])


def dedup_keep_top(df: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """General form for wide rows: ``row_number() over (partition by keys order by order_col desc
    nulls last) = 1``; Catalyst adds a partial WindowGroupLimit before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(F.col(order_col).desc_nulls_last())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def stg_backend(raw_backend: DataFrame, stg_appsflyer_df: DataFrame) -> DataFrame:
    """De-duplicated backend events, attributed through the install directory, with the late flag."""
    clean = backend_dedup(raw_backend)
    attribution = stg_appsflyer_df.select(
        "appsflyer_id", "channel", "campaign", "country_code", "platform", "install_time")
    joined = clean.join(attribution, clean.user_id == attribution.appsflyer_id, "left")
    return joined.select(
        "user_id", "event", "revenue", "event_time",
        F.to_date("event_time").alias("event_date"),
        "channel", "campaign", "country_code", "platform", "install_time",
        F.when(F.col("appsflyer_id").isNull(), 0).otherwise(1).alias("is_attributed"),
        F.when(is_late("event_time", "install_time"), 1).otherwise(0).alias("is_late_event"),
    )
