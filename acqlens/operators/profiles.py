"""Small profiling queries over single operators (channel mapping, taxonomy, bands, payers, LTV)."""
from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acqlens.functions.channel import standardize_channel
from acqlens.functions.ratios import ratio
from acqlens.functions.taxonomy import to_backend_event
from acqlens.operators.marts import LTV_D30_TO_D90, campaign_installs, cohort_revenue
from acqlens.schemas import MONEY_SUM


def channel_mapping(raw_appsflyer: DataFrame, raw_singular: DataFrame) -> DataFrame:
    """Every raw source spelling seen in attribution and spend rows, its canonical channel, row count."""
    spellings = (raw_appsflyer.select(F.col("media_source").alias("raw_value"))
                 .unionByName(raw_singular.select(F.col("source").alias("raw_value"))))
    return (spellings.groupBy("raw_value").agg(F.count(F.lit(1)).alias("row_count"))
            .select("raw_value", standardize_channel("raw_value").alias("channel"), "row_count"))


def event_taxonomy_reconcile(stg_events: DataFrame, stg_backend_df: DataFrame) -> DataFrame:
    """MMP revenue events mapped onto backend names, compared with attributed backend events by type."""
    mmp = (stg_events.select(to_backend_event("event_name").alias("event"), "event_revenue")
           .groupBy("event").agg(F.count(F.lit(1)).alias("mmp_events"), F.sum("event_revenue").alias("mmp_revenue")))
    back = (stg_backend_df.filter(F.col("is_attributed") == 1).groupBy("event")
            .agg(F.count(F.lit(1)).alias("backend_events"), F.sum("revenue").alias("backend_revenue")))
    j = mmp.join(back, on="event", how="full")
    return j.select(
        "event",
        F.coalesce("mmp_events", F.lit(0)).cast("bigint").alias("mmp_events"),
        F.coalesce("mmp_revenue", F.lit(0)).cast(MONEY_SUM).alias("mmp_revenue"),
        F.coalesce("backend_events", F.lit(0)).cast("bigint").alias("backend_events"),
        F.coalesce("backend_revenue", F.lit(0)).cast(MONEY_SUM).alias("backend_revenue"))


def cv_band_distribution(stg_skan_df: DataFrame) -> DataFrame:
    return stg_skan_df.groupBy("cv_band").agg(
        F.count(F.lit(1)).alias("postbacks"),
        F.min("conversion_value").cast("int").alias("min_value"),
        F.max("conversion_value").cast("int").alias("max_value"))


def daily_paying_users(fct_events_df: DataFrame) -> DataFrame:
    """Distinct paying devices per day and channel (not additive across days)."""
    return fct_events_df.groupBy(F.col("event_date").alias("activity_date"), "channel_key").agg(
        F.countDistinct("appsflyer_id").alias("paying_users"),
        F.sum("event_count").cast("bigint").alias("revenue_events"),
        F.sum("event_revenue").cast(MONEY_SUM).alias("revenue"))


def cohort_revenue_report(fct_installs_df: DataFrame, days: DataFrame) -> DataFrame:
    r = cohort_revenue(fct_installs_df, days)
    return r.select("channel_key", "campaign_key",
                    *[F.col(c).cast(MONEY_SUM).alias(c) for c in ("revenue_total", "revenue_d7", "revenue_d30")],
                    F.col("paying_users").cast("bigint").alias("paying_users"))


def ltv_projection(fct_installs_df: DataFrame, days: DataFrame,
                   factor: Decimal = LTV_D30_TO_D90) -> DataFrame:
    """D30 ARPU per campaign and the naive D90 LTV = D30 ARPU x factor (factor is a parameter)."""
    ia = campaign_installs(fct_installs_df).select("channel_key", "campaign_key", "installs")
    rv = cohort_revenue(fct_installs_df, days).select("channel_key", "campaign_key", "revenue_d30")
    j = ia.join(rv, ["channel_key", "campaign_key"], "left")
    rev = F.coalesce(F.col("revenue_d30"), F.lit(0))
    return j.select(
        "channel_key", "campaign_key", F.col("installs").cast("bigint").alias("installs"),
        rev.cast(MONEY_SUM).alias("revenue_d30"),
        ratio(rev, F.col("installs"), 12, 2).alias("arpu_d30"),
        F.lit(factor).cast("decimal(6,2)").alias("ltv_factor"),
        ratio(rev * F.lit(factor), F.col("installs"), 12, 2).alias("predicted_ltv_d90"))
