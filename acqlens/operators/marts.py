"""Gold marts: unified daily view, retention cohorts, growth metrics, privacy ROAS gap.

Every input is pre-aggregated to the join grain before joining (no fan-out; partial aggregation
happens map-side), and ratios go through the guarded exact-decimal helper.
"""
from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acqlens.functions.dates import day_diff
from acqlens.functions.keys import campaign_key
from acqlens.functions.ratios import ratio
from acqlens.functions.skan import CONVERSION_BANDS
from acqlens.operators.unions import stack, tagged
from acqlens.schemas import MONEY_SUM

# Naive D30 -> D90 lifetime-value extrapolation factor (a parameter of the growth mart),
# the cohort revenue windows in days since install (inclusive), and the retention days.
LTV_D30_TO_D90 = Decimal("1.4")
COHORT_WINDOWS = (7, 30)
RETENTION_DAYS = (1, 7, 30)
UNIFIED_KEYS = ("activity_date", "channel_key", "campaign_key", "country_code")


def _sum0(c: str):
    return F.coalesce(F.col(c), F.lit(0))


def mart_marketing_unified(fct_spend_df: DataFrame, fct_installs_df: DataFrame,
                           fct_events_df: DataFrame) -> DataFrame:
    """Spend, installs and revenue on one grain (date x channel x campaign x country).

    A tagged union: the three sources are stacked, each with its own measures, and grouped once, so the
    sources meet in one aggregation instead of two full outer joins of three. A key tuple with a NULL part
    stays one row per source, as it would in the joins.
    """
    keys = list(UNIFIED_KEYS)
    rows = stack([
        tagged(fct_spend_df.withColumnRenamed("spend_date", "activity_date"), "spend", keys,
               "impressions", "clicks", "network_installs", "cost"),
        tagged(fct_installs_df.withColumnRenamed("install_date", "activity_date"), "installs", keys, "install_count"),
        tagged(fct_events_df.withColumnRenamed("event_date", "activity_date"), "events", keys,
               "event_revenue", "event_count", "appsflyer_id")])
    u = rows.groupBy(*keys, "_apart").agg(
        *[F.sum(c).alias(c) for c in ("impressions", "clicks", "network_installs", "cost")],
        F.sum("install_count").alias("installs"), F.sum("event_revenue").alias("revenue"),
        F.sum("event_count").alias("revenue_events"), F.countDistinct("appsflyer_id").alias("paying_users"))
    u = u.select(*keys, *[_sum0(c).alias(c) for c in u.columns if c not in (*keys, "_apart")])
    return u.select(
        *keys,
        *[F.col(c).cast("bigint").alias(c) for c in ("impressions", "clicks", "network_installs")],
        F.col("cost").cast(MONEY_SUM).alias("cost"), F.col("installs").cast("bigint").alias("installs"),
        F.col("revenue").cast(MONEY_SUM).alias("revenue"),
        *[F.col(c).cast("bigint").alias(c) for c in ("revenue_events", "paying_users")],
        ratio(F.col("cost"), F.col("installs"), 12, 2).alias("cpi"),
        ratio(F.col("revenue"), F.col("cost"), 12, 4).alias("roas"),
    )


def last_activity_day(backend_rows: DataFrame) -> DataFrame:
    """Last backend activity date per user, aggregated map-side first (a user with a huge share of the
    events collapses to one row per task before the shuffle)."""
    return (backend_rows.groupBy("user_id")
            .agg(F.max(F.to_date("event_time")).alias("last_day")))


def mart_retention(backend_rows: DataFrame, fct_installs_df: DataFrame) -> DataFrame:
    """D1/D7/D30 retention per (channel, install date); denominator = every install.

    A device is retained at day N when its last attributed backend activity is at least N days after
    the install date. The last activity is taken per user before joining the install directory (one
    row per device), which is the same as the per-event offsets' maximum because the install date is
    fixed per device; backend rows of unknown users simply find no install.
    """
    last = last_activity_day(backend_rows)
    cohort = (fct_installs_df.select("appsflyer_id", F.col("channel_key").alias("channel"), "install_date")
              .join(last, F.col("appsflyer_id") == last.user_id, "left")
              .select("channel", "install_date", day_diff("install_date", "last_day").alias("max_day")))
    retained = {n: F.sum(F.when(F.col("max_day") >= n, 1).otherwise(0)) for n in RETENTION_DAYS}
    agg = cohort.groupBy("channel", "install_date").agg(
        F.count(F.lit(1)).alias("cohort_size"),
        *[retained[n].cast("bigint").alias(f"retained_d{n}") for n in RETENTION_DAYS])
    return agg.select(
        "channel", "install_date", "cohort_size",
        *[f"retained_d{n}" for n in RETENTION_DAYS],
        *[ratio(F.col(f"retained_d{n}") * 100, F.col("cohort_size"), 6, 2).alias(f"retention_d{n}_pct")
          for n in RETENTION_DAYS])


def campaign_installs(fct_installs_df: DataFrame) -> DataFrame:
    return (fct_installs_df.groupBy("channel_key", "campaign_key")
            .agg(F.max("campaign").alias("campaign"), F.count(F.lit(1)).alias("installs"),
                 F.sum(F.when(F.col("platform") == "ios", 1).otherwise(0)).alias("ios_installs")))


def device_days(fct_events_df: DataFrame) -> DataFrame:
    """Attributed revenue per device and day: the pre-aggregate that the cohort marts and the revenue totals
    share (a device with a huge share of the events is one row per active day from here on)."""
    return fct_events_df.groupBy("appsflyer_id", "event_date").agg(F.sum("event_revenue").alias("event_revenue"))


def cohort_days(fct_installs_df: DataFrame, days: DataFrame) -> DataFrame:
    """``device_days`` tied to the device's acquisition cohort, with the day offset from install."""
    i = fct_installs_df.select("appsflyer_id", "channel_key", "campaign_key", "install_date")
    return i.join(days, "appsflyer_id", "inner").select(
        "channel_key", "campaign_key", "appsflyer_id", "event_revenue",
        day_diff("install_date", "event_date").alias("day_n"))


def _within(n: int):
    return F.when(F.col("day_n").between(0, n), F.col("event_revenue"))


def cohort_revenue(fct_installs_df: DataFrame, days: DataFrame) -> DataFrame:
    return cohort_days(fct_installs_df, days).groupBy("channel_key", "campaign_key").agg(
        F.sum("event_revenue").alias("revenue_total"),
        *[F.coalesce(F.sum(_within(n)), F.lit(0)).alias(f"revenue_d{n}") for n in COHORT_WINDOWS],
        F.countDistinct("appsflyer_id").alias("paying_users"))


def skan_by_campaign(stg_skan_df: DataFrame) -> DataFrame:
    band = F.col("cv_band")
    return stg_skan_df.groupBy("campaign").agg(
        F.count(F.lit(1)).alias("skan_postbacks"),
        F.sum(F.when(band.isin(*CONVERSION_BANDS), 1).otherwise(0)).alias("skan_conversions"),
        F.sum(F.when(band == "high", 1).otherwise(0)).alias("skan_high_value"),
        F.sum("is_crowd_anonymized").alias("skan_null_cv"))


def campaign_totals(fct_installs_df: DataFrame, days: DataFrame, fct_spend_df: DataFrame) -> DataFrame:
    """Installs, cost and cohort revenue of every channel x campaign that has installs: the three sources
    stacked and grouped once. ``cost``, ``revenue_*`` and ``paying_users`` are NULL where that source has no
    rows (a NULL key part, which no join would match, keeps its rows apart)."""
    keys = ["channel_key", "campaign_key"]
    rows = stack([
        tagged(fct_installs_df, "installs", keys, F.lit(1).alias("install"), "campaign",
               F.when(F.col("platform") == "ios", 1).otherwise(0).alias("ios")),
        tagged(fct_spend_df, "spend", keys, "cost"),
        tagged(cohort_days(fct_installs_df, days), "revenue", keys, F.col("appsflyer_id").alias("payer"), "event_revenue",
               *[_within(n).alias(f"revenue_d{n}") for n in COHORT_WINDOWS])])
    return rows.groupBy(*keys, "_apart").agg(
        F.max("campaign").alias("campaign"), F.count("install").alias("installs"), F.sum("ios").alias("ios_installs"),
        F.sum("cost").alias("cost"), F.sum("event_revenue").alias("revenue_total"),
        *[F.sum(f"revenue_d{n}").alias(f"revenue_d{n}") for n in COHORT_WINDOWS],
        F.countDistinct("payer").alias("paying_users")).filter("installs > 0").drop("_apart")


def mart_growth_metrics(fct_installs_df: DataFrame, days: DataFrame, fct_spend_df: DataFrame,
                        stg_skan_df: DataFrame, ltv_factor: Decimal = LTV_D30_TO_D90) -> DataFrame:
    """CPI, CAC, ROAS D7/D30, ARPU/ARPPU and naive LTV per channel x campaign, beside SKAN counts.
    ``days``: the device-day revenue (``device_days``).

    Install-driven: campaigns with spend but no installs do not appear. Postbacks join on the
    campaign name only.
    """
    return growth_ratios(campaign_totals(fct_installs_df, days, fct_spend_df), skan_by_campaign(stg_skan_df), ltv_factor)


def growth_ratios(totals: DataFrame, skan: DataFrame, ltv_factor: Decimal = LTV_D30_TO_D90) -> DataFrame:
    """The growth mart from additive totals per campaign and postback counts per campaign name."""
    # a window without revenue of a campaign with payers is 0; without payers it stays NULL, and so do ratios
    had = F.col("paying_users") > 0
    t = totals.select(
        "channel_key", "campaign_key", "campaign", "installs", "ios_installs", F.col("cost").alias("sp_cost"),
        "revenue_total", *[F.when(had, _sum0(f"revenue_d{n}")).alias(f"revenue_d{n}") for n in COHORT_WINDOWS],
        F.when(had, F.col("paying_users")).alias("r_payers"))
    j = t.join(skan.withColumnRenamed("campaign", "sk_campaign"), F.col("campaign") == F.col("sk_campaign"), "left")
    cost, installs, payers = F.col("sp_cost"), F.col("installs"), F.col("r_payers")
    return j.select(
        "channel_key", "campaign_key", "campaign",
        _sum0("sp_cost").cast(MONEY_SUM).alias("cost"),
        installs.cast("bigint").alias("installs"),
        F.col("ios_installs").cast("bigint").alias("ios_installs"),
        _sum0("r_payers").cast("bigint").alias("paying_users"),
        _sum0("revenue_total").cast(MONEY_SUM).alias("revenue_total"),
        _sum0("revenue_d7").cast(MONEY_SUM).alias("revenue_d7"),
        _sum0("revenue_d30").cast(MONEY_SUM).alias("revenue_d30"),
        ratio(cost, installs, 12, 2, when=(installs > 0) & (cost > 0)).alias("cpi"),
        ratio(cost, payers, 12, 2, when=(payers > 0) & (cost > 0)).alias("cac"),
        ratio(F.col("revenue_d7"), cost, 12, 4).alias("roas_d7"),
        ratio(F.col("revenue_d30"), cost, 12, 4).alias("roas_d30"),
        ratio(F.col("revenue_total"), installs, 12, 2).alias("arpu"),
        ratio(F.col("revenue_total"), payers, 12, 2).alias("arppu"),
        ratio(F.col("revenue_d30") * F.lit(ltv_factor), installs, 12, 2).alias("predicted_ltv_d90"),
        *[_sum0(c).cast("bigint").alias(c)
          for c in ("skan_postbacks", "skan_conversions", "skan_high_value", "skan_null_cv")],
    )


def backend_cohort_d30(stg_backend_df: DataFrame) -> DataFrame:
    """Backend-confirmed revenue within 30 days of install per channel x campaign."""
    d30 = day_diff("install_time", "event_time").between(0, COHORT_WINDOWS[-1])
    return (stg_backend_df.filter((F.col("is_attributed") == 1) & F.col("install_time").isNotNull())
            .groupBy("channel", "campaign")
            .agg(F.sum(F.when(d30, F.col("revenue")).otherwise(0)).alias("backend_revenue_d30"))
            .select(F.col("channel").alias("channel_key"), campaign_key("channel", "campaign").alias("campaign_key"),
                    "backend_revenue_d30"))


def mart_privacy_roas_gap(growth: DataFrame, stg_backend_df: DataFrame) -> DataFrame:
    """MMP vs backend vs SKAN per campaign: ROAS gap, overstatement %, crowd-anonymity signal."""
    return privacy_gap(growth, backend_cohort_d30(stg_backend_df))


def privacy_gap(growth: DataFrame, confirmed: DataFrame) -> DataFrame:
    """The privacy mart from the growth mart and the backend's 30-day revenue per channel x campaign."""
    j = growth.join(confirmed, ["channel_key", "campaign_key"], "left")
    cost, mmp = F.col("cost"), F.col("revenue_d30")
    back = F.coalesce(F.col("backend_revenue_d30"), F.lit(0))
    null_cv, posts = F.col("skan_null_cv"), F.col("skan_postbacks")
    return j.select(
        "channel_key", "campaign_key", "campaign", "cost", "installs", "ios_installs",
        mmp.alias("mmp_revenue_d30"),
        back.cast(MONEY_SUM).alias("backend_revenue_d30"),
        F.col("roas_d30").alias("mmp_roas_d30"),
        ratio(back, cost, 12, 4).alias("backend_roas_d30"),
        ratio(mmp - back, cost, 12, 4).alias("roas_gap"),
        ratio((mmp - back) * 100, mmp, 8, 2).alias("revenue_overstatement_pct"),
        "skan_postbacks", "skan_conversions", "skan_high_value", "skan_null_cv",
        F.when(null_cv > 0, 1).otherwise(0).alias("has_crowd_anonymity"),
        ratio(null_cv * 100, posts, 6, 2).alias("skan_null_cv_pct"),
    )
