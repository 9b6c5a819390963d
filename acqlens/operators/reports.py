"""Channel-level report queries over the marts (leaderboard, discrepancy, privacy, KPI row).

Ratios are re-aggregated as ratio-of-sums (never an average of ratios). The leaderboard sorts a
few rows per channel after aggregation; nothing is collected to the driver.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acqlens.functions.ratios import nullif_ratio, ratio
from acqlens.schemas import MONEY_SUM


def report_roas(growth: DataFrame) -> DataFrame:
    """Per channel: cost, installs, payers, D30 revenue, ROAS D30, CPI, CAC (NULL when dividing by 0)."""
    agg = growth.groupBy(F.col("channel_key").alias("channel")).agg(
        F.sum("cost").alias("cost"), F.sum("installs").alias("installs"),
        F.sum("paying_users").alias("paying_users"), F.sum("revenue_d30").alias("revenue_d30"))
    return agg.select(
        "channel",
        F.col("cost").cast(MONEY_SUM).alias("cost"),
        F.col("installs").cast("bigint").alias("installs"),
        F.col("paying_users").cast("bigint").alias("paying_users"),
        F.col("revenue_d30").cast(MONEY_SUM).alias("revenue_d30"),
        nullif_ratio(F.col("revenue_d30"), F.col("cost"), 10, 4).alias("roas_d30"),
        nullif_ratio(F.col("cost"), F.col("installs"), 10, 2).alias("cpi"),
        nullif_ratio(F.col("cost"), F.col("paying_users"), 10, 2).alias("cac"),
    ).orderBy(F.col("roas_d30").desc_nulls_last())


def report_roas_paid(growth: DataFrame) -> DataFrame:
    """Leaderboard restricted to channels with a defined ROAS (paid channels)."""
    return report_roas(growth).filter(F.col("roas_d30").isNotNull())


def report_discrepancy(rec: DataFrame) -> DataFrame:
    return (rec.groupBy("channel").agg(
        F.sum("mmp_revenue").cast(MONEY_SUM).alias("mmp_revenue"),
        F.sum("backend_revenue").cast(MONEY_SUM).alias("backend_revenue"),
        F.sum(F.when(F.col("is_discrepancy_flag") == 1, 1).otherwise(0)).cast("bigint").alias("flagged_days"),
        F.count(F.lit(1)).alias("total_days"))
        .orderBy(F.col("mmp_revenue").desc_nulls_last()))


def report_privacy(privacy: DataFrame) -> DataFrame:
    agg = privacy.groupBy(F.col("channel_key").alias("channel")).agg(
        F.sum("installs").alias("installs"), F.sum("ios_installs").alias("ios_installs"),
        F.sum("skan_postbacks").alias("skan_postbacks"), F.sum("skan_null_cv").alias("skan_null_cv"),
        F.sum("has_crowd_anonymity").alias("campaigns_anonymized"),
        F.sum("mmp_revenue_d30").alias("mmp"), F.sum("backend_revenue_d30").alias("backend"),
        F.sum("cost").alias("cost"))
    return agg.select(
        "channel",
        *[F.col(c).cast("bigint").alias(c)
          for c in ("installs", "ios_installs", "skan_postbacks", "skan_null_cv", "campaigns_anonymized")],
        nullif_ratio(F.col("mmp"), F.col("cost"), 10, 4).alias("mmp_roas"),
        nullif_ratio(F.col("backend"), F.col("cost"), 10, 4).alias("backend_roas"),
    ).orderBy(F.col("installs").desc())


def report_kpi(growth: DataFrame, rec: DataFrame) -> DataFrame:
    """The KPI row: total cost, installs, D30 revenue (MMP) and MMP overstatement vs backend in %. ``rec`` is the
    discrepancy report or any finer rows that sum up to it (``reconcile.revenue_totals``)."""
    # one aggregate over both inputs (stacked, each contributing its own columns): no join needed
    both = growth.select("cost", "installs", "revenue_d30").unionByName(
        rec.select(F.col("mmp_revenue").alias("m"), F.col("backend_revenue").alias("b")), allowMissingColumns=True)
    agg = both.agg(F.sum("cost").alias("total_cost"), F.sum("installs").alias("total_installs"),
                   F.sum("revenue_d30").alias("revenue_d30"), F.sum("m").alias("m"), F.sum("b").alias("b"))
    m, b = F.col("m"), F.col("b")
    return agg.select(
        F.col("total_cost").cast(MONEY_SUM).alias("total_cost"),
        F.col("total_installs").cast("bigint").alias("total_installs"),
        F.col("revenue_d30").cast(MONEY_SUM).alias("revenue_d30"),
        ratio((m - b) * 100, m, 8, 2, when=(m != 0)).alias("mmp_overstatement_pct"))


def report_revenue_unpivot(discrepancy_report: DataFrame) -> DataFrame:
    """Long form of the per-channel revenue report: (channel, source, revenue)."""
    return discrepancy_report.unpivot(["channel"], ["mmp_revenue", "backend_revenue"], "source", "revenue")
