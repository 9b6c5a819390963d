"""Reconciliation: attribution-reported revenue vs the backend (source of truth)."""
from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from acqlens.functions.ratios import ratio
from acqlens.operators.unions import stack, tagged
from acqlens.schemas import MONEY_COST, MONEY_SUM

# Fixed value: relative difference above which a channel-day is flagged.
DISCREPANCY_THRESHOLD = Decimal("0.05")


def is_discrepant(mmp: Column, backend: Column) -> Column:
    """1 if the backend differs from the MMP's revenue by more than the threshold (or has what the MMP lacks)."""
    return (F.when((mmp == 0) & (backend > 0), 1)
            .when(mmp == 0, 0)
            .when((mmp > 0) & (F.abs(backend - mmp) > mmp * F.lit(DISCREPANCY_THRESHOLD)), 1)
            .otherwise(0))


def rec_revenue_discrepancy(stg_events: DataFrame, stg_backend_df: DataFrame) -> DataFrame:
    """Per channel x day: MMP vs attributed backend revenue, delta, delta %, and the >5 % flag."""
    keys = ["channel", "activity_date"]
    j = stack([
        tagged(stg_events.withColumnRenamed("event_date", "activity_date"), "mmp", keys,
               F.col("event_revenue").alias("mmp_revenue"), F.lit(1).alias("mmp_event")),
        tagged(stg_backend_df.filter(F.col("is_attributed") == 1).withColumnRenamed("event_date", "activity_date"),
               "backend", keys, F.col("revenue").alias("backend_revenue"), F.lit(1).alias("backend_event"))]) \
        .groupBy(*keys, "_apart").agg(
            F.sum("mmp_revenue").alias("mmp_revenue"), F.sum("backend_revenue").alias("backend_revenue"),
            F.count("mmp_event").alias("mmp_events"), F.count("backend_event").alias("backend_events"))
    m = F.coalesce(F.col("mmp_revenue"), F.lit(0))
    b = F.coalesce(F.col("backend_revenue"), F.lit(0))
    delta = b - m
    return j.select(
        "channel", "activity_date",
        m.cast(MONEY_SUM).alias("mmp_revenue"),
        b.cast(MONEY_SUM).alias("backend_revenue"),
        delta.cast(MONEY_COST).alias("revenue_delta"),
        ratio(delta * 100, m, 8, 2, when=(m != 0)).alias("revenue_delta_pct"),
        "mmp_events", "backend_events",
        is_discrepant(m, b).alias("is_discrepancy_flag"),
    )


def revenue_totals(days: DataFrame, stg_backend_df: DataFrame) -> DataFrame:
    """The discrepancy report's two revenues, unaggregated, for a grand total: device-day revenue and attributed
    backend revenue stacked (``days`` is shared with the growth mart, so its exchange is reused)."""
    return stack([days.select(F.col("event_revenue").alias("mmp_revenue")),
                  stg_backend_df.filter(F.col("is_attributed") == 1).select(F.col("revenue").alias("backend_revenue"))])


def rec_attribution_gap(stg_backend_df: DataFrame) -> DataFrame:
    """Backend events no attribution row explains, per day and event type."""
    return (stg_backend_df.filter(F.col("is_attributed") == 0)
            .groupBy("event_date", "event")
            .agg(F.count(F.lit(1)).alias("unattributed_events"),
                 F.sum("revenue").cast(DecimalType(14, 2)).alias("unattributed_revenue"),
                 F.sum(F.when(F.col("is_late_event") == 1, 1).otherwise(0)).cast("bigint")
                 .alias("late_among_unattributed")))
