"""Cohort marts kept up to date from deliveries, without reading old events again.

Every delivery leaves mergeable partial results under ``<root>/<table>/delivery=<name>/bucket=<n>`` (bucket: hash
of the device id):

* ``installs``       install rows, one per device and set of attributes, with their number;
* ``paid_days``      attributed revenue per device and day (sums merge by adding);
* ``server_events``  backend events per (user, event, time) with the highest revenue (merge by maximum, so a
                     duplicate that comes in a later delivery adds nothing);
* ``spend``, ``postbacks``  sums per campaign (no buckets: as many rows as campaigns).

``devices/bucket=<n>`` is the state per device: its cohort, last active day, first payment, revenue by window. A
delivery's devices (and those that an earlier version of the same delivery had) are computed anew from the partial
results of their buckets and replace their rows; no other device is touched. So a late install takes up the
revenue of earlier deliveries, a duplicate at a higher revenue retracts the lower one, and applying a delivery
again changes nothing. The marts are aggregates over ``devices``: one row a device, whatever the number of events.

The steps that a delivery changes are written in an order that can be repeated: partial results first (each
delivery its own folders, replaced whole), then ``devices`` by bucket. After a failure, apply the delivery again.
"""
from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acqlens.functions.dates import day_diff
from acqlens.functions.ratios import ratio
from acqlens.operators import facts, marts, staging
from acqlens.operators.unions import stack, tagged
from acqlens.schemas import MONEY_SUM
from acqlens.session import Scratch, delete_folder
from acqlens.sources.fixtures import RawSources
from acqlens.sources.loader import read_if_there

BUCKETS = 64
COHORT = "channel_key string, campaign_key string, campaign string, install_date date, platform string"
SCHEMAS = {
    "installs": f"device string, {COHORT}, n bigint, bucket int, delivery string",
    "paid_days": "device string, day date, revenue decimal(38,2), bucket int, delivery string",
    "server_events": "device string, event string, event_time timestamp_ntz, revenue decimal(12,2), bucket int, "
                     "delivery string",
    "spend": "channel_key string, campaign_key string, cost decimal(38,2), delivery string",
    "postbacks": "campaign string, skan_postbacks bigint, skan_conversions bigint, skan_high_value bigint, "
                 "skan_null_cv bigint, delivery string",
    "devices": f"device string, {COHORT}, n bigint, last_day date, first_paid_day date, paid decimal(38,2), "
               "paid_d7 decimal(38,2), paid_d30 decimal(38,2), confirmed_d30 decimal(38,2), bucket int",
}
BY_DEVICE = ("installs", "paid_days", "server_events")


def _bucket(device: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(device), F.lit(buckets)).cast("int")


def _partials(raw: RawSources) -> dict[str, DataFrame]:
    """What a delivery adds, aggregated as far as it merges."""
    installs = facts.fct_installs(staging.stg_appsflyer(raw.appsflyer))
    events = facts.fct_events(staging.stg_appsflyer_events(raw.appsflyer))
    spend = facts.fct_spend(staging.stg_singular(raw.singular))
    return {
        "installs": installs.groupBy(F.col("appsflyer_id").alias("device"), "channel_key", "campaign_key", "campaign",
                                     "install_date", "platform").agg(F.count(F.lit(1)).alias("n")),
        "paid_days": marts.device_days(events).select(
            F.col("appsflyer_id").alias("device"), F.col("event_date").alias("day"),
            F.col("event_revenue").cast(MONEY_SUM).alias("revenue")),
        "server_events": staging.backend_dedup(raw.backend).select(
            F.col("user_id").alias("device"), "event", "event_time", "revenue"),
        "spend": spend.groupBy("channel_key", "campaign_key").agg(F.sum("cost").cast(MONEY_SUM).alias("cost")),
        "postbacks": marts.skan_by_campaign(staging.stg_skan(raw.skan)).select(
            "campaign", *[F.col(c).cast("bigint").alias(c) for c in (
                "skan_postbacks", "skan_conversions", "skan_high_value", "skan_null_cv")]),
    }


def read_state(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All rows of a state table (none before the first delivery)."""
    df = read_if_there(spark, os.path.join(root, table), SCHEMAS[table])
    return spark.createDataFrame([], SCHEMAS[table]) if df is None else df


def device_states(installs: DataFrame, paid_days: DataFrame, server_events: DataFrame) -> DataFrame:
    """One row per device and cohort from merged partial results."""
    cohort = ["device", *[f.split()[0] for f in COHORT.split(", ")]]
    own = installs.groupBy(*cohort).agg(F.sum("n").alias("n"))
    paid = paid_days.select("device", "day", F.col("revenue").alias("claimed"))
    confirmed = (server_events.groupBy("device", "event", "event_time").agg(F.max("revenue").alias("confirmed"))
                 .select("device", F.to_date("event_time").alias("day"), "confirmed", F.lit(True).alias("served")))
    days = stack([paid, confirmed]).groupBy("device", "day").agg(
        F.sum("claimed").alias("claimed"), F.sum("confirmed").alias("confirmed"), F.max("served").alias("served"))
    offset = day_diff("install_date", "day")

    def within(column: str, n: int) -> Column:
        return F.sum(F.when(offset.between(0, n), F.col(column))).cast(MONEY_SUM)

    return own.join(days, "device", "left").groupBy(*cohort, "n").agg(
        F.max(F.when(F.col("served"), F.col("day"))).alias("last_day"),
        F.min(F.when(F.col("claimed").isNotNull(), F.col("day"))).alias("first_paid_day"),
        F.sum("claimed").cast(MONEY_SUM).alias("paid"),
        within("claimed", 7).alias("paid_d7"), within("claimed", 30).alias("paid_d30"),
        within("confirmed", 30).alias("confirmed_d30"))


def apply_delivery(spark: SparkSession, root: str, raw: RawSources, delivery: str, buckets: int = BUCKETS) -> None:
    """Take in one delivery's rows (or take them in again, replacing what the delivery held before)."""
    with Scratch(spark, "delivery") as scratch:
        before = [read_state(spark, root, t).filter(F.col("delivery") == delivery).select("device", "bucket")
                  for t in BY_DEVICE]
        new = {t: scratch.write(df.withColumn("bucket", _bucket("device", buckets)) if t in BY_DEVICE else df, t)
               for t, df in _partials(raw).items()}
        touched = scratch.write(stack([*before, *[new[t].select("device", "bucket") for t in BY_DEVICE]]).distinct(),
                                "touched")
        for t, df in new.items():
            path = os.path.join(root, t, f"delivery={delivery}")
            if t in BY_DEVICE:
                df.hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(path)
            else:
                df.write.mode("overwrite").parquet(path)
        numbers = sorted(r.bucket for r in touched.select("bucket").distinct().collect())   # at most ``buckets``
        here = F.col("bucket").isin(numbers)
        parts = {t: read_state(spark, root, t).filter(here).join(touched, ["device", "bucket"], "left_semi")
                 for t in BY_DEVICE}
        fresh = device_states(*[parts[t] for t in BY_DEVICE]).withColumn("bucket", _bucket("device", buckets))
        rest = read_state(spark, root, "devices").filter(here).join(touched, ["device", "bucket"], "left_anti")
        state = scratch.write(rest.unionByName(fresh), "devices")
        target = os.path.join(root, "devices")
        (state.hint("rebalance", F.col("bucket")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(target))
        filled = {r.bucket for r in state.select("bucket").distinct().collect()}
        for n in set(numbers) - filled:
            delete_folder(spark, os.path.join(target, f"bucket={n}"))


def retention(spark: SparkSession, root: str) -> DataFrame:
    """``mart_retention`` from the state."""
    d, stay = read_state(spark, root, "devices"), day_diff("install_date", "last_day")
    kept = {n: F.sum(F.when(stay >= n, F.col("n")).otherwise(0)).cast("bigint") for n in marts.RETENTION_DAYS}
    rows = d.groupBy(F.col("channel_key").alias("channel"), "install_date").agg(
        F.sum("n").alias("cohort_size"), *[v.alias(f"retained_d{n}") for n, v in kept.items()])
    return rows.select("*", *[ratio(F.col(f"retained_d{n}") * 100, F.col("cohort_size"), 6, 2)
                              .alias(f"retention_d{n}_pct") for n in marts.RETENTION_DAYS])


def growth(spark: SparkSession, root: str) -> DataFrame:
    """``mart_growth_metrics`` from the state."""
    keys, n = ["channel_key", "campaign_key"], F.col("n")
    rows = stack([
        tagged(read_state(spark, root, "devices"), "installs", keys, "campaign", "n",
               F.when(F.col("platform") == "ios", n).otherwise(0).alias("ios"),
               F.when(F.col("paid").isNotNull(), F.col("device")).alias("payer"),
               *[(F.col(c) * n).alias(c) for c in ("paid", "paid_d7", "paid_d30")]),
        tagged(read_state(spark, root, "spend"), "spend", keys, "cost")])
    totals = rows.groupBy(*keys, "_apart").agg(
        F.max("campaign").alias("campaign"), F.sum("n").alias("installs"), F.sum("ios").alias("ios_installs"),
        F.sum("cost").alias("cost"), F.sum("paid").alias("revenue_total"), F.sum("paid_d7").alias("revenue_d7"),
        F.sum("paid_d30").alias("revenue_d30"), F.countDistinct("payer").alias("paying_users")).filter("installs > 0")
    posts = read_state(spark, root, "postbacks")
    sums = posts.groupBy("campaign").agg(*[F.sum(c).alias(c) for c in posts.columns if c.startswith("skan_")])
    return marts.growth_ratios(totals, sums)


def privacy_gap(spark: SparkSession, root: str) -> DataFrame:
    """``mart_privacy_roas_gap`` from the state."""
    confirmed = read_state(spark, root, "devices").groupBy("channel_key", "campaign_key").agg(
        F.sum(F.col("confirmed_d30") * F.col("n")).alias("backend_revenue_d30"))
    return marts.privacy_gap(growth(spark, root), confirmed)
