"""Jobs re-aimed from the source writers' data rules (X1-X5)."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acqlens.functions.ratios import ratio
from acqlens.functions.skan import K_ANONYMITY_THRESHOLD
from acqlens.functions.taxonomy import BACKEND_EVENTS, INSTALL_EVENT, REVENUE_EVENTS
from acqlens.operators.reconcile import is_discrepant
from acqlens.operators.staging import backend_dedup, is_late
from acqlens.operators.unions import stack
from acqlens.schemas import MONEY_SUM


def k_anonymize(postbacks: DataFrame, group_col: str, value_col: str,
                k: int = K_ANONYMITY_THRESHOLD) -> DataFrame:
    """Withhold ``value_col`` (set NULL) in every group with fewer than ``k`` rows.

    Group sizes come from a partially aggregated count joined back on the group key (not a window),
    so one huge campaign is counted map-side and its rows are never gathered into a single task;
    AQE broadcasts the per-group counts when they are measured small, otherwise the join shuffles
    and splits a skewed key.
    """
    sizes = (postbacks.groupBy(F.col(group_col).alias("_g"))
             .agg(F.count(F.lit(1)).alias("_n")))
    j = postbacks.join(sizes, F.col(group_col).eqNullSafe(F.col("_g")), "left")
    small = F.col("_n") < k
    return j.withColumn(value_col, F.when(small, F.lit(None).cast(postbacks.schema[value_col].dataType))
                        .otherwise(F.col(value_col))).drop("_g", "_n")


# --------------------------------------------------------------------------- X1-X5
def skan_anonymity_by_campaign(postbacks: DataFrame, k: int = K_ANONYMITY_THRESHOLD) -> DataFrame:
    """Per campaign: postbacks, values withheld and visible after k-anonymity suppression. The group's size and
    its values come from one aggregate, so no postback is shuffled: a group under ``k`` shows nothing."""
    n, shown = F.col("postbacks"), F.when(F.col("postbacks") >= k, F.col("values")).otherwise(0)
    return (postbacks.groupBy(F.col("source_identifier").alias("campaign"))
            .agg(F.count(F.lit(1)).alias("postbacks"), F.count("conversion_value").alias("values"))
            .select("campaign", "postbacks", (n - shown).alias("withheld_values"),
                    shown.cast("bigint").alias("visible_values")))


def ios_paid_installs(stg_installs: DataFrame) -> DataFrame:
    """iOS installs of paid channels per (channel, campaign): the population privacy postbacks cover."""
    return (stg_installs.filter((F.col("platform") == "ios") & (F.col("is_paid") == 1))
            .groupBy("channel", "campaign").agg(F.count(F.lit(1)).alias("ios_installs")))


def ctit_by_channel(stg_installs: DataFrame) -> DataFrame:
    """Click/view-to-install time in whole minutes per channel and touch type (organic has no touch)."""
    mins = F.expr("timestampdiff(MINUTE, attributed_touch_time, install_time)")
    t = (stg_installs.filter(F.col("attributed_touch_time").isNotNull() & F.col("install_time").isNotNull())
         .select("channel", "attributed_touch_type", mins.alias("m")))
    agg = t.groupBy("channel", "attributed_touch_type").agg(
        F.count(F.lit(1)).alias("installs"), F.min("m").alias("min_ctit_minutes"),
        F.max("m").alias("max_ctit_minutes"), F.sum("m").alias("total"))
    return agg.select("channel", "attributed_touch_type", "installs",
                      F.col("min_ctit_minutes").cast("bigint").alias("min_ctit_minutes"),
                      F.col("max_ctit_minutes").cast("bigint").alias("max_ctit_minutes"),
                      ratio(F.col("total"), F.col("installs"), 12, 2).alias("avg_ctit_minutes"))


def spend_funnel(stg_spend: DataFrame) -> DataFrame:
    """Network funnel per channel: CTR, click-to-install rate, network-reported CPI."""
    agg = stg_spend.groupBy("channel").agg(
        F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"),
        F.sum("network_installs").alias("network_installs"), F.sum("cost").alias("cost"))
    return agg.select(
        "channel",
        *[F.col(c).cast("bigint").alias(c) for c in ("impressions", "clicks", "network_installs")],
        F.col("cost").cast(MONEY_SUM).alias("cost"),
        ratio(F.col("clicks"), F.col("impressions"), 12, 4).alias("ctr"),
        ratio(F.col("network_installs"), F.col("clicks"), 12, 4).alias("click_to_install"),
        ratio(F.col("cost"), F.col("network_installs"), 12, 2).alias("network_cpi"))


def defect_profile(raw_backend: DataFrame, stg_installs: DataFrame, stg_events: DataFrame) -> DataFrame:
    """One row measuring the backend's defects: duplicates, unattributed, late events, revenue drift.

    The de-duplicated rows carry how many raw rows they stand for, and the install directory has one row a
    device here (its first install), so one pass over the backend rows gives every count."""
    clean = backend_dedup(raw_backend, F.count(F.lit(1)).alias("copies"))
    known = (stg_installs.groupBy(F.col("appsflyer_id").alias("user_id"))
             .agg(F.min("install_time").alias("install_time"), F.lit(1).alias("is_attributed")))
    rows = clean.join(known, "user_id", "left").select(
        "copies", F.lit(1).alias("kept"), F.coalesce("is_attributed", F.lit(0)).alias("is_attributed"), "revenue",
        F.when(is_late("event_time", "install_time"), 1).otherwise(0).alias("is_late_event"))
    # both sources stacked and aggregated once: no join between one-row results
    j = stack([rows, stg_events.select("event_revenue")]).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("raw_backend_rows"),
        F.count("kept").alias("dedup_rows"),
        F.sum(1 - F.col("is_attributed")).alias("unattributed_events"),
        F.sum("is_late_event").alias("late_events"),
        F.sum(F.when(F.col("is_attributed") == 1, F.col("revenue"))).alias("backend_revenue"),
        F.sum("event_revenue").alias("mmp_revenue"))
    dup = F.col("raw_backend_rows") - F.col("dedup_rows")
    mmp, back = F.coalesce(F.col("mmp_revenue"), F.lit(0)), F.coalesce(F.col("backend_revenue"), F.lit(0))
    return j.select(
        "raw_backend_rows", "dedup_rows", dup.alias("duplicate_rows"),
        ratio(dup * 100, F.col("raw_backend_rows"), 6, 2).alias("duplicate_pct"),
        F.col("unattributed_events").cast("bigint").alias("unattributed_events"),
        ratio(F.col("unattributed_events") * 100, F.col("dedup_rows"), 6, 2).alias("unattributed_pct"),
        F.col("late_events").cast("bigint").alias("late_events"),
        ratio(F.col("late_events") * 100, F.col("dedup_rows"), 6, 2).alias("late_pct"),
        mmp.cast(MONEY_SUM).alias("mmp_revenue"),
        back.cast(MONEY_SUM).alias("backend_attributed_revenue"),
        ratio((back - mmp) * 100, mmp, 8, 2).alias("revenue_drift_pct"))


# --------------------------------------------------------------------------- proposed in prose (Y*)
def install_discrepancy(stg_installs: DataFrame, stg_spend: DataFrame) -> DataFrame:
    """MMP-attributed vs network-reported installs per channel x day, with the >5 % flag."""
    mmp = (stg_installs.groupBy("channel", F.col("install_date").alias("activity_date"))
           .agg(F.count(F.lit(1)).alias("mmp_installs")))
    net = (stg_spend.groupBy("channel", F.col("spend_date").alias("activity_date"))
           .agg(F.sum("network_installs").alias("network_installs")))
    j = mmp.join(net, on=["channel", "activity_date"], how="full")
    m = F.coalesce(F.col("mmp_installs"), F.lit(0)).cast("bigint")
    n = F.coalesce(F.col("network_installs"), F.lit(0)).cast("bigint")
    d = n - m
    flag = (F.when((m == 0) & (n > 0), 1).when(m == 0, 0)
            .when(F.abs(d) * 100 > m * 5, 1).otherwise(0))
    return j.select("channel", "activity_date", m.alias("mmp_installs"), n.alias("network_installs"),
                    d.alias("install_delta"), ratio(d * 100, m, 8, 2, when=(m != 0)).alias("install_delta_pct"),
                    flag.alias("is_discrepancy_flag"))


def decode_conversion_value(stg_skan_df: DataFrame) -> DataFrame:
    """Split the 6-bit conversion value: bits 0-2 revenue tier, 3-4 engagement, 5 retention flag."""
    cv = F.col("conversion_value").cast("int")
    return (stg_skan_df.filter(cv.isNotNull())
            .select("campaign",
                    F.shiftright(cv, 0).bitwiseAND(7).alias("revenue_tier"),
                    F.shiftright(cv, 3).bitwiseAND(3).alias("engagement_tier"),
                    F.shiftright(cv, 5).bitwiseAND(1).alias("retained_flag"))
            .groupBy("campaign", "revenue_tier", "engagement_tier", "retained_flag")
            .agg(F.count(F.lit(1)).alias("postbacks")))


def postback_windows(stg_skan_df: DataFrame) -> DataFrame:
    """Postbacks per campaign split by window index 0/1/2 (pivot with the value list given up front)."""
    return (stg_skan_df.groupBy("campaign").pivot("postback_sequence_index", [0, 1, 2])
            .agg(F.count(F.lit(1)))
            .select("campaign", *[F.coalesce(F.col(str(i)), F.lit(0)).cast("bigint").alias(f"window_{i}")
                                  for i in (0, 1, 2)]))


def taxonomy_lint(raw_appsflyer: DataFrame, raw_backend: DataFrame) -> DataFrame:
    """Event names outside the registry, per source, with row counts. The registry is a fixed
    vocabulary, so membership is a predicate evaluated in the scan (no join); NULL names are reported."""
    registry = {"appsflyer": (INSTALL_EVENT, *REVENUE_EVENTS), "backend": BACKEND_EVENTS}

    def unknown(source: str, col: str) -> DataFrame:
        c = F.col(col)
        return (raw_appsflyer if source == "appsflyer" else raw_backend).filter(
            c.isNull() | ~c.isin(*registry[source])).select(F.lit(source).alias("source"), c.alias("event_name"))

    return (unknown("appsflyer", "event_name").unionByName(unknown("backend", "event"))
            .groupBy("source", "event_name").agg(F.count(F.lit(1)).alias("row_count")))


# Fixed value: alert threshold proposed in the reference's notes (the other is the report's own 5 %).
ALERT_GAP_PCT = 10


def threshold_alerts(stg_events: DataFrame, stg_backend_df: DataFrame) -> DataFrame:
    """Alert rows: for each channel-day whose revenue delta is flagged (> 5 %), one row per campaign
    active in that channel and day (MMP or attributed backend revenue); and each day whose
    unattributed share of backend revenue exceeds 10 % (no campaign: those events have none).

    Both sources are stacked and summed once per (day, channel, campaign); the channel-day and day totals are
    windows over these sums (at most one row per campaign of a day), so nothing is read twice. One row per
    alert and campaign; nothing is collected into lists."""
    attributed = F.col("is_attributed") == 1
    grain = ["activity_date", "channel", "campaign", "attributed"]
    sums = stack([
        stg_events.select(F.col("event_date").alias("activity_date"), "channel", "campaign",
                          F.lit(True).alias("attributed"), F.col("event_revenue").alias("mmp")),
        stg_backend_df.select(F.col("event_date").alias("activity_date"),
                              *[F.when(attributed, F.col(c)).alias(c) for c in ("channel", "campaign")],
                              attributed.alias("attributed"), F.col("revenue").alias("back"))]) \
        .groupBy(*grain).agg(F.coalesce(F.sum("mmp"), F.lit(0)).alias("mmp"),
                             F.coalesce(F.sum("back"), F.lit(0)).alias("back"))
    day, channel_day = Window.partitionBy("activity_date"), Window.partitionBy("activity_date", "channel", "attributed")
    rows = sums.select(
        *grain,
        F.sum("back").over(day).alias("total"),
        F.sum(F.when(F.col("attributed"), 0).otherwise(F.col("back"))).over(day).alias("gap"),
        F.sum("mmp").over(channel_day).alias("m"), F.sum("back").over(channel_day).alias("b"))
    m, b, gap, total = F.col("m"), F.col("b"), F.col("gap"), F.col("total")
    whole = F.col("attributed") & F.col("activity_date").isNotNull() & F.col("channel").isNotNull()
    alert = F.struct(F.lit("revenue_discrepancy").alias("alert_type"), "activity_date", "channel", "campaign",
                     ratio((b - m) * 100, m, 8, 2, when=(m != 0)).alias("metric_pct"))
    disc = F.when(whole & (is_discrepant(m, b) == 1), alert)
    # unattributed rows of a day are one group: it carries the day's alert
    gap_alert = F.struct(F.lit("attribution_gap").alias("alert_type"), "activity_date", "channel", "campaign",
                         ratio(gap * 100, total, 8, 2).alias("metric_pct"))
    over = F.when(~F.col("attributed") & (total > 0) & (gap * 100 > total * ALERT_GAP_PCT), gap_alert)
    return rows.select(F.coalesce(disc, over).alias("a")).filter("a is not null").select("a.*")


def metric_anomalies(unified: DataFrame, sigmas: int = 3, lookback_days: int = 7, least_prior: int = 2) -> DataFrame:
    """Daily ROAS and CPI per channel on a gap-free calendar, flagged when a day lies more than
    ``sigmas`` standard deviations from the mean of the previous ``lookback_days`` days. A day with fewer than
    ``least_prior`` of them on record (a sample deviation needs two) is reported, never flagged.

    The series is aggregated to one row per channel, metric and day before the window, so each
    window partition holds at most one row per calendar day.
    """
    daily = unified.groupBy("channel_key", "activity_date").agg(
        F.sum("cost").alias("cost"), F.sum("revenue").alias("revenue"), F.sum("installs").alias("installs"))
    span = daily.groupBy("channel_key").agg(F.min("activity_date").alias("d0"), F.max("activity_date").alias("d1"))
    cal = span.select("channel_key", F.explode(F.sequence("d0", "d1")).alias("activity_date"))
    filled = cal.join(daily, ["channel_key", "activity_date"], "left")
    cost = F.col("cost").cast("double")
    roas = F.when(F.col("cost") > 0, F.col("revenue").cast("double") / cost)
    cpi = F.when(F.col("installs") > 0, cost / F.col("installs").cast("double"))
    # both metrics from one pass over the daily series (long form: one row per channel, day, metric)
    series = (filled.select("channel_key", "activity_date", F.explode(F.array(
        F.struct(F.lit("roas").alias("metric"), roas.alias("v")),
        F.struct(F.lit("cpi").alias("metric"), cpi.alias("v")))).alias("m"))
        .select("channel_key", "activity_date", "m.metric", "m.v"))
    w = Window.partitionBy("channel_key", "metric").orderBy("activity_date").rowsBetween(-lookback_days, -1)
    s = series.select("*", F.avg("v").over(w).alias("mu"), F.stddev_samp("v").over(w).alias("sd"),
                      F.count("v").over(w).alias("n_prior"))
    return s.select(
        "channel_key", "activity_date", "metric", "n_prior",
        F.when(F.col("v").isNotNull() & (F.col("n_prior") >= least_prior) & (F.col("sd") > 0)
               & (F.abs(F.col("v") - F.col("mu")) > F.col("sd") * sigmas), 1).otherwise(0).alias("is_anomaly"))
