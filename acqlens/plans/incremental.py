"""Daily refresh of the date-local marts (incremental models).

The discrepancy report, the attribution gap and the unified mart are keyed by a day. A day depends on
that day's source rows and on the installs of their users, so a daily run recomputes the days that
``touched_days`` finds (delivered rows, and the days on which newly installed users were active) and
replaces their date partitions; a day without rows loses its partition; every other day stays. The day filters are half-open ranges on
the raw time columns, so they reach the parquet scans (and prune date partitions of raw tables).
Cohort marts (retention, growth, privacy gap) look across days: ``plans.cohort_state`` keeps them.
"""
from __future__ import annotations

import datetime as dt
import os
import uuid
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acqlens.functions.taxonomy import INSTALL_EVENT
from acqlens.operators import facts, staging
from acqlens.plans.models import ModelGraph
from acqlens.schemas import LOADED_AT
from acqlens.session import delete_folder, ensure_checkpoint_dir
from acqlens.sources.fixtures import RawSources

# model -> its date column (the partition column of the refreshed table)
DATE_LOCAL = {
    "rec_revenue_discrepancy": "activity_date",
    "rec_attribution_gap": "event_date",
    "mart_marketing_unified": "activity_date",
}


def in_days(col: str, days: list[dt.date]) -> Column:
    """``col`` falls on one of ``days``: OR of half-open ranges, pushable to parquet."""
    conds = [(F.col(col) >= F.lit(d)) & (F.col(col) < F.lit(d + dt.timedelta(days=1))) for d in days]
    return reduce(lambda a, b: a | b, conds)


def _ntz_range(col: str, days: list[dt.date]) -> Column:
    conds = [(F.col(col) >= F.lit(f"{d} 00:00:00").cast("timestamp_ntz"))
             & (F.col(col) < F.lit(f"{d + dt.timedelta(days=1)} 00:00:00").cast("timestamp_ntz")) for d in days]
    return reduce(lambda a, b: a | b, conds)


def _restrict(df: DataFrame, cond: Column, partition_col: str, days: list[dt.date]) -> DataFrame:
    """Rows of ``days``; when the raw table carries its date partition column, filter on it too so
    whole date partitions are skipped, not only row groups."""
    if partition_col in df.columns:
        cond = cond & in_days(partition_col, days)
    return df.filter(cond)


class DayGraph(ModelGraph):
    """The model graph restricted to ``days`` for the date-local marts."""

    def __init__(self, raw: RawSources, days: list[dt.date]):
        super().__init__(raw)
        self.days = sorted(set(days))

    @cached_property
    def stg_appsflyer_events(self) -> DataFrame:
        # the attribution table is laid out by install date, so only row-group statistics help here
        return staging.stg_appsflyer_events(self.raw.appsflyer.filter(_ntz_range("event_time", self.days)))

    @cached_property
    def stg_singular(self) -> DataFrame:
        return staging.stg_singular(_restrict(self.raw.singular, in_days("date", self.days), "spend_date", self.days))

    @cached_property
    def stg_backend(self) -> DataFrame:
        # the whole install directory attributes the day's backend rows
        day_rows = _restrict(self.raw.backend, _ntz_range("event_time", self.days), "event_date", self.days)
        return staging.stg_backend(day_rows, self.stg_appsflyer)

    @cached_property
    def fct_installs(self) -> DataFrame:
        return facts.fct_installs(self.stg_appsflyer.filter(in_days("install_date", self.days)))


def write_date_local(df: DataFrame, path: str, date_col: str) -> None:
    # rebalanced by day: a day's rows meet in a few full files, and a large day is split over several tasks
    (df.hint("rebalance", F.col(date_col)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(date_col).parquet(path))


def build_all_days(raw: RawSources, root: str) -> None:
    """Initial full build of the date-local marts under ``root/<model>`` (partitioned by date)."""
    g = ModelGraph(raw)
    for m, col in DATE_LOCAL.items():
        write_date_local(g.model(m), os.path.join(root, m), col)


def touched_days(raw: RawSources, loaded_since: dt.datetime) -> list[dt.date]:
    """Days whose marts change through rows stamped ``loaded_since`` or later: the days of these rows, and
    every backend day of a user whose install is among them. Only distinct days reach the driver."""
    new = F.col(LOADED_AT) >= F.lit(loaded_since)
    mmp, back = raw.appsflyer.filter(new), raw.backend.filter(new)
    users = mmp.filter(F.col("event_name") == INSTALL_EVENT).select(F.col("appsflyer_id").alias("user_id"))
    days = (mmp.select(F.to_date("event_time").alias("d")).union(mmp.select(F.to_date("install_time")))
            .union(raw.singular.filter(new).select(F.col("date").cast("date")))
            .union(back.select(F.to_date("event_time")))
            .union(raw.backend.join(users, "user_id", "left_semi").select(F.to_date("event_time"))))
    return sorted(r.d for r in days.filter("d is not null").distinct().collect())


def refresh_days(raw: RawSources, root: str, days: list[dt.date]) -> None:
    """Recompute the date-local marts for ``days`` and replace only those date partitions. The new rows are
    written to the shared checkpoint folder first, so a day left without rows is known and removed."""
    g = DayGraph(raw, days)
    for m, col in DATE_LOCAL.items():
        df = g.model(m).filter(in_days(col, g.days))
        spark = df.sparkSession
        staged = os.path.join(ensure_checkpoint_dir(spark), f"acqlens-refresh-{uuid.uuid4().hex}")
        df.write.parquet(staged)
        fresh = spark.read.schema(df.schema).parquet(staged)
        filled = {r[0] for r in fresh.select(col).distinct().collect()}      # some of ``days``
        target = os.path.join(root, m)
        write_date_local(fresh, target, col)
        for day in set(g.days) - filled:
            delete_folder(spark, f"{target}/{col}={day.isoformat()}")


def read_date_local(spark, root: str, model: str) -> DataFrame:
    """A refreshed mart as stored (the date partition column comes back as the last column)."""
    return spark.read.parquet(os.path.join(root, model))


# cohort marts kept as dated snapshots (history of how each cohort looked on each run date)
SNAPSHOT_MODELS = ("mart_retention", "mart_growth_metrics")


def snapshot_cohorts(graph: ModelGraph, root: str, snapshot_date: dt.date) -> None:
    """Append today's cohort marts under ``root/snapshots/<model>/snapshot_date=<date>``. Re-running a
    date replaces just that date's partition, so snapshots stay one per date."""
    for m in SNAPSHOT_MODELS:
        df = graph.model(m).withColumn("snapshot_date", F.lit(snapshot_date))
        write_date_local(df, os.path.join(root, "snapshots", m), "snapshot_date")
