"""Daily refresh of the date-local marts equals a full rebuild on the changed data."""
import datetime as dt

from pyspark.sql import functions as F

from acqlens.plans import incremental
from acqlens.plans.models import ModelGraph
from acqlens.sources.fixtures import RawSources, load_fixture_sources
from conftest import SF_SMALL
from frames import backend, install, sources


def test_refresh_two_days_equals_full_rebuild(spark, tmpdir_path):
    src = load_fixture_sources(spark, SF_SMALL)
    raw = RawSources(src.appsflyer, src.singular, src.skan, src.backend)
    incremental.build_all_days(raw, tmpdir_path)
    d1, d2 = dt.date(2024, 1, 10), dt.date(2024, 1, 11)
    day = F.to_date("event_time")
    # late corrections: revenue on d1 doubled, and one more copy of every d2 row under a new user id
    b2 = (src.backend.withColumn("revenue", F.when(day == F.lit(d1), F.col("revenue") * 2)
                                 .otherwise(F.col("revenue")).cast("decimal(12,2)"))
          .unionByName(src.backend.filter(day == F.lit(d2)).withColumn("user_id", F.concat(F.lit("late_"), "user_id"))))
    raw2 = RawSources(src.appsflyer, src.singular, src.skan, b2)
    full = ModelGraph(raw2)
    for model in ("rec_revenue_discrepancy", "rec_attribution_gap"):   # the change is visible before refresh
        want = full.model(model)
        stale = incremental.read_date_local(spark, tmpdir_path, model).select(*want.columns)
        assert want.exceptAll(stale).count() > 0, model
    incremental.refresh_days(raw2, tmpdir_path, [d1, d2])
    for model, col in incremental.DATE_LOCAL.items():
        want = full.model(model)
        got = incremental.read_date_local(spark, tmpdir_path, model).select(*want.columns)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, model


def test_refresh_removes_emptied_days_and_finds_touched_ones(spark, tmpdir_path):
    src = load_fixture_sources(spark, SF_SMALL)
    raw = RawSources(src.appsflyer, src.singular, src.skan, src.backend)
    incremental.build_all_days(raw, tmpdir_path)
    day = dt.date(2024, 1, 10)
    raw2 = RawSources(src.appsflyer, src.singular, src.skan, src.backend.filter(F.to_date("event_time") != F.lit(day)))
    incremental.refresh_days(raw2, tmpdir_path, [day])
    full = ModelGraph(raw2)
    for model in incremental.DATE_LOCAL:
        want = full.model(model)
        got = incremental.read_date_local(spark, tmpdir_path, model).select(*want.columns)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, model
    # a late install touches its own day and its user's backend days
    old, new = dt.datetime(2024, 3, 1), dt.datetime(2024, 3, 9)
    late = sources(spark, appsflyer=[dict(install("u", t=dt.datetime(2024, 1, 1)), _loaded_at=new)],
                   backend_rows=[dict(backend("u", "1.00", dt.datetime(2024, 1, 5)), _loaded_at=old),
                                 dict(backend("v", "1.00", dt.datetime(2024, 1, 6)), _loaded_at=old)])
    assert incremental.touched_days(late, new) == [dt.date(2024, 1, 1), dt.date(2024, 1, 5)]


def test_day_filter_prunes_raw_partitions(spark, tmpdir_path):
    import os
    from acqlens.sources import loader
    src = load_fixture_sources(spark, SF_SMALL)
    for name, df in src.as_dict().items():
        _, _, part, col = loader.SPECS[name]
        loader.write_raw(df, os.path.join(tmpdir_path, name), part, col)
    raw = RawSources(**loader.read_raw(spark, tmpdir_path, keep_partition_column=True))
    g = incremental.DayGraph(raw, [dt.date(2024, 1, 10)])
    plan = g.rec_revenue_discrepancy._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "event_date#" in plan
    assert "GreaterThanOrEqual(event_time" in plan   # row-group skipping on the attribution table
    full = ModelGraph(raw).rec_revenue_discrepancy.filter(F.col("activity_date") == F.lit(dt.date(2024, 1, 10)))
    assert sorted(map(tuple, g.rec_revenue_discrepancy.collect())) == sorted(map(tuple, full.collect()))


def test_cohort_snapshots_one_per_date(spark, tmpdir_path):
    import os
    g = ModelGraph.from_fixtures(spark, SF_SMALL)
    for d in (dt.date(2024, 3, 1), dt.date(2024, 3, 2), dt.date(2024, 3, 2)):   # the 2nd date twice
        incremental.snapshot_cohorts(g, tmpdir_path, d)
    snap = spark.read.parquet(os.path.join(tmpdir_path, "snapshots", "mart_retention"))
    per_date = {r.snapshot_date: r.n for r in snap.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert per_date == {dt.date(2024, 3, 1): g.mart_retention.count(), dt.date(2024, 3, 2): g.mart_retention.count()}
