"""A user holding about a third of all backend rows: AQE must split the hot join partition, results
must not change, and the pre-aggregated paths must not need a split at all."""
import re

import pytest
from pyspark.sql import functions as F

from acqlens.plans.models import ModelGraph
from acqlens.sources.fixtures import FixtureSources, RawSources
from conftest import SF_ORACLE

SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",   # local partitions are tiny
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture
def skew_session(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _skewed(spark):
    src = FixtureSources(spark, SF_ORACLE)
    b = src.backend
    hot = (b.limit(b.count() // 2).withColumn("user_id", F.lit("7"))
           .withColumn("event_time", F.col("event_time") + F.expr("INTERVAL 1 SECOND")))
    return RawSources(src.appsflyer, src.singular, src.skan, b.unionByName(hot))


def _final_plan(df) -> str:
    rows = df.collect()
    return df._jdf.queryExecution().executedPlan().toString(), rows


def test_hot_user_join_is_split_and_results_hold(skew_session):
    spark = skew_session
    raw = _skewed(spark)
    plan, rows = _final_plan(ModelGraph(raw).stg_backend)
    assert "isFinalPlan=true" in plan and re.search(r"SortMergeJoin\(skew=true\)", plan)
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        plain = ModelGraph(raw).stg_backend.collect()
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, plain), key=str)


def test_retention_needs_no_split(skew_session):
    plan, _ = _final_plan(ModelGraph(_skewed(skew_session)).mart_retention)
    assert "skew=true" not in plan   # the hot user was collapsed map-side before any join


def test_install_ids_filter_events_before_the_shuffle(skew_session, tmpdir_path):
    """The Bloom filter of install ids reaches the event scan below the device-day aggregate, and the hot user's
    result is the same without it."""
    import os
    spark = skew_session
    raw, paths = _skewed(spark), {}
    hot = raw.appsflyer.filter("event_revenue is not null").withColumn("appsflyer_id", F.lit("unknown"))
    for name, df in {**raw.as_dict(), "appsflyer": raw.appsflyer.unionByName(hot)}.items():   # half of the events: no install
        paths[name] = os.path.join(tmpdir_path, name)
        df.write.parquet(paths[name])
    size = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    spark.conf.set(size, "0")
    try:
        plan, rows = _final_plan(ModelGraph.from_tables(spark, paths).mart_growth_metrics)
    finally:
        spark.conf.unset(size)
    final = plan.split("== Initial Plan ==")[0]
    assert "might_contain" in final
    below = final[final.index("might_contain"):]
    assert "FileScan parquet" in below and "partial_sum" not in below.split("FileScan parquet")[0]
    plain_plan, plain = _final_plan(ModelGraph.from_tables(spark, paths).mart_growth_metrics)
    assert "might_contain" not in plain_plan
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, plain), key=str)
