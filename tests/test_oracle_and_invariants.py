"""Every registered query against its DuckDB twin, plus cross-model invariants."""
from pyspark.sql import functions as F

import __spark_entry__ as E
from acqlens.plans.models import ModelGraph
from conftest import SF_SMALL
from oracle_compare import compare


def test_every_query_has_a_twin():
    # those of the optional subpackage are beyond SQL and have their own tests
    assert set(E.queries()) - set(E.LLM_QUERIES) == set(E.oracle_sql()) - set(E.LLM_SQL)


def test_all_queries_match_duckdb(spark):
    res = compare(spark, SF_SMALL, names=list(E.oracle_sql()), verbose=False)
    bad = {k: v for k, v in res.items() if v != "OK"}
    assert not bad, bad


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "roas_d30" in df.columns


def _sum(df, c):
    return df.agg(F.sum(c)).first()[0] or 0


def test_invariants(spark):
    g = ModelGraph.from_fixtures(spark, SF_SMALL)
    installs = g.fct_installs.count()
    assert _sum(g.mart_marketing_unified, "cost") == _sum(g.fct_spend, "cost")
    assert _sum(g.mart_marketing_unified, "installs") == installs
    assert _sum(g.mart_marketing_unified, "revenue") == _sum(g.fct_events, "event_revenue")
    assert _sum(g.mart_retention, "cohort_size") == installs
    b = g.stg_backend
    assert _sum(g.rec_attribution_gap, "unattributed_events") + b.filter("is_attributed = 1").count() == b.count()
    assert _sum(g.rec_attribution_gap, "late_among_unattributed") == 0
    assert _sum(g.rec_revenue_discrepancy, "mmp_revenue") == _sum(g.stg_appsflyer_events, "event_revenue")
    assert g.stg_appsflyer.select("appsflyer_id").distinct().count() == g.stg_appsflyer.count()


def test_results_do_not_depend_on_session_zone_or_ansi(spark):
    """Zone-less timestamps throughout: the same answers under a DST zone with ANSI off."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled")}
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        names = ["raw_appsflyer", "raw_backend", "stg_backend", "dim_date", "mart_retention", "ctit_by_channel",
                 "mart_privacy_roas_gap", "freshness"]
        res = compare(spark, SF_SMALL, names, verbose=False)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert all(v == "OK" for v in res.values()), res
