"""Plan regression tests: the physical plans keep the properties the scale design relies on."""
import re

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

# queries that run jobs of their own before they return a frame (checks, loads, refreshes, streams) have tests of
# their own; those of the optional subpackage are linted beside it
EAGER = ("load_idempotent", "load_incremental", "csv_round_trip", "load_freshness", "rolling_payers", "refresh_retention",
         "refresh_growth", "refresh_privacy_gap", "stream_dedup", "stream_late_rows")
LAZY = [k for k in E.queries() if not k.startswith("dq_") and k not in EAGER and k not in E.LLM_QUERIES]
UNUSED_COLUMNS = ("c_name", "c_address", "c_phone", "props", "o_orderstatus", "o_orderdate", "o_orderpriority")


def plan(spark, name: str) -> str:
    df = E.queries()[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_plan_lint(spark, name):
    p = plan(spark, name)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, "cross join"
    assert not re.search(r"(BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|FlatMapCoGroups|MapInPandas|MapInArrow|FlatMapGroupsInArrow)", p), "python in plan"
    for scan in re.findall(r"FileScan parquet \[([^\]]*)\]", p):
        assert not any(c in scan for c in UNUSED_COLUMNS), scan


def test_backend_dedup_aggregates_map_side(spark):
    p = plan(spark, "backend_dedup")
    assert re.search(r"HashAggregate\(keys=\[user_id#\d+, event#\d+, event_time#\d+\], functions=\[partial_max", p)


def test_growth_pre_aggregates_events_per_device_day(spark):
    p = plan(spark, "mart_growth_metrics")
    assert re.search(r"HashAggregate\(keys=\[appsflyer_id#\d+, event_date#\d+\], functions=\[partial_sum", p)


def final_plan(df) -> str:
    """The plan as it was run: what a reused exchange would read again is not in it."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", ["mart_growth_metrics", "mart_privacy_roas_gap", "report_kpi", "threshold_alerts",
                                  "defect_profile", "rec_revenue_discrepancy", "dim_date", "report_roas"])
def test_events_are_read_at_most_twice(spark, name):
    # once as the provider's events and once as the backend's
    p = final_plan(E.queries()[name](spark, SF_SMALL))
    assert 1 <= len(re.findall(r"FileScan parquet .*events\.parquet", p)) <= 2


def test_sources_meet_in_one_exchange_each(spark):
    """The unified mart and the discrepancy report group a tagged union: no join of the sources, and one exchange
    on their keys."""
    for name, keys in (("mart_marketing_unified", r"activity_date#\d+, channel_key#\d+, campaign_key#\d+, country_code#\d+, _apart#\d+"),
                       ("rec_revenue_discrepancy", r"channel#\d+, activity_date#\d+, _apart#\d+")):
        p = plan(spark, name)
        assert "FullOuter" not in p
        assert len(re.findall(rf"Exchange hashpartitioning\({keys}, \d+\)", p)) == 1, name


def test_event_filter_reaches_the_scan(spark):
    p = plan(spark, "stg_appsflyer_events")
    scan = next(line for line in p.splitlines() if "events.parquet" in line)
    assert "In(event_type, [purchase,signup])" in scan


def test_retention_pre_aggregates_per_user(spark):
    p = plan(spark, "mart_retention")
    assert re.search(r"HashAggregate\(keys=\[user_id#\d+\], functions=\[partial_max", p)
    assert "Window" not in p


def test_distinct_counts_are_two_phase(spark):
    p = plan(spark, "mart_marketing_unified")
    assert "partial_count(distinct" in p


def test_no_broadcast_hints():
    # every broadcast is AQE's runtime decision from measured sizes; the code hints none
    import inspect
    import pathlib

    import acqlens
    root = pathlib.Path(inspect.getfile(acqlens)).parent
    hits = [f"{f.name}:{i}" for f in root.rglob("*.py")
            for i, line in enumerate(f.read_text().splitlines(), 1) if "F.broadcast(" in line and f.parent.name != "llm"]
    assert not hits, hits
