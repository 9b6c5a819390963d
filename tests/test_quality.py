"""Each check fires on a planted failure and passes on clean data."""
import datetime as dt

from acqlens.operators import quality
from acqlens.plans.models import MaterializedGraph, ModelGraph
from frames import backend, install, mmp_event, postback, sources, spend

T = dt.datetime(2024, 1, 3, 10, 0)


def _results(g, **kw):
    return {r.check_name: (r.failures, r.status) for r in quality.check_results(g, **kw).collect()}


def test_suite_has_61_checks():
    cs = quality.all_checks()
    kinds = [c.kind for c in cs]
    assert (len(cs), kinds.count("not_null"), kinds.count("unique"), kinds.count("accepted_values"),
            kinds.count("relationships"), kinds.count("custom")) == (61, 24, 7, 13, 11, 6)


def test_planted_failures(spark):
    apps = [install("d1", t=T), install("d1", t=T, platform="Windows"),          # duplicate id, bad platform
            install("d2", media="Snapchat", t=T),                                # unknown channel
            mmp_event("ghost", "-3.00", T, install_t=T)]                          # event without install, negative
    back = [backend("d1", "-1.00", T)]
    sp = [spend(dt.date(2024, 1, 3), cost="0.00", installs=3),                     # installs without spend (warn)
          spend(dt.date(2024, 1, 3), cost="8.00", installs=0)]                     # spend without installs (warn)
    pb = [postback(cv=70), postback(cv=-1), postback(cv=None, idx=5)]
    g = MaterializedGraph(sources(spark, appsflyer=apps, backend_rows=back, spend_rows=sp, postbacks=pb)).build()
    got = _results(g)
    assert got["unique_stg_appsflyer_appsflyer_id"] == (1, "error")
    assert got["accepted_values_stg_appsflyer_platform"] == (1, "error")
    assert got["accepted_values_stg_appsflyer_channel"] == (1, "error")
    assert got["accepted_values_stg_skan_postback_sequence_index"] == (1, "error")
    assert got["relationships_stg_appsflyer_events_appsflyer_id__appsflyer_id__stg_appsflyer"] == (1, "error")
    # 1 MMP event + the backend row, which the duplicated install directory entry fans out to 2 rows
    assert got["assert_no_negative_revenue"] == (3, "error")
    assert got["assert_skan_conversion_value_in_range"] == (2, "error")
    assert got["assert_singular_installs_without_spend"] == (1, "warn")
    assert got["assert_singular_spend_without_installs"] == (1, "warn")
    assert got["not_null_stg_backend_user_id"] == (0, "pass")


def test_clean_data_passes(spark):
    apps = [install("d1", t=T, campaign="c"), mmp_event("d1", "5.00", T + dt.timedelta(hours=2), campaign="c", install_t=T)]
    g = ModelGraph(sources(spark, appsflyer=apps, backend_rows=[backend("d1", "4.00", T + dt.timedelta(hours=2))],
                           spend_rows=[spend(dt.date(2024, 1, 3), campaign="c", cost="3.00", installs=1)],
                           postbacks=[postback("c", 3)]))
    bad = {k: v for k, v in _results(g).items() if v[1] != "pass"}
    assert not bad, bad


def test_backend_duplicates_and_monotonic_rows(spark):
    from pyspark.sql import Row
    df = spark.createDataFrame([Row(user_id="u", event="purchase", event_time=T)] * 2)
    assert quality.backend_duplicates(df).count() == 1
    ret = spark.createDataFrame([("Meta", dt.date(2024, 1, 1), 1, 2, 0)],
                                "channel string, install_date date, retained_d1 int, retained_d7 int, retained_d30 int")
    assert quality.retention_not_monotonic(ret).count() == 1
