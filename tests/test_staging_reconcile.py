"""Staging (dedup, attribution, late flag) and reconciliation branches on hand-made frames."""
import datetime as dt
from decimal import Decimal

from acqlens.operators import staging
from acqlens.plans.models import ModelGraph
from frames import backend, install, mmp_event, sources

T0 = dt.datetime(2024, 1, 5, 12, 0, 0)


def test_dedup_keeps_max_revenue_nulls_last(spark):
    rows = [backend("u1", "5.00", T0), backend("u1", "7.00", T0), backend("u1", None, T0),   # keep 7.00
            backend("u2", None, T0), backend("u2", None, T0),                                 # all NULL -> NULL
            backend("u3", "1.00", T0), backend("u3", "1.00", T0),                             # exact copies
            backend("u4", "2.00", None), backend("u4", "3.00", None),                         # NULL time groups too
            backend("u1", "9.00", T0, event="subscribe")]                                     # other event
    src = sources(spark, backend_rows=rows)
    got = sorted((r.user_id, r.event, r.revenue) for r in staging.backend_dedup(src.backend).collect())
    assert got == sorted([("u1", "purchase", Decimal("7.00")), ("u2", "purchase", None), ("u3", "purchase", Decimal("1.00")),
                          ("u4", "purchase", Decimal("3.00")), ("u1", "subscribe", Decimal("9.00"))], key=str)


def test_window_dedup_equals_aggregate_dedup(spark):
    rows = [backend(f"u{i % 7}", f"{i % 5}.00" if i % 11 else None, T0 + dt.timedelta(hours=i % 3)) for i in range(200)]
    src = sources(spark, backend_rows=rows)
    a = staging.backend_dedup(src.backend)
    w = staging.dedup_keep_top(src.backend.select("user_id", "event", "revenue", "event_time"),
                               ["user_id", "event", "event_time"], "revenue")
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, w.select(*a.columns).collect()), key=str)


def test_attribution_and_late_flag(spark):  # S3, S18
    inst = dt.datetime(2024, 1, 1, 10, 0, 0)
    src = sources(spark, appsflyer=[install("d1", t=inst)],
                  backend_rows=[backend("d1", "1.00", inst + dt.timedelta(days=21)),
                                backend("d1", "1.00", inst + dt.timedelta(days=21, seconds=1)),
                                backend("zz", "1.00", inst + dt.timedelta(days=40))])
    g = ModelGraph(src)
    got = {(r.user_id, r.event_time): (r.is_attributed, r.is_late_event, r.channel)
           for r in g.stg_backend.collect()}
    assert got[("d1", inst + dt.timedelta(days=21))] == (1, 0, "Meta")
    assert got[("d1", inst + dt.timedelta(days=21, seconds=1))] == (1, 1, "Meta")
    assert got[("zz", inst + dt.timedelta(days=40))] == (0, 0, None)
    gap = g.rec_attribution_gap.collect()
    assert [r.late_among_unattributed for r in gap] == [0]


def test_discrepancy_branches(spark):  # S13
    d = lambda day: dt.datetime(2024, 1, day, 12, 0)
    inst = dt.datetime(2024, 1, 1, 8, 0)
    apps = [install("m", media="Meta", t=inst), install("g", media="google", t=inst), install("t", media="tiktok", t=inst)]
    apps += [mmp_event("m", "100.00", d(2), media="Meta"),            # both, delta exactly 5 % -> 0
             mmp_event("m", "100.00", d(3), media="Meta"),            # both, 5.01 % -> 1
             mmp_event("m", "50.00", d(4), media="Meta"),             # MMP only -> delta -100 % -> 1
             mmp_event("g", "0.00", d(6), media="google")]            # MMP = 0 and backend = 0 -> 0
    back = [backend("m", "105.00", d(2)), backend("m", "105.01", d(3)),
            backend("t", "20.00", d(5))]                               # backend only: MMP 0, backend > 0 -> 1
    g = ModelGraph(sources(spark, appsflyer=apps, backend_rows=back))
    got = {(r.channel, r.activity_date.day): (r.is_discrepancy_flag, r.revenue_delta_pct)
           for r in g.rec_revenue_discrepancy.collect()}
    assert got[("Meta", 2)] == (0, Decimal("5.00"))
    assert got[("Meta", 3)] == (1, Decimal("5.01"))
    assert got[("Meta", 4)] == (1, Decimal("-100.00"))
    assert got[("TikTok", 5)] == (1, None)
    assert got[("Google Ads", 6)] == (0, None)
