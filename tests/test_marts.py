"""Marts on hand-made frames: every NULL/0 guard branch, presence combinations, cohorts."""
import datetime as dt
from decimal import Decimal

from acqlens.plans.models import ModelGraph
from frames import backend, install, mmp_event, postback, sources, spend

D = dt.date(2024, 1, 10)
T = dt.datetime(2024, 1, 10, 9, 0)


def test_unified_all_presence_combinations_and_null_keys(spark):  # J3, S9, S12
    # campaigns: s=spend only, i=installs only, r=revenue only, si, sr, ir, sir (same date/channel/country)
    apps, sp = [], []
    for c in ("i", "si", "ir", "sir"):
        apps.append(install(f"dev_{c}", campaign=c, t=T))
    for c in ("r", "sr", "ir", "sir"):
        if c in ("r", "sr"):  # revenue needs a device on that campaign; use an install on another day
            apps.append(install(f"dev_{c}", campaign=c, t=T - dt.timedelta(days=3)))
        apps.append(mmp_event(f"dev_{c}", "10.00", T + dt.timedelta(hours=1), campaign=c,
                              install_t=T - dt.timedelta(days=3) if c in ("r", "sr") else T))
    for c in ("s", "si", "sr", "sir"):
        sp.append(spend(D, campaign=c, cost="30.00", installs=2))
    # NULL country on the spend side and on the install side: must stay two rows
    sp.append(spend(D, campaign="nc", country=None, cost="5.00"))
    apps.append(install("dev_nc", campaign="nc", country=None, t=T))
    g = ModelGraph(sources(spark, appsflyer=apps, spend_rows=sp))
    rows = [r for r in g.mart_marketing_unified.collect() if r.activity_date == D]
    by = {}
    for r in rows:
        by.setdefault(r.campaign_key, []).append(r)
    for c in ("s", "i", "r", "si", "sr", "ir", "sir"):
        (r,) = by[f"Meta|{c}"]
        assert (r.cost > 0) == ("s" in c) and (r.installs > 0) == ("i" in c) and (r.revenue > 0) == ("r" in c), c
    assert len(by["Meta|nc"]) == 2
    sir = by["Meta|sir"][0]
    assert sir.cpi == Decimal("30.00") and sir.roas == Decimal("0.3333")
    assert by["Meta|i"][0].cpi == Decimal("0.00")   # S12: installs > 0 with coalesced cost 0


def test_growth_guards(spark):  # S11, S16, S17
    inst = dt.datetime(2024, 1, 1, 10, 0)
    apps = [install("a1", campaign="nospend", t=inst), install("a2", campaign="nopayer", t=inst),
            install("a3", campaign="zero", t=inst), install("a4", campaign="paid", t=inst),
            install("a5", campaign="paid", t=inst), install("o1", media=None, campaign="shared", t=inst),
            install("m9", media="Meta", campaign="shared", t=inst)]
    apps += [mmp_event("a1", "10.00", inst + dt.timedelta(days=1), campaign="nospend", install_t=inst),
             mmp_event("a4", "40.00", inst + dt.timedelta(days=2), campaign="paid", install_t=inst),
             mmp_event("a4", "20.00", inst + dt.timedelta(days=10), campaign="paid", install_t=inst),
             mmp_event("a4", "5.00", inst + dt.timedelta(days=31), campaign="paid", install_t=inst)]
    sp = [spend(D, campaign="nopayer", cost="50.00"), spend(D, campaign="zero", cost="0.00"),
          spend(D, campaign="paid", cost="100.00"), spend(D, campaign="spendonly", cost="9.00")]
    pb = [postback("shared", cv) for cv in (None, 0, 5, 20, 50)]
    g = ModelGraph(sources(spark, appsflyer=apps, spend_rows=sp, postbacks=pb))
    got = {r.campaign_key: r for r in g.mart_growth_metrics.collect()}
    assert "Meta|spendonly" not in got                                        # S17
    ns = got["Meta|nospend"]
    assert ns.cost == 0 and ns.cpi is None and ns.roas_d30 is None and ns.arpu == Decimal("10.00")
    npay = got["Meta|nopayer"]
    assert npay.cpi == Decimal("50.00") and npay.cac is None and npay.roas_d7 is None   # no payer rows -> NULL
    assert got["Meta|zero"].cpi is None and got["Meta|zero"].roas_d30 is None
    p = got["Meta|paid"]
    assert (p.revenue_total, p.revenue_d7, p.revenue_d30) == (Decimal("65.00"), Decimal("40.00"), Decimal("60.00"))
    assert (p.roas_d7, p.roas_d30, p.cac, p.paying_users) == (Decimal("0.4000"), Decimal("0.6000"), Decimal("100.00"), 1)
    assert p.predicted_ltv_d90 == Decimal("42.00")                            # 60 / 2 * 1.4
    # S16: postbacks join on campaign name only -> both channels' rows carry the counts
    assert got["organic|shared"].skan_postbacks == 5 and got["Meta|shared"].skan_postbacks == 5
    assert got["Meta|shared"].skan_conversions == 3 and got["Meta|shared"].skan_high_value == 1
    priv = {r.campaign_key: r for r in g.mart_privacy_roas_gap.collect()}
    assert priv["Meta|nopayer"].backend_roas_d30 == Decimal("0.0000")        # S11: backend ROAS 0, not NULL
    assert priv["Meta|shared"].has_crowd_anonymity == 1 and priv["Meta|shared"].skan_null_cv_pct == Decimal("20.00")


def test_retention_last_activity_days(spark):
    inst = dt.datetime(2024, 1, 1, 23, 0)
    apps, back = [], []
    for i, last in enumerate([None, 0, 1, 6, 7, 29, 30]):
        apps.append(install(f"u{i}", t=inst))
        if last is not None:
            back.append(backend(f"u{i}", "1.00", dt.datetime(2024, 1, 1 + last, 23, 30)))
    g = ModelGraph(sources(spark, appsflyer=apps, backend_rows=back))
    (r,) = g.mart_retention.collect()
    assert (r.cohort_size, r.retained_d1, r.retained_d7, r.retained_d30) == (7, 5, 3, 1)
    assert r.retention_d1_pct == Decimal("71.43") and r.retention_d30_pct == Decimal("14.29")


def test_dim_date_gap_free_and_calendar(spark):
    apps = [install("a", t=dt.datetime(2023, 12, 30, 5)), install("b", t=dt.datetime(2024, 1, 2, 5))]
    g = ModelGraph(sources(spark, appsflyer=apps))
    rows = sorted(g.dim_date.collect(), key=lambda r: r.date_day)
    assert [r.date_day for r in rows] == [dt.date(2023, 12, 30) + dt.timedelta(days=i) for i in range(4)]
    sat, sun = rows[0], rows[1]
    assert (sat.day_name, sat.day_of_week, sat.is_weekend) == ("Saturday", 7, 1)
    assert (sun.day_of_week, sun.week_of_year, rows[2].week_of_year) == (1, 53, 1)
    assert rows[2].month_name == "January" and rows[2].quarter == 1


def test_ratio_overflow_raises_under_ansi(spark):  # S8
    import pytest
    inst = dt.datetime(2024, 1, 1, 10, 0)
    g = ModelGraph(sources(spark, appsflyer=[install("a", campaign="big", t=inst)],
                           spend_rows=[spend(D, campaign="big", cost="999999999999.00")]))
    with pytest.raises(Exception):
        g.mart_growth_metrics.collect()   # CPI 999,999,999,999.00 does not fit decimal(12,2)


def test_install_row_vs_event_row_keys(spark):  # S14, S15
    inst = dt.datetime(2024, 1, 1, 10, 0)
    ev_t = dt.datetime(2024, 1, 2, 12, 0)
    apps = [install("d", media="Meta", campaign="m1", t=inst),
            mmp_event("d", "10.00", ev_t, media="tiktok", campaign="t1", install_t=inst)]   # event row says TikTok
    g = ModelGraph(sources(spark, appsflyer=apps, backend_rows=[backend("d", "9.00", ev_t)]))
    rec = {r.channel: (r.mmp_revenue, r.backend_revenue) for r in g.rec_revenue_discrepancy.collect()}
    assert rec == {"TikTok": (Decimal("10.00"), Decimal("0.00")), "Meta": (Decimal("0.00"), Decimal("9.00"))}
    unified = {r.campaign_key: r.revenue for r in g.mart_marketing_unified.collect() if r.revenue > 0}
    assert unified == {"TikTok|t1": Decimal("10.00")}            # unified: the event row's keys
    growth = {r.campaign_key: r.revenue_total for r in g.mart_growth_metrics.collect()}
    assert growth == {"Meta|m1": Decimal("10.00")}                # cohort revenue: the install row's keys
