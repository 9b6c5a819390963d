"""Cohort marts kept from deliveries equal a full build, whatever the order and however often deliveries come."""
import datetime as dt

from acqlens.operators import rolling
from acqlens.plans import cohort_state
from acqlens.plans.models import ModelGraph
from frames import backend, install, mmp_event, postback, sources, spend

T = dt.datetime(2024, 1, 1, 10)


def day(n):
    return T + dt.timedelta(days=n)


FIRST = dict(
    appsflyer=[install("a", t=T), install("b", campaign="c2", t=T, platform="android"), mmp_event("a", "5.00", day(1)),
               mmp_event("late", "7.00", day(9))],                       # revenue before its install is known
    backend_rows=[backend("a", "4.00", day(1)), backend("late", "6.00", day(9)), backend("ghost", "1.00", day(2))],
    spend_rows=[spend(T.date(), cost="10.00"), spend(T.date(), campaign="c2", cost="3.00")],
    postbacks=[postback("c1", 5), postback("c2", None)])
SECOND = dict(
    appsflyer=[install("late", t=T), install("a", media="tiktok", campaign="t", t=day(0)),   # a second install row
               mmp_event("a", "2.50", day(30)), mmp_event("b", "1.00", day(31))],
    backend_rows=[backend("a", "8.00", day(1)),                          # a duplicate at a higher revenue
                  backend("a", "4.00", day(1)), backend("b", "2.00", day(7))],
    spend_rows=[spend(T.date(), cost="1.00"), spend(T.date(), campaign="lone", cost="2.00")],
    postbacks=[postback("c1", 50)])


def both(spark):
    return sources(spark, **{k: FIRST[k] + SECOND[k] for k in FIRST})


def check(spark, root, raw):
    g = ModelGraph(raw)
    for got, want in ((cohort_state.retention(spark, root), g.mart_retention),
                      (cohort_state.growth(spark, root), g.mart_growth_metrics),
                      (cohort_state.privacy_gap(spark, root), g.mart_privacy_roas_gap)):
        assert got.dtypes == want.dtypes
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_deliveries_equal_the_full_build(spark, tmpdir_path):
    cohort_state.apply_delivery(spark, tmpdir_path, sources(spark, **FIRST), "1", buckets=4)
    check(spark, tmpdir_path, sources(spark, **FIRST))
    for _ in range(2):
        cohort_state.apply_delivery(spark, tmpdir_path, sources(spark, **SECOND), "2", buckets=4)
        check(spark, tmpdir_path, both(spark))
    paid = {r.device: r.first_paid_day for r in cohort_state.read_state(spark, tmpdir_path, "devices").collect()}
    assert paid["late"] == day(9).date() and paid["a"] == day(1).date()


def test_order_of_deliveries_does_not_matter(spark, tmpdir_path):
    cohort_state.apply_delivery(spark, tmpdir_path, sources(spark, **SECOND), "2", buckets=4)
    cohort_state.apply_delivery(spark, tmpdir_path, sources(spark, **FIRST), "1", buckets=4)
    check(spark, tmpdir_path, both(spark))


def test_a_delivery_replaced_by_less_retracts(spark, tmpdir_path):
    for rows, name in ((FIRST, "1"), (SECOND, "2")):
        cohort_state.apply_delivery(spark, tmpdir_path, sources(spark, **rows), name, buckets=4)
    cohort_state.apply_delivery(spark, tmpdir_path, sources(spark), "2", buckets=4)
    check(spark, tmpdir_path, sources(spark, **FIRST))
    cohort_state.apply_delivery(spark, tmpdir_path, sources(spark), "1", buckets=4)
    assert cohort_state.read_state(spark, tmpdir_path, "devices").count() == 0


def test_directory_keeps_numbers_and_bitmaps_merge(spark):
    def payers(rows):
        return spark.createDataFrame([(day(d).date(), ch, dev) for d, ch, dev in rows], "day date, channel string, device string")

    one = [(0, "m", f"d{i}") for i in range(200)] + [(0, "m", "d1")] * 3 + [(3, "m", "d1"), (0, "t", "d1"), (2, "m", None)]
    two = [(6, "m", f"d{i}") for i in range(190, 260)] + [(7, "m", "d1")]
    first = rolling.number_devices(payers(one), shards=3)
    second = rolling.number_devices(payers(two), first, shards=3)
    known = {r.device: (r.shard, r.number) for r in first.collect()}
    now = {r.device: (r.shard, r.number) for r in second.collect()}
    assert all(now[d] == v for d, v in known.items()) and len(now) == len(set(now.values())) == 260
    bitmaps = rolling.day_bitmaps(payers(one), second).unionByName(rolling.day_bitmaps(payers(two), second))
    got = {(r.activity_date, r.channel_key): (r.payers_2d, r.payers_7d) for r in rolling.rolling_payers(bitmaps, (2, 7)).collect()}
    rows = [(d, ch, dev) for d, ch, dev in one + two if dev]
    for d, ch in {(d, ch) for d, ch, _ in rows}:
        want = tuple(len({v for e, c, v in rows if c == ch and d - n < e <= d}) for n in (2, 7))
        assert got.pop((day(d).date(), ch)) == want
    assert not got
