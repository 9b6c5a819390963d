"""Loader round trip, strict parsing, idempotent refresh, freshness, publish circuit breaker, streaming."""
import datetime as dt
import os
import shutil
import glob

import pytest

from acqlens.plans import publish
from acqlens.sources import loader
from acqlens.sources.fixtures import load_fixture_sources
from acqlens.sources.freshness import freshness
from conftest import SF_SMALL
from frames import backend, install, sources


def _export_csv(spark, src, out_dir):
    for name, (fname, _, _, _) in loader.SPECS.items():
        tmp = os.path.join(out_dir, f"_{name}")
        loader.write_source_csv(getattr(src, name), tmp, single_file=True)
        (part,) = glob.glob(os.path.join(tmp, "part-*.csv"))
        shutil.copy(part, os.path.join(out_dir, fname))


def test_csv_round_trip_idempotent(spark, tmpdir_path):
    src = load_fixture_sources(spark, SF_SMALL)
    csv_dir = os.path.join(tmpdir_path, "csv")
    os.makedirs(csv_dir)
    _export_csv(spark, src, csv_dir)
    want = {n: df.count() for n, df in src.as_dict().items()}
    target = os.path.join(tmpdir_path, "raw")
    first = loader.load_raw(spark, csv_dir, target, dt.datetime(2024, 3, 1))
    second = loader.load_raw(spark, csv_dir, target, dt.datetime(2024, 3, 1))
    assert first == want and second == want
    back = loader.read_raw(spark, target)
    for name, df in src.as_dict().items():
        a, b = df.drop("_loaded_at"), back[name].drop("_loaded_at")
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
    assert back["appsflyer"].filter("media_source = ' FB '").count() > 0   # blanks survive the CSV
    assert back["appsflyer"].schema["install_time"].dataType.simpleString() == "timestamp_ntz"


def test_reordered_header_and_empty_fields(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "b.csv")
    with open(p, "w") as f:
        f.write("event_time,revenue,user_id,event\n2024-01-01 10:00:00,,u1,purchase\n,1.50,u2,\n")
    df = loader.read_typed_csv(spark, p, loader.SPECS["backend"][1])
    rows = sorted(df.collect(), key=lambda r: r.user_id)
    assert rows[0].revenue is None and rows[0].event_time == dt.datetime(2024, 1, 1, 10, 0)
    assert rows[1].event is None and rows[1].event_time is None and str(rows[1].revenue) == "1.50"


def test_fractional_seconds_round_half_up(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "b.csv")
    with open(p, "w") as f:
        f.write("user_id,event,revenue,event_time\nu1,purchase,1.00,2024-01-01 10:00:00.6\n"
                "u2,purchase,1.00,2024-01-01 10:00:00.4\nu3,purchase,1.00,2024-12-31 23:59:59.5\n")
    got = {r.user_id: r.event_time for r in loader.read_typed_csv(spark, p, loader.SPECS["backend"][1]).collect()}
    assert got == {"u1": dt.datetime(2024, 1, 1, 10, 0, 1), "u2": dt.datetime(2024, 1, 1, 10, 0, 0),
                   "u3": dt.datetime(2025, 1, 1, 0, 0, 0)}


def test_bad_number_fails_the_load(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "b.csv")
    with open(p, "w") as f:
        f.write("user_id,event,revenue,event_time\nu1,purchase,abc,2024-01-01 10:00:00\n")
    with pytest.raises(Exception):
        loader.read_typed_csv(spark, p, loader.SPECS["backend"][1]).collect()


def test_freshness_thresholds(spark):
    src = sources(spark, backend_rows=[backend("u", "1.00", dt.datetime(2024, 1, 1), )])
    raw = {"backend": src.backend}   # loaded 2024-03-01 00:00:00
    status = lambda as_of: freshness(raw, as_of).first().status
    assert status("2024-03-02 00:00:00") == "pass"
    assert status("2024-03-03 00:00:01") == "warn"
    assert status("2024-03-08 00:00:01") == "error"


def test_publish_and_circuit_breaker(spark, tmpdir_path):
    ok = publish.run(spark, os.path.join(tmpdir_path, "ok"), raw=load_fixture_sources(spark, SF_SMALL), threads=4)
    assert ok.published and "marts.mart_growth_metrics" in ok.tables
    assert spark.table("marts.mart_growth_metrics").count() > 0
    assert publish.published_run(spark, os.path.join(tmpdir_path, "ok")) == ok.run_id
    # a duplicated device id is an error-severity failure: nothing may be published
    bad_src = sources(spark, appsflyer=[install("d", t=dt.datetime(2024, 1, 1)), install("d", t=dt.datetime(2024, 1, 1))])
    bad = publish.run(spark, os.path.join(tmpdir_path, "bad"), raw=bad_src, threads=2)
    assert not bad.published and "unique_stg_appsflyer_appsflyer_id" in bad.failed_errors
    assert publish.published_run(spark, os.path.join(tmpdir_path, "bad")) is None


def test_stream_closed_open_and_late_rows(spark, tmpdir_path):
    from acqlens.operators.staging import backend_dedup
    from acqlens.streaming.backend_stream import LateAwareDedup, start_backend_dedup

    day = lambda d, h=10: dt.datetime(2024, 1, d, h)
    batches = [
        [backend("a", "1.00", day(1)), backend("a", "3.00", day(1)), backend("b", "1.00", day(5))],
        [backend("a", "9.00", day(1)),                                  # late: its key is closed
         backend("b", "2.00", day(5)), backend("c", None, day(4)),      # still open, merged
         backend("n", "1.00", None)],                                   # no time
        [backend("z", "0.00", day(20))],
    ]
    land, sink = os.path.join(tmpdir_path, "land"), os.path.join(tmpdir_path, "sink")
    arrived = None
    for rows in batches:
        df = sources(spark, backend_rows=rows).backend
        arrived = df if arrived is None else arrived.unionByName(df)
        df.coalesce(1).write.mode("append").parquet(land)
        for _ in range(2):                                              # the second run finds nothing new
            start_backend_dedup(spark, land, sink, "2 days", os.path.join(tmpdir_path, "cp")).awaitTermination(300)
    out = LateAwareDedup(sink)
    got = sorted((r.batch, r.n_rows, r.n_late, r.n_closed, r.n_open) for r in out.marks(spark).collect())
    assert got == [(0, 3, 0, 1, 1), (1, 4, 2, 0, 2), (2, 1, 0, 2, 1)]
    closed = {(r.user_id, str(r.revenue)) for r in out.closed(spark).collect()}
    assert closed == {("a", "3.00"), ("b", "2.00"), ("c", "None")}
    assert {r.user_id for r in out.late(spark).collect()} == {"a", "n"} and out.open(spark).first().user_id == "z"
    want = backend_dedup(arrived)
    assert sorted(map(tuple, out.reconciled(spark).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_stream_batch_again_changes_nothing(spark, tmpdir_path):
    from acqlens.streaming.backend_stream import LateAwareDedup
    out = LateAwareDedup(tmpdir_path)
    for n, d in enumerate((1, 5, 9, 9)):
        rows = sources(spark, backend_rows=[backend("u", "1.00", dt.datetime(2024, 1, d))]).backend
        for _ in range(2):                                              # as after a failure
            out.process(rows, n)
    assert out.closed(spark).count() == 2 and out.open(spark).count() == 1 and out.late(spark).count() == 0


def _deliver(folder, appsflyer=(), backend_rows=(), postbacks=()):
    """Source files as Python's csv writes them."""
    import csv
    os.makedirs(folder)
    rows = {"appsflyer": appsflyer, "backend": backend_rows, "skan": postbacks, "singular": ()}
    for name, (fname, schema, _, _) in loader.SPECS.items():
        with open(os.path.join(folder, fname), "w", newline="") as f:
            w = csv.DictWriter(f, schema.fieldNames())
            w.writeheader()
            w.writerows(rows[name])


def test_incremental_load_keeps_history_and_replaces_itself(spark, tmpdir_path):
    from frames import mmp_event, postback
    d2, d9 = dt.datetime(2024, 1, 2, 10), dt.datetime(2024, 1, 9, 10)
    _deliver(os.path.join(tmpdir_path, "full"), [install("d", t=d2), mmp_event("d", 1, d2, install_t=d2)],
             [backend("u1", "1.00", d2)], [postback()])
    _deliver(os.path.join(tmpdir_path, "delta"), [mmp_event("d", 2, d9, install_t=d2)],   # an old device's event
             [backend("u2", "2.00", d2)], [postback()])                                   # a late row; an equal postback
    target = os.path.join(tmpdir_path, "raw")
    for name in (None, "d9"):                                                # unnamed; before any full load
        with pytest.raises(ValueError):
            loader.load_raw(spark, os.path.join(tmpdir_path, "delta"), target, incremental=True, delivery=name)
    loader.load_raw(spark, os.path.join(tmpdir_path, "full"), target)
    want = {"appsflyer": 3, "singular": 0, "skan": 2, "backend": 2}
    for _ in range(2):
        assert loader.load_raw(spark, os.path.join(tmpdir_path, "delta"), target, incremental=True, delivery="d9") == want
    raw = loader.read_raw(spark, target)
    assert sorted(r.user_id for r in raw["backend"].collect()) == ["u1", "u2"]
    assert raw["appsflyer"].filter("event_name = 'install'").count() == 1
    _deliver(os.path.join(tmpdir_path, "again"), [install("e", t=d9)])
    state = loader.committed_load(spark, target)
    loader.load_raw(spark, os.path.join(tmpdir_path, "again"), target)                    # a full load starts anew
    assert loader.read_raw(spark, target)["appsflyer"].count() == 1
    assert loader.read_raw(spark, target, load_id=state)["appsflyer"].count() == 3        # one state, resolved once


def test_quoted_fields_of_other_writers(spark, tmpdir_path):
    odd = 'say ""hi"" "x",\nnext line'
    _deliver(os.path.join(tmpdir_path, "csv"), [install("d", campaign=odd)])
    loader.load_raw(spark, os.path.join(tmpdir_path, "csv"), os.path.join(tmpdir_path, "raw"))
    assert loader.read_raw(spark, os.path.join(tmpdir_path, "raw"))["appsflyer"].first().campaign == odd


def test_seconds_are_rounded_before_dedup(spark):
    from acqlens.operators.staging import backend_dedup
    t = dt.datetime(2024, 1, 1, 10, 0, 1)
    rows = [backend("u", "1.00", t), backend("u", "2.00", t + dt.timedelta(milliseconds=200))]
    assert [tuple(r) for r in backend_dedup(sources(spark, backend_rows=rows).backend).collect()] == [
        ("u", "purchase", rows[1]["revenue"], t)]


def test_alerts_and_anomalies_on_fixture(spark):
    from acqlens.operators import extras
    from acqlens.plans.models import ModelGraph
    g = ModelGraph.from_fixtures(spark, SF_SMALL)
    alerts = extras.threshold_alerts(g.stg_appsflyer_events, g.stg_backend)
    kinds = {r.alert_type for r in alerts.collect()}
    assert "revenue_discrepancy" in kinds
    an = extras.metric_anomalies(g.mart_marketing_unified)
    assert an.filter("n_prior > 7").count() == 0


def test_reports_over_published_tables(spark, tmpdir_path):
    from acqlens.operators import reports
    from acqlens.plans.models import ModelGraph
    res = publish.run(spark, os.path.join(tmpdir_path, "pub"), raw=load_fixture_sources(spark, SF_SMALL), threads=4)
    assert res.published
    pub = ModelGraph.from_published(spark)
    lazy = ModelGraph.from_fixtures(spark, SF_SMALL)
    a = reports.report_roas(pub.mart_growth_metrics)
    b = reports.report_roas(lazy.mart_growth_metrics)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_publish_from_csv_and_freshness_gate(spark, tmpdir_path):
    src = load_fixture_sources(spark, SF_SMALL)
    csv_dir = os.path.join(tmpdir_path, "csv")
    os.makedirs(csv_dir)
    _export_csv(spark, src, csv_dir)
    stamp = dt.datetime(2024, 3, 1)
    ok = publish.run(spark, os.path.join(tmpdir_path, "a"), csv_dir=csv_dir, loaded_at=stamp,
                     as_of="2024-03-02 00:00:00")
    assert ok.published and os.path.isdir(loader.table_dir(spark, os.path.join(tmpdir_path, "a", "raw"), "backend"))
    assert spark.table("marts.rec_revenue_discrepancy").count() > 0
    raw_root = os.path.join(tmpdir_path, "a", "raw")
    recorded = spark.read.parquet(os.path.join(tmpdir_path, "a", "manifest")).first().raw_load
    assert recorded == loader.committed_load(spark, raw_root) is not None
    assert spark.table("raw.backend").count() == src.backend.count()
    stale = publish.run(spark, os.path.join(tmpdir_path, "b"), csv_dir=csv_dir, loaded_at=stamp,
                        as_of="2024-03-20 00:00:00")
    assert not stale.published and any(x.startswith("freshness_") for x in stale.failed_errors)


def test_cli_load_run_report(spark, tmpdir_path, capsys):
    from acqlens.__main__ import main
    src = load_fixture_sources(spark, SF_SMALL)
    csv_dir = os.path.join(tmpdir_path, "csv")
    os.makedirs(csv_dir)
    _export_csv(spark, src, csv_dir)
    root = os.path.join(tmpdir_path, "cli")
    assert main(["load", "--csv-dir", csv_dir, "--root", root]) == 0
    assert main(["run", "--root", root]) == 0
    assert main(["report", "kpi", "--root", root]) == 0
    assert main(["refresh", "--root", root, "--days", "2024-01-10,2024-01-11"]) == 0
    assert main(["snapshot", "--root", root, "--date", "2024-03-02"]) == 0
    assert spark.read.parquet(os.path.join(root, "snapshots", "mart_growth_metrics")).count() > 0
    assert spark.read.parquet(os.path.join(root, "daily", "rec_revenue_discrepancy")).count() > 0
    out = capsys.readouterr().out
    assert '"published": true' in out and "total_cost" in out


def test_graph_from_parquet_tables(spark, tmpdir_path):
    from acqlens.plans.models import ModelGraph
    src = load_fixture_sources(spark, SF_SMALL)
    paths = {}
    for name, df in src.as_dict().items():
        paths[name] = os.path.join(tmpdir_path, name)
        df.write.parquet(paths[name])
    g = ModelGraph.from_tables(spark, paths)
    want = ModelGraph(src).mart_privacy_roas_gap
    got = g.mart_privacy_roas_gap
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_failed_build_publishes_nothing(spark, tmpdir_path):
    from frames import spend
    bad = sources(spark, appsflyer=[install("a", campaign="big", t=dt.datetime(2024, 1, 1))],
                  spend_rows=[spend(dt.date(2024, 1, 1), campaign="big", cost="999999999999.00")])
    root = os.path.join(tmpdir_path, "fail")
    with pytest.raises(Exception):
        publish.run(spark, root, raw=bad, threads=2)     # growth CPI overflows decimal(12,2)
    assert publish.published_run(spark, root) is None


def test_full_load_is_all_or_nothing(spark, tmpdir_path, monkeypatch):
    src = load_fixture_sources(spark, SF_SMALL)
    csv_dir = os.path.join(tmpdir_path, "csv")
    os.makedirs(csv_dir)
    _export_csv(spark, src, csv_dir)
    target = os.path.join(tmpdir_path, "raw")
    first = loader.load_raw(spark, csv_dir, target, dt.datetime(2024, 3, 1))
    good = loader.committed_load(spark, target)
    real_write = loader.write_raw

    def failing(df, path, *a, **k):   # the third table fails while being written
        if path.endswith("skan"):
            raise RuntimeError("executor lost for good")
        return real_write(df, path, *a, **k)

    monkeypatch.setattr(loader, "write_raw", failing)
    with pytest.raises(RuntimeError):
        loader.load_raw(spark, csv_dir, target, dt.datetime(2024, 3, 2))
    monkeypatch.setattr(loader, "write_raw", real_write)
    assert loader.committed_load(spark, target) == good          # the failed load never became visible
    stamps = {r[0] for r in loader.read_raw(spark, target)["appsflyer"].select("_loaded_at").distinct().collect()}
    assert stamps == {dt.datetime(2024, 3, 1)}
    assert {n: df.count() for n, df in loader.read_raw(spark, target).items()} == first


def test_quarantine_keeps_rejects_with_reasons(spark, tmpdir_path):
    good = backend("u", "1.00", dt.datetime(2024, 1, 2, 10))
    _deliver(os.path.join(tmpdir_path, "csv"), [install("d"), install("e", country="SVN"), install("")],
             [good, dict(good, revenue="12345678901.00"), dict(good, event_time="soon", revenue="x"), dict(good, event="e" * 41)],
             [dict(conversion_value=v, redownload=r) for v, r in ((255, 1), (256, 0), (-1, 0), (7, 2), ("1.5", "yes"), ("", ""))])
    csv, target = os.path.join(tmpdir_path, "csv"), os.path.join(tmpdir_path, "raw")
    with pytest.raises(Exception):
        loader.load_raw(spark, csv, target)
    assert loader.load_raw(spark, csv, target, quarantine=True) == {"appsflyer": 1, "singular": 0, "skan": 2, "backend": 1}
    folder = os.path.join(target, "loads", loader.committed_load(spark, target), "rejects")
    faults = {n: sorted(f for r in spark.read.parquet(os.path.join(folder, n)).collect() for f in r["_faults"])
              for n in ("appsflyer", "skan", "backend")}
    assert faults == {
        "appsflyer": ["appsflyer_id: missing", "country_code: longer than 2"],
        "skan": ["conversion_value: not a whole number", "conversion_value: not within 0 and 255",
                 "conversion_value: not within 0 and 255", "redownload: not a whole number", "redownload: not within 0 and 1"],
        "backend": ["event: longer than 40", "event_time: not a datetime", "revenue: not a number", "revenue: over 10 digits"]}
    marks = {r.source_name: (r.row_count, r.high_water) for r in loader.read_marks(spark, target).collect() if r.row_count}
    assert marks["backend"] == (1, dt.datetime(2024, 1, 2, 10))


def test_digest_sees_every_change(spark):
    t = dt.datetime(2024, 1, 2, 10)
    base = [backend("u", "1.00", t), backend("v", None, t), backend("v", None, t)]

    def digest(rows):
        return tuple(loader.table_digests({"backend": sources(spark, backend_rows=rows).backend}).first())
    assert digest(base) == digest(base[::-1])
    for other in (base[:2], base + base[:1], [backend("u", "1.01", t), *base[1:]], [backend("u", "1.00", None), *base[1:]],
                  [backend("u", "1.00", t), backend("v", None, t), backend("v", "0.00", t)]):
        assert digest(other) != digest(base)


def test_freshness_by_load(spark):
    from acqlens.sources.freshness import freshness_by_load
    d = lambda n: dt.datetime(2024, 1, n)
    rows = [("1", "a", d(1)), ("1", "b", d(1)), ("1", "c", None), ("2", "a", d(4)), ("2", "b", None), ("2", "c", None),
            ("3", "a", d(2)), ("3", "b", d(20)), ("3", "c", None)]
    marks = spark.createDataFrame(rows, "load_id string, source_name string, high_water timestamp_ntz")
    got = {(r.load_id, r.source_name): (r.status, r.lag_seconds, r.advanced_seconds) for r in freshness_by_load(marks).collect()}
    day = 86400
    assert got["1", "a"] == ("pass", 0, None) and got["2", "b"] == ("warn", 3 * day, 0)
    assert got["3", "a"] == ("error", 16 * day, 0) and got["3", "b"] == ("pass", 0, 19 * day) and got["2", "c"][0] == "no clock"
