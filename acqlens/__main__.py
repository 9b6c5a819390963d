"""Command line: the daily run of the reference (load, build, test, freshness, reports) on Spark.

  python -m acqlens load      --csv-dir DIR --root ROOT          raw tables from the four CSV files
  python -m acqlens run       --root ROOT [--as-of TS]           build models, test, publish on success
  python -m acqlens test      --root ROOT                        checks on a build of the raw tables
  python -m acqlens freshness --root ROOT --as-of TS             source freshness
  python -m acqlens report    NAME --root ROOT                   a channel report over the published marts
  python -m acqlens refresh   --root ROOT --days D1,D2           recompute the date-local marts for those days
  python -m acqlens cohorts   --root ROOT --csv-dir DIR --delivery NAME   take one delivery into the cohort marts' state
  python -m acqlens snapshot  --root ROOT --date D               keep today's cohort marts as a dated snapshot

ROOT is a shared folder (raw/, runs/, manifest/). The session comes from spark-submit / the
environment; ``spark.checkpoint.dir`` must name a shared folder on a cluster.
"""
from __future__ import annotations

import argparse
import datetime as dt
import json
import os
import sys

from acqlens.operators import quality, reports
from acqlens.plans import cohort_state, incremental, publish
from acqlens.plans.models import MaterializedGraph, shared_models
from acqlens.session import build_session
from acqlens.sources.fixtures import RawSources
from acqlens.sources.freshness import freshness
from acqlens.sources.loader import committed_load, load_raw, read_raw, stage_sources

REPORTS = {
    "roas": lambda g: reports.report_roas(g.mart_growth_metrics),
    "roas_paid": lambda g: reports.report_roas_paid(g.mart_growth_metrics),
    "discrepancy": lambda g: reports.report_discrepancy(g.rec_revenue_discrepancy),
    "privacy": lambda g: reports.report_privacy(g.mart_privacy_roas_gap),
    "kpi": lambda g: reports.report_kpi(g.mart_growth_metrics, g.rec_revenue_discrepancy),
    "revenue_long": lambda g: reports.report_revenue_unpivot(reports.report_discrepancy(g.rec_revenue_discrepancy)),
}


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="acqlens", description=__doc__,
                                 formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("load", help="typed CSV -> raw tables (full loads are versioned and atomic)")
    p.add_argument("--csv-dir", required=True); p.add_argument("--root", required=True)
    p.add_argument("--incremental", action="store_true", help="add a delivery to the current load")
    p.add_argument("--delivery", help="the delivery's name (needed with --incremental)")
    p.add_argument("--quarantine", action="store_true", help="keep rows that break a domain as rejects, do not fail")
    p = sub.add_parser("run", help="build all models, run the checks, publish on success")
    p.add_argument("--root", required=True); p.add_argument("--as-of", help="freshness reference time")
    p.add_argument("--threads", type=int, default=4, help="models built concurrently")
    p = sub.add_parser("test", help="the 61 checks on a build of the raw tables")
    p.add_argument("--root", required=True)
    p = sub.add_parser("freshness", help="age of the newest load stamp per source")
    p.add_argument("--root", required=True); p.add_argument("--as-of", required=True)
    p = sub.add_parser("report", help="a channel report over the latest published run")
    p.add_argument("name", choices=sorted(REPORTS)); p.add_argument("--root", required=True)
    p = sub.add_parser("refresh", help="recompute the date-local marts for some days")
    p.add_argument("--root", required=True); p.add_argument("--days", required=True, help="D1,D2,... (ISO dates)")
    p = sub.add_parser("cohorts", help="take one delivery into the state of the cohort marts")
    p.add_argument("--root", required=True); p.add_argument("--csv-dir", required=True)
    p.add_argument("--delivery", required=True, help="its name; the same name again replaces its rows")
    p = sub.add_parser("snapshot", help="keep the cohort marts of the latest published run as a dated snapshot")
    p.add_argument("--root", required=True); p.add_argument("--date", required=True, help="snapshot date (ISO)")
    a = ap.parse_args(argv)

    spark = build_session()
    raw_dir = os.path.join(a.root, "raw")
    if a.cmd == "load":
        print(json.dumps(load_raw(spark, a.csv_dir, raw_dir, incremental=a.incremental, delivery=a.delivery,
                                  quarantine=a.quarantine)))
        return 0
    if a.cmd == "run":
        load_id = committed_load(spark, raw_dir)
        res = publish.run(spark, a.root, raw=RawSources(**read_raw(spark, raw_dir, load_id=load_id)),
                          threads=a.threads, as_of=a.as_of, raw_load=load_id)
        print(json.dumps({"run_id": res.run_id, "published": res.published, "errors": res.failed_errors,
                          "warnings": res.warnings}))
        return 0 if res.published else 1
    if a.cmd == "test":
        needed = shared_models(quality.models_read(quality.all_checks()))
        with MaterializedGraph(RawSources(**read_raw(spark, raw_dir)), names=needed).build() as g:
            rows = quality.check_results(g).orderBy("status", "check_name").collect()   # one row per check (61)
        for r in rows:
            print(f"{r.status:<6} {r.check_name}")
        counts = {s: sum(r.status == s for r in rows) for s in ("pass", "warn", "error")}
        print(json.dumps(counts))
        return 1 if counts["error"] else 0
    if a.cmd == "freshness":
        ages = freshness(read_raw(spark, raw_dir), a.as_of).collect()               # one row per source (4)
        for r in ages:
            print(f"{r.status:<6} {r.source_name}")
        return 1 if any(r.status == "error" for r in ages) else 0
    if a.cmd == "refresh":
        days = [dt.date.fromisoformat(d.strip()) for d in a.days.split(",") if d.strip()]
        raw = RawSources(**read_raw(spark, raw_dir, keep_partition_column=True))
        incremental.refresh_days(raw, os.path.join(a.root, "daily"), days)
        print(json.dumps({"refreshed_days": [str(d) for d in days], "models": sorted(incremental.DATE_LOCAL)}))
        return 0
    if a.cmd == "cohorts":
        state = os.path.join(a.root, "cohorts")
        cohort_state.apply_delivery(spark, state, RawSources(**stage_sources(spark, a.csv_dir)), a.delivery)
        print(json.dumps({"delivery": a.delivery, "devices": cohort_state.read_state(spark, state, "devices").count()}))
        return 0
    if a.cmd == "snapshot":
        incremental.snapshot_cohorts(publish.published_graph(spark, a.root), a.root, dt.date.fromisoformat(a.date))
        print(json.dumps({"snapshot_date": a.date, "models": list(incremental.SNAPSHOT_MODELS)}))
        return 0
    if a.cmd == "report":
        REPORTS[a.name](publish.published_graph(spark, a.root)).show(100, truncate=False)
        return 0
    return 2


if __name__ == "__main__":
    sys.exit(main())
