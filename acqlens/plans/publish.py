"""End-to-end run: load -> build -> check -> publish, with a circuit breaker.

1. raw sources come from CSV files (full refresh through the loader) or from given frames;
2. every model is built once into ``<root>/runs/<run_id>/<model>`` (parquet), independent models
   concurrently;
3. the data-quality suite runs on the built tables;
4. only when no ``error``-severity check fails are the models published: each one is registered in
   the session catalog as ``<layer>.<model>`` over this run's files (staging -> ``staging``,
   reconciliation and marts -> ``marts``; the raw load it came from as views in ``raw``), and a one-row manifest is written for the run (with the
   raw load it was built from). A failing run leaves the previously published tables untouched.

Everything is distributed work except the 61-row check result that decides publication.
"""
from __future__ import annotations

import datetime as dt
import os
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acqlens.operators import quality
from acqlens.plans.models import MODELS, STAGING, MaterializedGraph
from acqlens.schemas import LOADED_AT
from acqlens.sources.fixtures import RawSources
from acqlens.sources.freshness import freshness
from acqlens.sources.loader import SPECS, committed_load, load_raw, read_if_there, read_raw

LAYER_OF = {m: ("staging" if m in STAGING else "marts") for m in MODELS}


@dataclass
class RunResult:
    run_id: str
    published: bool
    checks: DataFrame
    failed_errors: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)
    tables: dict[str, str] = field(default_factory=dict)


def _register(spark: SparkSession, layer: str, name: str, path: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    spark.sql(f"DROP TABLE IF EXISTS {layer}.{name}")
    spark.catalog.createTable(f"{layer}.{name}", path=path, source="parquet")


def register_raw(spark: SparkSession, raw_dir: str, load_id: str) -> dict[str, str]:
    """``raw.<source>`` as views over the files of one committed load and its deliveries."""
    spark.sql("CREATE DATABASE IF NOT EXISTS raw")
    out = {}
    for name, (_, schema, part_col, _) in SPECS.items():
        folders = [os.path.join(raw_dir, "loads", part, name) for part in load_id.split("+")]
        columns = ", ".join(f"`{c}`" for c in [*schema.fieldNames(), LOADED_AT])
        parts = [f"SELECT {columns} FROM parquet.`{f}`" for f in folders]
        spark.sql(f"CREATE OR REPLACE VIEW raw.{name} AS " + " UNION ALL ".join(parts))
        out[f"raw.{name}"] = "+".join(folders)
    return out


def run(spark: SparkSession, root: str, raw: RawSources | None = None, csv_dir: str | None = None,
        threads: int = 4, loaded_at: dt.datetime | None = None, as_of: str | None = None,
        raw_load: str | None = None) -> RunResult:
    """Build, check and (on success) publish. ``raw_load`` names the raw load the given frames come
    from; with ``csv_dir`` it is the load this run commits. It is recorded in the manifest."""
    if (raw is None) == (csv_dir is None):
        raise ValueError("give exactly one of raw= or csv_dir=")
    run_id = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S") + "-" + uuid.uuid4().hex[:8]
    raw_dir = os.path.join(root, "raw")
    if csv_dir is not None:
        load_raw(spark, csv_dir, raw_dir, loaded_at)
        raw_load = committed_load(spark, raw_dir)
        raw = RawSources(**read_raw(spark, raw_dir, load_id=raw_load))
    build_root = os.path.join(root, "runs", run_id)
    graph = MaterializedGraph(raw, names=MODELS, root=build_root).build(MODELS, threads=threads)

    checks = quality.check_results(graph)
    rows = checks.select("check_name", "severity", "status").collect()  # one row per check (61)
    failed = [r.check_name for r in rows if r.status == "error"]
    warned = [r.check_name for r in rows if r.status == "warn"]
    result = RunResult(run_id=run_id, published=False, checks=checks, failed_errors=failed, warnings=warned)
    if as_of is not None:
        stale = [r.source_name for r in freshness(raw.as_dict(), as_of).collect() if r.status == "error"]
        result.failed_errors += [f"freshness_{s}" for s in stale]
    if result.failed_errors:
        return result

    for m in MODELS:
        path = os.path.join(build_root, m)
        _register(spark, LAYER_OF[m], m, path)
        result.tables[f"{LAYER_OF[m]}.{m}"] = path
    if raw_load is not None:
        result.tables |= register_raw(spark, raw_dir, raw_load)
    manifest = spark.createDataFrame(
        [(run_id, len(rows), len(warned), dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), raw_load)],
        "run_id string, checks int, warnings int, published_at timestamp_ntz, raw_load string")
    manifest.write.mode("append").parquet(os.path.join(root, "manifest"))
    result.published = True
    return result


def published_run(spark: SparkSession, root: str) -> str | None:
    """Id of the latest published run (from the manifest), or None."""
    manifest = read_if_there(spark, os.path.join(root, "manifest"))
    return manifest.agg(F.max_by("run_id", "published_at").alias("r")).first().r if manifest is not None else None


def published_graph(spark: SparkSession, root: str):
    """The models of the latest published run under ``root`` (any process may have published it)."""
    from acqlens.plans.models import PublishedGraph
    run_id = published_run(spark, root)
    if run_id is None:
        raise FileNotFoundError(f"no published run under {root}")
    return PublishedGraph(spark, os.path.join(root, "runs", run_id))
