"""The model graph: every bronze/silver/gold model as a lazily built DataFrame.

Models are built once per graph and shared, so a consumer that needs the same upstream model twice
references one logical plan (Spark reuses the identical exchanges). Nothing is computed until an
action runs; ``plans.publish`` decides what to materialise.
"""
from __future__ import annotations

import os
import threading
import uuid
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from acqlens.operators import dims, facts, marts, reconcile, staging
from acqlens.session import delete_folder, ensure_checkpoint_dir
from acqlens.sources.fixtures import RawSources, load_fixture_sources

STAGING = ("stg_appsflyer", "stg_appsflyer_events", "stg_singular", "stg_skan", "stg_backend")
RECONCILIATION = ("rec_revenue_discrepancy", "rec_attribution_gap")
MARTS = ("dim_channel", "dim_campaign", "dim_geo", "dim_date", "fct_installs", "fct_events", "fct_spend",
         "mart_marketing_unified", "mart_retention", "mart_growth_metrics", "mart_privacy_roas_gap")
MODELS = STAGING + RECONCILIATION + MARTS
FACTS = ("fct_installs", "fct_events", "fct_spend")

# model -> upstream models (where models are written; a lazy graph takes backend activity from the raw rows)
DEPENDS_ON: dict[str, tuple[str, ...]] = {
    "stg_appsflyer": (), "stg_appsflyer_events": (), "stg_singular": (), "stg_skan": (),
    "stg_backend": ("stg_appsflyer",),
    "rec_revenue_discrepancy": ("stg_appsflyer_events", "stg_backend"),
    "rec_attribution_gap": ("stg_backend",),
    "dim_channel": ("stg_appsflyer", "stg_singular"),
    "dim_campaign": ("stg_appsflyer", "stg_singular"),
    "dim_geo": ("stg_appsflyer", "stg_singular"),
    "dim_date": ("stg_appsflyer", "stg_appsflyer_events", "stg_backend", "stg_singular"),
    "fct_installs": ("stg_appsflyer",), "fct_events": ("stg_appsflyer_events",), "fct_spend": ("stg_singular",),
    "mart_marketing_unified": ("fct_spend", "fct_installs", "fct_events"),
    "mart_retention": ("fct_installs", "stg_backend"),
    "mart_growth_metrics": ("fct_installs", "fct_events", "fct_spend", "stg_skan"),
    "mart_privacy_roas_gap": ("mart_growth_metrics", "stg_backend"),
}


def build_levels(names=MODELS) -> list[list[str]]:
    """Topological levels: every model's upstream models sit in earlier levels."""
    level: dict[str, int] = {}

    def depth(m: str) -> int:
        if m not in level:
            level[m] = 1 + max((depth(d) for d in DEPENDS_ON[m]), default=-1)
        return level[m]

    for m in names:
        depth(m)
    out: list[list[str]] = [[] for _ in range(max(level.values()) + 1)]
    for m in MODELS:
        if m in level:
            out[level[m]].append(m)
    return out


def shared_models(names) -> tuple[str, ...]:
    """Of ``names`` and their upstream models those that more than one reader needs: worth a table when all of
    ``names`` are read together. Facts are column projections of staging, so they are seen through."""
    def seen(models) -> set[str]:
        return {d for m in models for d in (DEPENDS_ON[m] if m in FACTS else (m,))}

    closure = [m for level in build_levels(names) for m in level]
    readers = Counter(seen(names))
    for m in closure:
        if m not in FACTS:
            readers.update(seen(DEPENDS_ON[m]))
    return tuple(m for m in closure if readers[m] > 1)


class ModelGraph:
    def __init__(self, raw: RawSources):
        self.raw = raw

    @classmethod
    def from_fixtures(cls, spark: SparkSession, sf_dir: str) -> "ModelGraph":
        return cls(load_fixture_sources(spark, sf_dir))

    @classmethod
    def from_tables(cls, spark: SparkSession, names: dict[str, str]) -> "ModelGraph":
        """Graph over published raw tables (``names``: source -> table name or parquet path)."""
        def read(v: str) -> DataFrame:
            return spark.read.parquet(v) if "/" in v else spark.table(v)
        return cls(RawSources(**{k: read(v) for k, v in names.items()}))

    @classmethod
    def from_published(cls, spark: SparkSession) -> "PublishedGraph":
        """Graph over the tables a publish run registered (``staging.*`` and ``marts.*``)."""
        return PublishedGraph(spark)

    def model(self, name: str) -> DataFrame:
        if name not in MODELS:
            raise KeyError(name)
        return getattr(self, name)

    def _finish(self, name: str, df: DataFrame) -> DataFrame:
        """Hook applied to every model once; lazy by default."""
        return df

    # -- silver
    @cached_property
    def stg_appsflyer(self) -> DataFrame:
        return self._finish("stg_appsflyer", staging.stg_appsflyer(self.raw.appsflyer))

    @cached_property
    def stg_appsflyer_events(self) -> DataFrame:
        return self._finish("stg_appsflyer_events", staging.stg_appsflyer_events(self.raw.appsflyer))

    @cached_property
    def stg_singular(self) -> DataFrame:
        return self._finish("stg_singular", staging.stg_singular(self.raw.singular))

    @cached_property
    def stg_skan(self) -> DataFrame:
        return self._finish("stg_skan", staging.stg_skan(self.raw.skan))

    @cached_property
    def stg_backend(self) -> DataFrame:
        return self._finish("stg_backend", staging.stg_backend(self.raw.backend, self.stg_appsflyer))

    @cached_property
    def backend_activity(self) -> DataFrame:
        """When users were active on the server: first and last times need neither de-duplication nor
        attribution, so the raw rows do."""
        return self.raw.backend

    # -- reconciliation
    @cached_property
    def rec_revenue_discrepancy(self) -> DataFrame:
        return self._finish(
            "rec_revenue_discrepancy", reconcile.rec_revenue_discrepancy(self.stg_appsflyer_events, self.stg_backend))

    @cached_property
    def rec_attribution_gap(self) -> DataFrame:
        return self._finish("rec_attribution_gap", reconcile.rec_attribution_gap(self.stg_backend))

    # -- dimensions
    @cached_property
    def dim_channel(self) -> DataFrame:
        return self._finish("dim_channel", dims.dim_channel(self.stg_appsflyer, self.stg_singular))

    @cached_property
    def dim_campaign(self) -> DataFrame:
        return self._finish("dim_campaign", dims.dim_campaign(self.stg_appsflyer, self.stg_singular))

    @cached_property
    def dim_geo(self) -> DataFrame:
        return self._finish("dim_geo", dims.dim_geo(self.stg_appsflyer, self.stg_singular))

    @cached_property
    def dim_date(self) -> DataFrame:
        return self._finish("dim_date", dims.dim_date(
            self.stg_appsflyer, self.stg_appsflyer_events, self.backend_activity, self.stg_singular))

    # -- facts
    @cached_property
    def fct_installs(self) -> DataFrame:
        return self._finish("fct_installs", facts.fct_installs(self.stg_appsflyer))

    @cached_property
    def fct_events(self) -> DataFrame:
        return self._finish("fct_events", facts.fct_events(self.stg_appsflyer_events))

    @cached_property
    def fct_spend(self) -> DataFrame:
        return self._finish("fct_spend", facts.fct_spend(self.stg_singular))

    # -- marts
    @cached_property
    def device_days(self) -> DataFrame:
        """Attributed revenue per device and day (no model of its own: what several marts start from)."""
        return marts.device_days(self.fct_events)

    @cached_property
    def mart_marketing_unified(self) -> DataFrame:
        return self._finish(
            "mart_marketing_unified", marts.mart_marketing_unified(self.fct_spend, self.fct_installs, self.fct_events))

    @cached_property
    def mart_retention(self) -> DataFrame:
        return self._finish("mart_retention", marts.mart_retention(self.backend_activity, self.fct_installs))

    @cached_property
    def mart_growth_metrics(self) -> DataFrame:
        return self._finish("mart_growth_metrics", marts.mart_growth_metrics(
            self.fct_installs, self.device_days, self.fct_spend, self.stg_skan))

    @cached_property
    def mart_privacy_roas_gap(self) -> DataFrame:
        return self._finish(
            "mart_privacy_roas_gap", marts.mart_privacy_roas_gap(self.mart_growth_metrics, self.stg_backend))


class MaterializedGraph(ModelGraph):
    """Models of ``names`` are written once, on first use, as parquet tables under ``root`` (by default a folder
    in ``spark.checkpoint.dir``), the way the reference builds its models as tables: downstream models and
    checks read the written rows (with column pruning and predicate pushdown) instead of recomputing the
    upstream DAG, and a lost executor re-reads the table rather than recomputing from the sources. As a
    context, the graph deletes its tables at the end."""

    def __init__(self, raw: RawSources, names: tuple[str, ...] | None = None, root: str | None = None):
        super().__init__(raw)
        # facts are column projections of staging: recomputing them is cheaper than storing them
        self.names = set(MODELS if names is None else names) - (set(FACTS) if names is None else set())
        self.root = root
        self._root_lock = threading.Lock()
        self._spark: SparkSession | None = None

    def build(self, names=None, threads: int = 4) -> "MaterializedGraph":
        """Write ``names`` (by default all that the graph writes) level by level; models of one level are
        independent Spark jobs submitted concurrently from ``threads`` driver threads, like the
        reference's runner builds independent models in parallel."""
        for level in build_levels(self.names if names is None else names) if self.names else []:
            level = [m for m in level if m in self.names]
            if threads <= 1 or len(level) <= 1:
                for m in level:
                    self.model(m)
                continue
            with ThreadPoolExecutor(max_workers=min(threads, len(level))) as pool:
                list(pool.map(self.model, level))
        return self

    @cached_property
    def backend_activity(self) -> DataFrame:
        return self.stg_backend if "stg_backend" in self.names else self.raw.backend

    def _finish(self, name: str, df: DataFrame) -> DataFrame:
        if name not in self.names:
            return df
        with self._root_lock:   # build threads share one run folder
            self._spark = df.sparkSession
            if self.root is None:
                self.root = os.path.join(ensure_checkpoint_dir(df.sparkSession), "acqlens-tables", uuid.uuid4().hex)
        return write_table(df, os.path.join(self.root, name))

    def __enter__(self) -> "MaterializedGraph":
        return self

    def __exit__(self, *_) -> None:
        if self.root is not None and self._spark is not None:
            delete_folder(self._spark, self.root)


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` once as parquet and return the table read back (lineage ends at the files)."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


class PublishedGraph(ModelGraph):
    """Models read from published tables; nothing is rebuilt. Report queries over it read the
    published marts, like the reference's dashboard reads tables.

    Without ``run_dir`` the models come from the session catalog (``staging.*`` / ``marts.*``, as
    registered by a publish run in this session); with ``run_dir`` from that run's parquet folders
    (what another process published)."""

    def __init__(self, spark: SparkSession, run_dir: str | None = None):
        self.spark = spark
        self.run_dir = run_dir
        self.raw = None

    def model(self, name: str) -> DataFrame:
        if self.run_dir is not None:
            return self.spark.read.parquet(os.path.join(self.run_dir, name))
        from acqlens.plans.publish import LAYER_OF
        return self.spark.table(f"{LAYER_OF[name]}.{name}")



for _m in MODELS:
    setattr(PublishedGraph, _m, property(lambda self, _n=_m: self.model(_n)))
