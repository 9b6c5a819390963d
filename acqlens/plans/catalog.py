"""Registry of named queries: Spark builders (``queries()``) and their DuckDB twins (``oracle_sql()``).

Each query takes ``(spark, sf_dir)``, derives the raw sources from the driver's tables under
``sf_dir`` and returns a lazy DataFrame over the whole data.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acqlens import oracle, oracle_more
from acqlens.functions.taxonomy import INSTALL_EVENT
from acqlens.operators import extras, profiles, quality, reconcile, reports, rolling, staging
from acqlens.plans import cohort_state
from acqlens.plans.models import MODELS, MaterializedGraph, ModelGraph, shared_models
from acqlens.session import Scratch, kept
from acqlens.sources import fixtures
from acqlens.sources.domains import reject_counts
from acqlens.sources.fixtures import RawSources
from acqlens.sources.freshness import freshness, freshness_by_load
from acqlens.sources.loader import (SPECS, load_raw, read_marks, read_raw, record_marks, stage_sources, table_counts,
                                    table_digests, write_source_csv)
from acqlens.streaming.backend_stream import LateAwareDedup, start_backend_dedup

FRESHNESS_AS_OF = "2024-03-03 12:00:00"   # pinned, so that the registered query can be repeated
QueryFn = Callable[[SparkSession, str], DataFrame]
RAW = ("appsflyer", "singular", "skan", "backend")


def _graph(spark: SparkSession, sf_dir: str) -> ModelGraph:
    return ModelGraph.from_fixtures(spark, sf_dir)


def _on_graph(fn: Callable[[ModelGraph], DataFrame], name: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(_graph(spark, sf_dir))
    run.__name__ = name
    return run


def _checked(kinds=None, names=None, then: Callable[[DataFrame], DataFrame] = lambda results: results) -> QueryFn:
    """Checks over the whole suite's models, each read once. Models that several others need are written first
    (as the reference tests its built tables) and deleted when the counts, one row a check, are known."""
    needed = quality.models_read(quality.select_checks(kinds, names))

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = fixtures.load_fixture_sources(spark, sf_dir)
        with MaterializedGraph(raw, names=shared_models(needed)).build() as graph:
            return then(kept(quality.check_results(graph, kinds, names)))
    return run


def load_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same CSV files loaded in full twice; the second load must not add rows."""
    with Scratch(spark, "load-idempotent") as scratch:
        for name, df in fixtures.load_fixture_sources(spark, sf_dir).as_dict().items():
            write_source_csv(df, scratch.path(SPECS[name][0]))
        first, again = (load_raw(spark, scratch.root, scratch.path("raw")) for _ in range(2))
        return spark.createDataFrame([(f"raw.{n}", first[n], again[n]) for n in first],
                                     "table_name string, rows_first_load bigint, rows_second_load bigint")


# a text column of each source that gets commas, quotes and line breaks on its way through CSV
HARD_TEXT = {"appsflyer": "af_ad", "singular": "campaign", "skan": "source_identifier", "backend": "event"}


def _hard_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: df.withColumn(HARD_TEXT[name], F.concat(F.col(HARD_TEXT[name]), F.lit(', "so to say"\nand on')))
            for name, df in fixtures.load_fixture_sources(spark, sf_dir).as_dict().items()}


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw sources -> header CSV (one file per task, in the shared checkpoint folder) -> typed loader; returns
    the loaded tables' digests over every row and column."""
    with Scratch(spark, "csv") as scratch:
        for name, df in _hard_sources(spark, sf_dir).items():
            write_source_csv(df, scratch.path(SPECS[name][0]))
        return kept(table_digests(stage_sources(spark, scratch.root, validate=False)))


DELTA_FROM = "2024-01-20 00:00:00"   # rows from here on come as an incremental delivery


def _late_rows(from_time: str) -> dict[str, Column]:
    """Which rows of each source come with the second delivery; postbacks, which carry no time: the last window."""
    time = F.lit(from_time).cast("timestamp_ntz")
    return {"appsflyer": F.coalesce(F.coalesce("event_time", "install_time") >= time, F.lit(False)),
            "singular": F.col("date") >= F.lit(from_time).cast("date"),
            "skan": F.col("postback_sequence_index") == 2,
            "backend": F.coalesce(F.col("event_time") >= time, F.lit(False))}


def load_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full load of what happened before ``DELTA_FROM``, then the rest as a delivery, loaded twice (events
    of devices that installed earlier among it); returns the digests of the tables read back."""
    with Scratch(spark, "load-incremental") as scratch:
        late = _late_rows(DELTA_FROM)
        for name, df in _hard_sources(spark, sf_dir).items():
            df = scratch.write(df, f"derived/{name}")      # once for both deliveries
            write_source_csv(df.filter(~late[name]), scratch.path(f"full/{SPECS[name][0]}"))
            write_source_csv(df.filter(late[name]), scratch.path(f"delta/{SPECS[name][0]}"))
        target = scratch.path("raw")
        load_raw(spark, scratch.path("full"), target)
        for _ in range(2):
            load_raw(spark, scratch.path("delta"), target, incremental=True, delivery="second")
        return kept(table_digests(read_raw(spark, target)))


def _faulty(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The raw sources as text with planted faults: wrong codes, numbers and times, long and missing values."""
    def text(df: DataFrame, **changes: Column) -> DataFrame:
        return df.select(*[changes.get(c, F.col(c).cast("string")).alias(c) for c in df.columns if c != "_loaded_at"])

    a, s, k, b = (raw[n] for n in RAW)
    minute, day = F.minute("install_time"), F.dayofmonth("date")
    return {
        "appsflyer": text(a, country_code=F.when(minute == 7, "SVN").otherwise(F.col("country_code")),
                          appsflyer_id=F.when(minute == 8, "").otherwise(F.col("appsflyer_id")),
                          attributed_touch_time=F.when(minute == 9, "2024-02-31 10:00:00")
                          .otherwise(F.col("attributed_touch_time").cast("string")),
                          platform=F.when(minute == 10, "windows phone").otherwise(F.col("platform"))),
        "singular": text(s, impressions=F.when(day == 3, "3000000000").otherwise(F.col("impressions").cast("string")),
                         clicks=F.when(day == 3, "many").otherwise(F.col("clicks").cast("string")),
                         cost=F.when(day == 4, "1234567890123.5").otherwise(F.col("cost").cast("string"))),
        "skan": text(k, conversion_value=F.when(F.col("redownload") == 1, "300").otherwise(F.col("conversion_value").cast("string")),
                     redownload=F.when(F.col("conversion_value") == 17, "2").otherwise(F.col("redownload").cast("string"))),
        "backend": text(b, revenue=F.when(F.second("event_time") == 5, "1,50").otherwise(F.col("revenue").cast("string")),
                        event_time=F.when(F.second("event_time") == 6, "yesterday").otherwise(F.col("event_time").cast("string"))),
    }


def load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per source and broken domain ('' for good rows) when the raw sources come as text with faults."""
    return reject_counts(_faulty(fixtures.load_fixture_sources(spark, sf_dir).as_dict()))


LOAD_CUTS = ("2024-01-20 00:00:00", "2024-01-27 00:00:00")


def load_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lag of every source after each of three loads (cut by event time), from the marks that the loads keep."""
    raw = fixtures.load_fixture_sources(spark, sf_dir).as_dict()
    first, second = (_late_rows(t) for t in LOAD_CUTS)
    parts = {"load-1": lambda n: ~first[n], "load-2": lambda n: first[n] & (~second[n] if n != "skan" else F.lit(False)),
             "load-3": lambda n: second[n] if n != "skan" else F.lit(False)}
    with Scratch(spark, "freshness") as scratch:
        for load, rows in parts.items():
            record_marks(spark, scratch.root, load, {n: df.filter(rows(n)) for n, df in raw.items()})
        return kept(freshness_by_load(read_marks(spark, scratch.root)))


def rolling_payers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct payers of the last 7 and 30 days per channel, from bitmaps stored day by day."""
    events = _graph(spark, sf_dir).fct_events.select(
        F.col("event_date").alias("day"), F.col("channel_key").alias("channel"), F.col("appsflyer_id").alias("device"))
    scratch = Scratch(spark, "payers").until_exit()
    payers = scratch.write(events.distinct(), "payers")
    directory = scratch.write(rolling.number_devices(payers), "directory")
    return rolling.rolling_payers(scratch.write(rolling.day_bitmaps(payers, directory), "bitmaps"))


def _refreshed(result: Callable[[SparkSession, str], DataFrame], name: str) -> QueryFn:
    """A cohort mart after two deliveries: what happened before ``DELTA_FROM`` without one install in ten, then the
    rest, these late installs among it, applied twice."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = fixtures.load_fixture_sources(spark, sf_dir).as_dict()
        late = _late_rows(DELTA_FROM)
        late["appsflyer"] = late["appsflyer"] | ((F.col("event_name") == INSTALL_EVENT) & F.col("appsflyer_id").endswith("7"))
        scratch = Scratch(spark, name).until_exit()
        first = RawSources(**{n: df.filter(~late[n]) for n, df in raw.items()})
        second = RawSources(**{n: df.filter(late[n]) for n, df in raw.items()})
        for delivery, rows in (("first", first), ("second", second), ("second", second)):
            cohort_state.apply_delivery(spark, scratch.root, rows, delivery, buckets=8)
        return result(spark, scratch.root)
    run.__name__ = name
    return run


STREAM_CUTS = ("2024-01-11 00:00:00", "2024-01-21 00:00:00")


def _streamed(spark: SparkSession, sf_dir: str, scratch: Scratch) -> LateAwareDedup:
    """The backend rows in three deliveries by event time, users whose id ends in 7 one delivery late, each taken
    in by a run of the stream that ends when nothing new is there."""
    rows = fixtures.raw_backend(spark, sf_dir)
    arrival = F.lit(0)
    for t in STREAM_CUTS:
        arrival = arrival + (F.col("event_time") >= F.lit(t).cast("timestamp_ntz")).cast("int")
    arrival = F.least(arrival + F.col("user_id").endswith("7").cast("int"), F.lit(len(STREAM_CUTS)))
    rows = rows.withColumn("arrival", arrival)
    for n in range(len(STREAM_CUTS) + 1):
        rows.filter(F.col("arrival") == n).drop("arrival").write.mode("append").parquet(scratch.path("landed"))
        start_backend_dedup(spark, scratch.path("landed"), scratch.path("out"),
                            checkpoint_location=scratch.path("progress")).awaitTermination()
    return LateAwareDedup(scratch.path("out"))


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed, open and late rows of the stream put together: the batch de-duplication."""
    return _streamed(spark, sf_dir, Scratch(spark, "stream").until_exit()).reconciled(spark)


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per micro-batch of the stream: rows, and those that came after their time had been closed."""
    with Scratch(spark, "stream") as scratch:
        return kept(_streamed(spark, sf_dir, scratch).marks(spark).select("batch", "high_water", "n_rows", "n_late"))


def _registry() -> dict[str, QueryFn]:
    q: dict[str, QueryFn] = {}
    for s in RAW:
        q[f"raw_{s}"] = (lambda s: lambda spark, sf: getattr(fixtures, f"raw_{s}")(spark, sf))(s)
    for m in MODELS:
        q[m] = _on_graph((lambda m: lambda g: g.model(m))(m), m)
    # load / sources
    q["load_counts"] = lambda spark, sf: table_counts(fixtures.load_fixture_sources(spark, sf).as_dict())
    q["load_idempotent"] = load_idempotent
    q["csv_round_trip"] = csv_round_trip
    q["load_incremental"] = load_incremental
    q["load_rejects"] = load_rejects
    q["load_freshness"] = load_freshness
    q["freshness"] = lambda spark, sf: freshness(fixtures.load_fixture_sources(spark, sf).as_dict(),
                                                 FRESHNESS_AS_OF)
    # single operators
    g = _on_graph
    q["channel_standardize"] = g(lambda m: profiles.channel_mapping(m.raw.appsflyer, m.raw.singular),
                                 "channel_standardize")
    q["event_taxonomy_map"] = g(lambda m: profiles.event_taxonomy_reconcile(m.stg_appsflyer_events, m.stg_backend),
                                "event_taxonomy_map")
    q["backend_dedup"] = g(lambda m: staging.backend_dedup(m.raw.backend), "backend_dedup")
    q["cv_band_distribution"] = g(lambda m: profiles.cv_band_distribution(m.stg_skan), "cv_band_distribution")
    q["cohort_revenue"] = g(lambda m: profiles.cohort_revenue_report(m.fct_installs, m.device_days), "cohort_revenue")
    q["paying_users"] = g(lambda m: profiles.daily_paying_users(m.fct_events), "paying_users")
    q["ltv_projection"] = g(lambda m: profiles.ltv_projection(m.fct_installs, m.device_days), "ltv_projection")
    # data quality
    for key, kind in (("dq_not_null", "not_null"), ("dq_unique", "unique"),
                      ("dq_accepted_values", "accepted_values"), ("dq_relationships", "relationships")):
        q[key] = _checked(kinds=(kind,))
    for key, check in (("dq_backend_no_duplicates", "assert_backend_no_duplicates"),
                       ("dq_no_negative_revenue", "assert_no_negative_revenue"),
                       ("dq_retention_monotonic", "assert_retention_monotonic"),
                       ("dq_skan_range", "assert_skan_conversion_value_in_range")):
        q[key] = _checked(names=(check,))
    q["dq_installs_without_spend"] = g(lambda m: quality.installs_without_spend(m.stg_singular),
                                       "dq_installs_without_spend")
    q["dq_spend_without_installs"] = g(lambda m: quality.spend_without_installs(m.stg_singular),
                                       "dq_spend_without_installs")
    q["dq_summary"] = _checked()
    q["dq_verdict"] = _checked(then=quality.run_summary)
    # reports
    q["report_roas"] = g(lambda m: reports.report_roas(m.mart_growth_metrics), "report_roas")
    q["report_roas_paid"] = g(lambda m: reports.report_roas_paid(m.mart_growth_metrics), "report_roas_paid")
    q["report_discrepancy"] = g(lambda m: reports.report_discrepancy(m.rec_revenue_discrepancy), "report_discrepancy")
    q["report_privacy"] = g(lambda m: reports.report_privacy(m.mart_privacy_roas_gap), "report_privacy")
    q["report_kpi"] = g(lambda m: reports.report_kpi(
        m.mart_growth_metrics, reconcile.revenue_totals(m.device_days, m.stg_backend)), "report_kpi")
    q["report_revenue_unpivot"] = g(
        lambda m: reports.report_revenue_unpivot(reports.report_discrepancy(m.rec_revenue_discrepancy)),
        "report_revenue_unpivot")
    # jobs re-aimed from the source rules
    q["skan_k_anonymity"] = lambda spark, sf: extras.skan_anonymity_by_campaign(fixtures.skan_base(spark, sf))
    q["ios_paid_installs"] = g(lambda m: extras.ios_paid_installs(m.stg_appsflyer), "ios_paid_installs")
    q["ctit_by_channel"] = g(lambda m: extras.ctit_by_channel(m.stg_appsflyer), "ctit_by_channel")
    q["spend_funnel"] = g(lambda m: extras.spend_funnel(m.stg_singular), "spend_funnel")
    q["defect_profile"] = g(lambda m: extras.defect_profile(m.raw.backend, m.stg_appsflyer, m.stg_appsflyer_events),
                            "defect_profile")
    # proposed in the reference's prose
    q["install_discrepancy"] = g(lambda m: extras.install_discrepancy(m.stg_appsflyer, m.stg_singular),
                                 "install_discrepancy")
    q["cv_decode"] = g(lambda m: extras.decode_conversion_value(m.stg_skan), "cv_decode")
    q["skan_windows"] = g(lambda m: extras.postback_windows(m.stg_skan), "skan_windows")
    q["taxonomy_lint"] = g(lambda m: extras.taxonomy_lint(m.raw.appsflyer, m.raw.backend), "taxonomy_lint")
    q["threshold_alerts"] = g(lambda m: extras.threshold_alerts(m.stg_appsflyer_events, m.stg_backend),
                              "threshold_alerts")
    q["metric_anomalies"] = g(lambda m: extras.metric_anomalies(m.mart_marketing_unified), "metric_anomalies")
    # kept up to date from deliveries and streams
    q["rolling_payers"] = rolling_payers
    for key, result in (("refresh_retention", cohort_state.retention), ("refresh_growth", cohort_state.growth),
                        ("refresh_privacy_gap", cohort_state.privacy_gap)):
        q[key] = _refreshed(result, key)
    q["stream_dedup"] = stream_dedup
    q["stream_late_rows"] = stream_late_rows
    return q


def query_functions() -> dict[str, QueryFn]:
    return _registry()


def oracle_statements() -> dict[str, str]:
    out: dict[str, str] = {}
    for s in RAW:
        out[f"raw_{s}"] = oracle.model_sql(f"raw_{s}")
    for m in MODELS:
        out[m] = oracle.model_sql(m)
    out.update(oracle_more.statements())
    out["load_incremental"] = out["csv_round_trip"]   # a load in parts holds what a load at once does
    return out
