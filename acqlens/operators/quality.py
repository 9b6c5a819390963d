"""Data-quality checks: not_null, unique, accepted_values, relationships, custom assertions, summary.

Conventions (the usual dbt test semantics):
* each check counts *failures*; 0 = pass;
* ``unique`` and ``accepted_values`` ignore NULLs and count offending *values*;
* ``relationships`` ignores NULL foreign keys and counts offending *child rows*;
* a failing ``warn`` check reports ``warn``, a failing ``error`` check reports ``error`` (the run
  summary counts pass / warn / error).

Every model is read once: a row yields one finding per check it bears on, a (check, key) pair with two
counts, and the findings of all models are summed in one grouped count. A NULL or a broken predicate is a
finding by itself; a unique column yields its value (failing if counted twice); a foreign key yields its value
as child and the parent model yields the same keys as parent (failing children are those of keys without
parent), so relationships need no join. A key that a third of all rows hold is summed map-side. The result is
61 rows, never the checked data itself.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acqlens.functions.channel import CANONICAL_CHANNELS
from acqlens.functions.skan import CV_BANDS, CV_MAX, CV_MIN
from acqlens.functions.taxonomy import BACKEND_EVENTS, PLATFORMS, REVENUE_EVENTS
from acqlens.operators.unions import union_all


@dataclass(frozen=True)
class Check:
    kind: str                 # not_null | unique | accepted_values | relationships | custom
    model: str
    column: str | None = None
    values: tuple = ()
    to_model: str | None = None
    to_field: str | None = None
    severity: str = "error"
    name_override: str | None = None

    @property
    def name(self) -> str:
        if self.name_override:
            return self.name_override
        if self.kind == "relationships":
            return f"relationships_{self.model}_{self.column}__{self.to_field}__{self.to_model}"
        return f"{self.kind}_{self.model}_{self.column}"


# The declared test suite (model, column, parameters) of the reference project.
NOT_NULL = [
    ("stg_appsflyer", "appsflyer_id"), ("stg_appsflyer", "channel"),
    ("stg_appsflyer_events", "appsflyer_id"), ("stg_appsflyer_events", "event_revenue"),
    ("stg_singular", "spend_date"), ("stg_singular", "channel"),
    ("stg_backend", "user_id"), ("stg_backend", "event"),
    ("rec_revenue_discrepancy", "channel"), ("rec_revenue_discrepancy", "activity_date"),
    ("rec_attribution_gap", "event_date"), ("rec_attribution_gap", "unattributed_events"),
    ("dim_date", "date_day"), ("dim_channel", "channel_key"), ("dim_campaign", "campaign_key"),
    ("dim_geo", "country_code"), ("fct_installs", "channel_key"), ("fct_events", "channel_key"),
    ("fct_spend", "channel_key"), ("mart_marketing_unified", "activity_date"),
    ("mart_retention", "cohort_size"), ("mart_growth_metrics", "campaign_key"),
    ("mart_growth_metrics", "channel_key"), ("mart_privacy_roas_gap", "campaign_key"),
]
UNIQUE = [
    ("stg_appsflyer", "appsflyer_id"), ("dim_date", "date_day"), ("dim_channel", "channel_key"),
    ("dim_campaign", "campaign_key"), ("dim_geo", "country_code"), ("mart_growth_metrics", "campaign_key"),
    ("mart_privacy_roas_gap", "campaign_key"),
]
ACCEPTED_VALUES = [
    ("stg_appsflyer", "channel", CANONICAL_CHANNELS),
    ("stg_appsflyer", "platform", PLATFORMS),
    ("stg_appsflyer", "is_paid", (0, 1)),
    ("stg_appsflyer_events", "event_name", REVENUE_EVENTS),
    ("stg_singular", "channel", CANONICAL_CHANNELS),
    ("stg_skan", "postback_sequence_index", (0, 1, 2)),
    ("stg_skan", "cv_band", CV_BANDS),
    ("stg_backend", "event", BACKEND_EVENTS),
    ("stg_backend", "is_attributed", (0, 1)),
    ("stg_backend", "is_late_event", (0, 1)),
    ("rec_revenue_discrepancy", "is_discrepancy_flag", (0, 1)),
    ("dim_channel", "is_paid", (0, 1)),
    ("mart_privacy_roas_gap", "has_crowd_anonymity", (0, 1)),
]
RELATIONSHIPS = [
    ("stg_appsflyer_events", "appsflyer_id", "stg_appsflyer", "appsflyer_id"),
    ("fct_installs", "channel_key", "dim_channel", "channel_key"),
    ("fct_installs", "campaign_key", "dim_campaign", "campaign_key"),
    ("fct_installs", "country_code", "dim_geo", "country_code"),
    ("fct_installs", "install_date", "dim_date", "date_day"),
    ("fct_events", "channel_key", "dim_channel", "channel_key"),
    ("fct_events", "campaign_key", "dim_campaign", "campaign_key"),
    ("fct_events", "event_date", "dim_date", "date_day"),
    ("fct_spend", "channel_key", "dim_channel", "channel_key"),
    ("fct_spend", "campaign_key", "dim_campaign", "campaign_key"),
    ("mart_growth_metrics", "channel_key", "dim_channel", "channel_key"),
]
CUSTOM = [
    ("assert_backend_no_duplicates", "stg_backend", "error"),
    ("assert_no_negative_revenue", "stg_appsflyer_events+stg_backend", "error"),
    ("assert_retention_monotonic", "mart_retention", "error"),
    ("assert_skan_conversion_value_in_range", "stg_skan", "error"),
    ("assert_singular_installs_without_spend", "stg_singular", "warn"),
    ("assert_singular_spend_without_installs", "stg_singular", "warn"),
]


def all_checks() -> list[Check]:
    out = [Check("not_null", m, c) for m, c in NOT_NULL]
    out += [Check("unique", m, c) for m, c in UNIQUE]
    out += [Check("accepted_values", m, c, values=v) for m, c, v in ACCEPTED_VALUES]
    out += [Check("relationships", m, c, to_model=t, to_field=f) for m, c, t, f in RELATIONSHIPS]
    out += [Check("custom", m, None, severity=s, name_override=n) for n, m, s in CUSTOM]
    return out


# ----------------------------------------------------------------------------- failing rows
def backend_duplicates(stg_backend_df: DataFrame) -> DataFrame:
    return (stg_backend_df.groupBy("user_id", "event", "event_time").agg(F.count(F.lit(1)).alias("cnt"))
            .filter(F.col("cnt") > 1))


def negative_revenue(stg_events: DataFrame, stg_backend_df: DataFrame) -> DataFrame:
    a = stg_events.filter(F.col("event_revenue") < 0).select(
        F.lit("appsflyer").alias("source"), F.col("appsflyer_id").alias("id"), F.col("event_revenue").alias("revenue"))
    b = stg_backend_df.filter(F.col("revenue") < 0).select(
        F.lit("backend").alias("source"), F.col("user_id").alias("id"), "revenue")
    return a.unionByName(b)


def retention_not_monotonic(mart_retention_df: DataFrame) -> DataFrame:
    return mart_retention_df.filter((F.col("retained_d1") < F.col("retained_d7"))
                                    | (F.col("retained_d7") < F.col("retained_d30"))).select(
        "channel", "install_date", "retained_d1", "retained_d7", "retained_d30")


def skan_value_out_of_range(stg_skan_df: DataFrame) -> DataFrame:
    cv = F.col("conversion_value")
    return stg_skan_df.filter(cv.isNotNull() & ((cv < CV_MIN) | (cv > CV_MAX))).select(
        "ad_network_id", "campaign", "conversion_value")


_SPEND_COLS = ("spend_date", "channel", "campaign", "country_code", "cost", "network_installs")


def installs_without_spend(stg_spend: DataFrame) -> DataFrame:
    return stg_spend.filter((F.col("network_installs") > 0)
                            & (F.col("cost").isNull() | (F.col("cost") <= 0))).select(*_SPEND_COLS)


def spend_without_installs(stg_spend: DataFrame) -> DataFrame:
    return stg_spend.filter((F.col("cost") > 0) & (F.col("network_installs") == 0)).select(*_SPEND_COLS)


# ----------------------------------------------------------------------------- findings and counts
def broken_row(name: str, model: str):
    """The predicate of a custom check on one row of ``model`` (its failing rows are the functions above)."""
    cv, d1, d7, d30 = (F.col(c) for c in ("conversion_value", "retained_d1", "retained_d7", "retained_d30"))
    cost, installs = F.col("cost"), F.col("network_installs")
    money = {"stg_appsflyer_events": "event_revenue", "stg_backend": "revenue"}
    return {
        "assert_no_negative_revenue": lambda: F.col(money[model]) < 0,
        "assert_retention_monotonic": lambda: (d1 < d7) | (d7 < d30),
        "assert_skan_conversion_value_in_range": lambda: (cv < CV_MIN) | (cv > CV_MAX),
        "assert_singular_installs_without_spend": lambda: (installs > 0) & (cost.isNull() | (cost <= 0)),
        "assert_singular_spend_without_installs": lambda: (cost > 0) & (installs == 0),
    }[name]()


def _key(*columns: str):
    """The values of some columns as one text; NULL and empty differ."""
    return F.concat_ws("\u0001", *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in columns])


def _findings(model: str, numbered: list[tuple[int, Check]]) -> list:
    """One expression per check that bears on a row of ``model``: a struct (i, key, child, parent) or NULL."""
    def finding(i: int, key, when, child: int = 1):
        return F.when(when, F.struct(F.lit(i).alias("i"), key.alias("key"), F.lit(child).alias("child"),
                                     F.lit(1 - child).alias("parent")))

    out, alone = [], F.lit("")
    for i, c in numbered:
        if c.kind == "relationships" and c.to_model == model:
            out.append(finding(i, _key(c.to_field), F.col(c.to_field).isNotNull(), child=0))
        if model not in c.model.split("+"):
            continue
        if c.kind == "not_null":
            out.append(finding(i, alone, F.col(c.column).isNull()))
        elif c.kind == "accepted_values":
            out.append(finding(i, _key(c.column), F.col(c.column).isNotNull() & ~F.col(c.column).isin(*c.values)))
        elif c.kind in ("unique", "relationships"):
            out.append(finding(i, _key(c.column), F.col(c.column).isNotNull()))
        elif c.name == "assert_backend_no_duplicates":
            out.append(finding(i, _key("user_id", "event", "event_time"), F.lit(True)))
        else:
            out.append(finding(i, alone, broken_row(c.name, model)))
    return out


def failure_counts(models, checks: list[Check]) -> DataFrame:
    """(i, failures) for the checks, numbered as listed, that found anything; each model is read once."""
    numbered = list(enumerate(checks))
    parts = []
    for m in models_read(checks):
        found = F.filter(F.array(*_findings(m, numbered)), lambda x: x.isNotNull())
        parts.append(models.model(m).select(F.explode(found).alias("x")).select("x.*"))
    keys = union_all(parts).groupBy("i", "key").agg(F.sum("child").alias("child"), F.sum("parent").alias("parent"))
    by_rule = {rule: [i for i, c in numbered if (c.name if c.kind == "custom" else c.kind) in names] for rule, names in {
        "rows": ("not_null", "assert_no_negative_revenue", "assert_retention_monotonic",
                 "assert_skan_conversion_value_in_range", "assert_singular_installs_without_spend",
                 "assert_singular_spend_without_installs"),
        "repeated": ("unique", "assert_backend_no_duplicates"), "values": ("accepted_values",),
        "orphans": ("relationships",)}.items()}
    i, child = F.col("i"), F.col("child")
    failures = (F.when(i.isin(by_rule["rows"]), child)
                .when(i.isin(by_rule["repeated"]), F.when(child > 1, 1).otherwise(0))
                .when(i.isin(by_rule["values"]), 1)
                .when(i.isin(by_rule["orphans"]), F.when(F.col("parent") == 0, child).otherwise(0)))
    return keys.groupBy("i").agg(F.sum(failures).alias("failures"))


def with_status(df: DataFrame) -> DataFrame:
    return df.withColumn("status", F.when(F.col("failures") == 0, "pass")
                         .when(F.col("severity") == "warn", "warn").otherwise("error"))


def select_checks(kinds: tuple[str, ...] | None = None, names: tuple[str, ...] | None = None) -> list[Check]:
    return [c for c in all_checks() if (kinds is None or c.kind in kinds) and (names is None or c.name in names)]


def models_read(checks: list[Check]) -> tuple[str, ...]:
    """Models the given checks read (what must be built before they run)."""
    out: list[str] = []
    for c in checks:
        for m in c.model.split("+") + ([c.to_model] if c.to_model else []):
            if m not in out:
                out.append(m)
    return tuple(out)


def check_results(models, kinds: tuple[str, ...] | None = None, names: tuple[str, ...] | None = None) -> DataFrame:
    """Failure counts (+ status) for the selected checks over a ``ModelGraph``."""
    checks = select_checks(kinds, names)
    found = failure_counts(models, checks)
    suite = found.sparkSession.createDataFrame(
        [(i, c.name, c.kind, c.model, c.column, c.severity) for i, c in enumerate(checks)],
        "i int, check_name string, check_type string, model string, column_name string, severity string")
    return with_status(suite.join(found, "i", "left").select(
        "check_name", "check_type", "model", "column_name", "severity",
        F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures")))


def run_summary(results: DataFrame) -> DataFrame:
    """One row: how many checks passed, warned and errored (the run's verdict)."""
    s = F.col("status")
    return results.agg(
        F.count(F.lit(1)).alias("checks"),
        F.sum(F.when(s == "pass", 1).otherwise(0)).cast("bigint").alias("passed"),
        F.sum(F.when(s == "warn", 1).otherwise(0)).cast("bigint").alias("warned"),
        F.sum(F.when(s == "error", 1).otherwise(0)).cast("bigint").alias("errors"))
