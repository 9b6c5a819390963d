"""Source freshness: age of the newest load stamp per raw source against warn/error thresholds.

``as_of`` is always a parameter (never the wall clock inside a query), so results are reproducible.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acqlens.operators.unions import union_all
from acqlens.schemas import LOADED_AT

# Freshness thresholds.
WARN_AFTER_DAYS = 2
ERROR_AFTER_DAYS = 7


def freshness(raw: dict[str, DataFrame], as_of: str, warn_after_days: int = WARN_AFTER_DAYS,
              error_after_days: int = ERROR_AFTER_DAYS) -> DataFrame:
    """``(source_name, max_loaded_at, age_seconds, status)`` with status pass / warn / error."""
    parts = []
    for name, df in raw.items():
        m = df.agg(F.max(LOADED_AT).alias("max_loaded_at"))
        age = F.expr(f"timestampdiff(SECOND, max_loaded_at, TIMESTAMP_NTZ '{as_of}')")
        parts.append(m.select(F.lit(name).alias("source_name"), "max_loaded_at", age.alias("age_seconds")))
    out = union_all(parts)
    age = F.col("age_seconds")
    return out.select(
        "source_name", "max_loaded_at", age.cast("bigint").alias("age_seconds"),
        F.when(age.isNull() | (age > error_after_days * 86400), "error")
        .when(age > warn_after_days * 86400, "warn").otherwise("pass").alias("status"))


def freshness_by_load(marks: DataFrame, warn_after_days: int = WARN_AFTER_DAYS,
                      error_after_days: int = ERROR_AFTER_DAYS) -> DataFrame:
    """How far each source lags behind, load by load, told from the data alone.

    ``marks``: (load_id, source_name, high_water) of every load, load ids in the order of loading. A source's mark
    after a load is the latest event time of all its loads so far; its lag is the distance to the furthest
    source after that load. ``advanced_seconds`` is what the load moved the mark by (0: the source stood still;
    NULL: first load). A source without any event time so far (postbacks carry none) is reported as ``no clock``."""
    so_far = Window.partitionBy("source_name").orderBy("load_id").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("source_name").orderBy("load_id").rowsBetween(Window.unboundedPreceding, -1)
    rows = marks.select("load_id", "source_name", F.max("high_water").over(so_far).alias("high_water"),
                        F.max("high_water").over(before).alias("_before"))
    rows = rows.withColumn("_front", F.max("high_water").over(Window.partitionBy("load_id")))
    lag = F.expr("timestampdiff(SECOND, high_water, _front)")
    return rows.select(
        "load_id", "source_name", "high_water", lag.cast("bigint").alias("lag_seconds"),
        F.expr("timestampdiff(SECOND, _before, high_water)").cast("bigint").alias("advanced_seconds"),
        F.when(F.col("high_water").isNull(), "no clock").when(lag > error_after_days * 86400, "error")
        .when(lag > warn_after_days * 86400, "warn").otherwise("pass").alias("status"))
