"""Column domains of the raw contract: a per-row evaluator that parts good rows from rejects, with reasons.

A source arrives as text. Every column has a domain (below); a row that breaks any is a reject and keeps its
text with one reason per broken column, the others are typed. Both come from one pass of expressions over the
rows (no join, no shuffle), so ``split`` costs what typing costs.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acqlens.functions.dates import round_to_second
from acqlens.operators.unions import union_all
from acqlens.schemas import RAW_APPSFLYER, RAW_BACKEND, RAW_SINGULAR, RAW_SKAN

# The raw contract's domains, by source and column; "!" marks columns that must not be NULL.
DOMAINS: dict[str, dict[str, str]] = {
    "appsflyer": {
        "appsflyer_id": "varchar(64)!", "media_source": "varchar(64)", "campaign": "varchar(128)",
        "af_adset": "varchar(128)", "af_ad": "varchar(128)", "install_time": "datetime",
        "attributed_touch_time": "datetime", "attributed_touch_type": "varchar(20)", "event_name": "varchar(40)",
        "event_revenue": "decimal(12,2)", "event_time": "datetime", "country_code": "char(2)", "platform": "varchar(10)"},
    "singular": {
        "date": "date!", "source": "varchar(64)", "campaign": "varchar(128)", "country": "char(2)",
        "impressions": "int", "clicks": "int", "installs": "int", "cost": "decimal(14,2)"},
    "skan": {
        "ad_network_id": "varchar(64)", "source_identifier": "varchar(128)", "conversion_value": "tinyint",
        "postback_sequence_index": "tinyint", "redownload": "bit"},
    "backend": {"user_id": "varchar(64)!", "event": "varchar(40)", "revenue": "decimal(12,2)", "event_time": "datetime"},
}
RANGES = {"int": (-(1 << 31), (1 << 31) - 1), "tinyint": (0, 255), "bit": (0, 1)}
TYPED = {"appsflyer": RAW_APPSFLYER, "singular": RAW_SINGULAR, "skan": RAW_SKAN, "backend": RAW_BACKEND}


@dataclass(frozen=True)
class Domain:
    kind: str
    args: tuple[int, ...]
    required: bool

    @classmethod
    def parse(cls, text: str) -> "Domain":
        kind, _, rest = text.rstrip("!").partition("(")
        return cls(kind, tuple(int(x) for x in rest.rstrip(")").split(",")) if rest else (), text.endswith("!"))

    def fault(self, c: Column) -> Column:
        """Why the text does not belong to the domain (NULL if it does); an empty text is NULL."""
        if self.kind in ("varchar", "char"):
            bad = F.when(F.length(c) > self.args[0], f"longer than {self.args[0]}")
        elif self.kind in RANGES:
            low, high = RANGES[self.kind]
            n = c.try_cast("decimal(38,0)")
            whole = c.rlike(r"^\s*[+-]?[0-9]{1,37}\s*$")
            bad = F.when(~whole, "not a whole number").when((n < low) | (n > high), f"not within {low} and {high}")
        elif self.kind == "decimal":
            n = c.try_cast("decimal(38,10)")
            bad = F.when(n.isNull(), "not a number").when(
                F.abs(n) >= F.lit(10 ** (self.args[0] - self.args[1])), f"over {self.args[0] - self.args[1]} digits")
        else:
            bad = F.when(c.try_cast("date" if self.kind == "date" else "timestamp_ntz").isNull(), f"not a {self.kind}")
        missing = F.when(c.isNull(), "missing") if self.required else F.lit(None).cast("string")
        return F.when(c.isNull(), missing).otherwise(bad)


def _text(name: str) -> Column:
    c = F.col(name).cast("string")
    return F.when(c != "", c)


def with_faults(text: DataFrame, source: str) -> DataFrame:
    """``text`` plus ``_faults``: one ``column: reason`` per broken column."""
    faults = [F.when(d.fault(_text(c)).isNotNull(), F.concat(F.lit(f"{c}: "), d.fault(_text(c))))
              for c, d in ((c, Domain.parse(v)) for c, v in DOMAINS[source].items())]
    return text.withColumn("_faults", F.filter(F.array(*faults), lambda f: f.isNotNull()))


def split(text: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, typed by the raw schema; rejects as they came, with ``_faults``)."""
    judged = with_faults(text, source)
    typed = []
    for f in TYPED[source].fields:
        v = _text(f.name).try_cast(f.dataType)
        typed.append((round_to_second(v) if f.dataType.simpleString() == "timestamp_ntz" else v).alias(f.name))
    whole = F.size("_faults") == 0
    return judged.filter(whole).select(*typed), judged.filter(~whole)


def reject_counts(texts: dict[str, DataFrame]) -> DataFrame:
    """Per source: rows with each fault, and under fault '' the rows that are good. One pass per source; a row
    with several faults counts under each."""
    parts = []
    for source, text in texts.items():
        f = F.col("_faults")
        parts.append(with_faults(text, source).select(F.explode(F.when(F.size(f) == 0, F.array(F.lit(""))).otherwise(f))
                                                      .alias("fault"))
                     .groupBy("fault").agg(F.count(F.lit(1)).alias("n_rows"))
                     .select(F.lit(source).alias("source_name"), "fault", "n_rows"))
    return union_all(parts)
