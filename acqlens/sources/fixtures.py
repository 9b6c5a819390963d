"""Adapter: derive the four raw marketing sources from the driver's parquet tables.

The driver ships TPC-H-like tables plus an ``events`` stream; each raw source is a deterministic
projection of them (rules in FIXTURES.md section 3), written as Spark expressions so the work scales
with the tables: installs come from ``customer``, in-app events from ``events`` joined to ``customer``,
spend from ``orders`` joined to ``customer``, postbacks from iOS installs.
"""
from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acqlens.functions.dates import ntz, plus_days, plus_minutes, to_second
from acqlens.functions.skan import K_ANONYMITY_THRESHOLD
from acqlens.operators.extras import k_anonymize
from acqlens.schemas import LOADED_AT, MONEY_COST, MONEY_EVENT

# Fixed values of the adapter (FIXTURES.md section 3).
INSTALL_EPOCH = "2023-12-20 00:00:00"
SPEND_EPOCH = "2023-12-25"
LOADED_AT_VALUE = "2024-03-01 00:00:00"
MEDIA_SOURCE_SPELLINGS = {
    "AUTOMOBILE": ("Meta", "facebook", " FB "),      # chosen by k % 3
    "BUILDING": ("googleadwords", "Google Ads"),      # chosen by k % 2
    "FURNITURE": ("tiktok ads",),
    "MACHINERY": ("ASA",),
    "HOUSEHOLD": (None, "organic", "none"),          # chosen by k % 3
}
COUNTRY_BY_NATION_MOD5 = ("si", "DE", "AT", "HR", "IT")
ORGANIC_SEGMENT = "HOUSEHOLD"
NO_SPEND_CAMPAIGN = "furniture_c2"
EVENT_TYPE_TO_MMP = {"purchase": "af_purchase", "signup": "af_subscribe"}
EVENT_TYPE_TO_BACKEND = {"purchase": "purchase", "signup": "subscribe"}
OTHER_MMP_EVENT = "af_login"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(options: tuple, idx: Column) -> Column:
    out = None
    for i, v in enumerate(options):
        val = F.lit(v).cast("string")
        out = F.when(idx == i, val) if out is None else out.when(idx == i, val)
    return out


def device_columns(customer: DataFrame) -> DataFrame:
    """One device (install) per customer row, with all attribution attributes."""
    k = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    media = None
    for s, spellings in MEDIA_SOURCE_SPELLINGS.items():
        val = _pick(spellings, k % len(spellings))
        media = F.when(seg == s, val) if media is None else media.when(seg == s, val)
    organic = seg == ORGANIC_SEGMENT
    campaign = (F.when(organic, F.when(k % 40 == 0, F.lit(None).cast("string")).otherwise(F.lit("organic")))
                .when(F.col("c_acctbal") < -900, F.concat(F.lower(seg), F.lit("_small")))
                .otherwise(F.concat(F.lower(seg), F.lit("_c"), (k % 3).cast("string"))))
    install_time = plus_minutes(plus_days(ntz(INSTALL_EPOCH), (k * 7) % 30), (k * 37) % 1440)
    return customer.select(
        k.alias("k"),
        seg.alias("segment"),
        k.cast("string").alias("appsflyer_id"),
        media.alias("media_source"),
        campaign.alias("campaign"),
        install_time.alias("install_time"),
        _pick(COUNTRY_BY_NATION_MOD5, F.col("c_nationkey") % 5).alias("country_code"),
        F.when((seg == "MACHINERY") | (k % 20 < 9), "iOS").otherwise("android").alias("platform"),
    ).select(
        "*",
        F.when(~organic_col(), plus_minutes("install_time", -(2 + F.col("k") % 719)))
        .alias("attributed_touch_time"),
        F.when(~organic_col(), F.when(F.col("k") % 5 != 0, "click").otherwise("impression"))
        .alias("attributed_touch_type"),
        F.when(~organic_col(), F.concat("campaign", F.lit("_adset_"), (F.col("k") % 4 + 1).cast("string")))
        .alias("af_adset"),
        F.when(~organic_col(), F.concat("campaign", F.lit("_ad_"), (F.col("k") % 6 + 1).cast("string")))
        .alias("af_ad"),
    )


def organic_col() -> Column:
    return F.col("segment") == ORGANIC_SEGMENT


def _loaded_at() -> Column:
    return ntz(LOADED_AT_VALUE).alias(LOADED_AT)


_APPSFLYER_COLS = ["appsflyer_id", "media_source", "campaign", "af_adset", "af_ad", "install_time",
                   "attributed_touch_time", "attributed_touch_type", "event_name", "event_revenue",
                   "event_time", "country_code", "platform"]


def appsflyer_from(dev: DataFrame, events: DataFrame) -> DataFrame:
    """Install rows (one per customer) plus one row per customer event, device attributes repeated."""
    installs = dev.select(
        *[F.col(c) for c in _APPSFLYER_COLS if c not in ("event_name", "event_revenue", "event_time")],
        F.lit("install").alias("event_name"),
        F.lit(None).cast(MONEY_EVENT).alias("event_revenue"),
        F.lit(None).cast("timestamp_ntz").alias("event_time"),
    )
    et = F.col("event_type")
    name = None
    for t, mmp in EVENT_TYPE_TO_MMP.items():
        name = F.when(et == t, mmp) if name is None else name.when(et == t, mmp)
    paid = et.isin(*EVENT_TYPE_TO_MMP)
    # two branches, so that a reader of revenue events pushes their filter to the scan and leaves out the other branch
    ev = events.filter(paid).select("user_id", "ts", name.alias("event_name"), F.col("value").cast(MONEY_EVENT).alias("event_revenue")) \
        .unionByName(events.filter(et.isNull() | ~paid).select(
            "user_id", "ts", F.lit(OTHER_MMP_EVENT).alias("event_name"), F.lit(None).cast(MONEY_EVENT).alias("event_revenue")))
    events = ev.join(dev, ev.user_id == dev.k, "inner").select(
        *[F.col(c) for c in _APPSFLYER_COLS if c not in ("event_name", "event_revenue", "event_time")],
        "event_name", "event_revenue", to_second("ts").alias("event_time"),
    )
    return installs.unionByName(events).select(*_APPSFLYER_COLS, _loaded_at())


def backend_from(events: DataFrame) -> DataFrame:
    """Server-side purchases/subscriptions with planted defects: revenue drift, late shifts,
    exact duplicates and events of users the attribution side never saw."""
    ev = events.filter(F.col("event_type").isin(*EVENT_TYPE_TO_BACKEND))
    eid = F.col("event_id")
    et = F.col("event_type")
    event = None
    for t, b in EVENT_TYPE_TO_BACKEND.items():
        event = F.when(et == t, b) if event is None else event.when(et == t, b)
    drift = (F.lit(85) + eid % 26) * F.lit(0.01).cast("decimal(2,2)")
    base_time = to_second("ts")
    # one scan: every event yields its own row, plus an exact duplicate (event_id % 33 = 0) and a copy
    # under an id the attribution side never saw (event_id % 10 = 0)
    copies = F.filter(F.array(F.lit(0), F.when(eid % 33 == 0, F.lit(1)), F.when(eid % 10 == 0, F.lit(2))),
                      lambda c: c.isNotNull())
    rows = ev.select(
        F.col("user_id").cast("string").alias("uid"),
        event.alias("event"),
        (F.col("value").cast(MONEY_EVENT) * drift).cast(MONEY_EVENT).alias("revenue"),
        F.when(eid % 20 == 1, plus_days(base_time, 15)).otherwise(base_time).alias("event_time"),
        F.explode(copies).alias("copy"),
    )
    return rows.select(
        F.when(F.col("copy") == 2, F.concat(F.lit("x"), F.col("uid"))).otherwise(F.col("uid")).alias("user_id"),
        "event", "revenue", "event_time", _loaded_at())


def singular_from(dev: DataFrame, orders: DataFrame) -> DataFrame:
    """Daily network rows, one per order (every order is used). Organic devices and one campaign buy nothing:
    their rows carry impressions and clicks, no network installs and cost 0."""
    orders = orders.select("o_orderkey", "o_custkey", "o_totalprice")
    ok = F.col("o_orderkey")
    price = F.col("o_totalprice").cast(MONEY_COST)
    bought = ~organic_col() & (F.coalesce(F.col("campaign"), F.lit("")) != NO_SPEND_CAMPAIGN)
    return orders.join(dev, orders.o_custkey == dev.k, "inner").select(
        F.date_add(F.lit(SPEND_EPOCH).cast("date"), (ok % 30).cast("int")).alias("date"),
        F.col("media_source").alias("source"),
        F.when(ok % 97 == 0, F.concat(F.lower("segment"), F.lit("_spendonly")))
        .otherwise(F.col("campaign")).alias("campaign"),
        F.col("country_code").alias("country"),
        F.floor(price * F.lit(0.01).cast("decimal(2,2)")).cast("int").alias("impressions"),
        F.floor(price * F.lit(0.0002).cast("decimal(4,4)")).cast("int").alias("clicks"),
        F.when(bought, F.floor(price * F.lit(0.00002).cast("decimal(5,5)")).cast("int")).otherwise(0).alias("installs"),
        F.when(bought & (ok % 211 != 0), (price * F.lit(0.001).cast("decimal(3,3)")).cast(MONEY_COST))
        .otherwise(F.lit(0).cast(MONEY_COST)).alias("cost"),
        _loaded_at(),
    )


def skan_base_from(dev: DataFrame) -> DataFrame:
    """One privacy postback per iOS paid install, conversion values not yet withheld."""
    k = F.col("k")
    return dev.filter(~organic_col() & (F.col("platform") == "iOS")).select(
        F.concat(F.lower("segment"), F.lit(".skadnetwork")).alias("ad_network_id"),
        F.col("campaign").alias("source_identifier"),
        F.when((k * 37) % 100 < 55, 0).otherwise((k * 37) % 64).cast("smallint").alias("conversion_value"),
        (k % 3).cast("smallint").alias("postback_sequence_index"),
        F.when(k % 14 == 0, 1).otherwise(0).alias("redownload"),
    )


def skan_from(base: DataFrame) -> DataFrame:
    """Postbacks as delivered: values withheld for campaigns under the crowd-anonymity threshold,
    and for one campaign whose postbacks never carry a value."""
    posts = k_anonymize(base, "source_identifier", "conversion_value", K_ANONYMITY_THRESHOLD)
    posts = posts.withColumn(
        "conversion_value",
        F.when(F.col("source_identifier") == NO_SPEND_CAMPAIGN, F.lit(None).cast("smallint"))
        .otherwise(F.col("conversion_value")))
    return posts.select("ad_network_id", "source_identifier", "conversion_value",
                        "postback_sequence_index", "redownload", _loaded_at())


class RawSources:
    """The four bronze sources."""

    def __init__(self, appsflyer: DataFrame, singular: DataFrame, skan: DataFrame, backend: DataFrame):
        self.appsflyer, self.singular, self.skan, self.backend = appsflyer, singular, skan, backend

    def as_dict(self) -> dict[str, DataFrame]:
        return {"appsflyer": self.appsflyer, "singular": self.singular, "skan": self.skan,
                "backend": self.backend}


class FixtureSources(RawSources):
    """Raw sources derived from the driver's tables, built lazily: a query only plans the sources it
    uses, and every table is read (and the device frame derived) once per instance."""

    def __init__(self, spark: SparkSession, sf_dir: str):  # noqa: super-init deliberately not called
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        cache = self.__dict__.setdefault("_tables", {})
        if name not in cache:
            cache[name] = read_table(self.spark, self.sf_dir, name)
        return cache[name]

    @cached_property
    def devices(self) -> DataFrame:
        return device_columns(self.table("customer"))

    @cached_property
    def appsflyer(self) -> DataFrame:
        return appsflyer_from(self.devices, self.table("events"))

    @cached_property
    def singular(self) -> DataFrame:
        return singular_from(self.devices, self.table("orders"))

    @cached_property
    def skan_base(self) -> DataFrame:
        return skan_base_from(self.devices)

    @cached_property
    def skan(self) -> DataFrame:
        return skan_from(self.skan_base)

    @cached_property
    def backend(self) -> DataFrame:
        return backend_from(self.table("events"))


def load_fixture_sources(spark: SparkSession, sf_dir: str) -> FixtureSources:
    return FixtureSources(spark, sf_dir)


def raw_appsflyer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FixtureSources(spark, sf_dir).appsflyer


def raw_singular(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FixtureSources(spark, sf_dir).singular


def raw_skan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FixtureSources(spark, sf_dir).skan


def raw_backend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FixtureSources(spark, sf_dir).backend


def skan_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FixtureSources(spark, sf_dir).skan_base
