import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from acqlens.functions import (campaign_key, channel_type, cv_band, day_diff, is_paid, plus_days,
                               standardize_channel, us_week_of_year)
from acqlens.functions.channel import CHANNEL_ALIASES
from acqlens.functions.ratios import nullif_ratio, ratio


def test_channel_aliases_all_spellings(spark):
    rows = []
    for canonical, aliases in CHANNEL_ALIASES.items():
        for a in aliases:
            rows += [(f"  {a.upper()} ", canonical), (a.title(), canonical), (a, canonical)]
    rows += [(None, "organic"), ("", "organic"), ("  ", "organic"), ("Snapchat ", "Snapchat ")]
    df = spark.createDataFrame(rows, "raw string, want string")
    got = df.select("want", standardize_channel("raw").alias("got")).collect()
    assert all(r.got == r.want for r in got), [r for r in got if r.got != r.want]


def test_unknown_channel_passes_through_unchanged_and_is_paid(spark):  # S20
    r = spark.createDataFrame([(" Snap ",)], "c string").select(
        standardize_channel("c").alias("ch")).select("ch", is_paid("ch").alias("p"), channel_type("ch").alias("t")).first()
    assert (r.ch, r.p, r.t) == (" Snap ", 1, "Other")


def test_channel_types(spark):
    df = spark.createDataFrame([("organic",), ("Apple Search Ads",), ("Google Ads",), ("Meta",), ("TikTok",)], "c string")
    got = {r.c: r.t for r in df.select("c", channel_type("c").alias("t")).collect()}
    assert got == {"organic": "Organic", "Apple Search Ads": "Search", "Google Ads": "Search/Display",
                   "Meta": "Social", "TikTok": "Social"}


def test_campaign_key_null_campaign(spark):  # S1
    r = spark.createDataFrame([("organic", None), ("Meta", "x")], "ch string, ca string").select(
        campaign_key("ch", "ca").alias("k")).collect()
    assert [x.k for x in r] == ["organic|", "Meta|x"]


def test_day_diff_counts_midnights(spark):  # S2
    df = spark.createDataFrame([
        (dt.datetime(2024, 1, 1, 23, 50), dt.datetime(2024, 1, 2, 0, 10), 1),
        (dt.datetime(2024, 1, 1, 0, 0), dt.datetime(2024, 1, 1, 23, 59), 0),
        (dt.datetime(2024, 1, 2, 0, 10), dt.datetime(2024, 1, 1, 23, 50), -1),
    ], "a timestamp_ntz, b timestamp_ntz, want int")
    assert all(r.got == r.want for r in df.select("want", day_diff("a", "b").alias("got")).collect())


def test_late_boundary_keeps_time_of_day(spark):  # S3
    inst = dt.datetime(2024, 1, 1, 10, 0, 0)
    df = spark.createDataFrame([(inst, inst + dt.timedelta(days=21), 0),
                                (inst, inst + dt.timedelta(days=21, seconds=1), 1)],
                               "i timestamp_ntz, e timestamp_ntz, want int")
    got = df.select("want", F.when(F.col("e") > plus_days("i", 21), 1).otherwise(0).alias("got")).collect()
    assert all(r.got == r.want for r in got)


def _us_week(d: dt.date) -> int:
    """Independent count: week 1 holds 1 January and a new week starts on every later Sunday."""
    jan1 = dt.date(d.year, 1, 1)
    return 1 + sum(1 for i in range(1, (d - jan1).days + 1) if (jan1 + dt.timedelta(days=i)).weekday() == 6)


def test_us_week_matches_calendar_2020_2031(spark):  # S4, S5
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range((dt.date(2031, 12, 31) - dt.date(2020, 1, 1)).days + 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = {r.d: (r.w, r.dow) for r in df.select("d", us_week_of_year("d").alias("w"),
                                                 F.dayofweek("d").alias("dow")).collect()}
    bad = [d for d in days if got[d][0] != _us_week(d)]
    assert not bad, bad[:5]
    assert got[dt.date(2026, 5, 10)][0] == 20
    assert got[dt.date(2024, 1, 7)][1] == 1   # Sunday = 1


def test_ratio_rounds_half_up_once(spark):
    df = spark.createDataFrame([(Decimal("0.05"), 2, Decimal("0.03")), (Decimal("-0.05"), 2, Decimal("-0.03")),
                                (Decimal("1.00"), 3, Decimal("0.33")), (Decimal("5.00"), 0, None)],
                               "n decimal(12,2), d bigint, want decimal(12,2)")
    got = df.select("want", ratio(F.col("n"), F.col("d"), 12, 2, when=F.col("d") != 0).alias("got")).collect()
    assert all(r.got == r.want for r in got)
    r = spark.createDataFrame([(Decimal("1.00"), 0)], "n decimal(12,2), d int").select(
        nullif_ratio(F.col("n"), F.col("d"), 10, 2).alias("x")).first()
    assert r.x is None


def test_cv_bands(spark):
    vals = [None, 0, 1, 15, 16, 39, 40, 63]
    want = ["unknown", "none", "low", "low", "medium", "medium", "high", "high"]
    df = spark.createDataFrame([(v,) for v in vals], "cv smallint")
    assert [r.b for r in df.select(cv_band("cv").alias("b")).collect()] == want
