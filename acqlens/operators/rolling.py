"""Distinct payers over rolling day ranges from stored bitmaps: exact, and a new day never rescans old ones.

Device ids get dense numbers (``number_devices``): a shard by hash, and a running number within the shard, kept
in a directory that only grows. A day's payers of a channel are then bitmaps of 32,768 numbers each
(``day_bitmaps``: one row per day, channel and block of numbers, 4 KB at most). Bitmaps merge by OR, so a range of
days is the OR of its days' bitmaps, counted per block and summed: the events are read once, when their day is
stored, and each distinct device counts once however often it pays. Days that are delivered again replace theirs.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARDS = 64


def number_devices(devices: DataFrame, directory: DataFrame | None = None, shards: int = SHARDS) -> DataFrame:
    """(device, shard, number) of all devices: those of ``directory`` keep their numbers, others get the next
    of their shard. Numbering is a window per shard: raise ``shards`` with the number of devices."""
    new = devices.select("device").filter("device is not null").distinct()
    if directory is not None:
        new = new.join(directory, "device", "left_anti")
    new = new.withColumn("shard", F.pmod(F.xxhash64("device"), F.lit(shards)).cast("int")).withColumn(
        "number", F.row_number().over(Window.partitionBy("shard").orderBy("device")).cast("long"))
    if directory is None:
        return new
    last = directory.groupBy("shard").agg(F.max("number").alias("last"))
    return directory.unionByName(new.join(last, "shard", "left").select(
        "device", "shard", (F.col("number") + F.coalesce("last", F.lit(0))).alias("number")))


def day_bitmaps(payers: DataFrame, directory: DataFrame) -> DataFrame:
    """(day, channel, shard, block, bits) from payer rows (day, channel, device). Rows are made distinct before
    the join with the directory, so a device with a huge share of the events is one row a day."""
    return (payers.select("day", "channel", "device").distinct().join(directory, "device")
            .groupBy("day", "channel", "shard", F.bitmap_bucket_number("number").alias("block"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")))


def rolling_payers(bitmaps: DataFrame, ranges: tuple[int, ...] = (7, 30)) -> DataFrame:
    """Per channel and day with payers: distinct payers of the last n days (that day included), for every n."""
    most, widths = max(ranges), sorted(ranges)
    days = bitmaps.select("channel", F.col("day").alias("activity_date")).distinct()
    # a bitmap counts towards the days that follow it: n bitmaps a day, not n times the events
    ahead = bitmaps.select("*", F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("age")) \
        .withColumn("activity_date", F.date_add("day", F.col("age")))
    blocks = ahead.join(days, ["channel", "activity_date"], "left_semi") \
        .groupBy("activity_date", "channel", "shard", "block") \
        .agg(*[F.bitmap_or_agg(F.when(F.col("age") < n, F.col("bits"))).alias(f"_{n}") for n in widths])
    return blocks.groupBy("activity_date", F.col("channel").alias("channel_key")).agg(
        *[F.sum(F.bitmap_count(f"_{n}")).cast("bigint").alias(f"payers_{n}d") for n in widths])
