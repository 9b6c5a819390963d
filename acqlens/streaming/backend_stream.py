"""Incremental backend de-duplication with Structured Streaming.

Same rule as the batch ``backend_dedup`` (one row per user, event and event time; highest revenue wins) over
rows that arrive in any order. Per micro-batch (``foreachBatch``):

* the high-water mark is the latest event time seen in earlier batches, the limit lies ``allowed_lateness``
  before it;
* a row before the limit is *late*: its key may have been closed and handed on. It goes to the late output
  and is counted (as do rows without an event time, which no mark ever passes);
* every other row is merged with the open rows of the batch before; keys before the new limit are closed
  (appended to the output once), the rest stays open for the next batch.

Closed, open and late rows together hold every row that arrived, so ``reconciled`` equals the batch result; what
reads only the closed rows knows by the counts what it lacks. Open rows are bounded by the lateness window, not
by history. A batch's folders are named by its number and overwritten, so a batch that is run again after a
failure leaves what it would have left.
"""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType, TimestampNTZType

from acqlens.operators.staging import backend_dedup
from acqlens.schemas import LOADED_AT, RAW_BACKEND
from acqlens.session import delete_folder, ensure_checkpoint_dir
from acqlens.sources.loader import read_if_there

ROWS = "user_id string, event string, revenue decimal(12,2), event_time timestamp_ntz"
MARKS = "high_water timestamp_ntz, n_rows bigint, n_late bigint, n_closed bigint, n_open bigint, batch bigint"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    df = read_if_there(spark, path, schema)
    return spark.createDataFrame([], schema) if df is None else df.select(*[c.split()[0] for c in schema.split(", ")])


class LateAwareDedup:
    """The state and output of one stream under ``sink_dir``: ``closed``, ``open``, ``late`` and ``marks``, each with
    one folder a batch."""

    def __init__(self, sink_dir: str, allowed_lateness: str = "2 days"):
        self.sink_dir = sink_dir
        self.lateness = F.expr(f"INTERVAL {allowed_lateness}")

    def _path(self, kind: str, batch: int) -> str:
        return os.path.join(self.sink_dir, kind, f"batch={batch}")

    def process(self, rows: DataFrame, batch: int) -> None:
        spark, names = rows.sparkSession, [c.split()[0] for c in ROWS.split(", ")]
        before = _read(spark, self._path("marks", batch - 1), MARKS).select("high_water").first() if batch else None
        mark = F.lit(before.high_water if before else None).cast("timestamp_ntz")
        time = F.col("event_time")
        is_late = time.isNull() | F.coalesce(time < mark - self.lateness, F.lit(False))
        rows = rows.select(*names)
        rows.filter(is_late).write.mode("overwrite").parquet(self._path("late", batch))
        seen = rows.agg(F.max("event_time").alias("t"), F.count(F.lit(1)).alias("n"),
                        F.sum(is_late.cast("long")).alias("late")).first()
        high = F.greatest(mark, F.lit(seen.t).cast("timestamp_ntz"))       # greatest skips NULL
        earlier = _read(spark, self._path("open", batch - 1), ROWS)
        merged = backend_dedup(earlier.unionByName(rows.filter(~is_late)))
        done = F.coalesce(time < high - self.lateness, F.lit(False))
        # one pass for both outputs: the merged rows are written split, then each part is renamed by reading
        staged = self._path("merged", batch)
        merged.withColumn("closed", done).write.mode("overwrite").partitionBy("closed").parquet(staged)
        split = spark.read.schema(ROWS + ", closed boolean").parquet(staged)
        counts = {}
        for kind, cond in (("closed", F.col("closed")), ("open", ~F.col("closed"))):
            part = split.filter(cond).drop("closed")
            part.write.mode("overwrite").parquet(self._path(kind, batch))
            counts[kind] = _read(spark, self._path(kind, batch), ROWS).count()
        spark.range(1).select(high.alias("high_water"), F.lit(seen.n).cast("long").alias("n_rows"),
                              F.lit(seen.late or 0).cast("long").alias("n_late"),
                              F.lit(counts["closed"]).cast("long").alias("n_closed"),
                              F.lit(counts["open"]).cast("long").alias("n_open")) \
            .write.mode("overwrite").parquet(self._path("marks", batch))
        delete_folder(spark, staged)
        if batch > 1:                                  # a batch run again needs only the one before it
            delete_folder(spark, self._path("open", batch - 2))

    def marks(self, spark: SparkSession) -> DataFrame:
        """Per batch: rows, late rows, keys closed, keys left open, and the high-water mark after it."""
        return _read(spark, os.path.join(self.sink_dir, "marks"), MARKS)

    def closed(self, spark: SparkSession) -> DataFrame:
        return _read(spark, os.path.join(self.sink_dir, "closed"), ROWS)

    def late(self, spark: SparkSession) -> DataFrame:
        return _read(spark, os.path.join(self.sink_dir, "late"), ROWS)

    def open(self, spark: SparkSession) -> DataFrame:
        """Rows still waiting, as of the last batch."""
        last = self.marks(spark).agg(F.max("batch").alias("b")).first().b
        return _read(spark, self._path("open", last if last is not None else 0), ROWS)

    def reconciled(self, spark: SparkSession) -> DataFrame:
        """The batch result: every row that arrived, de-duplicated."""
        return backend_dedup(self.closed(spark).unionByName(self.open(spark)).unionByName(self.late(spark)))


def start_backend_dedup(spark: SparkSession, source_dir: str, sink_dir: str, allowed_lateness: str = "2 days",
                        checkpoint_location: str | None = None, available_now: bool = True,
                        max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Read raw backend parquet files as they land in ``source_dir`` and keep ``LateAwareDedup(sink_dir)`` up to
    date. Progress lives under ``checkpoint_location`` (by default a folder in ``spark.checkpoint.dir`` named by
    the sink), so a restarted query goes on where it stopped."""
    schema = StructType(list(RAW_BACKEND.fields) + [StructField(LOADED_AT, TimestampNTZType())])
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    name = "acqlens-stream-" + sink_dir.strip("/").replace("/", "-").replace(":", "")
    cp = checkpoint_location or os.path.join(ensure_checkpoint_dir(spark), name)
    w = (reader.parquet(source_dir).writeStream.foreachBatch(LateAwareDedup(sink_dir, allowed_lateness).process)
         .option("checkpointLocation", cp))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
