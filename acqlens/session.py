"""Spark session defaults for the engine and helpers that read cluster settings from the session."""
from __future__ import annotations

import atexit
import os
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs are designed around. Partition counts are sized per deployment:
# on a cluster, shuffle partitions ~ (largest shuffle bytes / 128 MiB); AQE coalesces small ones.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # coalesce shuffle partitions to the advisory size, not to maximal parallelism (Spark's advice for
    # shared clusters; fewer, fuller tasks)
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join partition even when that costs one more shuffle downstream (one key may
    # hold a third of the rows)
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Broadcast only what AQE measured at runtime to be below this size; never by compressed file sizes
    # at planning time.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    # cohort joins: a Bloom filter of the install directory's ids (built from its own filtered scan, 8 MB at most)
    # drops events of unknown devices before they are shuffled, where the event scan is large
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "acqlens", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(ENGINE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared lineage-cut folder: ``spark.checkpoint.dir`` from the session, set only when unset.

    On a cluster this must be a shared (distributed) path supplied by the deployment; the fallback is
    for local tests only.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: give the cluster a shared folder for "
                             "materialised tables and checkpoints (a machine-local path would not survive "
                             "executor loss)")
        path = fallback or os.path.join(os.environ.get("TMPDIR", "/tmp"), "acqlens-checkpoints")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder from whatever file system it is on; nothing happens if it is not there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def forget_shuffles(spark: SparkSession) -> None:
    """Spark deletes the shuffle files of frames that nothing refers to any more when the driver collects garbage,
    which a small driver heap rarely does: jobs of many steps ask for it, so that their disk does not add up."""
    spark._jvm.System.gc()


class Scratch:
    """Tables that one owner writes to the shared checkpoint folder and frees together. Each is written once and
    read back, so lineage ends at the files and a lost executor re-reads them. Use it as a context, or call
    ``free`` when nothing reads the tables any more."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = os.path.join(ensure_checkpoint_dir(spark), f"acqlens-{name}-{uuid.uuid4().hex}")

    def path(self, name: str) -> str:
        return os.path.join(self.root, name)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def until_exit(self) -> "Scratch":
        """For tables that a lazy result goes on reading: freed when the process ends."""
        atexit.register(self._last)
        return self

    def _last(self) -> None:
        if self.spark.sparkContext._jsc is not None:      # the session may have been stopped before
            self.free()

    def free(self) -> None:
        delete_folder(self.spark, self.root)

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *_) -> None:
        self.free()


def kept(df: DataFrame) -> DataFrame:
    """A result of a few rows (counts per check, source or load) as a frame that no table stands behind."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)
