"""Bronze loader: typed CSV -> raw tables, the Spark form of the reference's ingestion.

* columns are bound by header *name* (a reordered file still loads), every field read as text and cast
  explicitly; an empty field is NULL for every type; a malformed number or time fails the load
  (ANSI casts raise); quoted fields may hold quotes (doubled) and line breaks, so one file is one split:
  deliver large sources as folders of files;
* a load parses each source once into its own uncommitted folder on shared storage, validates it there,
  and becomes visible only by its manifest row, after all four are written (all-or-nothing);
* every row gets one load stamp per run; a full load replaces everything before it, an incremental load
  adds one delivery to it. A delivery that is loaded again replaces its own rows and no others;
* tables are laid out by their date (partition column) so date predicates prune files; the postback
  table has no date and is clustered by campaign instead.
"""
from __future__ import annotations

import datetime as dt
import os
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from acqlens.functions.dates import round_to_second
from acqlens.operators.unions import union_all
from acqlens.schemas import LOADED_AT, RAW_APPSFLYER, RAW_BACKEND, RAW_SINGULAR, RAW_SKAN
from acqlens.sources.domains import split

# source name -> (csv file name, schema, partition column expression name, partition source column)
SPECS = {
    "appsflyer": ("appsflyer_raw.csv", RAW_APPSFLYER, "install_date", "install_time"),
    "singular": ("singular_cost.csv", RAW_SINGULAR, "spend_date", "date"),
    "skan": ("skan_postbacks.csv", RAW_SKAN, None, "source_identifier"),
    "backend": ("backend_events.csv", RAW_BACKEND, "event_date", "event_time"),
}


def read_text_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Header CSV as text, the columns of ``schema`` by name."""
    text = (spark.read.option("header", True).option("encoding", "UTF-8").option("mode", "FAILFAST")
            .option("inferSchema", False).option("escape", '"').option("multiLine", True).csv(path))
    missing = [f.name for f in schema.fields if f.name not in text.columns]
    if missing:
        raise ValueError(f"{path}: missing columns {missing}")
    return text.select(*schema.fieldNames())


def read_typed_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Header CSV -> ``schema`` by column name; '' -> NULL; bad values raise at evaluation."""
    text = read_text_csv(spark, path, schema)
    cols = []
    for f in schema.fields:
        c = F.when(F.col(f.name) == "", F.lit(None)).otherwise(F.col(f.name))
        typed = c.cast(f.dataType)
        if f.dataType.simpleString() != "string":
            # strict even when ANSI casts are off: a value that does not parse fails the load
            typed = F.when(c.isNotNull() & c.try_cast(f.dataType).isNull(),
                           F.raise_error(F.concat(F.lit(f"{path}: bad {f.name} value "), c))
                           ).otherwise(typed)
        typed = typed.cast(f.dataType)
        if f.dataType.simpleString() == "timestamp_ntz":
            typed = round_to_second(typed)   # the raw contract stores whole seconds (rounded)
        cols.append(typed.alias(f.name))
    return text.select(*cols)


def validate_not_null(df: DataFrame, schema: StructType, name: str) -> None:
    """One aggregate over every column: NULLs in NOT NULL columns fail the load, and evaluating all
    columns surfaces any value that does not parse."""
    required = [f.name for f in schema.fields if not f.nullable]
    checks = [F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).alias(f"null_{c}") for c in required]
    touch = [F.count(F.col(f.name)).alias(f"n_{f.name}") for f in schema.fields]
    row = df.agg(*checks, *touch).first()
    bad = {c: row[f"null_{c}"] for c in required if row[f"null_{c}"]}
    if bad:
        raise ValueError(f"{name}: NULL in NOT NULL columns {bad}")


def stage_sources(spark: SparkSession, csv_dir: str, loaded_at: dt.datetime | None = None,
                  validate: bool = True, rejects: str | None = None) -> dict[str, DataFrame]:
    """The four sources parsed, typed and stamped; with ``validate`` every value is checked here (one pass). With
    ``rejects`` (a folder), rows that break a domain are written there instead of raising."""
    stamp = (loaded_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).strftime("%Y-%m-%d %H:%M:%S.%f")
    out = {}
    for name, (fname, schema, _, _) in SPECS.items():
        path = os.path.join(csv_dir, fname)
        if rejects:
            df, bad = split(read_text_csv(spark, path, schema), name)
            bad.write.mode("overwrite").parquet(os.path.join(rejects, name))
        else:
            df = read_typed_csv(spark, path, schema)
        if validate:
            validate_not_null(df, schema, name)
        out[name] = df.withColumn(LOADED_AT, F.lit(stamp).cast("timestamp_ntz"))
    return out


def write_raw(df: DataFrame, path: str, part_col: str | None, source_col: str) -> None:
    """Overwrite one raw table. Date-partitioned tables are rebalanced by date first: a date's rows meet in
    a few full files, and AQE splits a hot date over several tasks."""
    if part_col:
        df = df.withColumn(part_col, F.to_date(source_col)).hint("rebalance", F.col(part_col))
        df.write.mode("overwrite").partitionBy(part_col).parquet(path)
    else:
        df.sortWithinPartitions(source_col).write.mode("overwrite").parquet(path)


# when each source's rows happened (postbacks carry no time)
EVENT_TIME = {"appsflyer": ("event_time", "install_time"), "singular": ("date",), "skan": (), "backend": ("event_time",)}
MARKS = "_marks"
MARKS_SCHEMA = "load_id string, source_name string, row_count bigint, high_water timestamp_ntz"


def high_water_marks(tables: dict[str, DataFrame]) -> DataFrame:
    """(source_name, row_count, high_water): the latest event time per source (NULL without rows or clock)."""
    parts = []
    for name, df in tables.items():
        times = [F.max(F.col(c).cast("timestamp_ntz")) for c in EVENT_TIME[name]]
        high = F.greatest(*times) if len(times) > 1 else times[0] if times else F.lit(None).cast("timestamp_ntz")
        parts.append(df.agg(F.count(F.lit(1)).alias("row_count"), high.alias("high_water"))
                     .select(F.lit(name).alias("source_name"), "row_count", "high_water"))
    return union_all(parts)


def record_marks(spark: SparkSession, target_dir: str, load_id: str, tables: dict[str, DataFrame]) -> None:
    """Keep the marks of one load (four rows) under ``<target>/_marks``."""
    (high_water_marks(tables).select(F.lit(load_id).alias("load_id"), "source_name", "row_count", "high_water")
     .write.mode("overwrite").parquet(os.path.join(target_dir, MARKS, load_id)))


def read_marks(spark: SparkSession, target_dir: str) -> DataFrame:
    return spark.read.schema(MARKS_SCHEMA).option("recursiveFileLookup", True).parquet(os.path.join(target_dir, MARKS))


MANIFEST = "_loads"
MANIFEST_SCHEMA = "load_id string, committed_at timestamp_ntz, delivery string"


def read_if_there(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """The parquet table under ``path``, or None if that path does not exist; other failures raise."""
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def committed_load(spark: SparkSession, target_dir: str) -> str | None:
    """What readers see under ``target_dir``: the id of the latest full load and, joined by '+', those of
    the deliveries added since (the latest load of each). None before the first full load."""
    manifest = read_if_there(spark, os.path.join(target_dir, MANIFEST), MANIFEST_SCHEMA)
    if manifest is None:
        return None
    full = manifest.filter("delivery is null").agg(F.max_by("load_id", "committed_at").alias("id"),
                                                   F.max("committed_at").alias("at")).first()
    if full.id is None:
        return None
    added = (manifest.filter(F.col("delivery").isNotNull() & (F.col("committed_at") > F.lit(full["at"])))
             .groupBy("delivery").agg(F.max_by("load_id", "committed_at").alias("id")).collect())
    return "+".join([full.id, *sorted(r.id for r in added)])


def table_dir(spark: SparkSession, target_dir: str, name: str) -> str:
    """Folder of raw table ``name`` in the latest full load, or in the plain layout."""
    load_id = committed_load(spark, target_dir)
    return os.path.join(target_dir, "loads", load_id.split("+")[0], name) if load_id else os.path.join(target_dir, name)


def load_raw(spark: SparkSession, csv_dir: str, target_dir: str, loaded_at: dt.datetime | None = None,
             incremental: bool = False, delivery: str | None = None, quarantine: bool = False) -> dict[str, int]:
    """Load the four raw tables under ``target_dir``; returns their row counts after the load.

    The tables go to a new ``loads/<load_id>/`` folder and become visible by one row in the ``_loads``
    manifest, appended after every table is written and validated; a failed load changes nothing. An
    ``incremental`` load adds its rows to those of the current load, whatever dates they touch. It must be
    named by ``delivery`` (two true deliveries may hold equal rows): loading the same name again replaces its
    own rows. Each delivery adds a folder to read; a full load takes them together. With ``quarantine``, rows
    that break a column's domain go to ``loads/<load_id>/rejects/<table>`` with their reasons instead of failing
    the load. High-water marks of the load's event times are kept for ``sources.freshness``.
    """
    if incremental and not delivery:
        raise ValueError("an incremental load needs the name of its delivery")
    if incremental and committed_load(spark, target_dir) is None:
        raise ValueError("an incremental load needs a committed full load first")
    load_id = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S") + "-" + uuid.uuid4().hex[:8]
    tables = {}
    rejects = os.path.join(target_dir, "loads", load_id, "rejects") if quarantine else None
    for name, df in stage_sources(spark, csv_dir, loaded_at, validate=False, rejects=rejects).items():
        _, schema, part_col, source_col = SPECS[name]
        path = os.path.join(target_dir, "loads", load_id, name)
        write_raw(df, path, part_col, source_col)
        tables[name] = spark.read.schema(df.schema).parquet(path)
        validate_not_null(tables[name], schema, name)
    record_marks(spark, target_dir, load_id, tables)
    label = delivery if incremental else None
    commit = spark.createDataFrame([(load_id, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), label)],
                                   MANIFEST_SCHEMA)
    commit.write.mode("append").parquet(os.path.join(target_dir, MANIFEST))
    return {name: df.count() for name, df in read_raw(spark, target_dir).items()}


def read_raw(spark: SparkSession, target_dir: str, keep_partition_column: bool = False,
             load_id: str | None = None) -> dict[str, DataFrame]:
    """Raw tables of one committed state (``load_id`` as ``committed_load`` gives it, by default the latest;
    resolved once for all four), or of the plain ``<target>/<table>`` layout. The date partition column is
    dropped unless ``keep_partition_column`` (day-restricted reads filter on it to prune partitions)."""
    load_id = load_id or committed_load(spark, target_dir)
    roots = [os.path.join(target_dir, "loads", part) for part in load_id.split("+")] if load_id else [target_dir]
    out = {}
    for name, (_, schema, part_col, _) in SPECS.items():
        extra = ", ".join(f"{c} {t}" for c, t in [(LOADED_AT, "timestamp_ntz"), (part_col, "date")] if c)
        full = StructType(schema.fields + StructType.fromDDL(extra).fields)
        keep = [*schema.fieldNames(), LOADED_AT, *([part_col] if keep_partition_column and part_col else [])]
        parts = [spark.read.schema(full).parquet(os.path.join(root, name)).select(*keep) for root in roots]
        out[name] = reduce(DataFrame.unionByName, parts)
    return out


def write_source_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Export a raw frame as header CSV, one file per task (``single_file`` is for small exports: all rows
    pass one task); the loader reads either a file or a folder of part files."""
    out = df.drop(LOADED_AT)
    if single_file:
        out = out.coalesce(1)
    (out.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def row_digest(columns: list[str]) -> Column:
    """60 bits of the MD5 of a row's values as text (NULL and empty differ)."""
    text = F.concat_ws("\u001f", *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in columns])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("decimal(38,0)")


def table_digests(tables: dict[str, DataFrame]) -> DataFrame:
    """Per table: rows, and the sum of the digests of all rows over all columns but the load stamp. Two tables
    agree if they hold the same rows equally often, in any order: a lost, doubled or changed value shows."""
    parts = []
    for n, df in tables.items():
        columns = [c for c in df.columns if c != LOADED_AT]
        parts.append(df.agg(F.count(F.lit(1)).alias("row_count"), F.sum(row_digest(columns)).alias("rows_digest"))
                     .select(F.lit(f"raw.{n}").alias("table_name"), "row_count",
                             F.coalesce("rows_digest", F.lit(0)).cast("decimal(38,0)").alias("rows_digest")))
    return union_all(parts)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table as a small DataFrame ``(table_name, row_count)``."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(f"raw.{n}").alias("table_name"), "row_count")
             for n, df in tables.items()]
    return union_all(parts)
