"""Shared helpers of the llm operators: words, tables in the shared folder, hash remainders."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acqlens.session import Scratch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back: cuts the lineage, so what follows
    neither recomputes it nor depends on executors that may be lost. The folder goes when the process ends."""
    scratch = Scratch(df.sparkSession, f"llm-{name}").until_exit()
    df.write.option("compression", codec).parquet(scratch.root)
    return df.sparkSession.read.schema(df.schema).parquet(scratch.root)


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null ids count as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def words(text: str | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text as UTF-8 bytes (bytes.split cuts at just these)."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def lower_words(text: str | None) -> list[bytes]:
    """The same with A-Z in lower case (bytes.lower changes no other character)."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def small_batches(batches: Iterator[pa.RecordBatch], max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``max_bytes`` at most (one row at least), so that what a task
    builds from a batch stays small however long the texts are."""
    for batch in batches:
        step = max(1, int(batch.num_rows * max_bytes / max(batch.nbytes, 1)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def starts_of(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin in sorted columns."""
    n = len(keys[0])
    if not n:
        return np.zeros(0, np.int64)
    new = np.zeros(n, bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)
