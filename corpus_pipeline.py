"""The corpus pipeline: documents -> language -> quality -> near duplicates -> secrets -> packed sequences.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and all but the last
return the columns of ``documents``. ``run`` writes each stage's rows as Parquet to the shared folder and
reads them back as the next one's docs. Null and empty texts are not a language and go in the first stage;
repeated rows with one doc_id become one in the third (that of the smallest text). Extra columns are carried through
unchanged, also those named like a column that a stage adds for its own use. An empty table gives an empty result.
"""
from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acqlens.llm import langid, packing, quality_rules, secrets, simhash_dedup
from acqlens.llm.common import remainder, table, written
from acqlens.llm.queries import tokenizer_path

LEAST_SCORE = 0.5   # of a document's language


def _judged(docs: DataFrame, added: Iterable[str], judge: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows that ``judge`` keeps, as they came: columns named like those it adds step aside meanwhile."""
    names = {a.lower() for a in added}
    aside = {c: f"__aside_{i}" for i, c in enumerate(docs.columns) if c.lower() in names}
    return judge(docs.withColumnsRenamed(aside)).select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that have no language or whose best language scores under ``LEAST_SCORE``."""
    model = langid.learn(docs, remainder(F.col("doc_id"), 4) != 2)
    return _judged(docs, ("lang_pred", "lang_score"), lambda rows: langid.predict(rows, model).filter(
        (F.col("lang_pred") != "und") & (F.col("lang_score") >= LEAST_SCORE)))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that the base rule or the learned decision list rejects."""
    return _judged(docs, (*quality_rules.COUNTS, "base_failed", "kept"),
                   lambda rows: quality_rules.judge(rows, table(spark, sf_dir, "labels")).filter("kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, that of the smallest id."""
    return simhash_dedup.dedup(docs).select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret gives way to a mark; ``n_chars`` follows where the text changed."""
    clean = secrets.redact(docs.withColumn("__before", F.col("text")))
    return clean.withColumn("n_chars", F.when(F.col("text") != F.col("__before"), F.length("text").cast("long"))
                            .otherwise(F.col("n_chars"))).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences; its ids are those of the text
    from ``start``, ``length`` tokens long, checked by ``ids_crc32``."""
    pieces = packing.token_pieces(docs, tokenizer_path("byte_bpe_50k.json"))
    return packing.pack(written(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "pieces"))


STAGES = [("language ID", language_id), ("quality rules", quality), ("SimHash near-dedup", near_dedup),
          ("secret scans", secret_scan), ("best-fit packing", best_fit_packing)]
ORACLE_SQL = None   # fingerprints, learned rules and tokens are beyond SQL; tests hold it against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.lower().replace(" ", "-"))
    return docs
