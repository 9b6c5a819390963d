"""The registered queries of this package, ``opN_<name>``, and their SQL where SQL can express them."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acqlens.llm import (importance, langid, licenses, nn_descent, packing, periodic_runs, piece_scan, pitman_yor,
                         prefix_prints, quality_rules, secrets, simhash_dedup, toxicity)
from acqlens.llm.common import remainder, table, written
from acqlens.llm.sql import ORACLES  # noqa: F401  (read by the entry module)

QueryFn = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str) -> str:
    """The file of a public tokenizer, as the host's ``public_tokenizers`` module gives it."""
    import public_tokenizers
    return str(public_tokenizers.path(name))


def op1_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score(table(spark, sf_dir, "documents"), remainder(F.col("doc_id"), 5) != 1) \
        .select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = written(packing.token_pieces(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
                     .withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "pieces")
    return packing.pack(pieces)


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.simhash_groups(table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = remainder(F.col("doc_id"), 4) == 2
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), ~held)
    return toxicity.score(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = remainder(F.col("doc_id"), 4) == 2
    model = langid.learn(docs, ~held)
    return langid.predict(docs.select("doc_id", "text"), model) \
        .select("doc_id", held.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op7_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_piece_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_scan.round_trip(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")) \
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digest(periodic_runs.find_runs(periodic_runs.looped(table(spark, sf_dir, "documents"))))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")) \
        .select("doc_id", "n_features", "weight", "score", "rank")


def op13_prefix_prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_prints.neighbours(table(spark, sf_dir, "documents"))


QUERIES: dict[str, QueryFn] = {f.__name__: f for f in (
    op1_pitman_yor, op2_best_fit_packing, op3_simhash_dedup, op4_secret_scan, op5_toxicity, op6_language_id,
    op7_nn_descent, op8_piece_scan, op9_quality_rules, op10_license_scan, op11_periodic_runs,
    op12_importance_resampling, op13_prefix_prints)}
