"""Toxicity by non-negative positive-unlabelled learning (nnPU) with a linear numpy classifier.

Confirmed toxic documents are the positives; a sample of all training documents is unlabelled: it holds
toxic ones in the share of the class prior, estimated from labels that are taken for a random sample. The classifier minimises the prior-corrected risk
  prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives)),
whose second term may not go below zero: where it does, its gradient is turned around.
Features are words (letters only, lower case) hashed into buckets, present or not, so that a giant text
costs no more memory than its buckets. Buckets are chosen by how far their share among the positives
exceeds that among the unlabelled.

Nulls: a null or empty text has no words and scores by the bias alone. Null labels are not used; a null id
counts as ''. Without positives every score is the prior (0 if there are no labels). Repeated rows count
each time they occur; extra columns are ignored; empty tables give no rows.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acqlens.llm.common import small_batches
from acqlens.llm.langid import letter_words

BUCKETS = 1 << 18
POSITIVES = 4_000      # toxic rows that are learned from, at most
UNLABELLED = 8_000     # rows taken as unlabelled, at most
FEATURES = 512         # buckets kept
STEPS = 600
RATE = 0.05
PENALTY = 1e-3
THRESHOLD = 0.3


def buckets(text: str | None) -> np.ndarray:
    found: set[int] = set()
    for w in letter_words(text):
        found.add(zlib.crc32(w) % BUCKETS)
    return np.fromiter(found, np.int32, len(found))


@dataclass
class Model:
    columns: np.ndarray    # sorted buckets
    weights: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        b = buckets(text)
        at = np.searchsorted(self.columns, b) if len(self.columns) else b[:0]
        at = np.minimum(at, len(self.columns) - 1)
        hit = at[self.columns[at] == b] if len(at) else at
        return float(1 / (1 + np.exp(-np.clip(self.bias + self.weights[hit].sum(), -40, 40))))


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, n_features: int = FEATURES,
        steps: int = STEPS, rate: float = RATE, penalty: float = PENALTY) -> Model:
    """nnPU with the logistic loss, by Adam over all rows at once."""
    prior = min(max(prior, 1e-3), 0.999)
    if not positive or not unlabelled:
        return Model(np.zeros(0, np.int32), np.zeros(0), float(np.log(prior / (1 - prior))))
    np_, nu = len(positive), len(unlabelled)
    in_p = np.bincount(np.concatenate(positive), minlength=BUCKETS)
    in_u = np.bincount(np.concatenate(unlabelled), minlength=BUCKETS)
    share = (in_p + in_u) / (np_ + nu)
    with np.errstate(divide="ignore", invalid="ignore"):
        z = (in_p / np_ - in_u / nu) / np.sqrt(share * (1 - share) * (1 / np_ + 1 / nu))
    z = np.where(in_p >= 2, np.nan_to_num(z, nan=0.0, posinf=0.0, neginf=0.0), 0.0)
    columns = np.sort(np.argsort(-z, kind="stable")[:n_features])
    columns = columns[z[columns] > 3.0].astype(np.int32)

    def dense(rows: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(rows), len(columns)), np.float32)
        for i, r in enumerate(rows):
            at = np.searchsorted(columns, r)
            ok = at < len(columns)
            out[i, at[ok][columns[at[ok]] == r[ok]]] = 1
        return out
    xp, xu = dense(positive), dense(unlabelled)
    theta = np.zeros(len(columns) + 1)
    theta[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(theta), np.zeros_like(theta)

    def sigmoid(a: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(a, -40, 40)))
    for t in range(1, steps + 1):
        sp, su = xp @ theta[:-1] + theta[-1], xu @ theta[:-1] + theta[-1]
        yp, yu = sigmoid(sp), sigmoid(su)
        gain = np.append(xp.T @ (yp - 1), (yp - 1).sum()) * (prior / np_)
        corrected = np.logaddexp(0, su).mean() - prior * np.logaddexp(0, sp).mean()
        rest = np.append(xu.T @ yu, yu.sum()) / nu - np.append(xp.T @ yp, yp.sum()) * (prior / np_)
        g = (gain + rest if corrected >= 0 else -rest) + penalty * np.append(theta[:-1], 0)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return Model(columns, theta[:-1], float(theta[-1]))


def learn(docs: DataFrame, labels: DataFrame, is_train: Column, positives: int = POSITIVES, unlabelled: int = UNLABELLED,
          id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learns from at most ``positives`` and ``unlabelled`` rows, chosen by a hash of their ids. The prior is
    the share of toxic ones among all labelled training rows."""
    train = docs.filter(is_train & F.col(id_col).isNotNull()) \
        .select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).cast("string").alias("text"))
    marked = labels.filter("toxic is not null").select(F.col("doc_id").cast("long").alias("__id"), F.col("toxic").alias("__toxic"))
    known = marked.join(train.select("__id"), "__id", "left_semi")
    prior = known.agg(F.avg((F.col("__toxic") == 1).cast("double"))).first()[0] or 0.0
    toxic = known.filter("__toxic = 1").select("__id").distinct()
    some = toxic.orderBy(F.xxhash64("__id"), "__id").limit(positives)
    # the unlabelled sample stands for all text, so it is drawn from all training rows whatever their labels:
    # without the confirmed ones its share of toxic rows would fall short of the prior
    others = train.select("__id").distinct().orderBy(F.xxhash64("__id"), "__id").limit(unlabelled)
    chosen = some.withColumn("positive", F.lit(True)).union(others.withColumn("positive", F.lit(False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([buckets(t).tobytes() for t in b.column(1).to_pylist()], pa.binary())],
                                             ["positive", "found"])
    # the hint is bounded by ``positives`` and ``unlabelled``; one row an id, so that no more rows than chosen ids reach the driver however often an id is repeated
    texts = train.join(F.broadcast(chosen.select("__id").distinct()), "__id").groupBy("__id").agg(F.min("text").alias("text"))
    rows = texts.join(chosen, "__id").select("positive", "text").mapInArrow(run, "positive boolean, found binary").collect()
    found = sorted((r["positive"], bytes(r["found"])) for r in rows)    # the same order whatever the tasks'
    split = {k: [np.frombuffer(x, np.int32) for p, x in found if p is k] for k in (True, False)}
    return fit(split[True], split[False], prior)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score and predicted, a row per row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            s = np.array([shared.value.score(t) for t in b.column(1).to_pylist()], np.float64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                                             ["doc_id", "score", "predicted"])
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
               .mapInArrow(run, "doc_id long, score double, predicted int")
