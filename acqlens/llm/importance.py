"""Target-distribution importance resampling: documents drawn by how much more likely their hashed n-grams are
under a target corpus than under the documents themselves.

One table of 256 bytes lower-cases A-Z and turns every separator into a space; ``bytes.translate`` and
``bytes.split`` then yield a text's words in UTF-8. An n-gram's bucket is the crc32 of its words joined by one
space, got by extending the crc of the shorter n-gram (``zlib.crc32(b" " + word, crc)``), modulo ``buckets``.
Counters per batch reduce features to counts a bucket; tasks emit one row a bucket, and Spark adds them up: the
model is at most ``buckets`` rows, whatever the corpus. With S features in all documents, s of them in a bucket,
and T and t in the target, a bucket's gain is floor(1000 ln((t+1)(S+buckets) / ((s+1)(T+buckets)))). A
document's weight is the floored mean of the gains of its features. Gumbel noise from the document's id makes
the highest scores a sample without replacement in proportion to exp(weight / 1000).

Ranks are global and need no single sorted partition: scores are whole numbers of a bounded range (weights lie
within the gains, noise within -3.1 and 22.3 thousand), so a histogram of scores (a grouped count) tells where
each score begins and which is the last to be drawn; only drawn rows are then numbered, within their score,
by id. Noise differs from id to id, so only rows that repeat an id can pile up in one score; none is dropped.

Nulls and empty texts have no features and weight 0 and are never drawn (they have too few words); a null
doc_id counts as empty text in the noise and is ranked last among equal scores. Repeated rows are drawn each
for itself (their order is arbitrary, the set of ranks is not). Very long texts are counted whole. Extra
columns are ignored; empty tables give empty results, and an empty target leaves all gains to the documents.
"""
from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acqlens.llm.common import small_batches, written

BUCKETS = 10_000
LEAST_WORDS = 20   # of a document that may be drawn
PERCENT = 10       # of those documents are drawn
SEED = "2024"
# lower case for A-Z, a space for every other byte of ASCII that is no digit or letter; the rest stays
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
MODEL_SCHEMA = "bucket int, n long"


def words(text: bytes | None) -> list[bytes]:
    return text.translate(TABLE).split() if text else []


def features(ws: list[bytes], most: int) -> Counter:
    """How often each crc32 of a run of 1 to ``most`` consecutive words occurs."""
    crcs: Counter = Counter()
    for w, n in Counter(ws).items():
        crcs[zlib.crc32(w)] += n
    if most > 1:
        ends = [zlib.crc32(w) for w in ws]            # crc of the n-gram that begins at each word
        spaced = [b" " + w for w in ws]
        for n in range(2, most + 1):
            ends = [zlib.crc32(w, c) for c, w in zip(ends, spaced[n - 1:])]
            crcs.update(ends)
    return crcs


def counts(texts: DataFrame, most: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all rows of ``texts`` (column ``text``) a bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)           # of the whole task
        for b in small_batches(batches):
            found: Counter = Counter()
            if most == 1:                             # words reduce before their crc is taken
                ws: Counter = Counter()
                for text in b.column(0).to_pylist():
                    ws.update(words(text))
                for w, n in ws.items():
                    found[zlib.crc32(w)] += n
            else:
                for text in b.column(0).to_pylist():
                    found.update(features(words(text), most))
            if found:
                at = np.fromiter(found.keys(), np.int64, len(found)) % buckets
                np.add.at(total, at, np.fromiter(found.values(), np.int64, len(found)))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["bucket", "n"])

    raw = texts.select(F.col("text").cast("string").cast("binary").alias("text"))
    return raw.mapInArrow(run, MODEL_SCHEMA).groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, most: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of every bucket, from counts over all rows of both tables (two collected lists of at most
    ``buckets`` rows)."""
    def collected(texts: DataFrame) -> list[int]:
        out = [0] * buckets
        for row in counts(texts, most, buckets).collect():
            out[row["bucket"]] = row["n"]
        return out

    source, goal = collected(docs), collected(target)
    all_s, all_t = sum(source), sum(goal)
    return np.array([math.floor(1000 * math.log((t + 1) * (all_s + buckets) / ((s + 1) * (all_t + buckets))))
                     for s, t in zip(source, goal)], np.int64)


def noise(doc_id: int | None, seed: str = SEED) -> int:
    """Gumbel noise in thousandths, from the SHA-256 of the seed and the id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(docs: DataFrame, gain: np.ndarray, most: int = 1, seed: str = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row."""
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_word: dict[bytes, int] = {}                # gains of words seen by this task
        for b in small_batches(batches):
            cols: list[list[int]] = [[], [], [], []]
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ws = words(text)
                n = total = 0
                if most == 1:
                    n = len(ws)
                    for w in ws:
                        g = of_word.get(w)
                        if g is None:
                            if len(of_word) >= 1 << 18:
                                of_word.clear()       # bounded memory; nothing but time depends on it
                            g = of_word[w] = int(gain[zlib.crc32(w) % buckets])
                        total += g
                else:
                    for crc, k in features(ws, most).items():
                        n += k
                        total += k * int(gain[crc % buckets])
                weight = total // n if n else 0
                for col, v in zip(cols, (len(ws), n, weight, weight + noise(doc, seed))):
                    col.append(v)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), *(pa.array(c, pa.int64()) for c in cols)],
                                             ["doc_id", "n_words", "n_features", "weight", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text")) \
               .mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


def draw(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``scored`` (from ``scores``) plus ``rank``: 1, 2, 3... of the floor(percent * N / 100) highest scores among
    the N rows of ``least_words`` words or more, ties to the smaller id; null for all others.

    ``scored`` is read three times: give a written table."""
    able = F.col("n_words") >= least_words
    # one row a score, so no more rows than whole numbers between the lowest and the highest score
    histogram = sorted(((r["score"], r["n"]) for r in scored.filter(able).groupBy("score")
                        .agg(F.count("*").alias("n")).collect()), reverse=True)
    quota = percent * sum(n for _, n in histogram) // 100
    begins, before = [], 0
    for score, n in histogram:
        if before >= quota:
            break
        begins.append((score, before))
        before += n
    nobody = F.lit(None).cast("long")
    if not begins:
        return scored.withColumn("rank", nobody)
    reached = able & (F.col("score") >= begins[-1][0])
    first = scored.sparkSession.createDataFrame(begins, "score long, __before long")
    place = F.row_number().over(Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last()))
    numbered = scored.filter(reached).join(first, "score").withColumn("rank", F.col("__before") + place) \
        .withColumn("rank", F.when(F.col("rank") <= quota, F.col("rank")))
    return numbered.select(*scored.columns, "rank") \
        .unionByName(scored.filter(~F.coalesce(reached, F.lit(False))).withColumn("rank", nobody))


def resample(docs: DataFrame, target: DataFrame, most: int = 1, buckets: int = BUCKETS, percent: int = PERCENT,
             least_words: int = LEAST_WORDS, seed: str = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every document."""
    gain = gains(docs, target, most, buckets)
    return draw(written(scores(docs, gain, most, seed), "importance"), percent, least_words)
