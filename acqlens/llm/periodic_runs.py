"""Periodic runs of words, found by descending-LCP Kruskal over the suffixes of each text.

Suffixes of a text (as word sequences) are sorted by prefix doubling; adjacent suffixes with their longest
common prefix (LCP) are the edges of a tree. The edges are taken by decreasing LCP, and union-find unites the
suffix classes they join. Every class keeps its positions in order, the smaller class is put into the larger
one, and each pair of positions ``i < j`` that thereby becomes adjacent has exactly the LCP of the edge. Is
``j - i`` within the LCP (``exponent - 1`` times over), the pair is a seed: the text from ``i`` has period
``j - i`` for ``LCP + j - i`` words. It is a run's start if the words before ``i`` and ``j`` differ. A run of
smallest period q and length L that starts at s is found at the pair (s, s + q) of LCP L - q, as no position
between the two shares so long a prefix with s (else q were not the smallest period): each run once, no other.

A text is one row and one unit of work: memory is about 100 bytes a word of the longest text plus four bytes a
word and doubling round (rounds grow with the logarithm of the longest repeat). Nothing is shuffled.

Nulls and empty texts have no words and no runs (collapsed text empty); a null doc_id keeps its row; repeated
rows are each handled by themselves. Ties do not arise: a run is determined by its start and period. Extra
columns are ignored; empty tables give empty results.
"""
from __future__ import annotations

from bisect import bisect, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acqlens.llm.common import small_batches, starts_of

MIN_EXPONENT = 4   # a run holds its period at least this often,
MIN_LENGTH = 6     # and this many words
RUN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def repeated_suffixes(ids: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of neighbours in the suffix order that share ``least`` words or more, and how many they share:
    (i, j, lcp). Only suffixes that still tie take part in the next doubling."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    first = starts_of(ids[order])
    rank = np.empty(n, np.int64)                      # where the group of equal prefixes begins in the order
    rank[order] = np.repeat(first, np.diff(np.append(first, n)))
    levels, size, active = [rank.astype(np.int32)], 1, np.arange(n)
    while True:
        group = np.bincount(rank[active], minlength=n)
        active = active[group[rank[active]] > 1]
        if not len(active):
            break
        after = np.zeros(len(active), np.int64)
        inside = active + size < n
        after[inside] = rank[active[inside] + size] + 1
        key = rank[active] * (n + 1) + after
        order_a = np.argsort(key, kind="stable")
        active, key = active[order_a], key[order_a]
        old = rank[active]
        group_at, new_at = starts_of(old), starts_of(key)
        width = np.diff(np.append(new_at, len(active)))
        base = np.repeat(group_at, np.diff(np.append(group_at, len(active))))
        rank = rank.copy()
        rank[active] = old + np.repeat(new_at, width) - base
        size *= 2
        levels.append(rank.astype(np.int32))
    suffix = np.empty(n, np.int64)
    suffix[rank] = np.arange(n)
    i, j = suffix[:-1], suffix[1:]
    lcp = np.zeros(n - 1, np.int64)
    # words shared: the largest powers of two first, each level tells if two blocks of its size are equal
    pairs = np.arange(n - 1)
    for k in range(len(levels) - 1, -1, -1):
        level = levels[k]
        a, b = i[pairs] + lcp[pairs], j[pairs] + lcp[pairs]
        inside = np.maximum(a, b) < n
        same = np.zeros(len(pairs), bool)
        same[inside] = level[a[inside]] == level[b[inside]]
        lcp[pairs[same]] += 1 << k
        if 1 << k == least_power(least):
            pairs = pairs[lcp[pairs] + (1 << k) - 1 >= least]    # the others stay below ``least``
    keep = lcp >= least
    return i[keep], j[keep], lcp[keep]


def least_power(least: int) -> int:
    """The largest power of two up to ``least``."""
    return 1 << (least.bit_length() - 1)


class OrderedClasses:
    """Union-find over positions; the root of a class holds its positions in order."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}
        self.members: dict[int, list[int]] = {}

    def find(self, x: int) -> int:
        parent = self.parent
        if x not in parent:
            parent[x] = x
            self.members[x] = [x]
            return x
        root = x
        while parent[root] != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    def unite(self, a: int, b: int) -> list[tuple[int, int]]:
        """The pairs of positions that become adjacent when the classes of ``a`` and ``b`` are united."""
        a, b = self.find(a), self.find(b)
        if a == b:
            return []
        if len(self.members[a]) < len(self.members[b]):
            a, b = b, a
        big, small = self.members[a], self.members.pop(b)
        self.parent[b] = a
        fresh = []
        last = len(small) - 1
        for k, x in enumerate(small):
            at = bisect(big, x)
            if at and (k == 0 or small[k - 1] < big[at - 1]):
                fresh.append((big[at - 1], x))
            if at < len(big) and (k == last or small[k + 1] > big[at]):
                fresh.append((x, big[at]))
        if small[0] > big[-1]:
            big += small
        elif last < 8:
            for x in small:
                insort(big, x)
        else:
            big += small
            big.sort()                                # two ascending stretches: one merge
        return fresh


def runs_of(ids: np.ndarray, exponent: int = MIN_EXPONENT, length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """(start, length, period) of every maximal run of at least ``exponent`` (2 or more) periods and
    ``length`` words, by start and period. ``ids``: the words as numbers from 0."""
    # a run's LCP is its length less a period, so at least this:
    least = max(exponent - 1, -(-length * (exponent - 1) // exponent))
    if len(ids) < max(length, exponent):
        return []
    i, j, lcp = repeated_suffixes(ids, least)
    if not len(i):
        return []
    order = np.argsort(-lcp, kind="stable")
    classes, out = OrderedClasses(), []
    for a, b, shared in zip(i[order].tolist(), j[order].tolist(), lcp[order].tolist()):
        for p, q in classes.unite(a, b):
            d = q - p
            if d * (exponent - 1) <= shared and shared + d >= length and (p == 0 or ids[p - 1] != ids[q - 1]):
                out.append((p, shared + d, d))
    return sorted(out)


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that any run holds after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    kept = np.cumsum(change[:-1]) == 0
    return b" ".join([words[k] for k in np.flatnonzero(kept).tolist()])


def find_runs(docs: DataFrame, exponent: int = MIN_EXPONENT, length: int = MIN_LENGTH, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every text; ``runs`` by start and period, in word numbers from 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            counts, found, texts = [], [], []
            for text in b.column(1).to_pylist():
                words = text.split() if text else []
                number: dict[bytes, int] = {}
                ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
                runs = runs_of(ids, exponent, length)
                counts.append(len(words))
                found.append([{"start": s, "length": n, "period": p} for s, n, p in runs])
                texts.append(collapse(words, runs).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(found, RUN_TYPE),
                 pa.array(texts, pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text")) \
               .mapInArrow(run, SCHEMA)


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text as an array (null text: none)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def looped(docs: DataFrame) -> DataFrame:
    """(doc_id, text): texts whose id has a crc32 divisible by ten end in a loop of their own words. With
    g = floor(crc32 / 10), a = g % n and p = 1 + floor((n - a) / (3 + g % 8)), word i >= a becomes word
    a + (i - a) % p of the n words, joined by single spaces; other texts stay as they are. A null id counts as
    empty text."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    g, w = F.floor(h / 10), F.col("__w")
    n = F.size(w)
    a = (g % F.nullif(n, F.lit(0))).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    loop = F.concat_ws(" ", F.slice(w, 1, F.col("__a")),
                       F.transform(F.sequence(F.lit(0), F.size(w) - F.col("__a") - 1),
                                   lambda i: F.get(w, F.col("__a") + i % F.col("__p"))))
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .withColumn("__w", F.when(h % 10 == 0, words_of(F.col("text")))) \
        .withColumn("__a", F.when(n > 0, a)).withColumn("__p", F.when(n > 0, p))
    return chosen.select("doc_id", F.when(F.col("__a").isNotNull(), loop).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """Per row of ``find_runs``: the number of runs, the longest (ties: smallest start, then period), and
    SHA-256 digests of all runs and of the collapsed text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r.length.alias("length"), (-r.start).alias("s"), (-r.period).alias("p"))))
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(
        r.start.cast("string"), F.lit(","), r.length.cast("string"), F.lit(","), r.period.cast("string"), F.lit("\n"))))
    return found.withColumn("__best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        (-F.col("__best.s")).alias("start"), F.col("__best.length").alias("length"),
        (-F.col("__best.p")).alias("period"),
        F.floor(1000 * F.col("__best.length") / -F.col("__best.p")).cast("long").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
