"""Language-model scores by a hierarchical Pitman-Yor bigram model.

Every context word has a restaurant whose customers are the words that follow it; all share one parent,
the unigram restaurant, and that the uniform base. A table of a child is a customer of the parent. A Gibbs
sweep seats each dish of each restaurant anew, given the parent's predictive probabilities and the other
tables of the restaurant as the sweep before left them: customer after customer opens a new table or joins
one. Within a sweep restaurants do not see each other's new tables, so sweeps of all tasks agree on one state.
A dish's first ``EXACT`` customers draw one by one; later ones draw their new tables block by block from the
Poisson law of the same probabilities. Predictive probabilities are averaged over the sweeps after burn-in.

A dish of one customer has one table whatever is drawn, so sweeps (joins and groupings in Spark) move only the
dishes of two customers or more; the others enter by their number per word and per context. Pairs (context,
word) are dealt to ``buckets``, about ``BUCKET_CHARS`` characters of text a bucket: places of a grid whose rows
share out the contexts and whose columns the words, by their hashes, so a word is known to one column alone. A first
pass over the texts sends each bucket its pairs, packed, and counts them; a second sends each bucket the pairs again
with the places of their documents in a batch, after what the bucket needs to price them: probabilities of its words,
weights of its contexts, tables of its dishes. A bucket holds its distinct pairs; the documents of a pair, however many,
stream past. Sums of a batch's documents come back packed, a block a bucket. So texts are read twice, and no pair is
shuffled more than twice or stored with its document.

Draws come from hashes of (context, word, sweep, customer), so a task that runs again draws the same.
Words travel as 64-bit hashes. Nulls: a null or empty text is the end token alone; a null id counts as ''.
Rows that repeat are scored each. Extra columns are ignored; empty tables give no rows; without training
text N is 0 and the base is uniform. Ties do not arise: scores are sums. Very long texts are packed in parts.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acqlens.llm.common import lower_words, small_batches, starts_of
from acqlens.session import Scratch, forget_shuffles

DISCOUNT = 0.75
STRENGTH = 1.0
BURN_IN = 1
SAMPLES = 2
EXACT = 1024       # customers of a dish that draw one by one
END = 1            # hash standing for the end token; START for the context of the first token
START = 2
BUCKET_CHARS = 24_000_000   # of text a bucket of pairs, on average
PACK = 1 << 20              # tokens that a task gathers before it sends their pairs
MERGE = 1 << 19             # pairs of a bucket that wait to be added to its sums
ROWS = 1 << 16              # rows of a batch that a task gives back
SENT = 1 << 17              # rows whose values are packed together
WORDS_OF = 1 << 20          # bytes of text whose words a task holds at once
TEXTS = 8 << 20             # bytes of text whose pairs are sent to the buckets together


class Hashes(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1 << 17:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word) if word else END
        return h


def tokens(texts: list[str | None], hashes: Hashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, u, w): the pairs (context, word) of each text, one a token."""
    found = [[*lower_words(t), b""] for t in texts]         # no word is empty: the end token
    size = np.fromiter(map(len, found), np.int64, len(found))
    row = np.repeat(np.arange(len(found)), size)
    w = np.fromiter(map(hashes.__getitem__, chain.from_iterable(found)), np.uint64, int(size.sum())).view(np.int64)
    u = np.empty_like(w)
    u[1:] = w[:-1]
    u[np.cumsum(size) - size] = START
    return row, u, w


_BYTES = np.arange(256, dtype=np.uint8)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
IN_WORD = ~np.isin(_BYTES, [32, *range(9, 14)])
P1, P2, P3, P4, P5 = map(np.uint64, (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def hashes_at(data: np.ndarray, start: np.ndarray, size: np.ndarray, hashes: Hashes) -> np.ndarray:
    """XXH64 of many short stretches of some bytes, after which 8 more follow: all take each step of the hash together.
    Those of 32 bytes or more are hashed one by one."""
    eight, four = (np.ndarray(len(data) - 7, kind, data, strides=(1,)) for kind in ("<u8", "<u4"))
    h = size.astype(np.uint64) + P5
    at = start.copy()
    for k in range(3):
        live = np.flatnonzero((size >= 8 * k + 8) & (size < 32))
        h[live] = _turned(h[live] ^ _turned(eight[at[live]] * P2, 31) * P1, 27) * P1 + P4
        at[live] += 8
    live = np.flatnonzero(size & 4)
    h[live] = _turned(h[live] ^ four[at[live]].astype(np.uint64) * P1, 23) * P2 + P3
    at[live] += 4
    for k in range(3):
        live = np.flatnonzero((size & 3) > k)
        h[live] = _turned(h[live] ^ data[at[live]].astype(np.uint64) * P5, 11) * P1
        at[live] += 1
    h = (h ^ (h >> np.uint64(33))) * P2
    h = (h ^ (h >> np.uint64(29))) * P3
    h ^= h >> np.uint64(32)
    for i in np.flatnonzero(size >= 32).tolist():
        h[i] = hashes[data[start[i]:start[i] + size[i]].tobytes()]
    return h.view(np.int64)


def _tokens_at(texts: pa.Array, hashes: Hashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``tokens`` of a column, from its bytes."""
    texts = texts.fill_null("") if texts.null_count else texts
    _, places, raw = texts.buffers()
    wide = pa.types.is_large_string(texts.type)
    places = np.frombuffer(places, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    begin, n = int(places[0]), int(places[-1] - places[0])
    places -= begin
    data = np.zeros(n + 8, np.uint8)
    if n:
        data[:n] = LOWER[np.frombuffer(raw, np.uint8, n, begin)]
    inside = IN_WORD[data[:n]]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    at = places[:-1][places[:-1] < n]                      # no word runs on into the next text
    first[at] = inside[at]
    at = places[1:][places[1:] > 0] - 1
    last[at] = inside[at]
    start = np.flatnonzero(first)
    size = np.flatnonzero(last) + 1 - start
    many = np.diff(np.searchsorted(start, places)) + 1     # the end token too
    row = np.repeat(np.arange(len(texts)), many)
    stop = np.cumsum(many)
    w = np.full(len(row), END, np.int64)
    words = np.ones(len(row), bool)
    words[stop - 1] = False
    w[words] = hashes_at(data, start, size, hashes)
    u = np.empty_like(w)
    u[1:] = w[:-1]
    u[stop - many] = START
    return row, u, w


def tokens_of(texts: pa.Array, hashes: Hashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same of a column, its words taken out a few texts at a time."""
    at, parts = 0, []
    for b in small_batches([pa.RecordBatch.from_arrays([texts], ["text"])], WORDS_OF):
        row, u, w = _tokens_at(b.column(0), hashes)
        parts.append((row + at, u, w))
        at += b.num_rows
    return tuple(np.concatenate(x) for x in zip(*parts)) if parts else tokens([], hashes)


def listed(u: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of a batch's tokens, ascending, and the places of u and w among them."""
    words, at = np.unique(np.append(w, START), return_inverse=True)
    before = np.empty(len(w), np.int64)
    before[1:] = at[:-2]                                   # a word's context is the word before or ``START``
    before[u == START] = at[-1]
    return words, before, at[:-1]


def pairs(u: np.ndarray, w: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, ...]:
    """(words, u, w, more, n): the distinct triples of a batch's tokens in order, u and w as places among the words, and
    how many tokens each stands for."""
    words, u, w = listed(u, w)
    m = int(more.max(initial=0)) + 1
    if len(words) ** 2 * m < 1 << 63:                      # one number a triple
        key = np.sort((u * len(words) + w) * m + more)
        at = starts_of(key)
        n = np.diff(np.append(at, len(key)))
        pair, more = np.divmod(key[at], m)
        return words, *np.divmod(pair, len(words)), more, n
    u, w, more, n = distinct(u, w, more)
    order = np.lexsort((more, w, u))
    return words, *(x[order] for x in (u, w, more, n))


def distinct(*keys: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """The distinct rows of some columns, in any order, and the sum of ``n`` (1 a row) over the rows that each
    stands for. Rows are sorted by one number mixed of their columns; if two rows share it, by the columns."""
    mixed = keys[0].view(np.uint64)
    with np.errstate(over="ignore"):
        for k in keys[1:]:
            mixed = mixed * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(29))) + k.view(np.uint64)
    order = np.argsort(mixed)
    mixed = mixed[order]
    rows = tuple(k[order] for k in keys)
    at = starts_of(*rows)
    if len(at) != len(starts_of(mixed)):
        order = np.lexsort(keys[::-1])
        rows = tuple(k[order] for k in keys)
        at = starts_of(*rows)
    if n is None:
        return *(k[at] for k in rows), np.diff(np.append(at, len(order)))
    return *(k[at] for k in rows), np.add.reduceat(n[order], at) if len(at) else n[:0]


def squeeze(raw: bytes) -> bytes:
    return np.int64(len(raw)).tobytes() + pa.compress(raw, "zstd", asbytes=True)


def unsqueeze(block: bytes) -> bytes:
    return pa.decompress(memoryview(block)[8:], int(np.frombuffer(block, np.int64, 1)[0]), "zstd", asbytes=True)


def planes(column: np.ndarray) -> bytes:
    """Numbers with their first bytes side by side, then their second ones: bytes alike squeeze better."""
    return np.ascontiguousarray(column.view(np.uint8).reshape(-1, column.itemsize).T).tobytes()


def from_planes(raw: bytes, kind: str, n: int, at: int = 0) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n).T).view(kind).ravel()


def steps(keys: np.ndarray) -> np.ndarray:
    """Ascending keys as differences, which ``np.cumsum`` adds up again: their high bytes are zeros."""
    out = keys.copy()
    out[1:] -= keys[:-1]
    return out


def pack(u: np.ndarray, w: np.ndarray, *more: np.ndarray, sort: bool = False) -> bytes:
    """Columns in few bytes: words by their place in a list of the block's words, numbers as small as they fit. With
    ``sort`` rows are put in order, which takes fewer."""
    words, at = np.unique(np.concatenate([u, w]), return_inverse=True)
    columns = at[:len(u)], at[len(u):], *more
    if sort:
        order = np.argsort(columns[0] * len(words) + columns[1])
        columns = tuple(c[order] for c in columns)
    return _packed(words, *columns)


def pack_listed(words: np.ndarray, u: np.ndarray, w: np.ndarray, *more: np.ndarray) -> bytes:
    """The same of rows whose u and w are places among some words, of which the block lists those that it has."""
    if len(words) < 32 * len(u):
        has = np.zeros(len(words), bool)
        has[u] = has[w] = True
        used = np.flatnonzero(has)
        place = np.cumsum(has) - 1
        return _packed(words[used], place[u], place[w], *more)
    used, at = np.unique(np.concatenate([u, w]), return_inverse=True)
    return _packed(words[used], at[:len(u)], at[len(u):], *more)


def _packed(words: np.ndarray, *columns: np.ndarray) -> bytes:
    parts = [steps(words)]
    ascending = bool((columns[0][1:] >= columns[0][:-1]).all())           # as sorted rows are: differences, most of them 0
    for column in (steps(columns[0]) if ascending else columns[0], *columns[1:]):
        parts.append(column.astype(np.min_scalar_type(int(column.max(initial=0)))))
    head = np.array([len(words), len(columns[0]), ascending, *(p.itemsize for p in parts[1:])], np.int64)
    return squeeze(np.int64(len(head)).tobytes() + head.tobytes() + b"".join(map(planes, parts)))


def unpack(block: bytes) -> list[np.ndarray]:
    words, u, w, *more = unpack_listed(block)
    return [words[u], words[w], *more]


def unpack_listed(block: bytes) -> list[np.ndarray]:
    """The words of a block, then its columns, the first two as places among them."""
    raw = unsqueeze(block)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    head = np.frombuffer(raw, np.int64, n, 8)
    at = 8 + 8 * n
    words = np.cumsum(from_planes(raw, "i8", int(head[0]), at))
    at += 8 * int(head[0])
    out = [words]
    for size in head[3:].tolist():
        out.append(from_planes(raw, f"u{size}", int(head[1]), at).astype(np.int64))
        at += size * int(head[1])
    if head[2]:
        out[1] = np.cumsum(out[1])
    return out


def values(column: pa.Array) -> Iterator[bytes]:
    """The values of a column of blocks, one at a time."""
    return (x.as_py() for x in column)


def grid(buckets: int) -> tuple[int, int]:
    """Rows and columns of a grid of at least so many buckets."""
    rows = math.isqrt(buckets - 1) + 1
    return rows, -(-buckets // rows)


def dealt(sides: tuple[int, int], words: np.ndarray, u: np.ndarray, w: np.ndarray, *more: np.ndarray
          ) -> Iterator[tuple[int, tuple[np.ndarray, ...]]]:
    """The rows of each bucket, in their order, buckets ascending; u and w are places among the words."""
    b = (words % sides[0] * sides[1])[u] + (words % sides[1])[w]
    b = b.astype(np.min_scalar_type(sides[0] * sides[1]))                # few bits are sorted by radix
    order = np.argsort(b, kind="stable")
    at = starts_of(b[order])
    for begin, end in zip(at, np.append(at[1:], len(order))):
        rows = order[begin:end]
        yield int(b[rows[0]]), tuple(c[rows] for c in (u, w, *more))


def _blocks(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())],
                                      ["bucket", "block"])


def _source(docs: DataFrame, is_train: Column, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(is_train, F.lit(False)).alias("train"), F.col(text_col).cast("string").alias("text"))


COUNTS = "kind int, bucket int, a long, b long, x long, y long, block binary"
DISH, WORD, CONTEXT, UNSEEN, TOKENS = range(5)


def _rows(bucket: int, kind: int, *columns: np.ndarray | None, block: bytes | None = None) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(columns[0]), ROWS):
        n = len(columns[0][at:at + ROWS])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, kind, np.int32)), pa.array(np.full(n, bucket, np.int32)),
             *(pa.nulls(n, pa.int64()) if x is None else pa.array(x[at:at + n]) for x in columns),
             pa.nulls(n, pa.binary()) if block is None else pa.array([block], pa.binary())], [f.split()[0] for f in COUNTS.split(", ")])


def bucket_counts(bucket: int, u: np.ndarray, w: np.ndarray, c: np.ndarray) -> Iterator[pa.RecordBatch]:
    """``COUNTS`` of a bucket's distinct pairs, at most ``ROWS`` a batch."""
    many, unseen = c > 1, c == 0
    yield from _rows(bucket, DISH, u[many], w[many], c[many], None)
    yield from _rows(bucket, UNSEEN, np.zeros(1, np.int64), None, None, None, block=pack(u[unseen], w[unseen], sort=True))
    for kind, key in ((WORD, w), (CONTEXT, u)):
        order = np.argsort(key)
        at = starts_of(key[order])
        yield from _rows(bucket, kind, key[order[at]], None, *(np.add.reduceat(x[order], at) for x in (c, (c == 1).astype(np.int64))))


def counts(source: DataFrame, sides: tuple[int, int]) -> DataFrame:
    """What each bucket holds, by ``kind``: DISH, a pair (a, b) with its x customers, 2 or more; WORD and CONTEXT, a
    with its x customers and its y dishes of one customer in this bucket; UNSEEN, a block of the pairs of held-out
    text alone."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, size = Hashes(), [], 0

        def packed() -> pa.RecordBatch:
            words, u, w, trained, n = pairs(*(np.concatenate(x) for x in zip(*held)))
            at = starts_of(u, w)                           # a pair of held-out text, then that of training text
            c = np.add.reduceat(trained * n, at)
            return _blocks([(b, pack_listed(words, *columns)) for b, columns in dealt(sides, words, u[at], w[at], c)])
        for b in small_batches(batches, 2 << 20):
            row, u, w = tokens_of(b.column(1), hashes)
            held.append((u, w, b.column(0).to_numpy(zero_copy_only=False)[row]))
            size += len(u)
            if size >= PACK:
                yield packed()
                held, size = [], 0
        if held:
            yield packed()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, sums, late, n_late = None, None, [], 0

        def merged():
            parts = ([sums] if sums else []) + late
            return distinct(*(np.concatenate([x[i] for x in parts]) for i in (0, 1)), n=np.concatenate([x[2] for x in parts]))
        for batch in batches:
            for b, block in zip(batch.column(0).to_pylist(), values(batch.column(1))):
                if b != bucket and bucket is not None:
                    yield from bucket_counts(bucket, *merged())
                    sums, late, n_late = None, [], 0
                bucket = b
                late.append(unpack(block))
                n_late += len(late[-1][0])
                if n_late > MERGE:
                    sums, late, n_late = merged(), [], 0
        if bucket is not None:
            yield from bucket_counts(bucket, *merged())

    sent = source.select("train", "text").mapInArrow(send, "bucket int, block binary")
    return sent.repartition(sides[0] * sides[1], "bucket").sortWithinPartitions("bucket").mapInArrow(count, COUNTS)


def _uniform(key: np.ndarray, i: int) -> np.ndarray:
    """Numbers in (0, 1) from a mix of the bits of key and i."""
    with np.errstate(over="ignore"):
        x = key + np.uint64(i) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x = x ^ (x >> np.uint64(31))
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)


def seat(key: np.ndarray, customers: np.ndarray, mass: np.ndarray, discount: float = DISCOUNT, exact: int = EXACT) -> np.ndarray:
    """Tables of each dish, drawn by seating its customers one after the other: with s seated at t tables,
    a new table has weight ``mass + discount * t * p`` of the whole, joined ones s - discount * t. ``mass``
    is a pair of arrays (fixed weight, weight per table of this dish)."""
    fixed, each = mass
    key = key.astype(np.int64).view(np.uint64)
    order = np.argsort(-customers, kind="stable")
    c, k, a, e = customers[order], key[order], fixed[order], each[order]
    t = np.minimum(c, 1).astype(np.float64)
    for s in range(1, int(min(c[0], exact)) if len(c) else 0):
        live = int(np.searchsorted(-c, -s, side="left"))      # dishes with more than s customers
        if not live:
            break
        new = a[:live] + e[:live] * t[:live]
        t[:live] += _uniform(k[:live], s) * (new + s - discount * t[:live]) < new
    far = np.flatnonzero(c > exact)
    s = float(exact)
    block = 0
    while len(far):
        stop = np.minimum(c[far], np.ceil(s * 1.05))
        new = a[far] + e[far] * t[far]
        middle = (s + stop) / 2
        expected = (stop - s) * new / (new + middle - discount * t[far])
        rng = np.random.Generator(np.random.PCG64([int(k[far[0]]), block]))
        t[far] = np.minimum(t[far] + rng.poisson(np.maximum(expected, 0)), stop)
        s, block = float(np.ceil(s * 1.05)), block + 1
        far = far[c[far] > s]
    out = np.zeros(len(customers), np.int64)
    out[order] = t.astype(np.int64)
    return out


def large_batches(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``rows``."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= rows:
            yield pa.concat_batches(held)
            held, n = [], 0
    if held:
        yield pa.concat_batches(held)


def _seated(rows: DataFrame, sweep: int, discount: float) -> DataFrame:
    """``rows`` with tables ``t``, from u, w, c, fixed and each."""
    kept = [c for c in rows.columns if c not in ("t", "fixed", "each")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = {c: b.column(c) for c in b.schema.names}
            t = seat(col["key"].to_numpy(), col["c"].to_numpy(), (col["fixed"].to_numpy(), col["each"].to_numpy()), discount)
            yield pa.RecordBatch.from_arrays([*(col[c] for c in kept if c != "key"), pa.array(t)],
                                             [*(c for c in kept if c != "key"), "t"])
    keyed = rows.withColumn("key", F.xxhash64("u", "w", F.lit(sweep)))
    fields = ", ".join(f"{c} {t}" for c, t in keyed.dtypes if c in kept)
    return keyed.mapInArrow(run, fields + ", t long")


def parent_mass(own: Column, tables: int, base: float, discount: float = DISCOUNT, strength: float = STRENGTH) -> Column:
    """The fixed weight of a new table of a dish of the parent, which has ``own`` of all ``tables``."""
    return (strength + discount * (F.lit(tables) - own)) * F.lit(base)


def score(docs: DataFrame, is_train: Column, discount: float = DISCOUNT, strength: float = STRENGTH,
          burn_in: int = BURN_IN, samples: int = SAMPLES, id_col: str = "doc_id", text_col: str = "text",
          bucket_chars: int = BUCKET_CHARS) -> DataFrame:
    """doc_id, train, n_tokens, n_known, train_tokens, base_score and score (log10), a row per document row."""
    spark = docs.sparkSession
    source = _source(docs, is_train, id_col, text_col)
    buckets = 1 + int(source.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0] // bucket_chars)
    sides = grid(buckets)
    counted = Scratch(spark, "py-counts").until_exit()
    found = counted.write(counts(source, sides), "counts")

    def kept(df: DataFrame, name: str, before: Scratch | None = None) -> tuple[DataFrame, Scratch]:
        scratch = Scratch(spark, f"py-{name}").until_exit()
        table = scratch.write(df, name)
        if before:
            before.free()                              # the table that this one has more columns than
        return table, scratch

    def sums(kind: int, key: str) -> DataFrame:
        return found.filter(F.col("kind") == kind).groupBy(F.col("a").alias(key)) \
            .agg(F.sum("x").alias("customers"), F.sum("y").alias("singles"))
    words, words_at = kept(sums(WORD, "w").filter("customers > 0"), "words")
    total, vocabulary = words.agg(F.coalesce(F.sum("customers"), F.lit(0)), F.count("*")).first()
    base = 1.0 / (vocabulary + 1)
    contexts, contexts_at = kept(sums(CONTEXT, "u").filter("customers > 0"), "contexts")
    # what a sweep starts from: one table per dish
    state = found.filter(F.col("kind") == DISH).select(F.col("a").alias("u"), F.col("b").alias("w"), F.col("x").alias("c"),
                                                       F.lit(1).cast("long").alias("t"))
    parent, tp, parents, scratch = words.select("w", F.lit(1).cast("long").alias("t")), vocabulary, [], None
    for sweep in range(burn_in + samples):
        forget_shuffles(spark)
        now = Scratch(spark, "py-sweep")
        # the parent's dishes meet the tables that the sweep before left to the others, as the children's do
        served = words.select("w", "singles").join(state.groupBy("w").agg(F.sum("t").alias("more")), "w", "left") \
            .select("w", (F.col("singles") + F.coalesce("more", F.lit(0))).alias("c")).join(parent.select("w", F.col("t").alias("own")), "w")
        customers = served.select(F.lit(0).cast("long").alias("u"), "w", "c", parent_mass(F.col("own"), tp, base, discount, strength)
                                  .alias("fixed"), F.lit(discount * base).alias("each"))
        parent = now.write(_seated(customers, sweep, discount), "parent")
        cp, tp = parent.agg(F.coalesce(F.sum("c"), F.lit(0)), F.coalesce(F.sum("t"), F.lit(0))).first()
        p = (F.greatest(F.col("c") - discount * F.col("t"), F.lit(0.0)) + (strength + discount * tp) * base) / (strength + cp)
        tables = _tables(contexts, state)
        rows = state.join(parent.select("w", p.alias("p")), "w").join(tables.select("u", "tu"), "u")
        mass = F.greatest(strength + discount * (F.col("tu") - F.col("t")), F.lit(0.0)) * F.col("p")
        if sweep > burn_in:
            rows = rows.withColumn(f"t{sweep - 1 - burn_in}", F.col("t"))
        history = [f"t{i}" for i in range(max(0, sweep - burn_in))]
        state = now.write(_seated(rows.select("u", "w", "c", *history, mass.alias("fixed"), (discount * F.col("p")).alias("each")),
                                  sweep, discount), "state")
        if sweep >= burn_in:
            i = sweep - burn_in
            parents.append((cp, tp))
            words, words_at = kept(words.join(parent.select("w", F.col("c").alias(f"c{i}"), F.col("t").alias(f"t{i}")), "w"), "words", words_at)
            contexts, contexts_at = kept(_tables(contexts, state).withColumnRenamed("tu", f"t{i}"), "contexts", contexts_at)
        if scratch:
            scratch.free()                             # the state before is read no more
        scratch = now.until_exit()
    state = state.withColumnRenamed("t", f"t{samples - 1}")
    every = range(samples)
    # words and contexts of held-out text alone have no rows here; all values are counts, which pack into few bytes
    wanted = {
        DISH: _value_blocks(state.select(_pair_bucket(sides).alias("bucket"), "u", "w", "c", *(f"t{i}" for i in every))),
        WORD: _value_blocks(found.filter(F.col("kind") == WORD).select("bucket", F.col("a").alias("w")).join(words, "w").select(
            "bucket", "w", "customers", *chain.from_iterable((f"c{i}", f"t{i}") for i in every))),
        CONTEXT: _value_blocks(found.filter(F.col("kind") == CONTEXT).select("bucket", F.col("a").alias("u")).join(contexts, "u").select(
            "bucket", "u", "customers", *(f"t{i}" for i in every))),
        UNSEEN: found.filter(F.col("kind") == UNSEEN).select("bucket", "block")}

    def labelled(kind: int, blocks: DataFrame) -> DataFrame:
        return blocks.select("bucket", F.lit(kind).alias("kind"), "block")
    prices = Scratch(spark, "py-prices").until_exit().write(
        reduce(DataFrame.union, [labelled(kind, blocks) for kind, blocks in wanted.items()]), "prices")
    for done in (counted, words_at, contexts_at, scratch):
        done.free()                                    # all that prices need of them is in their blocks
    forget_shuffles(spark)
    needs = prices.union(labelled(TOKENS, _token_blocks(source, sides)))
    priced = needs.repartition(sides[0] * sides[1], "bucket").sortWithinPartitions("bucket", "kind") \
        .mapInArrow(_pricer(discount, strength, total, vocabulary, parents), "batch long, bucket int, head binary, sums binary")
    return priced.repartition("batch").sortWithinPartitions("batch", "bucket").mapInArrow(_added, ADDED) \
        .select("doc_id", "train", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


ADDED = "doc_id long, train boolean, n_tokens long, n_known long, base_score double, score double"


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of each batch, from the sums of its buckets; the first of them brings the documents' ids."""
    batch = head = None

    def rows() -> pa.RecordBatch:
        doc, flags = head
        return pa.RecordBatch.from_arrays(
            [pa.array(doc, mask=flags >= 2), pa.array(flags % 2 == 1), *map(pa.array, (*whole, *parts))], [f.split()[0] for f in ADDED.split(", ")])
    for b in batches:
        for number, first, block in zip(b.column(0).to_pylist(), values(b.column(2)), values(b.column(3))):
            if number != batch:
                if head is not None:
                    yield rows()
                batch, head = number, np.frombuffer(unsqueeze(first), np.int64).reshape(2, -1)
                whole, parts = np.zeros((2, head.shape[1]), np.int64), np.zeros((2, head.shape[1]))
            raw = unsqueeze(block)
            sums = from_planes(raw, "i8", len(raw) // 8).reshape(5, -1)
            whole[:, sums[0]] += sums[1:3]                 # a document is once in a block
            parts[:, sums[0]] += sums[3:].view(np.float64)
    if head is not None:
        yield rows()


def _value_blocks(rows: DataFrame) -> DataFrame:
    """(bucket, block): the rows of each bucket (keys, then counts), packed column by column."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in large_batches(batches, SENT):
            bucket, *columns = (c.to_numpy() for c in b.columns)
            order = np.lexsort((columns[0], bucket))
            bucket, columns = bucket[order], [c[order] for c in columns]
            at = starts_of(bucket).tolist()
            yield _blocks([(int(bucket[i]), squeeze(planes(np.concatenate([steps(columns[0][i:j]), *(c[i:j] for c in columns[1:])]))))
                           for i, j in zip(at, [*at[1:], len(order)])])
    return rows.mapInArrow(send, "bucket int, block binary")


def _pair_bucket(sides: tuple[int, int]) -> Column:
    return (F.pmod("u", F.lit(sides[0])) * sides[1] + F.pmod("w", F.lit(sides[1]))).cast("int")


def _tables(contexts: DataFrame, state: DataFrame) -> DataFrame:
    """``contexts`` with ``tu``, the tables of all their dishes."""
    more = state.groupBy("u").agg(F.sum("t").alias("__more"))
    return contexts.join(more, "u", "left").withColumn("tu", F.col("singles") + F.coalesce("__more", F.lit(0))).drop("__more")


def _token_blocks(source: DataFrame, sides: tuple[int, int]) -> DataFrame:
    """(bucket, block): a batch's pairs with the places of their rows, after the batch's number. The first block also
    brings the ids and parts of its rows."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for b in small_batches(batches, TEXTS):
            row, u, w = tokens_of(b.column(3), hashes)
            words, u, w, row, n = pairs(u, w, row)
            flags = b.column(1).is_null().to_numpy(zero_copy_only=False) * 2 + b.column(2).to_numpy(zero_copy_only=False)
            head = squeeze(np.concatenate([b.column(1).fill_null(0).to_numpy(), flags]).astype(np.int64).tobytes())
            out = []
            for bucket, columns in dealt(sides, words, u, w, n, row):
                out.append((bucket, np.array([b.column(0)[0].as_py(), len(head)], np.int64).tobytes() + head + pack_listed(words, *columns)))
                head = b""
            yield _blocks(out)
    return source.mapInArrow(send, "bucket int, block binary")


def _pricer(discount: float, strength: float, total: int, vocabulary: int, parents: list[tuple[int, int]]):
    """Prices the pairs of each bucket: rows by bucket and kind, the tokens last. ``parents``: customers and tables
    of the parent, sweep by sweep."""
    samples, base, smooth = len(parents), 1.0 / (vocabulary + 1), total + 0.5 * (vocabulary + 1)

    def of_words(customers: np.ndarray, *seated: np.ndarray) -> np.ndarray:
        """The logarithm of each word's base and its probabilities, from its customers and those and the tables
        that it has in the parent."""
        p = [(np.maximum(c - discount * t, 0.0) + (strength + discount * tp) * base) / (strength + cp)
             for c, t, (cp, tp) in zip(seated[::2], seated[1::2], parents)]
        return np.column_stack([np.log10((customers + 0.5) / smooth), *p])

    def of_contexts(customers: np.ndarray, *tables: np.ndarray) -> np.ndarray:
        """The weight of each context and the shares that it leaves to the parent."""
        return np.column_stack([strength + customers, *((strength + discount * t) / (strength + customers) for t in tables)])

    def of_dishes(*counts: np.ndarray) -> np.ndarray:
        return np.column_stack(counts).astype(np.float64)
    new_word = of_words(*np.zeros((1 + 2 * samples, 1), np.int64))[0]      # not in training text

    def lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Rows of ``values`` (by ascending ``keys``) of the wanted keys, NaN where there is none."""
        out = np.full((len(wanted), values.shape[1]), np.nan)
        if len(keys):
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            hit = keys[at] == wanted
            out[hit] = values[at[hit]]
        return out

    def table(blocks: list[bytes], keys: int, counts: int, of) -> tuple[np.ndarray, ...]:
        """The keys and the values of all rows in some blocks, by the first key."""
        parts = []
        for raw in map(unsqueeze, blocks):
            parts.append(from_planes(raw, "i8", len(raw) // 8).reshape(keys + counts, -1))
            parts[-1][0] = np.cumsum(parts[-1][0])
        all_rows = np.concatenate(parts, axis=1) if parts else np.zeros((keys + counts, 0), np.int64)
        all_rows = all_rows[:, np.argsort(all_rows[0])]
        return *all_rows[:keys], of(*all_rows[keys:])

    def pair_keys(u: np.ndarray, w: np.ndarray, heads: np.ndarray, words: np.ndarray) -> np.ndarray:
        """One number per pair: places of its words among the bucket's, which are all listed."""
        return np.searchsorted(heads, u) * (len(words) + 1) + np.searchsorted(words, w)

    def prepare(have: dict[int, list[bytes]]):
        words, heads = table(have.get(WORD, []), 1, 1 + 2 * samples, of_words), table(have.get(CONTEXT, []), 1, 1 + samples, of_contexts)
        dishes = table(have.get(DISH, []), 2, 1 + samples, of_dishes)
        unseen = [np.concatenate(x) for x in zip(*map(unpack, have.get(UNSEEN, [])))] or [np.zeros(0, np.int64)] * 2
        # words and contexts of held-out text alone have no values, but a place
        places = np.union1d(heads[0], unseen[0]), np.union1d(words[0], unseen[1])
        keys = pair_keys(dishes[0], dishes[1], *places)
        order = np.argsort(keys)
        return words, heads, places, keys[order], dishes[2][order], np.sort(pair_keys(*unseen, *places))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, have, ready = None, {}, None
        for batch in batches:
            for number, kind, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), values(batch.column(2))):
                if number != bucket:
                    bucket, have, ready = number, {}, None
                if kind != TOKENS:
                    have.setdefault(kind, []).append(block)
                    continue
                if ready is None:
                    ready, have = prepare(have), {}
                yield price(bucket, block, ready)

    def price(bucket: int, block: bytes, ready) -> pa.RecordBatch:
        words, heads, places, dish_keys, dish_values, unseen = ready
        batch, size = np.frombuffer(block, np.int64, 2).tolist()
        listed, u, w, n, row = unpack_listed(block[16 + size:])
        of_word, of_head = lookup(*words, listed), lookup(*heads, listed)[u]
        known = ~np.isnan(of_word[:, 0])
        of_word[~known] = new_word
        known, of_word = known[w], of_word[w]
        keys = np.searchsorted(places[0], listed)[u] * (len(places[1]) + 1) + np.searchsorted(places[1], listed)[w]
        dish = lookup(dish_keys, dish_values, keys)
        at = np.minimum(np.searchsorted(unseen, keys), max(len(unseen) - 1, 0))
        absent = (unseen[at] == keys) if len(unseen) else np.zeros(len(keys), bool)
        one = np.isnan(dish[:, 0])
        c = np.where(one, np.where(absent, 0.0, 1.0), dish[:, 0])
        mean = np.zeros(len(keys))
        for i in range(samples):
            t = np.where(one, c, dish[:, 1 + i])           # none, or one table for one customer
            p = of_word[:, 1 + i]
            served = np.maximum(c - discount * t, 0) / of_head[:, 0] + of_head[:, 1 + i] * p
            mean += np.where(np.isnan(of_head[:, 0]), p, served)
        lp = np.log10(mean / samples)
        columns = [np.bincount(row, weights) for weights in (n, n * known, n * of_word[:, 0], n * lp)]
        rows = np.flatnonzero(columns[0])
        sums = [rows, *(np.rint(x[rows]).astype(np.int64) for x in columns[:2]), *(x[rows].view(np.int64) for x in columns[2:])]
        return pa.RecordBatch.from_arrays(
            [pa.array([batch]), pa.array([bucket], pa.int32()), pa.array([block[16:16 + size]], pa.binary()),
             pa.array([squeeze(planes(np.concatenate(sums)))], pa.binary())], ["batch", "bucket", "head", "sums"])
    return run
