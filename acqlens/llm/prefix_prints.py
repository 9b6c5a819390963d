"""Document fingerprints by prefix polynomial hashes.

The code points c of a text give modular prefix sums P[i] = sum of c[k] * B^k for k < i, modulo 2^31 - 1, for two
bases. They answer the equality of any two spans in constant time: the spans [a, a + m) and [b, b + m), of one
text or of two, are equal (up to collisions of about 2^-62) when (P[a + m] - P[a]) * B^(b - a) = P[b + m] - P[b].
As equality of prefixes is monotone, a binary search over m finds the longest common extension of two places.

A fingerprint is a sample of that prefix array: the length, the whole text's hash, prefix hashes at even steps
(a power of two, 16 to 32 of them) and prefix hashes at places chosen by content (where the hash of the last
``WINDOW`` code points ends in ``k`` zero bits, k the least that leaves 32 places at most). Two fingerprints are
compared by what they hold alone:

* even places: from each common even place on, the longest common extension by binary search, then on behind the
  first difference: what was changed in place costs only the steps it touches;
* places by content: a common stretch between two places (moved, or behind an insertion) seeds a longest common
  extension over the stretches that follow, again by binary search on the prefix hashes.

The likeness is the larger of the two shares of code points that lie in common stretches, of the longer text.
Equal fingerprints have likeness 1, and equal texts have equal fingerprints; a fingerprint is at most about
1,100 characters, however long its text.

``neighbours`` pairs every document with the next by doc_id: one shuffle by ranges of (doc_id, hash of the text),
each range sorted and streamed; only the first and last row of a range leave it, to be paired between ranges.

Nulls count as empty texts (n_chars 0; two empty texts have likeness 1, an empty and any other 0). Null doc_ids
come first. Rows that repeat a doc_id follow each other by the hash of their text, then by the text. Of an only
row the next is the row itself. Very long texts are hashed whole, 16 bytes a code point at a time. Extra columns
are ignored; empty tables give empty results.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acqlens.llm.common import small_batches, written

PRIME = (1 << 31) - 1
BASES = (1_000_003, 1_103_515_245)
WINDOW = 8       # code points whose hash decides on a place
PLACES = 32      # at most, of each kind

_POWERS = {base: np.ones(1, np.int64) for base in BASES}   # grown as longer texts come, one a worker process


def powers(base: int, n: int) -> np.ndarray:
    """base^0 ... base^(n-1) modulo PRIME, by doubling."""
    have = _POWERS[base]
    while len(have) < n:
        have = np.concatenate([have, have * pow(base, len(have), PRIME) % PRIME])
        _POWERS[base] = have
    return have[:n]


def code_points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)


def prefix_sums(points: np.ndarray, base: int) -> np.ndarray:
    """P[0..n]: modular prefix sums; terms are under 2^31, so 2^32 of them add up exactly."""
    out = np.zeros(len(points) + 1, np.int64)
    np.cumsum((points + 1) * powers(base, len(points)) % PRIME, out=out[1:])
    out %= PRIME
    return out


def span_hash(low: int, high: int, start: int, base: int) -> int:
    """Hash of a span from its two prefix values, moved to place 0 so that equal spans have equal hashes."""
    return (high - low) * pow(base, -start, PRIME) % PRIME


def chosen_places(sums: np.ndarray, base: int) -> tuple[list[int], list[int], int]:
    """Places by content: (places, zero bits of each, k)."""
    n = len(sums) - 1
    if n <= WINDOW:
        return [], [], 0
    spans = (sums[WINDOW:] - sums[:-WINDOW]) % PRIME
    spans = spans * powers(base, n)[::-1][:n - WINDOW + 1] % PRIME      # all moved to the text's last place
    # last place depends on the length: undo it, so that a window has one hash in every text
    spans = spans * pow(pow(base, n - 1, PRIME), -1, PRIME) % PRIME
    mixed = (spans * 0x9E3779B1 >> 7) & 0xFFFFFF
    zeros = np.bitwise_count((mixed & -mixed) - 1).astype(np.int64)     # trailing zero bits; 24 of them: no place
    zeros[mixed == 0] = 0
    per_level = np.bincount(zeros[:-1] if len(zeros) > 1 else zeros[:0], minlength=25)
    at_least = np.cumsum(per_level[::-1])[::-1]
    k = int(np.argmax(at_least <= PLACES))
    at = np.flatnonzero(zeros[:-1] >= k)
    return (at + WINDOW).tolist(), zeros[at].tolist(), k


def fingerprint(text: str | None) -> str:
    """``length.hash.step.even places.k.places by content``, numbers in hexadecimal."""
    points = code_points(text)
    n = len(points)
    first, second = (prefix_sums(points, base) for base in BASES)
    step = 1
    while n // step > PLACES:
        step *= 2
    even = "".join(f"{v:08x}" for v in first[step:n + 1:step].tolist())
    places, zeros, k = chosen_places(first, BASES[0])
    content = ",".join(f"{p:x}:{z:x}:{int(first[p]):08x}" for p, z in zip(places, zeros))
    return f"{n:x}.{int(first[n]):08x}{int(second[n]):08x}.{step:x}.{even}.{k:x}.{content}"


class Print:
    """A fingerprint taken apart."""

    def __init__(self, text: str):
        n, whole, step, even, k, content = text.split(".")
        self.text, self.n, self.step, self.k = text, int(n, 16), int(step, 16), int(k, 16)
        self.last = int(whole[:8], 16)
        self.even = {0: 0}
        for x in range(len(even) // 8):
            self.even[(x + 1) * self.step] = int(even[8 * x:8 * x + 8], 16)
        self.content = [tuple(int(v, 16) for v in item.split(":")) for item in content.split(",") if item]


def even_share(a: Print, b: Print) -> int:
    """Code points in common stretches at equal places."""
    step = max(a.step, b.step)
    places = [p for p in range(0, min(a.n, b.n) + 1, step) if p in a.even and p in b.even]
    x, y = [a.even[p] for p in places], [b.even[p] for p in places]
    total, at = 0, 0
    while at < len(places) - 1:
        # longest common extension from places[at]: equal spans [at, m) at one place need no moving
        low, high = at, len(places) - 1
        while low < high:
            mid = (low + high + 1) // 2
            if (x[mid] - x[at] - y[mid] + y[at]) % PRIME == 0:
                low = mid
            else:
                high = mid - 1
        total += places[low] - places[at]
        at = low + 1
    return total


def content_share(a: Print, b: Print) -> int:
    """Code points in common stretches between places chosen by content, wherever they lie."""
    k, base = max(a.k, b.k), BASES[0]

    def at_level(f: Print) -> tuple[list[int], list[int]]:
        kept = [(p, h) for p, z, h in f.content if z >= k]
        return [0, *(p for p, _ in kept), f.n], [0, *(h for _, h in kept), f.last]

    ap, ah = at_level(a)
    bp, bh = at_level(b)

    def span(p: list[int], h: list[int], i: int, j: int) -> tuple[int, int]:
        return p[j] - p[i], span_hash(h[i], h[j], p[i], base)

    starts: dict[tuple[int, int], list[int]] = {}
    for j in range(len(bp) - 1):
        starts.setdefault(span(bp, bh, j, j + 1), []).append(j)
    total, i, taken = 0, 0, set()                      # taken: stretches of b that already have a partner
    while i < len(ap) - 1:
        best = (0, 0)
        for j in starts.get(span(ap, ah, i, i + 1), ()):
            if j in taken:
                continue
            low, high = 1, min(len(ap) - i, len(bp) - j) - 1
            while low < high:
                mid = (low + high + 1) // 2
                if span(ap, ah, i, i + mid) == span(bp, bh, j, j + mid):
                    low = mid
                else:
                    high = mid - 1
            best = max(best, (low, -j))
        if best[0]:
            j, length = -best[1], best[0]
            while length and any(j + x in taken for x in range(length)):
                length -= 1
            taken.update(range(j, j + length))
            total += ap[i + length] - ap[i]
            i += max(length, 1)
        else:
            i += 1
    return total


def likeness(one: str, other: str) -> float:
    """Share (0 to 1) of the longer text that lies in stretches common to both, told from fingerprints alone."""
    if one == other:
        return 1.0
    a, b = Print(one), Print(other)
    if not a.n or not b.n:
        return 0.0
    return min(1.0, max(even_share(a, b), content_share(a, b)) / max(a.n, b.n))


def edited(text: str, following: str) -> str:
    """The last quarter of a text replaced by as much of the beginning of the following one."""
    quarter = len(text) // 4
    return text[:len(text) - quarter] + following[:quarter]


ROW = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
       ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
BORDER = [("place", pa.int64()), ("head", pa.bool_()), ("text", pa.string())]
SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, " \
         "near_edited double, near_next double"


def compared(doc_id: int | None, text: str, print_of: str, following: str, print_next: str) -> tuple:
    changed = edited(text, following)
    print_changed = fingerprint(changed)
    return (doc_id, len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), print_of,
            print_changed, likeness(print_of, print_changed), likeness(print_of, print_next))


def _batch(rows: list[tuple], fields: list) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, fields)], [f for f, _ in fields])


def neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness to the text's and to the next
    document's; ``ranges`` (the session's shuffle partitions if not given) is the number of ranges."""
    spark = docs.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")) \
        .withColumn("__h", F.xxhash64("text"))
    ordered = rows.repartitionByRange(n, "doc_id", "__h").sortWithinPartitions("doc_id", "__h", "text").drop("__h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId()
        last = None                                    # doc_id, text, fingerprint of the row before
        for b in small_batches(batches):
            out = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                mark = fingerprint(text)
                if last is None:
                    out.append((*[None] * 7, place, True, text))
                else:
                    out.append((*compared(*last, text, mark), None, None, None))
                last = (doc, text, mark)
            yield _batch(out, ROW + BORDER)
        if last is not None:
            doc, text, mark = last
            yield _batch([(doc, len(text), None, mark, None, None, None, place, False, text)], ROW + BORDER)

    done = written(ordered.mapInArrow(run, SCHEMA + ", place long, head boolean, text string"), "prints", "zstd")
    borders = done.filter("place is not null")
    # two rows a range: the last of one range and the first of the next range that has rows
    whole = Window.orderBy("place").rowsBetween(1, Window.unboundedFollowing)
    heads = borders.filter("head").select("place")
    order = heads.withColumn("next", F.min("place").over(whole)) \
        .withColumn("next", F.coalesce("next", F.min("place").over(Window.orderBy(F.lit(1)).rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing))))
    following = borders.filter("head").select(F.col("place").alias("next"), F.col("text").alias("following"))
    tails = borders.filter("not head").select("doc_id", "text", "fingerprint", "place").join(order, "place") \
        .join(following, "next").select("doc_id", "text", "fingerprint", "following")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            yield _batch([compared(doc, text, mark, following, fingerprint(following))
                          for doc, text, mark, following in zip(*(c.to_pylist() for c in b.columns))], ROW)

    return done.filter("place is null").select([f for f, _ in ROW]).unionByName(tails.mapInArrow(close, SCHEMA))
