"""Periodic runs, importance resampling and prefix prints against brute force and on edge cases."""
from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from acqlens.llm import importance, periodic_runs, prefix_prints
from acqlens.llm.common import table

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, n_words string, runs int, score string, rank string, fingerprint int, place int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 1, "clash", "clash", 1, 1) for i, t in rows], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# -- periodic runs

def brute_runs(w, exponent=4, length=6):
    """Every run by definition: for each period the longest stretches that keep it, if no smaller period does."""
    out, n = [], len(w)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            stretch = w[i:i + size]
            smallest = next(p for p in range(1, size + 1) if all(stretch[x] == stretch[x + p] for x in range(size - p)))
            if smallest == q and size >= max(length, exponent * q):
                out.append((i, size, q))
            i = j + 1
    return sorted(out)


def brute_collapse(w, runs):
    gone = {x for s, n, q in runs for x in range(s + q, s + n)}
    return " ".join(v for x, v in enumerate(w) if x not in gone)


def random_words(rng, n):
    kind = rng.random()
    if kind < .3:
        return [rng.choice("ab") for _ in range(n)]
    if kind < .5:
        return ["a"] * n
    out = []
    while len(out) < n:
        part = [rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))]
        out += part * rng.randint(1, 9) + part[:rng.randint(0, len(part))]
    return out[:n]


def test_runs_equal_brute_force():
    rng = random.Random(1)
    for _ in range(700):
        w = random_words(rng, rng.randint(0, 90))
        ids = np.unique(np.array(w, dtype="U1"), return_inverse=True)[1].astype(np.int64) if w else np.zeros(0, np.int64)
        assert periodic_runs.runs_of(ids) == brute_runs(w), w
        assert periodic_runs.runs_of(ids, 2, 2) == brute_runs(w, 2, 2), w
        assert periodic_runs.runs_of(ids, 3, 11) == brute_runs(w, 3, 11), w


def test_neighbouring_suffixes_share_what_they_say():
    rng = random.Random(2)
    for _ in range(100):
        w = [rng.choice("ab") for _ in range(rng.randint(5, 60))]
        ids = np.array([ord(c) - 97 for c in w], np.int64)
        suffixes = sorted(range(len(w)), key=lambda i: w[i:])
        want = {}
        for i, j in zip(suffixes, suffixes[1:]):
            k = 0
            while max(i, j) + k < len(w) and w[i + k] == w[j + k]:
                k += 1
            if k >= 3:
                want[i, j] = k
        i, j, lcp = periodic_runs.repeated_suffixes(ids, 3)
        assert dict(zip(zip(i.tolist(), j.tolist()), lcp.tolist())) == want


def looped_words(doc_id, text):
    w = words(text)
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    if h % 10 == 0 and w:
        n, g = len(w), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_runs_of_documents(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(random_words(rng, rng.randint(0, 60)))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, " \t\n "), (None, "x " * 9), (203, "x " * 9), (203, "x " * 9),
             (204, "é🙂 \x85 " * 5), (205, " ".join(f"w{k % 5000}" for k in range(30_000)))]
    got = periodic_runs.digest(periodic_runs.find_runs(periodic_runs.looped(frame(spark, rows)))).collect()
    assert len(got) == len(rows)
    seen = []
    for doc_id, text in rows:
        w = looped_words(doc_id, text)
        runs = [(0, 30_000, 5000)] if doc_id == 205 else brute_runs(w)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
        seen.append((doc_id, len(runs), *(best[:1] + best[1:] + (1000 * best[1] // best[2],) if best else [None] * 4),
                     sha("".join(f"{s},{n},{p}\n" for s, n, p in runs)), sha(brute_collapse(w, runs))))
    key = str
    assert sorted(map(tuple, got), key=key) == sorted(seen, key=key)
    assert any(r[1] for r in seen) and zlib.crc32(b"205") % 10  # the long one is not looped


def test_loops_of_the_query(spark):
    got = {r.doc_id: r.text for r in periodic_runs.looped(table(spark, SMALL, "documents")).collect()}
    n = 0
    for r in table(spark, SMALL, "documents").select("doc_id", "text").collect():
        assert words(got[r.doc_id]) == looped_words(r.doc_id, r.text)
        n += words(r.text) != words(got[r.doc_id])
    assert n > 5


def test_runs_of_nothing(spark):
    none = frame(spark, [(1, "a")]).limit(0)
    assert periodic_runs.digest(periodic_runs.find_runs(periodic_runs.looped(none))).count() == 0


# -- importance resampling

def brute_features(text, most):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return w, [" ".join(w[i:i + n]) for n in range(1, most + 1) for i in range(len(w) - n + 1)]


def brute_resample(docs, target, most, buckets, percent, least):
    def count(texts):
        out = [0] * buckets
        for t in texts:
            for f in brute_features(t, most)[1]:
                out[zlib.crc32(f.encode()) % buckets] += 1
        return out
    s, t = count(x for _, x in docs), count(target)
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets))))
            for a, b in zip(s, t)]
    out = []
    for i, text in docs:
        w, f = brute_features(text, most)
        weight = math.floor(sum(gain[zlib.crc32(x.encode()) % buckets] for x in f) / len(f)) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + .5) / 4294967296))), len(w)))
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = [*range(1, percent * len(able) // 100 + 1)]
    return sorted([(*r[:4], k) for r, k in zip(able, ranks)] + [(*r[:4], None) for r in able[len(ranks):]]
                  + [(*r[:4], None) for r in out if r[4] < least], key=str)


@pytest.mark.parametrize("most,buckets", [(1, 10_000), (3, 97)])
def test_resampling(spark, most, buckets):
    rng = random.Random(5)
    docs = [(i, " ".join(rng.choice(["Cat", "dog's", "ÉÖ", "a1-b2", "x", " y"]) for _ in range(rng.randint(0, 60))))
            for i in range(200)] + [(300, None), (301, ""), (302, "cat " * 50_000), (None, "dog " * 30), (303, "--- !")]
    docs += [(400 + i, "Cat dog's " * 12) for i in range(60)]
    target = ["cat cat dog s", None, "a1 b2 cat", ""]
    got = importance.resample(frame(spark, docs), spark.createDataFrame([(t,) for t in target], "text string"), most, buckets)
    rows = [(r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in got.collect()]
    assert sorted(rows, key=str) == brute_resample(docs, target, most, buckets, 10, 20)
    assert sum(r[4] is not None for r in rows) > 10


def test_ties_and_repeats_are_drawn(spark):
    rows = [(i, 30, 30, 5, s) for i, s in [(3, 7), (1, 7), (2, 7), (4, 9), (5, 1), (6, 1), (6, 1), (None, 7), (8, 0), (9, 0)]]
    scored = spark.createDataFrame(rows + [(10, 3, 3, 5, 99)], "doc_id long, n_words long, n_features long, weight long, score long")
    got = importance.draw(scored, percent=60).collect()
    assert sorted((r["rank"], r.doc_id) for r in got if r["rank"]) == [(1, 4), (2, 1), (3, 2), (4, 3), (5, None), (6, 5)]
    assert len(got) == 11
    again = importance.draw(scored, percent=70).collect()
    assert sorted(r["rank"] for r in again if r["rank"]) == [*range(1, 8)]


def test_resampling_of_nothing(spark):
    none, docs = frame(spark, [(1, "a")]).limit(0), frame(spark, [(i, "word " * 30) for i in range(20)])
    assert importance.resample(none, docs).count() == 0
    assert importance.resample(docs, none).filter("rank is not null").count() == 2
    assert importance.resample(docs.filter("doc_id < 9"), docs).filter("rank is not null").count() == 0


# -- prefix prints

def test_prefix_sums_are_polynomial_hashes():
    text = "abcé🙂" * 7
    points = prefix_prints.code_points(text)
    assert points.tolist() == [ord(c) for c in text]
    for base in prefix_prints.BASES:
        sums = prefix_prints.prefix_sums(points, base)
        for n in range(len(text) + 1):
            assert sums[n] == sum((ord(c) + 1) * pow(base, k, prefix_prints.PRIME) for k, c in enumerate(text[:n])) \
                % prefix_prints.PRIME
        assert prefix_prints.span_hash(int(sums[5]), int(sums[10]), 5, base) == int(sums[5])


def test_likeness():
    rng = random.Random(7)
    text = " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(800))
    other = " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(800))

    def near(a, b):
        x, y = prefix_prints.fingerprint(a), prefix_prints.fingerprint(b)
        assert prefix_prints.likeness(x, y) == pytest.approx(prefix_prints.likeness(y, x), abs=.1)
        assert len(x) < 1200
        return prefix_prints.likeness(x, y)
    assert near(text, text) == 1 and near(text, other) < .05
    assert .65 <= near(text, prefix_prints.edited(text, other)) <= .76
    assert near(text, "in front " + text) > .8                       # moved
    assert near(text, text[:2000] + "X" + text[2001:]) > .9          # changed in place
    assert near(text, text[:2000] + text[2100:]) > .8                # cut out
    assert .4 < near(text, text + other) < .6
    assert near("", "") == 1 and near("", text) == 0
    assert near("abcd", "abce") == .75 and near("a" * 5000, "a" * 4000) >= .75
    for n in (1, 7, 31, 32, 33, 64, 1000):
        assert near(text[:n], text[:n]) == 1
        assert near(text[:n], text[:n - n // 4] + "!" * (n // 4)) >= .75 - 2 / 16


def test_equal_texts_alone_have_equal_prints():
    rng = random.Random(8)
    texts = {"".join(rng.choice("ab") for _ in range(rng.randint(0, 9))) for _ in range(3000)}
    assert len({prefix_prints.fingerprint(t) for t in texts}) == len(texts)


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_neighbours(spark, ranges):
    rng = random.Random(9)
    rows = [(i * 7 % 101, "".join(rng.choice("abc é🙂\n") for _ in range(rng.randint(0, 300)))) for i in range(100)]
    rows += [(500, None), (501, ""), (502, "long " * 60_000), (-4, "first"), (None, "no id"), (600, "same"), (600, "same")]
    got = prefix_prints.neighbours(frame(spark, rows), ranges=ranges).collect()
    texts = [(i, t or "") for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))]
    want = []
    for (i, t), (_, u) in zip(texts, texts[1:] + texts[:1]):
        quarter = len(t) // 4
        e = t[:len(t) - quarter] + u[:quarter]
        p, q, r = map(prefix_prints.fingerprint, (t, e, u))
        want.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), p, q, prefix_prints.likeness(p, q),
                     prefix_prints.likeness(p, r)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_neighbours_of_few(spark):
    none = frame(spark, [(1, "a")]).limit(0)
    assert prefix_prints.neighbours(none).count() == 0
    alone = prefix_prints.neighbours(frame(spark, [(1, "abcdefgh")])).collect()
    assert len(alone) == 1 and alone[0].near_next == 1
    assert alone[0].edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()


def test_no_null_columns(spark):
    got = prefix_prints.neighbours(table(spark, SMALL, "documents"))
    assert got.filter(F.greatest(*(F.col(c).isNull().cast("int") for c in got.columns)) > 0).count() == 0
    assert got.count() == table(spark, SMALL, "documents").count()
