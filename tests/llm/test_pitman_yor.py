"""The Pitman-Yor model against closed forms, and the same scores however pairs are dealt."""
from __future__ import annotations

import math
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from acqlens.llm import pitman_yor

SCHEMA = "doc_id long, text string, row string, train string, n_tokens int, score string, bucket int"


def texts(seed, n):
    rng = random.Random(seed)
    words = ["the", "The", "cat", "é🙂", "x" * 50, *(f"w{i}" for i in range(40))]
    return [(i, " ".join(rng.choice(words[:rng.randint(2, 45)]) for _ in range(rng.randint(0, 60)))) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", "clash", 1, "clash", 1) for i, t in rows], SCHEMA)


def tokens(text):
    return [None, *(text or "").lower().split(), ""]        # None: before the text, "": its end


def scores(spark, rows, **kw):
    got = pitman_yor.score(frame(spark, rows), F.coalesce(F.col("doc_id") % 5 != 1, F.lit(True)), **kw)
    return sorted(((r.doc_id, r.train, r.n_tokens, r.n_known, round(r.base_score, 7), round(r.score, 7)) for r in got.collect()), key=str)


ROWS = texts(1, 120) + [(200, None), (201, ""), (201, ""), (None, "the cat the cat"), (None, "other"), (206, "only held out words"),
                        (202, "the cat " * 30_000)]


@pytest.fixture(scope="module")
def one_bucket(spark):
    return scores(spark, ROWS)


def test_dealing_does_not_change_scores(spark, one_bucket):
    assert len(one_bucket) == len(ROWS)
    assert scores(spark, ROWS, bucket_chars=20_000) == one_bucket
    held = [r for r in one_bucket if not r[1] and r[2] > 5 and r[3] == r[2]]
    assert held and sum(r[5] for r in held) > sum(r[4] for r in held)     # better than the smoothed unigrams


def test_without_new_tables_it_is_the_relative_frequency(spark):
    rows = [r for r in ROWS if r[0] != 202]
    train = [tokens(t) for i, t in rows if i is None or i % 5 != 1]
    pairs = Counter(p for w in train for p in zip(w, w[1:]))
    heads = Counter(u for w in train for u in w[:-1])
    got = {(r[0], r[2]): r for r in scores(spark, rows, discount=0.0, strength=1e-12, bucket_chars=5_000)}
    for i, t in rows:
        if i is None or i % 5 != 1:
            w = tokens(t)
            want = sum(math.log10(pairs[p] / heads[p[0]]) for p in zip(w, w[1:]))
            assert got[i, len(w) - 1][5] == pytest.approx(want, abs=1e-5)


def test_with_new_tables_alone_it_is_the_base(spark):
    rows = ROWS[:40]
    vocabulary = {w for i, t in rows if i % 5 != 1 for w in tokens(t)[1:]}
    for r in scores(spark, rows, discount=0.0, strength=1e15):
        assert r[5] == pytest.approx(-r[2] * math.log10(len(vocabulary) + 1), rel=1e-6)


def test_blocks_are_read_back():
    rng = np.random.default_rng(4)
    for n in (0, 1, 1000):
        u, w = rng.integers(-2**63, 2**63 - 1, (2, n)) // 2**60 * 2**50
        c, far = rng.integers(0, 3, n), rng.integers(0, 2**40, n)
        for a, b in zip(pitman_yor.unpack(pitman_yor.pack(u, w, c, far)), (u, w, c, far)):
            assert (a == b).all() and len(a) == n


def test_a_bucket_is_counted_in_small_batches():
    n = pitman_yor.ROWS * 2 + 5
    u, w, c = np.arange(n), np.arange(n) % 7, np.arange(n) % 3
    got = list(pitman_yor.bucket_counts(4, u, w, c))
    assert max(b.num_rows for b in got) <= pitman_yor.ROWS and {x for b in got for x in b.column(1).to_pylist()} == {4}
    kinds = {k: [r for b in got for r in b.to_pylist() if r["kind"] == k] for k in range(4)}
    assert sorted((r["a"], r["b"], r["x"]) for r in kinds[pitman_yor.DISH]) == [(i, i % 7, 2) for i in range(2, n, 3)]
    assert [(r["a"], r["x"], r["y"]) for r in kinds[pitman_yor.WORD]] == [
        (i, int(c[w == i].sum()), int((c[w == i] == 1).sum())) for i in range(7)]
    assert [(r["a"], r["x"], r["y"]) for r in kinds[pitman_yor.CONTEXT]] == [(i, i % 3, int(i % 3 == 1)) for i in range(n)]
    assert sorted(pitman_yor.unpack(kinds[pitman_yor.UNSEEN][0]["block"])[0].tolist()) == list(range(0, n, 3))


def test_distinct_rows_of_columns_whose_mix_is_the_same():
    a = np.array([3, 1, 3, 1, 2], np.int64)
    with np.errstate(over="ignore"):       # the second column undoes what the mix makes of the first
        x = a.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        b = (np.uint64(5) - (x ^ (x >> np.uint64(29)))).view(np.int64)
    got = pitman_yor.distinct(a, b, n=np.array([1, 10, 100, 1000, 0]))
    assert sorted((i, n) for i, _, n in zip(*map(list, got))) == [(1, 1010), (2, 0), (3, 101)]


def test_blocks_take_few_bytes_a_pair():
    """Words of a block travel as differences, bytes of one place together: 8 random bytes a word before."""
    rng = np.random.default_rng(2)
    words = rng.integers(-2 ** 63, 2 ** 63 - 1, 20_000)
    u, w, n = rng.choice(words, 20_000), rng.choice(words, 20_000), rng.integers(1, 4, 20_000)
    block = pitman_yor.pack(u, w, n, sort=True)
    listed = len(np.unique(np.concatenate([u, w])))
    assert sorted(zip(*(x.tolist() for x in pitman_yor.unpack(block)))) == sorted(zip(u.tolist(), w.tolist(), n.tolist()))
    assert len(block) < 7 * listed + 4 * len(u)
    for part in (u[:0], u[:1], np.array([2 ** 63 - 1, -2 ** 63, 0])):
        assert [x.tolist() for x in pitman_yor.unpack(pitman_yor.pack(part, part))] == [part.tolist()] * 2


def test_prices_travel_as_counts(spark, monkeypatch, one_bucket):
    """What a bucket is told are customers and tables, which pack into few bytes; probabilities took 8 each before."""
    sent, blocks = [], pitman_yor._value_blocks
    monkeypatch.setattr(pitman_yor, "_value_blocks", lambda rows: sent.append(rows.dtypes) or blocks(rows))
    assert scores(spark, ROWS) == one_bucket
    assert len(sent) == 3 and {t for dtypes in sent for _, t in dtypes} == {"int", "bigint"}


def test_words_of_a_few_texts_are_held_at_once():
    """A column's words are taken out by small slices: 12 MB of text were held as words before."""
    column = pa.array([None, "", *(" ".join(f"w{k % 97}x{i}" for k in range(30_000)) for i in range(20)), "Last one"])
    hashes = pitman_yor.Hashes()
    want = pitman_yor.tokens(column.to_pylist(), hashes)
    tracemalloc.start()
    got = pitman_yor.tokens_of(column, hashes)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(got, want))
    assert peak < sum(x.nbytes for x in got) * 2 + 8 * pitman_yor.WORDS_OF
    assert not len(pitman_yor.tokens_of(column[:0], hashes)[0])


def test_words_are_hashed_from_the_bytes_of_a_column():
    """All words of a batch take each step of XXH64 together, with the same hashes as one by one."""
    rng, hashes = random.Random(3), pitman_yor.Hashes()
    rows = [None, "", " ", "\n\x0b", "ABC", "é🙂 Ünder\x1cA", "  ".join("Q" * k for k in range(70)),
            *("".join(rng.choice("aBcÄ \t\n\x0c\x1c ,") for _ in range(rng.randint(0, 80))) for _ in range(300))]
    whole = pa.array(rows)
    for column in (whole, whole[3:40], whole[:0], pa.array(rows, pa.large_string())[2:], pa.array([None, ""])):
        got, want = pitman_yor.tokens_of(column, hashes), pitman_yor.tokens(column.to_pylist(), hashes)
        assert all(len(a) == len(b) and (a == b).all() for a, b in zip(got, want, strict=True))


def test_a_word_is_known_to_one_column_of_buckets():
    """Words were sent to every bucket before; a bucket's rows come as the pairs of the batch do."""
    rng = np.random.default_rng(5)
    w = rng.choice(rng.integers(-2 ** 63, 2 ** 63 - 1, 500), 4000)
    u, row = np.append(pitman_yor.START, w[:-1]), np.sort(rng.integers(0, 9, 4000))
    words, a, b, more, n = pitman_yor.pairs(u, w, row)
    sides = pitman_yor.grid(50)
    assert sides == (8, 7) and pitman_yor.grid(1) == (1, 1)
    got, columns, lines = Counter(), {}, {}
    for bucket, part in pitman_yor.dealt(sides, words, a, b, more, n):
        pu, pw, pm, pn = pitman_yor.unpack(pitman_yor.pack_listed(words, *part))
        for x, y, m, k in zip(*(z.tolist() for z in (pu, pw, pm, pn))):
            got[x, y, m] += k
            lines.setdefault(x, set()).add(bucket // 7)
            columns.setdefault(y, set()).add(bucket % 7)
    assert got == Counter(zip(u.tolist(), w.tolist(), row.tolist()))
    assert {len(x) for x in (*columns.values(), *lines.values())} == {1}
    far = pitman_yor.pairs(u, w, row + 2 ** 60)             # triples that one number cannot hold
    assert all((x == y).all() for x, y in zip(far, (words, a, b, more + 2 ** 60, n), strict=True))


def test_sorted_places_travel_as_differences():
    """Contexts of a block's sorted rows ascend: stored as they were, each took its bytes."""
    u = np.sort(np.random.default_rng(7).integers(0, 4000, 30_000))
    words, w = np.arange(4000) * 2 ** 51, np.zeros(30_000, np.int64)
    block = pitman_yor.pack_listed(words, u, w)
    got = pitman_yor.unpack(block)
    assert (got[0] == words[u]).all() and (got[1] == 0).all()
    assert len(block) < len(pitman_yor.pack_listed(words, u[::-1], w)) and len(block) < 20_000
