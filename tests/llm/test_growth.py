"""Less memory, disk and time as tables grow: the same results from what is sent, kept and remembered."""
from __future__ import annotations

from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")
from acqlens.llm import langid, nn_descent, packing, piece_scan  # noqa: E402
from acqlens.llm.queries import QUERIES, tokenizer_path  # noqa: E402


def test_products_are_sums_in_the_order_of_components(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((60, 9)) * 10.0 ** rng.integers(-3, 4, (60, 9))
    nodes = spark.createDataFrame([(i * 7, v.tolist()) for i, v in enumerate(x)], "node long, raw array<double>")
    asked = nodes.filter("node % 5 = 0").select(F.col("node").alias("qnode"), F.col("raw").alias("q"))
    pairs = asked.select("qnode").crossJoin(nodes.select("node")).filter("(qnode + node) % 3 = 0")
    got = {(r.qnode, r.node): r.score for r in nn_descent._products(pairs, nodes, asked, 3).collect()}
    want = {}
    for q, n in ((r.qnode, r.node) for r in pairs.collect()):
        total = 0.0
        for a, b in zip(x[q // 7].tolist(), x[n // 7].tolist()):
            total += a * b
        want[q, n] = total
    assert got == want


def test_a_round_sends_each_edge_of_a_task_once():
    src, dst, sim = np.array([1, 2, 1, 1]), np.array([5, 5, 5, 6]), np.array([0.25, 0.5, 0.75, 0.1])
    got = [r for b in nn_descent._once(iter([[src[:2], dst[:2], sim[:2]], [src[2:], dst[2:], sim[2:]]])) for r in b.to_pylist()]
    assert sorted(tuple(r.values()) for r in got) == [(1, 5, 0.75), (1, 6, 0.1), (2, 5, 0.5)]
    assert not [r for b in nn_descent._once(iter([[src[:0], dst[:0], sim[:0]]])) for r in b.to_pylist()]


def test_frequent_units_outlive_a_full_cache():
    """A unit that every batch holds is encoded once, however often the remembered ones are too many."""
    encoder, plain = (packing.UnitEncoder(tokenizer_path("byte_bpe_50k.json"), cache=c) for c in (40, 10 ** 6))
    learnt, learn = [], encoder._learn
    encoder._learn = lambda units: learnt.extend(units) or learn(units)
    for k in range(12):
        texts = [" ".join(["head", "often", "naïve.", "line.\nnext", "x" * 80, *(f"u{k}{c}" for c in "abcdefghijkl")]), f"a \n b{k}", "", " ", f"{k}\n often"]
        want = [np.array(e.ids, "<u4").tobytes() for e in plain.tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert encoder.encode_all(texts) == want == plain.encode_all(texts)
        assert "x" * 80 not in encoder.known
    assert learnt.count("often") == 1 and len(encoder.known) + len(encoder.before) <= 80


def test_frequent_words_outlive_a_full_cache(monkeypatch):
    monkeypatch.setattr(piece_scan, "CACHE", 40)
    pieces, plain = (piece_scan.Pieces(tokenizer_path("piece_bpe_32k.model")) for _ in range(2))
    segmented, segment = [], pieces._segment
    pieces._segment = lambda words, size: segmented.extend(words) or segment(words, size)
    for k in range(12):
        texts = [piece_scan.marked(f"often {k} straße 🙂 \0 {'y' * 60} " + " ".join(f"w{k}{c}" for c in "abcdefghijkl")), ""]
        assert [np.frombuffer(x, "<u4").tolist() for x in pieces.encode_all(texts)] == [plain.trace(s, 0, len(s)) for s in texts]
    assert segmented.count("▁straße") == 1


def test_a_marked_unit_takes_its_word_from_the_kept_half():
    """A word that only the kept half of the cache holds is not encoded anew when a mark follows it."""
    encoder = packing.UnitEncoder(tokenizer_path("byte_bpe_50k.json"), cache=4)
    spelled, word = [], encoder.word
    encoder.word = lambda u: spelled.append(u) or word(u)
    for text in ("head kept one two", "kept, d'or, 日本, d'or: x \n kept; end ", "head kept! kept? " + "y" * 80):
        assert encoder.encode_all([text]) == [x.tobytes() for x in encoder._ids([text])]
    assert spelled.count("kept") == 1 and "end " not in encoder.known and "y" * 80 not in encoder.known


def test_learning_languages_writes_no_files(spark, monkeypatch):
    """Word counts are kept by the executors while a model is learnt, then freed: no file per shuffle partition."""
    docs = spark.createDataFrame([(1, "the cat and the dog", "en"), (2, "der Hund und die Katze", "de"), (3, None, "de"), (4, "x", None)],
                                 "doc_id long, text string, lang string")
    held, before = [], set(Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://")).glob("acqlens-*"))
    kept = spark.sparkContext._jsc.getPersistentRDDs().size()
    most = langid._most_frequent
    monkeypatch.setattr(langid, "_most_frequent", lambda counts, by, n: held.append(by) or most(counts, by, n))
    model = langid.learn(docs, F.lit(True))
    assert model.langs == ["de", "en"] and b"hund" in model.words and held == [["lang"], ["lang", "size"]]
    assert set(Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://")).glob("acqlens-*")) == before
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == kept


def test_language_scores_outlive_a_full_cache():
    """Words met before, unseen in training, score the same after the cache was full and forgotten, in texts of any length."""
    rng = np.random.default_rng(5)
    letters = sorted("abcdefgé")
    model = langid.Model(["en", "de", "fr"], [b"head", "é".encode()], rng.random((2, 3), np.float32) * 6,
                         [*letters, *(a + b for a in letters for b in letters)], rng.random((72, 3), np.float32) * 6, 5, 7.0)
    def text(n):
        return " ".join(["head", "often", *("".join(rng.choice(letters, rng.integers(1, 4))) for _ in range(n)), "1 X é Often"])
    texts = ["often often", *(text(n) for n in (5, 30, 1, 60, 7, 400, 3, 0, 9, 25) * 4)]
    scorer, plain = langid.Scorer(model, room=40), langid.Scorer(model)
    for t in texts:
        assert scorer.predict(t) == plain.predict(t) == langid.Scorer(model).predict(t)
        assert len(scorer.own) <= len(scorer.rows) == 42
        for w, i in scorer.own.items():
            assert (scorer.rows[i] == plain.rows[plain.own[w]]).all()


def test_op6_scores_words_again_after_a_worker_forgot_them(spark, tmp_path):
    """A text scores the same alone and after other texts of one task that hold its words and more than are remembered."""
    def long(first, n):
        return " ".join("hund" + "".join("abdefgklmn"[int(d)] for d in str(k)) for k in range(first, first + n))
    few = [(i, "the cat and the dog ran home" if i % 2 else "der Hund und die Katze", "en" if i % 2 else "de") for i in range(12)]
    last = (16, f"{long(100_000, 9_000)} the {long(400_000, 9_000)}", None)
    more = [(12 + k, long(k * 100_000, 100_000), None) for k in (1, 2, 3)]
    found = []
    for name, rows in (("alone", [last]), ("after", [*more, last])):
        docs = spark.createDataFrame(few + rows, "doc_id long, text string, lang string")
        docs.coalesce(1).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        found.append({r.doc_id: (r.lang_pred, r.score) for r in QUERIES["op6_language_id"](spark, f"{tmp_path}/{name}").collect()})
    alone, after = found
    assert len(after) == 16 and after.items() >= alone.items() and {after[k][0] for k in (13, 14, 15, 16)} == {"de"}


def test_words_between_borders_are_segmented_once():
    """A giant document's chunk gives the ids between its word borders with its matrix, and these are not found again."""
    pieces = piece_scan.Pieces(tokenizer_path("piece_bpe_32k.model"))
    rng = np.random.default_rng(8)
    words = ["often", "straße", "🙂", "\0", "y" * 60, "", "a\nb", "名", "\t", "▁", "ﷺx"]
    for _ in range(40):
        s = piece_scan.marked(" ".join(rng.choice(words, 60)))
        body = len(s) - pieces.longest
        m, borders, ids = pieces.transfer(s, body)
        first, last = borders
        assert ids == np.array(pieces.trace(s, first, last), "<u4").tobytes() and (m == pieces.matrix(s, body)).all()
        got = pieces.between(s[:first + 1], 0, first) + np.frombuffer(ids, "<u4").tolist() + pieces.between(s[last:], 0, len(s) - last)
        assert got == pieces.trace(s, 0, len(s))
        assert pieces.total(ids) == pytest.approx(pieces._best(s, first, last)[1])
        assert pieces.raw_all([ids, b"", np.array(got, "<u4").tobytes()]) == [pieces.raw(np.frombuffer(ids, "<u4").tolist()), b"", pieces.raw(got)]
    assert pieces.transfer("▁" * 40, 20)[1:] == (None, b"")


def test_units_of_letters_marks_and_a_line_break_take_known_words():
    """Marks that end a word, and the word that begins the next line, are split from it: only words go to the model,
    known ones not again."""
    encoder = packing.UnitEncoder(tokenizer_path("byte_bpe_50k.json"))
    encoder.encode_all(["head known naïve 日本 word"])
    spelled, word, batches, ids = [], encoder.word, [], encoder._ids
    encoder.word = lambda u, *before: spelled.append(u) or word(u, *before)
    encoder._ids = lambda texts: batches.append(texts) or ids(texts)
    text = "head known%%% known.\nNext naïve,.. word\nThen, known.\n日本. known.\n\nmore x's it's.\nd'or known'' word.\nΩmega 日本! new-ly"
    assert encoder.encode_all([text]) == [x.tobytes() for x in ids([text])]
    assert "known" not in spelled and "Next" in spelled and "Then" in spelled
    assert not any("known%%%" in t or "Next" in t for texts in batches for t in texts)
    rng = np.random.default_rng(7)
    parts = ["a", "é", "日", "Zq", "\n", ".", "%%", "'s", " ", "-", "9", "\t", " ", "ⁿ", "ª", "\x1c"]
    texts = ["".join(rng.choice(parts, 12)) for _ in range(3000)]
    assert encoder.encode_all(texts) == [x.tobytes() for x in ids(texts)]
