"""Lints of the training-data operators: plans without cross joins, no Python in native ones, no hints."""
import pathlib
import re

import pytest

from acqlens import llm
from acqlens.llm.queries import QUERIES, tokenizer_path
from acqlens.llm import piece_scan

SMALL = "/root/testdata/sf0.001"
NATIVE = ("op4_secret_scan",)
SOURCES = sorted(pathlib.Path(llm.__path__[0]).glob("*.py"))


@pytest.mark.parametrize("name", ["op4_secret_scan", "op8_piece_scan", "op9_quality_rules", "op10_license_scan",
                                  "op11_periodic_runs", "op12_importance_resampling", "op13_prefix_prints"])
def test_plans(spark, name):
    p = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    python = re.search(r"(BatchEvalPython|ArrowEvalPython|FlatMap\w+In(Pandas|Arrow)|MapIn(Pandas|Arrow))", p)
    assert python is None or name not in NATIVE, python
    for scan in re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*documents\.parquet", p):
        assert "source" not in scan and "n_chars" not in scan, scan


def test_sources_hint_bounded_broadcasts_and_cut_no_lineage_locally():
    for f in SOURCES:
        text = f.read_text()
        for word in ("localCheckpoint", "crossJoin", ".rdd"):
            assert word not in text, (f.name, word)
        # hints only for the labelled samples, which documented parameters bound
        assert text.count("F.broadcast(") == (f.name in ("toxicity.py", "quality_rules.py")), f.name


def test_matrices_collapse_at_word_borders():
    model = piece_scan.Pieces(tokenizer_path("piece_bpe_32k.model"))
    text = piece_scan.marked(("the cat  sat on  " + "a" * 40 + " é🙂 日本語 x" * 3 + "   ") * 4)
    for begin in (0, 1, 7, 40):
        for body in (0, 1, 5, 17, 60, 150):
            s = text[begin:begin + body + model.longest]
            body = min(body, len(s))
            got, want = model.matrix(s, body), model.full_matrix(s, body)
            assert got.shape == want.shape and ((got == want) | (abs(got - want) < 1e-9)).all()
    assert model.word_borders(text, 1, len(text)) and model.word_borders("abc", 1, 3) is None
    model.by_words = False
    assert model.word_borders(text, 1, len(text)) is None
    assert model.encode(text) == model.trace(text, 0, len(text))


def test_a_text_of_several_chunks(spark):
    path = tokenizer_path("piece_bpe_32k.model")
    words = ["piece", "scan", "ünïcode", "日本語", "x" * 200, "", "\n", "🙂"]
    text = " ".join(words[k * k % 8] + str(k % 7) for k in range(30_000))
    run = "ab" * 50_000                                      # no border in three chunks
    docs = spark.createDataFrame([(1, text), (2, run), (3, "short")], "doc_id long, text string")
    chunks = {r.doc_id: r.chunks for r in piece_scan.encode(docs, path).collect()}
    assert chunks[1] > 10 and chunks[2] == 4 and chunks[3] == 1
    assert {r.doc_id: r.text for r in piece_scan.decode(piece_scan.encode(docs, path), path).collect()} == {1: text, 2: run, 3: "short"}
