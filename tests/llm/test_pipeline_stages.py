"""Stages carry extra columns of any name unchanged, and take empty tables, null ids and repeated ids."""
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from acqlens.llm import quality_rules, simhash_dedup

EN = "the cat sat on the mat and then the dog ran away from the cat in the garden with {} other animals of the house "
DE = "der hund lief durch den garten und die katze schlief auf dem sofa am abend mit {} anderen tieren im haus "
CLASH = ["lang_pred", "Lang_Score", *quality_rules.COUNTS, "base_failed", "kept", "spans", "component_id"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stages"))
    spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def docs(spark):
    words = "red green blue yellow white black brown grey pink violet orange purple".split()
    rows = [(i, t.format(" ".join(words[i % 12:] + words[:i % 12])), lang, "s", 9) for i in range(24)
            for t, lang in ((EN, "en"), (DE, "de")) if (i % 2 == 0) == (lang == "en")]
    rows += [(None, EN.format("no"), "en", "s", 9), (100, None, "en", "s", 9), (101, "", "de", "s", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *[F.concat(F.lit("mine "), F.coalesce(F.col("doc_id").cast("string"), F.lit("?"))).alias(c) for c in CLASH])


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:4])
def test_extra_columns_are_carried(spark, docs, folder, name, stage):
    out = stage(spark, docs, folder)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    rows = out.collect()
    assert len(rows) > 10
    for r in rows:
        assert {r[c] for c in CLASH} == {f"mine {'?' if r.doc_id is None else r.doc_id}"}


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_take_an_empty_table(spark, docs, folder, name, stage):
    assert stage(spark, docs.limit(0), folder).count() == 0


def test_language_stage_takes_more_words_than_a_worker_remembers(spark, folder):
    """A task that meets more unseen words than it remembers forgets them all; a later text may hold some of them again."""
    def long(first, n):
        return " ".join("garden" + "".join("catdoghusmn"[int(d)] for d in str(k)) for k in range(first, first + n))
    texts = [long(k * 100_000, 100_000) for k in (1, 2, 3)] + [f"{long(100_000, 9_000)} {long(400_000, 9_000)}"]
    rows = [(i, t.format(i), lang) for i in range(8) for t, lang in ((EN, "en"), (DE, "de")) if (i % 2 == 0) == (lang == "en")]
    docs = spark.createDataFrame(rows + [(100 + i, t, None) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    kept = corpus_pipeline.language_id(spark, docs.coalesce(1), folder).select("doc_id").collect()
    assert sorted(r.doc_id for r in kept) == [*range(8), 100, 101, 102, 103]


def test_of_a_repeated_id_the_smallest_text_stays(spark):
    a, b = EN.format("some"), DE.format("vielen")
    rows = [(7, b, "x"), (7, a, "y"), (7, a, "y"), (8, None, "n"), (8, DE.format("zwei"), "m"), (None, a, "q"), (None, a, "q")]
    got = simhash_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string, more string")).collect()
    by_id = sorted(((r.doc_id, r.text, r.more) for r in got), key=str)
    assert (7, min(a, b), "x" if b < a else "y") in by_id and (8, None, "n") in by_id
    assert [r[0] for r in by_id].count(7) == 1 and [r[0] for r in by_id].count(8) == 1
