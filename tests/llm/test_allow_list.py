"""Allowed parts of a candidate hide themselves and nothing else."""
from acqlens.llm import secrets

RANDOM = "q7Rz0Xk2Vb9LmT4sWnJ8cYd1HgP5uFaE3oKiQxZt"


def spans_of(spark, text):
    (row,) = secrets.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    return [(s.kind, text[s.start:s.end]) for s in row.spans if s.kind.startswith("entropy")]


def test_a_word_beside_a_secret_does_not_hide_it(spark):
    for text in (f"see example/uploads/{RANDOM} there", f"{RANDOM}/EXAMPLE", f"0123456789_{RANDOM}-placeholder-{RANDOM}", RANDOM):
        found = spans_of(spark, text)
        assert len(found) == text.count(RANDOM) and all(k == "entropy_base64" and RANDOM[2:-2] in v for k, v in found), text
        assert not any("example" in v.lower() or "placeholder" in v for _, v in found)


def test_examples_hide_themselves(spark):
    for text in ("wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY", f"{RANDOM}example", f"abcdefghijkl{RANDOM}",
                 "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "example/placeholder_0123456789"):
        assert spans_of(spark, text) == [], text
