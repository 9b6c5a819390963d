"""Language identification by words first, then ever shorter character n-grams.

Learning counts every word of every training text per language; the most frequent words of each language
and the most frequent character n-grams (of words between word marks, weighted by the words' counts) make
the model, whose size is fixed by ``WORDS`` and ``GRAMS`` per language, so it may be broadcast. A word of
the model scores by its log frequency in each language. Any other word scores by the mean over its n-grams
of the greatest length at which the model knows one of them; failing all, it says nothing. The text's
score per language is the mean over its words.

Nulls: a null text, or one without a letter, is ``und`` with score 0. Rows without a language or id
give no training text / count as id ''. Ties go to the language with more training words, then by name.
With no training text every row is ``und``. Repeated rows count as often as they occur.
"""
from __future__ import annotations

import uuid
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from acqlens.llm.common import small_batches

WORDS = 20_000     # words kept per language
GRAMS = 8_000      # n-grams kept per language and length
LONGEST = 5        # characters of the longest n-grams
PENALTY = 7.0      # minus log10 frequency of what a language does not have
EVIDENCE = 10.0    # a long text counts as so many independent words in its posterior

# ASCII letters in lower case, other ASCII characters blank, bytes of other characters as they are
_LETTERS = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def letter_words(text: str | None) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(_LETTERS).split() if text else []


def grams(word: str, longest: int) -> Iterator[list[str]]:
    """The n-grams of a word between marks, longest first."""
    marked = f" {word} "
    for n in range(min(longest, len(marked)), 0, -1):
        yield [marked[i:i + n] for i in range(len(marked) - n + 1)] if n > 1 else list(word)


def _batch(held: dict[str, Counter]) -> pa.RecordBatch:
    keys = [k for found in held.values() for k in found]
    return pa.RecordBatch.from_arrays([
        pa.array([lang for lang, found in held.items() for _ in range(len(found))], pa.string()),
        pa.array([k.encode("utf-8", "replace") if isinstance(k, str) else k for k in keys], pa.binary()),
        pa.array([n for found in held.values() for n in found.values()], pa.int64())], ["lang", "key", "n"])


def _sums(adds: Iterator[tuple[str, Callable[[Counter], None]]], most: int = 200_000) -> Iterator[pa.RecordBatch]:
    """Partial sums of (lang, key, n): each step adds to the counter of its language; beyond ``most`` keys
    the counters go out."""
    held: dict[str, Counter] = defaultdict(Counter)
    for lang, add in adds:
        add(held[lang])
        if sum(map(len, held.values())) >= most:
            yield _batch(held)
            held.clear()
    if held:
        yield _batch(held)


def word_counts(train: DataFrame) -> DataFrame:
    """(lang, key, n): every word of every training text, counted in the tasks before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def adds():
            for b in small_batches(batches):
                for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    yield lang, lambda held, text=text: held.update(letter_words(text))
        yield from _sums(adds())
    return train.mapInArrow(run, "lang string, key binary, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))


def gram_counts(counts: DataFrame, longest: int) -> DataFrame:
    def add(held: Counter, word: str, n: int) -> None:
        for found in grams(word, longest):
            for g in found:
                held[g] = held.get(g, 0) + n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def adds():
            for b in batches:
                for lang, w, n in zip(*(c.to_pylist() for c in b.columns)):
                    yield lang, lambda held, w=w, n=n: add(held, w.decode("utf-8", "replace"), n)
        yield from _sums(adds())
    return counts.mapInArrow(run, "lang string, key binary, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))


SALTS = 32         # parts of a language whose most frequent keys are found side by side


def _most_frequent(counts: DataFrame, by: list[str], most: int) -> DataFrame:
    """The rows of the ``most`` largest n per group. Each of ``SALTS`` parts of a group ranks on its own
    first, so the task that ranks a whole group reads at most ``SALTS * most`` rows at any input size."""
    order = [F.desc("n"), F.col("key")]
    part = Window.partitionBy(*by, "salt").orderBy(*order)
    whole = Window.partitionBy(*by).orderBy(*order)
    return counts.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS))) \
        .withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= most) \
        .withColumn("rank", F.row_number().over(whole)).filter(F.col("rank") <= most).drop("rank", "salt")


@dataclass
class Model:
    langs: list[str]            # by training words, most first
    words: list[bytes]
    word_rows: np.ndarray       # minus log10 frequency, a row a word and a column a language
    grams: list[str]
    gram_rows: np.ndarray
    longest: int
    penalty: float


def learn(docs: DataFrame, is_train: Column, words: int = WORDS, gram_rows: int = GRAMS, longest: int = LONGEST,
          penalty: float = PENALTY, text_col: str = "text", lang_col: str = "lang") -> Model:
    train = docs.filter(is_train & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()) \
        .select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    counts = word_counts(train).persist(StorageLevel.DISK_ONLY)    # read three times
    try:
        return _model(counts, words, gram_rows, longest, penalty)
    finally:
        counts.unpersist()


def _model(counts: DataFrame, words: int, gram_rows: int, longest: int, penalty: float) -> Model:
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(totals, key=lambda k: (-totals[k], k))
    place = {k: i for i, k in enumerate(langs)}

    def rows(df: DataFrame) -> list:
        return df.select("lang", "key", "n").collect()

    def table(found: list, total: dict, key) -> dict:
        out: dict = {}
        for lang, k, n in found:
            out.setdefault(key(k), np.full(len(langs), penalty, np.float32))[place[lang]] = -np.log10(n / total[key(k, lang)])
        return out

    kept = rows(_most_frequent(counts, ["lang"], words))
    sums: dict = defaultdict(int)
    for lang, _, n in kept:
        sums[lang] += n
    known = table(kept, sums, lambda k, lang=None: bytes(k) if lang is None else lang)
    by_length = gram_counts(counts, longest).withColumn("size", F.length(F.decode("key", "UTF-8")))
    found = rows(_most_frequent(by_length, ["lang", "size"], gram_rows))
    for lang, k, n in found:
        sums[lang, len(bytes(k).decode())] += n
    pieces = table(found, sums, lambda k, lang=None: bytes(k).decode() if lang is None else (lang, len(bytes(k).decode())))

    def matrix(rows_by_key: dict) -> np.ndarray:
        return np.stack(list(rows_by_key.values())) if rows_by_key else np.zeros((0, len(langs)), np.float32)
    return Model(langs, list(known), matrix(known), list(pieces), matrix(pieces), longest, penalty)


class Scorer:
    """Scores texts; keeps the vectors of words met, as many as fit in ``room`` rows."""

    def __init__(self, model: Model, room: int = 300_000):
        self.model, self.base = model, len(model.words)
        self.rows = np.zeros((self.base + room, len(model.langs)), np.float32)
        self.at = {w: i for i, w in enumerate(model.words)}
        self.rows[:self.base] = model.word_rows
        self.own = dict(self.at)
        self.grams = {g: i for i, g in enumerate(model.grams)}

    def unseen(self, word: bytes) -> np.ndarray:
        for found in grams(word.decode("utf-8", "replace"), self.model.longest):
            at = [i for g in found if (i := self.grams.get(g)) is not None]
            if at:
                return (self.model.gram_rows[at].sum(axis=0) + self.model.penalty * (len(found) - len(at))) / len(found)
        return np.zeros(len(self.model.langs), np.float32)

    def _rows_of(self, words: list[bytes]) -> np.ndarray:
        at = list(map(self.own.get, words))
        if None in at:
            new = dict.fromkeys(w for w, i in zip(words, at) if i is None)
            if len(self.own) + len(new) > len(self.rows):        # words met are forgotten, those of this text too
                self.own = dict(self.at)
                new = dict.fromkeys(w for w in words if w not in self.own)
            if len(self.own) + len(new) > len(self.rows):        # one text with more new words than rows
                vector = {w: self.unseen(w) for w in new}
                return np.stack([vector[w] if w in vector else self.rows[self.own[w]] for w in words])
            for w in new:
                self.rows[len(self.own)] = self.unseen(w)
                self.own[w] = len(self.own)
            at = list(map(self.own.__getitem__, words))
        return self.rows[np.array(at)]

    def predict(self, text: str | None) -> tuple[str, float]:
        words = letter_words(text)
        if not words or not self.model.langs or not any(map(str.isalpha, text)):
            return "und", 0.0
        sums = np.zeros(len(self.model.langs))
        for at in range(0, len(words), 100_000):                  # bounded memory for giant texts
            sums += self._rows_of(words[at:at + 100_000]).sum(axis=0, dtype=np.float64)
        mean = sums / len(words)
        best = int(mean.argmin())
        weight = len(words) * EVIDENCE / (len(words) + EVIDENCE)
        posterior = 10.0 ** (-(mean - mean[best]) * weight)
        return self.model.langs[best], float(1.0 / posterior.sum())


_SCORERS: dict[str, Scorer] = {}                                  # of a worker process, by model


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` plus lang_pred and lang_score (columns of these names are replaced)."""
    docs = docs.drop("lang_pred", "lang_score")
    shared, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex
    schema = StructType(list(docs.schema)).add("lang_pred", "string").add("lang_score", "double")
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[key] = Scorer(shared.value)
        scorer = _SCORERS[key]
        for b in small_batches(batches):
            found = [scorer.predict(t) for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([x[0] for x in found], pa.string()),
                                              pa.array([x[1] for x in found], pa.float64())], names=schema.names)
    return docs.mapInArrow(run, schema)
