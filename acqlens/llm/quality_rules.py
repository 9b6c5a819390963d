"""Quality rules: a decision list learned by sequential covering, emitted as Spark expressions.

``features`` measures every whole text. ``learn`` takes a bounded sample of labelled documents and covers
the low-quality ones rule by rule: a rule is a conjunction of thresholds grown by information gain on one
part of the sample and pruned from its end on the other; the covered rows leave and the next rule is
grown, until a pruned rule is no longer precise enough. The list becomes one ordered CASE expression.

Nulls: a null or empty text has zero counts and fails the base rule. Labels that are null are not used;
labels of documents that are not there neither. Without both kinds of labels the list is empty and keeps
all that passes the base rule. Repeated rows are measured one by one. Extra columns are carried; columns
named like the features are replaced.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from acqlens.llm.common import small_batches

SAMPLE = 20_000        # labelled rows that the rules are learned from, at most
WINDOW = 5             # words in a window that may repeat
SYMBOLS = b"#*$%&|<>"
PRECISION = 0.9        # least precision of a rule on the pruning part
THRESHOLDS = 64        # thresholds tried per feature
CONDITIONS = 4         # conditions in a rule, at most

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits",
          "n_marks", "n_distinct"]
_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_SPACES = b" \t\n\v\f\r"


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words that lie in a window found twice or more (its first occurrence included)."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    code, span = ids[:n].astype(np.int64), int(ids.max()) + 1
    size = span
    for k in range(1, window):
        if size * span >= 1 << 62:                            # number what has been found so far anew
            code = np.unique(code, return_inverse=True)[1].astype(np.int64)
            size = int(code.max()) + 1
        code = code * span + ids[k:k + n]
        size *= span
    order = np.argsort(code, kind="stable")
    same = code[order[1:]] == code[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(ids) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + window, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The counts of ``COUNTS`` for one text."""
    if not text:
        return (0,) * len(COUNTS)
    data = text.encode("utf-8", "surrogatepass")
    w = data.split()
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(x, len(number)) for x in w), np.int64, len(w))
    lines = [x for x in data.split(b"\n") if x.strip()]
    return (len(w), len(text) - sum(map(data.count, (bytes([c]) for c in _SPACES))),
            sum(data.count(bytes([c])) for c in SYMBOLS), len(lines) - len(set(lines)), repeated_words(ids), len(lines),
            len(data) - len(data.translate(None, _UPPER)), len(data) - len(data.translate(None, _DIGITS)),
            data.count(b"!") + data.count(b"?"), len(number))


def features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus the counts (long)."""
    docs = docs.drop(*COUNTS)
    schema = StructType(list(docs.schema))
    for c in COUNTS:
        schema = schema.add(c, "long")
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            found = np.array([measure(t) for t in b.column(at).to_pylist()], np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(found[:, i]) for i in range(len(COUNTS)))], names=schema.names)
    return docs.mapInArrow(run, schema)


def _per(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))


def statistics() -> dict[str, Column]:
    """What the rules may look at."""
    return {
        "n_words": F.col("n_words").cast("double"), "mean_word": _per("word_chars", "n_words"),
        "symbols_per_word": _per("n_symbols", "n_words"), "dup_line_share": _per("n_dup_lines", "n_lines"),
        "repeat_share": _per("n_repeat_words", "n_words"), "upper_share": _per("n_upper", "word_chars"),
        "digit_share": _per("n_digits", "word_chars"), "marks_per_word": _per("n_marks", "n_words"),
        "distinct_share": _per("n_distinct", "n_words"), "words_per_line": _per("n_words", "n_lines"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


@dataclass
class Rule:
    """Reject where all conditions (feature, is_upper_bound, threshold) hold."""
    conditions: list[tuple[str, bool, float]] = field(default_factory=list)

    def holds(self, x: dict[str, np.ndarray], rows: np.ndarray) -> np.ndarray:
        out = np.ones(len(rows), bool)
        for name, upper, t in self.conditions:
            out &= x[name][rows] <= t if upper else x[name][rows] > t
        return out

    def expression(self) -> Column:
        known, out = statistics(), F.lit(True)
        for name, upper, t in self.conditions:
            out = out & (known[name] <= F.lit(t) if upper else known[name] > F.lit(t))
        return out


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray) -> Rule:
    """Adds the condition of the largest information gain until no clean row is covered."""
    rule = Rule()
    while len(rule.conditions) < CONDITIONS:
        p, n = int(bad[rows].sum()), int((~bad[rows]).sum())
        if not p or not n:
            break
        best, gain = None, 1e-9
        for name, col in x.items():
            v = col[rows]
            cuts = np.unique(np.quantile(v, np.linspace(0, 1, THRESHOLDS + 1)[1:-1], method="lower"))
            order = np.argsort(v, kind="stable")
            ends = np.searchsorted(v[order], cuts, side="right")
            below = np.concatenate(([0], np.cumsum(bad[rows][order])))[ends]
            for upper in (True, False):
                pp = below if upper else p - below
                nn = (ends - below) if upper else n - (ends - below)
                with np.errstate(divide="ignore", invalid="ignore"):
                    g = np.where(pp > 0, pp * (np.log2(pp / (pp + nn)) - np.log2(p / (p + n))), -1)
                k = int(g.argmax()) if len(g) else 0
                if len(g) and g[k] > gain:
                    best, gain = (name, upper, float(cuts[k])), float(g[k])
        if best is None:
            break
        rule.conditions.append(best)
        rows = rows[Rule([best]).holds(x, rows)]
    return rule


def _prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray) -> tuple[Rule, float]:
    """The beginning of the rule that is worth most, (p - n) / (p + n), on the pruning rows; its precision."""
    best, worth, precision = Rule(), -2.0, 0.0
    for k in range(1, len(rule.conditions) + 1):
        part = Rule(rule.conditions[:k])
        hit = rows[part.holds(x, rows)]
        p = int(bad[hit].sum())
        w = (2 * p - len(hit)) / max(1, len(hit))
        if len(hit) and w > worth:
            best, worth, precision = part, w, p / len(hit)
    return best, precision


def cover(x: dict[str, np.ndarray], bad: np.ndarray, precision: float = PRECISION) -> list[Rule]:
    """The decision list: every third row prunes, the others grow."""
    rows, rules = np.arange(len(bad)), []
    while bad[rows].any() and not bad[rows].all():
        prunes = rows % 3 == 0
        rule, right = _prune(_grow(x, bad, rows[~prunes]), x, bad, rows[prunes])
        if not rule.conditions or right < precision:
            break
        rules.append(rule)
        rows = rows[~rule.holds(x, rows)]
    return rules


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, precision: float = PRECISION,
          id_col: str = "doc_id", text_col: str = "text") -> list[Rule]:
    """Rules from at most ``sample`` labelled documents, in the order of a hash of their ids."""
    some = labels.filter("quality is not null").select(F.col("doc_id").alias("__id"), F.col("quality").alias("__quality")) \
        .orderBy(F.xxhash64("__id"), "__id", "__quality").limit(sample)
    texts = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("text")) \
        .join(F.broadcast(some.select("__id").distinct()), "__id").groupBy("__id").agg(F.min("text").alias("text")).join(some, "__id")
    seen = features(texts).filter(~base_failed()).select("__id", "__quality", *(c.alias(f"s_{k}") for k, c in statistics().items())) \
        .toPandas().sort_values(["__id", "__quality"], ignore_index=True)
    x = {k: seen[f"s_{k}"].to_numpy(float) for k in statistics()}
    return cover(x, seen["__quality"].to_numpy() == 0, precision)


def verdict(rules: list[Rule]) -> Column:
    """The list in order, as one conditional: the first rule that holds rejects; the last word is to keep."""
    out = F.when(base_failed(), F.lit(False))
    for rule in rules:
        out = out.when(rule.expression(), F.lit(False))
    return out.otherwise(F.lit(True))


def judge(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, precision: float = PRECISION,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` plus the counts, base_failed and kept."""
    rules = learn(docs, labels, sample, precision, id_col, text_col)
    return features(docs.drop("base_failed", "kept"), text_col).withColumn("base_failed", base_failed()) \
        .withColumn("kept", verdict(rules))
