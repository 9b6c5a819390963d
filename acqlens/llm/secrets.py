"""Secret scans in Spark expressions: patterns, and sliding-window Shannon entropy per character class.

Three base kinds are patterns (``assign``, ``access``, ``hex``). The method adds the kinds of ``CLASSES``:
a candidate is a run of a class's characters; a window of fixed width slides over it, and as one character
enters and one leaves, only the counts of these two change, so that sum(c * log2 c) is kept up to date
without counting the window anew. Stretches whose windows reach the class's entropy are spans, unless
the candidate matches the allow-list; a part of a candidate that says it is an example is cut out, and what stands
on either side is looked at by itself. No Python runs on rows: all is regular expressions and higher-order
functions within one row, without a shuffle.

Nulls: a null or empty text has no spans; a null id keeps its row. Repeated rows are scanned one by one.
Extra columns are carried by ``scan`` (``spans`` is replaced) and ``redact``. Empty tables give no rows.
"""
from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST_VALUE = 6   # characters of an assigned value
CHUNK = 512       # matches appended at a time, so that long lists cost linear time


@dataclass(frozen=True)
class CharClass:
    """Runs of ``pattern`` (of ``window`` characters at least) hold a secret where the entropy of a window
    reaches ``bits``."""
    kind: str
    pattern: str
    window: int
    bits: float


CLASSES = (CharClass("entropy_hex", r"[0-9A-Fa-f]{24,}", 24, 2.9),
           CharClass("entropy_base64", r"[A-Za-z0-9+/_-]{24,}", 24, 4.0))

# candidates that are no secrets: words and identifiers of one case, numbers, UUIDs, dates and paths of
# words
ALLOW = (r"^[a-z_-]+$", r"^[A-Z_-]+$", r"^[A-Z]?[a-z]+(?:[-_/][A-Z]?[a-z]+)*$", r"^[0-9_/+-]+$",
         r"^[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",
         r"^(?:[a-z]{1,20}/)+[a-z]{1,20}$")
# parts of a candidate (between / _ + -) that say they are examples, or hold an alphabet: they hide themselves, not
# what stands beside them
ALLOW_WORDS = r"(?i:example|placeholder|abcdefghijkl|0123456789)"
ALLOW_PART = r"[^/_+-]*" + ALLOW_WORDS + r"[^/_+-]*"
BASE_KINDS = ("assign", "access", "hex")
SPAN = "array<struct<start:bigint,end:bigint,rank:int,kind:string>>"
_FOUND = "array<struct<start:bigint,end:bigint,value:string,inner:string>>"


def _let(value: Column, body) -> Column:
    """``body(x)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches with their places in code points: what lies between matches and
    the matches themselves add up to the places."""
    p = F.lit(pattern)
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, p, F.lit(0)).alias("value"),
                          F.regexp_extract_all(text, p, F.lit(group)).alias("inner"))

    def step(state: Column, item: Column) -> Column:
        start = state["at"] + F.length(item["gap"])
        end = start + F.length(item["value"])
        one = F.struct(start.alias("start"), end.alias("end"), item["value"].alias("value"), item["inner"].alias("inner"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(one)).alias("out"))

    def chunk(state: Column, items: Column) -> Column:
        inner = F.aggregate(items, F.struct(state["at"].alias("at"), F.array().cast(_FOUND).alias("out")), step)
        return _let(inner, lambda x: F.struct(x["at"].alias("at"), F.concat(state["out"], F.array(x["out"])).alias("out")))

    def listed(items: Column) -> Column:
        # the last item is what follows the last match
        return _let(F.slice(items, 1, F.size(items) - 1), lambda z: F.flatten(F.aggregate(
            F.transform(F.sequence(F.lit(0), F.floor((F.size(z) - 1) / CHUNK).cast("int")),
                        lambda k: F.slice(z, k * CHUNK + 1, F.lit(CHUNK))),
            F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{_FOUND}>").alias("out")), chunk)["out"]))

    return F.when(text.rlike(pattern), _let(zipped, listed)).otherwise(F.array().cast(_FOUND))


def hot_stretches(value: Column, window: int, bits: float) -> Column:
    """(start, end) of the merged windows of ``value`` whose Shannon entropy is ``bits`` or more."""
    parts = [0.0] + [c * math.log2(c) for c in range(1, window + 2)]
    part = F.array(*map(F.lit, parts))
    most = (math.log2(window) - bits) * window + 1e-9     # entropy >= bits iff sum(c * log2 c) <= most
    stretch = "array<struct<start:bigint,end:bigint>>"

    def count(chars: Column, c: Column) -> Column:
        return F.length(chars) - F.length(F.replace(chars, c, F.lit("")))

    def step(state: Column, c: Column) -> Column:
        full = F.length(state["chars"]) == window
        rest = F.when(full, F.substring(state["chars"], 2, window)).otherwise(state["chars"])
        gone = count(state["chars"], F.substring(state["chars"], 1, 1))
        less = F.when(full, part[gone - 1] - part[gone]).otherwise(F.lit(0.0))
        had = count(rest, c)
        moved = F.struct(F.concat(rest, c).alias("chars"), (state["sum"] + less + part[had + 1] - part[had]).alias("sum"),
                         (state["at"] + 1).alias("at"), state["out"].alias("out"))

        def mark(s: Column) -> Column:
            hot = (F.length(s["chars"]) == window) & (s["sum"] <= most)
            start = s["at"] - window
            last = F.try_element_at(s["out"], F.lit(-1))
            grown = F.when(last.isNotNull() & (last["end"] >= start),
                           F.concat(F.slice(s["out"], 1, F.size(s["out"]) - 1),
                                    F.array(F.struct(last["start"].alias("start"), s["at"].alias("end"))))) \
                .otherwise(F.concat(s["out"], F.array(F.struct(start.alias("start"), s["at"].alias("end")))))
            return F.struct(s["chars"].alias("chars"), s["sum"].alias("sum"), s["at"].alias("at"),
                            F.when(hot, grown).otherwise(s["out"]).alias("out"))
        return _let(moved, mark)

    start = F.struct(F.lit("").alias("chars"), F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("at"),
                     F.array().cast(stretch).alias("out"))
    return F.aggregate(F.split(value, ""), start, step)["out"]


def _span(start: Column, end: Column, rank: int, kind: str) -> Column:
    return F.struct(start.cast("long").alias("start"), end.cast("long").alias("end"), F.lit(rank).alias("rank"),
                    F.lit(kind).alias("kind"))


def _as_spans(found: Column, rank: int, kind: str) -> Column:
    return F.transform(found, lambda m: _span(m["start"], m["end"], rank, kind))


def _unhidden(value: Column) -> Column:
    """(start, value) of the stretches of a candidate between its allowed parts."""
    schema = "array<struct<start:bigint,value:string>>"

    def step(state: Column, item: Column) -> Column:
        one = F.struct(state["at"].alias("start"), item["gap"].alias("value"))
        return F.struct((state["at"] + F.length(item["gap"]) + F.length(item["cut"])).alias("at"),
                        F.concat(state["out"], F.array(one)).alias("out"))
    zipped = F.arrays_zip(F.split(value, ALLOW_PART, -1).alias("gap"), F.concat(
        F.regexp_extract_all(value, F.lit(ALLOW_PART), F.lit(0)), F.array(F.lit(""))).alias("cut"))
    found = F.aggregate(zipped, F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(schema).alias("out")), step)["out"]
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), value.alias("value")))
    return F.when(value.rlike(ALLOW_WORDS), found).otherwise(whole)


def _class_spans(text: Column, c: CharClass, rank: int, allow: tuple[str, ...]) -> Column:
    def suspect(m: Column) -> Column:
        out = F.lit(True)
        for p in allow:
            out = out & ~m["value"].rlike(p)
        return out

    def of_piece(at: Column, piece: Column) -> Column:
        return F.transform(hot_stretches(piece["value"], c.window, c.bits),
                           lambda h: _span(at + piece["start"] + h["start"], at + piece["start"] + h["end"], rank, c.kind))

    def of_candidate(m: Column) -> Column:
        pieces = F.filter(_unhidden(m["value"]), lambda x: F.length(x["value"]) >= c.window)
        return F.flatten(F.transform(pieces, lambda x: of_piece(m["start"], x)))
    return F.flatten(F.transform(F.filter(matches(text, c.pattern), suspect), of_candidate))


def spans(text: Column, classes: tuple[CharClass, ...] = CLASSES, allow: tuple[str, ...] = ALLOW) -> Column:
    """All spans of a text, by start, then kind as listed, then end."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    assigned = F.filter(matches(text, ASSIGN, 2), lambda m: F.length(m["inner"]) >= LEAST_VALUE)
    found = [_as_spans(m, rank, BASE_KINDS[rank])
             for rank, m in enumerate((assigned, matches(text, ACCESS), matches(text, HEX)))]
    found += [_class_spans(text, c, rank, allow) for rank, c in enumerate(classes, len(BASE_KINDS))]
    ordered = F.transform(F.concat(*found), lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"),
                                                              s["end"].alias("end"), s["kind"].alias("kind")))
    return F.transform(F.array_sort(ordered), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                                                 s["rank"].alias("rank"), s["kind"].alias("kind"))).cast(SPAN)


def scan(docs: DataFrame, text_col: str = "text", classes: tuple[CharClass, ...] = CLASSES,
         allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """``docs`` plus ``spans``."""
    return docs.withColumn("spans", spans(F.col(text_col), classes, allow))


def joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256 and spans as text."""
    found = scan(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))).select("doc_id", "spans")

    def n(rank: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["rank"] == rank)).cast("long")
    return found.select("doc_id", *(n(i).alias(f"n_{k}") for i, k in enumerate(BASE_KINDS)),
                        F.sha2(joined(F.filter("spans", lambda s: s["rank"] < len(BASE_KINDS))).cast("binary"), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with what the spans cover (overlapping ones as one) replaced by ``mark``; texts without
    spans, null ones included, stay as they are."""
    name = "__spans"
    text = F.col(text_col)

    def step(state: Column, s: Column) -> Column:
        covered = s["start"] < state["at"]
        before = F.substring(text, (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int"))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"),
                        F.when(covered, state["out"]).otherwise(F.concat(state["out"], F.array(before, F.lit(mark)))).alias("out"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))
    clean = _let(F.aggregate(name, start, step), lambda x: F.concat(
        F.array_join(x["out"], ""), F.substring(text, (x["at"] + 1).cast("int"), F.length(text))))
    return docs.withColumn(name, spans(text)) \
        .withColumn(text_col, F.when(F.size(name) > 0, clean).otherwise(text)).drop(name)
