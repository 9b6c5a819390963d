"""License scans by sentence rules: known sentences become identifiers, identifier sequences match rules.

A text is cut into sentences (at blank lines, and after . ! ? before white space), each normalised (lower
case, every run of other characters than letters, digits, + and . one space). A single line break is white
space, and so are comment marks that begin a line; a line of these alone is blank. The full stop of "v."
ends no sentence, and a list number is none. A sentence that contains a known license sentence, word by
word, yields its identifier, placed at the sentence's part on the lines that hold it; the identifiers of a
text, in order, are matched against ordered rules: a rule is a sequence of identifiers that must follow one
another, with up to ``GAP`` sentences between them, and the first rule that matches at a place takes it.
Rules are listed most specific first.

Nulls: a null or empty text has no licenses. A null id keeps its rows. Repeated rows are scanned one by
one; extra columns are ignored; empty tables give no rows. A license named twice is reported at each place.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acqlens.llm.common import small_batches

GAP = 2   # unknown sentences allowed between two identifiers of a rule

# known sentences, normalised, by identifier
SENTENCES = {
    "mit-named": ("released under the mit license", "licensed under the mit license", "spdx license identifier mit"),
    "mit-grant": ("permission is hereby granted free of charge to any person obtaining a copy",),
    "mit-notice": ("the above copyright notice and this permission notice shall be included",),
    "apache-2-named": ("licensed under the apache license version 2.0", "spdx license identifier apache 2.0"),
    "apache-2-use": ("you may not use this file except in compliance with the license",),
    "gpl-3-named": ("licensed under the gnu general public license version 3", "spdx license identifier gpl 3.0"),
    "gpl-share": ("you can redistribute it and or modify it under the terms of the gnu general public license",),
    "gpl-3-or-later": ("either version 3 of the license or at your option any later version",),
    "bsd-grant": ("redistribution and use in source and binary forms with or without modification are permitted",),
    "bsd-endorse": ("may be used to endorse or promote products",),
    "cc-by-nc-4": ("licensed under cc by nc 4.0",),
    "cc-by-sa-4": ("licensed under cc by sa 4.0",),
    "cc-by-4": ("licensed under cc by 4.0",),
    "mpl-2-named": ("subject to the terms of the mozilla public license v. 2.0",),
    "as-is": ("is provided as is without warranty of any kind",),
    "all-rights": ("all rights reserved",),
}


@dataclass(frozen=True)
class Rule:
    license: str
    sequence: tuple[str, ...]


RULES = (
    Rule("MIT", ("mit-grant", "mit-notice", "as-is")), Rule("MIT", ("mit-grant", "mit-notice")), Rule("MIT", ("mit-grant",)),
    Rule("MIT", ("mit-named",)),
    Rule("Apache-2.0", ("apache-2-named", "apache-2-use")), Rule("Apache-2.0", ("apache-2-named",)),
    Rule("GPL-3.0-or-later", ("gpl-share", "gpl-3-or-later")), Rule("GPL-3.0-only", ("gpl-3-named",)),
    Rule("BSD-3-Clause", ("bsd-grant", "bsd-endorse")), Rule("BSD-2-Clause", ("bsd-grant",)),
    Rule("CC-BY-NC-4.0", ("cc-by-nc-4",)), Rule("CC-BY-SA-4.0", ("cc-by-sa-4",)), Rule("CC-BY-4.0", ("cc-by-4",)),
    Rule("MPL-2.0", ("mpl-2-named",)), Rule("Proprietary", ("all-rights",)),
)
_ENDS = re.compile(r"(?<![.!?])(?<!\b[vV])[.!?]++(?=\s)|\n(?:[^\S\n]*\n)+|\Z")
_MARKS = re.compile(r"""^[^\S\n]*(?:[^\w\s.?]+(?:rem\b)?|\.\\"|(?:dnl|rem|c)(?=\s))""", re.I | re.M)
_NUMBER = re.compile(r"[a-z]|[ivxl]+|\d+(?:\.\d+)*")
_OTHER = re.compile(r"[^a-z0-9.+]+")


def normalised(sentence: str) -> str:
    return _OTHER.sub(" ", sentence.lower()).strip(" .")


def unmarked(text: str) -> str:
    """``text`` with blanks for the comment marks of its lines and \\n for every line end, in the same places."""
    return _MARKS.sub(lambda m: " " * len(m[0]), text.replace("\r\n", " \n").replace("\r", "\n"))


def places(sentence: str) -> list[int]:
    """The place in ``sentence`` of each character of ``normalised(sentence)``."""
    chars, at = [], []
    for i, c in enumerate(sentence):
        for x in c.lower():
            x = " " if _OTHER.match(x) else x
            if x != " " or chars[-1:] != [" "]:
                chars.append(x)
                at.append(i)
    plain = "".join(chars)
    return at[len(plain) - len(plain.lstrip(" .")):]


class Recogniser:
    def __init__(self, sentences: dict[str, tuple[str, ...]] = SENTENCES, rules: tuple[Rule, ...] = RULES, gap: int = GAP):
        self.rules, self.gap = rules, gap
        known = [(normalised(s), k) for k, many in sentences.items() for s in many]
        self.by_sentence = dict(known)
        longest = sorted(self.by_sentence, key=lambda s: (-len(s), s))
        # a few first words tell quickly that most texts hold no known sentence at all
        self.any = re.compile("|".join(rf"(?<![a-z0-9]){re.escape(s)}(?![a-z0-9])" for s in longest)) if longest else None

    def identifiers(self, text: str | None) -> list[tuple[int, int, int, str]]:
        """(sentence number, start, end, identifier) of the sentences that are known."""
        if not text or self.any is None:
            return []
        bare = unmarked(text)
        if not self.any.search(normalised(bare)):
            return []
        out, number, begin = [], 0, 0
        for m in _ENDS.finditer(bare):
            sentence, at, begin = bare[begin:m.end()], begin, m.end()
            plain = normalised(sentence)
            if not plain or _NUMBER.fullmatch(plain):
                continue
            found = list(self.any.finditer(plain))
            where = places(sentence) if found else []
            for x in found:
                # the lines of the known sentence, as far as they belong to this sentence
                start = max(at, bare.rfind("\n", 0, at + where[x.start()]) + 1)
                line_end = bare.find("\n", at + where[x.end() - 1])
                end = min(begin, line_end if line_end >= 0 else len(bare))
                held = text[start:end]
                out.append((number, start + len(held) - len(held.lstrip()), start + len(held.rstrip()), self.by_sentence[x[0]]))
            number += 1
        return out

    def find(self, text: str | None) -> list[tuple[str, int, int, str]]:
        """(license, start, end, identifiers) of the rules that match, left to right."""
        ids, at, out = self.identifiers(text), 0, []
        while at < len(ids):
            for rule in self.rules:
                part = ids[at:at + len(rule.sequence)]
                if tuple(p[3] for p in part) == rule.sequence and all(b[0] - a[0] <= self.gap + 1 for a, b in zip(part, part[1:])):
                    out.append((rule.license, part[0][1], part[-1][2], ",".join(rule.sequence)))
                    at += len(rule.sequence)
                    break
            else:
                at += 1
        return out


def scan(docs: DataFrame, sentences: dict[str, tuple[str, ...]] = SENTENCES, rules: tuple[Rule, ...] = RULES,
         gap: int = GAP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, license, start, end, identifiers): a row per license found; places are code points."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recogniser = Recogniser(sentences, rules, gap)
        for b in small_batches(batches):
            found = [(i, *f) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for f in recogniser.find(t)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*found) if found else ([],) * 5, (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()))],
                ["doc_id", "license", "start", "end", "identifiers"])
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
               .mapInArrow(run, "doc_id long, license string, start long, end long, identifiers string")
