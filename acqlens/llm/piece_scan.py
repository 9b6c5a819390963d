"""SentencePiece encoding and decoding, giant documents by a max-plus parallel scan.

A model file gives pieces and ids; a text's segmentation is the one of the greatest total score (a unigram
decoding; see ``Pieces`` for scores); of equal scores that whose last piece begins first, as long as rounding
leaves them equal (a chunked document adds its scores in another order). A document longer than ``CHUNK``
characters is cut into chunks that go to different tasks. A chunk's state at its border is how many
characters the piece across it reaches into the chunk; the chunk yields the matrix of best scores from
each state at its beginning to each at its end. If no piece crosses the border of words (true of models that
split at spaces), a path is free at every such border, so the matrix is the cost up to the first border, of the
words between, and from the last. Matrices multiply in max-plus algebra, associatively:
``BLOCK`` that follow one another make a product in a Spark grouping, as many of these products the next,
until a document has one block left. The states at the borders of that block's parts are the states at the
ends of the blocks below, whose inner borders are then found block by block, and each chunk is traced back
on its own between its two known states. A task holds the matrices of a block (2 KB each). Decoding
gives the bytes of each chunk's ids in the tasks; those of a giant document are joined in the order of its
chunks before they are read as text, so a task holds the text of one document, as the input does.

A space is written as U+2581 and one is put before the text, as the library does; a U+2581 in a text is
spelled in bytes, so decoding gives every text back. Nulls: a null or empty text has no ids. A null id
keeps its row; rows that repeat are encoded each. Extra columns are ignored; empty tables give no rows.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acqlens.llm.common import small_batches, written

CHUNK = 32_768
BLOCK = 64         # matrices that are multiplied, and whose borders are found, in one group
CACHE = 480_000    # words remembered (half of them since the other half was full: frequent ones stay),
REMEMBERED = 48    # of at most so many characters; none of the two changes a result
_BASE = np.uint64(0x9E3779B97F4A7C15)
_TOP = np.uint64(46)   # the first 18 bits of a hash tell whether it may be that of a piece
_MARK = "▁"
_BORDER = re.compile(f"(?<=[^{_MARK}]){_MARK}")
_WORD = re.compile(f"{_MARK}+[^{_MARK}]*|[^{_MARK}]+")
_KEPT = "﷐"     # a noncharacter standing for a U+2581 of the text, so that it is spelled in bytes


def _text_hash(text: str) -> int:
    h = 0
    for c in text:
        h = (h * int(_BASE) + ord(c)) & 0xFFFFFFFFFFFFFFFF
    return h


class Pieces:
    """Pieces of a model. The score of a piece is minus the log of its place in the model, pieces of a
    merge list being stored by frequency; a character that no piece holds costs its bytes."""

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.text = [model.id_to_piece(i) for i in range(n)]
        byte = [i for i in range(n) if model.is_byte(i)]
        self.bytes = {int(self.text[i][3:5], 16): i for i in byte}
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.raw_of = [bytes([self.byte_of[i]]) if i in self.byte_of else t.replace(_MARK, " ").encode() for i, t in enumerate(self.text)]
        self.score = {self.text[i]: (-float(np.log(k + 2)) - 4.0, i) for k, i in enumerate(plain)}
        # the hashes of the pieces of each length in order, with their scores and ids
        self.hashed = {}
        for k in range(1, max(map(len, self.score), default=1) + 1):
            found = sorted((_text_hash(p), x, i) for p, (x, i) in self.score.items() if len(p) == k) or [(0, -np.inf, 0)]
            keys = np.array([f for f, _, _ in found], np.uint64)
            maybe = np.zeros(1 << (64 - int(_TOP)), bool)
            maybe[keys >> _TOP] = True
            self.hashed[k] = keys, np.array([x for _, x, _ in found]), np.array([i for _, _, i in found], np.int32), maybe
        # every beginning of a piece, with the score of the piece that it is (none: minus infinity)
        self.beginnings = {p[:k]: -float(np.inf) for p in self.score for k in range(1, len(p))}
        self.beginnings.update((p, x) for p, (x, _) in self.score.items())
        self.byte_cost = -2 * float(np.log(n + 2))
        self.longest = max(map(len, self.score), default=1)
        # if no piece goes from another character on to a mark, words are decoded one by one
        self.by_words = not any(re.search(f"[^{_MARK}]{_MARK}", p) for p in self.score)
        self.cost = np.zeros(n)                        # of each id
        self.cost[byte] = self.byte_cost
        self.cost[plain] = [self.score[self.text[i]][0] for i in plain]
        self.raws = pa.array(self.raw_of, pa.binary())
        # the id of a character of one byte that is no piece; of others (-1) there are several
        self.single = np.full(129, -1, np.int32)
        for b in range(128):
            self.single[b] = self.bytes.get(b, -1)
        # ids (little-endian uint32) of words without the mark before them, "a space and the word" if it has none
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def at(self, s: str, i: int) -> list[tuple[int, float]]:
        """(end, score) of the pieces of s that begin at i; the bytes of the character if it is no piece."""
        out = [(j, self.score[s[i:j]][0]) for j in range(i + 1, min(len(s), i + self.longest) + 1) if s[i:j] in self.score]
        if not out or out[0][0] != i + 1:
            out.append((i + 1, self.byte_cost * len(self._raw(s[i]))))
        return out

    @staticmethod
    def _raw(c: str) -> bytes:
        return (_MARK if c == _KEPT else c).encode("utf-8", "surrogatepass")

    def ids(self, s: str) -> list[int]:
        found = self.score.get(s)
        return [found[1]] if found else [self.bytes[b] for b in self._raw(s)]

    def trace(self, s: str, begin: int, end: int) -> list[int]:
        """Ids of the best segmentation of s[begin:end]."""
        return self._best(s, begin, end)[0]

    def _best(self, s: str, begin: int, end: int) -> tuple[list[int], float]:
        """Ids and score of the best segmentation of s[begin:end], character by character: from each place along
        the beginnings of pieces as far as any piece goes."""
        get, none = self.beginnings.get, -np.inf
        best, came = [none] * (end + 1), [0] * (end + 1)
        best[begin] = 0.0
        for i in range(begin, end):
            here = best[i]
            j = i + 1
            x = get(s[i])
            if x is None or x == none:                # no piece: its bytes
                cost = here + self.byte_cost * len(self._raw(s[i]))
                if cost > best[j]:
                    best[j], came[j] = cost, i
            while x is not None:
                if here + x > best[j]:
                    best[j], came[j] = here + x, i
                j += 1
                if j > end:
                    break
                x = get(s[i:j])
        cuts = [end]
        while cuts[-1] > begin:
            cuts.append(came[cuts[-1]])
        cuts.reverse()
        return [t for a, b in zip(cuts, cuts[1:]) for t in self.ids(s[a:b])], best[end]

    def word_borders(self, s: str, least: int, most: int) -> tuple[int, int] | None:
        """The first and the last place from ``least`` to ``most`` that no piece goes across: a mark after another
        character. None if there is none, or if the model's pieces may cross such a place."""
        if not self.by_words:
            return None
        first = _BORDER.search(s, max(least, 1))
        if not first or first.start() > most:
            return None
        last = s.rfind(_MARK, 0, most + 1)
        while s[last - 1] == _MARK:
            last = s.rfind(_MARK, 0, last)
        return first.start(), last

    @staticmethod
    def _parts(s: str) -> list[str]:
        """The words of a text as they are remembered."""
        if s[:1] == _MARK != s[-1] and _MARK * 2 not in s:
            return s[1:].split(_MARK)
        return [w[1:] if w[0] == _MARK else " " + w for w in _WORD.findall(s)]

    @staticmethod
    def _spelled(part: str) -> str:
        return part[1:] if part[:1] == " " else _MARK + part

    def words(self, s: str) -> bytes:
        """Ids (little-endian uint32) of a text that begins and ends at word borders, by remembered words."""
        parts = self._parts(s)
        self.learn([parts])
        return b"".join(map(self._known, parts))

    def total(self, ids: bytes) -> float:
        """The score of a text segmented into these ids."""
        return float(self.cost[np.frombuffer(ids, "<u4")].sum())

    def _known(self, part: str) -> bytes:
        got = self.known.get(part)
        if got is None:
            w = self._spelled(part)
            got = np.array(self.trace(w, 0, len(w)), "<u4").tobytes()
        return got

    def learn(self, texts: list[list[str]]) -> None:
        """Remember all words of at most ``REMEMBERED`` characters, those that are new segmented together."""
        if len(self.known) > CACHE // 2:
            self.before, self.known = self.known, {}
        by_length: dict[int, list[str]] = {}
        known, before = self.known, self.before
        for part in set().union(*texts).difference(known):
            found = before.get(part)
            if found is None:
                w = part[1:] if part[:1] == " " else _MARK + part
                by_length.setdefault(len(w), []).append(w)
            else:
                known[part] = found
        for size, words in by_length.items():
            if size <= REMEMBERED:
                for at in range(0, len(words), 1 << 14):
                    self._segment(words[at:at + (1 << 14)], size)

    def _remember(self, w: str, ids: bytes) -> None:
        self.known[w[1:] if w[0] == _MARK else " " + w] = ids

    def _segment(self, words: list[str], size: int) -> None:
        """The best segmentations of words of one length, place by place for all of them at once: the same sums
        and choices as ``_best`` makes for each."""
        plain = [w for w in words if "\0" not in w]     # numpy drops these at the end of a text
        for w in set(words).difference(plain):
            self._remember(w, np.array(self.trace(w, 0, size), "<u4").tobytes())
        if not plain:
            return
        points = np.array(plain, f"U{size}").view(np.uint32).reshape(len(plain), size).astype(np.uint64)
        most = min(self.longest, size)
        scores, pieces, h = [], [], np.zeros((len(plain), size + 1), np.uint64)
        for k in range(1, most + 1):
            h = h[:, :size - k + 1] * _BASE + points[:, k - 1:]
            keys, values, ids, maybe = self.hashed[k]
            rows = np.flatnonzero(maybe[h >> _TOP])
            wanted = h.ravel()[rows]
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            hit = keys[at] == wanted
            found = np.full(h.shape, -np.inf)
            found.ravel()[rows[hit]] = values[at[hit]]
            scores.append(found)
            piece = np.zeros(h.shape, np.int32) if k > 1 else self.single[np.minimum(points, 128).astype(np.int64)]
            piece.ravel()[rows[hit]] = ids[at[hit]]
            pieces.append(piece)
        width = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        scores[0] = np.where(np.isneginf(scores[0]), self.byte_cost * width, scores[0])
        scores, pieces = ([np.ascontiguousarray(x.T) for x in xs] for xs in (scores, pieces))
        there = [(~np.isneginf(x)).sum(axis=1) for x in scores]
        best = np.full((size + 1, len(plain)), -np.inf)
        came, last = np.zeros((size + 1, len(plain)), np.int64), np.zeros((size + 1, len(plain)), np.int32)
        best[0] = 0.0
        for j in range(1, size + 1):
            for k in range(min(most, j), 0, -1):
                of_words = scores[k - 1][j - k]
                if there[k - 1][j - k] * 8 > len(plain):
                    x = best[j - k] + of_words
                    better = x > best[j]
                    np.copyto(best[j], x, where=better)
                    np.copyto(came[j], j - k, where=better)
                    np.copyto(last[j], pieces[k - 1][j - k], where=better)
                elif there[k - 1][j - k]:              # few words have a piece here
                    few = np.flatnonzero(of_words > -np.inf)
                    x = best[j - k][few] + of_words[few]
                    better = x > best[j][few]
                    few = few[better]
                    best[j][few], came[j][few], last[j][few] = x[better], j - k, pieces[k - 1][j - k][few]
        # back along the best paths of all words at once: the ends of their pieces
        used, at, live = np.zeros((len(plain), size + 1), bool), np.full(len(plain), size), np.arange(len(plain))
        while len(live):
            ends = at[live]
            used[live, ends] = True
            at[live] = came[ends, live]
            live = live[at[live] > 0]
        ids = last.T[used]
        stops = np.cumsum(used.sum(axis=1))
        several = np.zeros(len(plain), bool)               # words with a character of several bytes that is no piece
        several[np.searchsorted(stops, np.flatnonzero(ids < 0), side="right")] = True
        raw, begin = ids.astype("<u4").tobytes(), 0
        for w, end, spell in zip(plain, (4 * stops).tolist(), several.tolist()):
            self._remember(w, np.array(self.trace(w, 0, size), "<u4").tobytes() if spell else raw[begin:end])
            begin = end

    def matrix(self, s: str, body: int) -> np.ndarray:
        return self.transfer(s, body)[0]

    def transfer(self, s: str, body: int) -> tuple[np.ndarray, tuple[int, int] | None, bytes]:
        """Best scores from each state at the beginning of s[:body] to each at its end; what follows the
        body in s is what pieces may reach into. Where the chunk holds word borders, every path passes the first
        and the last: what comes before depends on the state at the beginning alone, what comes after on that at
        the end, and the words between cost what they cost. Then these two borders and the ids between them."""
        borders = self.word_borders(s, self.longest, body)
        if borders is None:
            return self.full_matrix(s, body), None, b""
        first, last = borders
        head = np.full(first + 1, -np.inf)
        head[first] = 0.0
        before = s[:first]
        for i in range(first - 1, -1, -1):
            head[i] = max(x + head[j] for j, x in self.at(before, i))
        tail = np.full(body + self.longest + 1 - last, -np.inf)
        tail[0] = 0.0
        for i in range(last, body):
            for j, x in self.at(s, i):
                tail[j - last] = max(tail[j - last], tail[i - last] + x)
        end = tail[body - last:body - last + self.longest]
        ids = self.words(s[first:last])
        return head[:self.longest, None] + self.total(ids) + end[None, :], borders, ids

    def full_matrix(self, s: str, body: int) -> np.ndarray:
        """The same, character by character for all states at once."""
        best = np.full((body + self.longest + 1, self.longest), -np.inf)
        for i in range(min(self.longest, body + self.longest)):
            best[i, i] = 0.0
        for i in range(body):
            for j, x in self.at(s, i):
                np.maximum(best[j], best[i] + x, out=best[j])
        return best[body:body + self.longest].T.copy()

    def between(self, s: str, begin: int, end: int) -> list[int]:
        """Ids of the best segmentation of s[begin:end], words remembered between the first and last border."""
        borders = self.word_borders(s, begin, end)
        if borders is None:
            return self.trace(s, begin, end)
        first, last = borders
        return [*self.trace(s, begin, first), *np.frombuffer(self.words(s[first:last]), "<u4").tolist(), *self.trace(s, last, end)]

    def encode(self, s: str) -> list[int]:
        """Ids of a whole text that is already written with marks."""
        return np.frombuffer(self.encode_all([s])[0], "<u4").tolist()

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts as little-endian uint32, the words of all of them learnt together."""
        if not self.by_words:
            return [np.array(self.trace(s, 0, len(s)), "<u4").tobytes() for s in texts]
        parts = list(map(self._parts, texts))
        self.learn(parts)
        out = []
        for words in parts:
            found = list(map(self.known.get, words))
            if None in found:                          # longer than what is remembered
                found = list(map(self._known, words))
            out.append(b"".join(found))
        return out

    def raw(self, ids: list[int]) -> bytes:
        """The bytes of ids, the space before the text among them."""
        return b"".join(map(self.raw_of.__getitem__, ids))

    def raw_all(self, rows: list[bytes]) -> list[bytes]:
        """The bytes of the ids (little-endian uint32) of each row."""
        found = self.raws.take(pa.array(np.frombuffer(b"".join(rows), "<u4")))
        stops = np.cumsum([0, *(len(x) // 4 for x in rows)])
        ends = np.frombuffer(found.buffers()[1], np.int32)[stops].tolist()
        data = memoryview(found.buffers()[2] or b"")
        return [data[i:j].tobytes() for i, j in zip(ends, ends[1:])]

    def decode(self, ids: list[int]) -> str:
        return self.raw(ids).decode("utf-8", "surrogatepass")[1:]


def marked(text: str | None) -> str:
    return _MARK + text.replace(_MARK, _KEPT).replace(" ", _MARK) if text else ""


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def border_states(matrices: list[np.ndarray], first: int = 0, last: int = 0) -> list[int]:
    """The state at each border of a block: prefix products from state ``first``, then choices from the
    end, state ``last``."""
    rows = [np.where(np.arange(len(matrices[0])) == first, 0.0, -np.inf)]
    for m in matrices:
        rows.append((rows[-1][:, None] + m).max(axis=0))
    states = [last]
    for row, m in zip(rows[-2::-1], matrices[::-1]):
        states.append(int((row + m[:, states[-1]]).argmax()))
    return states[::-1]


def scan(matrices: DataFrame, most: int, block: int = BLOCK) -> DataFrame:
    """(row, chunk, enter, leave): the states at the two borders of each chunk, from its matrix (row, chunk,
    m), ``most`` chunks a row at most; a row begins and ends in state 0. No group has more than ``block``
    matrices."""
    def held(rows: pd.DataFrame) -> list[np.ndarray]:
        return [m.reshape(int(len(m) ** 0.5), -1) for m in map(np.frombuffer, rows["m"])]

    def total(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("chunk")
        m = reduce(product, held(rows))
        return pd.DataFrame({"row": rows["row"].iloc[:1], "chunk": rows["block"].iloc[:1], "m": [m.tobytes()]})

    def inner(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("chunk")
        states = border_states(held(rows), int(rows["first"].iloc[0]), int(rows["last"].iloc[0]))
        return pd.DataFrame({"row": rows["row"], "chunk": rows["chunk"], "enter": states[:-1], "leave": states[1:]})

    of_block = F.floor(F.col("chunk") / block).cast("int")
    levels = [matrices.withColumn("block", of_block)]
    while most > block:
        most = -(-most // block)
        levels.append(written(levels[-1].groupBy("row", "block").applyInPandas(total, "row string, chunk int, m binary"), "piece-products")
                      .withColumn("block", of_block))
    ends = levels.pop().withColumn("first", F.lit(0).cast("long")).withColumn("last", F.lit(0).cast("long"))
    while True:
        states = ends.groupBy("row", "block").applyInPandas(inner, "row string, chunk int, enter long, leave long")
        if not levels:
            return states
        ends = levels.pop().join(states.select("row", F.col("chunk").alias("block"), F.col("enter").alias("first"),
                                               F.col("leave").alias("last")), ["row", "block"])


_MODELS: dict[str, Pieces] = {}


def _model(path: str) -> Pieces:
    if path not in _MODELS:
        _MODELS[path] = Pieces(path)
    return _MODELS[path]


def encode(docs: DataFrame, path: str, chunk: int = CHUNK, block: int = BLOCK,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, chunk, chunks, ids): ids as little-endian uint32; ``row`` tells apart rows that repeat an
    id, and the ``chunks`` chunks of a row in order are its encoding."""
    short, giant = _encoded(docs, path, chunk, block, id_col, text_col)
    return short.union(giant)


def _encoded(docs: DataFrame, path: str, chunk: int, block: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The encodings of documents of one chunk, and of the others."""
    fields = "doc_id long, row string, chunk int, chunks int, text string"
    result = "doc_id long, row string, chunk int, chunks int, ids binary"
    # of a chunk: its text up to the first border, from the last on (all of it, if it holds none), how much of this is
    # the chunk's own, the ids between, and its matrix
    seen = "doc_id long, row string, chunk int, chunks int, head string, tail string, body int, ids binary, m binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longest = _model(path).longest
        for b in small_batches(batches, 2 << 20):
            out = []
            for doc, row, text in zip(*(c.to_pylist() for c in b.columns)):
                s = marked(text)
                n = -(-len(s) // chunk)
                out += [(doc, row, k, n, s[k * chunk:(k + 1) * chunk + longest]) for k in range(n)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*out) if out else ([],) * 5, (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.string()))],
                ["doc_id", "row", "chunk", "chunks", "text"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, 2 << 20):
            ids = _model(path).encode_all([marked(t) for t in b.column(2).to_pylist()])
            n = len(ids)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([0] * n, pa.int32()), pa.array([1] * n, pa.int32()),
                                              pa.array(ids, pa.binary())], ["doc_id", "row", "chunk", "chunks", "ids"])

    def transfer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                s = b.column(4)[k].as_py()
                body = min(chunk, len(s))
                m, borders, ids = _model(path).transfer(s, body)
                first, last = borders or (0, 0)
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(k, 1) for c in b.columns[:4]), pa.array([s[:first + 1] if borders else None], pa.string()),
                     pa.array([s[last:]], pa.string()), pa.array([body - last], pa.int32()), pa.array([ids], pa.binary()),
                     pa.array([m.tobytes()], pa.binary())], [f.split()[0] for f in seen.split(", ")])

    def traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            model, out = _model(path), []
            for head, tail, body, ids, i, j in zip(*(b.column(c).to_pylist() for c in (4, 5, 6, 7, 8, 9))):
                if head is not None:                       # up to the first border, whose mark it ends with
                    before, i = np.array(model.between(head, i, len(head) - 1), "<u4").tobytes(), 0
                    ids = before + ids
                out.append(ids + np.array(model.between(tail, i, body + j), "<u4").tobytes())
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(out, pa.binary())], ["doc_id", "row", "chunk", "chunks", "ids"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().cast("string").alias("row"),
                         F.col(text_col).cast("string").alias("text"))
    is_giant = F.coalesce(F.length("text") + 1 > chunk, F.lit(False))    # written with the mark before it
    short = source.filter(~is_giant).mapInArrow(whole, result)
    # the chunks of giant documents are written, and dealt out evenly by number, as their cost is time and not size;
    # the row number of a file's row is the same if a task runs again
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    giant = written(source.filter(is_giant).mapInArrow(cut, fields).repartition(tasks, "row", "chunk"), "piece-chunks")
    chunks = written(giant.mapInArrow(transfer, seen), "piece-matrices")
    most = chunks.agg(F.coalesce(F.max("chunks"), F.lit(0))).first()[0]
    known = chunks.join(scan(chunks.select("row", "chunk", "m"), most, block), ["row", "chunk"]) \
        .select("doc_id", "row", "chunk", "chunks", "head", "tail", "body", "ids", "enter", "leave")
    return short, known.mapInArrow(traced, result)


def _raw(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, row, chunk, n_tokens, ids_crc32, raw): the bytes of each chunk, without the space put before
    the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in small_batches([whole], 2 << 20):
                raw = [x[k == 0:] for k, x in zip(b.column(2).to_pylist(), _model(path).raw_all(b.column(5).to_pylist()))]
                yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(raw, pa.binary())],
                                                 ["doc_id", "row", "chunk", "n_tokens", "ids_crc32", "raw"])
    return encoded.select("doc_id", "row", "chunk", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"), "ids") \
                  .mapInArrow(run, "doc_id long, row string, chunk int, n_tokens long, ids_crc32 long, raw binary")


def _texts(short: DataFrame, giant: DataFrame, path: str) -> DataFrame:
    """(doc_id, row, n_tokens, ids_crc32, text) of the encodings of one chunk and of those of several."""
    parts = F.transform(F.sort_array(F.collect_list(F.struct("chunk", "raw"))), lambda x: x["raw"].cast("string"))
    joined = _raw(giant, path).groupBy("doc_id", "row").agg(F.sum("n_tokens").alias("n_tokens"), F.sum("ids_crc32").alias("ids_crc32"),
                                                            F.array_join(parts, "").alias("text"))
    return _raw(short, path).select("doc_id", "row", "n_tokens", "ids_crc32", F.col("raw").cast("string").alias("text")).union(joined)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, row, text): the texts of what ``encode`` gave; a null text is an empty one."""
    return _texts(encoded.filter("chunks = 1"), encoded.filter("chunks > 1"), path).select("doc_id", "row", "text")


def round_trip(docs: DataFrame, path: str, chunk: int = CHUNK, block: int = BLOCK,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, the sum of the crc32 of the chunks' ids, and the crc32 of the text decoded from
    them, a row per document row."""
    return _texts(*_encoded(docs, path, chunk, block, id_col, text_col), path) \
        .select("doc_id", "n_tokens", "ids_crc32", F.crc32(F.col("text").cast("binary")).alias("decoded_crc32"))
