"""Best-fit packing of token sequences into fixed-length training sequences.

``token_pieces`` tokenizes whole documents and cuts only those longer than a sequence. ``pack`` deals
pieces out to shards by a hash and fills each shard's sequences online: a bounded number of open bins,
kept in a bitset keyed by free space, so the tightest bin with room is one bit operation away. When all
open places are taken, the fullest bin closes. A shard is streamed longest piece first, holding only its
open bins in memory.

Nulls: a null or empty text is one piece holding only the end token. Rows repeating a doc_id each give
their pieces; a null doc_id is kept. Empty tables give no rows.
"""
from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acqlens.llm.common import small_batches

SEQUENCE = 1024        # tokens in a sequence
END_ID = 2             # closes each document
OPEN_BINS = 4096       # bins open at once in a shard
SHARD_PIECES = 8192    # pieces dealt to a shard, on average
CACHE = 800_000        # units a worker remembers
MARKS = ".,;:!?%&$#*|<>()\"-"   # those that end a word are split from it
LETTERS = "\u0250"     # Latin ones come before
_WIDE = re.compile(r"\s\s")

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids binary"


class UnitEncoder:
    """Token ids as little-endian uint32 bytes. A byte-level BPE whose splitter never looks across a
    single space between two non-space characters gives a text's ids as those of the units between such
    spaces, so units (mostly words) are encoded once and remembered. Unknown units are encoded many at a
    time; the tokens' byte lengths tell where each unit ends."""

    def __init__(self, path: str, cache: int = CACHE):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        special = {i: len(t.content.encode()) for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.width = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.width[i] = special.get(i, len(token))     # a character of a token stands for one byte
        # by unit without its leading space: half of the places take what is used, then that half is kept while the
        # other takes what is used again or new, so frequent units are not encoded anew
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.cache = cache
        # words of Latin letters are one piece for the splitter: they go to the model in its own alphabet
        model, four = self.tokenizer.model, [i.to_bytes(4, "little") for i in range(len(self.width))]
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]  # the alphabet shows these bytes from U+0100 on
        alphabet = {b: 0x100 + k for k, b in enumerate(hidden)}

        def word(u: str, before: str = "\u0120") -> bytes:
            inside = u if u.isascii() else u.encode().decode("latin-1").translate(alphabet)
            return b"".join([four[t.id] for t in model.tokenize(before + inside)])
        self.word = word
        self.tail: dict[str, bytes] = {"": b""}            # marks after a word, and the line's end after them

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _tail(self, marks: str) -> bytes:
        ids = self.tail.get(marks)
        if ids is None:
            ids = self._ids([marks])[0].tobytes()
            if len(self.tail) < 4096:
                self.tail[marks] = ids
        return ids

    def _learn(self, units: list[str]) -> None:
        """Remember each unit's ids after a space. Marks that end a word are split from it, and so is the word that
        begins the next line, so that known words are not encoded anew."""
        known, before, tail, word = self.known, self.before, self.tail, self.word
        marked, stems = [], []
        for u in units:
            if u.isalpha() and (u.isascii() or max(u) < LETTERS):
                if u not in known:
                    known[u] = word(u)
                continue
            x, after, y = u.partition("\n")                # y: the next line's word
            end = x
            x = x.rstrip(MARKS)
            z = y.rstrip(MARKS)
            if not x.isalpha() or not (z.isalpha() and (z.isascii() or max(z) < LETTERS) if after else u[-1] in MARKS):
                stems.append(u)
                continue
            ids = known.get(x)
            if ids is None:
                ids = before.get(x)
                if ids is None and (x.isascii() or max(x) < LETTERS):
                    ids = word(x)
                if ids is not None:
                    known[x] = ids
            end = end[len(x):] + after
            last = tail.get(end)
            if last is None:
                last = self._tail(end)
            if after:
                last += word(z, "") + self._tail(y[len(z):])
            if ids is None:
                marked.append((u, x, last))
            else:
                known[u] = ids + last
        stems = list({*stems, *(x for _, x, _ in marked)}.difference(known))
        groups = [stems[i:i + 256] for i in range(0, len(stems), 256)]
        for group, ids in zip(groups, self._ids(["".join(" " + u for u in g) for g in groups])):
            ends = np.cumsum(np.fromiter((len(u.encode()) + 1 for u in group), np.int64, len(group)))
            cuts = np.searchsorted(np.cumsum(self.width[ids]), ends) + 1
            raw = ids.tobytes()
            for u, i, j in zip(group, [0, *cuts[:-1].tolist()], cuts.tolist()):
                known[u] = raw[4 * i:4 * j]
        for u, x, last in marked:
            known[u] = known[x] + last

    def encode_all(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > self.cache // 2:
            self.before, self.known = self.known, {}
        docs = [t.split(" ") for t in texts]
        heads = [parts.pop(0) for parts in docs]           # no space before them: encoded on their own
        missing = set().union(*docs).difference(self.known)
        # white space beside a space: such texts are cut again
        wide = {u for u in missing if not u or len(u.strip()) < len(u)} if _WIDE.search(f" {' '.join(missing)} ") else set()
        missing -= wide
        ends = set()                                       # last units of such texts that end in white space
        for k, (head, parts) in enumerate(zip(heads, docs)):
            if parts and (not head or head[-1].isspace()) or wide and not wide.isdisjoint(parts):
                heads[k], *docs[k] = self._joined([head, *parts])
                missing.update(u for u in docs[k] if u not in self.known)
                ends.update(u for u in docs[k][-1:] if u[-1].isspace())
        fresh = {u: self.before[u] for u in missing & self.before.keys()}
        self.known.update(fresh)
        missing.difference_update(fresh)
        rest = [u for u in missing if len(u) > 64 or u in ends]        # long or wide ones are not remembered
        missing.difference_update(rest)
        self._learn(list(missing))
        self.known.update(zip(rest, (x.tobytes() for x in self._ids([" " + u for u in rest]))))
        ids = self.known.__getitem__
        out = [head.tobytes() + b"".join(map(ids, parts)) for head, parts in zip(self._ids(heads), docs)]
        for u in rest:
            del self.known[u]
        return out

    @staticmethod
    def _joined(parts: list[str]) -> list[str]:
        """Units again, where runs of white space stay inside one."""
        units, at = [], [parts[0]]
        for before, p in zip(parts, parts[1:]):
            if p and before and not p[0].isspace() and not before[-1].isspace():
                units.append(" ".join(at))
                at = [p]
            else:
                at.append(p)
        return [*units, " ".join(at)]


_ENCODERS: dict[str, UnitEncoder] = {}                     # one a worker process, kept from task to task


def _encoder(path: str) -> UnitEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = UnitEncoder(path)
    return _ENCODERS[path]


def token_pieces(docs: DataFrame, tokenizer_path: str, sequence: int = SEQUENCE, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids): ids are little-endian uint32; the first piece of a long
    document takes the remainder, the others are full."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        for b in small_batches(batches, 2 << 20):
            out: list[list] = [[], [], [], [], []]
            texts = [t or "" for t in b.column(1).to_pylist()]
            for doc, ids in zip(b.column(0).to_pylist(), encoder.encode_all(texts)):
                ids += end
                n = len(ids) // 4
                cuts = [0, *range(n % sequence or sequence, n + 1, sequence)] if n > sequence else [0, n]
                for k, (s, e) in enumerate(zip(cuts, cuts[1:])):
                    for col, v in zip(out, (doc, k, s, e - s, ids[4 * s:4 * e])):
                        col.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))],
                ["doc_id", "piece", "start", "length", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
               .mapInArrow(run, PIECE_SCHEMA)


class OpenBins:
    """At most ``most`` open bins. Bit f of ``free`` is set if some open bin has f places left."""

    def __init__(self, sequence: int, most: int):
        self.sequence, self.most = sequence, most
        self.free, self.count, self.next = 0, 0, 0
        self.at: list[list[int]] = [[] for _ in range(sequence + 1)]

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) for a piece: the open bin it fits tightest, else a new one."""
        fits = self.free >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            number = self._take(room)
        else:
            if self.count == self.most:                     # close the fullest
                self._take((self.free & -self.free).bit_length() - 1)
            number, room = self.next, self.sequence
            self.next += 1
        if room > length:
            left = room - length
            self.at[left].append(number)
            self.free |= 1 << left
            self.count += 1
        return number, self.sequence - room

    def _take(self, room: int) -> int:
        stack = self.at[room]
        number = stack.pop()
        if not stack:
            self.free ^= 1 << room
        self.count -= 1
        return number


def pack(pieces: DataFrame, n_pieces: int | None = None, sequence: int = SEQUENCE, open_bins: int = OPEN_BINS,
         shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``pieces`` (with doc_id, piece, length <= sequence, and any other columns) plus sequence_id and
    offset. ``n_pieces`` sets the number of shards; it is counted if not given."""
    n = pieces.count() if n_pieces is None else n_pieces
    shards = max(1, round(n / shard_pieces))
    sharded = pieces.drop("sequence_id", "offset") \
        .withColumn("__shard", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shards)).cast("long"))
    dealt = sharded.repartition("__shard").sortWithinPartitions("__shard", F.desc("length"), "doc_id", "piece")
    schema = sharded.drop("__shard").schema.add("sequence_id", "long").add("offset", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, bins = None, OpenBins(sequence, open_bins)
        for b in batches:
            t = pa.Table.from_batches([b])
            ids, offsets = [], []
            for s, length in zip(t.column("__shard").to_pylist(), t.column("length").to_pylist()):
                if s != shard:
                    shard, bins = s, OpenBins(sequence, open_bins)
                number, offset = bins.place(length)
                ids.append((s << 32) | number)
                offsets.append(offset)
            t = t.drop_columns("__shard").append_column("sequence_id", pa.array(ids, pa.int64())) \
                 .append_column("offset", pa.array(offsets, pa.int64()))
            yield from t.to_batches()

    return dealt.mapInArrow(run, schema)
