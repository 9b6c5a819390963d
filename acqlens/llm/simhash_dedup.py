"""SimHash near-duplicates: 64-bit fingerprints linked by BK-trees, one component id per document.

Fingerprints within ``radius`` bits agree on at least one of ``radius + 1`` bands of their bits, so
each distinct fingerprint is routed to one shard per band (band number and band value) instead of to
every shard: the trees of one shard hold all that can be near. A shard of more than ``max_tree``
fingerprints is cut into tiles (tree part x query part), so no task holds an unbounded shard. In a
tile, a BK-tree (children keyed by their integer Hamming distance to the parent) is searched for every
query, following only edges within the radius of the query's distance. Links of a tile leave it as a
spanning forest, never as all pairs; a label-propagation join then yields the components.

Nulls: a null or empty text has fingerprint zero and links like any other; rows with a null doc_id
take no part in links (they get a null component) but keep their row. Rows that repeat a doc_id are one
document: its fingerprints are linked. Extra columns are ignored; empty tables give empty results.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acqlens.llm.common import lower_words, small_batches, starts_of, written

SHINGLE = 3      # words a shingle
RADIUS = 2       # differing bits of linked fingerprints
MAX_TREE = 4096  # fingerprints in one tree; larger shards are tiled


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    w = lower_words(text)
    if not w:
        return 0
    joined = b" ".join(w)
    if len(w) <= shingle:
        return xxhash.xxh64_intdigest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1)
    begins = np.concatenate(([0], ends[:len(w) - shingle])).tolist()
    stops = (ends[shingle - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], 42) for a, b in zip(begins, stops)), np.uint64, len(begins))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 14):  # bounded memory for giant texts
        bits = np.unpackbits(h[at:at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    out = 0
    for bit in np.flatnonzero(2 * ones > len(h)):
        out |= 1 << int(bit)
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): fp is the fingerprint's 64 bits as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            fp = np.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(fp)], ["doc_id", "fp"])
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
               .mapInArrow(run, "doc_id long, fp long")


class BKForest:
    """BK-trees over many disjoint groups at once. ``group`` numbers the tree of each key. A node's
    children sit under the integer distance to it; trees grow level by level for all groups together."""

    def __init__(self, keys: np.ndarray, group: np.ndarray):
        n = len(keys)
        self.keys = keys
        self.parent_edge = np.zeros(n, np.int64)              # distance to the parent
        self.first_child = np.zeros(n + 1, np.int64)
        parent = np.full(n, -1, np.int64)
        order = np.argsort(group, kind="stable")
        first = order[starts_of(group[order])]
        self.root_of = dict(zip(group[first].tolist(), first.tolist()))
        at = np.zeros(n, np.int64)                            # the node each key has come down to
        at[order] = np.repeat(first, np.diff(np.append(starts_of(group[order]), n)))
        todo = np.setdiff1d(np.arange(n), first, assume_unique=True)
        while len(todo):
            node = at[todo]
            d = np.bitwise_count(keys[todo] ^ keys[node]).astype(np.int64)
            slot = np.lexsort((todo, d, node))
            node, d, todo = node[slot], d[slot], todo[slot]
            begin = starts_of(node, d)
            child = todo[begin]                               # the first to come takes the place
            parent[child], self.parent_edge[child] = node[begin], d[begin]
            at[todo] = np.repeat(child, np.diff(np.append(begin, len(todo))))
            todo = np.setdiff1d(todo, child, assume_unique=True)
        kids = np.flatnonzero(parent >= 0)
        kids = kids[np.lexsort((self.parent_edge[kids], parent[kids]))]
        self.kids = kids
        self.first_child = np.searchsorted(parent[kids], np.arange(n + 1))

    def search(self, queries: np.ndarray, roots: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query index, key index) of all hits; only edges within ``radius`` of the distance are followed."""
        q, node = np.arange(len(queries)), roots
        while len(q):
            d = np.bitwise_count(queries[q] ^ self.keys[node]).astype(np.int64)
            hit = d <= radius
            if hit.any():
                yield q[hit], node[hit]
            n_kids = self.first_child[node + 1] - self.first_child[node]
            rep = np.repeat(np.arange(len(q)), n_kids)
            kid_at = np.arange(len(rep)) - np.repeat(np.cumsum(n_kids) - n_kids, n_kids) + self.first_child[node][rep]
            kid = self.kids[kid_at]
            follow = np.abs(self.parent_edge[kid] - d[rep]) <= radius
            q, node = q[rep[follow]], kid[follow]


def spanning_links(group: np.ndarray, fp: np.ndarray, as_tree: np.ndarray, as_query: np.ndarray,
                   radius: int, block: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Per group, links (fp, smallest fp of its part of the group) that connect what lies within radius.
    Rows are sorted by group; each row is in the tree, a query, or both."""
    n = len(fp)
    label = np.arange(n)
    tree_rows = np.flatnonzero(as_tree)
    if not len(tree_rows):
        return fp[:0], fp[:0]
    keys = fp.view(np.uint64)
    forest = BKForest(keys[tree_rows], group[tree_rows])
    root = np.full(int(group.max()) + 1, -1, np.int64)
    root[list(forest.root_of)] = list(forest.root_of.values())
    query_rows = np.flatnonzero(as_query & (root[group] >= 0))

    def find(x: np.ndarray) -> np.ndarray:
        while True:
            y = label[x]
            if (y == x).all():
                return x
            label[x] = label[y]
            x = label[x]

    for at in range(0, len(query_rows), block):
        rows = query_rows[at:at + block]
        for q, k in forest.search(keys[rows], root[group[rows]], radius):
            a, b = rows[q], tree_rows[k]
            while True:                                       # union by smaller row, all links at once
                ra, rb = find(a), find(b)
                lo, hi = np.minimum(ra, rb), np.maximum(ra, rb)
                if (lo == hi).all():
                    break
                np.minimum.at(label, hi, lo)
    end = find(np.arange(n))
    far = np.flatnonzero(end != np.arange(n))
    return fp[far], fp[end[far]]


def near_links(fps: DataFrame, radius: int = RADIUS, max_tree: int = MAX_TREE) -> DataFrame:
    """(a, b): a spanning forest, shard by shard, of the distinct fingerprints within ``radius`` bits."""
    bands = radius + 1
    edges = [64 * i // bands for i in range(bands + 1)]
    shards = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("band"),
                 F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)).alias("value"))
        for i, (lo, hi) in enumerate(zip(edges, edges[1:]))])).alias("s")).select("fp", "s.*")
    sizes = shards.groupBy("band", "value").agg(F.count("*").alias("n")).filter("n > 1")
    sized = shards.join(sizes, ["band", "value"]) \
        .withColumn("parts", F.ceil(F.col("n") / max_tree).cast("int")) \
        .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    # tiles (tree part i, query part j) with i <= j; a row of part p is in the tree of (p, j>=p) and a
    # query of (i<=p, p). Shards of one part have the one tile (0, 0).
    tiles = sized.select("band", "value", "fp", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")) \
        .select("band", "value", F.least("part", "other").alias("ti"), F.greatest("part", "other").alias("tj"),
                (F.col("part") <= F.col("other")).alias("tree"), (F.col("part") >= F.col("other")).alias("query"), "fp")
    dealt = tiles.repartition("band", "value", "ti", "tj").sortWithinPartitions("band", "value", "ti", "tj", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        size = 1 << 16

        def links(t: pa.Table) -> pa.RecordBatch:
            cols = [t.column(c).to_numpy() for c in ("band", "value", "ti", "tj")]
            begin = starts_of(*cols)
            group = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, t.num_rows)))
            a, b = spanning_links(group, t.column("fp").to_numpy(), t.column("tree").to_numpy(zero_copy_only=False),
                                  t.column("query").to_numpy(zero_copy_only=False), radius)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            rest = pa.concat_tables([rest, pa.Table.from_batches([batch])]) if rest is not None else pa.Table.from_batches([batch])
            if rest.num_rows < size:
                continue
            cut = int(starts_of(*[rest.column(c).to_numpy() for c in ("band", "value", "ti", "tj")])[-1])
            if cut:                                           # the last tile may go on in the next batch
                yield links(rest.slice(0, cut))
                rest = rest.slice(cut).combine_chunks()
        if rest is not None and rest.num_rows:
            yield links(rest)

    return dealt.mapInArrow(run, "a long, b long").distinct()


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, root): the smallest node of each node's component, for nodes of ``links`` (a, b).
    Alternates large-star and small-star joins until nothing changes; each round is written to the
    shared folder. A star's centre is aggregated with map-side combine, so hubs stay small."""
    def both(e):
        return e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))

    edges = written(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .distinct(), name)
    before = None
    while True:
        two = both(edges)
        low = two.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = two.filter("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        down = large.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        low2 = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(low2, "a").select(F.col("b").alias("x"), "m").union(low2.select(F.col("a").alias("x"), "m"))
        edges = written(small.filter("x <> m").select(F.col("x").alias("a"), F.col("m").alias("b")).distinct(), name)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
        before = now


def _groups(docs: DataFrame, shingle: int, radius: int, max_tree: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    marks = written(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    fps = written(marks.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    repeated = marks.filter("doc_id is not null").groupBy("doc_id") \
        .agg(F.count("*").alias("n"), F.min("fp").alias("lo"), F.max("fp").alias("hi")).filter("n > 1")
    same_id = marks.join(repeated.filter("lo < hi").select("doc_id", "lo"), "doc_id").select(F.col("fp").alias("a"), F.col("lo").alias("b"))
    parts = components(near_links(fps.select("fp"), radius, max_tree).union(same_id))
    rooted = written(fps.join(parts, fps.fp == parts.node, "left")
                     .select("fp", "first_id", F.coalesce("root", "fp").alias("root")), "rooted")
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_fp = rooted.join(ids, "root").select("fp", "component_id")
    # documents meet their fingerprint's component by a join in which a hot fingerprint can be split
    return marks.join(by_fp, "fp"), repeated


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, max_tree: int = MAX_TREE,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id linked)."""
    found, _ = _groups(docs, shingle, radius, max_tree, id_col, text_col)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def dedup(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, max_tree: int = MAX_TREE,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group: that with the smallest id, once (of rows that repeat the id, one of
    the smallest text). Rows without an id stay."""
    found, repeated = _groups(docs, shingle, radius, max_tree, id_col, text_col)
    gone = written(found.filter("doc_id <> component_id").select("doc_id"), "duplicates") \
        .select(F.col("doc_id").alias("__id"))
    stay = docs.join(gone, docs[id_col].cast("long") == gone["__id"], "left_anti")
    twice = written(repeated.select(F.col("doc_id").alias("__id")), "repeated-ids")
    if twice.isEmpty():
        return stay
    once = stay.join(twice, stay[id_col].cast("long") == twice["__id"], "left_anti")
    return once.union(stay.join(twice, stay[id_col].cast("long") == twice["__id"], "left_semi")
                      .groupBy(id_col).agg(F.min_by(F.struct(*docs.columns), F.struct(
                          F.col(text_col).isNotNull(), F.col(text_col), F.xxhash64(*docs.columns))).alias("__row"))
                      .select("__row.*"))
