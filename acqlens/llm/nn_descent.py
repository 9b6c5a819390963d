"""Approximate nearest neighbours by inner product: NN-descent graph, greedy graph search.

Equal vectors are one node. Inner products become cosines by one more component, sqrt(M^2 - |x|^2), M the
largest norm, so that the graph joins what is near. NN-descent starts from neighbours by hash order and
from neighbours along random projections; each round is a Spark join: every node gathers its neighbours'
vectors, both ways, compares them with one another, and each of them keeps the best ``DEGREE`` seen so
far. It ends when few lists change. A query walks greedily: from its own graph neighbours it looks at the
neighbours of the best ``BEAM`` nodes it has found and has not yet opened, until nothing better turns up.

Fixed sizes: ``DEGREE``, ``BEAM``, ``ROUNDS``; nodes that many others list pass on ``DEGREE`` of these
each round, drawn anew by hash. Nulls: vectors that are null, zero, or hold a null or non-finite component
take no part, nor do vectors of another length than the most frequent one; null ids take no part. Ties go
to the smaller id. Rows repeating an id and vector count once. Empty tables give no rows.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acqlens.llm.common import written
from acqlens.session import Scratch, forget_shuffles

K = 20
DEGREE = 32
BEAM = 160
ROUNDS = 8
PROJECTIONS = 6
SETTLED = 0.01     # share of lists' entries that still change when the descent ends
EDGES = "src long, dst long, sim double"
GATHERED = 1 << 20  # edges that a task gathers to drop those it has twice
TOGETHER = 64       # queries, on average, whose pairs are scored in one group


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v): rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).filter(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)) \
        .dropDuplicates(["vec_id", "v"])
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.filter(F.size("v") == (size["n"] if size else 0))


def _best(edges: DataFrame, most: int) -> DataFrame:
    """The ``most`` best edges of each node, each once, with their places ``r`` and ``old``, true of those that were old."""
    w = Window.partitionBy("src").orderBy(F.desc("sim"), "dst")
    return edges.repartition("src").groupBy("src", "dst").agg(F.max("sim").alias("sim"), F.max("old").alias("old")) \
        .withColumn("r", F.row_number().over(w)).filter(F.col("r") <= most)


def _once(found: Iterator[list[np.ndarray]], size: int = GATHERED) -> Iterator[pa.RecordBatch]:
    """Edges (src, dst, sim) as batches without most of the repeated ones, of which the greatest sim stays."""
    def batch(held: list[list[np.ndarray]]) -> pa.RecordBatch:
        src, dst, sim = (np.concatenate(x) for x in zip(*held))
        with np.errstate(over="ignore"):
            order = np.argsort(src.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + dst.astype(np.uint64))
        src, dst, sim = src[order], dst[order], sim[order]
        at = np.flatnonzero(np.append(True, (src[1:] != src[:-1]) | (dst[1:] != dst[:-1]))) if len(src) else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(src[at]), pa.array(dst[at]), pa.array(np.maximum.reduceat(sim, at) if len(at) else sim)],
                                          ["src", "dst", "sim"])
    held, n = [], 0
    for columns in found:
        held.append(columns)
        n += len(columns[0])
        if n >= size:
            yield batch(held)
            held, n = [], 0
    if held:
        yield batch(held)


def _first_edges(nodes: DataFrame, n: int, dim: int, degree: int, projections: int) -> DataFrame:
    """Neighbours in the order of random projections: nodes are dealt into ranges of each projection and
    sorted there; windows of ``degree`` that follow one another are compared."""
    planes = np.random.default_rng(7).standard_normal((projections, dim))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = _vectors(b.column(1)) @ planes.T
            m = b.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(projections), m)), pa.array(at.reshape(-1)), b.column(0).take(pa.array(np.repeat(np.arange(m), projections))),
                 b.column(1).take(pa.array(np.repeat(np.arange(m), projections)))], ["plane", "at", "node", "v"])
    parts = max(1, n // 2000) * projections
    placed = nodes.mapInArrow(place, "plane long, at double, node long, v array<double>") \
        .repartitionByRange(parts, "plane", "at").sortWithinPartitions("plane", "at", "node")

    def near(x: np.ndarray, node: np.ndarray, plane: np.ndarray, seen: int) -> list[np.ndarray]:
        """The best edges of each node among the windows; the first ``seen`` nodes have met one another."""
        n = len(node)
        sims = np.full((n, 2 * degree), -np.inf)          # with the nodes after, and before
        for step in range(1, min(degree, n - 1) + 1):
            sim = np.einsum("ij,ij->i", x[step:], x[:-step])
            sim[(plane[step:] != plane[:-step]) | (np.arange(step, n) < seen)] = -np.inf
            sims[:-step, step - 1] = sims[step:, degree + step - 1] = sim
        top = np.argpartition(-sims, degree - 1, axis=1)[:, :degree]
        sim = np.take_along_axis(sims, top, axis=1).reshape(-1)
        at = np.repeat(np.arange(n), degree)
        to = at + np.where(top < degree, top + 1, degree - 1 - top).reshape(-1)
        real = sim > -np.inf
        return [node[at[real]], node[to[real]], sim[real]]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[list[np.ndarray]]:
            held: pa.Table | None = None
            for b in batches:
                t = pa.Table.from_batches([b])
                seen = min(degree, held.num_rows) if held is not None else 0
                held = pa.concat_tables([held.slice(held.num_rows - seen), t]).combine_chunks() if held is not None else t
                yield near(_vectors(held.column("v").combine_chunks()), held.column("node").to_numpy(), held.column("plane").to_numpy(), seen)
        yield from _once(found())
    return placed.mapInArrow(compare, EDGES)


def graph(nodes: DataFrame, degree: int = DEGREE, rounds: int = ROUNDS, projections: int = PROJECTIONS) -> DataFrame:
    """(src, dst, sim): the ``degree`` nearest found of each of ``nodes`` (node, v), v of length 1."""
    first = nodes.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim")).first()
    spark = nodes.sparkSession
    last = Scratch(spark, "nn-edges").until_exit()
    edges = last.write(_best(_first_edges(nodes, first["n"], first["dim"] or 1, degree, projections).withColumn("old", F.lit(False)), degree),
                       "edges")
    for turn in range(rounds):
        forget_shuffles(spark)
        # both ways; of the nodes that list a node, ``degree`` take part in a round, others in the next
        draw = Window.partitionBy("dst").orderBy(F.xxhash64("src", F.lit(turn)), "src")
        back = edges.withColumn("r", F.row_number().over(draw)).filter(F.col("r") <= degree) \
            .select(F.col("dst").alias("hub"), F.col("src").alias("node"))
        near = edges.select(F.col("src").alias("hub"), F.col("dst").alias("node")).union(back).repartition("node").distinct()
        # what is below the last of a full list would not stay in it
        bars = edges.filter(F.col("r") == degree).select(F.col("src").alias("node"), F.col("sim").alias("bar"))
        met = near.join(nodes.join(bars, "node", "left"), "node").select("hub", "node", "v", F.coalesce("bar", F.lit(-2.0)).alias("bar")) \
            .repartition("hub").sortWithinPartitions("hub", "node")

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def local(t: pa.Table) -> list[np.ndarray]:
                hub, node, bar = (t.column(c).to_numpy() for c in ("hub", "node", "bar"))
                x = _vectors(t.column("v").combine_chunks())
                cuts = np.append(np.flatnonzero(np.append(True, hub[1:] != hub[:-1])), len(hub))
                out: list[list[np.ndarray]] = [[node[:0]], [node[:0]], [bar[:0]]]
                for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                    if e - s < 2:
                        continue
                    sim = x[s:e] @ x[s:e].T
                    np.fill_diagonal(sim, -9.0)
                    few = min(6, e - s - 1)          # the best a node meets here; worse ones would not stay
                    top = np.argpartition(-sim, few - 1, axis=1)[:, :few]
                    out[0].append(np.repeat(node[s:e], few))
                    out[1].append(node[s:e][top].reshape(-1))
                    sim = np.take_along_axis(sim, top, axis=1)
                    out[2].append(np.where(sim >= bar[s:e, None], sim, -np.inf).reshape(-1))
                src, dst, sim = map(np.concatenate, out)
                stay = sim > -np.inf
                return [src[stay], dst[stay], sim[stay]]

            def found() -> Iterator[list[np.ndarray]]:
                rest: pa.Table | None = None
                for b in batches:
                    t = pa.Table.from_batches([b])
                    rest = pa.concat_tables([rest, t]).combine_chunks() if rest is not None else t
                    hub = rest.column("hub").to_numpy()
                    cut = int(np.flatnonzero(np.append(True, hub[1:] != hub[:-1]))[-1])
                    if cut:
                        yield local(rest.slice(0, cut).combine_chunks())
                        rest = rest.slice(cut)
                if rest is not None:
                    yield local(rest.combine_chunks())
            yield from _once(found())

        now = Scratch(spark, "nn-edges").until_exit()
        after = now.write(_best(edges.select("src", "dst", "sim", F.lit(True).alias("old")).union(
            met.mapInArrow(compare, EDGES).withColumn("old", F.lit(False))), degree), "edges")
        changed = after.filter("not old").count()
        edges = after
        last.free()
        last = now
        if changed <= SETTLED * degree * max(1, first["n"]):
            break
    return edges.select("src", "dst", "sim")


def _products(pairs: DataFrame, nodes: DataFrame, asked: DataFrame, blocks: int) -> DataFrame:
    """(qnode, node, score): the inner products of pairs. Queries are dealt into blocks; a block gets each vector that
    its pairs need once, so that no pair is shuffled with a vector."""
    block = F.pmod(F.xxhash64("qnode"), F.lit(blocks)).alias("block")
    placed = pairs.select(block, "qnode", "node")
    needed = placed.select("block", "node").distinct().join(nodes.select("node", "raw"), "node") \
        .select(F.col("block").alias("group"), F.lit(False).alias("asks"), F.col("node").alias("id"), F.col("raw").alias("v")) \
        .union(asked.select(block, F.lit(True), "qnode", "q"))

    def score(rows: pa.Table, vectors: pa.Table) -> pa.Table:
        asks, ids = vectors.column("asks").to_numpy(), vectors.column("id").to_numpy()
        x = _vectors(vectors.column("v").combine_chunks())
        sides = []
        for side, column in ((asks, "qnode"), (~asks, "node")):
            order = np.argsort(ids[side])
            sides += [np.ascontiguousarray(x[side][order].T), np.searchsorted(ids[side][order], rows.column(column).to_numpy())]
        q, at_q, v, at_v = sides
        total = np.zeros(rows.num_rows)
        for s in range(0, len(total), 1 << 15):
            part = slice(s, s + (1 << 15))
            for a, b in zip(q, v):                     # component after component, as a sum in double precision goes
                total[part] += a[at_q[part]] * b[at_v[part]]
        return pa.table({"qnode": rows.column("qnode"), "node": rows.column("node"), "score": total})
    return placed.groupBy("block").cogroup(needed.groupBy("group")).applyInArrow(
        lambda rows, vectors: score(rows, vectors) if rows.num_rows else pa.table(
            {"qnode": pa.array([], pa.int64()), "node": pa.array([], pa.int64()), "score": pa.array([], pa.float64())}),
        "qnode long, node long, score double")


def search(vectors: DataFrame, is_query: Column, k: int = K, degree: int = DEGREE, beam: int = BEAM, rounds: int = ROUNDS,
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each row for which ``is_query`` (an
    expression of vec_id) holds, by inner product in double precision."""
    rows = written(valid(vectors, id_col, vector_col), "nn-rows")
    by_vector = rows.groupBy("v").agg(F.min("vec_id").alias("node"))
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    most = by_vector.agg(F.max(norm)).first()[0] or 1.0
    nodes = written(by_vector.withColumn("raw", F.col("v")).select("node", "raw", F.transform(
        F.concat("v", F.array(F.sqrt(F.greatest(most - norm, F.lit(0.0))))), lambda x: x / F.sqrt(F.lit(most))).alias("v")), "nn-nodes")
    # copies of a vector: the k + 1 smallest ids of each node can be in a result
    first = Window.partitionBy("node").orderBy("vec_id")
    copies = written(rows.join(nodes.select("node", F.col("raw").alias("v")), "v").select("node", "vec_id")
                     .withColumn("r", F.row_number().over(first)).filter(F.col("r") <= k + 1).drop("r"), "nn-copies")
    edges = graph(nodes.select("node", "v"), degree, rounds)
    queries = written(rows.filter(is_query).join(nodes.select("node", F.col("raw").alias("v")), "v")
                      .select(F.col("vec_id").alias("query_id"), "node", F.col("v").alias("q")), "nn-queries")
    asked = queries.select(F.col("node").alias("qnode"), F.col("q")).dropDuplicates(["qnode"])
    blocks = 1 + asked.count() // TOGETHER
    best = Window.partitionBy("qnode").orderBy(F.desc("score"), "node")

    start = asked.join(edges, F.col("qnode") == F.col("src")).select("qnode", F.col("dst").alias("node")) \
        .union(asked.select("qnode", F.col("qnode").alias("node"))).distinct()
    last = Scratch(vectors.sparkSession, "nn-pool").until_exit()
    pool = last.write(_products(last.write(start, "found"), nodes, asked, blocks).withColumn("opened", F.col("node") == F.col("qnode")), "pool")
    for _ in range(2 * rounds):
        forget_shuffles(vectors.sparkSession)
        closed = pool.filter("not opened")
        if closed.isEmpty():
            break
        reached = closed.join(edges, F.col("node") == F.col("src")).select("qnode", F.col("dst").alias("node")).distinct() \
            .join(pool, ["qnode", "node"], "left_anti")
        now = Scratch(vectors.sparkSession, "nn-pool").until_exit()
        grown = pool.withColumn("opened", F.lit(True)).union(
            _products(now.write(reached, "found"), nodes, asked, blocks).withColumn("opened", F.lit(False)))
        pool = now.write(grown.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= beam).drop("r"), "pool")
        last.free()
        last = now
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return queries.select("query_id", F.col("node").alias("qnode")).join(pool.select("qnode", "node", "score"), "qnode") \
        .join(copies, "node").filter("vec_id <> query_id").withColumn("rank", F.row_number().over(rank)) \
        .filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
