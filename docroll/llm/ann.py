"""Approximate nearest neighbours by largest inner product: NN-descent graph,
greedy graph search.

*Rows.* Vectors that are null, zero, of another length than most, or hold a null
or non-finite component take no part, nor do rows without an id; a repeated id
counts once (its least vector). Equal vectors are one node, with its smallest
ids (``members``), so a vector that very many rows share is no hot group and ties
among copies go to the smaller ids exactly.

*Graph.* Inner products are made comparable across norms by one extra component,
sqrt(max norm^2 - norm^2), so that near in the graph means large inner product
(unit vectors stay as they are). Every node starts with the nearest of its
neighbours in a few orders by random-projection signs. Then NN-descent rounds, as
Spark joins: each node's neighbours and reverse neighbours (``SAMPLE`` of either,
new and old each) meet their vectors, pairs among them that hold a new one are
scored, and every node keeps its ``DEGREE`` best. Rounds end when few edges
change.

*Search.* A query walks the graph (edges in both directions) greedily: each round
joins its best ``EXPAND`` unvisited nodes with their neighbours, scores those and
keeps the best ``BEAM``; it ends when all nodes kept are visited.

State between rounds is a staged table. All rows are indexed; nothing is fitted on
a sample. Columns other than the two named are not read. Fewer candidates than
``k`` give fewer rows; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docroll.llm.common import drop_stage, mix, stage

DEGREE = 40
SAMPLE = 24
ORDERS = 4
BITS = 12
BLOCK = 128
ROUNDS = 7
#: Rounds end when fewer than this share of the edges is new.
STILL = 0.01
#: Reverse edges of a node that a search follows, the nearest first.
BACK = 48
BEAM = 224
EXPAND = 40
SEARCH_ROUNDS = 12
#: Nodes that every query starts at besides its own.
ENTRIES = 8
#: Candidates that one local join proposes for a node.
PROPOSE = 10


def nodes(table: DataFrame, id_column: str, vector_column: str, k: int, query) -> tuple[DataFrame, DataFrame, DataFrame, int, float]:
    """Distinct vectors (node, v, norm2), members (node, vec_id) with up to k + 1
    smallest ids each, queries (query_id, node), the dimension, and the largest
    squared norm."""
    v = F.col("v")
    rows = table.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v"))
    finite = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size("v") > 0) & finite & F.exists(v, lambda x: x != 0))
    # the length of most rows; sizes are few
    lengths = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").first()
    dimension = lengths[0] if lengths else 0
    rows = rows.where(F.size("v") == dimension).groupBy("vec_id").agg(F.min("v").alias("v"))
    named = rows.withColumn("same", F.struct(F.xxhash64("v"), F.hash("v")))
    heads = named.groupBy("same", "v").agg(F.min("vec_id").alias("node"))
    heads = stage(heads.select("node", "same", "v", F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x).alias("norm2")), "ann-nodes")
    ranked = named.select("same", "vec_id").withColumn("turn", F.row_number().over(Window.partitionBy("same").orderBy("vec_id"))).where(F.col("turn") <= k + 1)
    members = stage(ranked.join(heads.select("same", "node"), "same").select("node", "vec_id"), "ann-members")
    asked = stage(named.where(query(F.col("vec_id"))).select(F.col("vec_id").alias("query_id"), "same").join(heads.select("same", "node"), "same").select("query_id", "node"), "ann-asked")
    most = heads.agg(F.max("norm2")).first()[0]
    return heads.select("node", "v", "norm2"), members, asked, dimension, float(most or 0.0)


def _pack(most: float):
    """Packed float32 vectors with the extra component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if n:
                v = batch.column("v").flatten().to_numpy().reshape(n, -1)
                extra = np.sqrt(np.maximum(most - batch.column("norm2").to_numpy(), 0))
                full = np.concatenate([v, extra[:, None]], axis=1).astype(np.float32)
                yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([x.tobytes() for x in full], pa.binary())], names=["node", "vec"])

    return run


def _codes(order: int, dimension: int):
    """Sign codes of random projections: rows that are near often share a prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng([17, order])
        planes = rng.normal(size=(dimension + 1, BITS + 1)).astype(np.float32)
        for batch in batches:
            if batch.num_rows:
                spots = _matrix(batch.column("vec"), dimension + 1) @ planes
                code = ((spots[:, :BITS] > 0) @ (1 << np.arange(BITS - 1, -1, -1))).astype(np.int64)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(code), pa.array(spots[:, BITS].astype(np.float64))], names=["node", "vec", "code", "along"])

    return run


def _matrix(column, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset]
    return np.frombuffer(data, np.float32, n * width, at).reshape(n, width)


def _edges(a, b, s) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(s, pa.float32())], names=["a", "b", "s"])


def _best_of(scores: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the best ``keep`` finite entries of each row."""
    keep = min(keep, scores.shape[1])
    top = np.argpartition(-scores, keep - 1, axis=1)[:, :keep]
    row = np.repeat(np.arange(len(scores)), keep)
    col = top.ravel()
    fine = np.isfinite(scores[row, col])
    return row[fine], col[fine]


def _blocks(dimension: int):
    """First edges: the best partners within blocks of consecutive rows of an order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("node").to_numpy()
            x = _matrix(batch.column("vec"), dimension + 1) if len(ids) else np.zeros((0, dimension + 1), np.float32)
            for i in range(0, len(ids), BLOCK):
                lo = min(i, max(0, len(ids) - BLOCK))  # the last block reaches back
                own, part = ids[lo : lo + BLOCK], x[lo : lo + BLOCK]
                scores = part @ part.T
                np.fill_diagonal(scores, -np.inf)
                if len(own) > 1:
                    row, col = _best_of(scores, DEGREE // 2)
                    yield _edges(own[row], own[col], scores[row, col])

    return run


def _keep_best(degree: int):
    """Over rows sorted by (a, b): each node's best edges, without repeats. A row
    that was there before counts as old."""

    def cut(a, b, s, new):
        first = np.ones(len(a), dtype=bool)
        first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        at = np.flatnonzero(first)
        new = np.minimum.reduceat(new, at)  # 0 if the edge was known
        a, b, s = a[at], b[at], s[at]
        order = np.lexsort((b, -s, a))
        a, b, s, new = a[order], b[order], s[order], new[order]
        begin = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
        rank = np.arange(len(a)) - np.repeat(begin, np.diff(np.append(begin, len(a))))
        keep = rank < degree
        a, b, s, new = a[keep], b[keep], s[keep], new[keep]
        # a node's new and old edges take turns in a fixed random order
        order = np.lexsort((mix((a * 31 + b).view(np.uint64)), new, a))
        begin = np.flatnonzero(np.concatenate([[True], (a[order][1:] != a[order][:-1]) | (new[order][1:] != new[order][:-1])]))
        turn = np.empty(len(a), np.int32)
        turn[order] = np.arange(len(a)) - np.repeat(begin, np.diff(np.append(begin, len(a)))) + 1
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (a, b, s, new, turn)], names=["a", "b", "s", "new", "turn"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(c).to_numpy() for c in ("a", "b", "s", "new")]
            if held:
                rows = [np.concatenate(x) for x in zip(held, rows)]
            tail = rows[0] == rows[0][-1]
            held = [c[tail] for c in rows]
            if not tail.all():
                yield cut(*(c[~tail] for c in rows))
        if held:
            yield cut(*held)

    return run


def _graph_of(edges: DataFrame, degree: int) -> DataFrame:
    # no fixed number of partitions here and below: Spark joins small ones
    return edges.repartition("a").sortWithinPartitions("a", "b").mapInArrow(_keep_best(degree), "a long, b long, s float, new int, turn int")


def _local_join(dimension: int):
    """Over rows (v, u, new, worst, vec) sorted by v: scores of the pairs among the
    neighbours u of one v, of which one is new; each u gets its best proposals
    that beat its worst edge."""

    def score(v, u, new, worst, x):
        begin = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
        size = np.diff(np.append(begin, len(v)))
        begin, size = begin[size > 1], size[size > 1]
        for i in range(0, len(begin), 256):
            b, n = begin[i : i + 256], size[i : i + 256]
            width = int(n.max())
            at = np.minimum(b[:, None] + np.arange(width), len(v) - 1)
            there = np.arange(width) < n[:, None]
            part = x[at]
            scores = part @ part.transpose(0, 2, 1)
            fresh = new[at] > 0
            useful = there[:, :, None] & there[:, None, :] & (fresh[:, :, None] | fresh[:, None, :])
            useful &= (u[at][:, :, None] != u[at][:, None, :]) & (scores > worst[at][:, :, None])
            scores = np.where(useful, scores, -np.inf).reshape(-1, width)
            row, col = _best_of(scores, PROPOSE)
            yield _edges(u[at].reshape(-1)[row], np.repeat(u[at], width, axis=0).reshape(-1, width)[row, col], scores[row, col])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(c).to_numpy() for c in ("v", "u", "new", "worst")] + [_matrix(batch.column("vec"), dimension + 1)]
            if held:
                rows = [np.concatenate(x) for x in zip(held, rows)]
            tail = rows[0] == rows[0][-1]
            held = [c[tail] for c in rows]
            if not tail.all():
                yield from score(*(c[~tail] for c in rows))
        if held:
            yield from score(*held)

    return run


def neighbour_graph(packed: DataFrame, dimension: int, degree: int = DEGREE, rounds: int = ROUNDS) -> DataFrame:
    """Staged edges (a, b, s, new, turn) of the NN-descent graph over (node, vec)."""
    first = None
    for order in range(ORDERS):
        coded = packed.mapInArrow(_codes(order, dimension), "node long, vec binary, code long, along double")
        edges = coded.repartitionByRange("code", "along").sortWithinPartitions("code", "along").select("node", "vec").mapInArrow(_blocks(dimension), "a long, b long, s float")
        first = edges if first is None else first.unionByName(edges)
    graph = stage(_graph_of(first.withColumn("new", F.lit(1)), degree), "ann-graph")
    total = graph.count()
    for _ in range(rounds):
        worst = graph.groupBy("a").agg(F.when(F.count("*") >= degree, F.min("s")).otherwise(F.lit(float("-inf"))).cast("float").alias("worst"))
        sampled = graph.where(F.col("turn") <= SAMPLE)
        back = sampled.select(F.col("b").alias("v"), F.col("a").alias("u"), "new")
        turn = F.row_number().over(Window.partitionBy("v", "new").orderBy(F.xxhash64("v", "u"), "u"))
        back = back.withColumn("turn", turn).where(F.col("turn") <= SAMPLE).drop("turn")
        chosen = sampled.select(F.col("a").alias("v"), F.col("b").alias("u"), "new").unionByName(back).groupBy("v", "u").agg(F.max("new").alias("new"))
        known = packed.join(worst, packed["node"] == worst["a"], "left").select(F.col("node").alias("u"), "vec", F.coalesce("worst", F.lit(float("-inf")).cast("float")).alias("worst"))
        met = chosen.join(known, "u").select("v", "u", "new", "worst", "vec")
        proposed = met.repartition("v").sortWithinPartitions("v").mapInArrow(_local_join(dimension), "a long, b long, s float")
        # an edge whose pairs have been tried is old
        old = graph.select("a", "b", "s", F.when(F.col("turn") <= SAMPLE, 0).otherwise(F.col("new")).alias("new"))
        after = stage(_graph_of(old.unionByName(proposed.withColumn("new", F.lit(1))), degree), "ann-graph")
        drop_stage(graph)
        graph = after
        if (graph.agg(F.sum("new")).first()[0] or 0) <= STILL * total:
            break
    return graph


def _scores(width: int):
    """Inner products of queries and nodes, without the extra component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                s = np.einsum("ij,ij->i", _matrix(batch.column("q_vec"), width)[:, :-1], _matrix(batch.column("vec"), width)[:, :-1])
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(s)], names=["a", "b", "s"])

    return run


def _search(queries: DataFrame, packed: DataFrame, graph: DataFrame, dimension: int) -> DataFrame:
    """Pool (a: query node, b: node, s, new: 1 while unvisited, go: to be visited next) of
    each query's best nodes."""
    back = graph.select(F.col("b").alias("a"), F.col("a").alias("b"), "s")
    turn = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("s"), "b"))
    back = back.withColumn("turn", turn).where(F.col("turn") <= BACK).select("a", "b")
    links = stage(graph.select("a", "b").unionByName(back).distinct().withColumnsRenamed({"a": "from", "b": "to"}), "ann-links")
    asked = queries.join(packed, "node").select(F.col("node").alias("a"), F.col("vec").alias("q_vec"))

    def scored(pairs: DataFrame) -> DataFrame:
        met = pairs.join(packed.withColumnRenamed("node", "b"), "b").join(asked, "a")
        return met.select("a", "b", "q_vec", "vec").mapInArrow(_scores(dimension + 1), "a long, b long, s float").withColumn("new", F.lit(1))

    def kept(every: DataFrame) -> DataFrame:
        # both orders are within one query: they share a shuffle
        best = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("s"), "b"))
        unvisited = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("new"), F.desc("s"), "b"))
        cut = every.withColumn("turn", best).where(F.col("turn") <= BEAM + 1).drop("turn")
        return stage(cut.withColumn("go", (F.col("new") == 1) & (unvisited <= EXPAND)), "ann-pool")

    # a query starts at its own node, the neighbours that the graph gives it, and a
    # few nodes that are the same for all
    entries = [r[0] for r in packed.orderBy(F.xxhash64("node"), "node").select("node").limit(ENTRIES).collect()]
    if not entries:
        return graph.select("a", "b", "s", "new", F.lit(False).alias("go"))
    own = asked.select("a", F.col("a").alias("b"), F.lit(float("inf")).cast("float").alias("s"), F.lit(1).alias("new"))
    near = graph.join(asked.select("a"), "a").select("a", "b")
    far = asked.select("a", F.explode(F.array(*[F.lit(e) for e in entries])).alias("b"))
    pool = kept(own.unionByName(scored(near.unionByName(far).where("a <> b").distinct())))
    for _ in range(SEARCH_ROUNDS):
        next_ = pool.where("go").select("a", "b")
        if not next_.take(1):
            break
        seen = pool.select("a", "b")
        met = next_.join(links, next_["b"] == links["from"]).select("a", F.col("to").alias("b")).distinct().join(seen, ["a", "b"], "left_anti")
        visited = pool.select("a", "b", "s", F.when(F.col("go"), 0).otherwise(F.col("new")).alias("new"))
        after = kept(visited.unionByName(scored(met)))
        drop_stage(pool)
        pool = after
    return pool


def nearest(table: DataFrame, query, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """For each row of ``table`` whose id meets the condition ``query`` (a function
    of the id column): query_id, rank, vec_id, score of the ``k`` nearest others found (inner product
    in double precision, ties to the smaller id)."""
    heads, members, asked, dimension, most = nodes(table, id_column, vector_column, k, query)
    packed = stage(heads.mapInArrow(_pack(most), "node long, vec binary"), "ann-packed")
    graph = neighbour_graph(packed, dimension)
    pool = _search(asked.select("node").distinct(), packed, graph, dimension)
    dot = F.aggregate(F.zip_with("q", "v", lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
    vectors = heads.select("node", "v")
    found = pool.select(F.col("a").alias("node"), "b").join(vectors.withColumnRenamed("v", "q"), "node").join(vectors.withColumnsRenamed({"node": "b"}), "b").select("node", "b", dot.alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    out = asked.join(found, "node").join(members.withColumnsRenamed({"node": "b"}), "b").where("vec_id <> query_id")
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
