"""Helpers shared by the operators of this subpackage: text buffers out of
Arrow batches, rolling 64-bit hashes over them, word shingles, connected
components.

A task sees Arrow batches of whole rows; the kernels walk a batch in chunks of
whole documents of about ``CHUNK_BYTES``, so a task's memory is bounded by that
(or by one document, if it is longer).
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docroll.session import remove_path, scratch_path

CHUNK_BYTES = 1 << 20
#: Constants of the SplitMix64 generator, an odd base for rolling hashes.
GOLDEN = 0x9E3779B97F4A7C15
MIX_1 = 0xBF58476D1CE4E5B9
MIX_2 = 0x94D049BB133111EB
BASE = 0x5851F42D4C957F2D
U64 = (1 << 64) - 1

#: Bytes of [\x20\x09-\x0D].
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finaliser: spreads every input bit over the result."""
    x = np.array(x, dtype=np.uint64, copy=True)
    t = x >> np.uint64(30)
    x ^= t
    x *= np.uint64(MIX_1)
    np.right_shift(x, np.uint64(27), out=t)
    x ^= t
    x *= np.uint64(MIX_2)
    np.right_shift(x, np.uint64(31), out=t)
    x ^= t
    return x


#: One 64-bit code per byte value, from SplitMix64.
BYTE_CODE = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(GOLDEN))
_POWERS = {"n": 0}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse modulo 2**64 for i up to n; kept in the worker."""
    if _POWERS["n"] < n + 1:
        size = max(n + 1, CHUNK_BYTES + 1)
        out = []
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            p = np.ones(size, dtype=np.uint64)
            done = 1
            while done < size:  # p[done:2*done] = p[:done] * base**done
                step = min(done, size - done)
                p[done : done + step] = p[:step] * np.uint64(pow(base, done, 1 << 64))
                done += step
            out.append(p)
        _POWERS.update(n=size, p=out)
    up, down = _POWERS["p"]
    return up, down


class RollingHash:
    """Hashes of any byte range of one buffer, from prefix sums of code * BASE**i."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        up, self.down = powers(n)
        self.prefix = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(BYTE_CODE[data] * up[:n], out=self.prefix[1:])

    def windows(self, width: int) -> np.ndarray:
        """The hash of every window of ``width`` bytes, by its start."""
        n = len(self.prefix) - width
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        out = self.prefix[width:] - self.prefix[:n]
        out *= self.down[:n]
        return mix(out)

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.prefix[end] - self.prefix[start]) * self.down[start] + (end - start).astype(np.uint64) * np.uint64(GOLDEN))


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """A string column's UTF-8 bytes and its row bounds (n + 1 offsets; a null is empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    n = len(column)
    if n == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + n + 1].astype(np.int64)
    body = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    body = body[bounds[0] : bounds[-1]]
    return body, bounds - bounds[0]


def chunks(bounds: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one row that is longer."""
    n, i = len(bounds) - 1, 0
    while i < n:
        j = int(np.searchsorted(bounds, bounds[i] + limit, side="right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j
        i = j


def long_column(column) -> np.ndarray:
    """Integers of an Arrow column; a null becomes the smallest long."""
    return np.asarray(column.cast(pa.int64()).fill_null(-(1 << 63)).to_numpy(zero_copy_only=False), dtype=np.int64)


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word ``[^\\x20\\x09-\\x0D]+``; rows are ``bounds``."""
    n = len(data)
    solid = np.zeros(n + 2, dtype=bool)
    np.logical_not(SPACE[data], out=solid[1:-1])
    first = np.zeros(n + 1, dtype=bool)
    first[bounds] = True  # a row's end is the next one's start
    start = np.flatnonzero(solid[1:-1] & (~solid[:-2] | first[:-1]))
    end = np.flatnonzero(solid[1:-1] & (~solid[2:] | first[1:])) + 1
    row = np.searchsorted(bounds, start, side="right") - 1
    return start, end, row


def shingle_hashes(data: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``width``-word shingles with their rows (rows ascending,
    repeats kept). Words are lower-cased (A-Z); a row with fewer words has its
    whole sequence as one shingle, a row without words has none."""
    low = LOWER[data]
    start, end, row = words(low, bounds)
    if not len(start):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    h = RollingHash(low).ranges(start, end)
    m = len(h) - width + 1
    whole = np.zeros(0, dtype=np.uint64)
    at = np.zeros(0, dtype=np.int64)
    if m > 0:
        acc = np.zeros(m, dtype=np.uint64)
        for j in range(width):
            acc += h[j : j + m] * np.uint64(pow(GOLDEN, 2 * j + 1, 1 << 64))
        ok = row[:m] == row[width - 1 :]
        whole, at = mix(acc[ok]), row[:m][ok]
    count = np.bincount(row, minlength=len(bounds) - 1)
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):
        first = np.searchsorted(row, short)
        acc = count[short].astype(np.uint64) * np.uint64(MIX_1)
        for j in range(width - 1):
            has = count[short] > j
            acc[has] += h[first[has] + j] * np.uint64(pow(GOLDEN, 2 * j + 1, 1 << 64))
        whole, at = np.concatenate([whole, mix(acc)]), np.concatenate([at, short])
        order = np.argsort(at, kind="stable")
        whole, at = whole[order], at[order]
    return whole, at


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Give freed buffers back to the system. Workers live on from stage to stage beside
    the executor's heap, and the C library keeps what they freed (where it has this call)."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


#: Spark's own setting: the shuffle files of a statement go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a result once to the shared folder and read it back: it cuts the
    lineage, and a lost executor costs no recomputation. What was shuffled for it
    is not read again, so it is deleted at once, not when the driver collects garbage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_stage(df: DataFrame) -> None:
    """Delete a staged table that nothing reads any more."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        remove_path(df.sparkSession, path)


def doc_key(name: str = "doc_id"):
    """The id as a long without nulls, for ordering and joining (a null id is the smallest)."""
    return F.coalesce(F.col(name).cast("long"), F.lit(-(1 << 63)))


def text_key(name: str = "text"):
    """With doc_key, tells apart rows that share an id (or have none): the hash of the text."""
    return F.xxhash64(F.col(name).cast("string"))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each batch of edges, a spanning forest: the same components, at most
    one edge a node."""
    for batch in batches:
        a, b = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        nodes, both = np.unique(np.concatenate([a, b]), return_inverse=True)
        root = np.arange(len(nodes))
        u, v = both[: len(a)], both[len(a) :]
        while True:  # hook the larger root under the smaller one, then jump pointers
            ru, rv = root[u], root[v]
            if (ru == rv).all():
                break
            np.minimum.at(root, np.maximum(ru, rv), np.minimum(ru, rv))
            while (root[root] != root).any():
                root = root[root]
        keep = root != np.arange(len(nodes))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[keep]), pa.array(nodes[root[keep]])], names=["a", "b"])


def _state(edges: DataFrame) -> tuple:
    """Tells one set of edges from another."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of the edges (a long, b long): rows (node, root)
    with the smallest node of each component, for nodes that have an edge.

    Alternating large-star and small-star steps; each reads and writes a staged
    table, and the minimum over a node's neighbours is a partial aggregation, so
    a node with many edges is no hot task. An empty table gives an empty one."""
    forest = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").mapInArrow(_forest, "a long, b long")
    now = stage(forest.distinct(), name)
    state = _state(now)
    while True:
        both = now.select("a", "b").unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("e")).select(F.col("e.b").alias("a"), F.col("e.m").alias("b")).where("a <> b").distinct()
        after = stage(small, name)
        drop_stage(now)
        now, before = after, state
        state = _state(now)
        if state == before:
            return after.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(after.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
