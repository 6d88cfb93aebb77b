"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard stands on a ring of 64-bit hashes with ``vnodes`` virtual nodes; a
document belongs to the first node clockwise of its id's hash. A shard takes at
most its bound of rows (the mean, rounded up for the first total % shards
shards, else down, so that counts end at most one apart); documents of an arc
that its shard has no room for continue clockwise to the next shard with room.
Shards that stay below their bound keep all the documents that hash to them, so
adding a shard moves few rows.

Only the counts of the arcs (shards * vnodes numbers, whatever the data) come to
the driver, which fills the shards by them. A document's place in its arc (by
hash, id, then checksum) tells its shard and its gapless slot there.

Null texts have 0 bytes and checksum 0; a null id hashes as the smallest long.
Rows that repeat an id lie next to each other on the ring. Columns to carry along
keep their names; the added ones replace any of the same name.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docroll.llm.common import GOLDEN, doc_key, mix

SHARDS = 24
VNODES = 128
#: Bytes a row counts besides its text.
ROW_BYTES = 8


def ring(shards: int, vnodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Ring positions in order, and the shard of each."""
    shard = np.repeat(np.arange(shards, dtype=np.uint64), vnodes)
    node = np.tile(np.arange(vnodes, dtype=np.uint64), shards)
    at = mix(mix(shard + np.uint64(1)) + node * np.uint64(GOLDEN))
    order = np.lexsort((shard, at))
    return at[order], shard[order].astype(np.int64)


def _arc_of(shards: int, vnodes: int):
    """The arc of an id's hash and the place within it."""

    def look(keys: pd.Series) -> pd.DataFrame:
        at, _ = ring(shards, vnodes)
        hashed = mix(keys.to_numpy().astype(np.int64).view(np.uint64) * np.uint64(GOLDEN))
        arc = np.searchsorted(at, hashed, side="left") % len(at)
        # the arc that wraps round the ring begins behind the last node
        return pd.DataFrame({"arc": arc.astype(np.int32), "place": (hashed - at[arc - 1]).view(np.int64)})

    look.__annotations__ = {"keys": pd.Series, "return": pd.DataFrame}
    return F.pandas_udf(look, "struct<arc:int, place:long>")


def fill(counts: np.ndarray, owner: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """Which ranks of each arc go where: (arc, first rank, end rank, shard, first slot).

    Documents at home come first; what an arc has left continues clockwise."""
    room, used, out = bounds.copy(), np.zeros(len(bounds), dtype=np.int64), []

    def put(arc: int, first: int, count: int, shard: int) -> int:
        take = int(min(count, room[shard]))
        if take:
            out.append((arc, first, first + take, int(shard), int(used[shard])))
            room[shard] -= take
            used[shard] += take
        return take

    left = {}
    for arc in np.flatnonzero(counts).tolist():
        took = put(arc, 0, int(counts[arc]), owner[arc])
        if took < counts[arc]:
            left[arc] = took
    for arc, first in left.items():
        node = arc
        while first < counts[arc]:
            node = (node + 1) % len(owner)
            first += put(arc, first, int(counts[arc]) - first, owner[node])
    return out


def row_bounds(total: int, shards: int) -> np.ndarray:
    return total // shards + (np.arange(shards) < total % shards)


def shard_rows(docs: DataFrame, shards: int = SHARDS, vnodes: int = VNODES, carry: list[str] | None = None) -> DataFrame:
    """Per row of ``docs``: the columns ``carry`` (default: none), doc_id, size,
    text_crc32, shard, slot."""
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    carry = [c for c in carry or [] if c not in {"size", "text_crc32", "shard", "slot"}]
    arc = _arc_of(shards, vnodes)
    counts = np.zeros(shards * vnodes, dtype=np.int64)
    per_arc = docs.select(arc(doc_key()).alias("_at")).groupBy("_at.arc").agg(F.count("*"))
    for at, n in per_arc.collect():  # one row a virtual node
        counts[at] = n
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES
    crc = F.coalesce(F.crc32(F.encode(text, "UTF-8")), F.lit(0)).cast("long")
    row = [F.struct(*[F.col(f"`{c}`") for c in carry]).alias("_row")] if carry else []
    rows = docs.select(*row, doc_key().alias("_doc_key"), size.alias("_size"), crc.alias("_crc"))
    rows = rows.withColumn("_at", arc("_doc_key")).withColumns({"_arc": F.col("_at.arc"), "_place": F.col("_at.place")}).drop("_at")
    plan = fill(counts, ring(shards, vnodes)[1], row_bounds(int(counts.sum()), shards))
    segments = spark.createDataFrame(plan, "_a int, _first long, _end long, _shard int, _slot long")
    rank = F.row_number().over(Window.partitionBy("_arc").orderBy("_place", "_doc_key", "_size", "_crc")).cast("long") - 1
    ranked = rows.withColumn("_rank", rank)
    placed = ranked.join(F.broadcast(segments), (F.col("_arc") == F.col("_a")) & (F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_end")))
    doc_id = F.when(F.col("_doc_key") != F.lit(-(1 << 63)), F.col("_doc_key")).alias("doc_id")
    kept = [F.col("_row").getField(c).alias(c) for c in carry]
    return placed.select(*kept, *([] if "doc_id" in carry else [doc_id]), F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"), F.col("_shard").alias("shard"), (F.col("_slot") + F.col("_rank") - F.col("_first")).alias("slot"))

