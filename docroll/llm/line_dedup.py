"""Line dedup by a range partition of line hashes.

Every line (text split at \\n) has a key: the line without the bytes
[\\x20\\x09-\\x0D] at both ends, A-Z lower-cased. Rows (128-bit hash of the key,
doc_id, hash of the text, line number) are range-partitioned and sorted by all of these, so a
task streams over runs of equal hashes in document order and decides each run on
the spot and holds at most the rows of one key in its range. A key that very many documents
hold spreads over several ranges; the runs at the two ends of a range (at most two
keys a range) are decided together in a small second step, whose verdicts (one row a
key) are broadcast to their lines, so a hot key's lines stay in the tasks they are in.

Two rules:

* ``min_docs=None``: of each key the first line stays (smallest document, then
  line), the later ones go;
* ``min_docs=k``: keys of at least k documents lose all their lines.

The result is not text but a compressed bitmap of kept lines for each document
that loses a line; a document without a row keeps everything.

Null and empty texts are one empty line. Lines with an empty key are never
dropped. Rows with equal doc_id and text are one document and share the result;
rows that share a doc_id (or have none: the smallest) but not the text are judged
and cut each by itself. ``min_docs`` counts doc_ids, and of rows without one the
different texts. Texts of any length are read whole, an empty table gives no rows.
Columns other than doc_id and text are not read and may have any name.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docroll.llm.common import doc_key, long_column, shuffle_partitions, stage, text_key

KEYS = ["h1", "h2", "doc_key", "text_key", "line"]
ROWS = "h1 long, h2 long, doc_key long, text_key long, line int, n_lines int"
NO_ID = -(1 << 63)


def _texts(column) -> Iterator[bytes]:
    for t in column.cast(pa.large_binary()):
        yield t.as_py() or b""


def _line_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest = xxhash.xxh3_128_digest
    for batch in batches:
        keys, at, numbers, sizes = [], [], [], []
        for row, text in enumerate(_texts(batch.column("text"))):
            lines = text.split(b"\n")
            for i, line in enumerate(lines):
                if key := line.strip().lower():  # bytes: strips [\x20\x09-\x0D], lowers A-Z only
                    keys.append(digest(key))
                    at.append(row)
                    numbers.append(i)
                    sizes.append(len(lines))
        both = np.frombuffer(b"".join(keys), dtype=np.int64).reshape(-1, 2)
        at = np.array(at, dtype=np.int64)
        doc, text = (long_column(batch.column(c))[at] for c in ("doc_key", "text_key"))
        yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(doc), pa.array(text), pa.array(numbers, pa.int32()), pa.array(sizes, pa.int32())], names=[*KEYS, "n_lines"])


def _runs(min_docs: int | None):
    """Streams over sorted rows. Emits the dropped lines (edge 0) and, undecided, the
    rows of the first and last key of the range (edge 1)."""

    def emit(rows: list[np.ndarray], keep: np.ndarray, edge: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*(pa.array(c[keep]) for c in rows), pa.array(np.full(int(keep.sum()), edge, np.int32))], names=[*KEYS, "n_lines", "edge"])

    def decide(rows: list[np.ndarray]) -> np.ndarray:
        h1, h2, doc, text, line, _ = rows
        new = np.ones(len(h1), dtype=bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        if min_docs is None:  # a repeated row is no later line
            at = np.flatnonzero(new)[np.cumsum(new) - 1]
            return (doc != doc[at]) | (text != text[at]) | (line != line[at])
        other = new.copy()
        other[1:] |= (doc[1:] != doc[:-1]) | ((doc[1:] == NO_ID) & (text[1:] != text[:-1]))
        run = np.cumsum(new) - 1
        return np.bincount(run, weights=other)[run] >= min_docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = True  # still within the range's first key
        held: list[list[np.ndarray]] = []  # rows of the last key seen, from earlier batches
        head = last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(c).to_numpy(zero_copy_only=False) for c in [*KEYS, "n_lines"]]
            start = 0
            if first:
                head = head or (rows[0][0], rows[1][0])
                differs = (rows[0] != head[0]) | (rows[1] != head[1])
                start = int(np.argmax(differs)) if differs.any() else len(differs)
                yield emit(rows, np.arange(len(differs)) < start, 1)
                if start == len(differs):
                    continue
                first = False
            rows = [c[start:] for c in rows]
            if held and len(rows[0]):
                if (rows[0][0], rows[1][0]) != last:
                    rows = [np.concatenate(x) for x in zip(*held, rows)]
                    held = []
                else:
                    same = (rows[0] == last[0]) & (rows[1] == last[1])
                    if same.all():  # the run goes on
                        held.append(rows)
                        continue
                    rows = [np.concatenate(x) for x in zip(*held, rows)]
                    held = []
            last = (rows[0][-1], rows[1][-1])
            tail = (rows[0] == last[0]) & (rows[1] == last[1])
            held = [[c[tail] for c in rows]]
            body = [c[~tail] for c in rows]
            if len(body[0]):
                yield emit(body, decide(body), 0)
        for rows in held:
            yield emit(rows, np.ones(len(rows[0]), dtype=bool), 1)

    return run


def dropped_lines(docs: DataFrame, min_docs: int | None = None) -> DataFrame:
    """Rows (doc_key, text_key, line, n_lines) of the lines to drop."""
    rows = docs.select(doc_key().alias("doc_key"), text_key().alias("text_key"), F.col("text").cast("string").alias("text")).mapInArrow(_line_rows, ROWS)
    ranges = rows.repartitionByRange(shuffle_partitions(docs.sparkSession), *KEYS).sortWithinPartitions(*KEYS)
    decided = stage(ranges.mapInArrow(_runs(min_docs), ROWS + ", edge int"), "line-runs")
    edges = decided.where("edge = 1")  # at most two keys a range
    if min_docs is None:
        first = edges.groupBy("h1", "h2").agg(F.min(F.struct("doc_key", "text_key", "line")).alias("first"))
        late = edges.join(F.broadcast(first), ["h1", "h2"]).where(F.struct("doc_key", "text_key", "line") > F.col("first"))
    else:
        nameless = F.when(F.col("doc_key") == F.lit(NO_ID), F.col("text_key"))
        per_doc = edges.groupBy("h1", "h2", "doc_key", nameless.alias("nameless")).agg(F.count("*").alias("c"))
        common = per_doc.groupBy("h1", "h2").agg(F.count("*").alias("c")).where(F.col("c") >= min_docs)
        late = edges.join(F.broadcast(common), ["h1", "h2"], "left_semi")
    columns = ["doc_key", "text_key", "line", "n_lines"]
    return decided.where("edge = 0").select(*columns).unionByName(late.select(*columns))


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        maps, lost = [], []
        for n, gone in zip(batch.column("n_lines").to_pylist(), batch.column("gone")):
            keep = np.ones(n, dtype=bool)
            keep[gone.values.to_numpy()] = False
            maps.append(zlib.compress(np.packbits(keep).tobytes(), 6))
            lost.append(int(n - keep.sum()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_key"), batch.column("text_key"), batch.column("n_lines"), pa.array(lost, pa.int32()), pa.array(maps, pa.binary())],
            names=["doc_key", "text_key", "n_lines", "n_dropped", "keep"],
        )


def keep_bitmaps(docs: DataFrame, min_docs: int | None = None) -> DataFrame:
    """One row per document that loses a line: doc_key, text_key, n_lines, n_dropped and
    ``keep``, a zlib-compressed bitmap (first line in the highest bit)."""
    gone = dropped_lines(docs, min_docs).groupBy("doc_key", "text_key").agg(F.max("n_lines").alias("n_lines"), F.collect_set("line").alias("gone"))
    return gone.mapInArrow(_bitmaps, "doc_key long, text_key long, n_lines int, n_dropped int, keep binary")


def kept_lines(text: bytes, keep: bytes | None) -> list[bytes]:
    """The lines of a text that its bitmap keeps (None: all)."""
    lines = text.split(b"\n")
    if keep is None:
        return lines
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8))
    return [line for i, line in enumerate(lines) if i >= len(bits) or bits[i]]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total, gone, digests = [], [], []
        for text, keep in zip(_texts(batch.column("text")), batch.column("keep").to_pylist()):
            kept = kept_lines(text, keep)
            total.append(text.count(b"\n") + 1)
            gone.append(total[-1] - len(kept))
            digests.append(hashlib.sha256(b"\n".join(kept)).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("doc_key"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests)], names=["doc_key", "n_lines", "n_dropped", "kept_sha256"])


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [None if t is None else b"\n".join(kept_lines(t, keep)) for t, keep in zip(batch.column("text").cast(pa.large_binary()).to_pylist(), batch.column("keep").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column("doc_key"), pa.array(texts, pa.binary()).cast(pa.string())], names=["doc_key", "text"])


def _with_maps(docs: DataFrame, min_docs: int | None) -> DataFrame:
    texts = docs.select(doc_key().alias("doc_key"), text_key().alias("text_key"), F.col("text").cast("string").alias("text"))
    return texts.join(keep_bitmaps(docs, min_docs).select("doc_key", "text_key", "keep").hint("shuffle_hash"), ["doc_key", "text_key"], "left")


def line_digests(docs: DataFrame, min_docs: int | None = None) -> DataFrame:
    """Per row of ``docs``: doc_key, n_lines, n_dropped, kept_sha256 of what stays."""
    return _with_maps(docs, min_docs).mapInArrow(_digests, "doc_key long, n_lines long, n_dropped long, kept_sha256 string")


def dedup_lines(docs: DataFrame, min_docs: int | None = None) -> DataFrame:
    """Per row of ``docs``: doc_key and the text without its dropped lines."""
    return _with_maps(docs, min_docs).mapInArrow(_apply, "doc_key long, text string")
