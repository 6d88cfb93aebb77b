"""Substring dedup by hashing whole lines or paragraphs.

A unit is a line (between \\n) or a paragraph (between runs of blank lines). It
is normalised (lower case, runs of whitespace as one space, none at the ends)
and hashed to 128 bits. Digests are grouped globally by a partial aggregation;
of each digest the earliest occurrence stays (smallest rank, by default the
doc_id, then the doc_id, the hash of the text and the offset) and the others are cut. Cut units are reported by their
byte offsets in the original text.

Units of fewer than ``min_words`` words are never cut (1: every unit that is not
blank can be).

A passage inside units that differ around it is no repeated unit. With ``passage`` (a
number of words) windows of words are hashed beside the units, normalised alike and
across their bounds: of each ``passage`` words on end the window of least hash. Equal
runs of that many words so have a window in common, wherever they stand. A window that
an earlier document holds too is cut; windows that overlap are one passage. No window
of fewer than half that many words is ever cut, and at either end of a passage less than half of them may stay.

Null and empty texts
have no units. A null doc_id is the smallest. Rows with equal doc_id and text are
one document: they stay or go alike, and no row is a copy of itself. Rows that share
a doc_id (or have none) but not the text are cut each by itself. Only
doc_id, text and the rank column are read. Bytes that are no UTF-8 stay as they are.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docroll.llm.common import GOLDEN, RollingHash, chunks, doc_key, drop_stage, long_column, mix, powers, stage, text_buffer, text_key, words

UNITS = {"line": re.compile(rb"[^\n]+"), "paragraph": re.compile(rb"\S(?:[^\n]|\n(?!\s*\n))*")}
MIN_WORDS = 10
#: Words of a passage: over 50.
PASSAGE = 51
#: Occurrences of one digest go to this many tasks when they learn their first one,
SALTS = 16
#: if it has more than these.
HOT = 1000


def units(text: bytes, unit: str, min_words: int) -> Iterator[tuple[int, int, bytes | None]]:
    """Start, end and digest of each unit (None: too short to be cut)."""
    for m in UNITS[unit].finditer(text):
        parts = m[0].split()
        if parts:
            yield m.start(), m.end(), xxhash.xxh3_128_digest(b" ".join(parts).decode("utf-8", "surrogateescape").lower().encode("utf-8", "surrogateescape")) if len(parts) >= min_words else None


def _sliding(values: np.ndarray, width: int, least) -> np.ndarray:
    """The least (or greatest) of every ``width`` neighbours, by the first one's place."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = least(values[:-step], values[step:])
        done += step
    return values


def windows(texts: list[bytes], passage: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, start, end and digest (two numbers) of the windows of words that stand for
    every ``passage`` words on end. Neighbouring ones overlap; equal ones that do are given as one."""
    width = passage // 2 + 2
    choice = passage - width + 1

    def found(parts: list[bytes]):
        data, bounds = np.frombuffer(b"".join(parts), dtype=np.uint8), np.cumsum([0, *map(len, parts)])
        return data, *words(data, bounds)

    _, start, end, row = found(texts)
    n = len(row)
    if n < passage:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none, none
    low, low_start, low_end, _ = found([t.decode("utf-8", "surrogateescape").lower().encode("utf-8", "surrogateescape") for t in texts])
    code = RollingHash(low).ranges(low_start, low_end)
    up, down = powers(n)
    prefix = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(code * up[:n], out=prefix[1:])
    h = mix((prefix[width:] - prefix[:-width]) * down[: n - width + 1])
    least = _sliding(h, choice, np.minimum)
    least[row[: len(least)] != row[passage - 1 :]] = 0  # no passage of one text
    at = np.flatnonzero(_sliding(np.pad(least, choice - 1), choice, np.maximum) == h)
    second = np.zeros(len(at), dtype=np.uint64)
    for j in range(width):
        second += code[at + j] * np.uint64(pow(GOLDEN, 2 * j + 1, 1 << 64))
    h1, h2, at_row = h[at], mix(second), row[at]
    order = np.lexsort((at, h2, h1, at_row))
    at, h1, h2, at_row = at[order], h1[order], h2[order], at_row[order]
    new = np.ones(len(at) + 1, dtype=bool)  # a word repeated on end has equal windows at each place
    new[1:-1] = (at_row[1:] != at_row[:-1]) | (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]) | (at[1:] >= at[:-1] + width)
    first, last = np.flatnonzero(new[:-1]), np.flatnonzero(new[1:])
    own = np.cumsum([0, *map(len, texts)])[at_row[first]]
    return at_row[first], start[at[first]] - own, end[at[last] + width - 1] - own, h1[first].view(np.int64), h2[first].view(np.int64)


def _unit_rows(unit: str, min_words: int, passage: int | None, order: list[str]):
    def table(batch, at, *columns, passage: bool):
        keys = (long_column(batch.column(c))[at] for c in order)
        h1, h2, start, end = (pa.array(c, pa.int64()) for c in columns)
        return pa.RecordBatch.from_arrays([h1, h2, *map(pa.array, keys), start, end, pa.repeat(passage, len(at))], names=["h1", "h2", *order, "start", "end", "passage"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if passage is not None:
                _, bounds = text_buffer(batch.column("text"))
                for i, j in chunks(bounds):
                    texts = [t or b"" for t in batch.column("text").slice(i, j - i).cast(pa.large_binary()).to_pylist()]
                    row, s, e, h1, h2 = windows(texts, passage)
                    yield table(batch, row + i, h1, h2, s, e, passage=True)
            keys, at, start, end = [], [], [], []
            for i, text in enumerate(batch.column("text").cast(pa.large_binary())):
                for s, e, key in units(text.as_py() or b"", unit, min_words):
                    if key is not None:
                        keys.append(key)
                        at.append(i)
                        start.append(s)
                        end.append(e)
            both = np.frombuffer(b"".join(keys), dtype=np.int64).reshape(-1, 2)
            at = np.array(at, dtype=np.int64)
            yield table(batch, at, both[:, 0], both[:, 1], start, end, passage=False)

    return run


def cut_units(docs: DataFrame, unit: str = "line", min_words: int = MIN_WORDS, rank: str | None = None, passage: int | None = None) -> DataFrame:
    """Rows (doc_key, text_key, start, end, passage): the units that repeat an earlier one, and
    (passage true) the windows of words that an earlier document holds.
    ``rank``: an integer column that says which document comes first."""
    keys = {"doc_key": doc_key(), "text_key": text_key()}
    if rank is not None:
        keys = {"rank": doc_key(rank), **keys}
    order = list(keys)
    rows = docs.select(*(c.alias(k) for k, c in keys.items()), F.col("text").cast("string").alias("text"))
    found = rows.mapInArrow(_unit_rows(unit, min_words, passage, order), f"h1 long, h2 long, {', '.join(f'{k} long' for k in order)}, start long, end long, passage boolean")
    place = F.struct(*order, "start")
    first = stage(found.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1"), "units-first")
    hot = first.where(F.col("n") > HOT).select("h1", "h2", F.lit(True).alias("hot"))
    salts = F.sequence(F.lit(0), F.when(F.col("n") > HOT, SALTS - 1).otherwise(0))
    salted = found.join(F.broadcast(hot), ["h1", "h2"], "left")
    salted = salted.withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("doc_key", "text_key", "start"), F.lit(SALTS))).otherwise(0).cast("int")).drop("hot")
    salty = first.select("h1", "h2", "first", F.explode(salts).alias("salt"))
    holder = F.struct(*order) > F.struct(*(f"first.{k}" for k in order))
    later = (place > F.col("first")) & (~F.col("passage") | holder)
    cut = stage(salted.join(salty, ["h1", "h2", "salt"]).where(later).select("doc_key", "text_key", "start", "end", "passage").distinct(), "units-cut")
    drop_stage(first)
    return cut


def cut_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Each row's text with its document's spans to cut, ascending (null: none)."""
    lists = spans.groupBy("doc_key", "text_key").agg(F.sort_array(F.collect_list(F.struct("start", "end", "passage"))).alias("cuts"))
    texts = docs.select(doc_key().alias("doc_key"), text_key().alias("text_key"), F.col("text").cast("string").alias("text"))
    return texts.join(lists.hint("shuffle_hash"), ["doc_key", "text_key"], "left")


def _digests(unit: str, min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, gone, passages, size, digests, cuts = [], [], [], [], [], []
            for text, spans in zip(batch.column("text").cast(pa.large_binary()).to_pylist(), batch.column("cuts").to_pylist()):
                text = text or b""
                total.append(sum(1 for _ in units(text, unit, min_words)))
                spans = [s for s in spans or () if s["end"] <= len(text)]
                gone.append(sum(not s["passage"] for s in spans))
                passages.append(len(merged((s["start"], s["end"]) for s in spans if s["passage"])))
                inside = merged((s["start"], s["end"]) for s in spans)
                size.append(sum(e - s for s, e in inside))
                cuts.append([{"start": s, "end": e} for s, e in inside])
                digests.append(hashlib.sha256(remaining(text, inside)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_key"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(passages, pa.int64()), pa.array(size, pa.int64()), pa.array(cuts, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(digests)],
                names=["doc_key", "n_units", "n_units_removed", "n_passages_removed", "n_removed", "removed", "kept_sha256"],
            )

    return run


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ascending spans, with those that overlap as one."""
    out: list[tuple[int, int]] = []
    for s, e in spans:
        if out and s <= out[-1][1]:
            out[-1] = out[-1][0], max(e, out[-1][1])
        else:
            out.append((s, e))
    return out


def remaining(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the (ascending, disjoint) spans."""
    out, at = [], 0
    for s, e in spans:
        out.append(text[at:s])
        at = e
    return b"".join([*out, text[at:]])


def unit_digests(docs: DataFrame, unit: str = "line", min_words: int = MIN_WORDS, rank: str | None = None, passage: int | None = None) -> DataFrame:
    """Per row of ``docs``: doc_key, n_units, n_units_removed, n_passages_removed, n_removed (bytes of
    both), removed (original byte spans), kept_sha256 of the remaining bytes."""
    cuts = cut_spans(docs, cut_units(docs, unit, min_words, rank, passage))
    return cuts.mapInArrow(_digests(unit, min_words), "doc_key long, n_units long, n_units_removed long, n_passages_removed long, n_removed long, removed array<struct<start:long,end:long>>, kept_sha256 string")
