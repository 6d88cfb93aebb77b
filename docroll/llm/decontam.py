"""Benchmark decontamination by the q-gram lemma and banded alignment.

Texts are compared after folding: lower case, every run of characters that are
neither letters nor digits as one space. A benchmark item of m folded characters
may occur in a document with up to k = floor(rate * m) edits. Such an occurrence
shares at least m + 1 - q * (k + 1) q-grams with the item, and these lie on
neighbouring diagonals (document position minus item position). For an item so
short that this bound would be zero, q is lowered to m div (k + 1), so every item
of ``q`` folded characters or more has its whole budget. Each task counts
shared q-grams in overlapping bands of 2 * (k + 1) diagonals, one band starting
every k + 1, so an occurrence lies within one band as a whole. Bands that reach
the bound are verified by a banded alignment; no other pair is ever looked at.
Hits are counted in blocks of ``PAIRS``, so a q-gram that text and benchmark
repeat without end takes time but no memory. Of the occurrences in a chain of
neighbouring bands that overlap each other, the best is listed (fewest edits, then the first).

The benchmark is dealt into slices of at most ``SLICE_CHARS`` characters (by the
measured sizes of hash buckets; an item or bucket beyond that is a slice by itself); a
slice is broadcast to a pass over the documents, so what is sent is bounded however
large the benchmark is.

Items of fewer than ``q`` folded characters are no passages and never found; null
and empty texts contain nothing, and an empty table gives no rows. Documents that repeat are reported
each; items equal in id and text are one item. Null ids stay null, bytes that are no
UTF-8 are spaces. Texts of any length are searched whole. Only doc_id, text and item_id,
text are read, so other columns may have any name.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docroll.llm.common import GOLDEN, chunks, doc_key, long_column, mix, powers, text_buffer

Q = 12
RATE = 0.06
SLICE_CHARS = 2_000_000
#: Hits (a document position and a place in an item) that are held at a time.
PAIRS = 4_000_000
#: Hash buckets a slice, by whose sizes the benchmark is dealt.
FINE = 64
FOUND = "doc_key long, item_key long, edits int, budget int, item_chars int, start long, end long"


_TABLE: dict[str, np.ndarray] = {}


def _fold_table() -> np.ndarray:
    """Code point (below 65536) to its folded form; 0x20 for what is neither letter nor digit."""
    if not _TABLE:
        fold = np.arange(65536, dtype=np.uint16)
        for c in range(65536):
            ch = chr(c)
            if 0xD800 <= c < 0xE000 or not ch.isalnum():
                fold[c] = 0x20
            elif len(low := ch.lower()) == 1 and ord(low) < 65536:
                fold[c] = ord(low)
        _TABLE["fold"] = fold
        _TABLE["code"] = mix((np.arange(65536, dtype=np.uint64) + np.uint64(1)) * np.uint64(GOLDEN))
    return _TABLE["fold"]


def fold(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """UTF-8 rows to folded characters, their row bounds, and each one's character offset in its row."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)
    starts = (data & 0xC0) != 0x80
    row_at = np.concatenate([[0], np.cumsum(starts)])[bounds]
    table = _fold_table()
    # characters beyond the first plane keep their low half, as letters
    out = np.where(points < 65536, table[points & 0xFFFF], np.maximum(points & 0xFFFF, 0x21).astype(np.uint16))
    gap = out == 0x20
    drop = gap.copy()
    drop[1:] &= gap[:-1]
    first = row_at[:-1][np.diff(row_at) > 0]
    drop[first] = gap[first]  # a row's first space and
    last = row_at[1:][np.diff(row_at) > 0] - 1
    run_last = last[gap[last]]  # the space that ends a row
    keep = ~drop
    if len(run_last):
        begin = np.maximum.accumulate(np.where(gap, np.where(np.concatenate([[True], ~gap[:-1]]), np.arange(len(gap)), -1), -1))
        heads = begin[run_last]
        keep[np.maximum(heads, row_at[np.searchsorted(row_at, run_last, side="right") - 1])] = False
    # a run of spaces that goes on from the row before starts anew
    kept = np.flatnonzero(keep)
    folded = np.searchsorted(kept, row_at)
    row = np.searchsorted(row_at, kept, side="right") - 1
    return out[kept], folded, kept - row_at[row]


def _grams(folded: np.ndarray, q: int) -> np.ndarray:
    n = len(folded) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = powers(len(folded))
    prefix = np.zeros(len(folded) + 1, dtype=np.uint64)
    np.cumsum(_TABLE["code"][folded] * up[: len(folded)], out=prefix[1:])
    return mix((prefix[q:] - prefix[:n]) * down[:n])


class Index:
    """Some benchmark items, by the q that their budget allows."""

    def __init__(self, items: list[tuple[int, str]], q: int = Q, rate: float = RATE):
        by_q: dict[int, list[tuple[int, np.ndarray, int]]] = {}
        for key, text in items:
            raw = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
            folded = fold(raw, np.array([0, len(raw)]))[0] if len(raw) else raw
            if len(folded) >= q:
                budget = int(rate * len(folded))
                by_q.setdefault(min(q, len(folded) // (budget + 1)), []).append((key, folded, budget))
        self.parts = [Grams(kept, q) for q, kept in sorted(by_q.items())]

    def found(self, data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int, int, int, int, int]]:
        """Verified occurrences: row, item key, edits, budget, item length, start and end in
        characters of the row."""
        if not self.parts or not len(data):
            return
        folded, at, offset = fold(data, bounds)
        for part in self.parts:
            for row, item, low, high in part.bands(folded, at).tolist():
                pattern, k = part.items[item], int(part.budget[item])
                place = offset[at[row] : at[row + 1]]
                for edits, start, end in align(pattern, folded[at[row] : at[row + 1]], low - k, high + k, k):
                    yield row, int(part.keys[item]), edits, k, len(pattern), int(place[start]), int(place[end - 1]) + 1


def _summed(hits: np.ndarray) -> np.ndarray:
    """Rows (row, item, band, hits), one for each (row, item, band), in order."""
    if not len(hits):
        return hits
    hits = hits[np.lexsort((hits[:, 2], hits[:, 1], hits[:, 0]))]
    first = np.flatnonzero(np.concatenate([[True], (hits[1:, :3] != hits[:-1, :3]).any(axis=1)]))
    return np.column_stack([hits[first, :3], np.add.reduceat(hits[:, 3], first)])


class Grams:
    """The q-grams of some benchmark items, with where they occur."""

    def __init__(self, kept: list[tuple[int, np.ndarray, int]], q: int):
        self.q = q
        self.keys = np.array([key for key, _, _ in kept], dtype=np.int64)
        self.items = [f for _, f, _ in kept]
        self.budget = np.array([k for _, _, k in kept], dtype=np.int64)
        m = np.array([len(f) for f in self.items], dtype=np.int64)
        self.least = m + 1 - q * (self.budget + 1)
        grams = [_grams(f, q) for f in self.items]
        gram = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(m)), [len(g) for g in grams])
        at = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
        order = np.argsort(gram, kind="stable")
        self.item, self.at = item[order].astype(np.int32), at[order].astype(np.int32)
        self.grams, self.begin, self.count = np.unique(gram[order], return_index=True, return_counts=True)
        self.bits = max(16, int(len(self.grams) * 16).bit_length())
        self.may = np.zeros(1 << self.bits, dtype=bool)
        self.may[(self.grams >> np.uint64(64 - self.bits)).astype(np.int64)] = True

    def bands(self, folded: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Rows (row, item, first diagonal, end diagonal) of merged bands that reach the bound."""
        grams = _grams(folded, self.q)
        pos = np.flatnonzero(self.may[(grams >> np.uint64(64 - self.bits)).astype(np.int64)])
        which = np.searchsorted(self.grams, grams[pos])
        hit = self.grams[np.minimum(which, len(self.grams) - 1)] == grams[pos]
        pos, which = pos[hit], which[hit]
        row = np.searchsorted(bounds, pos, side="right") - 1
        inside = pos + self.q <= bounds[row + 1]
        pos, which, row = pos[inside], which[inside], row[inside]
        pairs = np.cumsum(self.count[which])
        seen = np.zeros((0, 4), np.int64)
        i = 0
        while i < len(pos):
            done = pairs[i - 1] if i else 0
            j = max(i + 1, int(np.searchsorted(pairs, done + PAIRS, side="right")))
            seen = _summed(np.concatenate([seen, self._hits(pos[i:j], which[i:j], row[i:j], bounds)]))
            i = j
        row, item, band = seen[seen[:, 3] >= self.least[seen[:, 1]], :3].T
        if not len(row):
            return np.zeros((0, 4), np.int64)
        apart = np.concatenate([[True], (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (band[1:] > band[:-1] + 2)])
        group = np.flatnonzero(apart)
        ends = np.append(group[1:], len(row)) - 1
        step = self.budget[item[group]] + 1
        return np.stack([row[group], item[group], band[group] * step, (band[ends] + 2) * step], axis=1)

    def _hits(self, pos: np.ndarray, which: np.ndarray, row: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Rows (row, item, band, hits) of some q-grams of the texts that items hold."""
        n = self.count[which]
        post = np.repeat(self.begin[which] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        item = self.item[post].astype(np.int64)
        diagonal = np.repeat(pos - bounds[row], n) - self.at[post]
        band = np.floor_divide(diagonal, self.budget[item] + 1)
        # each hit counts for the band that starts at its step and for the one before
        one = np.stack([np.repeat(row, n), item, band, np.ones(len(band), np.int64)], axis=1)
        return np.concatenate([one, one - [0, 0, 1, 0]])


def align(pattern: np.ndarray, text: np.ndarray, low: int, high: int, budget: int) -> list[tuple[int, int, int]]:
    """The occurrences of the pattern in the text on diagonals low to high (Sellers'
    recurrence within the band) that are within the budget and don't overlap a better one:
    (edits, start, end), best first."""
    low, high = max(low, -budget), min(high, len(text) - len(pattern) + budget)
    width = high - low + 1
    if width <= 0:
        return []
    big = np.int64(1 << 30)
    along = np.arange(width)
    # cell c of row i stands for text position i + low + c (characters consumed)
    spot = low + along
    cost = np.where((spot >= 0) & (spot <= len(text)), 0, big)
    begin = np.maximum(spot, 0)
    for i in range(1, len(pattern) + 1):
        spot = i + low + along
        ok = (spot >= 0) & (spot <= len(text))
        char = text[np.clip(spot - 1, 0, len(text) - 1)]
        match = np.where(spot >= 1, cost + (char != pattern[i - 1]), big)
        skip, skip_begin = np.append(cost[1:] + 1, big), np.append(begin[1:], 0)  # a pattern character too many
        better = skip < match
        best, best_begin = np.where(better, skip, match), np.where(better, skip_begin, begin)
        best = np.where(ok, best, big)
        # text characters too many: a running minimum along the row
        slid = best - along
        low_so_far = np.minimum.accumulate(slid)
        source = np.maximum.accumulate(np.where(slid == low_so_far, along, 0))
        cost = np.minimum(low_so_far + along, big)
        begin = best_begin[source]
        if cost.min() > budget:
            return []
    end = len(pattern) + low + along
    fine = np.flatnonzero((end >= 0) & (end <= len(text)) & (cost <= budget) & (end > begin))
    taken: list[tuple[int, int]] = []
    out = []
    for c in fine[np.lexsort((end[fine], cost[fine]))].tolist():
        spot = (int(begin[c]), int(end[c]))
        i = bisect.bisect_left(taken, spot)
        if (i == 0 or taken[i - 1][1] <= spot[0]) and (i == len(taken) or taken[i][0] >= spot[1]):
            taken.insert(i, spot)
            out.append((int(cost[c]), *spot))
    return out


def _occurrences(index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _fold_table()
        look = index.value
        for batch in batches:
            data, bounds = text_buffer(batch.column("text"))
            keys = long_column(batch.column("doc_key"))
            out = []
            for i, j in chunks(bounds):
                for row, *rest in look.found(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i]):
                    out.append((int(keys[i + row]), *rest))
            columns = list(zip(*out)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()))],
                names=["doc_key", "item_key", "edits", "budget", "item_chars", "start", "end"],
            )

    return run


def _slices(benchmark: DataFrame, q: int, rate: float) -> Iterator[object]:
    """Broadcast indexes of the benchmark, slice by slice."""
    spark = benchmark.sparkSession
    items = benchmark.select(doc_key("item_id").alias("item_key"), F.col("text").cast("string").alias("text"))
    items = items.where(F.octet_length("text") >= q).distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    fine = FINE * (-(-int(total) // SLICE_CHARS) or 1)
    bucket = F.pmod(F.xxhash64("item_key", "text"), F.lit(fine)).cast("int")
    # FINE numbers a slice
    sizes = sorted(tuple(r) for r in items.groupBy(bucket.alias("bucket")).agg(F.sum(F.length("text"))).collect())
    slices: list[list[int]] = []
    room = 0
    for at, chars in sizes:
        if not slices or chars > room:
            slices.append([])
            room = SLICE_CHARS
        slices[-1].append(at)
        room -= chars
    for held in slices:
        part = items if len(slices) == 1 else items.where(bucket.isin(held))
        yield spark.sparkContext.broadcast(Index(sorted(tuple(r) for r in part.collect()), q, rate))


def contaminations(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = RATE) -> DataFrame:
    """One row per occurrence: doc_key, item_key, edits, budget, item_chars and
    start, end (characters of the original text)."""
    texts = docs.select(doc_key().alias("doc_key"), F.col("text").cast("string").alias("text"))
    found = [texts.mapInArrow(_occurrences(x), FOUND) for x in _slices(benchmark, q, rate)]
    return reduce(DataFrame.unionByName, found) if found else docs.sparkSession.createDataFrame([], FOUND)


def decontaminate(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = RATE) -> DataFrame:
    """The rows of ``docs`` (same columns) whose text contains no benchmark item."""
    for index in _slices(benchmark, q, rate):

        docs = docs.where(F.arrow_udf(_clean(index), "boolean")(F.col("text").cast("string")))
    return docs


def _clean(index):
    def clean(texts: pa.Array) -> pa.Array:
        _fold_table()
        data, bounds = text_buffer(texts)
        ok = np.ones(len(texts), dtype=bool)
        for i, j in chunks(bounds):
            for row, *_ in index.value.found(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i]):
                ok[i + row] = False
        return pa.array(ok)

    clean.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return clean
