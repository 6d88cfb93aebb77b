"""Suffix-array dedup by distributed prefix doubling.

A byte goes when a string of ``length`` bytes that covers it also starts earlier
(in a document with a smaller doc_id, or earlier in the same one). Matches stay
within documents, and strings are judged on the input.

Sorting every position of the corpus at every offset would move it many times
over, so positions are named by prefixes in growing widths, and a position whose
prefix is unique leaves at once:

1. *Sampled prefixes.* Of each ``length``-byte string the ``SEED``-byte prefix
   with the least hash is its sample; equal strings have equal samples at equal
   offsets, and neighbouring strings mostly share one, so a run of strings is one
   row. Spark sorts the rows by (sample, whole run, position). A run whose sample
   is unique is unique. A run that equals an earlier one as a whole is covered.
   The first of each set of equal runs goes on if other runs have its sample
   (parts of it may match): these are the edges of repeated passages.
2. *Wider samples.* By how far a string reaches beyond its sample to the left, it is one
   of ``SIDES`` kinds; all strings of a kind hold the sample widened to the least reach of the kind on either
   side. The widened samples are sorted and ranked again; a string goes on only if that of its kind
   is not unique.
3. *Prefix doubling.* The two halves of the strings that are left are ranked as
   prefixes of length / 2 bytes, without those of a unique rank; the ranks of position pairs at that offset are
   sorted into ranks of twice the width. What is not the first of its final rank is covered.

Prefixes are compared by 64-bit hashes; a final rank joins two of them, so two
different strings would have to agree in both (as whole runs in theirs).

Null and empty texts have no bytes. A null doc_id counts as the smallest. Rows
with equal doc_id and text are one document: a row is no copy of itself, and they
share the result. Rows that share a doc_id (or have none) but not the text are
different documents, in the order of the texts' hashes. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docroll.llm.common import RollingHash, chunks, doc_key, drop_stage, long_column, mix, shuffle_partitions, stage, text_buffer, text_key

LENGTH = 100
SEED = 32
#: Widened samples of a run of strings.
SIDES = 4
#: Documents longer than this are walked in overlapping pieces.
PIECE = 1 << 20
_LOW = np.uint64((1 << 24) - 1)


def _pieces(batch: pa.RecordBatch, length: int, keys: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes, bounds, keys (by default the doc keys) and offsets in the document: whole documents, or
    pieces of a long one that overlap so that each string lies in one piece."""
    data, bounds = text_buffer(batch.column("text"))
    keys = long_column(batch.column("doc_key")) if keys is None else keys
    for i, j in chunks(bounds, PIECE):
        body = data[bounds[i] : bounds[j]]
        if j - i > 1 or len(body) <= PIECE:
            yield body, bounds[i : j + 1] - bounds[i], keys[i:j], np.zeros(j - i, dtype=np.int64)
        else:
            for at in range(0, len(body) - length + 1, PIECE - length + 1):
                part = body[at : at + PIECE]
                yield part, np.array([0, len(part)]), keys[i:j], np.array([at])


def sample_runs(body: np.ndarray, bounds: np.ndarray, length: int, seed: int):
    """Runs of neighbouring strings with one sample: first and last start, sample
    position, hash of the sample, hash of the run's bytes with the sample's place."""
    n = len(body) - length + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    rolling = RollingHash(body)
    code = rolling.windows(seed)
    # the least of each string's prefixes, with its position in the low bits
    least = (code & ~_LOW) | np.arange(len(code), dtype=np.uint64)
    span, width = length - seed + 1, 1
    while width * 2 <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        rest = span - width
        least = np.minimum(least[:-rest], least[rest:])
    at = (least & _LOW).astype(np.int64)
    inside = np.zeros(n, dtype=bool)
    lens = np.diff(bounds)
    first = bounds[:-1][lens >= length]
    mark = np.zeros(n + 1, dtype=np.int8)
    np.add.at(mark, first, 1)
    np.add.at(mark, bounds[1:][lens >= length] - length + 1, -1)
    inside = np.cumsum(mark[:n], dtype=np.int8) > 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | (at[1:] != at[:-1])
    begins[first] = True
    lo = np.flatnonzero(begins)
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | begins[1:]
    hi = np.flatnonzero(ends)
    at = at[lo]
    whole = mix(rolling.ranges(lo, hi + length) + ((at - lo) * 4096 + (hi - lo)).astype(np.uint64))
    return lo, hi, at, code[at], whole


def _runs(length: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, text = (long_column(batch.column(c)) for c in ("doc_key", "text_key"))
            for body, bounds, of, offset in _pieces(batch, length, np.arange(batch.num_rows)):
                lo, hi, at, sample, whole = sample_runs(body, bounds, length, seed)
                row = np.searchsorted(bounds, lo, side="right") - 1
                start = lo - bounds[row] + offset[row]
                # sample position, distance to the first and on to the last string
                place = (((start + at - lo) << 24) | ((at - lo) << 12) | (hi - lo)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(sample.view(np.int64)), pa.array(whole.view(np.int64)), pa.array(doc[of[row]]), pa.array(text[of[row]]), pa.array(place)], names=["sample", "whole", "doc_key", "text_key", "place"])

    return run


def _judge_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by (sample, whole, doc_key, text_key, place): runs that an earlier
    equal one covers (covered), and first runs whose sample others have."""

    def out(doc, text, place, covered) -> pa.RecordBatch:
        at, back, more = place >> 24, (place >> 12) & 4095, place & 4095
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(text), pa.array(at - back), pa.array(at - back + more), pa.array(at), pa.array(covered)], names=["doc_key", "text_key", "first", "last", "at", "covered"])

    pending = None  # the last first-of-its-kind: (sample, whole, doc, text, place), others seen?
    open_ = False
    for batch in batches:
        if not batch.num_rows:
            continue
        sample, whole, doc, text, place = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("sample", "whole", "doc_key", "text_key", "place"))
        held = pending is not None
        if held:
            sample, whole, doc, text, place = (np.concatenate([[p], c]) for p, c in zip(pending, (sample, whole, doc, text, place)))
        n = len(sample)
        same_sample = np.zeros(n, dtype=bool)
        same_sample[1:] = sample[1:] == sample[:-1]
        kind = np.zeros(n, dtype=bool)  # equal to the row before in sample and run
        kind[1:] = same_sample[1:] & (whole[1:] == whole[:-1])
        reps = np.flatnonzero(~kind)
        of = np.cumsum(~kind) - 1
        later = kind & ((doc != doc[reps][of]) | (text != text[reps][of]) | (place != place[reps][of]))
        before = same_sample[reps].copy()  # another run has this sample already
        if held:
            before[0] = open_
        after = np.zeros(len(reps), dtype=bool)
        after[:-1] = same_sample[reps[1:]]
        edge = (before | after)[:-1]  # the last one waits for what follows
        yield out(doc[reps[:-1]][edge], text[reps[:-1]][edge], place[reps[:-1]][edge], np.zeros(int(edge.sum()), dtype=bool))
        yield out(doc[later], text[later], place[later], np.ones(int(later.sum()), dtype=bool))
        last = reps[-1]
        pending, open_ = (sample[last], whole[last], doc[last], text[last], place[last]), bool(before[-1])
    if pending is not None and open_:
        yield out(np.array([pending[2]]), np.array([pending[3]]), np.array([pending[4]]), np.zeros(1, dtype=bool))


def _kinds(length: int, seed: int) -> list[tuple[int, int, int]]:
    """Of each kind of strings: the least and most reach to the left of the sample, the least to the right."""
    more = length - seed
    step = more // SIDES
    return [(i * step, more if i == SIDES - 1 else (i + 1) * step - 1, 0 if i == SIDES - 1 else more - (i + 1) * step + 1) for i in range(SIDES)]


def _wider_samples(length: int, seed: int):
    """Hashes of each edge run's sample widened as each kind of strings holds it (null
    where the run has none of the kind)."""
    kinds = _kinds(length, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()  # repeated rows of a document meet in one task
        for batch in batches:
            data, bounds = text_buffer(batch.column("text"))
            keys, texts = (long_column(batch.column(c)) for c in ("doc_key", "text_key"))
            for i, runs in enumerate(batch.column("runs")):
                if (row := (int(keys[i]), int(texts[i]))) in seen:
                    continue
                seen.add(row)
                body = data[bounds[i] : bounds[i + 1]]
                first, last, at = (runs.values.field(c).to_numpy() for c in ("first", "last", "at"))
                order = np.argsort(at)
                first, last, at = (c[order] for c in (first, last, at))
                for base in range(0, len(body), PIECE):
                    here = (at >= base) & (at < base + PIECE)
                    if not here.any():
                        continue
                    begin = max(0, base - length)
                    part = body[begin : base + PIECE + length]
                    rolling, spot = RollingHash(part), at[here] - begin
                    wider = []
                    for left, most, right in kinds:
                        has = (first[here] <= at[here] - left) & (last[here] >= at[here] - most)
                        code = rolling.ranges(np.where(has, spot - left, 0), np.where(has, spot + seed + right, 0)).view(np.int64)
                        wider.append(pa.array(code, mask=~has))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(spot), keys[i])), pa.array(np.full(len(spot), texts[i])), *(pa.array(c[here]) for c in (first, last, at)), *wider], names=["doc_key", "text_key", "first", "last", "at", *(f"w{k}" for k in range(SIDES))])

    return run


def _first_ranks(length: int, seed: int, width: int):
    """Positions of the halves of the strings that are left, with the hash of their ``width`` bytes."""
    kinds = _kinds(length, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()  # repeated rows of a document meet in one task
        for batch in batches:
            data, bounds = text_buffer(batch.column("text"))
            keys, texts = (long_column(batch.column(c)) for c in ("doc_key", "text_key"))
            for i, runs in enumerate(batch.column("runs")):
                if (row := (int(keys[i]), int(texts[i]))) in seen:
                    continue
                seen.add(row)
                body = data[bounds[i] : bounds[i + 1]]
                first, last, at, sides = (runs.values.field(c).to_numpy() for c in ("first", "last", "at", "sides"))
                lo = np.concatenate([np.maximum(first, at - most)[sides >> k & 1 > 0] for k, (_, most, _) in enumerate(kinds)])
                hi = np.concatenate([np.minimum(last, at - left)[sides >> k & 1 > 0] for k, (left, _, _) in enumerate(kinds)]) + 1
                lo, hi = (np.concatenate([c, c + length - width]) for c in (lo, hi))
                for base in range(0, max(len(body) - width + 1, 0), PIECE):
                    part = body[base : base + PIECE + width - 1]
                    n = len(part) - width + 1
                    mark = np.zeros(n + 1, dtype=np.int32)
                    np.add.at(mark, np.clip(lo - base, 0, n), 1)
                    np.add.at(mark, np.clip(hi - base, 0, n), -1)
                    spot = np.flatnonzero(np.cumsum(mark)[:n] > 0)
                    if len(spot):
                        code = RollingHash(part).windows(width)[spot]
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(spot), keys[i])), pa.array(np.full(len(spot), texts[i])), pa.array(spot + base), pa.array(code.view(np.int64))], names=["doc_key", "text_key", "pos", "r1"])

    return run


def _rerank(final: bool):
    """Over rows sorted by (r1, r2, doc_key, text_key, pos): one new rank for each distinct
    pair, without the unique ones; at the end, the positions after the first of each."""

    def judge(r1, r2, doc, text, pos, base: int):
        once = np.ones(len(r1), dtype=bool)  # a position may come twice
        once[1:] = (r1[1:] != r1[:-1]) | (r2[1:] != r2[:-1]) | (doc[1:] != doc[:-1]) | (text[1:] != text[:-1]) | (pos[1:] != pos[:-1])
        r1, r2, doc, text, pos = (c[once] for c in (r1, r2, doc, text, pos))
        new = np.ones(len(r1), dtype=bool)
        new[1:] = (r1[1:] != r1[:-1]) | (r2[1:] != r2[:-1])
        rank = np.cumsum(new) - 1
        reps = np.flatnonzero(new)
        if final:
            keep = (doc != doc[reps][rank]) | (text != text[reps][rank]) | (pos != pos[reps][rank])
        else:
            keep = np.bincount(rank)[rank] > 1
        return pa.RecordBatch.from_arrays([pa.array(doc[keep]), pa.array(text[keep]), pa.array(pos[keep]), pa.array(rank[keep] + base)], names=["doc_key", "text_key", "pos", "rank"]), len(reps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 40  # ranks tell pairs apart, their order means nothing
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("r1", "r2", "doc_key", "text_key", "pos")]
            if held:
                rows = [np.concatenate(x) for x in zip(held, rows)]
            tail = (rows[0] == rows[0][-1]) & (rows[1] == rows[1][-1])
            held = [c[tail] for c in rows]
            if not tail.all():
                got, used = judge(*(c[~tail] for c in rows), base)
                base += used
                yield got
        if held:
            yield judge(*held, base)[0]

    return run


def _ranked(pairs: DataFrame, parts: int, final: bool) -> DataFrame:
    """Rows (doc_key, text_key, pos, rank) of the positions whose pair is not unique; at the
    end, of those behind the first of their pair."""
    order = ["r1", "r2", "doc_key", "text_key", "pos"]
    ordered = pairs.select(*order).repartition(parts, "r1", "r2").sortWithinPartitions(*order)
    return ordered.mapInArrow(_rerank(final), "doc_key long, text_key long, pos long, rank long")


def covered_strings(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """Rows (doc_key, text_key, first, last): strings from start ``first`` to ``last`` that
    also start earlier."""
    if length % 4 or not 4 <= seed <= length // 2:
        raise ValueError("length must be a multiple of 4 and seed at most half of it")
    texts = docs.select(doc_key().alias("doc_key"), text_key().alias("text_key"), F.col("text").cast("string").alias("text"))
    runs = texts.mapInArrow(_runs(length, seed), "sample long, whole long, doc_key long, text_key long, place long")
    order = ["sample", "whole", "doc_key", "text_key", "place"]
    row = ["doc_key", "text_key"]
    parts = shuffle_partitions(docs.sparkSession)
    judged = stage(runs.repartition(parts, "sample").sortWithinPartitions(*order).mapInArrow(_judge_runs, "doc_key long, text_key long, first long, last long, at long, covered boolean"), "suffix-runs")
    edges = judged.where("NOT covered").groupBy(*row).agg(F.collect_set(F.struct("first", "last", "at")).alias("runs"))
    wider = ", ".join(f"w{k} long" for k in range(SIDES))
    found = texts.join(edges.hint("shuffle_hash"), row).mapInArrow(_wider_samples(length, seed), f"doc_key long, text_key long, first long, last long, at long, {wider}")
    found = stage(found, "suffix-edges")
    # a run and the kind of its strings in one number
    kinds = found.select(*row, "first", F.posexplode(F.array(*(f"w{k}" for k in range(SIDES))))).where("col IS NOT NULL")
    kinds = kinds.select(F.col("col").alias("r1"), F.col("pos").cast("long").alias("r2"), *row, (F.col("first") * SIDES + F.col("pos")).alias("pos"))
    shared = _ranked(kinds, parts, False).groupBy(*row, F.floor(F.col("pos") / SIDES).alias("first")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pos % {SIDES} AS int))")).alias("sides"))
    left = found.select(*row, "first", "last", "at").join(shared, [*row, "first"])
    left = left.groupBy(*row).agg(F.collect_set(F.struct("first", "last", "at", "sides")).alias("runs"))
    width = length // 2
    where = texts.join(left.hint("shuffle_hash"), row).mapInArrow(_first_ranks(length, seed, width), "doc_key long, text_key long, pos long, r1 long")
    halves = stage(_ranked(where.withColumn("r2", F.lit(0).cast("long")), parts, False), "suffix-ranks")
    drop_stage(found)
    # pairs of ranks at the offset of the width so far give twice the width; each
    # document's ranks are moved once
    ahead = F.first("rank").over(Window.partitionBy(*row).orderBy("pos").rangeBetween(width, width))
    pairs = halves.select(*row, "pos", F.col("rank").alias("r1"), ahead.alias("r2")).where("r2 IS NOT NULL")
    now = stage(_ranked(pairs, parts, True), "suffix-ranks")
    drop_stage(halves)
    late = now.select(*row, F.col("pos").alias("first"), F.col("pos").alias("last"))
    return judged.where("covered").select(*row, "first", "last").unionByName(late)


def spans_to_cut(first: np.ndarray, last: np.ndarray, length: int, size: int) -> np.ndarray:
    """Maximal runs of covered bytes: rows (start, end)."""
    order = np.argsort(first, kind="stable")
    start, end = first[order], np.minimum(last[order] + length, size)
    start, end = start[start < end], end[start < end]
    if not len(start):
        return np.zeros((0, 2), dtype=np.int64)
    reach = np.maximum.accumulate(end)
    new = np.concatenate([[True], start[1:] > reach[:-1]])
    return np.stack([start[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(start) - 1)]], axis=1)


def _digests(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_buffer(batch.column("text"))
            size, gone, spans, digests, cut = [], [], [], [], []
            for i, runs in enumerate(batch.column("runs")):
                body = data[bounds[i] : bounds[i + 1]]
                cuts = np.zeros((0, 2), dtype=np.int64)
                if runs.is_valid:
                    cuts = spans_to_cut(runs.values.field("first").to_numpy(), runs.values.field("last").to_numpy(), length, len(body))
                kept, at = hashlib.sha256(), 0
                for s, e in cuts.tolist():
                    kept.update(body[at:s])
                    at = e
                kept.update(body[at:])
                size.append(len(body))
                gone.append(int((cuts[:, 1] - cuts[:, 0]).sum()))
                spans.append(len(cuts))
                digests.append(kept.hexdigest())
                cut.append([{"start": s, "end": e} for s, e in cuts.tolist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_key"), pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests, pa.string()), pa.array(cut, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                names=["doc_key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"],
            )

    return run


def suffix_digests(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """Per row of ``docs``: doc_key, n_bytes, n_removed, n_spans, kept_sha256 and
    removed (the maximal runs of removed bytes)."""
    lists = covered_strings(docs, length, seed).groupBy("doc_key", "text_key").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    texts = docs.select(doc_key().alias("doc_key"), text_key().alias("text_key"), F.col("text").cast("string").alias("text"))
    return texts.join(lists.hint("shuffle_hash"), ["doc_key", "text_key"], "left").mapInArrow(
        _digests(length), "doc_key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<start:long,end:long>>"
    )
