"""Best-fit packing of documents into training sequences, by linear grouping.

A document is its token ids and an end id. Documents of more than ``capacity``
tokens are cut into pieces of ``capacity`` tokens, of which the first may be
shorter; every other document is one piece. Then

1. pieces longer than ``SMALL`` of the capacity are large: sorted by length they fall
   into ``GROUPS`` groups of equal cardinality, each rounded up to its longest;
2. with so few sizes, the linear programme over configurations (multisets of
   sizes that fit one sequence) is solved by column generation, its solution rounded
   down to whole sequences;
3. the real pieces take the places of their groups' rounded sizes;
4. the large pieces that rounding down left over, and the small ones, go by decreasing length into
   the sequence where they fit best (the least room that holds them), or a new one.

Lengths are integers of at most ``capacity``, so all of this is decided on the histogram
of lengths: the driver gets ``capacity`` counts, however many pieces there are, and
returns runs of alike sequences. Pieces of equal length are interchangeable: the r-th
of them takes the r-th place for that length. A piece's r is its turn among those
of its length in its task, plus the pieces of that length in earlier tasks, so nothing is
sorted and no length, however common, meets in one task.

A null text is empty: a single end id. Rows are packed each by itself, repeated rows,
ids and null ids too. Bytes that are no UTF-8 read as U+FFFD. A task holds
one batch's texts, or one document if that is longer. Only doc_id and text are read, under
whatever names other columns have. An empty table gives no rows.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docroll.llm.common import chunks, release, stage, text_buffer

CAPACITY = 1024
END = 2
#: Groups of large pieces; the share of the capacity up to which a piece is small.
GROUPS = 96
SMALL = 0.4
#: A text may be cut at a single space between two other characters without changing its
#: ids: there, byte-level pre-tokenizers start a token with the space.
CUT = re.compile(r"(?<=\S) (?=\S)")
#: Latin letters and the marks behind them; perhaps a line's end and the next line's first word.
_MARKED = r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([.,;:!?]*)"
MARKED = re.compile(rf"{_MARKED}(?:\n{_MARKED})?")
#: What byte-level pre-tokenizers split texts into.
PRETOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters beyond the Latin, Greek and Cyrillic ones and common marks, whose class may
#: differ between the libraries' versions of Unicode, and very long runs of white space.
ODD = re.compile(r"[^\x00-\u024f\u0391-\u03a1\u03a3-\u03c9\u0410-\u044f\u2010-\u2027\u2030-\u205e\u20ac]|\s{2048}")
#: Ids of words kept by a worker (some 15 MB), and the longest word kept.
KEPT_WORDS, KEPT_CHARS = 1 << 16, 48

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, turn long"


# --- the plan, on the histogram of lengths ------------------------------------------


def _groups(hist: np.ndarray, small: int, n_groups: int) -> list[list[tuple[int, int]]]:
    """Large pieces, longest first, in groups of equal cardinality: (length, count) each."""
    total = int(hist[small + 1 :].sum())
    share = -(-total // n_groups) if total else 0
    out: list[list[tuple[int, int]]] = []
    room = 0
    for length in range(len(hist) - 1, small, -1):
        left = int(hist[length])
        while left:
            if not room:
                out.append([])
                room = share
            take = min(left, room)
            out[-1].append((length, take))
            left, room = left - take, room - take
    return out


def _knapsack(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The configuration of the largest worth."""
    best = np.zeros(capacity + 1)
    last = np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        fits = np.flatnonzero(sizes <= room)
        if len(fits):
            gain = best[room - sizes[fits]] + worth[fits]
            k = int(np.argmax(gain))
            if gain[k] > best[room] + 1e-12:
                best[room], last[room] = gain[k], fits[k]
    config = np.zeros(len(sizes))
    room = capacity
    while room > 0:
        if last[room] < 0:
            room -= 1
        else:
            config[last[room]] += 1
            room -= sizes[last[room]]
    return float(best[capacity]), config


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """An optimal basis of the configuration programme: (how often each size, sequences)."""
    n = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))
    amount = demand / np.diag(basis)
    for _ in range(60 * n):  # every basis is feasible: an early end costs sequences, not rows
        worth = np.linalg.solve(basis.T, np.ones(n))
        value, config = _knapsack(sizes, np.maximum(worth, 0), capacity)
        if value <= 1 + 1e-7:
            break
        step = np.linalg.solve(basis, config)
        ratio = np.where(step > 1e-9, amount / np.where(step > 1e-9, step, 1), np.inf)
        leaves = int(np.argmin(ratio))
        amount = np.maximum(amount - ratio[leaves] * step, 0)
        amount[leaves] = ratio[leaves]
        basis[:, leaves] = config
    return [(basis[:, j].astype(int), float(amount[j])) for j in range(n)]


def _substituted(groups: list[list[tuple[int, int]]], capacity: int) -> tuple[list[tuple[int, tuple[tuple[int, int], ...]]], dict[int, int]]:
    """Runs (sequences, ((length, times), ...)) of the rounded configurations with the
    real lengths in them, and the large lengths left over."""
    left = [list(g) for g in groups]  # of each group, what is not placed; longest first
    runs = []
    sizes = np.array([g[0][0] for g in groups], dtype=np.int64)
    demand = np.array([sum(c for _, c in g) for g in groups], dtype=float)
    unique, of = np.unique(sizes, return_inverse=True)  # groups of one length are one size
    wanted = np.bincount(of, weights=demand)
    members = {u: [g for g in range(len(groups)) if of[g] == u] for u in range(len(unique))}
    for config, amount in configurations(unique, wanted, capacity):
        n = int(amount + 1e-6)
        if not n:
            continue
        columns = []  # per place of the configuration, n pieces as (length, count)
        for u in np.flatnonzero(config):
            for _ in range(config[u]):
                column, need = [], n
                for g in members[u]:
                    while need and left[g]:
                        length, count = left[g][0]
                        take = min(count, need)
                        column.append((length, take))
                        need -= take
                        left[g][0] = (length, count - take)
                        if count == take:
                            left[g].pop(0)
                columns.append(column + ([(0, need)] if need else []))
        at = 0
        ends = sorted({int(e) for column in columns for e in np.cumsum([c for _, c in column])})
        for end in ends:
            items: dict[int, int] = {}
            for column in columns:
                edges = np.cumsum([c for _, c in column])
                length = column[int(np.searchsorted(edges, at, side="right"))][0]
                if length:
                    items[length] = items.get(length, 0) + 1
            if items:
                runs.append((end - at, tuple(items.items())))
            at = end
    rest: dict[int, int] = {}
    for group in left:
        for length, count in group:
            rest[length] = rest.get(length, 0) + count
    return runs, rest


def plan(hist: np.ndarray, capacity: int = CAPACITY, n_groups: int = GROUPS, small: float = SMALL) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """Runs of alike sequences (sequences, ((length, times), ...)) that place exactly
    ``hist[length]`` pieces of each length from 1 to ``capacity``."""
    hist = np.asarray(hist, dtype=np.int64)
    runs = [(int(hist[capacity]), ((capacity, 1),))] if hist[capacity] else []  # full by themselves
    open_hist = hist.copy()
    open_hist[capacity] = 0
    limit = int(capacity * small)
    groups = _groups(open_hist, limit, n_groups)
    rest = {length: int(open_hist[length]) for length in range(1, limit + 1) if open_hist[length]}
    rooms: dict[int, list] = {}
    if groups:
        placed, over = _substituted(groups, capacity)
        rest.update(over)
        for n, items in placed:
            rooms.setdefault(capacity - sum(x * m for x, m in items), []).append((n, items))
    for length in sorted(rest, reverse=True):
        count = rest[length]
        for room in [r for r in sorted(rooms) if r >= length]:  # the least room that holds it first
            while count and rooms[room]:
                n, items = rooms[room].pop()
                each = room // length  # a sequence begun stays the best fit until it is full
                whole = min(n, count // each)
                if whole:
                    rooms.setdefault(room - each * length, []).append((whole, (*items, (length, each))))
                count -= whole * each
                n -= whole
                if n and count and count < each:
                    rooms.setdefault(room - count * length, []).append((1, (*items, (length, count))))
                    n, count = n - 1, 0
                if n:
                    rooms[room].append((n, items))
                    if not count:
                        break
            if not count:
                break
        if count:
            each = capacity // length
            if count // each:
                rooms.setdefault(capacity - each * length, []).append((count // each, ((length, each),)))
            if count % each:
                rooms.setdefault(capacity - (count % each) * length, []).append((1, ((length, count % each),)))
    for room in sorted(rooms):
        runs += rooms[room]
    return runs


def places(runs: list[tuple[int, tuple[tuple[int, int], ...]]]) -> dict[str, np.ndarray]:
    """For the r-th piece of a length: rows sorted by (length, first r) with the sequence
    and offset of that r, and how many pieces of the length stand in one sequence."""
    rows, taken, at = [], {}, 0
    for n, items in runs:
        offset = 0
        for length, times in items:
            first = taken.get(length, 0)
            rows.append((length, first, at, times, offset))
            taken[length] = first + n * times
            offset += length * times
        at += n
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "sequence", "times", "offset"), table.T))


# --- pieces and their places, in Spark ---------------------------------------------


def _merges(spec: dict) -> dict[bytes, int] | None:
    """The ranks of a byte-level BPE tokenizer whose ids are in the order of its merges, else None."""
    model = spec["model"]
    before = spec.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or spec.get("normalizer") or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
        return None
    if model.get("dropout") or model.get("ignore_merges") or spec.get("truncation") or spec.get("padding"):
        return None
    shown = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xAD)]  # bytes that byte-level vocabularies print as they are
    hidden = [b for b in range(256) if b not in set(shown)]
    of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    own = {t["content"] for t in spec.get("added_tokens") or ()}
    vocab = {w: i for w, i in model["vocab"].items() if w not in own}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    order = [vocab[a + b] for a, b in pairs]
    if any(c not in of for w in vocab for c in w) or order != sorted(set(order)) or len(order) + 256 != len(vocab):
        return None
    return {bytes(of[c] for c in w): i for w, i in vocab.items()}


def _beside(word: str) -> bool:
    return not word or word[0].isspace() or word[-1].isspace()


class Words:
    """Token ids of texts as little-endian unsigned 32-bit bytes. Texts without ``ODD``
    characters and added tokens go whole to a faster library with the same pre-tokens and
    merges, where the tokenizer allows it; of other texts, the stretches between the words that hold these.
    Of such words, and of all where it doesn't, a worker keeps the ids of some that
    it has met. A word is what stands between two single spaces; its ids are those
    of the space and the word. New words go to the tokenizer, but for words of Latin letters:
    these are one pre-token, to which a faster library applies the same merges."""

    def __init__(self, path: str):
        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.ranks = _merges(spec)
        self.added = [t["content"] for t in spec.get("added_tokens") or ()]
        self.whole = self.ranks and tiktoken.Encoding("texts", pat_str=PRETOKENS, mergeable_ranks=self.ranks, special_tokens={}).encode_to_numpy
        self.odd = re.compile("|".join([ODD.pattern, *map(re.escape, self.added)]))
        self.words: dict[str, bytes] = {}

    @cached_property
    def tokenizer(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    @cached_property
    def letters(self):
        import tiktoken

        return self.ranks and tiktoken.Encoding("letters", pat_str=r"(?s).+", mergeable_ranks=self.ranks, special_tokens={}).encode_ordinary

    @cached_property
    def ends(self) -> dict[str, bytes]:
        """Ids of the marks behind a word."""
        return {"": b"", "\n": self._encode(["\n"])[0]}

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: set[str]) -> None:
        """Marks behind letters, and a single line end, are tokens of their own, so ``word`` serves ``word,`` too."""
        words, plain, parts, odd = self.words, self.letters, [], []
        for word in new:
            m = MARKED.fullmatch(word)
            if m is None:
                odd.append(word)
                continue
            stem, end, below, last = m.groups()
            if below and not plain:
                odd.append(word)
                continue
            if end or below:
                parts.append((word, stem, end, below, last))
            if stem not in words:
                if plain:
                    words[stem] = np.array(plain(" " + stem), dtype="<u4").tobytes()
                else:
                    odd.append(stem)
        words.update(zip(odd, self._encode([" " + w for w in odd])))
        ends = list({end for p in parts for end in (p[2], p[4] or "")}.difference(self.ends))
        self.ends.update(zip(ends, self._encode(ends)))
        for word, stem, end, below, last in parts:
            own = words[stem] + self.ends[end]
            words[word] = own + self.ends["\n"] + np.array(plain(below), dtype="<u4").tobytes() + self.ends[last] if below else own

    def ids(self, texts: list[str]) -> list[bytes]:
        if not self.whole:
            return self._by_words(texts)
        return [self._by_stretches(t) if ODD.search(t) or any(a in t for a in self.added) else self._plain(t) for t in texts]

    def _plain(self, text: str) -> bytes:
        return self.whole(text).astype("<u4").tobytes()

    def _by_stretches(self, text: str) -> bytes:
        if len(self.words) > KEPT_WORDS:
            self.words.clear()
        out, at = [], 0
        while m := self.odd.search(text, at):
            lo = text.rfind(" ", at + 1, m.start() + 1)
            while lo > at and _beside(text[lo - 1] + text[lo + 1]):
                lo = text.rfind(" ", at + 1, lo)
            lo = max(lo, at)
            cut = CUT.search(text, m.end())
            hi = cut.start() if cut else len(text)
            if lo > at:
                out.append(self._plain(text[at:lo]))
            word = text[lo:hi]
            ids = self.words.get(word)
            if ids is None:
                ids = self._encode([word])[0]
                if len(word) <= KEPT_CHARS:
                    self.words[word] = ids
            out.append(ids)
            at = hi
        if at < len(text):
            out.append(self._plain(text[at:]))
        return b"".join(out)

    def _by_words(self, texts: list[str]) -> list[bytes]:
        if len(self.words) > KEPT_WORDS:
            self.words.clear()
        split = [t.split(" ") for t in texts]
        new = set(chain.from_iterable(split)).difference(self.words)
        # a space beside other white space or at an end can't be cut at; such words are never kept
        beside = set(filter(_beside, new))
        if beside:
            split = [words if beside.isdisjoint(words) else CUT.split(t) for words, t in zip(split, texts)]
        heads = dict.fromkeys(words[0] for words in split)
        heads.update(zip(heads, self._encode(list(heads))))
        bodies = [words[1:] for words in split]
        if beside:
            new = set(chain.from_iterable(split)).difference(self.words)
        self._learn(new)
        known = self.words.__getitem__
        out = [heads[words[0]] + b"".join(map(known, body)) for words, body in zip(split, bodies)]
        for word in new:
            if len(word) > KEPT_CHARS or _beside(word):
                del self.words[word]
        return out


_WORDS: dict[str, Words] = {}


def _pieces(path: str, capacity: int, end: int, keep_ids: bool):
    tail = np.array([end], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _WORDS.get(path) or _WORDS.setdefault(path, Words(path))
        task = TaskContext.get().partitionId()
        turns = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            column = batch.column("text")
            data, bounds = text_buffer(column)
            for i, j in chunks(bounds):
                body = data[bounds[i] : bounds[j]].tobytes()
                at = bounds[i : j + 1] - bounds[i]
                texts = [body[at[k] : at[k + 1]].decode("utf-8", "replace") for k in range(j - i)]
                out: list[tuple] = []
                for doc, ids in zip(batch.column("doc_id").slice(i, j - i).to_pylist(), words.ids(texts)):
                    ids += tail
                    n = len(ids) // 4
                    first = n % capacity or capacity
                    edges = [0, *range(first, n + 1, capacity)]
                    for piece, (a, b) in enumerate(zip(edges, edges[1:])):
                        own = ids[4 * a : 4 * b]
                        out.append((doc, piece, a, b - a, zlib.crc32(own), task, int(turns[b - a]), own if keep_ids else None))
                        turns[b - a] += 1
                doc, piece, start, length, crc, tasks, turn, own = zip(*out)
                arrays = [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), *(pa.array(c, pa.int64()) for c in (start, length, crc)), pa.array(tasks, pa.int32()), pa.array(turn, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "turn"]
                if keep_ids:
                    arrays, names = [*arrays, pa.array(own, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(arrays, names=names)
        release()

    return run


def _placed(table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = table.value
        key = t["length"].astype(np.uint64) << np.uint64(48) | t["first"].astype(np.uint64)
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            at = np.searchsorted(key, length.astype(np.uint64) << np.uint64(48) | rank.astype(np.uint64), side="right") - 1
            past, times = rank - t["first"][at], t["times"][at]
            sequence = t["sequence"][at] + past // times
            offset = t["offset"][at] + past % times * length
            names = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END, keep_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, piece (from 0), start, length, ids_crc32, sequence_id and offset;
    with ``keep_ids`` also ``ids``, the piece's tokens as little-endian unsigned 32-bit bytes.
    ``tokenizer``: the file of a byte-level tokenizer, at the same path on every executor."""
    spark = docs.sparkSession
    schema = PIECES + (", ids binary" if keep_ids else "")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # written once: a turn is a fact of this table, not of a task that may be run again
    pieces = stage(rows.mapInArrow(_pieces(tokenizer, capacity, end, keep_ids), schema), "pack-pieces")
    counts = stage(pieces.groupBy("length", "task").agg(F.count("*").alias("n")), "pack-counts")
    hist = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.groupBy("length").agg(F.sum("n")).collect():  # at most ``capacity`` rows
        hist[length] = n
    table = spark.sparkContext.broadcast(places(plan(hist, capacity)))
    earlier = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = pieces.join(counts.select("length", "task", earlier.alias("base")), ["length", "task"]).withColumn("rank", F.col("base") + F.col("turn"))
    wanted = ["doc_id", "piece", "start", "length", "ids_crc32"] + (["ids"] if keep_ids else [])
    types = {c: t for c, t in ranked.dtypes}
    out = ", ".join(f"{c} {types[c]}" for c in wanted) + ", sequence_id long, offset long"
    return ranked.select(*wanted, "rank").mapInArrow(_placed(table), out)
