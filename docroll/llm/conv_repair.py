"""Repair of conversation structure by weighted interval parsing.

A conversation's rows, by turn, shall read as role initials ``(s?(ua)+)?``. Edits: Keep
a row (0), Rerole it to user or assistant (3), Delete it (4; blank rows and repeats must go), Insert an
empty-text user or assistant row anywhere (3); a truncated row that stays costs 3
more. Wanted are the cheapest edits and, of these, the least audit, the string of
the edits' initials.

The repair grammar in Chomsky normal form has a nonterminal for every kind of piece
of such a string: empty, or its first and last initial (``KINDS``). A rule joins two
adjacent pieces; a row is a terminal of the kinds that its edits give, and the
closure under Insert puts new rows before and behind any span. A cell holds for a
span of rows the minimum (cost, audit) per kind; spans are combined bottom-up by length, over
all their splits. On a span, an audit fixes its cost and no audit is a proper prefix of another of the
same cost, so the minimum of a span is made of minima. Joining is associative: runs of
``SPAN`` rows are parsed first, then the runs' cells in the same way, so a long conversation costs in
proportion to its rows. Cells of equal row sequences are computed once a worker.

Rows are range-partitioned by (conversation, turn), so a conversation of any size is split.
A range parses the conversations that lie within it. Those at its two ends and those of more
than ``HELD`` rows or ``HELD_BYTES`` go on as rows: repeats are found by a join on the text's hash, a cell is made of each
range's part, the parts' cells (one a range) are joined by conversation, and the rows are streamed
once more behind their part of the audit.

Nulls in role and text are one space. Null turns come first; rows of the same turn go by role,
the text's first 64 characters and its hash. All rows without a conversation id are one conversation. An empty role has no initial and
can't be kept. Rows with ``present`` false (where that column is named) only say that
their conversation exists. A text of any length counts whole; other columns are not read, and
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from docroll.llm.common import shuffle_partitions, stage

#: Rows parsed at once; rows and bytes of a conversation that a range holds; cells kept.
SPAN, HELD, HELD_BYTES, CELLS = 32, 2048, 1 << 23, 200_000
SALTS = 16
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3

#: The grammar's kinds of pieces: nothing, or first and last initial.
KINDS = ("", "uu", "ua", "aa", "au", "ss", "su", "sa")
AFTER = {"s": "u", "u": "a", "a": "u"}
GOAL = [KINDS.index(k) for k in ("", "ua", "sa")]


def _rules() -> list[tuple[int, int, int]]:
    """(left, right, whole) of every pair of kinds that may stand side by side."""
    out = []
    for i, x in enumerate(KINDS):
        for j, y in enumerate(KINDS):
            if not x or not y or AFTER[x[1]] == y[0]:
                out.append((i, j, KINDS.index((x or y)[:1] + (y or x)[1:])))
    return out


RULES = _rules()
Cell = list  # per kind: (cost, audit) or None
USER, ASSISTANT = KINDS.index("uu"), KINDS.index("aa")


def _better(cell: Cell, kind: int, cost: int, audit: str) -> bool:
    if cell[kind] is None or (cost, audit) < cell[kind]:
        cell[kind] = (cost, audit)
        return True
    return False


def _closed(cell: Cell) -> Cell:
    """With Inserts before and behind, as long as any kind gets cheaper."""
    changed = True
    while changed:
        changed = False
        for i, j, whole in RULES:
            if i in (USER, ASSISTANT) and cell[j] is not None:
                changed |= _better(cell, whole, cell[j][0] + INSERT, "I" + cell[j][1])
            if j in (USER, ASSISTANT) and cell[i] is not None:
                changed |= _better(cell, whole, cell[i][0] + INSERT, cell[i][1] + "I")
    return cell


def nothing() -> Cell:
    """The cell of no rows."""
    cell: Cell = [None] * len(KINDS)
    cell[0] = (0, "")
    return _closed(cell)


def terminal(row: str) -> Cell:
    """The cell of one row: its initial (``x``: another), upper case if truncated, or ``-`` if it must go."""
    cell: Cell = [None] * len(KINDS)
    cell[0] = (DELETE, "D")
    if row != "-":
        more = TRUNCATED if row.isupper() else 0
        if row.lower() != "x":
            _better(cell, KINDS.index(row.lower() * 2), KEEP + more, "K")
        for kind in (USER, ASSISTANT):
            _better(cell, kind, REROLE + more, "R")
    return _closed(cell)


def _joined(halves: Iterator[tuple[Cell, Cell]]) -> Cell:
    cell: Cell = [None] * len(KINDS)
    for left, right in halves:
        for i, j, whole in RULES:
            a, b = left[i], right[j]
            if a is not None and b is not None:
                cost = a[0] + b[0]
                if cell[whole] is None or cost <= cell[whole][0]:
                    _better(cell, whole, cost, a[1] + b[1])
    return _closed(cell)


_CELLS: dict[str, Cell] = {}


def parse_rows(rows: str) -> Cell:
    """The cell of at most ``SPAN`` rows, bottom-up by span length."""
    if rows not in _CELLS:
        if len(_CELLS) > CELLS:
            _CELLS.clear()
        for length in range(1, len(rows) + 1):
            for i in range(len(rows) - length + 1):
                span = rows[i : i + length]
                if span not in _CELLS:
                    _CELLS[span] = terminal(span) if length == 1 else _joined((_CELLS[span[:k]], _CELLS[span[k:]]) for k in range(1, length))
    return _CELLS[rows]


def parse_cells(cells: list[Cell]) -> Cell:
    """The cell of adjacent spans, bottom-up by length; more than ``SPAN`` go by runs."""
    if not cells:
        return nothing()
    while len(cells) > SPAN:
        cells = [parse_cells(cells[i : i + SPAN]) for i in range(0, len(cells), SPAN)]
    chart = {(i, i + 1): c for i, c in enumerate(cells)}
    for length in range(2, len(cells) + 1):
        for i in range(len(cells) - length + 1):
            j = i + length
            chart[i, j] = _joined((chart[i, k], chart[k, j]) for k in range(i + 1, j))
    return chart[0, len(cells)]


def parse(rows: str) -> Cell:
    return parse_cells([parse_rows(rows[i : i + SPAN]) for i in range(0, len(rows), SPAN)])


def best(cell: Cell) -> tuple[int, str]:
    return min(cell[k] for k in GOAL if cell[k] is not None)


# --- one conversation, row by row --------------------------------------------------


class Faults:
    """Counts over a conversation's rows (or a part of them) in order, and the rows as terminals."""

    COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")

    def __init__(self):
        self.rows: list[str] = []
        self.n = dict.fromkeys(self.COUNTS, 0)
        self.low = self.high = None
        self.first = self.last = None  # (initial, turn) of the outermost rows

    def add(self, turn: int | None, role: bytes, text: bytes, again: bool) -> None:
        body = text.strip()
        initial = role.decode("utf-8", "replace")[:1]
        fault = "blank" if not body else "duplicate" if again else "truncated" if body[-1:] not in (b".", b"!", b"?") else None
        if fault:
            self.n[fault] += 1
        known = initial if initial in ("s", "u", "a") else "x"
        self.rows.append("-" if fault in ("blank", "duplicate") else known.upper() if fault else known)
        here = Faults()
        here.first = here.last = (initial, turn)
        here.low = here.high = turn
        here.n["turns"] = int(turn is not None)
        self.join(here)

    def join(self, more: Faults) -> None:
        """Append the counts of what follows."""
        if more.first is None:
            return
        for c in self.COUNTS:
            self.n[c] += more.n[c]
        if self.first is None:
            self.first = more.first
        else:
            self.n["illegal"] += self.last[0] + more.first[0] not in ("su", "ua", "au")
            self.n["turns"] -= self.last[1] is not None and self.last[1] == more.first[1]
        self.last = more.last
        if more.low is not None:
            self.low, self.high = (more.low, more.high) if self.low is None else (min(self.low, more.low), max(self.high, more.high))

    def report(self) -> dict:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.n["turns"]
        return {"gaps": gaps} | {c: self.n[c] for c in self.COUNTS[:-1]}


class Repaired:
    """Applies an audit to rows as they come."""

    def __init__(self, emit):
        self.emit, self.last, self.seq = emit, "", 0
        self.hash = hashlib.sha256()

    def _put(self, edit: str, role: bytes, text: bytes) -> None:
        self.hash.update((b"\n" if self.seq else b"") + role + b":" + text)
        self.last = role[:1].decode("ascii", "replace")
        if self.emit:
            self.emit({"seq": self.seq, "edit": edit, "role": role, "text": text})
        self.seq += 1

    def inserts(self, audit: str, at: int) -> int:
        while at < len(audit) and audit[at] == "I":
            self._put("I", self._next(), b"")
            at += 1
        return at

    def _next(self) -> bytes:
        return b"assistant" if self.last == "u" else b"user"

    def row(self, edit: str, role: bytes, text: bytes) -> None:
        if edit != "D":
            self._put(edit, role if edit == "K" else self._next(), text)


# --- over a table -----------------------------------------------------------------

LONG_ROW = "turn long, role string, text string, present boolean, part int, at long"
REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
ROW = "seq long, edit string"


def _arrow(spec: str) -> dict[str, pa.DataType]:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
    return {n: kinds[t] for n, t in (c.split() for c in spec.split(", "))}


class _Out:
    """Rows to Arrow batches of one schema; columns that a row lacks are null."""

    LIMIT = 1000

    def __init__(self, types: dict[str, pa.DataType]):
        self.types, self.rows = types, []

    def batch(self) -> pa.RecordBatch:
        arrays = []
        for name, kind in self.types.items():
            values = [r.get(name) for r in self.rows]
            if pa.types.is_string(kind) and name in ("role", "text"):
                arrays.append(pa.array(values, pa.binary()).view(pa.string()))
            else:
                arrays.append(pa.array(values, kind))
        self.rows = []
        return pa.RecordBatch.from_arrays(arrays, names=list(self.types))

    def full(self) -> Iterator[pa.RecordBatch]:
        if len(self.rows) >= self.LIMIT or sum(len(r.get("text") or b"") for r in self.rows[-1:]) > 1 << 20:
            yield self.batch()


def _columns(batch: pa.RecordBatch, names: list[str]) -> Iterator[tuple]:
    cols = []
    for n in names:
        c = batch.column(n)
        cols.append((c.cast(pa.binary()) if pa.types.is_string(c.type) and n in ("role", "text") else c).to_pylist())
    return zip(*cols)


def _in_ranges(types: dict[str, pa.DataType], rows_wanted: bool):
    """Conversations within the range are repaired; rows of the others go on (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(types)
        part = TaskContext.get().partitionId()
        held: list[tuple] = []
        size, at = 0, 0
        conv, first, passing = None, True, True  # the range's first conversation may have begun earlier
        started = False

        def go_on() -> None:
            for n, (turn, role, text, present) in enumerate(held):
                out.rows.append({"kind": 1, "conv_id": conv, "turn": turn, "role": role, "text": text, "present": present, "part": part, "at": at - len(held) + n})
            held.clear()

        for batch in batches:
            for key, turn, role, text, present in _columns(batch, ["conv_id", "turn", "role", "text", "present"]):
                if started and key != conv:
                    if passing:
                        go_on()
                    else:
                        _whole(out, conv, held, rows_wanted)
                    held.clear()
                    first = False
                if not started or key != conv:
                    conv, started, passing, size = key, True, first, 0
                held.append((turn, role, text, present))
                size += len(text or b"") + 64
                at += 1
                if passing or len(held) > HELD or size > HELD_BYTES:
                    passing = True
                    go_on()
                    size = 0
                yield from out.full()
        go_on()  # the last one may go on in the next range
        if out.rows:
            yield out.batch()

    return run


def _whole(out: _Out, conv, rows: list[tuple], rows_wanted: bool) -> None:
    faults, seen = Faults(), set()
    there = [(turn, role, text) for turn, role, text, present in rows if present]
    for turn, role, text in there:
        faults.add(turn, role, text, (role, text) in seen)
        seen.add((role, text))
    cost, audit = best(parse("".join(faults.rows)))
    fixed = Repaired((lambda r: out.rows.append({"kind": 2, "conv_id": conv} | r)) if rows_wanted else None)
    at = 0
    for _, role, text in there:
        at = fixed.inserts(audit, at)
        fixed.row(audit[at], role, text)
        at += 1
    fixed.inserts(audit, at)
    if not rows_wanted:
        out.rows.append({"kind": 0, "conv_id": conv, "cost": cost, "audit": audit, "repaired_sha256": fixed.hash.hexdigest()} | faults.report())


PART = "part int, n long, blank long, duplicate long, truncated long, illegal long, turns long, low long, high long, first string, first_turn long, last string, last_turn long, costs array<long>, audits array<string>"


def _part_cells(conv_type: pa.DataType):
    """One row a part of a conversation: its counts and its cell."""
    types = {"conv_key": pa.string(), "conv_id": conv_type} | _arrow(PART.split(", costs")[0]) | {"costs": pa.list_(pa.int64()), "audits": pa.list_(pa.string())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(types)
        now, faults, cells, n = None, Faults(), [], 0

        def close() -> None:
            if faults.rows:
                cells.append(parse_rows("".join(faults.rows)))
            cell = parse_cells(cells)
            first, last = faults.first or (None, None), faults.last or (None, None)
            out.rows.append({"conv_key": now[0], "part": now[1], "conv_id": now[2], "n": n, "low": faults.low, "high": faults.high, "first": first[0], "first_turn": first[1], "last": last[0], "last_turn": last[1],
                             "costs": [c and c[0] for c in cell], "audits": [c and c[1] for c in cell]} | faults.n)

        for batch in batches:
            for key, part, conv, turn, role, text, present, again in _columns(batch, ["conv_key", "part", "conv_id", "turn", "role", "text", "present", "again"]):
                if now is None or (key, part) != now[:2]:
                    if now is not None:
                        close()
                    now, faults, cells, n = (key, part, conv), Faults(), [], 0
                if present:
                    faults.add(turn, role, text, again)
                    n += 1
                    if len(faults.rows) == SPAN:
                        cells.append(parse_rows("".join(faults.rows)))
                        faults.rows.clear()
                        if len(cells) == SPAN * SPAN:
                            cells = [parse_cells(cells)]
            yield from out.full()
        if now is not None:
            close()
        if out.rows:
            yield out.batch()

    return run


def _join_parts(conv_type: pa.DataType):
    """Per part, its slice of the conversation's audit; the report stands at the first part."""
    types = {"conv_key": pa.string(), "conv_id": conv_type, "part": pa.int32(), "slice": pa.string(), "last_part": pa.bool_()} | {n: t for n, t in _arrow(REPORT).items() if n not in ("audit", "repaired_sha256")}

    def run(table: pa.Table) -> pa.Table:
        parts = sorted(table.to_pylist(), key=lambda r: r["part"])
        total = Faults()
        for p in parts:
            more = Faults()
            if p["first"] is not None:
                more.first, more.last = (p["first"], p["first_turn"]), (p["last"], p["last_turn"])
                more.low, more.high = p["low"], p["high"]
                more.n = {c: p[c] for c in Faults.COUNTS}
            total.join(more)
        cells = [[None if c is None else (c, a) for c, a in zip(p["costs"], p["audits"])] for p in parts]
        cost, audit = best(parse_cells(cells))
        rows = np.flatnonzero(np.frombuffer(audit.encode(), dtype=np.uint8) != ord("I")) + 1  # ends of rows' letters
        out, done, at = _Out(types), 0, 0
        for i, p in enumerate(parts):
            done += p["n"]
            end = len(audit) if i == len(parts) - 1 else int(rows[done - 1]) if done else 0
            row = {"conv_key": p["conv_key"], "conv_id": p["conv_id"], "part": p["part"], "slice": audit[at:end], "last_part": i == len(parts) - 1, "cost": cost}
            out.rows.append(row | (total.report() if i == 0 else {}))
            at = end
        return pa.Table.from_batches([out.batch()])

    return run


def _stream(types: dict[str, pa.DataType], rows_wanted: bool):
    """Rows in order, each part's behind its slice of the audit (at -1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(types)
        key = fixed = None
        report: dict = {}
        audit, whole, at, last = "", [], 0, False

        def close() -> None:
            fixed.inserts(audit, at)
            if not rows_wanted:
                out.rows.append(report | {"kind": 0, "audit": "".join(whole), "repaired_sha256": fixed.hash.hexdigest()})

        names = ["conv_key", "conv_id", "at", "role", "text", "present", "slice", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
        for batch in batches:
            for conv_key, conv, place, role, text, present, piece, *counts in _columns(batch, names):
                if place < 0:
                    if conv_key != key:
                        if key is not None:
                            close()
                        key, whole = conv_key, []
                        report = {"conv_id": conv} | dict(zip(names[7:], counts))
                        fixed = Repaired((lambda r, c=conv: out.rows.append({"kind": 2, "conv_id": c} | r)) if rows_wanted else None)
                    else:
                        fixed.inserts(audit, at)
                    audit, at = piece, 0
                    whole.append(piece)
                elif present:
                    at = fixed.inserts(audit, at)
                    fixed.row(audit[at], role, text)
                    at += 1
                yield from out.full()
        if key is not None:
            close()
        if out.rows:
            yield out.batch()

    return run


def _repair(turns: DataFrame, present: str | None, rows_wanted: bool) -> DataFrame:
    spark = turns.sparkSession
    conv = turns.schema["conv_id"].dataType
    conv_sql = conv.simpleString()
    conv_arrow = to_arrow_type(conv)
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    there = F.lit(True) if present is None else F.coalesce(F.col(present), F.lit(True))
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), value("role"), value("text"), there.alias("present"))
    # equal rows are spread by a running number: any of them may stand first
    order = ["conv_id", "turn", "role", F.substring("text", 1, 64), F.xxhash64("text"), "present", F.pmod(F.monotonically_increasing_id(), F.lit(1024))]
    keyed = rows.select("*", *[c.alias(f"order{i}") for i, c in enumerate(order[3:5] + order[6:])])
    keys = ["conv_id", "turn", "role", "order0", "order1", "present", "order2"]
    ranges = keyed.repartitionByRange(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys).drop("order0", "order1", "order2")

    result = ROW + ", role string, text string" if rows_wanted else REPORT
    spec = f"kind int, conv_id {conv_sql}, " + LONG_ROW + ", " + (ROW if rows_wanted else REPORT)
    types = {"kind": pa.int32(), "conv_id": conv_arrow} | _arrow(LONG_ROW + ", " + (ROW if rows_wanted else REPORT))
    first = stage(ranges.mapInArrow(_in_ranges(types, rows_wanted), spec), "repair-ranges")
    wanted = ["conv_id", *(c.split()[0] for c in result.split(", "))]

    key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("conv_key")
    long = first.where("kind = 1").select(key, "conv_id", "turn", "role", "text", "present", "part", "at", F.xxhash64("role", "text").alias("h1"), F.xxhash64("text", "role").alias("h2"))
    place = F.struct("part", "at")
    seen = long.where("present").groupBy("conv_key", "h1", "h2").agg(F.min(place).alias("seen"), F.max(place).alias("last")).where("seen < last")
    seen = seen.select("conv_key", "h1", "h2", "seen", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    marked = long.withColumn("salt", F.pmod(F.col("at"), F.lit(SALTS)).cast("int")).join(seen, ["conv_key", "h1", "h2", "salt"], "left")
    marked = marked.withColumn("again", F.coalesce(place > F.col("seen"), F.lit(False)))
    n = shuffle_partitions(spark)
    in_parts = marked.select("conv_key", "part", "conv_id", "turn", "role", "text", "present", "again", "at").repartition(n, "conv_key", "part").sortWithinPartitions("conv_key", "part", "at")
    cells = in_parts.mapInArrow(_part_cells(conv_arrow), f"conv_key string, conv_id {conv_sql}, {PART}")
    counts = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
    slices = stage(cells.groupBy("conv_key").applyInArrow(_join_parts(conv_arrow), f"conv_key string, conv_id {conv_sql}, part int, slice string, last_part boolean, {counts}"), "repair-slices")
    heads = slices.withColumns({"at": F.lit(-1).cast("long"), "role": F.lit(None).cast("string"), "text": F.lit(None).cast("string"), "present": F.lit(True)})
    bodies = long.withColumns({"slice": F.lit(None).cast("string")} | {c.split()[0]: F.lit(None).cast("long") for c in counts.split(", ")})
    columns = ["conv_key", "conv_id", "part", "at", "role", "text", "present", "slice", *(c.split()[0] for c in counts.split(", "))]
    both = heads.select(*columns).unionByName(bodies.select(*columns)).repartition(n, "conv_key").sortWithinPartitions("conv_key", "part", "at")
    spec2 = f"kind int, conv_id {conv_sql}, {result}"
    types2 = {"kind": pa.int32(), "conv_id": conv_arrow} | _arrow(result)
    rest = both.mapInArrow(_stream(types2, rows_wanted), spec2)
    return first.where(f"kind = {2 if rows_wanted else 0}").select(*wanted).unionByName(rest.select(*wanted))


def repair_report(turns: DataFrame, present: str | None = None) -> DataFrame:
    """Per conversation: conv_id, gaps (missing turns), blank, duplicate, truncated (first fault
    of each row), illegal (neighbours out of order), cost, audit, repaired_sha256 (``role:text`` of
    the repaired rows, joined by newlines)."""
    return _repair(turns, present, False)


def repaired_turns(turns: DataFrame, present: str | None = None) -> DataFrame:
    """The repaired conversations: conv_id, seq (from 0), edit (K, R or I), role, text."""
    return _repair(turns, present, True)


def damaged(turns: DataFrame) -> DataFrame:
    """Rows with faults put in by crc32(``conv_id:turn``) mod 20 (a null is one space): 0 drops the row
    (``present`` is false), 1 empties its text, 2 takes .!? out of it, 3 repeats it, 4 makes it the user's."""
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.pmod(F.crc32(F.concat(value("conv_id"), F.lit(":"), value("turn")).cast("binary")), F.lit(20))
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), value("role").alias("role"), value("text").alias("text"), fault.alias("fault"))
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault").isin(0, 1), "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (F.col("fault") != 0).alias("present"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")
