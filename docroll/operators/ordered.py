"""Whole sorted results: global positions, and folds in a stated order.

Rows are range-partitioned and sorted on their keys, then written once (``ranges``), so
every later step sees the same ranges. What has to pass from one range to the next is one small
row a range: a count for positions, a state for folds. No row is numbered or folded in a
single task, and a key that holds a third of the rows spans as many ranges as its rows fill.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from docroll.session import stage


def _n_ranges(df: DataFrame, n: int | None) -> int:
    return n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _ranges(df: DataFrame, keys: Sequence[str], n: int | None) -> DataFrame:
    """Each row as a struct ``row``, in sorted ranges. Rows with equal keys are told apart by
    a hash of the whole row, so that very many of them still spread over ranges."""
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    order = [F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)]
    rows = df.select(F.struct("*").alias("row"), *order, F.xxhash64(*plain).alias("tie"))
    by = [*(f"k{i}" for i in range(len(keys))), "tie"]
    return rows.repartitionByRange(_n_ranges(df, n), *by).sortWithinPartitions(*by)


def with_positions(df: DataFrame, keys: Sequence[str], name: str = "position", n_ranges: int | None = None) -> DataFrame:
    """The rows of ``df`` with their position (from 1) in the order of ``keys``
    (nulls first; equal keys by the hash of the row): ``sortByKey`` as a whole, numbered.

    A row's position is its place within its range plus the rows of the ranges before, of
    which there are at most ``n_ranges`` counts."""
    if name in df.columns:
        raise ValueError(f"column {name} exists")
    # an id of this kind is the partition's number and, in the low 33 bits, the row's place in it
    placed = stage(_ranges(df, keys, n_ranges).select("row", F.monotonically_increasing_id().alias("id")), "sorted-ranges")
    placed = placed.select("row", F.shiftright("id", 33).alias("range"), F.col("id").bitwiseAND((1 << 33) - 1).alias("at"))
    counts = placed.groupBy("range").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("range", before.alias("before"))  # a row a range
    return placed.join(F.broadcast(starts), "range").select("row.*", (F.col("before") + F.col("at") + 1).alias(name))


def write_sorted(df: DataFrame, keys: Sequence[str], target: str, n_ranges: int | None = None, mode: str = "overwrite") -> None:
    """Parquet files that lie in the order of ``keys``, by name and within each file."""
    _ranges(df, keys, n_ranges).select("row.*").write.mode(mode).parquet(target)


# --- folds ----------------------------------------------------------------------


def _fold_ranges(n_keys: int, init, step, lift, compose, state: pa.DataType, summary: pa.DataType, key: pa.DataType, row: pa.DataType):
    """Folds the keys that begin in a range. The rows of its first key, which may have
    begun before, stay open (``open``); at the end comes one row about the range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        first = last = now = acc = None
        seen = opened = 0
        alone = True  # one key so far
        names = ["kind", "range", "at", "key", "row", "args", "open", "state", "summary", "first"]

        def out(kind, at, keys, rows, args, is_open, states, sums=None, firsts=None, args_type=None):
            n = len(at)
            return pa.RecordBatch.from_arrays(
                [pa.array([kind] * n, pa.int32()), pa.array([part] * n, pa.int32()), pa.array(at, pa.int64()), keys, rows, args, pa.array(is_open, pa.bool_()), pa.array(states, state),
                 pa.array(sums or [None] * n, summary), pa.array(firsts or [None] * n, key)], names=names)

        args_type = None
        for batch in batches:
            args_type = batch.column("args").type
            states, is_open = [], []
            for k, a in zip(batch.column("key").to_pylist(), batch.column("args").to_pylist()):
                if not seen:
                    first = last = k
                elif k != last:
                    alone, last, now = False, k, init
                seen += 1
                values = tuple(a.values())
                if alone:
                    opened += 1
                    if lift is not None:
                        acc = lift(*values) if acc is None else compose(acc, lift(*values))
                else:
                    now = step(now, *values)
                states.append(None if alone else now)
                is_open.append(alone)
            n = batch.num_rows
            if n:
                yield out(0, list(range(seen - n, seen)), batch.column("key"), batch.column("row"), batch.column("args"), is_open, states)
        if seen:
            yield out(1, [seen], pa.array([last], key), pa.nulls(1, row), pa.nulls(1, args_type), [alone], [now], [acc], [first])

    return run


def _fold_open(starts, step, state: pa.DataType):
    """The open rows of ranges, in order, from the states that ``starts`` has for the ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = starts.value
        part = now = None
        for batch in batches:
            states = []
            for r, a in zip(batch.column("range").to_pylist(), batch.column("args").to_pylist()):
                if r != part:
                    part, now = r, known[r]
                now = step(now, *a.values())
                states.append(now)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("range", "at", "key", "row")), pa.array(states, state)], names=["range", "at", "key", "row", "state"])

    return run


def _folded(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str], state: str, init, step: Callable,
    lift: Callable | None, compose: Callable | None, apply: Callable | None, summary: str | None, n_ranges: int | None,
) -> DataFrame:
    """Rows (range, at, key, row, state)."""
    spark = df.sparkSession
    state_type, sum_type = T.DataType.fromDDL(state), T.DataType.fromDDL(summary or "int")
    key = F.struct(*[F.col(f"row.`{k}`").alias(f"k{i}") for i, k in enumerate(keys)])
    args = F.struct(*[F.col(f"row.`{v}`").alias(f"v{i}") for i, v in enumerate(values)])
    rows = _ranges(df, [*keys, *order], n_ranges).select(key.alias("key"), "row", args.alias("args"))
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    schema = (T.StructType().add("kind", "integer").add("range", "integer").add("at", "long").add("key", kinds["key"]).add("row", kinds["row"]).add("args", kinds["args"])
              .add("open", "boolean").add("state", state_type).add("summary", sum_type).add("first", kinds["key"]))
    arrow = [to_arrow_type(t) for t in (state_type, sum_type, kinds["key"], kinds["row"])]
    table = stage(rows.mapInArrow(_fold_ranges(len(keys), init, step, lift, compose, *arrow), schema), "fold-ranges")
    ends = table.where("kind = 1").select("range", "first", "key", "open", "state", "summary").orderBy("range").collect()  # a row a range
    columns = ["range", "at", "key", "row", "state"]
    parts = [table.where("kind = 0 AND NOT open").select(*columns)]
    open_rows = table.where("kind = 0 AND open").select("range", "at", "key", "row", "args")
    out_schema = T.StructType().add("range", "integer").add("at", "long").add("key", kinds["key"]).add("row", kinds["row"]).add("state", state_type)

    def settle(starts: dict) -> DataFrame:
        wanted = open_rows.where(F.col("range").isin(list(starts))) if len(starts) < len(ends) else open_rows
        placed = wanted.repartition(min(len(starts), _n_ranges(df, n_ranges)), "range").sortWithinPartitions("range", "at")
        return placed.mapInArrow(_fold_open(spark.sparkContext.broadcast(starts), step, arrow[0]), out_schema)

    def plain(x):
        return tuple(x) if isinstance(x, T.Row) else x

    begin: dict = {}  # the state before each range's open rows
    left: dict = {}  # the state behind each range
    wait: list[tuple[int, int | None]] = []
    before = None
    for e in ends:
        goes_on = before is not None and before.key == e.first
        if not e.open:
            left[e.range] = plain(e.state)
        wait.append((e.range, before.range if goes_on else None))
        before = e
    of = {e.range: e for e in ends}
    while wait:
        ready = {}
        for r, previous in wait:
            if previous is None or previous in left:
                ready[r] = init if previous is None else left[previous]
                if lift is not None and of[r].open:  # the whole range in one piece
                    left[r] = apply(plain(of[r].summary), ready[r])
        wait = [w for w in wait if w[0] not in ready]
        begin.update(ready)
        if lift is None:  # without summaries, a key that spans ranges goes from range to range
            got = settle(ready)
            if wait:
                got = stage(got, "fold-open")
                for x in got.where(F.col("range").isin([r for r in ready if of[r].open])).groupBy("range").agg(F.max_by("state", "at").alias("state")).collect():
                    left[x["range"]] = plain(x["state"])
            parts.append(got)
    if lift is not None and begin:
        parts.append(settle(begin))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def running_fold(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str], state: str, init, step: Callable,
    name: str = "state", lift: Callable | None = None, compose: Callable | None = None, apply: Callable | None = None,
    summary: str | None = None, n_ranges: int | None = None,
) -> DataFrame:
    """Each row of ``df`` with the state (of type ``state``) after it: ``step(state, *values)``
    from ``init`` over a key's rows in ``order``; any step, associative or not.

    A key that spans ranges is folded range after range, each in its own task. If a run of
    rows can be summarised, give ``lift(*values)``, ``compose(earlier, later)`` and
    ``apply(summary, state)`` with the summary's type: then all ranges are folded at once,
    whatever their keys. The functions run in Python and must not keep state of their own.
    Structs are passed and returned as tuples."""
    if name in df.columns:
        raise ValueError(f"column {name} exists")
    got = _folded(df, keys, order, values, state, init, step, lift, compose, apply, summary, n_ranges)
    return got.select("row.*", F.col("state").alias(name))


def fold_by_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str], state: str, init, step: Callable,
    name: str = "state", lift: Callable | None = None, compose: Callable | None = None, apply: Callable | None = None,
    summary: str | None = None, n_ranges: int | None = None,
) -> DataFrame:
    """One row per key: the state after its last row; see ``running_fold``."""
    got = _folded(df, keys, order, values, state, init, step, lift, compose, apply, summary, n_ranges)
    last = got.groupBy("key").agg(F.max_by("state", F.struct("range", "at")).alias("state"))
    return last.select(*[F.col(f"key.k{i}").alias(k) for i, k in enumerate(keys)], F.col("state").alias(name))
