"""Aggregates with a state that the caller writes: create, merge a value, merge two
states, finish.

Before the shuffle every task folds its rows into one state a key; what moves is a row
(key, state) a task and key. After it the states of a key are merged as they stream by.
A key with a third of all rows costs one state a task. The state is an Arrow
value of a declared type, so it is not tied to Python's pickles. Built-in aggregates
(``keyed``, ``rollups``) stay in the JVM; use this for a state they can't express.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Keys that a task holds before it sends their states on.
HELD_KEYS = 200_000


def _partial(create, merge_value, key: pa.DataType, state: pa.DataType, held: int):
    def frozen(x):
        """A key as something that a dictionary can hold."""
        if isinstance(x, dict):
            return tuple((k, frozen(v)) for k, v in x.items())
        return tuple(map(frozen, x)) if isinstance(x, list) else x

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict = {}
        value_of: dict = {}

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(value_of.values()), key), pa.array(list(states.values()), state)], names=["key", "state"])
            states.clear()
            value_of.clear()
            return out

        for batch in batches:
            for whole, v in zip(batch.column("key").to_pylist(), batch.column("args").to_pylist()):
                k, values = frozen(whole), v.values()
                if k in states:
                    states[k] = merge_value(states[k], *values)
                else:
                    states[k] = create(*values)
                    value_of[k] = whole
            if len(states) >= held:
                yield flush()
        if states:
            yield flush()

    return run


def _merged(merge_combiners, finish, key: pa.DataType, result: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = state = None
        keys, results = [], []

        def close() -> None:
            keys.append(now)
            results.append(finish(state) if finish else state)

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(keys, key), pa.array(results, result)], names=["key", "result"])
            keys.clear()
            results.clear()
            return out

        for batch in batches:
            for k, s in zip(batch.column("key").to_pylist(), batch.column("state").to_pylist()):
                s = tuple(s.values()) if isinstance(s, dict) else s
                if now is None or k != now:
                    if now is not None:
                        close()
                    now, state = k, s
                else:
                    state = merge_combiners(state, s)
            if len(keys) >= 5000:
                yield flush()
        if now is not None:
            close()
        if keys:
            yield flush()

    return run


def combine_by_key(
    df: DataFrame, keys: str | Sequence[str], values: str | Sequence[str], create: Callable, merge_value: Callable, merge_combiners: Callable,
    state: str, finish: Callable | None = None, result: str | None = None, name: str = "result", n_partitions: int | None = None, held_keys: int = HELD_KEYS,
) -> DataFrame:
    """One row per key: the key columns and ``name``.

    ``create(*values)`` makes a state of a key's first row, ``merge_value(state, *values)``
    adds a row, ``merge_combiners(a, b)`` joins two states (in any grouping, so it must be
    associative and commutative), ``finish(state)`` gives the result. ``state`` and ``result``
    are their types as DDL (``result`` defaults to ``state``); structs are
    tuples. A null key is a key; null values are passed as None."""
    names = [keys] if isinstance(keys, str) else list(keys)
    given = [values] if isinstance(values, str) else list(values)
    rows = df.select(F.struct(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(names)]).alias("key"), F.struct(*[F.col(f"`{v}`").alias(f"v{i}") for i, v in enumerate(given)]).alias("args"))
    key, state_type = rows.schema["key"].dataType, T.DataType.fromDDL(state)
    result_type = T.DataType.fromDDL(result) if result else state_type
    partial = rows.mapInArrow(_partial(create, merge_value, to_arrow_type(key), to_arrow_type(state_type), held_keys), T.StructType().add("key", key).add("state", state_type))
    n = n_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    together = partial.repartition(n, "key").sortWithinPartitions("key")
    done = together.mapInArrow(_merged(merge_combiners, finish, to_arrow_type(key), to_arrow_type(result_type)), T.StructType().add("key", key).add("result", result_type))
    return done.select(*[F.col(f"key.k{i}").alias(k) for i, k in enumerate(names)], F.col("result").alias(name))
