"""Joins whose large side loses its partnerless rows before the shuffle.

A Bloom filter of the small side's keys is built by a partial aggregate and
broadcast to the scan of the large side; the exact join stands behind it, so a
false hit costs one shuffled row and nothing else.

The filter is a table of blocks: (block, four words of 64 bits). A key falls
into one block by its hash and sets one bit in each word, so building is
``bit_or`` per block (a hot key is one row a map task) and a test is one lookup
by block. ``KEYS_PER_BLOCK`` keys a block let through about one absent key in
400. What is broadcast is bounded by ``MAX_BLOCKS`` rows whatever the keys
are; where there are more distinct keys than these blocks hold (measured, or
stated by the caller), no filter is made and the join runs as it is.

Null keys match nothing. Key columns must have the same type on both sides and
be integers, decimals, booleans, dates, timestamps, strings or binaries, whose equal
values have equal hashes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docroll.operators.rollups import order_rollup

KEYS_PER_BLOCK = 16
#: Rows of a filter (40 bytes each), hence 4 million keys.
MAX_BLOCKS = 1 << 18
WORDS = 4
BLOCK = "__filter_block"
WORD = [f"__filter_word{i}" for i in range(WORDS)]
#: Joins that drop the rows of the large (left) side without a partner.
CUTTING_JOINS = ("inner", "left_semi", "right")

_HASHED_ALIKE = (T.IntegralType, T.DecimalType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType, T.BinaryType)


@dataclass(frozen=True)
class KeyFilter:
    """A filter's blocks, their number and the types of the keys it holds."""

    blocks: DataFrame
    n_blocks: int
    types: tuple[T.DataType, ...]


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def _types(df: DataFrame, keys: Sequence[str]) -> tuple[T.DataType, ...]:
    types = tuple(df.schema[k].dataType for k in keys)
    for key, dtype in zip(keys, types):
        if not isinstance(dtype, _HASHED_ALIKE):
            raise ValueError(f"key {key} of type {dtype.simpleString()} can't be filtered by hash")
    return types


def _block(keys: Sequence[str], n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(n_blocks).cast("long"))


def _bits(keys: Sequence[str]) -> list[Column]:
    """The bit that the key sets in each word, from a second hash."""
    second = F.xxhash64(F.lit(1), *[F.col(f"`{k}`") for k in keys])
    return [F.shiftrightunsigned(second, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(WORDS)]


def _all_set(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys])


def key_filter(
    small: DataFrame, on: str | Sequence[str], expected_keys: int | None = None, max_blocks: int = MAX_BLOCKS
) -> KeyFilter | None:
    """The filter of the keys of ``small``; None if they need over ``max_blocks`` blocks.

    Without ``expected_keys`` one job counts the distinct keys approximately. A
    wrong number changes how many absent keys pass, never the joins' results.
    """
    keys = _keys(on)
    types = _types(small, keys)
    present = small.select(*[F.col(f"`{k}`") for k in keys]).where(_all_set(keys))
    if expected_keys is None:
        expected_keys = present.agg(F.approx_count_distinct(F.xxhash64(*[F.col(f"`{k}`") for k in keys]))).first()[0]
    n_blocks = max(1, -(-int(expected_keys) // KEYS_PER_BLOCK))
    if n_blocks > max_blocks:
        return None
    one = F.lit(1).cast("long")
    marks = [F.call_function("shiftleft", one, bit).alias(w) for w, bit in zip(WORD, _bits(keys))]
    blocks = present.select(_block(keys, n_blocks).alias(BLOCK), *marks).groupBy(BLOCK).agg(*[F.bit_or(w).alias(w) for w in WORD])
    return KeyFilter(blocks, n_blocks, types)


def _test(large: DataFrame, on: str | Sequence[str], kept: KeyFilter, how: str) -> DataFrame:
    keys = _keys(on)
    types = _types(large, keys)
    if types != kept.types:
        raise ValueError(f"key types differ: {[t.simpleString() for t in types]} and {[t.simpleString() for t in kept.types]}")
    hit = (_block(keys, kept.n_blocks) == F.col(BLOCK)) & _all_set(keys)
    for word, bit in zip(WORD, _bits(keys)):
        hit = hit & (F.getbit(F.col(word), bit) == 1)
    return large.join(F.broadcast(kept.blocks), hit, how)  # at most n_blocks rows


def may_match(large: DataFrame, on: str | Sequence[str], kept: KeyFilter) -> DataFrame:
    """The rows whose key may be among the filter's: every one that is, few others."""
    return _test(large, on, kept, "left_semi")


def cannot_match(large: DataFrame, on: str | Sequence[str], kept: KeyFilter) -> DataFrame:
    """The other rows; their key is surely not among the filter's (or null)."""
    return _test(large, on, kept, "left_anti")


def filtered_join(
    large: DataFrame, small: DataFrame, on: str | Sequence[str], how: str = "inner", expected_keys: int | None = None,
    max_blocks: int = MAX_BLOCKS,
) -> DataFrame:
    """``large.join(small, on, how)``, with ``large`` cut by the keys of ``small`` first."""
    if how not in CUTTING_JOINS:
        raise ValueError(f"how must be one of {CUTTING_JOINS}: other joins keep rows without a partner")
    kept = key_filter(small, on, expected_keys, max_blocks)
    cut = large if kept is None else may_match(large, on, kept)
    return cut.join(small, _keys(on), how)


def filtered_orphans(
    child: DataFrame, parent: DataFrame, child_on: str | Sequence[str], parent_on: str | Sequence[str] | None = None,
    expected_keys: int | None = None, max_blocks: int = MAX_BLOCKS,
) -> DataFrame:
    """``joins.orphans``: rows that the filter rejects are orphans at once; the
    others go to the anti-join. Pays where most children are orphans."""
    from docroll.operators.joins import orphans

    kept = key_filter(parent, parent_on if parent_on is not None else child_on, expected_keys, max_blocks)
    if kept is None:
        return orphans(child, parent, child_on, parent_on)
    rest = orphans(may_match(child, child_on, kept), parent, child_on, parent_on)
    return cannot_match(child, child_on, kept).unionByName(rest)


def filtered_order_rollup(
    lines: DataFrame, orders: DataFrame, line_order_key: str, order_key: str, amount: str, order_cols: Sequence[str] = (),
    expected_keys: int | None = None, max_blocks: int = MAX_BLOCKS,
) -> DataFrame:
    """``order_rollup`` for few orders: lines of other orders leave before they
    are aggregated and shuffled."""
    kept = key_filter(orders, order_key, expected_keys, max_blocks)
    cut = lines if kept is None else may_match(lines, line_order_key, kept)
    return order_rollup(cut, orders, line_order_key, order_key, amount, order_cols)
