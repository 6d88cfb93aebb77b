"""Small keyed aggregates: counts, sums, user-defined mean, integer mean.

Each is a ``groupBy(...).agg(...)`` whose functions all have a partial
(map-side) form, so a key holding a third of the rows costs one buffer per
task before the shuffle and one row per task after it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cols(cs: str | Column | Sequence[str | Column]) -> list[Column]:
    if isinstance(cs, (str, Column)):
        cs = [cs]
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def count_by(df: DataFrame, keys: str | Column | Sequence[str | Column], name: str = "n") -> DataFrame:
    """Rows per key; a key may be a whole (nested) struct: structural equality."""
    return df.groupBy(*_cols(keys)).agg(F.count(F.lit(1)).alias(name))


def keyed_sum(df: DataFrame, key: str, value: str, name: str = "value") -> DataFrame:
    """Sum per key: the intent of the reference's keyed reduce."""
    return df.groupBy(key).agg(F.sum(value).alias(name))


def keyed_last_doubled(
    df: DataFrame, key: str, value: str, order_by: Sequence[str], name: str = "value"
) -> DataFrame:
    """The reference's literal reduce ``(a, b) => b doubled``, made deterministic.

    Folding rows r1..rn in ``order_by`` order gives r1 when n = 1, else
    2 * rn. ``max`` of a struct of the order columns and the value (the value
    last, as the final tie-breaker) picks rn with a partial aggregate and one
    buffer per key, no sort of the group.
    """
    last = F.max(F.struct(*[F.col(c) for c in order_by], F.col(value).alias("__v")))["__v"]
    return df.groupBy(key).agg(
        F.when(F.count(F.lit(1)) == 1, last).otherwise(last * 2).alias(name)
    )


def combine_mean(
    df: DataFrame, key: str, value: str, threshold: float = 10, key_name: str | None = None
) -> DataFrame:
    """create/merge/combine aggregate (sum, count) -> mean as float, sum,
    square of the sum, and ``sum > threshold``.

    The square is decimal(38,0): any bigint squared fits, where a 64-bit
    product would overflow.
    """
    s = F.sum(F.col(value).cast("long"))
    n = F.count(F.col(value))
    out = df.groupBy(F.col(key).alias(key_name or key)).agg(s.alias("sum"), n.alias("n"))
    wide = F.col("sum").cast("decimal(20,0)")
    return out.select(
        key_name or key,
        (F.col("sum") / F.col("n")).cast("float").alias("mean"),
        "sum",
        (wide * wide).cast("decimal(38,0)").alias("square"),
        (F.col("sum") > F.lit(threshold)).alias("above"),
    )


def global_int_mean(df: DataFrame, value: str, name: str = "mean") -> DataFrame:
    """Integer mean over all rows, truncating (``sum div count``); null when empty."""
    return df.agg(F.expr(f"sum(`{value}`) div count(`{value}`)").alias(name))


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    """Global row count as a one-row DataFrame (no driver round trip)."""
    return df.agg(F.count(F.lit(1)).alias(name))
