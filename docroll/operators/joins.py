"""Key checks around joins: orphans, one parent per key, text vs int keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ORPHAN_POLICIES = ("report", "drop", "fail")


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def orphans(
    child: DataFrame,
    parent: DataFrame,
    child_on: str | Sequence[str],
    parent_on: str | Sequence[str] | None = None,
) -> DataFrame:
    """Child rows whose key has no parent (a null key never has one).

    The reference fails on such rows (``head`` of an empty group); here they
    are a report: one anti-join with the parent's keys, evaluated when the
    report is.
    """
    ck = _keys(child_on)
    names = [f"__ok{i}" for i in range(len(ck))]
    keys = parent.select(*[F.col(p).alias(n) for p, n in zip(_keys(parent_on) if parent_on is not None else ck, names)])
    return child.join(keys, [child[c] == keys[n] for c, n in zip(ck, names)], "left_anti")


def check_orphans(
    child: DataFrame,
    parent: DataFrame,
    child_on: str | Sequence[str],
    parent_on: str | Sequence[str] | None = None,
    policy: str = "report",
) -> DataFrame | None:
    """Apply an orphan policy: ``report`` returns the orphan rows, ``drop``
    returns None (nesting from the parent drops them), ``fail`` raises when
    any exists (one action that stops at the first orphan found)."""
    if policy not in ORPHAN_POLICIES:
        raise ValueError(f"policy must be one of {ORPHAN_POLICIES}")
    report = orphans(child, parent, child_on, parent_on)
    if policy == "report":
        return report
    if policy == "fail" and not report.isEmpty():
        raise ValueError("child rows without a parent key")
    return None


def first_per_key(df: DataFrame, on: str | Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by ``order_by``, then by the other columns.

    A single ``min`` over one struct (order columns first, then the rest of
    the row) is a partial aggregate: a duplicated key costs one buffered row
    per task, never a list of the group, and ties are broken by the
    whole row, so the pick is deterministic.
    """
    keys = _keys(on)
    order = [c for c in order_by if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    row = F.min(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest])).alias("__row")
    return df.groupBy(*keys).agg(row).select(*keys, "__row.*").select(*df.columns)


def key_match_counts(
    child: DataFrame,
    parent: DataFrame,
    child_key: str,
    parent_key: str,
    as_type: str = "long",
) -> DataFrame:
    """Matches of text keys compared as text and compared as numbers.

    ``'01'`` and ``'1'`` differ as text and match as ints. One row:
    n_text, n_typed. Each side is first counted per key (partial
    aggregates, so a hot key is one row per task), then the counts are joined
    and ``n_child * n_parent`` summed: the number of matching row pairs,
    without moving the rows. Text that is not a number never matches as a
    number.
    """

    def per_key(df: DataFrame, key: str, typed: bool, side: str) -> DataFrame:
        k = F.col(key).cast("string")
        k = k.try_cast(as_type) if typed else k
        return df.groupBy(k.alias("__k")).agg(F.count(F.lit(1)).alias(side))

    def matches(typed: bool) -> DataFrame:
        c = per_key(child, child_key, typed, "__nc")
        p = per_key(parent, parent_key, typed, "__np")
        return c.join(p, "__k", "inner").select(
            F.lit("typed" if typed else "text").alias("__kind"), (F.col("__nc") * F.col("__np")).alias("__pairs")
        )

    both = matches(False).unionByName(matches(True))
    return both.agg(
        F.coalesce(F.sum(F.when(F.col("__kind") == "text", F.col("__pairs"))), F.lit(0).cast("long")).alias("n_text"),
        F.coalesce(F.sum(F.when(F.col("__kind") == "typed", F.col("__pairs"))), F.lit(0).cast("long")).alias("n_typed"),
    )
