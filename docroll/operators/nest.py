"""Nest child rows into documents per parent key (cogroup re-expressed).

The reference cogroups parent and children and walks the groups in Scala.
Here each child is aggregated on its own first (``collect_list`` of a
struct, sorted so the list order is deterministic), then left-joined from the
parent; parents without children get an empty list. Aggregating before the
join avoids both the fan-out of joining two children at once and the
``[{null}]`` item a left join would put in an empty group.

Pages. A parent may own a third of all child rows, so its list is never built
in one row. One rule holds for every parent, whatever its size: items stand in
the order (bucket, item), where the bucket is a fixed function of the item's
first field (``bucket_of``), and page p holds the items whose running weight
ends in (p * page_size, (p + 1) * page_size]. An item weighs 1 by default, so
this is rank - 1 div page_size. A document is one page (``part``, of ``parts``) with
the parent's fields, the whole parent's totals, and page p of every child list.
Pages depend on the rows' values alone.

The running weight needs no task that sees a whole parent: weights are summed
per (parent, bucket) by a partial aggregate, a running sum over a parent's
buckets (at most ``BUCKETS`` rows) gives where each bucket begins, and a window per
(parent, bucket) places the items. Documents are joined on (key, part), so the
pages of one parent land in different tasks.

``page_size=None`` asks for one document per parent, however large: one
aggregate and one join per child.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docroll.functions.scalars import exact_sum, exact_sum_in_parts

#: Items (or weight) of one page.
PAGE_SIZE = 10_000
#: Buckets that a parent's items are placed in.
BUCKETS = 64

PART = "part"
PARTS = "parts"


@dataclass(frozen=True)
class Child:
    """One child collection of a document.

    ``fields`` are the list item's fields; lists are sorted by them in order,
    so put a unique id first. ``aggs`` are aggregate columns over all of a
    parent's children (whole parent, on every page); ``sums`` are exact sums of
    columns of ``df`` by name, which come with the bucket sums and need no
    aggregate and join of their own; ``fill`` gives the value of either for a
    parent without children. ``weight`` (default 1 per item, and at most
    the page size) is what ``page_size`` bounds: weigh items that carry lists of
    their own by what they hold. ``count_as`` names the whole parent's count,
    ``held_as`` the count of items on the page.
    """

    df: DataFrame
    on: str | Sequence[str]
    into: str
    fields: Sequence[str | Column]
    count_as: str | None = None
    aggs: Mapping[str, Column] = field(default_factory=dict)
    sums: Mapping[str, str] = field(default_factory=dict)
    fill: Mapping[str, Any] = field(default_factory=dict)
    weight: Column | None = None
    held_as: str | None = None


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def bucket_of(item: Column, dtype: T.DataType) -> Column:
    """The bucket of an item's first field: an integer modulo ``BUCKETS``, the
    CRC-32 of other values' text modulo ``BUCKETS``, 0 for a null."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        value = item
    else:
        value = F.crc32(item.cast("string").cast("binary"))
    return F.coalesce(F.pmod(value, F.lit(BUCKETS)).cast("int"), F.lit(0))


def _stat_exprs(child: Child) -> list[Column]:
    out = [a.alias(n) for n, a in child.aggs.items()]
    out += [exact_sum(child.df, c).alias(n) for n, c in child.sums.items()]
    if child.count_as:
        out.insert(0, F.count(F.lit(1)).alias(child.count_as))
    return out


def _prepared(child: Child, keys: list[str]) -> DataFrame:
    ck = _keys(child.on)
    if len(ck) != len(keys):
        raise ValueError(f"child key {ck} does not match parent key {keys}")
    return child.df.withColumns({k: F.col(src) for k, src in zip(keys, ck)})


def _list_exprs(child: Child, item: Column) -> list[Column]:
    out = [F.sort_array(F.collect_list(item)).alias(child.into)]
    if child.held_as:
        out.append(F.count(F.lit(1)).alias(child.held_as))
    return out


def _item(child: Child) -> Column:
    return F.struct(*[F.col(f) if isinstance(f, str) else f for f in child.fields])


def _paged(child: Child, c: DataFrame, keys: list[str], page_size: int) -> tuple[DataFrame, DataFrame]:
    """(keys, totals, __pages) per parent and (keys, __part, list) per page."""
    weight = F.lit(1) if child.weight is None else F.least(F.greatest(child.weight, F.lit(1)), F.lit(page_size))
    c = c.withColumns({"__w": weight.cast("long"), "__item": _item(child)})
    first = c.schema["__item"].dataType.fields[0]
    c = c.withColumn("__bucket", bucket_of(F.col("__item").getField(first.name), first.dataType))
    in_parts = {n: exact_sum_in_parts(child.df, column, n) for n, column in child.sums.items()}
    sums = c.groupBy(*keys, "__bucket").agg(F.sum("__w").alias("__sum"), F.count(F.lit(1)).alias("__n"), *[p for parts, _ in in_parts.values() for p in parts])
    earlier = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    begins = sums.withColumn("__begin", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)))
    # per parent on the window's own partitioning
    pages = F.ceil(F.max(F.col("__begin") + F.col("__sum")) / F.lit(page_size)).cast("int").alias("__pages")
    count = [F.sum("__n").alias(child.count_as)] if child.count_as else []
    totals = begins.groupBy(*keys).agg(pages, *count, *[whole.alias(n) for n, (_, whole) in in_parts.items()])
    if child.aggs:
        totals = totals.join(c.groupBy(*keys).agg(*[a.alias(n) for n, a in child.aggs.items()]), keys)
    upto = Window.partitionBy(*keys, "__bucket").orderBy("__item").rowsBetween(Window.unboundedPreceding, 0)
    placed = c.select(*keys, "__bucket", "__item", "__w").join(begins.select(*keys, "__bucket", "__begin"), [*keys, "__bucket"])
    end = F.col("__begin") + F.sum("__w").over(upto)
    placed = placed.withColumn("__part", F.floor((end - 1) / F.lit(page_size)).cast("int"))
    return totals, placed.groupBy(*keys, "__part").agg(*_list_exprs(child, F.col("__item")))


def _filled(df: DataFrame, child: Child, list_type: T.DataType) -> DataFrame:
    fills: dict[str, Column] = {child.into: F.coalesce(F.col(child.into), F.array().cast(list_type))}
    for name in (child.count_as, child.held_as):
        if name:
            fills[name] = F.coalesce(F.col(name), F.lit(0).cast("long"))
    for name, value in child.fill.items():
        fills[name] = F.coalesce(F.col(name), F.lit(value))
    return df.withColumns(fills)


def _out_columns(child: Child) -> list[str]:
    named = [child.count_as] if child.count_as else []
    held = [child.held_as] if child.held_as else []
    return named + list(child.aggs) + list(child.sums) + held + [child.into]


def nest(
    parent: DataFrame,
    on: str | Sequence[str],
    children: Sequence[Child],
    page_size: int | None = PAGE_SIZE,
    one_per_key: bool = False,
) -> DataFrame:
    """Documents: parent columns, then per child its count, aggregates and
    sorted list, then ``part`` and ``parts``.

    Children whose key has no parent are not in any document (see
    ``joins.orphans`` for the report). ``one_per_key`` keeps one parent row per
    key, the smallest (``joins.first_per_key``), as the reference keeps one;
    its aggregate shares the join's key partitioning.
    """
    parent_keys = _keys(on)
    if one_per_key:
        from docroll.operators.joins import first_per_key

        parent = first_per_key(parent, parent_keys, [])
    # Joins run on reserved key columns so child fields may reuse key names.
    keys = [f"__k{i}" for i in range(len(parent_keys))]
    out = [*parent.columns, *(c for ch in children for c in _out_columns(ch))]
    docs = parent.withColumns({k: F.col(src) for k, src in zip(keys, parent_keys)})
    prepared = [(ch, _prepared(ch, keys)) for ch in children]
    if page_size is None:
        for ch, c in prepared:
            lists = c.groupBy(*keys).agg(*_list_exprs(ch, _item(ch)), *_stat_exprs(ch))
            docs = _filled(docs.join(lists, keys, "left"), ch, lists.schema[ch.into].dataType)
        return docs.select(*out, F.lit(0).alias(PART), F.lit(1).alias(PARTS))

    paged = [(ch, *_paged(ch, c, keys, page_size)) for ch, c in prepared]
    docs = docs.withColumn("__parts", F.lit(1))
    for _, totals, _ in paged:
        docs = docs.join(totals, keys, "left").withColumn("__parts", F.greatest("__parts", "__pages")).drop("__pages")
    docs = docs.withColumn("__part", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)))
    for ch, _, lists in paged:
        docs = _filled(docs.join(lists, [*keys, "__part"], "left"), ch, lists.schema[ch.into].dataType)
    return docs.select(*out, F.col("__part").alias(PART), F.col("__parts").alias(PARTS))


def group_documents(child: Child, page_size: int | None = PAGE_SIZE) -> DataFrame:
    """Documents per group of ``child.on``: the key columns, the group's count
    and aggregates, its sorted list, ``part`` and ``parts``.

    The groups are the parents, so there is no parent table to join. A null
    key is one group of its own (the key is carried as one struct, which joins
    to itself).
    """
    source, key = _keys(child.on), "__k0"
    keyed = child.df.withColumn(key, F.struct(*[F.col(k) for k in source]))
    inner = replace(child, df=keyed, on=key)
    names = [F.col(f"{key}.{k}").alias(k) for k in source]
    if page_size is None:
        docs = keyed.groupBy(key).agg(*_list_exprs(inner, _item(inner)), *_stat_exprs(inner))
        return docs.select(*names, *_out_columns(child), F.lit(0).alias(PART), F.lit(1).alias(PARTS))
    totals, lists = _paged(inner, keyed, [key], page_size)
    docs = lists.join(totals, key)
    return docs.select(*names, *_out_columns(child), F.col("__part").alias(PART), F.col("__pages").alias(PARTS))


def list_total(
    items: Column | str, value: Callable[[Column], Column], zero: Column | None = None
) -> Column:
    """Sum of ``value(item)`` over a list column (higher-order, no explode)."""
    arr = F.col(items) if isinstance(items, str) else items
    start = zero if zero is not None else F.lit(0).cast("long")
    return F.aggregate(arr, start, lambda acc, x: acc + value(x))
