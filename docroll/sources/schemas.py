"""Named positional layouts for ``;``-separated files.

A layout belongs to a job, not to a file name: the same entity is read with
different column positions by different jobs. A layout is a list of
(position, name, type); positions not listed are skipped.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import types as T

_TYPES = {
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampNTZType(),
    "timestamp_ltz": T.TimestampType(),
    "date": T.DateType(),
}


@dataclass(frozen=True)
class Layout:
    name: str
    fields: tuple[tuple[int, str, str], ...]
    ts_format: str = "yyyy-MM-dd'T'HH:mm:ss"

    @property
    def width(self) -> int:
        """Fields a line must have (the highest position used, plus one)."""
        return max(p for p, _, _ in self.fields) + 1

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, _TYPES[t], True) for _, n, t in self.fields])


def text_keyed(layout: Layout) -> Layout:
    """The layout with its id fields kept as text, for matching keys as text."""
    fields = tuple((p, n, "string" if n.endswith("Id") else t) for p, n, t in layout.fields)
    return replace(layout, name=f"{layout.name}_text", fields=fields)


def layout_of(name: str, schema: T.StructType) -> Layout:
    """A layout with one position per column of a schema, in column order."""
    back = {type(v): k for k, v in _TYPES.items()}
    return Layout(
        name,
        tuple((i, f.name, back[type(f.dataType)]) for i, f in enumerate(schema.fields)),
    )


def _layout(name: str, spec: Sequence[tuple[int, str, str]]) -> Layout:
    return Layout(name, tuple(spec))


# Fixed values that must equal the reference's: file layouts per job,
# (position, field, type), in natural position order.
LAYOUTS: dict[str, Layout] = {
    layout.name: layout
    for layout in [
        _layout("customer_join", [(0, "customerId", "int"), (1, "name", "string"), (2, "catchPhrase", "string"), (3, "siren", "string")]),
        _layout("customer_short", [(0, "customerId", "int"), (1, "name", "string")]),
        _layout("customer_sql", [(0, "customerId", "int"), (1, "name", "string"), (2, "catchPhrase", "string"), (3, "siren", "string")]),
        _layout("contact", [(0, "contactId", "int"), (1, "customerId", "int"), (2, "firstName", "string"), (3, "lastName", "string"), (4, "email", "string"), (5, "tel", "string"), (6, "avatar", "string")]),
        _layout("contact_typed", [(0, "contactId", "int"), (1, "customerId", "int"), (2, "firstName", "string"), (3, "lastName", "string"), (4, "email", "string"), (5, "tel", "string"), (6, "avatar", "string"), (7, "type", "string")]),
        _layout("order_join", [(0, "orderId", "int"), (1, "customerId", "int"), (2, "orderName", "string"), (3, "createdDate", "timestamp"), (4, "updatedDate", "timestamp"), (5, "shippedDate", "timestamp")]),
        _layout("order_short", [(0, "orderId", "int"), (1, "customerId", "int"), (2, "orderName", "string")]),
        _layout("order_rollup", [(0, "orderId", "int"), (1, "customerId", "int"), (2, "orderType", "string"), (3, "orderName", "string"), (4, "date", "timestamp")]),
        _layout("order_sql", [(0, "orderId", "int"), (1, "customerId", "int"), (2, "description", "string"), (3, "amount", "int")]),
        _layout("order_line_join", [(0, "orderLineId", "int"), (1, "orderId", "int"), (2, "name", "string"), (3, "desc", "string"), (4, "cat", "string"), (5, "quantity", "int"), (6, "unitPrice", "double"), (7, "lineAmount", "int")]),
        _layout("order_line_short", [(0, "orderLineId", "int"), (1, "orderId", "int"), (3, "lineAmount", "double")]),
        _layout("order_line_rollup", [(0, "orderLineId", "int"), (1, "orderId", "int"), (7, "amount", "double")]),
        _layout("car", [(0, "year", "int"), (1, "make", "string"), (2, "model", "string"), (3, "desc", "string"), (4, "price", "double")]),
    ]
}
