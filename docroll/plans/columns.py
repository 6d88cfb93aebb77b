"""Which input columns feed which document fields.

The document jobs name their fields once; a ``Columns`` says where an input
carries them. A field whose columns an input lacks is left out of the
documents, except for the keys and amounts that the jobs work on.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

Names = Mapping[str, str | tuple[str, ...]]


@dataclass(frozen=True)
class Columns:
    """Per entity: document field -> input column (or the candidates, the first
    that exists counts), in document order."""

    customer: Names
    order: Names
    line: Names
    contact: Names

    def found(self, entity: str, df: DataFrame, required: tuple[str, ...] = ()) -> dict[str, str]:
        """The fields of an entity that ``df`` has, with their columns."""
        out = {}
        for field, source in getattr(self, entity).items():
            names = (source,) if isinstance(source, str) else source
            column = next((c for c in names if c in df.columns), None)
            if column:
                out[field] = column
        missing = [f for f in required if f not in out]
        if missing:
            raise ValueError(f"{entity} input has no column for {', '.join(missing)}")
        return out


#: The driver's tables: customer, orders, lineitem, and events as contacts.
TABLE_COLUMNS = Columns(
    customer={"id": "c_custkey", "name": "c_name", "catchPhrase": "c_mktsegment", "siren": "c_nationkey"},
    order={"id": "o_orderkey", "customerId": "o_custkey", "orderDescription": "o_orderpriority", "orderType": "o_orderstatus", "createDate": "o_orderdate"},
    line={
        "id": "l_linenumber", "partId": "l_partkey", "suppId": "l_suppkey", "orderId": "l_orderkey", "quantity": "l_quantity",
        "amount": "l_extendedprice", "returnFlag": "l_returnflag", "lineStatus": "l_linestatus",
    },
    contact={"id": "event_id", "customerId": "user_id", "type": "event_type", "at": "ts", "value": "value"},
)

#: The delimited layouts of ``sources.schemas.LAYOUTS``.
LAYOUT_COLUMNS = Columns(
    customer={"id": "customerId", "name": "name", "catchPhrase": "catchPhrase", "siren": "siren"},
    order={
        "id": "orderId", "customerId": "customerId", "orderDescription": ("orderName", "description"), "orderType": "orderType",
        "createDate": ("createdDate", "date"), "updateDate": "updatedDate", "shipDate": "shippedDate",
    },
    line={
        "id": "orderLineId", "orderId": "orderId", "name": "name", "description": "desc", "category": "cat", "quantity": "quantity",
        "unitPrice": "unitPrice", "amount": ("amount", "lineAmount"),
    },
    contact={
        "id": "contactId", "customerId": "customerId", "firstName": "firstName", "lastName": "lastName", "email": "email",
        "phone": "tel", "avatar": "avatar", "type": "type",
    },
)
