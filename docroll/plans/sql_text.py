"""The SQL jobs: SQL text over any DataFrames with the jobs' columns.

The inputs are passed to ``spark.sql`` as arguments, so a job reads Parquet,
JSON or delimited text alike and leaves the session's views alone.

Both statements aggregate orders per customer *before* the join (partial
aggregation then one exchange), so the join moves one row per customer and
description instead of one row per order, and a customer holding a third of
all orders costs one row per map task. The result is the same as grouping
after the join: unmatched orders fall into the null-customer group either way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from docroll.functions.scalars import MONEY_SCALE

# Customer id, name, siren, catch phrase and order description map to
# c_custkey, c_name, c_nationkey, c_mktsegment and o_orderpriority.
_GROUPS = """
SELECT c.c_custkey, c.c_name, c.c_nationkey, c.c_mktsegment, p.o_orderpriority, CAST(SUM(p.n) AS BIGINT) AS n
FROM {customers} c
RIGHT JOIN (SELECT o_custkey, o_orderpriority, COUNT(*) AS n
            FROM {orders} GROUP BY o_custkey, o_orderpriority) p
  ON c.c_custkey = p.o_custkey
GROUP BY c.c_custkey, c.c_name, c.c_nationkey, c.c_mktsegment, p.o_orderpriority
"""

# Ordered by name; the unique tie-breakers let the range-partitioned sort
# split a name shared by many customers across tasks.
_ORDERED = "SELECT * FROM {groups} ORDER BY c_name NULLS FIRST, c_custkey NULLS FIRST, o_orderpriority NULLS FIRST"

# {amount}: integers sum to integers, other amounts as exact decimals.
_NAME_SUMS = """
SELECT c.c_name, CAST(SUM(p.amount) AS {kind}) AS amount
FROM {customers} c
JOIN (SELECT o_custkey, SUM(CAST(o_totalprice AS {exact})) AS amount FROM {orders} GROUP BY o_custkey) p
  ON c.c_custkey = p.o_custkey
GROUP BY c.c_name
"""


def right_join_count(customers: DataFrame, orders: DataFrame, ordered: bool = False, view: str | None = None) -> DataFrame:
    """Per (customer, order description): order count; orders without a
    customer kept with null customer fields. ``view`` registers the result under
    that name; ``ordered`` sorts it by name (nulls first, unique tie-breakers), a
    range-partitioned global sort."""
    spark = orders.sparkSession
    groups = spark.sql(_GROUPS, customers=customers, orders=orders)
    if view:
        groups.createOrReplaceTempView(view)
    return spark.sql(_ORDERED, groups=groups) if ordered else groups


def inner_join_sum(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Order amount per customer name (namesakes merge, as in the SQL)."""
    whole = dict(orders.dtypes)["o_totalprice"] in ("tinyint", "smallint", "int", "bigint")
    kind, exact = ("BIGINT", "BIGINT") if whole else ("DOUBLE", f"DECIMAL({24 + MONEY_SCALE},{MONEY_SCALE})")
    text = _NAME_SUMS.replace("{kind}", kind).replace("{exact}", exact)
    return orders.sparkSession.sql(text, customers=customers, orders=orders)
