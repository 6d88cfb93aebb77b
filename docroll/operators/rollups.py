"""Order and customer rollups (the README job without the stores).

Plan shape, per input one exchange:
  lines --partial agg--> exchange(order key) --final agg--+
                                                          +-- join (reuses the
  orders --------------> exchange(order key) ------------+    aggregate's partitioning)
Partial aggregation makes a hot order key cost one row per map task in the
shuffle, so skew in the child table does not reach the join.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docroll.functions.scalars import (
    REFERENCE_BUCKET_THRESHOLDS,
    REFERENCE_CUTOFF,
    bucket,
    exact_sum,
    ts_literal,
)


def order_rollup(
    lines: DataFrame,
    orders: DataFrame,
    line_order_key: str,
    order_key: str,
    amount: str,
    order_cols: Sequence[str] = (),
) -> DataFrame:
    """Sum and count of lines per order, inner-joined with the orders.

    Orders without lines are absent, as in the reference (``join`` after
    ``reduceByKey``). Output: order_key, *order_cols, total, n_lines.
    """
    stats = lines.groupBy(F.col(line_order_key).alias(order_key)).agg(
        exact_sum(lines, amount).alias("total"),
        F.count(F.lit(1)).alias("n_lines"),
    )
    wanted = [order_key, *[c for c in order_cols if c != order_key]]
    return stats.join(orders.select(*wanted), order_key, "inner").select(
        *wanted, "total", "n_lines"
    )


def customer_rollup(
    orders_rolled: DataFrame,
    customers: DataFrame,
    customer_key: str,
    order_customer_key: str,
    date_col: str,
    customer_cols: Sequence[str] = (),
    cutoff: str | _dt.date | _dt.datetime = REFERENCE_CUTOFF,
    thresholds: Sequence[float] = REFERENCE_BUCKET_THRESHOLDS,
    total_col: str = "total",
) -> DataFrame:
    """Per customer: total of orders strictly after ``cutoff``, count, max, avg, bucket.

    ``avg`` divides the conditional total by the count of *all* orders and
    ``max`` is over all orders, as in the reference. Customers without orders
    are absent (inner join). Output: customer_key, *customer_cols, total,
    n_orders, avg, max, bucket.
    """
    dtype = orders_rolled.schema[date_col].dataType
    after = F.col(date_col) > ts_literal(cutoff, dtype)
    stats = (
        orders_rolled.groupBy(F.col(order_customer_key).alias(customer_key))
        .agg(
            exact_sum(orders_rolled, total_col, where=after).alias("total"),
            F.count(F.lit(1)).alias("n_orders"),
            F.max(total_col).alias("max"),
        )
        .withColumn("avg", F.col("total") / F.col("n_orders"))
    )
    wanted = [customer_key, *[c for c in customer_cols if c != customer_key]]
    return (
        stats.join(customers.select(*wanted), customer_key, "inner")
        .withColumn("bucket", bucket("total", thresholds))
        .select(*wanted, "total", "n_orders", "avg", "max", "bucket")
    )


def bucket_counts(rolled: DataFrame, bucket_col: str = "bucket") -> DataFrame:
    """Customers per bucket."""
    return rolled.groupBy(bucket_col).agg(F.count(F.lit(1)).alias("n_customers"))


def sorted_head(df: DataFrame, keys: Sequence[str], n: int = 100) -> DataFrame:
    """First ``n`` rows by key (``sortByKey().take(n)``): a top-k, not a full sort.

    Planned as ``TakeOrderedAndProject``: each task keeps its own n best rows,
    so only n rows per task reach the final merge. Add a unique tie-breaker to
    ``keys`` for a deterministic head.
    """
    return df.orderBy(*keys).limit(n)
