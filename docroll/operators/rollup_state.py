"""A kept order rollup: added lines and orders update it without the earlier ones.

The state is a keyed set (``sinks.keyed``) with a row per order key: the exact sum of the amounts,
whether one was NaN, the number of lines, and the order's own columns once it is known. All of these
merge in any order, so lines may come before their order and late ones count. Customer rollups are
made from the state, which has a row an order, not from the lines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docroll.functions.scalars import MONEY_SCALE
from docroll.sinks.keyed import BUCKETS, merge_by_key, read_keyed

_SUM = f"decimal(38,{MONEY_SCALE})"


def add_to_order_state(
    target: str, lines: DataFrame, orders: DataFrame, line_order_key: str, order_key: str, amount: str,
    order_cols: Sequence[str] = (), batch: str | None = None, buckets: int = BUCKETS,
) -> dict:
    """Add lines and orders (either may be empty) to the state below ``target``; the new manifest.

    ``batch`` names the addition, so that a job run again does not count it twice. Of several rows of an
    order the largest, by its columns, counts."""
    value = F.col(f"`{amount}`").cast("double")
    of_lines = lines.groupBy(F.col(f"`{line_order_key}`").alias("order_key")).agg(
        F.sum(F.when(~F.isnan(value), value.cast(f"decimal(28,{MONEY_SCALE})"))).cast(_SUM).alias("amount"),
        F.coalesce(F.max(F.isnan(value)), F.lit(False)).alias("not_a_number"),
        F.count(F.lit(1)).alias("n_lines"),
    )
    columns = [c for c in order_cols if c != order_key]
    header = F.struct(F.lit(True).alias("known"), *[F.col(f"`{c}`") for c in columns])
    rows = of_lines.select("*", F.lit(None).cast(orders.select(header.alias("h")).schema["h"].dataType).alias("header")).unionByName(
        orders.select(F.col(f"`{order_key}`").alias("order_key"), F.lit(None).cast(_SUM).alias("amount"), F.lit(False).alias("not_a_number"), F.lit(0).cast("long").alias("n_lines"), header.alias("header"))
    )
    combine = [F.sum("amount").cast(_SUM).alias("amount"), F.max("not_a_number").alias("not_a_number"), F.sum("n_lines").alias("n_lines"), F.max("header").alias("header")]
    return merge_by_key(rows, target, "order_key", combine=combine, batch=batch, buckets=buckets)


def kept_order_rollup(spark: SparkSession, target: str, order_key: str) -> DataFrame:
    """The columns of ``order_rollup``, from the state: known orders that have lines."""
    state = read_keyed(spark, target).where("header IS NOT NULL AND n_lines > 0")
    header = [f.name for f in state.schema["header"].dataType.fields if f.name != "known"]
    total = F.when(F.col("not_a_number"), F.lit(float("nan"))).otherwise(F.col("amount").cast("double"))
    return state.select(F.col("order_key").alias(order_key), *[F.col(f"header.`{c}`").alias(c) for c in header], total.alias("total"), "n_lines")
