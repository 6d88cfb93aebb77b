"""Registered queries of the operators that write and reread what they need: the term index,
sorted positions, folds in order, user-written aggregates, keyed merges, the kept rollup,
records of varying shape and joins behind a key filter.
Importing this module adds them to the catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from docroll.operators.combine import combine_by_key
from docroll.operators.key_filter import filtered_order_rollup, filtered_orphans
from docroll.operators.ordered import fold_by_key, running_fold, with_positions
from docroll.operators.rollup_state import add_to_order_state, kept_order_rollup
from docroll.plans import catalog as C
from docroll.plans import documents as D
from docroll.plans.catalog import ORACLE, register
from docroll.session import scratch_path
from docroll.sinks.keyed import merge_by_key, read_keyed
from docroll.sources.tables import table
from docroll.sources.term_index import build_term_index, search_index, term_counts
from docroll.sources.varied import read_varied_json, record_fields, typed_fields

# 1. Term index -----------------------------------------------------------------


@register("search_index_part", ORACLE["search_any_field"])
def search_index_part_q(spark, d):
    """The search of ``search_any_field`` through a written index of all fields."""
    path = scratch_path(spark, "part-index")
    build_term_index(table(spark, d, "part"), "p_partkey", path)
    return search_index(spark, path, C.SEARCH_TERM)


@register("search_index_nested", ORACLE["search_nested"])
def search_index_nested_q(spark, d):
    """The search of ``search_nested`` through an index of the nested documents."""
    path = scratch_path(spark, "order-index")
    build_term_index(C.order_docs_to_search(spark, d), "id", path)
    return C._seventh(search_index(spark, path, C.NESTED_TERM))


_TEXT_FIELDS = ("p_name", "p_brand", "p_type")


@register("term_index_counts", "\nUNION ALL\n".join(f"""
SELECT term, '{c}' AS field, COUNT(DISTINCT p_partkey) AS n
FROM (SELECT p_partkey, unnest(string_split_regex(lower({c}), '[^\\p{{L}}\\p{{N}}]+')) AS term FROM part) t
WHERE term <> '' GROUP BY term""" for c in _TEXT_FIELDS))
def term_index_counts_q(spark, d):
    """Documents per term and field, read off the index."""
    path = scratch_path(spark, "part-text-index")
    build_term_index(table(spark, d, "part"), "p_partkey", path, columns=_TEXT_FIELDS)
    return term_counts(spark, path)


# 2. Aggregates with a user-written state ------------------------------------------


@register("combine_user_mean", """
SELECT l_suppkey, CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / COUNT(*) AS mean_cents
FROM lineitem GROUP BY l_suppkey""")
def combine_user_mean_q(spark, d):
    """The (sum, count) state of the reference's mean, given as four functions."""
    lines = table(spark, d, "lineitem").select("l_suppkey", F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents"))
    return combine_by_key(
        lines, "l_suppkey", "cents", lambda x: (x, 1), lambda s, x: (s[0] + x, s[1] + 1), lambda a, b: (a[0] + b[0], a[1] + b[1]),
        "struct<sum:bigint,n:bigint>", finish=lambda s: s[0] / s[1], result="double", name="mean_cents",
    )


#: Hashes that the distinct sketch keeps, and its hash: x * SPREAD mod 2^32.
KEPT, SPREAD = 256, 2654435761


@register("combine_user_distinct", f"""
WITH h AS (SELECT DISTINCT l_returnflag, l_linestatus, (CAST(l_partkey AS HUGEINT) * {SPREAD} % 4294967296)::BIGINT AS h FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY h) AS rn FROM h)
SELECT l_returnflag, l_linestatus,
       CASE WHEN COUNT(*) < {KEPT} THEN CAST(COUNT(*) AS DOUBLE) ELSE {KEPT - 1} * 4294967296.0 / MAX(h) END AS parts
FROM r WHERE rn <= {KEPT} GROUP BY l_returnflag, l_linestatus""")
def combine_user_distinct_q(spark, d):
    """Distinct parts per flag and status, estimated from the k least hashes: a state of bounded size."""
    kept, spread = KEPT, SPREAD

    def least(a, b):
        return sorted({*a, *b})[:kept]

    def add(state, x):
        h = x * spread % 4294967296
        return state if len(state) == kept and h >= state[-1] or h in state else least(state, [h])

    return combine_by_key(
        table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], "l_partkey", lambda x: [x * spread % 4294967296], add, least, "array<bigint>",
        finish=lambda s: float(len(s)) if len(s) < kept else (kept - 1) * 4294967296.0 / s[-1], result="double", name="parts",
    )


# 3. Folds in order -----------------------------------------------------------------

_DELTA = "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE -1 END * CAST(ROUND(o_totalprice * 100) AS BIGINT)"
_BALANCES = f"""
WITH RECURSIVE n AS (
  SELECT o_custkey, o_orderkey, {_DELTA} AS delta,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
  FROM orders),
w AS (
  SELECT o_custkey, o_orderkey, delta, rn, greatest(0, delta) AS balance FROM n WHERE rn = 1
  UNION ALL
  SELECT n.o_custkey, n.o_orderkey, n.delta, n.rn, greatest(0, w.balance + n.delta)
  FROM w JOIN n ON n.o_custkey = w.o_custkey AND n.rn = w.rn + 1)"""


def _deltas(spark, d):
    sign = F.when(F.col("o_orderstatus") == "F", F.lit(1)).otherwise(F.lit(-1))
    return table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", (sign * F.round(F.col("o_totalprice") * 100).cast("long")).alias("delta"))


#: What a run of orders does to any balance x: max(x + add, floor).
FLOORED = {
    "lift": lambda delta: (delta, 0),
    "compose": lambda f, g: (f[0] + g[0], max(f[1] + g[0], g[1])),
    "apply": lambda f, x: max(x + f[0], f[1]),
    "summary": "struct<add:bigint,floor:bigint>",
}


@register("running_balance", f"{_BALANCES} SELECT o_custkey, o_orderkey, delta, CAST(balance AS BIGINT) AS balance FROM w")
def running_balance_q(spark, d):
    """Each customer's balance after each order, never below 0 (finished orders add, others take)."""
    got = running_fold(_deltas(spark, d), ["o_custkey"], ["o_orderdate", "o_orderkey"], ["delta"], "bigint", 0, lambda x, delta: max(x + delta, 0), name="balance", **FLOORED)
    return got.select("o_custkey", "o_orderkey", "delta", "balance")


@register("balance_by_customer", f"{_BALANCES} SELECT o_custkey, CAST(max_by(balance, rn) AS BIGINT) AS balance FROM w GROUP BY o_custkey")
def balance_by_customer_q(spark, d):
    """The last of these balances, by a fold of which nothing but the step is known."""
    return fold_by_key(_deltas(spark, d), ["o_custkey"], ["o_orderdate", "o_orderkey"], ["delta"], "bigint", 0, lambda x, delta: max(x + delta, 0), name="balance")


# 4. Whole sorted results --------------------------------------------------------------


@register("order_positions", f"""
SELECT r.*, row_number() OVER (ORDER BY o_custkey, o_orderkey) AS position FROM ({ORACLE['order_rollup']}) r""")
def order_positions_q(spark, d):
    """Every rolled-up order with its position in the order of customer and order key."""
    return with_positions(C._orders_rolled(spark, d), ["o_custkey", "o_orderkey"])


# 5. Keyed merges and the kept rollup --------------------------------------------------


@register("merge_keyed_documents", f"""
SELECT c.c_custkey AS id, c.c_name AS name, r.total, CAST(r.n_orders AS BIGINT) AS orders,
       CASE WHEN r.c_custkey IS NULL THEN 'plain' ELSE 'rolled' END AS origin
FROM customer c LEFT JOIN ({ORACLE['customer_rollup']}) r ON r.c_custkey = c.c_custkey""")
def merge_keyed_documents_q(spark, d):
    """All customers written as documents, then merged with the rolled-up ones by key; the second merge runs twice."""
    target = scratch_path(spark, "keyed-documents")
    plain = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit(None).cast("double").alias("total"), F.lit(None).cast("long").alias("orders"), F.lit("plain").alias("origin"))
    rolled = C._customers_rolled(spark, d).select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), "total", F.col("n_orders").alias("orders"), F.lit("rolled").alias("origin"))
    merge_by_key(plain, target, "id")
    merge_by_key(rolled, target, "id", batch="rolled")
    merge_by_key(rolled, target, "id", batch="rolled")
    return read_keyed(spark, target)


@register("kept_customer_rollup", ORACLE["customer_rollup"])
def kept_customer_rollup_q(spark, d):
    """The customer rollup from a kept state: finished lines and orders first, then the others
    (lines of either kind may come before their order)."""
    target = scratch_path(spark, "order-state")
    lines, orders = table(spark, d, "lineitem"), table(spark, d, "orders")
    done_line, done_order = F.col("l_linestatus") == "F", F.col("o_orderstatus") == "F"
    for batch, of_lines, of_orders in (("finished", done_line, done_order), ("open", ~done_line, ~done_order)):
        add_to_order_state(target, lines.where(of_lines), orders.where(of_orders), "l_orderkey", "o_orderkey", "l_extendedprice", ("o_custkey", "o_orderdate"), batch=batch)
    return D.rolled_customers(kept_order_rollup(spark, target, "o_orderkey"), table(spark, d, "customer"), C.CUTOFF, C.THRESHOLDS)


# 6. Records of varying shape ------------------------------------------------------------


def _records(spark, d):
    """Orders and events as JSON lines in one folder: ``id`` is a number in the one and
    text in the other, other fields are in one of the two or nested in it."""
    path = scratch_path(spark, "varied-json")
    money = "decimal(15, 2)"
    o = table(spark, d, "orders").select(F.struct(
        F.lit("order").alias("kind"), F.col("o_orderkey").alias("id"), F.struct(F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("status")).alias("customer"),
        F.col("o_totalprice").cast(money).alias("amount")).alias("r"))
    e = table(spark, d, "events").select(F.struct(
        F.lit("event").alias("kind"), F.concat(F.lit("e"), "event_id").alias("id"), F.col("event_type").alias("type"), F.col("user_id").alias("user"),
        F.col("value").cast(money).alias("amount"), F.parse_json("props").alias("props")).alias("r"))
    o.select(F.to_json("r").alias("value")).write.text(path)
    e.select(F.to_json("r").alias("value")).write.mode("append").text(path)
    return read_varied_json(spark, path)


def _amount_type(cents: str) -> str:
    """SQL for the type that JSON decimals with up to two places merge to."""
    scale = f"(CASE WHEN {cents} % 100 = 0 THEN 0 WHEN {cents} % 10 = 0 THEN 1 ELSE 2 END)"
    digits = f"(CASE WHEN abs({cents}) < 100 THEN 0 ELSE length(CAST(abs({cents}) // 100 AS VARCHAR)) END)"
    return f"printf('DECIMAL(%d,%d)', MAX({digits}) + MAX({scale}), MAX({scale}))"


_AMOUNTS = """(SELECT CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders
      UNION ALL SELECT CAST(round(value * 100) AS BIGINT) FROM events) a"""


@register("varied_record_fields", f"""
SELECT '$.kind' AS path, 'STRING' AS type, (SELECT COUNT(*) FROM orders) + (SELECT COUNT(*) FROM events) AS n
UNION ALL SELECT '$.id', 'VARIANT', (SELECT COUNT(o_orderkey) FROM orders) + (SELECT COUNT(event_id) FROM events)
UNION ALL SELECT '$.customer.id', 'BIGINT', COUNT(o_custkey) FROM orders
UNION ALL SELECT '$.customer.status', 'STRING', COUNT(o_orderstatus) FROM orders
UNION ALL SELECT '$.type', 'STRING', COUNT(event_type) FROM events
UNION ALL SELECT '$.user', 'BIGINT', COUNT(user_id) FROM events
UNION ALL SELECT '$.props.' || key, CASE WHEN MIN(t) = MAX(t) THEN MAX(t) ELSE 'VARIANT' END, COUNT(*)
FROM (SELECT key, CASE WHEN json_type(props, key) IN ('BIGINT', 'UBIGINT') THEN 'BIGINT' ELSE json_type(props, key) END AS t
      FROM (SELECT props, unnest(json_keys(props)) AS key FROM events) k) p GROUP BY key
UNION ALL SELECT '$.amount', {_amount_type('cents')}, COUNT(cents) FROM {_AMOUNTS}""")
def varied_record_fields_q(spark, d):
    """Paths, merged types and counts of mixed order and event records."""
    return record_fields(_records(spark, d))


@register("varied_typed_fields", """
SELECT 'order' AS kind, o_orderkey AS id, CAST(CAST(o_totalprice AS DECIMAL(15, 2)) AS DOUBLE) AS amount,
       CAST(NULL AS BIGINT) AS "user", printf('{"customer":{"id":%d,"status":"%s"}}', o_custkey, o_orderstatus) AS rest
FROM orders
UNION ALL
SELECT 'event', NULL, CAST(CAST(value AS DECIMAL(15, 2)) AS DOUBLE), user_id,
       printf('{"id":"e%d","props":%s,"type":"%s"}', event_id, replace(props, ' ', ''), event_type)
FROM events""")
def varied_typed_fields_q(spark, d):
    """Typed columns of the mixed records; an event's id is no number and stays in the rest."""
    typed = typed_fields(_records(spark, d), {"kind": "string", "id": "bigint", "amount": "decimal(15,2)", "user": "bigint"})
    return typed.select("kind", "id", F.col("amount").cast("double").alias("amount"), "user", F.to_json("rest").alias("rest"))


# 8. Joins behind a filter of the small side's keys -------------------------------

#: Orders of the last weeks: few, so most lines leave before their shuffle.
LATE = "2001-06-01"


@register("late_order_rollup", f"""
SELECT o_orderkey, o_custkey, o_orderdate, CAST(cents AS DOUBLE) / 100 AS total, n_lines
FROM ({C._ROLLED_ORDERS}) r WHERE o_orderdate >= TIMESTAMP '{LATE}'""")
def late_order_rollup_q(spark, d):
    """The order rollup of late orders; other orders' lines are neither summed nor shuffled."""
    late = table(spark, d, "orders").where(F.col("o_orderdate") >= F.lit(LATE).cast("timestamp"))
    return filtered_order_rollup(
        table(spark, d, "lineitem"), late, "l_orderkey", "o_orderkey", "l_extendedprice", ["o_custkey", "o_orderdate"]
    )


@register("filtered_orphan_report", ORACLE["orphan_report"])
def filtered_orphan_report_q(spark, d):
    """``orphan_report`` with what the parents' filter rejects reported unshuffled."""
    return C._orphan_report(spark, d, filtered_orphans)
