"""Registered queries: each builds a lazy Spark DataFrame over the data
folder's full tables, and most carry an equivalent DuckDB SQL text.

Outputs are flat (nested documents are summarised by counts and exact sums
computed *from their arrays*), so an external engine can check them.
Parameters fixed for the driver's tables: orders end in 2001, so the cutoff
is 1998-01-01 and the bucket thresholds are the reference's times 100.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docroll.functions.scalars import (
    REFERENCE_BUCKET_THRESHOLDS,
    doc_json,
    java_date_text,
    parse_ts,
)
from docroll.operators.joins import first_per_key, key_match_counts, orphans
from docroll.operators.keyed import (
    combine_mean,
    count_by,
    global_int_mean,
    keyed_last_doubled,
    keyed_sum,
    row_count,
)
from docroll.operators.nest import list_total
from docroll.operators.rollups import bucket_counts, sorted_head
from docroll.plans import documents as D
from docroll.plans import sql_text as S
from docroll.plans.columns import LAYOUT_COLUMNS
from docroll.session import scratch_path
from docroll.sinks.documents import flat_docs, read_docs, string_docs, string_map_docs, write_docs
from docroll.sources.delimited import read_delimited, write_delimited
from docroll.sources.json_files import read_json_table
from docroll.sources.schemas import LAYOUTS, layout_of, text_keyed
from docroll.sources.search import search
from docroll.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]

CUTOFF = "1998-01-01"
THRESHOLDS = tuple(t * 100 for t in REFERENCE_BUCKET_THRESHOLDS)
SEARCH_TERM = "ring"

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle.strip()
        return fn

    return wrap


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return table(spark, d, name)


def _orders_rolled(spark, d):
    return D.rolled_orders(_t(spark, d, "orders"), _t(spark, d, "lineitem"))


def _customers_rolled(spark, d):
    return D.rolled_customers(_orders_rolled(spark, d), _t(spark, d, "customer"), CUTOFF, THRESHOLDS)


# Shared oracle fragments ---------------------------------------------------

_CENTS = "CAST(ROUND({x} * 100) AS BIGINT)"
_ORDER_CENTS = f"""
  SELECT l_orderkey, SUM({_CENTS.format(x='l_extendedprice')}) AS cents, COUNT(*) AS n_lines
  FROM lineitem GROUP BY l_orderkey"""
_ROLLED_ORDERS = f"""
  SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_orderpriority, o.o_orderdate,
         x.cents, x.n_lines
  FROM ({_ORDER_CENTS}) x JOIN orders o ON x.l_orderkey = o.o_orderkey"""
_ROLLED_CUSTOMERS = f"""
  SELECT c.c_custkey, c.c_name,
         CAST(s.tcents AS DOUBLE) / 100 AS total, s.n_orders,
         (CAST(s.tcents AS DOUBLE) / 100) / s.n_orders AS avg,
         CAST(s.mcents AS DOUBLE) / 100 AS max,
         CASE WHEN s.tcents / 100.0 > 600000 THEN 5 WHEN s.tcents / 100.0 > 550000 THEN 4
              WHEN s.tcents / 100.0 > 450000 THEN 3 WHEN s.tcents / 100.0 > 350000 THEN 2
              WHEN s.tcents / 100.0 > 250000 THEN 1 ELSE 0 END AS bucket
  FROM (SELECT o_custkey,
               SUM(CASE WHEN o_orderdate > TIMESTAMP '{CUTOFF} 00:00:00' THEN cents ELSE 0 END) AS tcents,
               COUNT(*) AS n_orders, MAX(cents) AS mcents
        FROM ({_ROLLED_ORDERS}) ro GROUP BY o_custkey) s
  JOIN customer c ON c.c_custkey = s.o_custkey"""


# The reference's statements join first and count then; so do the oracles.
_RIGHT_JOIN = """
SELECT c.c_custkey, c.c_name, c.c_nationkey, c.c_mktsegment, o.o_orderpriority, COUNT(*) AS n
FROM customer c RIGHT JOIN orders o ON c.c_custkey = o.o_custkey
GROUP BY c.c_custkey, c.c_name, c.c_nationkey, c.c_mktsegment, o.o_orderpriority"""


# 1. Rollups (README job) ---------------------------------------------------

@register("order_rollup", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_orderdate,
       CAST(cents AS DOUBLE) / 100 AS total, n_lines
FROM ({_ROLLED_ORDERS}) r""")
def order_rollup_q(spark, d):
    return _orders_rolled(spark, d)


@register("customer_rollup", f"SELECT * FROM ({_ROLLED_CUSTOMERS}) r")
def customer_rollup_q(spark, d):
    return _customers_rolled(spark, d)


@register("bucket_totals", f"""
SELECT bucket, COUNT(*) AS n_customers FROM ({_ROLLED_CUSTOMERS}) r GROUP BY bucket""")
def bucket_totals_q(spark, d):
    return bucket_counts(_customers_rolled(spark, d))


@register("rollup_top100", f"""
SELECT * FROM ({_ROLLED_CUSTOMERS}) r ORDER BY c_custkey LIMIT 100""")
def rollup_top100_q(spark, d):
    return sorted_head(_customers_rolled(spark, d), ["c_custkey"], 100)


@register("order_top100", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_orderdate,
       CAST(cents AS DOUBLE) / 100 AS total, n_lines
FROM ({_ROLLED_ORDERS}) r ORDER BY o_custkey, o_orderkey LIMIT 100""")
def order_top100_q(spark, d):
    """Rolled-up orders, first 100 by customer key (order key breaks ties)."""
    return sorted_head(_orders_rolled(spark, d), ["o_custkey", "o_orderkey"], 100)


# 2. Nesting -----------------------------------------------------------------

def _line_cents(x):
    """An amount of the driver's tables in whole cents, for exact check sums."""
    return F.round(x["amount"] * 100).cast("long")


@register("nest_orders_lines", f"""
SELECT o.o_orderkey AS o_orderkey, o.o_custkey AS o_custkey,
       CAST(COALESCE(x.n_lines, 0) AS BIGINT) AS n_lines,
       CAST(COALESCE(x.n_lines, 0) AS BIGINT) AS line_count,
       CAST(COALESCE(x.cents, 0) AS DOUBLE) / 100 AS amount,
       CAST(COALESCE(x.cents, 0) AS DOUBLE) / 100 AS order_amount,
       CAST(COALESCE(x.id_sum, 0) AS BIGINT) AS line_id_sum
FROM orders o LEFT JOIN (
  SELECT l_orderkey, COUNT(*) AS n_lines, SUM({_CENTS.format(x='l_extendedprice')}) AS cents,
         SUM(l_linenumber) AS id_sum
  FROM lineitem GROUP BY l_orderkey) x ON x.l_orderkey = o.o_orderkey""")
def nest_orders_lines_q(spark, d):
    docs = D.order_documents(_t(spark, d, "orders"), _t(spark, d, "lineitem"))
    per_part = docs.select(
        F.col("id").alias("o_orderkey"),
        F.col("customerId").alias("o_custkey"),
        F.size("orderLines").cast("long").alias("n"),
        list_total("orderLines", _line_cents).alias("c"),
        list_total("orderLines", lambda x: x["id"].cast("long")).alias("ids"),
        "lineCount",
        "orderAmount",
    )
    out = D.summed_over_parts(
        per_part, "o_orderkey", {"n_lines": "n", "cents": "c", "line_id_sum": "ids"},
        keep=("o_custkey", "lineCount", "orderAmount"),
    )
    return out.select(
        "o_orderkey", "o_custkey", "n_lines",
        F.col("lineCount").alias("line_count"),
        (F.col("cents") / F.lit(100.0)).alias("amount"),
        F.col("orderAmount").alias("order_amount"),
        "line_id_sum",
    )


@register("nest_customer_children", """
SELECT c.c_custkey AS c_custkey, c.c_name AS c_name,
       CAST(COALESCE(o.n, 0) AS BIGINT) AS n_orders, CAST(COALESCE(o.ids, 0) AS BIGINT) AS order_id_sum,
       CAST(COALESCE(e.n, 0) AS BIGINT) AS n_contacts, CAST(COALESCE(e.ids, 0) AS BIGINT) AS contact_id_sum
FROM customer c
LEFT JOIN (SELECT o_custkey, COUNT(*) AS n, SUM(o_orderkey) AS ids FROM orders GROUP BY o_custkey) o
  ON o.o_custkey = c.c_custkey
LEFT JOIN (SELECT user_id, COUNT(*) AS n, SUM(event_id) AS ids FROM events GROUP BY user_id) e
  ON e.user_id = c.c_custkey""")
def nest_customer_children_q(spark, d):
    docs = D.customer_documents(_t(spark, d, "customer"), _t(spark, d, "orders"), _t(spark, d, "events"))
    per_part = docs.select(
        F.col("id").alias("c_custkey"),
        F.col("name").alias("c_name"),
        F.size("orders").cast("long").alias("no"),
        list_total("orders", lambda x: x["id"]).alias("oi"),
        F.size("contacts").cast("long").alias("nc"),
        list_total("contacts", lambda x: x["id"]).alias("ci"),
    )
    return D.summed_over_parts(
        per_part, "c_custkey",
        {"n_orders": "no", "order_id_sum": "oi", "n_contacts": "nc", "contact_id_sum": "ci"},
        keep=("c_name",),
    ).select("c_custkey", "c_name", "n_orders", "order_id_sum", "n_contacts", "contact_id_sum")


@register("nest_three_level", f"""
SELECT c.c_custkey AS c_custkey,
       CAST(COALESCE(o.n_orders, 0) AS BIGINT) AS n_orders,
       CAST(COALESCE(o.n_lines, 0) AS BIGINT) AS n_lines,
       CAST(COALESCE(o.cents, 0) AS DOUBLE) / 100 AS total,
       CAST(COALESCE(e.n, 0) AS BIGINT) AS n_contacts
FROM customer c
LEFT JOIN (
  SELECT o.o_custkey, COUNT(*) AS n_orders, SUM(COALESCE(x.n_lines, 0)) AS n_lines,
         SUM(COALESCE(x.cents, 0)) AS cents
  FROM orders o LEFT JOIN ({_ORDER_CENTS}) x ON x.l_orderkey = o.o_orderkey
  GROUP BY o.o_custkey) o ON o.o_custkey = c.c_custkey
LEFT JOIN (SELECT user_id, COUNT(*) AS n FROM events GROUP BY user_id) e ON e.user_id = c.c_custkey""")
def nest_three_level_q(spark, d):
    docs = D.three_level_documents(
        _t(spark, d, "customer"), _t(spark, d, "orders"), _t(spark, d, "lineitem"), _t(spark, d, "events")
    )
    per_part = docs.select(
        F.col("customerId").alias("c_custkey"),
        F.size(F.filter("orders", lambda o: o["part"] == 0)).cast("long").alias("no"),
        list_total("orders", lambda o: F.size(o["orderLines"]).cast("long")).alias("nl"),
        list_total("orders", lambda o: list_total(o["orderLines"], _line_cents)).alias("c"),
        F.size("contacts").cast("long").alias("nc"),
    )
    out = D.summed_over_parts(per_part, "c_custkey", {"n_orders": "no", "n_lines": "nl", "c": "c", "n_contacts": "nc"})
    return out.select(
        "c_custkey", "n_orders", "n_lines", (F.col("c") / F.lit(100.0)).alias("total"), "n_contacts"
    )


@register("nest_customer_rollup", f"""
SELECT r.c_custkey AS c_custkey, r.c_name AS c_name, r.total, r.max, r.avg, r.bucket,
       CAST(o.n AS BIGINT) AS n_orders, o.latest AS latest_order,
       CAST(COALESCE(e.n, 0) AS BIGINT) AS n_contacts
FROM ({_ROLLED_CUSTOMERS}) r
JOIN (SELECT o_custkey, COUNT(*) AS n, MAX(o_orderdate) AS latest FROM ({_ROLLED_ORDERS}) ro GROUP BY o_custkey) o
  ON o.o_custkey = r.c_custkey
LEFT JOIN (SELECT user_id, COUNT(*) AS n FROM events GROUP BY user_id) e ON e.user_id = r.c_custkey""")
def nest_customer_rollup_q(spark, d):
    return _rollup_doc_summary(_rollup_docs(spark, d))


def _rollup_docs(spark, d):
    ro = _orders_rolled(spark, d)
    rc = D.rolled_customers(ro, _t(spark, d, "customer"), CUTOFF, THRESHOLDS)
    return D.rollup_documents(rc, ro, _t(spark, d, "events"))


def _rollup_doc_summary(docs: DataFrame) -> DataFrame:
    per_part = docs.select(
        F.col("customerId").alias("c_custkey"),
        F.col("name").alias("c_name"),
        "total", "max", "avg", F.col("range").alias("bucket"),
        F.size("orders").cast("long").alias("no"),
        F.array_max(F.transform("orders", lambda o: o["orderDate"])).alias("lo"),
        F.size("contacts").cast("long").alias("nc"),
    )
    out = per_part.groupBy("c_custkey").agg(
        F.min("c_name").alias("c_name"), F.min("total").alias("total"), F.min("max").alias("max"),
        F.min("avg").alias("avg"), F.min("bucket").alias("bucket"),
        F.sum("no").alias("n_orders"), F.max("lo").alias("latest_order"), F.sum("nc").alias("n_contacts"),
    )
    return out.select("c_custkey", "c_name", "total", "max", "avg", "bucket", "n_orders", "latest_order", "n_contacts")


@register("nest_from_join", f"""
SELECT g.c_name AS customer_name, MIN(g.c_nationkey) AS customer_siren,
       CAST(COUNT(*) AS BIGINT) AS n_descriptions,
       MIN(g.o_orderpriority) AS first_desc, MAX(g.o_orderpriority) AS last_desc,
       CAST(SUM(LENGTH(g.o_orderpriority)) AS BIGINT) AS desc_chars
FROM ({_RIGHT_JOIN}) g
GROUP BY g.c_name""")
def nest_from_join_q(spark, d):
    docs = D.names_with_descriptions(_right_join(spark, d))
    per_part = docs.select(
        F.col("customerName").alias("customer_name"),
        F.col("customerSiren").alias("customer_siren"),
        F.size("orderList").cast("long").alias("n"),
        F.array_min(F.transform("orderList", lambda x: x["desc"])).alias("lo"),
        F.array_max(F.transform("orderList", lambda x: x["desc"])).alias("hi"),
        list_total("orderList", lambda x: F.length(x["desc"]).cast("long")).alias("ch"),
    ).withColumn("__name", F.struct(F.col("customer_name").alias("v")))
    out = per_part.groupBy("__name").agg(
        F.min("customer_siren").alias("customer_siren"),
        F.sum("n").alias("n_descriptions"),
        F.min("lo").alias("first_desc"),
        F.max("hi").alias("last_desc"),
        F.sum("ch").alias("desc_chars"),
    )
    return out.select(
        F.col("__name.v").alias("customer_name"), "customer_siren", "n_descriptions",
        "first_desc", "last_desc", "desc_chars",
    )


@register("nest_json_text", f"""
SELECT o.o_orderkey AS o_orderkey, 0 AS part,
       to_json(struct_pack(id := o.o_orderkey, customerId := o.o_custkey,
                           orderDescription := o.o_orderpriority,
                           createDate := strftime(o.o_orderdate, '%a %b %d %H:%M:%S UTC %Y'),
                           lineCount := COALESCE(x.n, 0),
                           orderAmount := CAST(COALESCE(x.cents, 0) AS DOUBLE) / 100,
                           orderLines := COALESCE(x.lines, [])))::VARCHAR AS doc
FROM orders o LEFT JOIN (
  SELECT l_orderkey, COUNT(*) AS n, SUM({_CENTS.format(x='l_extendedprice')}) AS cents,
         list(struct_pack(id := l_linenumber, partId := l_partkey, suppId := l_suppkey,
                          orderId := l_orderkey, quantity := l_quantity, amount := l_extendedprice,
                          returnFlag := l_returnflag, lineStatus := l_linestatus)
              ORDER BY l_linenumber, l_partkey, l_suppkey, l_orderkey, l_quantity, l_extendedprice,
                       l_returnflag, l_linestatus) AS lines
  FROM lineitem GROUP BY l_orderkey) x ON x.l_orderkey = o.o_orderkey""")
def nest_json_text_q(spark, d):
    """Each order document (header, totals, nested lines) as JSON text."""
    docs = D.order_documents(_t(spark, d, "orders"), _t(spark, d, "lineitem"))
    doc = F.struct("id", "customerId", "orderDescription", "createDate", "lineCount", "orderAmount", "orderLines")
    return docs.select(F.col("id").alias("o_orderkey"), "part", doc_json(doc).alias("doc"))


PAGES_OF = 3

_LINE_ORDER = ", ".join(["l_linenumber", "l_partkey", "l_suppkey", "l_orderkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus"])


@register("nest_json_pages", f"""
WITH placed AS (
  SELECT *, (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber % 64, {_LINE_ORDER}) - 1) // {PAGES_OF} AS page
  FROM lineitem),
pages AS (
  SELECT l_orderkey, page,
         list(struct_pack(id := l_linenumber, partId := l_partkey, suppId := l_suppkey,
                          orderId := l_orderkey, quantity := l_quantity, amount := l_extendedprice,
                          returnFlag := l_returnflag, lineStatus := l_linestatus)
              ORDER BY {_LINE_ORDER}) AS lines
  FROM placed GROUP BY l_orderkey, page),
totals AS ({_ORDER_CENTS})
SELECT o.o_orderkey AS o_orderkey, CAST(COALESCE(p.page, 0) AS INTEGER) AS part,
       to_json(struct_pack(id := o.o_orderkey, customerId := o.o_custkey,
                           lineCount := COALESCE(x.n_lines, 0),
                           orderAmount := CAST(COALESCE(x.cents, 0) AS DOUBLE) / 100,
                           orderLines := COALESCE(p.lines, [])))::VARCHAR AS doc
FROM orders o LEFT JOIN pages p ON p.l_orderkey = o.o_orderkey LEFT JOIN totals x ON x.l_orderkey = o.o_orderkey""")
def nest_json_pages_q(spark, d):
    """Order documents in pages of three lines, so that most orders have several."""
    docs = D.order_documents(_t(spark, d, "orders"), _t(spark, d, "lineitem"), page_size=PAGES_OF)
    doc = F.struct("id", "customerId", "lineCount", "orderAmount", "orderLines")
    return docs.select(F.col("id").alias("o_orderkey"), "part", doc_json(doc).alias("doc"))


@register("nest_customer_json", """
WITH o AS (
  SELECT o_custkey, COUNT(*) AS n,
         list(struct_pack(id := o_orderkey, customerId := o_custkey, orderDescription := o_orderpriority,
                          createDate := strftime(o_orderdate, '%a %b %d %H:%M:%S UTC %Y'))
              ORDER BY o_orderkey, o_orderpriority, o_orderdate) AS items
  FROM orders GROUP BY o_custkey),
e AS (
  SELECT user_id, COUNT(*) AS n,
         list(struct_pack(id := event_id, customerId := user_id, type := event_type, value := value)
              ORDER BY event_id, event_type) AS items
  FROM events GROUP BY user_id)
SELECT c.c_custkey AS c_custkey,
       to_json(struct_pack(id := c.c_custkey, name := c.c_name, catchPhrase := c.c_mktsegment, siren := c.c_nationkey,
                           contactCount := COALESCE(e.n, 0), contacts := COALESCE(e.items, []),
                           orderCount := COALESCE(o.n, 0), orders := COALESCE(o.items, [])))::VARCHAR AS doc
FROM customer c LEFT JOIN o ON o.o_custkey = c.c_custkey LEFT JOIN e ON e.user_id = c.c_custkey""")
def nest_customer_json_q(spark, d):
    """Each customer document (header, contacts, orders) as JSON text; the
    contacts' times are left out, since JSON writers print them differently."""
    docs = D.customer_documents(_t(spark, d, "customer"), _t(spark, d, "orders"), _t(spark, d, "events").drop("ts"))
    names = ("id", "name", "catchPhrase", "siren", "contactCount", "contacts", "orderCount", "orders")
    return docs.select(F.col("id").alias("c_custkey"), doc_json(F.struct(*names)).alias("doc"))


# 3. SQL jobs -----------------------------------------------------------------

def _right_join(spark, d, **how):
    return S.right_join_count(_t(spark, d, "customer"), _t(spark, d, "orders"), **how)


def _from_json(spark, d, name):
    """A table written as JSON lines and read back with its schema inferred."""
    path = scratch_path(spark, f"{name}-json")
    write_docs(_t(spark, d, name), path, fmt="json")
    return read_json_table(spark, path)


@register("sql_inner_join_sum", """
SELECT c.c_name, CAST(SUM(CAST(o.o_totalprice AS DECIMAL(28, 4))) AS DOUBLE) AS amount
FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey GROUP BY c.c_name""")
def sql_inner_join_sum_q(spark, d):
    return S.inner_join_sum(_t(spark, d, "customer"), _t(spark, d, "orders"))


@register("sql_right_join_count", f"{_RIGHT_JOIN} ORDER BY c_name NULLS FIRST, c_custkey NULLS FIRST, o_orderpriority NULLS FIRST")
def sql_right_join_count_q(spark, d):
    return _right_join(spark, d, ordered=True)


@register("sql_right_join_unmatched", """
SELECT e.user_id AS c_custkey, e.event_type AS c_name, e.w AS c_nationkey, e.t AS c_mktsegment,
       c.c_mktsegment AS o_orderpriority, COUNT(*) AS n
FROM (SELECT *, CAST(event_id % 3 AS INTEGER) AS w, 'event' AS t FROM events) e
RIGHT JOIN customer c ON e.user_id = c.c_custkey
GROUP BY e.user_id, e.event_type, e.w, e.t, c.c_mktsegment""")
def sql_right_join_unmatched_q(spark, d):
    """The right join where many rows on its right have no partner: customers
    without an event stay, under nulls."""
    events = _t(spark, d, "events").select(
        F.col("user_id").alias("c_custkey"), F.col("event_type").alias("c_name"),
        (F.col("event_id") - F.floor(F.col("event_id") / 3) * 3).cast("int").alias("c_nationkey"), F.lit("event").alias("c_mktsegment"),
    )
    people = _t(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("o_orderpriority"))
    return S.right_join_count(events, people)


@register("sql_json_nested", f"""
SELECT g.c_name AS customer_name, MIN(g.c_nationkey) AS customer_siren, COUNT(*) AS n_descriptions,
       string_agg(g.o_orderpriority, ',' ORDER BY g.o_orderpriority, g.c_custkey) AS descriptions
FROM ({_RIGHT_JOIN}) g GROUP BY g.c_name""")
def sql_json_nested_q(spark, d):
    """JSON tables -> SQL right join and count -> one document per name."""
    docs = D.names_with_descriptions(S.right_join_count(_from_json(spark, d, "customer"), _from_json(spark, d, "orders")), page_size=None)
    return docs.select(
        F.col("customerName").alias("customer_name"), F.col("customerSiren").cast("int").alias("customer_siren"),
        F.size("orderList").cast("long").alias("n_descriptions"),
        F.array_join(F.transform("orderList", lambda x: x["desc"]), ",").alias("descriptions"),
    )


# 4. Key checks ----------------------------------------------------------------

@register("orphan_report", """
SELECT 'line_without_order' AS kind, l.l_orderkey AS child_key FROM lineitem l
  WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)
UNION ALL
SELECT 'order_without_customer', o.o_orderkey FROM orders o
  WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)
UNION ALL
SELECT 'contact_without_customer', e.event_id FROM events e
  WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = e.user_id)
UNION ALL
SELECT 'order_without_lines', o.o_orderkey FROM orders o
  WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""")
def orphan_report_q(spark, d):
    return _orphan_report(spark, d, orphans)


def _orphan_report(spark, d, find):
    c, o, l, e = (_t(spark, d, n) for n in ("customer", "orders", "lineitem", "events"))
    checks = [
        ("line_without_order", l, o, "l_orderkey", "o_orderkey", "l_orderkey"),
        ("order_without_customer", o, c, "o_custkey", "c_custkey", "o_orderkey"),
        ("contact_without_customer", e, c, "user_id", "c_custkey", "event_id"),
        # Parents the rollup drops: an order needs a line to be rolled up.
        ("order_without_lines", o, l, "o_orderkey", "l_orderkey", "o_orderkey"),
    ]
    out = None
    for kind, child, parent, child_on, parent_on, key in checks:
        part = find(child, parent, child_on, parent_on).select(F.lit(kind).alias("kind"), F.col(key).alias("child_key"))
        out = part if out is None else out.unionByName(part)
    return out


@register("first_parent", """
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey
                           ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                                    l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) = 1""")
def first_parent_q(spark, d):
    return first_per_key(_t(spark, d, "lineitem"), "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey"])


@register("key_text_vs_int", """
SELECT
  (SELECT COUNT(*) FROM orders o JOIN customer c
     ON CAST(o.o_custkey AS VARCHAR) = lpad(CAST(c.c_custkey AS VARCHAR), 9, '0')) AS n_text,
  (SELECT COUNT(*) FROM orders o JOIN customer c
     ON o.o_custkey = TRY_CAST(lpad(CAST(c.c_custkey AS VARCHAR), 9, '0') AS BIGINT)) AS n_typed""")
def key_text_vs_int_q(spark, d):
    padded = _t(spark, d, "customer").select(F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("key"))
    return key_match_counts(_t(spark, d, "orders"), padded, "o_custkey", "key")


@register("text_key_nest", """
SELECT lpad(CAST(c.c_custkey AS VARCHAR), 6, '0') AS id, c.c_name AS name, COUNT(o.o_orderkey) AS n_orders
FROM customer c LEFT JOIN orders o ON lpad(CAST(c.c_custkey AS VARCHAR), 6, '0') = CAST(o.o_custkey AS VARCHAR)
GROUP BY c.c_custkey, c.c_name""")
def text_key_nest_q(spark, d):
    """Customer documents whose keys stay text: '000123' and '123' do not match."""
    people, orders, contacts = (scratch_path(spark, f"text-key-{n}") for n in ("customer", "orders", "events"))
    write_delimited(_t(spark, d, "customer").select(F.lpad(F.col("c_custkey").cast("string"), 6, "0").alias("k"), "c_name", "c_mktsegment", "c_nationkey"), people)
    write_delimited(_t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority"), orders)
    write_delimited(_t(spark, d, "events").select("event_id", "user_id", *[F.lit("").alias(f"x{i}") for i in range(5)]), contacts)
    read = lambda path, name: read_delimited(spark, path, text_keyed(LAYOUTS[name]))
    docs = D.customer_documents(read(people, "customer_join"), read(orders, "order_short"), read(contacts, "contact"), page_size=None, columns=LAYOUT_COLUMNS)
    return docs.select("id", "name", F.col("orderCount").alias("n_orders"))


# 5. Nested records and small keyed aggregates --------------------------------

@register("count_by_struct", """
SELECT l_returnflag, l_linestatus, l_discount, COUNT(*) AS n
FROM lineitem GROUP BY l_returnflag, l_linestatus, l_discount""")
def count_by_struct_q(spark, d):
    rec = _t(spark, d, "lineitem").select(
        F.struct("l_returnflag", F.struct("l_linestatus", "l_discount").alias("status")).alias("rec")
    )
    return count_by(rec, "rec").select(
        F.col("rec.l_returnflag").alias("l_returnflag"),
        F.col("rec.status.l_linestatus").alias("l_linestatus"),
        F.col("rec.status.l_discount").alias("l_discount"),
        "n",
    )


@register("nested_path_project", """
SELECT c.c_custkey AS customerId, c.c_name AS name, o.o_orderkey AS orderId,
       l.l_linenumber AS orderLineId, l.l_partkey AS partId, l.l_suppkey AS suppId,
       l.l_extendedprice AS lineAmount
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON c.c_custkey = o.o_custkey""")
def nested_path_project_q(spark, d):
    l, o, c = (_t(spark, d, n) for n in ("lineitem", "orders", "customer"))
    # the narrow tables first: lines move once, on the order key
    rec = o.join(c, c.c_custkey == o.o_custkey).join(l, l.l_orderkey == o.o_orderkey).select(
        F.struct(
            F.col("c_custkey").alias("customerId"),
            F.col("c_name").alias("name"),
            F.struct(
                F.col("o_orderkey").alias("orderId"),
                F.col("o_custkey").alias("customerId"),
                F.col("o_orderpriority").alias("orderName"),
                F.struct(
                    F.col("l_linenumber").alias("orderLineId"),
                    F.col("l_partkey").alias("partId"),
                    F.col("l_suppkey").alias("suppId"),
                    F.col("l_orderkey").alias("orderId"),
                    F.col("l_extendedprice").alias("lineAmount"),
                ).alias("orderLine"),
            ).alias("order"),
        ).alias("customer")
    )
    return rec.select(
        F.col("customer.customerId").alias("customerId"),
        F.col("customer.name").alias("name"),
        F.col("customer.order.orderId").alias("orderId"),
        F.col("customer.order.orderLine.orderLineId").alias("orderLineId"),
        F.col("customer.order.orderLine.partId").alias("partId"),
        F.col("customer.order.orderLine.suppId").alias("suppId"),
        F.col("customer.order.orderLine.lineAmount").alias("lineAmount"),
    )


@register("value_count", """
SELECT l_linenumber AS value, COUNT(*) AS n FROM lineitem GROUP BY l_linenumber""")
def value_count_q(spark, d):
    return count_by(_t(spark, d, "lineitem").select(F.col("l_linenumber").alias("value")), "value")


@register("keyed_sum", """
SELECT l_orderkey, SUM(l_quantity) AS value FROM lineitem GROUP BY l_orderkey""")
def keyed_sum_q(spark, d):
    return keyed_sum(_t(spark, d, "lineitem"), "l_orderkey", "l_quantity")


@register("keyed_last_doubled", """
SELECT l_orderkey, CASE WHEN n = 1 THEN l_quantity ELSE 2 * l_quantity END AS value
FROM (SELECT l_orderkey, l_quantity, COUNT(*) OVER (PARTITION BY l_orderkey) AS n,
             row_number() OVER (PARTITION BY l_orderkey
                                ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) AS rn
      FROM lineitem) t
WHERE rn = 1""")
def keyed_last_doubled_q(spark, d):
    return keyed_last_doubled(
        _t(spark, d, "lineitem"), "l_orderkey", "l_quantity", ["l_linenumber", "l_partkey", "l_suppkey"]
    )


@register("combine_mean", """
SELECT event_type,
       CAST(CAST(SUM(user_id) AS DOUBLE) / COUNT(user_id) AS FLOAT) AS mean,
       CAST(SUM(user_id) AS BIGINT) AS sum,
       CAST(CAST(SUM(user_id) AS DECIMAL(38,0)) * CAST(SUM(user_id) AS DECIMAL(38,0)) AS DECIMAL(38,0)) AS square,
       SUM(user_id) > 10 AS above
FROM events GROUP BY event_type""")
def combine_mean_q(spark, d):
    return combine_mean(_t(spark, d, "events"), "event_type", "user_id", threshold=10)


@register("global_int_mean", """
SELECT CAST(SUM(p_size) // COUNT(p_size) AS BIGINT) AS mean FROM part""")
def global_int_mean_q(spark, d):
    return global_int_mean(_t(spark, d, "part"), "p_size")


# 6. Search ------------------------------------------------------------------------

_SEARCH_PATTERN = r"(^|[^\p{L}\p{N}])" + SEARCH_TERM + r"($|[^\p{L}\p{N}])"
_SEARCH_WHERE = " OR ".join(
    f"COALESCE(regexp_matches(lower({c}), '{_SEARCH_PATTERN}'), false)"
    for c in ("p_name", "p_brand", "p_type")
)


@register("search_any_field", f"SELECT * FROM part WHERE {_SEARCH_WHERE}")
def search_any_field_q(spark, d):
    return search(_t(spark, d, "part"), SEARCH_TERM)


@register("search_count", f"""
SELECT COUNT(*) AS n, 'Number of hits: ' || CAST(COUNT(*) AS VARCHAR) AS message
FROM part WHERE {_SEARCH_WHERE}""")
def search_count_q(spark, d):
    counted = row_count(search(_t(spark, d, "part"), SEARCH_TERM))
    return counted.withColumn("message", F.format_string("Number of hits: %d", F.col("n")))


_ORDER_DOC_TEXT = """
SELECT o.o_orderkey AS id,
       concat_ws(' ', o.o_orderkey, o.o_custkey, o.o_orderpriority, strftime(o.o_orderdate, '%a %b %d %H:%M:%S UTC %Y'),
                 COALESCE(x.n, 0), CAST(COALESCE(x.cents, 0) AS DOUBLE) / 100, x.lines) AS text,
       COALESCE(x.n_seventh, 0) AS n_seventh
FROM orders o LEFT JOIN (
  SELECT l_orderkey, COUNT(*) AS n, SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS cents,
         COUNT(*) FILTER (WHERE l_linenumber = 7) AS n_seventh,
         string_agg(concat_ws(' ', l_linenumber, l_partkey, l_suppkey, l_orderkey, l_quantity, l_extendedprice, l_returnflag, l_linestatus), ' ') AS lines
  FROM lineitem GROUP BY l_orderkey) x ON x.l_orderkey = o.o_orderkey"""
NESTED_TERM = "7"


def order_docs_to_search(spark, d):
    """Whole order documents: header, totals, every field of every line."""
    docs = D.order_documents(_t(spark, d, "orders"), _t(spark, d, "lineitem"))
    return docs.select("id", "customerId", "orderDescription", "createDate", "lineCount", "orderAmount", "orderLines")


def _seventh(found):
    return found.select("id", F.size(F.filter("orderLines", lambda x: x["id"] == 7)).cast("long").alias("n_seventh"))


@register("search_nested", f"""
SELECT id, n_seventh FROM ({_ORDER_DOC_TEXT}) t
WHERE regexp_matches(lower(text), '(^|[^\\p{{L}}\\p{{N}}]){NESTED_TERM}($|[^\\p{{L}}\\p{{N}}])')""")
def search_nested_q(spark, d):
    """A number searched for in all fields of whole nested documents."""
    return _seventh(search(order_docs_to_search(spark, d), NESTED_TERM))


# 7. Scans ----------------------------------------------------------------------------

@register("scan_delimited", "SELECT * FROM customer")
def scan_delimited_q(spark, d):
    src = _t(spark, d, "customer")
    path = scratch_path(spark, "customer-text")
    write_delimited(src, path)
    return read_delimited(spark, path, layout_of("customer", src.schema))


@register("scan_json_inferred", "SELECT * FROM customer")
def scan_json_inferred_q(spark, d):
    src = _t(spark, d, "customer")
    path = scratch_path(spark, "customer-json")
    write_docs(src, path, fmt="json")
    found = read_json_table(spark, path)  # a pass over the data finds the types
    return found.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in src.schema.fields])


@register("json_schema", """
SELECT * FROM (VALUES (0, 'c_acctbal', 'double'), (1, 'c_custkey', 'bigint'), (2, 'c_mktsegment', 'string'),
                      (3, 'c_name', 'string'), (4, 'c_nationkey', 'bigint')) t(position, name, type)""")
def json_schema_q(spark, d):
    """The schema that inference finds, read off the data."""
    found = _from_json(spark, d, "customer")
    return spark.createDataFrame([(i, f.name, f.dataType.simpleString()) for i, f in enumerate(found.schema.fields)], "position int, name string, type string")


@register("scan_dates", """
SELECT o_orderkey,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '.000Z' AS text,
       o_orderdate AS parsed,
       strftime(o_orderdate, '%a %b %d %H:%M:%S UTC %Y') AS java_text
FROM orders""")
def scan_dates_q(spark, d):
    o = _t(spark, d, "orders").select(
        "o_orderkey",
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".000Z")).alias("text"),
    )
    parsed = o.withColumn("parsed", parse_ts("text"))
    return parsed.withColumn("java_text", java_date_text("parsed", parsed.schema["parsed"].dataType))


@register("scan_head", "SELECT * FROM orders LIMIT 100")
def scan_head_q(spark, d):
    """Any 100 rows (of one file, its first). The limit is the plan's root: a few partitions are read."""
    return _t(spark, d, "orders").limit(100)


# 8. Sinks (written to the shared scratch folder, read back) ---------------------

@register("sink_nested_roundtrip", ORACLE["nest_customer_rollup"])
def sink_nested_roundtrip_q(spark, d):
    """The README job end to end (both document outputs), nested docs read back."""
    c, o, l, e = (_t(spark, d, n) for n in ("customer", "orders", "lineitem", "events"))
    out = D.run_rollup_job(spark, c, o, l, e, scratch_path(spark, "rollup-job"), CUTOFF, THRESHOLDS)
    return _rollup_doc_summary(read_docs(spark, out["customers"], _rollup_docs(spark, d).schema, fmt="json"))


@register("sink_nested_cached", ORACLE["nest_customer_rollup"])
def sink_nested_cached_q(spark, d):
    """The same job with its rollups cached instead of staged."""
    c, o, l, e = (_t(spark, d, n) for n in ("customer", "orders", "lineitem", "events"))
    out = D.run_rollup_job(spark, c, o, l, e, scratch_path(spark, "rollup-job"), CUTOFF, THRESHOLDS, cache=True, missing="drop")
    return _rollup_doc_summary(read_docs(spark, out["customers"], _rollup_docs(spark, d).schema, fmt="json"))


def _as_layouts(spark, d) -> dict[str, DataFrame]:
    """The driver's tables written as delimited text in the README job's layouts, and read back."""
    blank = lambda n: [F.lit("").alias(f"x{i}") for i in range(n)]
    texts = {
        "customer_join": _t(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey"),
        "order_rollup": _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"),
        "order_line_rollup": _t(spark, d, "lineitem").select("l_linenumber", "l_orderkey", *blank(5), "l_extendedprice"),
        "contact_typed": _t(spark, d, "events").select("event_id", "user_id", *blank(5), "event_type"),
    }
    out = {}
    for name, df in texts.items():
        path = scratch_path(spark, f"text-{name}")
        write_delimited(df, path)
        out[name] = read_delimited(spark, path, LAYOUTS[name])
    return out


@register("job_from_text", ORACLE["nest_customer_rollup"])
def job_from_text_q(spark, d):
    """The README job from delimited files to nested documents."""
    t = _as_layouts(spark, d)
    out = D.run_rollup_job(
        spark, t["customer_join"], t["order_rollup"], t["order_line_rollup"], t["contact_typed"], scratch_path(spark, "text-job"),
        CUTOFF, THRESHOLDS, fmt="parquet", columns=LAYOUT_COLUMNS, missing="drop",
    )
    docs = _rollup_doc_summary(spark.read.parquet(out["customers"]))
    return docs.withColumns({"c_custkey": F.col("c_custkey").cast("long")})


@register("job_missing_report", """
SELECT 'line_without_order' AS kind, CAST(l.l_linenumber AS VARCHAR) AS id FROM lineitem l
  WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)
UNION ALL
SELECT 'order_without_customer', CAST(o.o_orderkey AS VARCHAR) FROM orders o
  WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)
UNION ALL
SELECT 'contact_without_customer', CAST(e.event_id AS VARCHAR) FROM events e
  WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = e.user_id)
UNION ALL
SELECT 'order_without_lines', CAST(o.o_orderkey AS VARCHAR) FROM orders o
  WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""")
def job_missing_report_q(spark, d):
    """Rows that the job's documents leave out, as the job reports them."""
    return D.missing_rows(*(_t(spark, d, n) for n in ("customer", "orders", "lineitem", "events")))


@register("sink_flat_typed", f"""
SELECT c_custkey AS id, c_name AS name, total, max, avg, n_orders AS numberOfOrder, bucket AS range
FROM ({_ROLLED_CUSTOMERS}) r""")
def sink_flat_typed_q(spark, d):
    flat = D.flat_customer_documents(_customers_rolled(spark, d))
    path = scratch_path(spark, "flat-docs")
    write_docs(flat, path, fmt="json")
    return read_docs(spark, path, flat.schema, fmt="json")


@register("sink_flat_constant", f"""
SELECT c_custkey AS customerId, c_name AS customerName, c_nationkey AS customerSiren,
       o_orderpriority AS orderDescription, 'constant' AS test
FROM ({_RIGHT_JOIN}) g""")
def sink_flat_constant_q(spark, d):
    docs = flat_docs(
        _right_join(spark, d),
        {"customerId": "c_custkey", "customerName": "c_name", "customerSiren": "c_nationkey",
         "orderDescription": "o_orderpriority"},
        constants={"test": "constant"},
    )
    path = scratch_path(spark, "flat-const-docs")
    write_docs(docs, path, fmt="parquet")
    return spark.read.parquet(path)


@register("sink_string_map", f"""
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS nom, CAST(c_nationkey AS VARCHAR) AS siren,
       c_mktsegment AS slogan, CAST(n AS VARCHAR) AS totalOrder
FROM ({_RIGHT_JOIN}) g""")
def sink_string_map_q(spark, d):
    docs = string_docs(
        _right_join(spark, d),
        {"id": "c_custkey", "nom": "c_name", "siren": "c_nationkey", "slogan": "c_mktsegment", "totalOrder": "n"},
    )
    path = scratch_path(spark, "string-docs")
    write_docs(docs, path, fmt="json")
    return read_docs(spark, path, docs.schema, fmt="json")


@register("sink_string_map_entries", f"""
SELECT c_custkey AS customer, o_orderpriority AS description, e.key AS key, e.value AS value
FROM ({_RIGHT_JOIN}) g,
  LATERAL (VALUES ('id', CAST(g.c_custkey AS VARCHAR)), ('nom', g.c_name), ('siren', CAST(g.c_nationkey AS VARCHAR)),
                  ('totalOrder', CAST(g.n AS VARCHAR))) e(key, value)""")
def sink_string_map_entries_q(spark, d):
    """String-map documents, one row per entry."""
    groups = _right_join(spark, d)
    maps = string_map_docs(groups, {"id": "c_custkey", "nom": "c_name", "siren": "c_nationkey", "totalOrder": "n"}, keep=("c_custkey", "o_orderpriority"))
    return maps.select(F.col("c_custkey").alias("customer"), F.col("o_orderpriority").alias("description"), F.explode(F.map_entries("doc")).alias("e")).select("customer", "description", "e.key", "e.value")
