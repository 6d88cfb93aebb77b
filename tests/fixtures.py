"""Hand-made tables in the driver's column layout, with the edge cases the
driver's tables lack (orphans, childless parents, namesakes, cutoff ties)."""

from __future__ import annotations

import datetime as dt

CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
ORDERS = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string"
)
LINEITEM = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
    "l_linestatus string, l_shipdate timestamp_ntz"
)
EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"

D = dt.datetime


def customers(spark):
    return spark.createDataFrame(
        [
            (1, "anna", 10, 1.0, "A"),
            (2, "fred", 20, 2.0, "B"),
            (3, "anna", 30, 3.0, "C"),   # namesake of 1
            (4, "nobody", 40, 4.0, "D"),  # contacts, no orders
            (5, "empty", 50, 5.0, "E"),   # neither
        ],
        CUSTOMER,
    )


def orders(spark):
    return spark.createDataFrame(
        [
            (10, 1, "O", 100.0, D(2010, 1, 1, 0, 0, 0), "d1"),   # exactly the cutoff: not after
            (11, 1, "O", 200.0, D(2010, 1, 1, 0, 0, 1), "d2"),   # one second after
            (12, 2, "F", 300.0, D(2009, 6, 1), "d3"),
            (13, 2, "F", 400.0, D(2009, 7, 1), "d4"),            # all of 2's orders before the cutoff
            (14, 3, "O", 500.0, D(2011, 1, 1), "d1"),
            (15, 99, "O", 600.0, D(2011, 1, 1), "d5"),           # customer missing
            (16, 1, "O", 700.0, D(2012, 1, 1), "d3"),            # no lines
        ],
        ORDERS,
    )


def lineitem(spark):
    ship = D(2010, 2, 1)
    return spark.createDataFrame(
        [
            (10, 1, 1, 1, 1.0, 1000.10, 0.0, 0.0, "N", "O", ship),
            (10, 2, 1, 2, 2.0, 2000.20, 0.0, 0.0, "N", "O", ship),
            (11, 3, 1, 1, 3.0, 3000.30, 0.0, 0.0, "R", "F", ship),
            (12, 1, 2, 1, 1.0, 1500.00, 0.0, 0.0, "N", "O", ship),
            (13, 1, 2, 1, 1.0, 1600.00, 0.0, 0.0, "N", "O", ship),
            (14, 5, 3, 1, 1.0, 7000.00, 0.0, 0.0, "A", "F", ship),
            (15, 5, 3, 1, 1.0, 10.00, 0.0, 0.0, "A", "F", ship),
            (77, 5, 3, 1, 1.0, 20.00, 0.0, 0.0, "A", "F", ship),   # order missing
        ],
        LINEITEM,
    )


def events(spark):
    t = D(2024, 1, 1)
    return spark.createDataFrame(
        [
            (100, t, 1, "click", 1.0, "{}"),
            (101, t, 1, "view", 2.0, "{}"),
            (102, t, 4, "click", 3.0, "{}"),
            (103, t, 42, "error", 4.0, "{}"),   # customer missing
        ],
        EVENTS,
    )


def write_tables(spark, folder):
    for name, fn in [("customer", customers), ("orders", orders), ("lineitem", lineitem), ("events", events)]:
        fn(spark).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return folder
