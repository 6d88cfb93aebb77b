from docroll.operators import bucket_counts, sorted_head
from docroll.plans import documents as D
from tests import fixtures as X
from tests.conftest import rows


def test_order_rollup_drops_orders_without_lines(spark):
    ro = D.rolled_orders(X.orders(spark), X.lineitem(spark))
    got = rows(ro, "o_orderkey", "total", "n_lines")
    assert got == [(10, 3000.3, 2), (11, 3000.3, 1), (12, 1500.0, 1), (13, 1600.0, 1), (14, 7000.0, 1), (15, 10.0, 1)]


def test_customer_rollup_cutoff_avg_max(spark):
    ro = D.rolled_orders(X.orders(spark), X.lineitem(spark))
    rc = D.rolled_customers(ro, X.customers(spark))  # reference cutoff 2010-01-01
    got = {r.c_custkey: r for r in rc.collect()}
    # customer 1: order 10 is exactly at the cutoff (not after), 11 is after, 16 has no lines
    c1 = got[1]
    assert (c1.total, c1.n_orders, c1.max, c1.avg, c1.bucket) == (3000.3, 2, 3000.3, 3000.3 / 2, 1)
    # customer 2: every order before the cutoff -> total 0, avg 0, count and max over all
    c2 = got[2]
    assert (c2.total, c2.n_orders, c2.max, c2.avg, c2.bucket) == (0.0, 2, 1600.0, 0.0, 0)
    assert got[3].bucket == 5 and got[3].total == 7000.0
    # customers without rolled-up orders are absent; the missing customer 99 too
    assert set(got) == {1, 2, 3}


def test_bucket_counts_and_head(spark):
    ro = D.rolled_orders(X.orders(spark), X.lineitem(spark))
    rc = D.rolled_customers(ro, X.customers(spark))
    assert rows(bucket_counts(rc)) == [(0, 1), (1, 1), (5, 1)]
    head = sorted_head(rc, ["c_custkey"], 2).collect()
    assert [r.c_custkey for r in head] == [1, 2]


def test_flat_customer_documents_names(spark):
    ro = D.rolled_orders(X.orders(spark), X.lineitem(spark))
    flat = D.flat_customer_documents(D.rolled_customers(ro, X.customers(spark)))
    assert flat.columns == ["id", "name", "total", "max", "avg", "numberOfOrder", "range"]
