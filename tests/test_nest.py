import pytest
from pyspark.sql import functions as F

from docroll.functions import money_sum
from docroll.operators import Child, check_orphans, first_per_key, group_documents, nest, orphans
from docroll.plans import documents as D
from tests import fixtures as X
from tests.conftest import rows


def test_order_documents_lines_and_empty(spark):
    docs = D.order_documents(X.orders(spark), X.lineitem(spark))
    got = {r.id: r for r in docs.collect()}
    assert set(got) == {10, 11, 12, 13, 14, 15, 16}  # the line of missing order 77 is in no document
    assert [line.id for line in got[10].orderLines] == [1, 2]
    assert got[10].orderAmount == 3000.3 and got[10].lineCount == 2
    # an order without lines: empty list (not [{null}]), zero totals
    assert got[16].orderLines == [] and got[16].lineCount == 0 and got[16].orderAmount == 0.0
    assert got[10].createDate == "Fri Jan 01 00:00:00 UTC 2010"
    assert {(r.part, r.parts) for r in got.values()} == {(0, 1)}


def test_customer_documents_two_children_no_fanout(spark):
    docs = D.customer_documents(X.customers(spark), X.orders(spark), X.events(spark))
    got = {r.id: r for r in docs.collect()}
    assert docs.count() == 5
    assert [o.id for o in got[1].orders] == [10, 11, 16] and [c.id for c in got[1].contacts] == [100, 101]
    assert got[4].orders == [] and [c.id for c in got[4].contacts] == [102]
    assert got[5].orders == [] and got[5].contacts == []
    assert (got[1].orderCount, got[1].contactCount, got[5].orderCount) == (3, 2, 0)


def test_three_level_documents(spark):
    docs = D.three_level_documents(X.customers(spark), X.orders(spark), X.lineitem(spark), X.events(spark))
    got = {r.customerId: r for r in docs.collect()}
    c1 = got[1]
    assert [o.id for o in c1.orders] == [10, 11, 16]
    assert [len(o.orderLines) for o in c1.orders] == [2, 1, 0]
    assert [o.orderAmount for o in c1.orders] == [3000.3, 3000.3, 0.0]
    assert got[5].orders == []


def test_rollup_documents(spark):
    ro = D.rolled_orders(X.orders(spark), X.lineitem(spark))
    rc = D.rolled_customers(ro, X.customers(spark))
    docs = D.rollup_documents(rc, ro, X.events(spark))
    got = {r.customerId: r for r in docs.collect()}
    assert set(got) == {1, 2, 3}
    assert [o.orderId for o in got[1].orders] == [10, 11]
    assert got[1].orders[0].orderTotal == 3000.3
    assert [c.type for c in got[1].contacts] == ["click", "view"]
    assert "numberOfOrder" not in docs.columns and got[1].range == 1


def test_orphan_reports(spark):
    assert rows(orphans(X.lineitem(spark), X.orders(spark), "l_orderkey", "o_orderkey"), "l_orderkey") == [(77,)]
    assert rows(orphans(X.orders(spark), X.customers(spark), "o_custkey", "c_custkey"), "o_orderkey") == [(15,)]
    assert rows(orphans(X.events(spark), X.customers(spark), "user_id", "c_custkey"), "event_id") == [(103,)]
    with pytest.raises(ValueError):
        check_orphans(X.orders(spark), X.customers(spark), "o_custkey", "c_custkey", policy="fail")
    assert check_orphans(X.orders(spark), X.customers(spark), "o_custkey", "c_custkey", policy="drop") is None


def test_first_per_key_is_deterministic(spark):
    df = spark.createDataFrame(
        [(1, 3, "c"), (1, 1, "b"), (1, 1, "a"), (2, 5, "z")], "k int, seq int, v string"
    ).repartition(4)
    assert rows(first_per_key(df, "k", ["seq"])) == [(1, 1, "a"), (2, 5, "z")]


def _hot_child(spark, n_hot=23, n_cold=3):
    data = [(1, i, float(i)) for i in range(n_hot)] + [(2, i, 1.0) for i in range(n_cold)]
    return spark.createDataFrame(data, "pk int, id int, amount double")


def test_pages_brute_force(spark):
    child_df = _hot_child(spark)
    parent = spark.createDataFrame([(1, "hot"), (2, "cold"), (3, "none")], "pk int, name string")
    child = Child(child_df, "pk", "items", ("id", "amount"), count_as="n", aggs={"total": money_sum("amount")}, fill={"total": 0.0})
    docs = nest(parent, "pk", [child], page_size=5).collect()
    hot = sorted((d for d in docs if d.pk == 1), key=lambda d: d.part)
    # ids below 64 are buckets of their own, so pages run in id order
    assert [[i.id for i in d.items] for d in hot] == [list(range(k, min(k + 5, 23))) for k in range(0, 23, 5)]
    assert all((d.parts, d.n, d.total) == (5, 23, float(sum(range(23)))) for d in hot)
    cold = [d for d in docs if d.pk == 2]
    assert len(cold) == 1 and cold[0].part == 0 and cold[0].parts == 1 and len(cold[0].items) == 3
    none = [d for d in docs if d.pk == 3]
    assert len(none) == 1 and none[0].items == [] and none[0].n == 0 and none[0].total == 0.0


def test_pages_depend_on_values_alone(spark):
    parent = spark.createDataFrame([(1, "hot")], "pk int, name string")
    rows_ = [(1, i * 37 % 1000, f"v{i}") for i in range(300)] + [(1, 5, "same")] * 40

    def pages(parts):
        df = spark.createDataFrame(rows_, "pk int, id int, v string").repartition(parts)
        return sorted((d.part, tuple((i.id, i.v) for i in d.items)) for d in nest(parent, "pk", [Child(df, "pk", "items", ("id", "v"))], page_size=7).collect())

    two, five = pages(2), pages(5)
    assert two == five
    assert [len(items) for _, items in two] == [7] * 48 + [4]
    order = sorted(((r[1], r[2]) for r in rows_), key=lambda x: (x[0] % 64, x))
    assert [sorted(order[k : k + 7]) for k in range(0, 340, 7)] == [list(items) for _, items in two]


def test_two_children_page_side_by_side(spark):
    parent = spark.createDataFrame([(1, "hot")], "pk int, name string")
    a = Child(_hot_child(spark), "pk", "a_items", ("id",), count_as="na")
    b = Child(spark.createDataFrame([(1, 100), (1, 101)], "pk int, id int"), "pk", "b_items", ("id",), count_as="nb")
    docs = nest(parent, "pk", [a, b], page_size=5).collect()
    assert len(docs) == 5
    assert sorted(i.id for d in docs for i in d.a_items) == list(range(23))
    assert [[i.id for i in d.b_items] for d in sorted(docs, key=lambda d: d.part)] == [[100, 101], [], [], [], []]
    assert all(d.na == 23 and d.nb == 2 for d in docs)


def test_group_documents_null_key_and_hot_split(spark):
    df = spark.createDataFrame(
        [("A", "d1", 1), ("A", "d2", 1), ("B", "d3", 2), ("B", "d4", 2), (None, "d5", None)],
        "name string, desc string, siren int",
    )
    child = Child(df, "name", "orderList", ("desc",), aggs={"siren": F.min("siren")})
    got = {r.name: r for r in group_documents(child).collect()}
    # the whole list per name (the reference's driver loop lost B's first order)
    assert [x.desc for x in got["A"].orderList] == ["d1", "d2"]
    assert [x.desc for x in got["B"].orderList] == ["d3", "d4"]
    assert [x.desc for x in got[None].orderList] == ["d5"]
    split = group_documents(child, page_size=1).collect()
    assert sorted(x.desc for r in split for x in r.orderList) == ["d1", "d2", "d3", "d4", "d5"]
    assert {r.name for r in split} == {"A", "B", None}
    assert all(r.parts == 2 for r in split if r.name in ("A", "B"))


def test_nest_without_split(spark):
    parent = spark.createDataFrame([(1, "hot")], "pk int, name string")
    child = Child(_hot_child(spark), "pk", "items", ("id",))
    docs = nest(parent, "pk", [child], page_size=None).collect()
    assert len(docs) == 1 and len(docs[0].items) == 23


def test_report_policy_returns_orphans(spark):
    report = check_orphans(X.events(spark), X.customers(spark), "user_id", "c_custkey", policy="report")
    assert rows(report, "event_id") == [(103,)]
    with pytest.raises(ValueError):
        check_orphans(X.events(spark), X.customers(spark), "user_id", "c_custkey", policy="ignore")


def test_run_rollup_job_writes_both_documents(spark, tmp_dir):
    out = D.run_rollup_job(
        spark, X.customers(spark), X.orders(spark), X.lineitem(spark), X.events(spark), tmp_dir, keep_stage=True
    )
    flat = spark.read.json(out["customers_flat"])
    assert sorted(r.id for r in flat.collect()) == [1, 2, 3]
    assert set(flat.columns) == {"id", "name", "total", "max", "avg", "numberOfOrder", "range"}
    nested = spark.read.json(out["customers"])
    got = {r.customerId: r for r in nested.collect()}
    assert [o.orderId for o in got[1].orders] == [10, 11] and len(got[1].contacts) == 2
    assert spark.read.parquet(out["orders_rolled"]).count() == 6


def test_run_rollup_job_cached_gives_same_documents(spark, tmp_dir):
    args = (spark, X.customers(spark), X.orders(spark), X.lineitem(spark), X.events(spark))
    staged = D.run_rollup_job(*args, tmp_dir + "-staged")
    cached = D.run_rollup_job(*args, tmp_dir + "-cached", cache=True)
    for key in ("customers_flat", "customers"):
        a = sorted(map(str, spark.read.json(staged[key]).collect()))
        b = sorted(map(str, spark.read.json(cached[key]).collect()))
        assert a == b
    assert not spark.sparkContext._jsc.getPersistentRDDs()  # nothing left cached


def _job(spark, target, **how):
    return D.run_rollup_job(spark, X.customers(spark), X.orders(spark), X.lineitem(spark), X.events(spark), target, **how)


def test_run_rollup_job_deletes_only_its_own_stage(spark, tmp_dir, monkeypatch):
    import os

    stage = tmp_dir + "-stage"
    os.makedirs(stage)
    open(f"{stage}/mine.txt", "w").close()
    out = _job(spark, tmp_dir, stage_dir=stage)
    assert "orders_rolled" not in out and os.listdir(stage) == ["mine.txt"]
    assert spark.read.json(out["customers"]).count() == 3

    def broken(*args, **kwargs):
        raise RuntimeError("midway")

    monkeypatch.setattr(D, "rollup_documents", broken)
    with pytest.raises(RuntimeError, match="midway"):
        _job(spark, tmp_dir + "-2", stage_dir=stage)
    assert os.listdir(stage) == ["mine.txt"]


def test_run_rollup_job_modes_names_and_missing_rows(spark, tmp_dir):
    out = _job(spark, tmp_dir, mode="append", legacy_names=True)
    _job(spark, tmp_dir, mode="append", legacy_names=True)
    assert spark.read.json(out["customers_flat"]).count() == 6
    with pytest.raises(Exception, match="already exists"):
        _job(spark, tmp_dir, mode="error")
    missing = {(r.kind, r.id) for r in spark.read.json(out["missing"]).collect()}
    assert missing == {("line_without_order", "1"), ("order_without_customer", "15"), ("contact_without_customer", "103"), ("order_without_lines", "16")}
    assert "missing" not in _job(spark, tmp_dir + "-drop", missing="drop")
    with pytest.raises(ValueError, match="partner"):
        _job(spark, tmp_dir + "-fail", missing="fail")


def test_nan_amounts_reach_bucket_zero(spark):
    lines = X.lineitem(spark).selectExpr("*").withColumn("l_extendedprice", F.when(F.col("l_orderkey") == 14, F.lit(float("nan"))).otherwise(F.col("l_extendedprice")))
    rc = {r.c_custkey: r for r in D.rolled_customers(D.rolled_orders(X.orders(spark), lines), X.customers(spark)).collect()}
    assert rc[3].total != rc[3].total and rc[3].bucket == 0 and rc[1].total == 3000.3


def test_integer_amounts_stay_integers(spark):
    lines = spark.createDataFrame([(1, 1, 3), (2, 1, 4)], "orderLineId int, orderId int, lineAmount int")
    orders = spark.createDataFrame([(1, 7, "d"), (2, 7, "e")], "orderId int, customerId int, orderName string")
    from docroll.plans.columns import LAYOUT_COLUMNS

    docs = D.order_documents(orders, lines, columns=LAYOUT_COLUMNS)
    assert dict(docs.dtypes)["orderAmount"] == "bigint"
    assert sorted((r.id, r.orderAmount) for r in docs.collect()) == [(1, 7), (2, 0)]


def test_key_match_counts_text_vs_int_with_duplicates(spark):
    from docroll.operators import key_match_counts

    child = spark.createDataFrame([("1",), ("1",), ("01",), ("x",), (None,)], "k string")
    parent = spark.createDataFrame([("1",), ("01",), ("01",)], "k string")
    r = key_match_counts(child, parent, "k", "k").first()
    # text: '1' 2x1 + '01' 1x2 = 4; int: 1 -> 3 child rows x 3 parent rows = 9
    assert (r.n_text, r.n_typed) == (4, 9)


def test_orphans_null_keys_and_shuffled_path(spark):
    child = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (9, "d"), (9, "e")], "k int, v string")
    parent = spark.createDataFrame([(1,), (2,)], "k int")
    assert rows(orphans(child, parent, "k"), "v") == [("c",), ("d",), ("e",)]
    none = orphans(child.where("k = 1"), parent, "k")
    assert none.count() == 0 and none.columns == child.columns


def test_one_parent_per_key(spark):
    parent = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "pk int, name string")
    child = Child(spark.createDataFrame([(1, 10), (2, 20)], "pk int, id int"), "pk", "items", ("id",))
    dup = nest(parent, "pk", [child]).collect()
    one = nest(parent, "pk", [child], one_per_key=True).collect()
    assert len(dup) == 3
    assert sorted((r.pk, r.name, [i.id for i in r.items]) for r in one) == [(1, "a", [10]), (2, "c", [20])]


@pytest.mark.parametrize("n", [50, 100, 200])
def test_pages_of_nested_lists_grow_with_the_lines(spark, n):
    """One customer with one order of n lines: pages grow in proportion, and none is empty."""
    orders = X.orders(spark).where("o_orderkey = 10")
    lines = X.lineitem(spark).where("l_orderkey = 11").drop("l_linenumber", "l_orderkey").crossJoin(spark.range(n).selectExpr("cast(id as int) as l_linenumber", "10L as l_orderkey"))
    docs = D.three_level_documents(X.customers(spark).where("c_custkey = 1"), orders, lines, X.events(spark).where("false"), page_size=5).collect()
    order_pages = -(-n // 5)
    assert len(docs) == order_pages and all(d.parts == order_pages for d in docs)
    assert all(len(d.orders) == 1 and 1 <= len(d.orders[0].orderLines) <= 5 for d in docs)
    assert sorted(x.id for d in docs for o in d.orders for x in o.orderLines) == list(range(n))


def test_sums_come_with_the_bucket_sums(spark):
    """Exact sums as of ``aggs``, without an aggregate and a join of their own; names of internal columns do not clash."""
    data = [(1, i, i % 7, float(i) / 100) for i in range(300)] + [(2, 1, 5, float("nan")), (2, 65, 6, 1.5), (3, 2, None, None)]
    child_df = spark.createDataFrame(data, "pk int, id int, whole int, amount double").repartition(3)
    parent = spark.createDataFrame([(1, "hot"), (2, "nan"), (3, "null"), (4, "none")], "pk int, name string")
    by_sums = Child(child_df, "pk", "items", ("id",), sums={"sum": "amount", "n": "whole"}, fill={"sum": 0.0, "n": 0})
    by_aggs = Child(child_df, "pk", "items", ("id",), aggs={"sum": money_sum("amount"), "n": F.sum("whole")}, fill={"sum": 0.0, "n": 0})
    got, plain, want = (nest(parent, "pk", [c], page_size=p) for c, p in ((by_sums, 7), (by_sums, None), (by_aggs, 7)))
    assert got.dtypes == want.dtypes and list(map(repr, rows(got))) == list(map(repr, rows(want)))  # NaN equals no NaN
    whole = {r.pk: (repr(r["sum"]), r.n) for r in plain.collect()}
    assert whole == {r.pk: (repr(r["sum"]), r.n) for r in got.collect()} == {1: ("448.5", sum(i % 7 for i in range(300))), 2: ("nan", 11), 3: ("0.0", 0), 4: ("0.0", 0)}
    exchanges = [df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") for df in (got, want)]
    assert exchanges[0] < exchanges[1]


def test_three_levels_shuffle_order_documents_once_a_use(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = D.three_level_documents(X.customers(spark), X.orders(spark), X.lineitem(spark), X.events(spark))
        assert docs._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") < 20
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
