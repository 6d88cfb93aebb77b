"""Property tests of the nesting operator against brute force in Python."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from docroll.functions import bucket, money_sum
from docroll.operators import Child, group_documents, nest

SETTINGS = settings(max_examples=8, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))

children_st = st.lists(
    st.tuples(st.integers(0, 4), st.integers(0, 10_000), st.integers(-50_000, 50_000)),
    min_size=0,
    max_size=40,
    unique_by=lambda t: t[1],
)


@SETTINGS
@given(rows=children_st, page_size=st.integers(1, 6))
def test_nest_keeps_every_child_once(spark, rows, page_size):
    parent = spark.createDataFrame([(k, f"p{k}") for k in range(4)], "pk int, name string")
    child_df = spark.createDataFrame(rows, "pk int, id int, cents int")
    child = Child(
        child_df.selectExpr("pk", "id", "cents / 100.0 AS amount"),
        "pk",
        "items",
        ("id", "amount"),
        count_as="n",
        aggs={"total": money_sum("amount")},
        fill={"total": 0.0},
    )
    docs = nest(parent, "pk", [child], page_size=page_size).collect()
    want = Counter(k for k, _, _ in rows if k < 4)
    got_ids = sorted((d.pk, i.id) for d in docs for i in d.items)
    assert got_ids == sorted((k, i) for k, i, _ in rows if k < 4)
    for d in docs:
        assert d.n == want.get(d.pk, 0)
        assert round(d.total * 100) == sum(c for k, _, c in rows if k == d.pk)
        n = want.get(d.pk, 0)
        assert d.parts == max(1, -(-n // page_size))
        assert len(d.items) == min(page_size, n - d.part * page_size)
        assert [i.id for i in d.items] == sorted(i.id for i in d.items)
    # every parent is present (key 4 has no parent: its children are in no document)
    assert {d.pk for d in docs} == {0, 1, 2, 3}
    assert all(sum(1 for d in docs if d.pk == k) <= max(1, -(-want.get(k, 0) // page_size)) for k in range(4))


@SETTINGS
@given(rows=children_st, page_size=st.integers(1, 6))
def test_group_documents_matches_brute_force(spark, rows, page_size):
    df = spark.createDataFrame(rows, "pk int, id int, cents int").selectExpr(
        "CASE WHEN pk = 0 THEN NULL ELSE pk END AS pk", "id"
    )
    docs = group_documents(Child(df, "pk", "items", ("id",), count_as="n"), page_size=page_size).collect()
    want = Counter(None if k == 0 else k for k, _, _ in rows)
    got = Counter()
    for d in docs:
        got[d.pk] += len(d.items)
        assert d.n == want[d.pk]
    assert got == want


@SETTINGS
@given(values=st.lists(st.floats(allow_nan=True, allow_infinity=True, width=64), min_size=1, max_size=20))
def test_bucket_matches_python(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r.b for r in df.select("i", bucket("v").alias("b")).orderBy("i").collect()]

    def py_bucket(v):
        if v != v:
            return 0
        return sum(1 for t in (2500, 3500, 4500, 5500, 6000) if v > t)

    assert got == [py_bucket(v) for v in values]


lines_st = st.lists(
    st.tuples(st.integers(0, 9), st.integers(1, 500_000)),  # (order key, amount in cents)
    min_size=0, max_size=40,
)
orders_st = st.lists(
    st.tuples(st.integers(0, 4), st.integers(0, 3)),  # (customer key, day offset around the cutoff)
    min_size=10, max_size=10,
)


@SETTINGS
@given(lines=lines_st, orders=orders_st)
def test_rollups_match_python(spark, lines, orders):
    import datetime as dt

    from docroll.plans import documents as D

    cutoff = dt.datetime(2010, 1, 1)
    order_rows = [(k, c, "O", 0.0, cutoff + dt.timedelta(days=off - 1), "p") for k, (c, off) in enumerate(orders)]
    line_rows = [(k, 1, 1, i, 1.0, cents / 100, 0.0, 0.0, "N", "O", cutoff) for i, (k, cents) in enumerate(lines)]
    o = spark.createDataFrame(order_rows, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
                              "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string")
    l = spark.createDataFrame(line_rows, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                              "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                              "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")
    c = spark.createDataFrame([(k, f"c{k}") for k in range(4)], "c_custkey bigint, c_name string")
    rc = {r.c_custkey: r for r in D.rolled_customers(D.rolled_orders(o, l), c, "2010-01-01", [10, 20, 30, 40, 5000]).collect()}

    order_cents = Counter()
    for k, cents in lines:
        order_cents[k] += cents
    want = {}
    for k, (cust, off) in enumerate(orders):
        if k not in order_cents or cust >= 4:
            continue  # orders without lines and orders of missing customers are not rolled up
        tot, n, mx = want.get(cust, (0, 0, 0))
        after = cutoff + dt.timedelta(days=off - 1) > cutoff
        want[cust] = (tot + (order_cents[k] if after else 0), n + 1, max(mx, order_cents[k]))
    assert set(rc) == set(want)
    for cust, (tot, n, mx) in want.items():
        r = rc[cust]
        assert (round(r.total * 100), r.n_orders, round(r.max * 100)) == (tot, n, mx)
        assert r.avg == (tot / 100) / n
        assert r.bucket == sum(1 for t in (10, 20, 30, 40, 5000) if tot / 100 > t)


text_st = st.one_of(st.none(), st.text(alphabet="abcAB xé Ö1,-.;'", max_size=12))


@SETTINGS
@given(rows=st.lists(st.tuples(text_st, text_st), min_size=1, max_size=15),
       term=st.text(alphabet="abxé1", min_size=1, max_size=3))
def test_search_matches_whole_tokens(spark, rows, term):
    from docroll.sources import any_field_matches

    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], "i int, a string, b string")
    got = [r.m for r in df.select("i", any_field_matches(df, term).alias("m")).orderBy("i").collect()]

    def tokens(v):
        out, cur = set(), ""
        for ch in (v or "").lower():
            if ch.isalnum():
                cur += ch
            else:
                out.add(cur)
                cur = ""
        out.add(cur)
        return out - {""}

    assert got == [term.lower() in tokens(a) | tokens(b) for a, b in rows]


@SETTINGS
@given(rows=st.lists(st.tuples(
    st.integers(-2**31, 2**31 - 1),
    st.integers(-2**63, 2**63 - 1),
    st.floats(allow_nan=True, allow_infinity=True, width=64),
    st.text(alphabet=st.characters(blacklist_characters=";\n\r", blacklist_categories=("Cs",)), max_size=10),
), min_size=1, max_size=12))
def test_delimited_text_round_trip(spark, rows):
    import math

    from docroll.session import scratch_path
    from docroll.sources.delimited import read_delimited, write_delimited
    from docroll.sources.schemas import layout_of

    src = spark.createDataFrame(rows, "i int, l long, d double, s string")
    path = scratch_path(spark, "prop-delimited")
    write_delimited(src, path)
    back = read_delimited(spark, path, layout_of("t", src.schema))
    assert back.schema == src.schema

    def key(r):
        d = "nan" if isinstance(r[2], float) and math.isnan(r[2]) else r[2]
        return (r[0], r[1], d, r[3])

    assert sorted(map(key, back.collect()), key=repr) == sorted(map(key, rows), key=repr)
