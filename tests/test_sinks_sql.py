import pytest
from pyspark.sql import functions as F

from docroll.plans import documents as D
from docroll.plans import sql_text as S
from docroll.sinks import flat_docs, read_docs, string_docs, string_map_docs, write_docs
from tests import fixtures as X
from tests.conftest import rows


def test_nested_documents_roundtrip_json(spark, tmp_dir):
    docs = D.three_level_documents(X.customers(spark), X.orders(spark), X.lineitem(spark), X.events(spark))
    write_docs(docs, tmp_dir, fmt="json")
    back = read_docs(spark, tmp_dir, docs.schema, fmt="json")
    assert sorted(map(str, back.collect())) == sorted(map(str, docs.collect()))
    # overwrite (default) replaces, never appends
    write_docs(docs, tmp_dir, fmt="json")
    assert read_docs(spark, tmp_dir, docs.schema).count() == docs.count()


def test_flat_and_string_documents(spark, tmp_dir):
    df = spark.createDataFrame([(1, "anna", 7, 3)], "c_custkey bigint, c_name string, c_nationkey int, n bigint")
    flat = flat_docs(df, {"customerId": "c_custkey", "customerName": "c_name"}, constants={"test": "constant"})
    assert rows(flat) == [(1, "anna", "constant")]
    strs = string_docs(df, {"id": "c_custkey", "nom": "c_name", "siren": "c_nationkey", "totalOrder": "n"})
    assert set(dict(strs.dtypes).values()) == {"string"}
    write_docs(strs, tmp_dir, fmt="json")
    assert rows(read_docs(spark, tmp_dir, strs.schema)) == [("1", "anna", "7", "3")]
    m = string_map_docs(df, {"id": "c_custkey", "nom": "c_name"}).first().doc
    assert m == {"id": "1", "nom": "anna"}


def test_sql_jobs_on_fixture_tables(spark, tmp_dir):
    c, o = X.customers(spark), X.orders(spark)
    rj = S.right_join_count(c, o, ordered=True)
    got = rows(rj)
    # the order of missing customer 99 is kept with null customer fields
    assert (None, None, None, None, "d5", 1) in got
    assert (1, "anna", 10, "A", "d1", 1) in got and len(got) == 7
    assert rj.collect()[0].c_name is None  # nulls first
    # namesakes merge when grouped by name
    assert rows(S.inner_join_sum(c, o)) == [("anna", 1500.0), ("fred", 700.0)]


def test_names_with_descriptions_keeps_all_orders(spark, tmp_dir):
    docs = {r.customerName: r for r in D.names_with_descriptions(S.right_join_count(X.customers(spark), X.orders(spark))).collect()}
    assert [x.desc for x in docs["anna"].orderList] == ["d1", "d1", "d2", "d3"]
    assert docs["anna"].customerSiren == 10
    assert [x.desc for x in docs["fred"].orderList] == ["d3", "d4"]
    assert [x.desc for x in docs[None].orderList] == ["d5"]


def test_rename_fields_gives_original_spellings_at_any_depth(spark):
    from docroll.sinks import rename_fields

    docs = D.order_documents(X.orders(spark), X.lineitem(spark))
    legacy = rename_fields(docs)
    assert "orderAmout" in legacy.columns and "orderlines" in legacy.columns
    line_fields = legacy.schema["orderlines"].dataType.elementType.fieldNames()
    assert "amout" in line_fields and "amount" not in line_fields
    a = {r.id: (r.orderAmount, [x.amount for x in r.orderLines]) for r in docs.collect()}
    b = {r.id: (r.orderAmout, [x.amout for x in r.orderlines]) for r in legacy.collect()}
    assert a == b


def test_command_line_jobs(spark, tmp_dir):
    from docroll.__main__ import main

    data = X.write_tables(spark, tmp_dir + "-data")
    out = main(["rollup-job", "--data", data, "--target", tmp_dir + "-job"])
    assert spark.read.json(out["customers"]).count() == 3
    res = main(["order-docs", "--data", data, "--target", tmp_dir + "-orders", "--legacy-names"])
    assert "orderAmout" in spark.read.json(res["written"]).columns
    assert main(["search", "--data", data, "--table", "customer", "--term", "anna"]) == {"rows": 2}
    assert main(["query", "orphan_report", "--data", data]) == {"rows": 4}


def test_sql_job_over_delimited_layouts(spark, tmp_dir):
    """Delimited files in the SQL job's layouts -> views -> SUM per name ->
    text lines and all-string documents."""
    import os

    from docroll.sources import LAYOUTS, read_delimited

    def lines(name, rows):
        path = f"{tmp_dir}-{name}"
        os.makedirs(path, exist_ok=True)
        with open(f"{path}/part-0", "w") as fh:
            fh.write("\n".join(rows) + "\n")
        return path

    cust = read_delimited(spark, lines("c", ["1;anna;fast;111", "2;fred;slow;222", "3;anna;calm;333"]), LAYOUTS["customer_sql"])
    orders = read_delimited(spark, lines("o", ["10;1;d1;5", "11;1;d2;7", "12;2;d3;11", "13;3;d4;2"]), LAYOUTS["order_sql"])
    req = S.inner_join_sum(
        cust.withColumnsRenamed({"customerId": "c_custkey", "name": "c_name"}),
        orders.withColumnsRenamed({"customerId": "o_custkey", "amount": "o_totalprice"}),
    ).withColumnRenamed("c_name", "name")
    assert dict(req.dtypes)["amount"] == "bigint"
    assert rows(req) == [("anna", 14), ("fred", 11)]
    text = rows(req.select(F.format_string("result: [%s,%d]", "name", "amount").alias("t")))
    assert text == [("result: [anna,14]",), ("result: [fred,11]",)]
    assert rows(string_docs(req, {"name": "name", "amount": "amount"})) == [("anna", "14"), ("fred", "11")]


def test_car_layout_to_string_map(spark, tmp_dir):
    import os

    from docroll.sources import LAYOUTS, read_delimited

    os.makedirs(tmp_dir, exist_ok=True)
    with open(f"{tmp_dir}/part-0", "w") as fh:
        fh.write("1997;Ford;E350;ac, abs, moon;3000.0\n2000;Mercury;Cougar;;12.5\n")
    cars = read_delimited(spark, tmp_dir, LAYOUTS["car"])
    maps = [r.doc for r in string_map_docs(cars, {n: n for n in cars.columns}).collect()]
    assert {"year": "1997", "make": "Ford", "model": "E350", "desc": "ac, abs, moon", "price": "3000.0"} in maps
    assert {"year": "2000", "make": "Mercury", "model": "Cougar", "desc": "", "price": "12.5"} in maps


def test_sql_jobs_leave_the_views_of_the_session_alone(spark):
    spark.range(3).createOrReplaceTempView("customer")
    S.right_join_count(X.customers(spark), X.orders(spark), view="derived").collect()
    assert spark.table("customer").count() == 3 and spark.table("derived").count() == 7
    ordered = S.right_join_count(X.customers(spark), X.orders(spark), ordered=True)
    assert [r.c_name for r in ordered.collect()][:2] == [None, "anna"]
    spark.catalog.dropTempView("customer")


def test_json_sql_right_join_and_nesting(spark, tmp_dir):
    import os

    from docroll.sources import read_json_table

    def lines(name, rows):
        path = f"{tmp_dir}-{name}"
        os.makedirs(path, exist_ok=True)
        with open(f"{path}/part-0.json", "w") as fh:
            fh.write("\n".join(rows) + "\n")
        return path

    people = read_json_table(spark, lines("c", [
        '{"id": 1, "name": "anna", "siren": "111", "catchPhrase": "fast"}',
        '{"id": 2, "name": "ben", "siren": "222", "catchPhrase": "slow"}',
    ]))
    orders = read_json_table(spark, lines("o", [
        '{"customerId": 1, "description": "d1"}', '{"customerId": 1, "description": "d2"}',
        '{"customerId": 2, "description": "d3"}', '{"customerId": 2, "description": "d4"}',
        '{"customerId": 9, "description": "d5"}',
    ]))
    grouped = S.right_join_count(
        people.withColumnsRenamed({"id": "c_custkey", "name": "c_name", "siren": "c_nationkey", "catchPhrase": "c_mktsegment"}),
        orders.withColumnsRenamed({"customerId": "o_custkey", "description": "o_orderpriority"}),
        ordered=True,
    )
    assert grouped.first().c_name is None and grouped.count() == 5
    got = {r.customerName: ([x.desc for x in r.orderList], r.customerSiren) for r in D.names_with_descriptions(grouped).collect()}
    assert got == {"anna": (["d1", "d2"], "111"), "ben": (["d3", "d4"], "222"), None: (["d5"], None)}


def test_command_line_job_from_text(spark, tmp_dir):
    from docroll.__main__ import main
    from docroll.sources import write_delimited

    c, o, l, e = X.customers(spark), X.orders(spark), X.lineitem(spark), X.events(spark)
    blank = [F.lit("").alias(f"x{i}") for i in range(5)]
    write_delimited(c.select("c_custkey", "c_name", "c_mktsegment", "c_nationkey"), f"{tmp_dir}-in/customer")
    write_delimited(o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"), f"{tmp_dir}-in/orders")
    write_delimited(l.select("l_linenumber", "l_orderkey", *blank, "l_extendedprice"), f"{tmp_dir}-in/lineitem")
    write_delimited(e.select("event_id", "user_id", *blank, "event_type"), f"{tmp_dir}-in/events")
    text = main(["rollup-job", "--data", f"{tmp_dir}-in", "--target", f"{tmp_dir}-a", "--input-format", "delimited"])
    data = X.write_tables(spark, f"{tmp_dir}-tables")
    same = main(["rollup-job", "--data", data, "--target", f"{tmp_dir}-b"])
    a, b = (spark.read.json(x["customers_flat"]) for x in (text, same))
    assert rows(a) == rows(b) and a.count() == 3
    with pytest.raises(Exception, match="already exists"):
        main(["rollup-job", "--data", data, "--target", f"{tmp_dir}-b", "--mode", "error"])
