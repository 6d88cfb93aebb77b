from pyspark.sql import functions as F

from docroll.operators import (
    combine_mean,
    count_by,
    global_int_mean,
    keyed_last_doubled,
    keyed_sum,
    row_count,
)
from tests.conftest import rows

NESTED = (
    "customer struct<customerId:int, name:string, order:struct<orderId:int, customerId:int, "
    "orderName:string, orderLine:struct<orderLineId:int, orderId:int, lineAmount:int>>>"
)


def _cust(cid, name, oid, oname, lid, amount):
    return ((cid, name, (oid, cid, oname, (lid, oid, amount))),)


def nested_customers(spark, repeat_row_two=False):
    # FIXTURES 1a (1c when row 3 repeats row 2)
    data = [
        _cust(1, "anna", 1, "a_", 1, 91),
        _cust(1, "anna", 2, "aa", 2, 92),
        _cust(1, "anna", 2, "aa", 2, 92) if repeat_row_two else _cust(1, "anna", 2, "aa", 3, 93),
        _cust(2, "fred", 3, "f_", 4, 94),
        _cust(2, "fred", 4, "ff", 5, 95),
        _cust(2, "fred", 4, "ff", 6, 96),
    ]
    return spark.createDataFrame(data, NESTED)


def test_nested_path_projection(spark):
    df = nested_customers(spark).select(
        F.col("customer.customerId").alias("k"),
        F.col("customer.name").alias("name"),
        F.col("customer.order.orderLine.lineAmount").alias("amount"),
    )
    assert rows(df) == [(1, "anna", 91), (1, "anna", 92), (1, "anna", 93), (2, "fred", 94), (2, "fred", 95), (2, "fred", 96)]


def _flat(spark):
    return nested_customers(spark).select(
        F.col("customer.customerId").alias("k"),
        F.col("customer.order.orderLine.orderLineId").alias("line"),
        F.col("customer.order.orderLine.lineAmount").alias("amount"),
    )


def test_keyed_sum(spark):
    assert rows(keyed_sum(_flat(spark), "k", "amount")) == [(1, 276), (2, 285)]


def test_keyed_last_doubled(spark):
    df = _flat(spark).repartition(3)
    assert rows(keyed_last_doubled(df, "k", "amount", ["line"])) == [(1, 186), (2, 192)]
    single = spark.createDataFrame([(9, 1, 7)], "k int, line int, amount int")
    assert rows(keyed_last_doubled(single, "k", "amount", ["line"])) == [(9, 7)]


def test_value_count(spark):
    df = spark.createDataFrame([(v,) for v in [1, 2, 3, 4, 2, 3]], "x int")
    assert rows(count_by(df, "x")) == [(1, 1), (2, 2), (3, 2), (4, 1)]


def test_count_by_whole_struct(spark):
    got = rows(count_by(nested_customers(spark, repeat_row_two=True), "customer"))
    assert len(got) == 5
    counts = sorted(n for _, n in got)
    assert counts == [1, 1, 1, 1, 2]


def test_combine_mean(spark):
    df = spark.createDataFrame([("Anna", 10), ("Anna", 5), ("Ben", 2)], "key string, value int")
    got = {r.key: r for r in combine_mean(df, "key", "value").collect()}
    assert (got["Anna"].mean, got["Anna"].sum, int(got["Anna"].square), got["Anna"].above) == (7.5, 15, 225, True)
    assert (got["Ben"].mean, got["Ben"].sum, int(got["Ben"].square), got["Ben"].above) == (2.0, 2, 4, False)
    assert dict(combine_mean(df, "key", "value").dtypes)["mean"] == "float"


def test_combine_mean_square_does_not_overflow(spark):
    big = 3_000_000_000
    df = spark.createDataFrame([("k", big), ("k", big)], "key string, value long")
    r = combine_mean(df, "key", "value").first()
    assert int(r.square) == (2 * big) ** 2


def test_global_int_mean(spark):
    df = spark.createDataFrame([(1,), (2,), (2,)], "x int")
    assert global_int_mean(df, "x").first().mean == 1
    neg = spark.createDataFrame([(-7,), (0,)], "x int")
    assert global_int_mean(neg, "x").first().mean == -3  # truncates toward zero
    empty = spark.createDataFrame([], "x int")
    assert global_int_mean(empty, "x").first().mean is None


def test_row_count(spark):
    assert row_count(spark.range(17)).first().n == 17
