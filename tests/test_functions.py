import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docroll.functions import (
    as_strings,
    bucket,
    doc_json,
    exact_sum,
    java_date_text,
    money_sum,
    parse_ts,
    string_map,
)


def test_bucket_reference_thresholds(spark):
    # FIXTURES 1e
    vals = [-5.0, 0.0, 2500.0, 2500.01, 3500.01, 4500.01, 5500.01, 6000.0, 6000.01, float("nan"), None]
    want = [0, 0, 0, 1, 2, 3, 4, 4, 5, 0, 0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v double")
    got = [r.b for r in df.select("i", bucket("v").alias("b")).orderBy("i").collect()]
    assert got == want


def test_bucket_custom_thresholds(spark):
    df = spark.createDataFrame([(100.0,), (250001.0,), (700000.0,)], "v double")
    got = sorted(r.b for r in df.select(bucket("v", [250000, 350000, 450000, 550000, 600000]).alias("b")).collect())
    assert got == [0, 1, 5]


def test_money_sum_is_exact_and_order_free(spark):
    vals = [0.1, 0.2, 0.3] * 1000 + [1e6 + 0.01]
    df = spark.createDataFrame([(v,) for v in vals], "v double").repartition(7)
    assert df.agg(money_sum("v").alias("s")).first().s == 1000600.01


def test_parse_ts_ignores_trailing_text(spark):
    df = spark.createDataFrame(
        [("2010-01-01T00:00:00",), ("2010-01-01T00:00:01.000Z",)], "s string"
    )
    got = [r.t for r in df.select(parse_ts("s").alias("t")).orderBy("t").collect()]
    assert got == [dt.datetime(2010, 1, 1, 0, 0, 0), dt.datetime(2010, 1, 1, 0, 0, 1)]


def test_parse_ts_month_13(spark):
    df = spark.createDataFrame([("2010-13-01T00:00:00",)], "s string")
    assert df.select(parse_ts("s", strict=False).alias("t")).first().t is None
    with pytest.raises(Exception):
        df.select(parse_ts("s").alias("t")).collect()


def test_java_date_text(spark):
    df = spark.createDataFrame([(dt.datetime(2010, 1, 5, 3, 4, 5),)], T.StructType([T.StructField("t", T.TimestampNTZType())]))
    text = df.select(java_date_text("t", df.schema["t"].dataType).alias("s"))
    assert text.first().s == "Tue Jan 05 03:04:05 UTC 2010"
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        zoned = spark.sql("SELECT timestamp '2010-01-05 03:04:05 UTC' AS t")
        assert zoned.select(java_date_text("t", zoned.schema["t"].dataType).alias("s")).first().s == "Tue Jan 05 12:04:05 JST 2010"
        assert df.select(java_date_text("t", df.schema["t"].dataType).alias("s")).first().s == "Tue Jan 05 03:04:05 UTC 2010"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_sums_keep_small_amounts_integers_and_nan(spark):
    df = spark.createDataFrame([(0.004, 1)] * 1000, "v double, i int")
    got = df.agg(exact_sum(df, "v").alias("v"), exact_sum(df, "i").alias("i"), money_sum("v", 2).alias("cents"))
    assert got.first() == (4.0, 1000, 0.0) and dict(got.dtypes)["i"] == "bigint"
    nan = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "v double")
    assert nan.agg(money_sum("v").alias("s")).first().s != nan.agg(money_sum("v").alias("s")).first().s
    assert nan.where("v IS NULL").agg(money_sum("v").alias("s")).first().s is None


def test_string_forms(spark):
    df = spark.createDataFrame([(1, "a", 12.5, 10000000.0, None)], "i int, s string, d double, big double, n string")
    strs = as_strings(df, {"id": "i", "name": "s", "price": "d", "big": "big", "none": "n"}).first()
    assert (strs.id, strs.name, strs.price, strs.big, strs.none) == ("1", "a", "12.5", "1.0E7", None)
    m = df.select(string_map({"id": "i", "price": "d"}).alias("m")).first().m
    assert m == {"id": "1", "price": "12.5"}


def test_doc_json_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert df.select(doc_json(F.struct("a", "b")).alias("j")).first().j == '{"a":1,"b":null}'
    assert df.select(doc_json(F.struct("a", "b"), keep_nulls=False).alias("j")).first().j == '{"a":1}'
