import os

import pytest
from pyspark.sql import types as T

from docroll.sources import LAYOUTS, any_field_matches, read_delimited, read_json_table, schema_text, search, text_keyed
from docroll.sources.schemas import layout_of
from docroll.sources.delimited import write_delimited
from tests.conftest import rows


def _write_lines(path, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.txt"), "w") as fh:
        fh.write("\n".join(lines) + "\n")
    return path


def test_delimited_layouts_by_position(spark, tmp_dir):
    p = _write_lines(tmp_dir, ["1;2;xx;7.5;extra", "2;3;yy;8", "3;4;;9;"])
    df = read_delimited(spark, p, LAYOUTS["order_line_short"])
    assert df.columns == ["orderLineId", "orderId", "lineAmount"]
    assert rows(df) == [(1, 2, 7.5), (2, 3, 8.0), (3, 4, 9.0)]


def test_delimited_keeps_empty_text_and_trailing_fields(spark, tmp_dir):
    p = _write_lines(tmp_dir, ["1;;x;", "2;n;;"])
    df = read_delimited(spark, p, LAYOUTS["customer_join"])
    assert rows(df) == [(1, "", "x", ""), (2, "n", "", "")]


def test_delimited_bad_rows_fail(spark, tmp_dir):
    short = _write_lines(tmp_dir + "-short", ["1;anna"])
    with pytest.raises(Exception):
        read_delimited(spark, short, LAYOUTS["customer_join"]).collect()
    bad = _write_lines(tmp_dir + "-bad", ["x;anna;c;s"])
    with pytest.raises(Exception):
        read_delimited(spark, bad, LAYOUTS["customer_join"]).collect()


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_rows_fail_whatever_is_asked_for(spark, tmp_dir, ansi):
    p = _write_lines(tmp_dir, ["1;anna;c;s", "x;bad;c;s", "3;carl;c;s"])
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = read_delimited(spark, p, LAYOUTS["customer_join"])
        for ask in (df.count, df.select("name").collect, df.collect, lambda: df.where("name = 'anna'").count()):
            with pytest.raises(Exception, match="bad row"):
                ask()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_text_keys_match_as_text(spark, tmp_dir):
    p = _write_lines(tmp_dir, ["007;bond;c;s", "7;seven;c;s"])
    assert rows(read_delimited(spark, p, text_keyed(LAYOUTS["customer_join"])), "customerId") == [("007",), ("7",)]
    assert rows(read_delimited(spark, p, LAYOUTS["customer_join"]), "customerId") == [(7,), (7,)]


def test_json_schema_skips_inference_and_bad_lines_raise(spark, tmp_dir):
    p = _write_lines(tmp_dir, ['{"id": 1, "rare": true}', '{"id": 2}'])
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup("json"))
    spark.sparkContext.setJobGroup("json", "json")
    try:
        known = read_json_table(spark, p, schema=T.StructType([T.StructField("id", T.IntegerType())]))
        assert jobs() == 0
        assert dict(read_json_table(spark, p).dtypes) == {"id": "bigint", "rare": "boolean"} and jobs() == 1
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert rows(known) == [(1,), (2,)]
    bad = _write_lines(tmp_dir + "-bad", ['{"id": 1}', "not json"])
    with pytest.raises(Exception):
        read_json_table(spark, bad, schema=known.schema).collect()
    assert rows(read_json_table(spark, bad, schema=known.schema, on_bad="null")) == [(1,), (None,)]


def test_delimited_quarantine(spark, tmp_dir):
    p = _write_lines(tmp_dir, ["1;anna;c;s", "x;bad;c;s", "2;short", ' 12 ;blank;c;s', '3;"lone;c;s'])
    good, bad = read_delimited(spark, p, LAYOUTS["customer_join"], on_bad="quarantine")
    # Spark trims blanks around numbers; a lone quote is plain text (no quoting)
    assert rows(good) == sorted([(1, "anna", "c", "s"), (3, '"lone', "c", "s"), (12, "blank", "c", "s")], key=repr)
    assert rows(bad) == [("2;short",), ("x;bad;c;s",)]


def test_delimited_timestamps(spark, tmp_dir):
    p = _write_lines(tmp_dir, ["1;2;name;2010-01-01T00:00:00;2010-01-02T00:00:00.000Z;2010-01-03T10:11:12"])
    r = read_delimited(spark, p, LAYOUTS["order_join"]).first()
    assert str(r.createdDate) == "2010-01-01 00:00:00" and str(r.updatedDate) == "2010-01-02 00:00:00"


def test_delimited_roundtrip(spark, tmp_dir):
    src = spark.createDataFrame([(1, "a", 1.5), (2, "b", None)], "k bigint, s string, d double")
    write_delimited(src, tmp_dir)
    good, bad = read_delimited(spark, tmp_dir, layout_of("t", src.schema), on_bad="quarantine")
    assert rows(good) == [(1, "a", 1.5)] and rows(bad) == [("2;b;",)]


def test_json_inferred_schema_and_view(spark, tmp_dir):
    _write_lines(tmp_dir, ['{"id": 1, "name": "anna", "siren": "123"}', '{"id": 2, "name": "fred"}'])
    df = read_json_table(spark, tmp_dir, name="customers_json")
    assert dict(df.dtypes)["id"] == "bigint"  # JSON integers infer as bigint
    assert "|-- siren: string" in schema_text(df)
    assert rows(spark.sql("SELECT id, siren FROM customers_json")) == [(1, "123"), (2, None)]


def test_search_whole_word_any_case_any_field(spark):
    df = spark.createDataFrame(
        [(1, "Anna Martin", None), (2, "annabel", "x"), (3, None, "met ANNA."), (4, None, None), (5, "anna-b", "")],
        "id int, a string, b string",
    )
    assert rows(search(df, "anna"), "id") == [(1,), (3,), (5,)]
    flags = rows(df.select("id", any_field_matches(df, "anna").alias("m")))
    assert flags == [(1, True), (2, False), (3, True), (4, False), (5, True)]
    assert rows(search(df, "anna", columns=["b"]), "id") == [(3,)]


def test_search_reaches_numbers_and_nested_fields(spark):
    df = spark.createDataFrame(
        [(1, [("Anna x", 5)], {"k": "v"}), (2, [("b", 42)], {"k": "anna"}), (3, [], None), (4, None, {})],
        "id int, items array<struct<name:string,n:int>>, m map<string,string>",
    )
    assert rows(search(df, "anna"), "id") == [(1,), (2,)]
    assert rows(search(df, "42"), "id") == [(2,)]
    assert rows(search(df, "3"), "id") == [(3,)]


def test_delimited_roundtrip_dates_and_timestamps(spark, tmp_dir):
    import datetime as dt

    from pyspark.sql import types as T

    schema = T.StructType([
        T.StructField("k", T.LongType()),
        T.StructField("d", T.DateType()),
        T.StructField("ntz", T.TimestampNTZType()),
        T.StructField("ltz", T.TimestampType()),
    ])
    src = spark.createDataFrame(
        [(1, dt.date(2010, 1, 5), dt.datetime(2010, 1, 5, 3, 4, 5), dt.datetime(2011, 2, 3, 4, 5, 6))], schema
    )
    write_delimited(src, tmp_dir)
    back = read_delimited(spark, tmp_dir, layout_of("t", src.schema))
    assert back.schema == src.schema
    assert back.collect() == src.collect()
