"""The term index against the scan's search, and what a lookup reads."""

import re

import pytest
from pyspark.sql import functions as F

from docroll.plans import catalog
from docroll.sources import term_index
from docroll.sources.search import search
from docroll.sources.tables import table
from docroll.sources.term_index import build_term_index, search_index, term_counts, tokens_of_term

SMALL = "/root/testdata/sf0.001"
ROWS = [
    (1, "Red ring, small", [{"n": 7, "t": "été-RING"}], {"k": "blue bell"}, b"ring"),
    (2, "ringing", [], {}, None), (3, None, None, None, None), (4, "7.5 a_b", [{"n": None, "t": "x7"}], {"ring": "no"}, None),
    (5, "small red\nring", [{"n": 75, "t": ""}, {"n": 5, "t": "RING!"}], None, None), (None, "ring without key", None, None, None), (5, "same key, no such word", None, None, None),
]
SCHEMA = "id int, text string, items array<struct<n:int,t:string>>, tags map<string,string>, raw binary"


@pytest.mark.parametrize("term", ["ring", "RING", "7", "7.5", "red ring", "small red ring", "été", "bell", "b", "nothing", "-", "75"])
def test_same_rows_as_the_scan(spark, tmp_dir, term):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    build_term_index(df, "id", tmp_dir, buckets=4)
    got, want = search_index(spark, tmp_dir, term), search(df, term)
    assert got.columns == df.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_chosen_columns_and_counts(spark, tmp_dir):
    df = spark.createDataFrame(ROWS, SCHEMA)
    build_term_index(df, "id", tmp_dir, columns=["items"], buckets=2)
    assert sorted(r.id for r in search_index(spark, tmp_dir, "ring").collect()) == [1, 5]
    got = {(r.term, r.field): r.n for r in term_counts(spark, tmp_dir).collect()}
    assert got == {("7", "items.n"): 1, ("été", "items.t"): 1, ("ring", "items.t"): 2, ("x7", "items.t"): 1, ("75", "items.n"): 1, ("5", "items.n"): 1}
    assert tokens_of_term("Small, RED_ring") == ["red", "ring", "small"] and tokens_of_term(" -") == []


def test_a_lookup_reads_one_bucket_and_prunes_documents(spark, tmp_dir):
    docs = catalog.order_docs_to_search(spark, SMALL)
    build_term_index(docs, "id", tmp_dir, buckets=16)
    one = table(spark, SMALL, "orders").agg(F.max("o_orderkey")).first()[0]
    got = search_index(spark, tmp_dir, str(one))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(term_bucket" in plan and f"EqualTo(term,{one})" in plan
    assert "dynamicpruning" in plan and "key_bucket" in plan
    assert sorted(r.id for r in got.collect()) == sorted(r.id for r in search(docs, str(one)).collect())
    terms = spark.read.parquet(f"{tmp_dir}/terms")
    # sorted by term: the files' statistics tell terms apart
    rows = terms.select("term_bucket", "term", F.col("_metadata.file_name").alias("f"), F.col("_metadata.row_index").alias("i")).collect()
    for bucket in {r.term_bucket for r in rows}:
        in_order = [r.term for r in sorted((r for r in rows if r.term_bucket == bucket), key=lambda r: (r.f, r.i))]
        assert in_order == sorted(in_order)


@pytest.mark.parametrize("term", ["5", "0e10", "1", "2024", "true", "nan", "σας", "x", "75", "infinity", "a"])
def test_values_of_any_type_and_depth(spark, tmp_dir, term):
    one = "-5 AS n, 1.0E10D AS d, DATE'2024-03-01' AS day, TIMESTAMP'1999-12-31 23:59:58.25' AS at, true AS yes, 'Σας-ΣΑΣ' AS t, array(array('x y', null), null, array()) AS deep, map('k', array(7, -75, null)) AS m, named_struct('q', cast(0.75 AS decimal(5,2))) AS s"
    two = "null AS n, double('NaN') AS d, null AS day, null AS at, null AS yes, null AS t, array(array('A')) AS deep, null AS m, null AS s"
    df = spark.sql(f"SELECT 1 AS id, {one} UNION ALL SELECT 2, {two} UNION ALL SELECT 3, {one.replace('-5', '75').replace('1.0E10D', 'double(\"-Infinity\")')}")
    build_term_index(df, "id", tmp_dir, buckets=3)
    assert sorted(r.id for r in search_index(spark, tmp_dir, term).collect()) == sorted(r.id for r in search(df, term).collect())


def test_ranges_grow_with_the_documents_and_patterns_are_compiled_once(spark, tmp_dir, monkeypatch):
    docs = catalog.order_docs_to_search(spark, SMALL)
    monkeypatch.setattr(term_index, "TERM_RANGE", 1000)
    build_term_index(docs, "id", tmp_dir, buckets=2)
    files = spark.read.parquet(f"{tmp_dir}/terms").inputFiles()
    assert len(files) > 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    plan = term_index.term_rows(docs, "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "split(regexp_replace(" in plan and not re.search(r"split\((?!regexp_replace)", plan)
