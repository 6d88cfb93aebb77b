"""Records of varying shape: paths and types, typed columns and what is left."""

import json

import pytest
from pyspark.sql import functions as F

from docroll.sources.varied import RECORD, read_varied_json, record_fields, typed_fields

LINES = [
    '{"id":1,"u":{"id":5,"x y":[1,2.5]},"t":100.50}', "", "   ", '{"id":"e","u":{},"a":[],"n":null}', "7", '{"id":"12","u":{"id":1.5},"it\'s":true}',
    '{"id":2.5,"t":"no","deep":{"a":{"b":{"c":{"d":1}}}}}', '{"id":99999999999,"t":3}', "null", "[{\"id\":1},2]",
]


@pytest.fixture()
def records(spark, tmp_dir):
    spark.createDataFrame([(x,) for x in LINES], "value string").repartition(3).write.text(tmp_dir)
    return read_varied_json(spark, tmp_dir)


def test_fields(records):
    got = {r.path: (r.type, r.n) for r in record_fields(records).collect()}
    assert got == {
        "$.id": ("VARIANT", 5), "$.u.id": ("DECIMAL(21,1)", 2), "$.u['x y'][*]": ("DECIMAL(21,1)", 2), "$.t": ("VARIANT", 3),
        "$.u": ("OBJECT<>", 1), "$.a": ("ARRAY<VOID>", 1), "$.n": ("VOID", 1), "$": ("BIGINT", 2), "$['it\\'s']": ("BOOLEAN", 1),
        "$.deep.a.b.c": ("OBJECT<d: BIGINT>", 1), "$[*].id": ("BIGINT", 1), "$[*]": ("BIGINT", 1),
    }
    deeper = {r.path: r.type for r in record_fields(records, depth=6).collect()}
    assert deeper["$.deep.a.b.c.d"] == "BIGINT"
    assert {r.path: r.type for r in record_fields(records, depth=0).collect()} == {"$": "VARIANT"}


def test_typed_columns_and_rest_hold_everything(records):
    fields = {"id": "int", "t": "decimal(15,2)"}
    for r in typed_fields(records.withColumn("whole", F.to_json(RECORD)), fields).select("whole", "id", "t", F.to_json("rest").alias("rest")).collect():
        whole, rest = json.loads(r.whole), json.loads(r.rest)
        if not isinstance(whole, dict):
            assert (rest, r.id, r.t) == (whole, None, None)
            continue
        for name in fields:
            assert (r[name] is None) == (name not in whole or name in rest)
            if r[name] is not None:
                rest[name] = float(r[name])
        assert rest == whole
    got = {(r.id, None if r.t is None else str(r.t)) for r in typed_fields(records, fields).collect()}
    # text is no number, a decimal no integer, a large integer no int
    assert got == {(1, "100.50"), (None, None), (None, "3.00")}


def test_columns_kept_and_clashes(spark, records):
    more = records.withColumn("a.b", F.lit(1))
    assert typed_fields(more, {"id": "bigint"}).columns == [RECORD, "a.b", "id", "rest"]
    with pytest.raises(ValueError, match="a.b"):
        typed_fields(more, {"a.b": "int"})
    none = typed_fields(records, {})
    assert none.columns == [RECORD, "rest"] and none.where(F.to_json(RECORD) != F.to_json("rest")).count() == 0
    empty = records.where(F.lit(False))
    assert record_fields(empty).collect() == [] and typed_fields(empty, {"id": "int"}).collect() == []


def test_bad_lines(spark, tmp_dir):
    spark.createDataFrame([('{"a":1}',), ('{"a":',)], "value string").write.text(tmp_dir)
    with pytest.raises(Exception, match="MALFORMED"):
        read_varied_json(spark, tmp_dir).select(F.to_json(RECORD)).collect()
    got = read_varied_json(spark, tmp_dir, on_bad="null")
    assert sorted(r[0] or "" for r in got.select(F.to_json(RECORD)).collect()) == ["", '{"a":1}']
    assert [(r.path, r.type, r.n) for r in record_fields(got).collect()] == [("$.a", "BIGINT", 1)]
    with pytest.raises(ValueError):
        read_varied_json(spark, tmp_dir, on_bad="skip")


def test_one_pass_with_types_merged_before_the_shuffle(records):
    plan = record_fields(records)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and plan.count("Exchange") == 1 and "partial_schema_of_variant_agg" in plan
