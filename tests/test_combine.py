"""User-written aggregates: the reference's mean, hot keys, keys of any type."""

from collections import Counter

from pyspark.sql import functions as F

from docroll.operators.combine import combine_by_key

MEAN = (lambda x: (x, 1), lambda s, x: (s[0] + x, s[1] + 1), lambda a, b: (a[0] + b[0], a[1] + b[1]), "struct<sum:bigint,n:bigint>")


def test_mean_of_the_reference(spark):
    df = spark.createDataFrame([("Anna", 10), ("Anna", 5), ("Ben", 2), (None, 4)], "key string, value int").repartition(3)
    got = combine_by_key(df, "key", "value", *MEAN, finish=lambda s: s[0] / s[1], result="double", name="mean")
    assert {r.key: r["mean"] for r in got.collect()} == {"Anna": 7.5, "Ben": 2.0, None: 4.0}
    assert combine_by_key(df.limit(0), "key", "value", *MEAN).collect() == []


def test_state_is_the_result_without_finish_and_nulls_are_passed(spark):
    df = spark.createDataFrame([(1, None), (1, 3), (2, None)], "k int, v int")
    got = combine_by_key(df, "k", ["v", "k"], lambda v, k: [v], lambda s, v, k: [*s, v], lambda a, b: [*a, *b], "array<int>", name="all")
    assert {r.k: Counter(r["all"]) for r in got.collect()} == {1: Counter([None, 3]), 2: Counter([None])}


def test_a_hot_key_sends_one_state_a_task(spark):
    df = spark.range(30_000, numPartitions=6).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.lit(1).cast("long").alias("v"), F.struct((F.col("id") % 5).alias("a"), F.array((F.col("id") % 2)).alias("b")).alias("nested"))
    calls = spark.sparkContext.accumulator(0)

    def merged(a, b):
        calls.add(1)
        return a + b

    got = {r.k: r.n for r in combine_by_key(df, "k", "v", lambda x: x, lambda s, x: s + x, merged, "bigint", name="n").collect()}
    assert got[0] == 10_000 and len(got) == 20_001 and set(got.values()) == {1, 10_000}
    assert calls.value == 5  # six tasks, six states
    nested = combine_by_key(df, ["nested"], "v", lambda x: x, lambda s, x: s + x, lambda a, b: a + b, "bigint", held_keys=3)
    assert sorted((r.nested.a, r.nested.b[0], r.result) for r in nested.collect()) == [(a, b, 3000) for a in range(5) for b in range(2)]
