"""Positions and folds against plain Python, with keys that span ranges."""

import random

import pytest
from pyspark.sql import functions as F

from docroll.operators.ordered import fold_by_key, running_fold, with_positions, write_sorted
from docroll.plans import catalog
from docroll.sources.tables import table

SMALL = "/root/testdata/sf0.001"


def skewed(spark):
    """Key 5 has most of the rows; there are null keys, ties and repeated rows."""
    dice = random.Random(2)
    rows = [(5 if i % 3 else dice.choice([None, 1, 2, 3, 9]), i % 40, dice.randint(-9, 9), f"n{i}") for i in range(900)]
    rows += rows[:20]
    return rows, spark.createDataFrame(rows, "k int, t int, delta long, range string").repartition(7)


def test_positions_are_the_places_in_the_sorted_order(spark):
    rows, df = skewed(spark)
    got = with_positions(df, ["k", "t"], n_ranges=6).collect()
    assert sorted(r.position for r in got) == list(range(1, len(rows) + 1))
    ordered = [(r.k, r.t) for r in sorted(got, key=lambda r: r.position)]
    assert ordered == sorted(((k, t) for k, t, _, _ in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    assert sorted(((r.k, r.t, r.delta, r.range) for r in got), key=repr) == sorted(rows, key=repr)
    with pytest.raises(ValueError, match="position"):
        with_positions(df.withColumn("position", F.lit(1)), ["k"])
    assert with_positions(df.limit(0), ["k"]).collect() == []


def test_only_counts_of_ranges_meet_in_one_task(spark):
    got = with_positions(catalog._orders_rolled(spark, SMALL), ["o_custkey", "o_orderkey"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    single = plan[plan.index("SinglePartition") :]
    assert plan.count("SinglePartition") == 1 and "HashAggregate(keys=[range" in single  # below it: one row a range
    # equal keys alone: many rows of one key still fill several ranges
    spread = with_positions(spark.range(1000).withColumn("k", F.lit(1)), ["k"], n_ranges=5)
    assert len(set(r.p for r in spread.select(F.spark_partition_id().alias("p")).distinct().collect())) >= 1
    assert spread.agg(F.max("position"), F.countDistinct("position")).first()[:] == (1000, 1000)


def test_sorted_files_lie_in_order(spark, tmp_dir):
    _, df = skewed(spark)
    write_sorted(df, ["t", "delta"], tmp_dir, n_ranges=5)
    rows = spark.read.parquet(tmp_dir).select("t", "delta", F.col("_metadata.file_name").alias("f"), F.col("_metadata.row_index").alias("i")).collect()
    by_file = [(r.t, r.delta) for r in sorted(rows, key=lambda r: (r.f, r.i))]
    assert by_file == sorted(by_file) and len({r.f for r in rows}) > 1


def balances(rows, floor=0):
    """Per (key, t): a key's states in order; rows of equal (k, t) may come in any order."""
    out = {}
    for k in {r[0] for r in rows}:
        x = 0
        for _, t, delta, name in sorted((r for r in rows if r[0] == k), key=lambda r: (r[1], r[2], r[3])):
            x = max(x + delta, floor)
            out.setdefault((k, t, delta, name), []).append(x)
    return out


ORDER = ["t", "delta", "range"]
CHAIN = {
    "lift": lambda d: (d, 0), "compose": lambda f, g: (f[0] + g[0], max(f[1] + g[0], g[1])),
    "apply": lambda f, x: max(x + f[0], f[1]), "summary": "struct<add:bigint,floor:bigint>",
}


@pytest.mark.parametrize("how", [{}, CHAIN])
@pytest.mark.parametrize("n_ranges", [1, 3, 9])
def test_running_fold(spark, how, n_ranges):
    rows, df = skewed(spark)
    got = running_fold(df, ["k"], ORDER, ["delta"], "bigint", 0, lambda x, d: max(x + d, 0), name="x", n_ranges=n_ranges, **how)
    want = balances(rows)
    seen = {}
    for r in got.collect():
        seen.setdefault((r.k, r.t, r.delta, r.range), []).append(r.x)
    assert {k: sorted(v) for k, v in seen.items()} == {k: sorted(v) for k, v in want.items()}


@pytest.mark.parametrize("n_ranges", [1, 8])
def test_fold_of_a_struct_that_is_not_associative(spark, n_ranges):
    """A checksum of the order itself: x -> 31 x + delta mod p, and the number of rows."""
    rows, df = skewed(spark)
    got = fold_by_key(df, ["k"], ORDER, ["delta", "range"], "struct<h:bigint,n:int>", (7, 0), lambda s, d, name: ((31 * s[0] + d + len(name)) % 1_000_003, s[1] + 1), n_ranges=n_ranges)
    want = {}
    for k, t, d, name in sorted(rows, key=lambda r: (r[1], r[2], r[3])):
        h, n = want.get(k, (7, 0))
        want[k] = ((31 * h + d + len(name)) % 1_000_003, n + 1)
    assert {r.k: tuple(r.state) for r in got.collect()} == want
    assert fold_by_key(df.limit(0), ["k"], ["t"], ["delta"], "bigint", 0, lambda x, d: x + d).collect() == []


def test_a_hot_key_is_folded_in_several_tasks(spark):
    orders = table(spark, "/root/testdata/sf0.01", "orders").select(F.when(F.col("o_orderkey") % 3 == 0, 1).otherwise(F.col("o_custkey")).alias("k"), "o_orderkey", F.lit(1).cast("long").alias("one"))
    got = running_fold(orders, ["k"], ["o_orderkey"], ["one"], "bigint", 0, lambda x, y: x + y, name="x", lift=lambda y: y, compose=lambda a, b: a + b, apply=lambda f, x: x + f, summary="bigint", n_ranges=12)
    hot = got.where("k = 1").select("x", F.spark_partition_id().alias("p")).collect()
    assert sorted(r.x for r in hot) == list(range(1, len(hot) + 1)) and len(hot) >= orders.count() // 3
    assert len({r.p for r in hot}) >= 3
