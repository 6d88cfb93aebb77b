"""Joins cut by a Bloom filter of the small side's keys equal the plain joins."""

import re

import pytest
from pyspark.sql import functions as F

from docroll.operators import filtered_join, filtered_order_rollup, filtered_orphans, key_filter, may_match, order_rollup, orphans
from docroll.operators.key_filter import cannot_match
from tests.conftest import rows


@pytest.fixture(scope="module")
def sides(spark):
    """A third of the large side has one key; some keys are null, some repeat in the small side."""
    key = F.when(F.col("id") % 3 == 0, 40).when(F.col("id") % 50 == 1, None).otherwise(F.col("id"))
    large = spark.range(12_000, numPartitions=5).select(key.alias("k"), F.concat(F.lit("k"), key % 90).alias("t"), F.col("id").alias("v"))
    small = spark.range(600, numPartitions=3).select(F.when(F.col("id") % 20 > 0, F.col("id") % 400 * 10).alias("k"), F.concat(F.lit("k"), F.col("id") % 45 * 2).alias("t"), F.col("id").alias("w"))
    return large, small


@pytest.mark.parametrize("how", ["inner", "left_semi", "right"])
@pytest.mark.parametrize("on", ["k", "t", ["t", "k"]])
def test_joins_equal_the_plain_ones(sides, how, on):
    large, small = sides
    small = small.dropDuplicates(["t"]) if on == "t" else small
    got, want = filtered_join(large, small, on, how), large.join(small, on, how)
    assert got.columns == want.columns and rows(got) == rows(want) and got.count()


def test_rows_without_a_partner_leave(sides):
    large, small = sides
    kept = key_filter(small, "k")
    may = may_match(large, "k", kept)
    exact = large.join(small, "k", "left_semi").count()
    assert exact <= may.count() <= exact + 0.02 * large.count()
    assert rows(may.unionByName(cannot_match(large, "k", kept))) == rows(large)


def test_one_row_a_block_however_hot_a_key(spark):
    keys = spark.range(50_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1600).alias("k"))
    kept = key_filter(keys, "k")
    assert kept.blocks.count() <= kept.n_blocks and 80 <= kept.n_blocks <= 120
    narrow = key_filter(keys, "k", expected_keys=1)  # too small a number only lets more through
    assert narrow.n_blocks == 1 and may_match(keys, "k", narrow).count() == 50_000


def test_too_many_keys_mean_no_filter(sides):
    large, small = sides
    assert key_filter(small, "k", max_blocks=2) is None
    assert rows(filtered_join(large, small, "k", max_blocks=2)) == rows(large.join(small, "k"))
    assert rows(filtered_orphans(large, small, "k", max_blocks=2)) == rows(orphans(large, small, "k"))


def test_orphans_and_rollup(sides, spark):
    large, small = sides
    assert rows(filtered_orphans(large, small, "k")) == rows(orphans(large, small, "k"))
    other = small.withColumnRenamed("k", "p")
    assert rows(filtered_orphans(large, other, "k", "p")) == rows(orphans(large, other, "k", "p"))
    orders = small.where("k IS NOT NULL").dropDuplicates(["k"])
    assert rows(filtered_order_rollup(large, orders, "k", "k", "v", ["w"])) == rows(order_rollup(large, orders, "k", "k", "v", ["w"]))


def test_empty_sides_and_odd_names(sides):
    large, small = sides
    assert filtered_join(large.limit(0), small, "k").count() == 0 == filtered_join(large, small.limit(0), "k").count()
    assert rows(filtered_orphans(large, small.limit(0), "k")) == rows(large)
    odd = [d.withColumnRenamed("k", "a.b") for d in sides]
    assert rows(may_match(odd[0], "a.b", key_filter(odd[1], "a.b"))) == rows(may_match(large, "k", key_filter(small, "k")))


def test_what_is_refused(sides):
    large, small = sides
    with pytest.raises(ValueError, match="without a partner"):
        filtered_join(large, small, "k", "left")
    with pytest.raises(ValueError, match="types differ"):
        filtered_join(large, small.withColumn("k", F.col("k").cast("int")), "k")
    with pytest.raises(ValueError, match="by hash"):
        key_filter(small.withColumn("k", F.col("k").cast("double")), "k")


def test_the_filter_stands_before_the_exchange(sides):
    large, small = sides
    plan = may_match(large, "k", key_filter(small, "k")).groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    above, _, below = plan.partition("BroadcastHashJoin")
    assert "LeftSemi" in below and re.search(r"Exchange hashpartitioning\(k#", above) and "hashpartitioning(k#" not in below
