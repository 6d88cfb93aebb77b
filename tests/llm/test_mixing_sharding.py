from __future__ import annotations

import bisect
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from docroll.llm import mixing, sharding

from .conftest import words


def targets_expected(rows):
    sizes = defaultdict(int)
    for source, text in rows:
        sizes[source] += len(words(text))
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        share = (total - sum(fixed.values())) / max(sum(weight[s] for s in free), 1e-300)
        over = [s for s in free if weight[s] * share > 3 * sizes[s]]
        if not over:
            return sizes, {**fixed, **{s: weight[s] * share for s in free}}
        fixed.update({s: 3 * sizes[s] for s in over})


@pytest.mark.parametrize("which", ["odd", "small"])
def test_mix_meets_targets(which, request):
    docs = request.getfixturevalue(which)
    got = mixing.copies(docs).collect()
    again = mixing.copies(docs.repartition(5)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    rows = [(r.source, r.text) for r in docs.select("source", "text").collect()]
    sizes, targets = targets_expected(rows)
    assert Counter(r.size for r in got) == Counter(len(words(t)) for _, t in rows)
    by = defaultdict(list)
    for r in got:
        assert 0 <= r.copies <= 3
        by[(r.source_size, round(r.target, 6))].append(r)
    want = defaultdict(float)
    for s in sizes:
        want[(sizes[s], round(targets[s], 6))] += 1
    assert set(by) == set(want)
    for (size, target), members in by.items():
        n = want[(size, target)]
        taken = sum(r.copies * r.size for r in members)
        smallest = sorted(r.size for r in members if r.size)
        assert abs(taken - n * target) <= n * max([1, *smallest[-1:]]) * 0.5 + 1e-6


def test_dual_is_the_entropy_optimum(small):
    """r = exp(l x), capped, and the constraint holds before rounding."""
    rows = small.select("source", mixing.word_count().alias("size"))
    hist = rows.groupBy("source", "size").agg(F.count("*").alias("n"))
    duals = mixing.solve_duals(hist, mixing.source_targets(hist)).toPandas().set_index("source")
    cells = hist.toPandas()
    for source, d in duals.iterrows():
        c = cells[cells["source"] == source]
        r = np.minimum(3.0, np.exp(d["dual"] * c["size"] / d["mean_size"]))
        assert abs((c["n"] * c["size"] * r).sum() / d["target"] - 1) < 1e-6


def test_mix_rows(odd, nothing):
    out = mixing.mix(odd)
    assert out.columns == odd.columns
    per = Counter((r.doc_id, r.text, r.source) for r in out.collect())
    n = Counter((r.doc_id, r.text, r.source) for r in odd.collect())
    assert all(per[k] <= 3 * n[k] for k in per) and set(per) <= set(n)
    assert sum(per.values()) == mixing.copies(odd).agg(F.sum("copies")).first()[0]
    assert mixing.copies(nothing).collect() == [] and mixing.mix(nothing).collect() == []


def test_mix_keeps_whole_rows_of_any_names(spark):
    """Columns named as internal ones are, nested columns, rows equal but for one column."""
    names = ["_doc_key", "_text_key", "_turn", "_times", "_copy", "_least_1", "doc_key", "text_key", "whole", "row", "times", "turn", "copy", "least_1", "s", "k", "t", "copies", "a.b"]
    docs = spark.range(90).select(
        F.when(F.col("id") % 9 > 0, F.col("id") % 4).alias("doc_id"), F.concat(F.lit("some words "), F.repeat(F.lit("again "), (F.col("id") % 3).cast("int"))).alias("text"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 5).cast("string").alias("source"), *[F.concat(F.lit(n), F.col("id") % 30).alias(n) for n in names],
        F.create_map(F.lit("m"), F.col("id") % 30).alias("mapped"), F.array(F.struct(F.col("id") % 2)).alias("listed"))
    out = mixing.mix(docs)
    assert out.dtypes == docs.dtypes
    per, again, n = (Counter(map(repr, d.collect())) for d in (out, mixing.mix(docs.repartition(7)), docs))
    assert per == again and set(per) <= set(n) and all(per[k] <= 3 * n[k] for k in per)
    taken = defaultdict(int)
    for r in out.select("source", "text").collect():
        taken[r.source] += len(words(r.text))
    sums = {r.source: r.taken for r in mixing.copies(docs).groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("taken")).collect()}
    assert taken == {s: x for s, x in sums.items() if x}


def test_no_python_in_the_mix(small):
    plan = mixing.mix(small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("which", ["odd", "small"])
def test_shards(which, request):
    docs = request.getfixturevalue(which)
    got = sharding.shard_rows(docs, carry=["doc_id", "text", "shard"]).collect()
    assert len(got) == docs.count()
    count = Counter(r.shard for r in got)
    assert max(count.values()) - min(count[s] for s in range(24)) <= 1
    for s in range(24):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(count[s]))
    for r in got:
        data = (r.text or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 8, zlib.crc32(data))
    light = sharding.shard_rows(docs.repartition(4)).collect()
    pick = lambda rows: sorted((r.doc_id or -1, r.text_crc32, r.shard, r.slot) for r in rows)
    assert pick(light) == pick(got)


def test_shards_of_nothing(nothing):
    assert sharding.shard_rows(nothing).collect() == []


#: Share of the rows that change shards when a ninth is added (a ninth at least must).
MOVED = 0.2


def walk(hashed, shards, vnodes):
    """The shard of each document, placed one by one: those that their own shard has room for in
    the ring's order, then each of the others, node by node clockwise."""
    at, owner = (x.tolist() for x in sharding.ring(shards, vnodes))
    room = sharding.row_bounds(len(hashed), shards).tolist()
    arcs = [bisect.bisect_left(at, h) % len(at) for h in hashed]
    order = sorted(range(len(hashed)), key=lambda i: (arcs[i], (hashed[i] - at[arcs[i] - 1]) % 2**64, i))
    out, later = {}, []
    for i in order:
        if room[owner[arcs[i]]]:
            out[i] = owner[arcs[i]]
            room[out[i]] -= 1
        else:
            later.append(i)
    for i in later:
        node = arcs[i]
        while not room[owner[node]]:
            node = (node + 1) % len(at)
        out[i] = owner[node]
        room[out[i]] -= 1
    return [out[i] for i in range(len(hashed))]


def test_shards_are_those_of_a_walk(spark):
    """Every row against a walk of single documents, with one shard more too; few rows change shards."""
    docs = spark.range(4000).selectExpr("id * 7919 AS doc_id", "'some text' AS text")
    hashed = sharding.mix((np.arange(4000, dtype=np.uint64) * np.uint64(7919)) * np.uint64(sharding.GOLDEN)).tolist()
    got = {}
    for shards in (8, 9):
        rows = sharding.shard_rows(docs, shards, 64).collect()
        got[shards] = [s for _, s in sorted((r.doc_id, r.shard) for r in rows)]
        assert got[shards] == walk(hashed, shards, 64)
    moved = sum(a != b for a, b in zip(got[8], got[9]))
    assert moved < 4000 * MOVED, moved / 4000


def test_fill_moves_little_and_balances():
    """The plan fills every shard to its bound, without gaps, mostly from its own arcs."""
    rng = np.random.default_rng(1)
    at, owner = sharding.ring(8, 64)
    counts = rng.poisson(20, len(at))
    bounds = sharding.row_bounds(int(counts.sum()), 8)
    plan = sharding.fill(counts, owner, bounds)
    load = np.zeros(8, int)
    for arc, a, b, s, slot in plan:
        assert slot == load[s]
        load[s] += b - a
    assert (load == bounds).all()
    assert sum(b - a for _, a, b, _, _ in plan) == counts.sum()
    home = sum(b - a for arc, a, b, s, _ in plan if owner[arc] == s)
    assert home > 0.8 * counts.sum()
