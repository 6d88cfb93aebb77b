from __future__ import annotations

import numpy as np
import pytest

from docroll.llm import ann

DIM = 24


def brute(rows, asked, k):
    good = {}
    for i, v in rows:
        if i is None or v is None or len(v) != DIM or any(c is None or not np.isfinite(c) for c in v) or not any(v):
            continue
        good[i] = min(good.get(i, tuple(v)), tuple(v))
    ids = np.array(sorted(good))
    x = np.array([good[i] for i in ids], dtype=np.float32).astype(np.float64)
    out = {}
    for i in ids:
        if i % asked == 0:
            s = x @ x[np.searchsorted(ids, i)]
            order = np.lexsort((ids, -np.round(s, 9)))
            out[int(i)] = [(int(ids[j]), s[j]) for j in order if ids[j] != i][:k]
    return out


@pytest.fixture(scope="module")
def vectors(spark):
    r = np.random.default_rng(8)
    x = r.normal(size=(1500, DIM)).astype(np.float32)
    x *= (r.uniform(0.8, 1.2, (1500, 1)) / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    x[200:600] = x[200]  # very many copies of one vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(5000, None), (5020, [0.0] * DIM), (5040, [float("nan")] * DIM), (5060, [1.0] * 3), (5080, [None] * DIM), (None, [1.0] * DIM), (5100, [float("inf")] + [0.0] * (DIM - 1)), (20, rows[20][1])]
    return rows


def test_recall_order_and_exact_scores(spark, vectors):
    df = spark.createDataFrame([(i, v, "x", 1.0) for i, v in vectors], "vec_id long, embedding array<float>, node string, score double").repartition(4)
    got = ann.nearest(df, lambda i: i % 20 == 0, k=20).collect()
    want = brute(vectors, 20, 20)
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(by) == set(want)
    hits = 0
    for q, found in by.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21))
        assert [(-f[2], f[1]) for f in found] == sorted((-f[2], f[1]) for f in found)
        exact = dict(brute_scores(vectors, q))
        assert all(abs(s - exact[i]) < 1e-9 for _, i, s in found)
        hits += len({f[1] for f in found} & {i for i, _ in want[q]})
    assert hits / (20 * len(want)) >= 0.9
    # a query among the copies gets the copies with the smallest ids
    assert [f[1] for f in by[220]][:20] == [i for i, _ in want[220]]


def brute_scores(rows, q):
    x = {i: np.array(v, dtype=np.float32).astype(np.float64) for i, v in rows if i is not None and i < 1500}
    return [(i, float(v @ x[q])) for i, v in x.items()]


def test_few_rows_and_none(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (20, [0.5, 0.5]), (3, [0.0, 1.0])], "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in ann.nearest(few, lambda i: i % 20 == 0, k=20).collect())
    assert got == [(0, 1, 20, 0.5), (0, 2, 3, 0.0), (20, 1, 0, 0.5), (20, 2, 3, 0.5)]
    assert ann.nearest(few.limit(0), lambda i: i % 20 == 0).collect() == []
    assert ann.nearest(few.where("vec_id = 0"), lambda i: i % 20 == 0).collect() == []


def test_a_search_round_stages_the_pool_alone(spark, vectors, monkeypatch):
    names, stage = [], ann.stage
    monkeypatch.setattr(ann, "stage", lambda df, name: (names.append(name), stage(df, name))[1])
    df = spark.createDataFrame(vectors[:150], "vec_id long, embedding array<float>")
    ann.nearest(df, lambda i: i % 20 == 0, k=5).collect()
    assert names.count("ann-pool") > 1 and "ann-next" not in names


def test_small_rounds_are_not_dealt_over_every_partition(spark):
    """A graph of few edges is written by few tasks, however many shuffle partitions there are."""
    x = np.random.default_rng(5).normal(size=(600, 5)).astype(np.float32)
    packed = spark.createDataFrame([(i, v.tobytes()) for i, v in enumerate(x)], "node long, vec binary")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        graph = ann.neighbour_graph(packed, 4, rounds=1)
        assert graph.select("a").distinct().count() == 600
        assert len(graph.inputFiles()) <= 8
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
