"""The registered queries: contracts, oracles, the pipeline."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from docroll.llm import queries as Q
from docroll.llm.common import stage

from .conftest import SMALL

CONTRACT = {
    "op1_": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op2_": {"doc_id": "bigint", "item_id": "bigint"},
    "op3_": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op4_": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op5_": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op6_": {"doc_id": "bigint"},
    "op7_": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op8_": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op9_": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op10_": {"doc_id": "bigint", "n_lines": "bigint", "n_dropped": "bigint", "kept_sha256": "string"},
    "op11_": {"conv_id": "bigint", **dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), "bigint"), "audit": "string", "repaired_sha256": "string"},
    "op12_": {"part": "string", "filter_order": "string", "step": "int", **dict.fromkeys(("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"), "bigint")},
    "op13_": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"},
}


@pytest.mark.parametrize("op", CONTRACT)
def test_columns_and_rows(spark, op):
    (name,) = [n for n in Q.QUERIES if n.startswith(op)]
    got = Q.QUERIES[name](spark, SMALL)
    types = dict(got.dtypes)
    assert {c: types.get(c) for c in CONTRACT[op]} == CONTRACT[op]
    if op not in ("op1_", "op2_", "op11_", "op12_", "op13_"):
        assert got.select("doc_id").distinct().count() == got.count() == 200


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_oracle(spark, name):
    got = Q.QUERIES[name](spark, SMALL)
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    want = con.sql(Q.ORACLE[name])
    order = sorted(got.columns)
    assert sorted(want.columns) == order
    assert sorted(map(tuple, got.select(*order).collect())) == sorted(want.select(", ".join(order)).fetchall())


def test_op6_cuts_lines_of_any_length(spark, tmp_dir):
    rows = [(1, "short\nown line one"), (2, "own line two\n SHORT \n\nshort"), (3, "short"), (4, " \n \n")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_dir}/documents.parquet")
    got = {r.doc_id: (r.n_units, r.n_units_removed, r.n_removed, [(s.start, s.end) for s in r.removed]) for r in Q.QUERIES["op6_line_hash_dedup"](spark, tmp_dir).collect()}
    assert got == {1: (2, 0, 0, []), 2: (3, 2, 12, [(13, 20), (22, 27)]), 3: (1, 1, 5, [(0, 5)]), 4: (0, 0, 0, [])}


def test_op6_cuts_passages_within_lines(spark, tmp_dir):
    passage = " ".join(f"word{i}" for i in range(51))
    rows = [(1, f"one starts {passage} one ends"), (2, f"two starts {passage} two ends\nown"), (3, " ".join(passage.split()[:26])), (4, "own")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_dir}/documents.parquet")
    got = {r.doc_id: r for r in Q.QUERIES["op6_line_hash_dedup"](spark, tmp_dir).collect()}
    assert {d: (r.n_units, r.n_units_removed, r.n_passages_removed) for d, r in got.items()} == {1: (1, 0, 0), 2: (2, 0, 1), 3: (1, 0, 0), 4: (1, 1, 0)}
    (cut,) = got[2].removed
    assert rows[1][1][cut.start : cut.end] in passage and got[2].n_removed == cut.end - cut.start


def test_stages(spark, odd, small, nothing):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_duplicates", "decontamination", "mixture", "shards"] and corpus_pipeline.ORACLE_SQL is None
    docs = stage(small.select(*small.columns).unionByName(odd.select(*small.columns)), "test-docs")
    for name, step in corpus_pipeline.STAGES[:-1]:
        got = step(spark, docs, SMALL)
        assert got.columns == docs.columns, name
        docs = stage(got, f"test-{name}")
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert last.count() == docs.count() > 0
    empty = nothing.select(*small.columns)
    for name, step in corpus_pipeline.STAGES:
        assert step(spark, empty, SMALL).collect() == [], name


def test_pipeline_rows_follow_the_stages(spark, small):
    """Against plain sets: no rejected language, one of each component, no benchmark
    passage, copies within bounds, shards balanced."""
    from .test_decontam import folded
    from .test_jaccard import shingles

    out = corpus_pipeline.run(spark, SMALL)
    assert out.columns == [*small.columns, "size", "text_crc32", "shard", "slot"]
    rows = out.collect()
    per = out.groupBy("doc_id").count().agg(F.max("count")).first()[0]
    assert 1 <= per <= 3
    texts = {r.doc_id: r.text for r in rows}
    sets = [(i, shingles(t)) for i, t in texts.items()]
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            assert not a or not b or 100 * len(a & b) < 75 * len(a | b)
    items = [folded(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    assert not any(item in folded(t) for t in texts.values() for item in items)
    counts = [sum(r.shard == s for r in rows) for s in range(24)]
    assert max(counts) - min(counts) <= 1
