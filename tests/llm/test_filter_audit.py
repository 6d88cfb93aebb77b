"""The filter audit against sets of plain Python."""

from __future__ import annotations

import itertools
import re

import numpy as np
from hypothesis import given, seed, settings
from hypothesis import strategies as st

from docroll.llm import filter_audit as A

from .conftest import words


def fails(text: str, earlier: bool) -> set[str]:
    w = words(text)
    tests = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": bool(re.search(r"[#$%&*|]", text)), "E": earlier}
    return {f for f, t in tests.items() if t}


def brute(docs: list[tuple], labels: list[tuple]) -> dict:
    """Docs (doc_id, text, part)."""
    named = [(i, t or "") for i, t, _ in docs if i is not None]
    first: dict = {}
    for i, t in named:
        first[t] = min(first.get(t, i), i)
    rows = []
    for i, t, part in docs:
        earlier = i is not None and first[t or ""] < i
        marks = [(q, x) for d, q, x in labels if d == i and i is not None]
        rows.append((part or "", fails(t or "", earlier), any(q == 1 for q, _ in marks), any(x == 1 for _, x in marks)))
    out: dict = {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                total[f] += len(gone)
                out[part, "".join(order), step] = (len(left), len(gone), sum(f in r[1] for r in own) - len(gone), sum(r[1] == {f} for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone))
        for (p, order, step), v in list(out.items()):
            if p == part:
                out[p, order, step] = (*v, total[order[step - 1]])
    return out


def audited(docs, labels) -> dict:
    got = A.order_steps(A.audit(docs, labels)).collect()
    assert len({tuple(r)[:3] for r in got}) == len(got)
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got}


def test_odd_rows(spark, odd):
    rows = [(r.doc_id, r.text, r.lang) for r in odd.collect()]
    extra = [(None, "short", "fr"), (None, "short", "fr"), (3, "SHORT # and again", None), (3, "SHORT # and again", ""), (40, "short", "de"), (41, "X" * 400_000, "de")]
    docs = odd.select("doc_id", "text", "lang", "size").unionByName(spark.createDataFrame([(*e, 1) for e in extra], "doc_id long, text string, lang string, size int"))
    labels = [(1, 1, 0), (3, 1, 1), (3, 0, 1), (9, None, 1), (None, 1, 1), (40, 1, None), (999, 1, 1), (10, 0, 0)]
    frame = spark.createDataFrame([(*r, 5) for r in labels], "doc_id long, quality int, toxic int, fails int")
    assert audited(docs.withColumnRenamed("size", "n"), frame) == brute(rows + extra, labels)


def test_one_id_and_one_text_hold_most_rows(spark):
    rows = [(7, f"text {i % 3}", "en") for i in range(300)] + [(i, "the same text", "de") for i in range(300)] + [(None, "none", None)] * 200
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(6)
    labels = [(7, 1, 1), *((i, i % 2, 0) for i in range(100))]
    assert audited(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")) == brute(rows, labels)


def test_invalid_text_and_empty_tables(spark, nothing):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audited(nothing, labels) == {}
    bad = spark.sql("SELECT 1L AS doc_id, CAST(unhex('41FF2442') AS STRING) AS text, 'en' AS lang")
    got = audited(bad, labels)
    assert len(got) == 600 and got["en", "DABCE", 1][:2] == (0, 1)


@seed(2)
@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3000), max_size=900, unique=True), st.lists(st.integers(0, 3000), max_size=900, unique=True))
def test_galloping_union_and_difference(a, b):
    a, b = (np.array(sorted(x), dtype=np.int64) for x in (a, b))
    assert (A.gallop(b, a) == np.searchsorted(a, b)).all()
    union, new = A.merged(a, b)
    assert union.tolist() == sorted({*a.tolist(), *b.tolist()}) and new.tolist() == sorted({*b.tolist()} - {*a.tolist()})


def test_many_parts_and_ranges(spark, monkeypatch):
    monkeypatch.setattr(A, "RANGE", 40)
    rows = [(i, f"word {i % 11} #" if i % 3 else f"Text {i % 7}", f"part{i % 23}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = [(i, i % 2, i % 5 == 0) for i in range(0, 400, 3)]
    labels = [(i, q, int(t)) for i, q, t in labels]
    assert audited(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")) == brute(rows, labels)
