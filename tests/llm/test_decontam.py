from __future__ import annotations

import random

import numpy as np
import pytest

from docroll.llm import decontam as D


def folded(text: str) -> str:
    out = "".join(c.lower() if c.isalnum() and len(c.lower()) == 1 else (c if c.isalnum() else " ") for c in text)
    return " ".join(out.split())


def best(pattern: str, text: str) -> int:
    """Sellers: edits of the best occurrence of the pattern in the text."""
    row = list(range(len(pattern) + 1))
    least = row[-1]
    for c in text:
        new = [0]
        for i, p in enumerate(pattern, 1):
            new.append(min(row[i - 1] + (p != c), row[i] + 1, new[-1] + 1))
        row, least = new, min(least, new[-1])
    return least


def edited(r, text, k):
    t = list(text)
    for _ in range(k):
        i = r.randrange(len(t))
        kind = r.randrange(3)
        if kind == 0:
            t[i] = "z"
        elif kind == 1:
            del t[i]
        else:
            t.insert(i, "q")
    return "".join(t)


@pytest.fixture(scope="module")
def tables(spark):
    r = random.Random(11)
    word = lambda: "".join(r.choice("etaoinshrdlu") for _ in range(r.randint(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(i, prose(r.randint(15, 45)).capitalize() + ".") for i in range(12)] + [(12, ""), (13, None), (14, "too short"), (None, prose(20)), (3, "Ünï cödé " + prose(20)), (17, "Twenty folded chars."), (18, "thirteen char")]
    items += [items[2]]
    docs = []
    for i in range(60):
        text = prose(r.randint(5, 120))
        if i % 3 == 0:
            item = items[i % 12][1]
            at = r.randrange(len(text))
            text = text[:at] + " \n" + edited(r, item, r.choice([0, 1, 3, 6, 9, 14, 20])).upper() + "!! " + text[at:]
        docs.append((i, text))
    docs += [(100, None), (101, ""), (102, " \n"), (None, items[15][1]), (103, items[16][1].replace(" ", "\n--")), (104, (items[1][1] + " ") * 3), (104, (items[1][1] + " ") * 3)]
    docs += [(105, prose(9) + " twenty fulded chars " + prose(9)), (106, "twenty foldd cars"), (107, "xx thirteen char xx thirteen chair")]
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")


def test_occurrences_match_brute_force(tables):
    docs, items = tables
    got = D.contaminations(docs, items).collect()
    texts = [(r.doc_id, folded(r.text or "")) for r in docs.collect()]
    want = set()
    for item, raw in items.collect():
        p = folded(raw or "")
        if len(p) < D.Q:
            continue
        budget = int(D.RATE * len(p))
        for doc, t in texts:
            if (e := best(p, t)) <= budget:
                want.add((doc, item, e))
    none = -(1 << 63)
    key = lambda d, i: (none if d is None else d, none if i is None else i)
    least = {}
    for r in got:
        k = (r.doc_key, r.item_key)
        least[k] = min(least.get(k, 99), r.edits)
        assert 0 <= r.edits <= r.budget and 0 <= r.start < r.end
    expected = {}
    for d, i, e in want:
        expected[key(d, i)] = min(expected.get(key(d, i), 99), e)
    assert least == expected and len(expected) > 12
    assert (105, 17) in least and (107, 18) in least and (106, 17) not in least
    assert sum(r.doc_key == 104 and r.item_key == 1 for r in got) == 6  # three times in each of two rows


def test_slices_of_the_benchmark_find_the_same(tables, monkeypatch):
    docs, items = tables
    whole = sorted(map(tuple, D.contaminations(docs, items).collect()))
    monkeypatch.setattr(D, "SLICE_CHARS", 400)
    assert len(list(D._slices(items, D.Q, D.RATE))) > 4
    assert sorted(map(tuple, D.contaminations(docs, items).collect())) == whole


def test_decontaminate_drops_the_found_rows(tables, spark):
    docs, items = tables
    found = {r.doc_key for r in D.contaminations(docs, items).collect()}
    wide = docs.selectExpr("doc_id", "text", "1 AS edits", "'x' AS item_key")
    left = D.decontaminate(wide, items)
    assert left.columns == wide.columns
    none = -(1 << 63)
    ids = [none if r.doc_id is None else r.doc_id for r in wide.collect()]
    assert sorted(none if r.doc_id is None else r.doc_id for r in left.collect()) == sorted(i for i in ids if i not in found)
    nothing = spark.createDataFrame([], "doc_id long, text string")
    assert D.contaminations(nothing, items).collect() == [] and D.decontaminate(docs, nothing.withColumnRenamed("doc_id", "item_id")).count() == docs.count()


def test_clean_documents_of_the_test_data_stay(spark, small):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = [folded(r.text) for r in bench.collect()]
    holds = {r.doc_id for r in small.collect() if any(i in folded(r.text or "") for i in items)}
    assert {r.doc_key for r in D.contaminations(small, bench).collect()} == holds and holds


def test_alignment_in_a_band():
    r = random.Random(4)
    for _ in range(300):
        p, t = ("".join(r.choice("ab") for _ in range(r.randint(a, b))) for a, b in ((6, 14), (1, 40)))
        k = r.randint(0, 3)
        arrays = [np.array([ord(c) for c in s], np.uint16) for s in (p, t)]
        got, e = D.align(*arrays, -k, len(t) - len(p) + k, k), best(p, t)
        assert bool(got) == (e <= k)
        assert not got or got[0][0] == e
        places = sorted(place for _, *place in got)
        assert all(best(p, t[a:b]) <= c <= k for c, a, b in got)
        assert all(a[1] <= b[0] for a, b in zip(places, places[1:]))


def test_every_exact_occurrence_is_found():
    """Of several copies in a text, near and far, each; an exact copy is within the found ones."""
    r = random.Random(6)
    index = D.Index([(5, "abcdefghij klmnop qrstu " * 2)])
    for _ in range(20):
        gaps = ["x" * r.randint(1, 60) for _ in range(4)]
        text = " ".join(g + " abcdefghij klmnop qrstu abcdefghij klmnop qrstu" for g in gaps)
        raw = np.frombuffer(text.encode(), np.uint8)
        got = list(index.found(raw, np.array([0, len(raw)])))
        assert len([g for g in got if g[2] == 0]) == 4


def test_a_q_gram_repeated_without_end(monkeypatch):
    """Equal letters in text and item: all disjoint copies, hits held in blocks."""
    index = D.Index([(1, "a" * 100), (2, "a" * 60)])
    raw = np.frombuffer(b"a" * 5000, np.uint8)
    whole = list(index.found(raw, np.array([0, 2000, 5000])))
    assert {(key, row): sum(g[1] == key and g[0] == row for g in whole) for key in (1, 2) for row in (0, 1)} == {(1, 0): 20, (1, 1): 30, (2, 0): 33, (2, 1): 50}
    held = []
    hits = D.Grams._hits
    monkeypatch.setattr(D, "PAIRS", 1000)
    monkeypatch.setattr(D.Grams, "_hits", lambda *a: held.append(hits(*a)) or held[-1])
    assert list(index.found(raw, np.array([0, 2000, 5000]))) == whole
    assert len(held) > 100 and max(map(len, held)) <= 2 * 1000
