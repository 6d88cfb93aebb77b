from __future__ import annotations

import random

import numpy as np
import pytest

from docroll.llm import jaccard_join as J
from docroll.llm.common import components, shingle_hashes

from .conftest import lower, words

NONE = -(1 << 63)


def shingles(text, width=5):
    w = words(lower(text or ""))
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def brute(rows, percent=75):
    """Component of each row by trying every pair of different sets."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[max(find(i), find(j))] = min(find(i), find(j))
    out = []
    for i, (doc, _) in enumerate(rows):
        mates = [rows[k][0] for k in range(len(rows)) if find(k) == find(i)] if sets[i] else [doc]
        out.append((doc, len(sets[i]), min(mates)))
    return sorted(out)


def rows_of(df):
    return [(NONE if r[0] is None else r[0], r[1]) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("which", ["odd", "nothing", "small"])
def test_components(which, request):
    docs = request.getfixturevalue(which)
    got = J.jaccard_components(docs).select("doc_key", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == brute(rows_of(docs))


@pytest.mark.parametrize("block", [3, 500])
def test_chains_in_small_blocks(spark, block):
    """Near copies that link only along a chain, in clusters dealt to several cells."""
    r = random.Random(5)
    rows = []
    for c in range(6):
        text = [f"c{c}w{i}" for i in range(80)]
        for _ in range(12):
            rows.append((len(rows), " ".join(text)))
            text[r.randrange(80)] = f"new{len(rows)}"
            if len(rows) % 12 == 7:  # here the chain breaks
                text[:40] = [f"other{len(rows)}n{i}" for i in range(40)]
            if r.random() < 0.5:
                text[r.randrange(80)] = f"more{len(rows)}"
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = J.jaccard_components(df, block=block).select("doc_key", "n_shingles", "component_id").collect()
    want = brute(rows)
    assert sorted(map(tuple, got)) == want
    assert len({x[2] for x in want}) > 6


@pytest.mark.parametrize("block", [3, 500])
def test_links_of_every_row(spark, block):
    """A chain, a crowd of near copies and exact copies in one cluster."""
    r = random.Random(11)
    text = [f"w{i}" for i in range(60)]
    rows = []
    for k in range(14):
        rows += [(len(rows) + c, " ".join(text)) for c in range(1 + k % 3)]
        text[(k * 17) % 60] = f"new{k}"
    for k in range(10):
        near = list(text)
        near[r.randrange(60)] = f"near{k}"
        rows.append((len(rows), " ".join(near)))
    rows += [(len(rows), ""), (len(rows) + 1, None), (len(rows) + 2, "alone among them all with its own words")]
    sets = [shingles(t) for _, t in rows]
    want = [(doc, sum(j != i and 100 * len(a & b) >= 75 * len(a | b) for j, b in enumerate(sets)) if a else 0) for i, ((doc, _), a) in enumerate(zip(rows, sets))]
    got = J.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), block=block)
    assert sorted(map(tuple, got.select("doc_key", "n_links").collect())) == want
    assert len({n for _, n in want}) > 5


def test_one_per_component_keeps_columns_and_one_row(odd):
    kept = J.one_per_component(odd)
    assert kept.columns == odd.columns
    got = sorted((r[0] if r[0] is not None else NONE) for r in kept.select("doc_id").collect())
    want = {doc for doc, n, c in brute(rows_of(odd)) if doc == c}
    assert set(got) == want and len(got) == len(want)


def test_one_per_component_with_shared_ids(spark):
    """Rows without an id, or with a repeated one, are lost only to a copy."""
    text = [" ".join(f"t{k}w{i}" for i in range(40)) for k in range(6)]
    near = text[0].replace("t0w20", "other")
    rows = [
        (None, text[0]), (None, text[1]), (None, text[1]), (None, text[2].upper()), (None, text[2]), (None, ""), (None, None),
        (1, text[3]), (2, near), (2, text[4]), (3, " "), (3, text[5]), (4, text[5] + " tail"),
    ]
    kept = J.one_per_component(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    got = sorted(((r.doc_id, r.text) for r in kept), key=repr)
    want = [(None, text[0]), (None, text[1]), (None, text[2].upper()), (None, ""), (None, None), (1, text[3]), (2, text[4]), (3, " "), (3, text[5])]
    assert got == sorted(want, key=repr)


def test_divide_skip_finds_what_pairs_find():
    r = np.random.default_rng(2)
    base = r.integers(0, 400, (12, 60)).astype(np.uint64)
    sets = []
    for i in range(150):
        s = base[i % 12].copy()
        s[r.integers(0, 60, r.integers(0, 9))] = r.integers(1000, 9000)
        sets.append(np.unique(s))
    n = np.array([len(s) for s in sets])
    got = {(q, int(i)) for q, found in J.divide_skip(sets, n, sets, n, 75) for i in found}
    plain = [set(s.tolist()) for s in sets]
    want = {(i, j) for i in range(150) for j in range(150) if 100 * len(plain[i] & plain[j]) >= 75 * len(plain[i] | plain[j])}
    assert got == want


def test_divide_skip_over_different_index_and_queries():
    """As in a cell of two blocks: queries hold shingles that the index lacks, and
    pairs lie just above and just below the threshold."""
    r = np.random.default_rng(7)
    base = r.choice(10_000, (8, 60), replace=False).astype(np.uint64) * np.uint64(1 << 45)

    def near(count):
        out = []
        for i in range(count):
            s = base[i % 8].copy()
            at = r.choice(60, r.integers(0, 15), replace=False)
            s[at] = r.choice(s, len(at)) - r.integers(1, 60, len(at)).astype(np.uint64)  # just before a shingle of the set
            out.append(np.unique(s))
        return out

    index, queries = near(90), near(110)
    sizes = [np.array([len(s) for s in x]) for x in (index, queries)]
    got = {(q, int(i)) for q, found in J.divide_skip(index, sizes[0], queries, sizes[1], 75) for i in found}
    a, b = ([set(s.tolist()) for s in x] for x in (queries, index))
    want = {(i, j) for i in range(110) for j in range(90) if 100 * len(a[i] & b[j]) >= 75 * len(a[i] | b[j])}
    close = {(i, j) for i in range(110) for j in range(90) if 70 <= 100 * len(a[i] & b[j]) / len(a[i] | b[j]) < 75}
    assert want and close and got == want


def test_shingle_hashes_tell_texts_apart():
    texts = ["a b c d e f", "A b  c\td e\nf", "a b c d", "a b c d e", "", " ", "b a c d e", "a", "a a", "ab", "é É"]
    enc = [t.encode() for t in texts]
    h, row = shingle_hashes(np.frombuffer(b"".join(enc), np.uint8), np.cumsum([0, *map(len, enc)]), 5)
    got = [tuple(h[row == i].tolist()) for i in range(len(texts))]
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert (set(got[i]) == set(got[j])) == (shingles(a) == shingles(b)), (a, b)
    assert [len(g) for g in got] == [len(shingles(t)) for t in texts]


def test_components_of_random_graphs(spark):
    r = random.Random(1)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7)]
    got = {x.node: x.root for x in components(spark.createDataFrame(edges, "a long, b long").repartition(6)).collect()}
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            ra, rb = find(a), find(b)
            root[max(ra, rb)] = min(ra, rb)
    assert got == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
