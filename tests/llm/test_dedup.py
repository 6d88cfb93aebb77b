"""Line, unit and suffix-array dedup against plain Python over the same rows."""

from __future__ import annotations

import hashlib
import os
import re
import time
from collections import defaultdict

import pytest

from docroll.llm import line_dedup, suffix_dedup, unit_dedup

NONE = -(1 << 63)


def rows_of(df):
    return [(NONE if r[0] is None else r[0], (r[1] or "").encode()) for r in df.select("doc_id", "text").collect()]


def sha(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()


@pytest.fixture(params=["odd", "small", "nothing"])
def docs(request):
    return request.getfixturevalue(request.param)


def lines_expected(rows, min_docs):
    holders, first = defaultdict(set), {}
    for doc, text in rows:
        for i, line in enumerate(text.split(b"\n")):
            if key := line.strip().lower():
                holders[key].add(doc)
                first[key] = min(first.get(key, (doc, i)), (doc, i))
    out = []
    for doc, text in rows:
        lines = text.split(b"\n")
        keep = []
        for i, line in enumerate(lines):
            key = line.strip().lower()
            gone = key and (len(holders[key]) >= min_docs if min_docs else (doc, i) != first[key])
            if not gone:
                keep.append(line)
        out.append((doc, len(lines), len(lines) - len(keep), sha(b"\n".join(keep))))
    return sorted(out)


@pytest.mark.parametrize("min_docs", [None, 2, 10])
@pytest.mark.parametrize("parts", [2, 40])
def test_lines(spark, docs, min_docs, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = line_dedup.line_digests(docs, min_docs).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    rows = rows_of(docs)
    assert sorted(map(tuple, got)) == lines_expected(rows, min_docs)


def test_lines_text_matches_bitmaps(odd):
    texts = line_dedup.dedup_lines(odd, 10).collect()
    want = {(d, h) for d, _, _, h in lines_expected(rows_of(odd), 10)}
    assert {(r[0], sha((r[1] or "").encode())) for r in texts} == want
    maps = line_dedup.keep_bitmaps(odd, 10).collect()
    assert maps and all(r.n_dropped > 0 and len(r.keep) > 0 for r in maps)


def test_units(docs):
    rows = rows_of(docs)
    first = {}
    for doc, text in rows:
        at = 0
        for line in text.split(b"\n"):
            parts = line.split()
            if len(parts) >= 10:
                key = b" ".join(parts).decode().lower()
                first[key] = min(first.get(key, (doc, at)), (doc, at))
            at += len(line) + 1
    want = []
    for doc, text in rows:
        at, cuts, kept, n, last = 0, [], [], 0, 0
        for line in text.split(b"\n"):
            parts = line.split()
            n += bool(parts)
            if len(parts) >= 10 and first[b" ".join(parts).decode().lower()] < (doc, at):
                cuts.append((at, at + len(line)))
                kept.append(text[last:at])
                last = at + len(line)
            at += len(line) + 1
        want.append((doc, n, len(cuts), cuts, sha(b"".join([*kept, text[last:]]))))
    got = [(r.doc_key, r.n_units, r.n_units_removed, [(s.start, s.end) for s in r.removed], r.kept_sha256) for r in unit_dedup.unit_digests(docs).collect()]
    assert sorted(got) == sorted(want)


def test_units_of_any_length_against_a_walk(spark, docs):
    """As op6 has them, min_words=1: rows in order, a line whose words came before goes. A passage inside a line that differs elsewhere is no unit and stays."""
    from docroll.llm.common import doc_key, text_key

    passage = " ".join(f"Word{i} and more." for i in range(30))
    inside = spark.createDataFrame([(10**9 + i, f"own {i} start {passage} own end {i}\nMIT  License.\n{passage}") for i in range(3)], "doc_id long, text string")
    df = docs.select("doc_id", "text").unionByName(inside)
    rows = sorted((r.d, r.t, (r.text or "").encode()) for r in df.select(doc_key().alias("d"), text_key().alias("t"), "text").collect())
    first, want = {}, []
    for doc, key, text in rows:
        at, n, kept, cuts = 0, 0, [], []
        for line in text.split(b"\n"):
            words = b" ".join(line.split()).decode().lower()
            n += bool(words)
            gone = words and first.setdefault(words, (doc, key, at)) != (doc, key, at)
            if gone:
                cuts.append((at, at + len(line)))
            kept.append(b"" if gone else line)
            at += len(line) + 1
        want.append((doc, n, len(cuts), sum(e - s for s, e in cuts), cuts, sha(b"\n".join(kept))))
    got = [(r.doc_key, r.n_units, r.n_units_removed, r.n_removed, [(s.start, s.end) for s in r.removed], r.kept_sha256) for r in unit_dedup.unit_digests(df, min_words=1).collect()]
    assert sorted(got) == sorted(want)
    assert [g[1:3] for g in sorted(got)[-3:]] == [(3, 0), (3, 2), (3, 2)]


def test_windows_depend_on_their_passage_only():
    """Those of a text are those of its runs of that many words, each by itself; none crosses texts."""
    import random

    r = random.Random(6)
    text = " ".join(r.choice(["a", "Bb", "ΑΣ", "ñ", "\n dd"]) for _ in range(280))
    low, spans = text.encode(), [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", text.encode())]
    want = set()
    for i in range(len(spans) - 50):
        run = low[spans[i][0] : spans[i + 50][1]]
        row, start, end, *digest = unit_dedup.windows([run], 51)
        assert len(row) and not row.any()
        want |= set(zip((start + spans[i][0]).tolist(), (end + spans[i][0]).tolist(), *(d.tolist() for d in digest)))
    row, start, end, *digest = unit_dedup.windows([b"x", low[:300], b"", low], 51)
    own = row == 3
    assert set(zip(start[own].tolist(), end[own].tolist(), *(d[own].tolist() for d in digest))) == want
    assert {len(low[s:e].split()) for s, e in zip(start[own], end[own])} == {27}
    assert [c.tolist() for c in unit_dedup.windows([b"to " * 80], 51)[:3]] == [[0], [0], [239]]
    lines = (f"{text.upper()}\r\n\t".replace(" ", "  \n").encode(), text.encode())
    first, second = (unit_dedup.windows([t], 51)[3:] for t in lines)
    assert [d.tolist() for d in first] == [d.tolist() for d in second]


def test_passages_within_lines(spark, docs):
    """A passage of 51 words that an earlier document holds is cut though its lines differ around it; documents without one keep all but their lines."""
    from docroll.llm.common import doc_key, text_key

    passage = " ".join(f"Word{i} and" for i in range(26))
    inside = [(10**9 + i, f"own {i} start {passage} own end {i}") for i in range(3)]
    inside += [(10**9 + 3, f"again {passage.upper()}\nand {passage} ends".replace(" ", " \n ")), (10**9 + 4, " ".join(passage.split()[:26]))]
    alone = " ".join(f"alone{i}" for i in range(60))
    inside += [(10**9 + 5, f"{alone} between {alone}")]
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame(inside, "doc_id long, text string"))
    rows = sorted((r.d, r.t, (r.text or "").encode()) for r in df.select(doc_key().alias("d"), text_key().alias("t"), "text").collect())
    found = {width: defaultdict(lambda: rows[-1][:2]) for width in (27, 51)}
    held = {}
    for width, first in found.items():
        for doc, key, text in rows:
            words = [w.decode().lower() for w in text.split()]
            held[width, doc, key] = grams = {" ".join(words[i : i + width]) for i in range(len(words) - width + 1)}
            for g in grams:
                first[g] = min(first[g], (doc, key))
    plain = {(r.doc_key, r.kept_sha256): r for r in unit_dedup.unit_digests(df, min_words=1).collect()}
    got = unit_dedup.unit_digests(df, min_words=1, passage=51).collect()
    assert len(got) == len(rows)
    by_doc = defaultdict(list)
    for r in got:
        by_doc[r.doc_key].append(r)
    for doc, key, text in rows:
        repeated = {w: any(found[w][g] < (doc, key) for g in held[w, doc, key]) for w in (27, 51)}
        if len(by_doc[doc]) > 1:
            continue
        (r,) = by_doc[doc]
        assert r.n_passages_removed > 0 if repeated[51] else r.n_passages_removed == 0 or repeated[27]
        spans = [(s.start, s.end) for s in r.removed]
        assert all(e < s for (_, e), (s, _) in zip(spans, spans[1:])) and r.n_removed == sum(e - s for s, e in spans)
        assert r.kept_sha256 == sha(unit_dedup.remaining(text, spans))
        assert r.n_passages_removed or (doc, r.kept_sha256) in plain
    counts = {d: by_doc[10**9 + d][0] for d in range(6)}
    assert [counts[d].n_passages_removed for d in range(6)] == [0, 1, 1, 2, 0, 0]
    left = inside[1][1].encode()
    assert len(unit_dedup.remaining(left, [(s.start, s.end) for s in counts[1].removed]).split()) < 6 + 51 - 26


def test_paragraph_units():
    text = b"one two\nthree\n\n four five\n \nsix"
    got = [(text[s:e]) for s, e, _ in unit_dedup.units(text, "paragraph", 1)]
    assert got == [b"one two\nthree", b"four five", b"six"]


def test_rows_that_share_an_id_are_cut_each_by_itself(spark):
    """Texts without an id, or with one id, whose repeats lie at different places."""
    common = "a line that all of the rows below have, with more than ten words in it, at some place of their own text" + "." * 20
    rows = [(None, f"{'own start ' * k}{k}\n{common}\nown end {k} " + "x" * 150 * k) for k in range(4)]
    rows = [(None, "first of its kind\nsecond line"), *rows, rows[2]]
    rows += [(5, f"{common}\nfive"), (5, f"other words of five\nand more\n{common}"), (5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    by_text = {text or "" for _, text in rows}
    digests = {}
    for text in by_text:
        body, at = text.encode(), text.encode().find(common.encode())
        cut = body if at < 0 else body[:at] + body[at + len(common) :]
        lines = [x for x in text.split("\n") if x != common]
        digests[text] = (sha(cut), sha("\n".join(lines).encode()))
    # op10: the line is in four texts without id and in one id: five documents
    got = sorted(r.kept_sha256 for r in line_dedup.line_digests(df, 5).collect())
    assert got == sorted(digests[text or ""][1] for _, text in rows)
    assert all(r.n_dropped == 0 for r in line_dedup.line_digests(df, 6).collect())
    whole = {text: sha(text.encode()) for text in by_text}
    holders = [text for text in by_text if common in text]
    unit = sorted(r.kept_sha256 for r in unit_dedup.unit_digests(df).collect())
    first = sorted(r.kept_sha256 for r in line_dedup.line_digests(df, None).collect())
    # one of the texts without id keeps the line, and it is the same for its repeats
    for which, got in ((0, unit), (1, first)):
        options = []
        for stays in holders:
            options.append(sorted(whole[text or ""] if (text or "") == stays else digests[text or ""][which] for _, text in rows))
        assert got in options
    # op5: the order of equal ids is that of the hashes; each row by brute force
    from docroll.llm.common import doc_key, text_key

    keyed = df.select(doc_key().alias("d"), text_key().alias("t"), "text").collect()
    names = {k: i for i, k in enumerate(sorted({(r.d, r.t) for r in keyed}))}
    want = suffix_expected([(names[r.d, r.t], (r.text or "").encode()) for r in keyed], 100)
    got = suffix_dedup.suffix_digests(df).select("n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(w[1:] for w in want)


def suffix_expected(rows, length):
    first = {}
    for doc, text in set(rows):
        for i in range(len(text) - length + 1):
            s = text[i : i + length]
            if s not in first or (doc, i) < first[s]:
                first[s] = (doc, i)
    out = []
    for doc, text in rows:
        gone = bytearray(len(text))
        for i in range(len(text) - length + 1):
            if first[text[i : i + length]] < (doc, i):
                gone[i : i + length] = b"\x01" * length
        kept = bytes(b for b, g in zip(text, gone) if not g)
        spans = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((doc, len(text), sum(gone), spans, sha(kept)))
    return sorted(out)


@pytest.mark.parametrize("length, seed", [(100, 32), (20, 8)])
def test_suffix(docs, length, seed):
    got = suffix_dedup.suffix_digests(docs, length, seed).drop("removed").collect()
    assert sorted(map(tuple, got)) == suffix_expected(rows_of(docs), length)


def test_suffix_long_document_in_pieces(spark, monkeypatch):
    import random

    r = random.Random(3)
    long = "".join(r.choice("abcd ") for _ in range(30_000))
    text = long + "-" + long[2_000:9_000] + long[20_000:20_099]
    df = spark.createDataFrame([(1, text), (2, "x" + long[100:300])], "doc_id long, text string")
    monkeypatch.setattr(suffix_dedup, "PIECE", 4096)  # the workers keep theirs: pieces are covered below
    got = suffix_dedup.suffix_digests(df).drop("removed").collect()
    assert sorted(map(tuple, got)) == suffix_expected([(1, text.encode()), (2, ("x" + long[100:300]).encode())], 100)


def test_suffix_pieces_cover_each_string_once(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(suffix_dedup, "PIECE", 1000)
    batch = pa.RecordBatch.from_arrays([pa.array([5, 6]), pa.array(["ab" * 1700, "c" * 50])], names=["doc_key", "text"])
    seen = []
    for body, bounds, keys, offset in suffix_dedup._pieces(batch, 100):
        lo, hi, *_ = suffix_dedup.sample_runs(body, bounds, 100, 32)
        row = 0 if len(keys) == 1 else None
        seen += [(int(keys[0]), p + int(offset[0])) for a, b in zip(lo, hi) for p in range(a, b + 1)] if row == 0 else []
    assert sorted(seen) == [(5, p) for p in range(3400 - 99)]


def test_unit_dedup_of_bytes_that_are_no_utf8(spark):
    bad = spark.sql("SELECT id AS doc_id, CAST(unhex('41FF420A63') AS STRING) AS text FROM range(3)")
    got = {r.doc_key: (r.n_units, r.n_units_removed, r.n_removed) for r in unit_dedup.unit_digests(bad, min_words=1).collect()}
    assert got == {0: (2, 0, 0), 1: (2, 2, 4), 2: (2, 2, 4)}


def test_stages_leave_no_shuffle_files(spark):
    """A staged table's shuffle files go when it is written, not when the driver collects garbage."""
    from docroll.llm.common import stage

    folders = [d.toString() for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def files() -> int:
        return sum(name.startswith("shuffle_") for d in folders for _, _, names in os.walk(d) for name in names)

    before = files()
    setting = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    stage(spark.range(5000).repartition(7, "id"), "test-shuffle")
    for _ in range(100):  # Spark deletes them in the background
        if files() <= before:
            break
        time.sleep(0.1)
    assert files() <= before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting


def test_suffix_ranks_of_repeated_rows_and_long_runs(spark):
    """Rows that come twice, and strings that repeat at every offset, against plain Python."""
    rows = [(1, "ab" * 400 + "x" * 120), (1, "ab" * 400 + "x" * 120), (2, "q" + "ab" * 150 + "é" * 80), (None, "x" * 333), (3, "é" * 90 + "ab" * 99)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = suffix_dedup.suffix_digests(docs)
    plan = suffix_dedup._ranked(spark.range(3).selectExpr(*(f"id AS {c}" for c in ("r1", "r2", "doc_key", "text_key", "pos"))), 4, False)
    assert "rangepartitioning" not in plan._jdf.queryExecution().toString()  # no pass for a sample of the pairs
    assert sorted(map(tuple, got.drop("removed").collect())) == suffix_expected(rows_of(docs), 100)


def test_suffix_ranks_only_what_wider_samples_share(spark, monkeypatch):
    """Of two documents that share a passage, the doubling gets the halves of its strings and few others."""
    import random

    r = random.Random(11)
    own = ["".join(r.choice("abcdefghijklmnop ") for _ in range(3000)) for _ in range(40)]
    rows = [(i, own[i] + own[0][100:210] + own[i + 20]) for i in range(1, 20)]  # 11 strings each
    docs = spark.createDataFrame([(0, own[0]), *rows], "doc_id long, text string")
    ranked, sizes = suffix_dedup._ranked, []
    monkeypatch.setattr(suffix_dedup, "_ranked", lambda pairs, *a: sizes.append(pairs.count()) or ranked(pairs, *a))
    got = suffix_dedup.suffix_digests(docs).drop("removed").collect()
    assert sorted(map(tuple, got)) == suffix_expected(rows_of(docs), 100)
    assert sum(sizes) < 20 * 100
