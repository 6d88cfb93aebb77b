"""Packing: ids against the tokenizer itself, places against plain counting, the number
of sequences against the tokens and against best-fit decreasing."""

from __future__ import annotations

import json
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, seed, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from docroll.llm import packing as K
from docroll.llm import queries as Q

from .conftest import SMALL

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def words():
    return K.Words(PATH)


def ids_of(tokenizer, text: str | None) -> list[int]:
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def check(rows, texts: list[tuple], tokenizer, capacity: int = 1024) -> int:
    """Rows hold every id of every document once, in gapless sequences; the number of sequences."""
    want: dict = {}
    for doc, text in texts:
        ids = ids_of(tokenizer, text)
        first = len(ids) % capacity or capacity
        edges = [0, *range(first, len(ids) + 1, capacity)]
        for piece, (a, b) in enumerate(zip(edges, edges[1:])):
            key = (doc, piece, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes()))
            want[key] = want.get(key, 0) + 1
    got: dict = {}
    sequences: dict = {}
    for r in rows:
        key = (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
        got[key] = got.get(key, 0) + 1
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert got == want
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_whole_query(spark, small, tokenizer):
    rows = Q.QUERIES["op13_linear_grouping_pack"](spark, SMALL).collect()
    texts = [(r.doc_id, r.text) for r in small.collect()]
    n = check(rows, texts, tokenizer)
    tokens = sum(r.length for r in rows)
    assert n <= 1.02 * -(-tokens // 1024) + 1


@pytest.mark.parametrize("capacity", [16, 1024])
def test_odd_rows(spark, odd, tokenizer, capacity):
    texts = [(r.doc_id, r.text) for r in odd.collect()]
    extra = [(50, "  two  spaces \n\n and\tmore "), (51, "<|endoftext|> inside <|endoftext|>"), (52, " lead"), (53, "a" * 5000), (54, "it's  don't, é, 12²,3"), (None, " wide  space")]
    docs = odd.select("doc_id", "text", "size").unionByName(spark.createDataFrame([(*e, 1) for e in extra], "doc_id long, text string, size int")).withColumnRenamed("size", "length")
    check(K.pack(docs, PATH, capacity).collect(), texts + extra, tokenizer, capacity)


def test_ids_are_kept_on_request_and_round_trip(spark, tokenizer):
    text = "one two three, four. " * 40
    rows = K.pack(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string"), PATH, 64, keep_ids=True).collect()
    ids = b"".join(r.ids for r in sorted(rows, key=lambda r: r.start) if r.doc_id == 1)
    assert tokenizer.decode(np.frombuffer(ids, "<u4")[:-1].tolist()) == text
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in rows if r.doc_id == 2] == [[2]]


def test_empty_table_and_invalid_text(spark, nothing, tokenizer):
    assert K.pack(nothing, PATH).collect() == []
    (r,) = K.pack(spark.sql("SELECT 1L AS doc_id, CAST(unhex('41FF42') AS STRING) AS text"), PATH).collect()
    assert r.ids_crc32 == zlib.crc32(np.array(ids_of(tokenizer, "A�B"), dtype="<u4").tobytes())


PIECE = st.sampled_from(["word", "Word,", "a.\nb", "it's", "été.", " ", "  ", "\n", "\t", "12", "²", "!!", "'", "s", "é", " ", " ", "\x1c", "<|endoftext|>", "\U0001f600", "中文", "..", ","])


@seed(3)
@settings(max_examples=300, deadline=None)
@given(st.lists(PIECE, max_size=12).map("".join))
def test_ids_of_words_are_the_ids_of_the_text(words, tokenizer, text):
    (got,) = words.ids([text])
    assert np.frombuffer(got, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def best_fit_decreasing(hist: np.ndarray) -> int:
    rooms, n = np.zeros(len(hist), dtype=int), 0
    for length in range(len(hist) - 1, 0, -1):
        for _ in range(hist[length]):
            fits = np.flatnonzero(rooms[length:])
            room = fits[0] + length if len(fits) else len(hist) - 1
            n += not len(fits)
            rooms[room] -= bool(len(fits))
            rooms[room - length] += 1
    return n


def placed(hist: np.ndarray, **how) -> int:
    runs = K.plan(hist, len(hist) - 1, **how)
    got = np.zeros(len(hist), dtype=np.int64)
    for n, items in runs:
        assert n > 0 and sum(x * m for x, m in items) < len(hist)
        for x, m in items:
            got[x] += n * m
    assert (got == hist).all()
    table = K.places(runs)
    for x in np.unique(table["length"]):
        own = table["length"] == x
        assert table["first"][own][0] == 0 and (np.diff(table["first"][own]) > 0).all()
    return sum(n for n, _ in runs)


@seed(4)
@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 64), st.integers(1, 300)), max_size=25), st.integers(1, 12), st.sampled_from([0.1, 0.25, 0.4]))
def test_plan_places_every_piece(sizes, groups, small):
    hist = np.zeros(65, dtype=np.int64)
    for length, n in sizes:
        hist[length] += n
    total = -(-int((hist * np.arange(65)).sum()) // 64)
    assert placed(hist, n_groups=groups, small=small) >= total


def test_plan_is_near_best_fit_decreasing_and_does_not_grow_with_the_counts():
    dice = np.random.default_rng(1)
    lengths = np.minimum(1024, dice.lognormal(5.8, 0.9, 20000).astype(int) + 1)
    hist = np.bincount(lengths, minlength=1025)
    assert placed(hist) <= 1.01 * best_fit_decreasing(hist)
    many = hist.astype(np.int64) * 10_000_000
    assert len(K.plan(many)) < 6000
    assert placed(many) <= 1.01 * 10_000_000 * best_fit_decreasing(hist)


def test_plain_texts_are_encoded_whole_and_odd_ones_by_words(tokenizer):
    """Every plain character beside letters, digits, marks and white space; other texts as before."""
    own = K.Words(PATH)
    plain = [c for c in map(chr, range(0x2100)) if not K.ODD.search(c)]
    texts = [f"a{c}b 1{c}2 {c} .{c}, {c}{c}a\n{c}\n'{c}s  {c}" for c in plain]
    odd = ["漢字 and words, 漢字", "a<|endoftext|>b", "x" + " " * 5000 + "y", "क्षि ͸ z"]
    got = own.ids(texts + ["it's I'LL 's" * 40, "q" * 90000, ""])
    assert not own.words  # no text went word by word
    got += own.ids(odd)
    assert own.words
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in [*texts, "it's I'LL 's" * 40, "q" * 90000, "", *odd]]
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == want
    assert own._by_words(texts[:300]) == got[:300]


def test_other_byte_level_settings_are_not_encoded_whole():
    spec = json.loads(Path(PATH).read_text())
    assert K._merges(spec)
    for change in ({"add_prefix_space": True}, {"use_regex": False}):
        assert K._merges(spec | {"pre_tokenizer": spec["pre_tokenizer"] | change}) is None


def test_plain_words_around_odd_ones_are_not_kept(tokenizer):
    """A worker keeps the words that hold odd characters, not every word of their texts."""
    own = K.Words(PATH)
    texts = [" ".join(f"word{i}x{k}" for k in range(200)) + f" 中{i % 3}文 end" for i in range(50)]
    texts += ["中 a  b 中", " 中", "a\n 中 b <|endoftext|> c d", "x" + " " * 3000 + "y 中z w", "中文" * 40 + " a"]
    assert [np.frombuffer(x, "<u4").tolist() for x in own.ids(texts)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(own.words) < 20
