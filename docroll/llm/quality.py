"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages (``PASSAGE`` words each, the whole text). Every
passage is encoded: byte-class pair frequencies and a few word statistics go
through a learned tanh layer. Gated attention, learned from document labels only,
weighs the passages; the document is scored on its weighted representation.

Training takes a bounded sample (``PER_CLASS`` documents of each label) in numpy;
scoring runs over all passages of all texts. A null or empty text, or one without
words, is one passage without content. Only text (and, for training, the label)
is read; equal texts get equal scores (six decimals,
beyond which batches differ). Without training rows of both labels every
score is the share of label 1 (0.5 without any).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docroll.llm.common import RollingHash, chunks, text_buffer, words
from docroll.llm.sample import Adam, sample_by_class

PASSAGE = 50
HIDDEN = 32
ATTENTION = 16
PER_CLASS = 1500
EPOCHS = 30
#: Score from which a document is predicted to be of label 1.
THRESHOLD = 0.3
#: Longer texts are sent for training by this many pieces of this many characters.
PIECES, PIECE = 16, 2000

#: Byte classes: space, newline, digit, lower, upper, 8 kinds of punctuation, control, lead byte, continuation byte.
_CLASS = np.full(256, 13, dtype=np.int64)
_CLASS[0x20], _CLASS[0x0A] = 0, 1
_CLASS[48:58], _CLASS[97:123], _CLASS[65:91] = 2, 3, 4
for _i, _group in enumerate((b".", b",;:", b"!?", b"|/\\", b"#$%&*+=@^~", b"\"'`", b"()[]{}<>", b"-_")):
    for _b in _group:
        _CLASS[_b] = 5 + _i
_CLASS[0xC0:], _CLASS[0x80:0xC0] = 14, 15
N_CLASSES = 16
N_FEATURES = N_CLASSES * N_CLASSES + 6


def passages(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of all rows, and the row of each (rows ascending)."""
    rows = len(bounds) - 1
    start, end, row = words(data, bounds)
    count = np.bincount(row, minlength=rows)
    first = np.cumsum(count) - count
    bags = np.maximum(-(-count // PASSAGE), 1)
    base = np.cumsum(bags) - bags
    owner = np.repeat(np.arange(rows), bags)
    total = int(bags.sum())
    out = np.zeros((total, N_FEATURES), dtype=np.float32)
    if not len(start):
        return out, owner
    of = base[row] + (np.arange(len(row)) - first[row]) // PASSAGE
    # bytes belong to the passage of the last word that began before them
    byte_row = np.repeat(np.arange(rows), np.diff(bounds))
    at = np.searchsorted(start, np.arange(len(data)), side="right") - 1
    byte_of = np.where((at >= 0) & (row[np.maximum(at, 0)] == byte_row), of[np.maximum(at, 0)], base[byte_row])
    kind = _CLASS[data]
    pair = kind[:-1] * N_CLASSES + kind[1:]
    same = byte_of[:-1] == byte_of[1:]
    pairs = np.bincount(byte_of[:-1][same] * N_CLASSES * N_CLASSES + pair[same], minlength=total * N_CLASSES * N_CLASSES).reshape(total, -1)
    size = np.maximum(pairs.sum(axis=1), 1)
    out[:, :-6] = np.sqrt(pairs / size[:, None])
    h = RollingHash(data).ranges(start, end)
    held = np.bincount(of, minlength=total)
    n = np.maximum(held, 1)
    order = np.lexsort((h, of))
    again = (h[order][1:] == h[order][:-1]) & (of[order][1:] == of[order][:-1])
    repeats = np.bincount(of[order][1:][again], minlength=total) / n
    beside = np.bincount(of[1:][(h[1:] == h[:-1]) & (of[1:] == of[:-1])], minlength=total) / n
    length = (end - start).astype(np.float64)
    mean = np.bincount(of, weights=length, minlength=total) / n
    spread = np.sqrt(np.maximum(np.bincount(of, weights=length * length, minlength=total) / n - mean * mean, 0))
    lines = np.bincount(byte_of, weights=data == 0x0A, minlength=total) / n
    out[:, -6:] = np.stack([repeats, beside, np.log1p(mean), np.log1p(spread), np.minimum(lines, 1), np.log1p(held) / 4], axis=1)
    return out, owner


@dataclass
class BagModel:
    """Encoder, gated attention and document score."""

    params: dict[str, np.ndarray]
    constant: float | None = None

    @classmethod
    def fresh(cls, seed: int = 1) -> BagModel:
        rng = np.random.default_rng(seed)
        shape = {"encode": (N_FEATURES, HIDDEN), "shift": (HIDDEN,), "v": (HIDDEN, ATTENTION), "u": (HIDDEN, ATTENTION), "w": (ATTENTION,), "out": (HIDDEN,), "bias": (1,)}
        return cls({k: (rng.normal(0, 1 / np.sqrt(s[0]), s) if k not in ("shift", "bias") else np.zeros(s)) for k, s in shape.items()})

    def forward(self, x: np.ndarray, owner: np.ndarray, n: int) -> dict[str, np.ndarray]:
        p = self.params
        h = np.tanh(x @ p["encode"] + p["shift"])
        t, g = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
        e = (t * g) @ p["w"]
        begin = np.searchsorted(owner, np.arange(n))
        a = np.exp(e - np.maximum.reduceat(e, begin)[owner])
        a /= np.add.reduceat(a, begin)[owner]
        z = np.add.reduceat(a[:, None] * h, begin, axis=0)
        return {"h": h, "t": t, "g": g, "a": a, "z": z, "score": 1 / (1 + np.exp(-(z @ p["out"] + p["bias"][0])))}

    def gradients(self, x, owner, label, weight) -> dict[str, np.ndarray]:
        p, f = self.params, self.forward(x, owner, len(label))
        d = (f["score"] - label) * weight / weight.sum()
        d_z = d[:, None] * p["out"]
        d_h = f["a"][:, None] * d_z[owner]
        d_a = (f["h"] * d_z[owner]).sum(axis=1)
        begin = np.searchsorted(owner, np.arange(len(label)))
        d_e = f["a"] * (d_a - np.add.reduceat(f["a"] * d_a, begin)[owner])
        d_tg = d_e[:, None] * p["w"]
        d_v, d_u = d_tg * f["g"] * (1 - f["t"] ** 2), d_tg * f["t"] * f["g"] * (1 - f["g"])
        d_h += d_v @ p["v"].T + d_u @ p["u"].T
        d_x = d_h * (1 - f["h"] ** 2)
        return {"encode": x.T @ d_x, "shift": d_x.sum(0), "v": f["h"].T @ d_v, "u": f["h"].T @ d_u, "w": (f["t"] * f["g"]).T @ d_e, "out": f["z"].T @ d, "bias": np.array([d.sum()])}

    def score(self, texts: pa.Array) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        data, bounds = text_buffer(texts)
        out = np.zeros(len(texts))
        for i, j in chunks(bounds, 1 << 19):
            x, owner = passages(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])
            out[i:j] = np.round(self.forward(x, owner, j - i)["score"], 6)
        return out


def train(texts: list[bytes], labels: list[int], seed: int = 1) -> BagModel:
    """Fit a model to texts with labels 0 and 1; both classes weigh the same."""
    model, label = BagModel.fresh(seed), np.array(labels, dtype=np.float64)
    if len(set(labels)) < 2:
        return BagModel(model.params, float(label.mean()) if len(label) else 0.5)
    bounds = np.cumsum([0, *map(len, texts)])
    parts = [passages(np.frombuffer(b"".join(texts[i:j]), np.uint8), bounds[i : j + 1] - bounds[i]) for i, j in chunks(bounds, 1 << 19)]
    sizes = np.concatenate([np.bincount(owner) for _, owner in parts])
    x = np.concatenate([f for f, _ in parts])
    begin = np.concatenate([[0], np.cumsum(sizes)])
    weight = np.where(label == 1, 0.5 / label.mean(), 0.5 / (1 - label.mean()))
    rng, adam = np.random.default_rng(seed), Adam(model.params, rate=5e-3, decay=1e-5)
    for _ in range(EPOCHS):
        order = rng.permutation(len(label))
        for k in range(0, len(order), 64):
            at = np.sort(order[k : k + 64])
            rows = np.concatenate([np.arange(begin[i], begin[i + 1]) for i in at])
            owner = np.repeat(np.arange(len(at)), sizes[at])
            adam.step(model.gradients(x[rows].astype(np.float64), owner, label[at], weight[at]))
    return model


def fit(docs: DataFrame, labels: DataFrame, training) -> BagModel:
    """A model fitted to a bounded sample of the labelled rows (labels: doc_id,
    quality; several labels of one document count by their mean) that ``training``
    holds for: of at most ``PER_CLASS`` ids a label, at most ``PER_CLASS`` distinct texts,
    however often an id is repeated. Rows without an id have no label."""
    one = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    chosen = sample_by_class(one.where(training), "label", "doc_id", PER_CLASS).select(F.col("doc_id").alias("_id"), "label")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    step = (F.length(text) / PIECES).cast("int")
    pieces = F.concat(*[F.substring(text, F.lit(1) + step * i, F.lit(PIECE)) for i in range(PIECES)])
    cut = F.when(F.length(text) <= PIECES * PIECE, text).otherwise(pieces)
    texts = docs.select("doc_id", F.xxhash64(text).alias("text_key"), cut.alias("text"))
    of_ids = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).drop("_id")
    rows = sample_by_class(of_ids, "label", ["doc_id", "text_key"], PER_CLASS).select("doc_id", "label", "text").collect()  # PER_CLASS a label
    rows.sort()
    return train([r[2].encode() for r in rows], [r[1] for r in rows])


def scorer(spark, model: BagModel):
    """A column function: text to score."""
    sent = spark.sparkContext.broadcast(model)

    def score(texts: pa.Array) -> pa.Array:
        return pa.array(sent.value.score(texts), pa.float64())

    score.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(score, "double")


def score_documents(docs: DataFrame, model: BagModel, into: str = "score") -> DataFrame:
    """``docs`` with the column ``into``."""
    return docs.withColumn(into, scorer(docs.sparkSession, model)(F.col("text").cast("string")))
