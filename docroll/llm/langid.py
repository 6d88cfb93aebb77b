"""Language identification by a byte convolutional network.

Bytes are embedded, convolved with filters of several widths, max-pooled over a
window, and classified by softmax. The network is trained in numpy on a bounded
sample (``PER_LANGUAGE`` documents of each language, ``WINDOWS`` windows of each)
of the rows that the caller marks as training rows, and applied to every window
of every text: fixed windows of ``WINDOW`` bytes, batch by batch. A document's
language has the largest mean log probability over its windows (weighted by
their letters); its score is the geometric mean probability, normalised.

Bytes that are no UTF-8 count as bytes and are no letters. A text that is null or has no letter is ``und`` with score 0, and so is every text
when no training row has a language. Only text (and, for training, the label)
is read; equal texts get equal results (scores have six
decimals, beyond which batches differ).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docroll.llm.common import chunks, release, text_buffer
from docroll.llm.sample import Adam, sample_by_class

WINDOW = 256
EMBED = 8
WIDTHS = (2, 3, 4, 5)
FILTERS = 16
PER_LANGUAGE = 500
WINDOWS = 4
EPOCHS = 8
#: Texts longer than this are sent for training by pieces from all over them.
SENT = 8192
UNKNOWN = "und"
#: A document whose best language scores less is rejected by ``accepted``.
LEAST_SCORE = 0.5

_ASCII_LETTER = np.zeros(256, dtype=bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True


def windows(data: np.ndarray, bounds: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """All windows of all rows, zero-padded, with a filter's reach behind them; the row of each."""
    reach = max(WIDTHS) - 1
    count = -(-np.diff(bounds) // window)
    row = np.repeat(np.arange(len(count)), count)
    start = bounds[row] + (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)) * window
    at = start[:, None] + np.arange(window + reach)
    out = data[np.minimum(at, len(data) - 1)] if len(data) else np.zeros(at.shape, np.uint8)
    return np.where(at < bounds[row + 1][:, None], out, np.uint8(0)), row


@dataclass
class Network:
    """Weights of the network; one matrix holds the filters of all widths."""

    languages: list[str]
    params: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, languages: list[str], seed: int = 1) -> Network:
        rng = np.random.default_rng(seed)
        widest, filters = max(WIDTHS), FILTERS * len(WIDTHS)
        params = {
            "embed": rng.normal(0, 0.5, (256, EMBED)).astype(np.float32),
            "filters": (rng.normal(0, 0.3, (widest * EMBED, filters)) * cls.reach()).astype(np.float32),
            "shift": np.zeros(filters, np.float32),
            "out": rng.normal(0, 0.2, (filters, len(languages))).astype(np.float32),
            "bias": np.zeros(len(languages), np.float32),
        }
        params["embed"][0] = 0
        return cls(languages, params)

    @staticmethod
    def reach() -> np.ndarray:
        """1 where a filter has a weight: the first bytes up to its width."""
        mask = np.zeros((max(WIDTHS) * EMBED, FILTERS * len(WIDTHS)), np.float32)
        for i, w in enumerate(WIDTHS):
            mask[: w * EMBED, i * FILTERS : (i + 1) * FILTERS] = 1
        return mask

    def pooled(self, batch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Unfolded embeddings and filter responses of a batch of windows."""
        seen = self.params["embed"][batch]
        view = np.lib.stride_tricks.sliding_window_view(seen, (max(WIDTHS), EMBED), axis=(1, 2))
        n, width = view.shape[:2]
        unfolded = view.reshape(n * width, -1)
        return unfolded, (unfolded @ self.params["filters"]).reshape(n, width, -1)

    def log_probabilities(self, batch: np.ndarray) -> np.ndarray:
        hidden = np.maximum(self.pooled(batch)[1].max(axis=1) + self.params["shift"], 0)
        logits = hidden @ self.params["out"] + self.params["bias"]
        logits -= logits.max(axis=1, keepdims=True)
        return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))

    def gradients(self, batch: np.ndarray, label: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        p = self.params
        unfolded, response = self.pooled(batch)
        top = response.argmax(axis=1)
        most = np.take_along_axis(response, top[:, None, :], axis=1)[:, 0] + p["shift"]
        hidden = np.maximum(most, 0)
        logits = hidden @ p["out"] + p["bias"]
        prob = np.exp(logits - logits.max(axis=1, keepdims=True))
        prob /= prob.sum(axis=1, keepdims=True)
        prob[np.arange(len(label)), label] -= 1
        d_logits = prob * weight[:, None] / weight.sum()
        d_hidden = (d_logits @ p["out"].T) * (most > 0)
        n, width, filters = response.shape
        # only the position that each filter peaked at gets its gradient
        picked = unfolded.reshape(n, width, -1)[np.arange(n)[:, None], top]  # n, filters, widest * EMBED
        d_filters = np.einsum("nfk,nf->kf", picked, d_hidden) * self.reach()
        d_seen = np.einsum("nf,kf->nfk", d_hidden, p["filters"]).reshape(n, filters, max(WIDTHS), EMBED)
        d_embed = np.zeros_like(p["embed"])
        for j in range(max(WIDTHS)):
            np.add.at(d_embed, batch[np.arange(n)[:, None], top + j], d_seen[:, :, j])
        d_embed[0] = 0
        return {"embed": d_embed, "filters": d_filters, "shift": d_hidden.sum(0), "out": hidden.T @ d_logits, "bias": d_logits.sum(0)}

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and score of each text of an Arrow column."""
        data, bounds = text_buffer(texts)
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        for i, j in chunks(bounds):
            part = data[bounds[i] : bounds[j]]
            seen, row = windows(part, bounds[i : j + 1] - bounds[i])
            if not len(row) or not self.languages:
                continue
            log_p = np.concatenate([self.log_probabilities(seen[k : k + 64]) for k in range(0, len(seen), 64)])
            letters = (_ASCII_LETTER[seen[:, :WINDOW]] | (seen[:, :WINDOW] >= 0xC3)).sum(axis=1) + 1e-3
            total = np.zeros((j - i, len(self.languages)))
            np.add.at(total, row, log_p * letters[:, None])
            total /= np.maximum(np.bincount(row, weights=letters, minlength=j - i), 1e-9)[:, None]
            prob = np.exp(total - total.max(axis=1, keepdims=True))
            prob /= prob.sum(axis=1, keepdims=True)
            ascii_letter = np.bincount(row, weights=_ASCII_LETTER[seen[:, :WINDOW]].sum(axis=1), minlength=j - i) > 0
            for k in np.flatnonzero(np.diff(bounds[i : j + 1])).tolist():
                if ascii_letter[k] or any(c.isalpha() for c in data[bounds[i + k] : bounds[i + k + 1]].tobytes().decode("utf-8", "ignore")):
                    best = int(prob[k].argmax())
                    names[i + k], scores[i + k] = self.languages[best], round(float(prob[k, best]), 6)
        release()
        return names, scores


def train(texts: list[bytes], labels: list[str], seed: int = 1) -> Network:
    """Fit a network to labelled texts."""
    languages = sorted(set(labels))
    net = Network.fresh(languages, seed)
    rng = np.random.default_rng(seed)
    seen, label = [], []
    for text, name in zip(texts, labels):
        data = np.frombuffer(text, np.uint8)
        rows, _ = windows(data, np.array([0, len(data)]))
        pick = rows if len(rows) <= WINDOWS else rows[rng.choice(len(rows), WINDOWS, replace=False)]
        seen.append(pick)
        label += [languages.index(name)] * len(pick)
    if not label:
        return Network([], net.params)
    seen, label = np.concatenate(seen), np.array(label)
    weight = (len(label) / np.maximum(np.bincount(label, minlength=len(languages)), 1))[label].astype(np.float32)
    adam = Adam(net.params)
    for _ in range(EPOCHS):
        order = rng.permutation(len(label))
        for k in range(0, len(order), 64):
            at = order[k : k + 64]
            adam.step(net.gradients(seen[at], label[at], weight[at]))
    return net


def fit(docs: DataFrame, training) -> Network:
    """A network fitted to a bounded sample of the rows of ``docs`` (doc_id, text,
    lang) that ``training`` holds for: of at most ``PER_LANGUAGE`` ids a language, at
    most ``PER_LANGUAGE`` distinct texts, however often an id (or none) is repeated."""
    usable = docs.where(training & F.col("lang").isNotNull() & (F.length("text") > 0))
    chosen = sample_by_class(usable.select("doc_id", "lang"), "lang", "doc_id", PER_LANGUAGE).select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang"))
    whole = F.col("text").cast("string")
    step = F.greatest(F.length(whole) / 8, F.lit(SENT / 8)).cast("int")
    pieces = F.concat(*[F.substring(whole, F.lit(1) + step * i, F.lit(SENT // 8)) for i in range(8)])
    cut = F.when(F.length(whole) <= SENT, whole).otherwise(pieces)
    texts = usable.select("doc_id", "lang", F.xxhash64(whole).alias("text_key"), cut.alias("text"))
    of_ids = texts.join(F.broadcast(chosen), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("lang") == F.col("_lang"))).drop("_id", "_lang")
    rows = sample_by_class(of_ids, "lang", ["doc_id", "text_key"], PER_LANGUAGE).select("lang", "doc_id", "text").collect()  # PER_LANGUAGE a language
    rows.sort(key=lambda r: (r[0], r[1] is None, r[1] or 0, r[2]))
    return train([r[2].encode() for r in rows], [r[0] for r in rows])


def predictor(spark, network: Network):
    """A column function: text to struct(lang_pred, score)."""
    sent = spark.sparkContext.broadcast(network)

    def guess(texts: pa.Array) -> pa.Array:
        names, scores = sent.value.predict(texts)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["lang_pred", "score"])

    guess.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(guess, "struct<lang_pred:string, score:double>")


def identify(docs: DataFrame, network: Network, into: str = "_language") -> DataFrame:
    """``docs`` with a column struct(lang_pred, score)."""
    return docs.withColumn(into, predictor(docs.sparkSession, network)(F.col("text").cast("string")))


def accepted(docs: DataFrame, network: Network, least: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs`` (same columns, whatever their names) whose language is known
    with a score of at least ``least``."""
    guess = predictor(docs.sparkSession, network)(F.col("text").cast("string"))
    got = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), guess.alias("guess"))
    return got.where((F.col("guess.lang_pred") != UNKNOWN) & (F.col("guess.score") >= least)).select("row.*")
