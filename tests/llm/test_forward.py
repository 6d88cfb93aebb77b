"""The trained operators' scores against their formulas written out in plain loops."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from docroll.llm import langid, quality

TEXTS = [
    "Two short lines.\nWith a few words, and 3 numbers: 12, 345.",
    "Zwölf Käfer über Äpfel! " * 30,
    " \t leading and trailing space \n\n",
    "one",
    "again again again and again, " * 40 + "$$ {odd} | marks & more",
    "日本語 と English, mixed. " * 12,
]


def language_scores(net: langid.Network, text: str) -> list[float]:
    """Embedding, one filter response a position and width, maximum, ReLU, softmax; the windows'
    log probabilities weighted by their letters."""
    p = {k: v.tolist() for k, v in net.params.items()}
    data, reach = list(text.encode()), max(langid.WIDTHS) - 1
    sums, weights = [0.0] * len(net.languages), 0.0
    for begin in range(0, len(data), langid.WINDOW):
        window = data[begin : begin + langid.WINDOW + reach]
        window += [0] * (langid.WINDOW + reach - len(window))
        seen = [p["embed"][b] for b in window]
        hidden = []
        for i, width in enumerate(langid.WIDTHS):
            for f in range(i * langid.FILTERS, (i + 1) * langid.FILTERS):
                taps = [[p["filters"][j * langid.EMBED + e][f] for e in range(langid.EMBED)] for j in range(width)]
                top = max(sum(t * x for j in range(width) for t, x in zip(taps[j], seen[at + j])) for at in range(langid.WINDOW))
                hidden.append(max(top + p["shift"][f], 0.0))
        logits = [b + sum(h * p["out"][f][k] for f, h in enumerate(hidden)) for k, b in enumerate(p["bias"])]
        norm = math.log(sum(math.exp(x) for x in logits))
        letters = sum(chr(b).isalpha() and b < 128 or b >= 0xC3 for b in window[: langid.WINDOW]) + 1e-3
        sums = [s + letters * (x - norm) for s, x in zip(sums, logits)]
        weights += letters
    odds = [math.exp(s / weights) for s in sums]
    return [o / sum(odds) for o in odds]


def test_language_network_written_out():
    net = langid.Network.fresh(["a", "b", "c"], seed=4)
    net.params["bias"] += np.array([0.3, -0.2, 0.1], np.float32)
    texts = TEXTS[:3] + TEXTS[5:]
    names, scores = net.predict(pa.array(texts))
    for text, name, score in zip(texts, names, scores):
        want = language_scores(net, text)
        assert score == pytest.approx(max(want), abs=2e-4)
        assert sorted(want)[-1] - sorted(want)[-2] < 1e-3 or name == net.languages[want.index(max(want))]


def passages_of(text: str) -> list[tuple[list[str], bytes]]:
    """Words and bytes of each passage of ``PASSAGE`` words; bytes before the first word are the first's."""
    data, starts, inside = text.encode(), [], False
    for i, b in enumerate(data):
        blank = b == 0x20 or 9 <= b <= 13
        if not blank and not inside:
            starts.append(i)
        inside = not blank
    cuts = [0, *starts[quality.PASSAGE :: quality.PASSAGE], len(data)]
    return [(data[a:b].split(), data[a:b]) for a, b in zip(cuts, cuts[1:])]


def features(held: list[bytes], data: bytes) -> list[float]:
    kinds = [int(quality._CLASS[b]) for b in data]
    pairs = Counter(zip(kinds, kinds[1:]))
    size, n = max(sum(pairs.values()), 1), max(len(held), 1)
    out = [math.sqrt(pairs[a, b] / size) for a in range(quality.N_CLASSES) for b in range(quality.N_CLASSES)]
    mean = sum(map(len, held)) / n
    spread = math.sqrt(max(sum(len(w) ** 2 for w in held) / n - mean * mean, 0))
    beside = sum(a == b for a, b in zip(held, held[1:])) / n
    return out + [(len(held) - len(set(held))) / n, beside, math.log1p(mean), math.log1p(spread), min(data.count(b"\n") / n, 1), math.log1p(len(held)) / 4]


def quality_score(model: quality.BagModel, text: str) -> float:
    p = {k: v.tolist() for k, v in model.params.items()}
    dot = lambda x, m, k: sum(a * row[k] for a, row in zip(x, m))
    coded, energy = [], []
    for held, data in passages_of(text):
        x = features(held, data)
        h = [math.tanh(dot(x, p["encode"], k) + p["shift"][k]) for k in range(len(p["shift"]))]
        gate = [math.tanh(dot(h, p["v"], k)) / (1 + math.exp(-dot(h, p["u"], k))) for k in range(len(p["w"]))]
        coded.append(h)
        energy.append(sum(a * b for a, b in zip(gate, p["w"])))
    total = sum(map(math.exp, energy))
    bag = [sum(math.exp(e) / total * h[k] for e, h in zip(energy, coded)) for k in range(len(p["out"]))]
    return 1 / (1 + math.exp(-(sum(a * b for a, b in zip(bag, p["out"])) + p["bias"][0])))


def test_quality_model_written_out():
    model = quality.BagModel.fresh(seed=5)
    r = random.Random(2)
    texts = [*TEXTS, " ".join(r.choice(["alpha", "beta", "Gamma.", "7", "delta,\n"]) for _ in range(333))]
    got = model.score(pa.array(texts))
    assert got == pytest.approx([quality_score(model, t) for t in texts], abs=2e-5)
    assert len(set(got)) == len(texts)
