"""Language identification by a byte convolutional network, trained here in numpy.

A text is cut into windows of ``WINDOW`` bytes that overlap by the widest
filter less one, so no run of bytes is missed; the last window is padded with
zeros.  For each width, ``FILTERS`` filters slide over the one-hot bytes of a
window; each filter's largest value in the window, rectified, is a feature, and
a softmax over the features gives the languages' probabilities.  A document's
score is the mean of its windows', weighted by their bytes.

Training takes at most about ``SAMPLE`` documents a language (all rows of rare
languages; less where there are so many that ``ROWS`` are divided among them, but one
at least), chosen by a hash of the id among the given rows, and of each at
most ``CROPS`` windows at hashed places.  The features' gradients reach only the
bytes at each maximum.  The seed is fixed, so equal tables give equal models.

Texts that are null or have no letter are ``und`` with score 0.  Repeated rows
give repeated results.  Without any training row every text is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_bytes, pieces

WIDTHS, FILTERS, WINDOW = (2, 3, 4), 16, 256
SAMPLE, CROPS, EPOCHS, RATE = 1200, 3, 6, 0.01
#: training steps at least, however few the windows
STEPS = 600
#: documents of all languages together at most, about
ROWS = 600_000
_STEP = WINDOW - max(WIDTHS) + 1


class Network:
    """Weights: for every width an array (width, 256, FILTERS) and a bias, then the softmax layer."""

    def __init__(self, languages: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.conv = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages))).astype(np.float32)
        self.out_bias = np.zeros(len(languages), np.float32)
        self._pairs: list | None = None

    def __getstate__(self):
        return self.__dict__ | {"_pairs": None}

    def _features(self, x: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Maxima and their places, for training."""
        top, place = [], []
        for w, conv, bias in zip(WIDTHS, self.conv, self.bias, strict=True):
            n = x.shape[1] - w + 1
            y = conv[0][x[:, :n]]
            for k in range(1, w):
                y += conv[k][x[:, k : k + n]]
            p = y.argmax(1)
            place.append(p)
            top.append(np.take_along_axis(y, p[:, None], 1)[:, 0] + bias)
        return top, place

    def train(self, x: np.ndarray, y: np.ndarray, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        params = [*self.conv, *self.bias, self.out, self.out_bias]
        m, v, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        for _ in range(max(EPOCHS, -(-STEPS // max(1, -(-len(x) // 128))))):
            order = rng.permutation(len(x))
            for lo in range(0, len(x), 128):
                rows = order[lo : lo + 128]
                xb, yb = x[rows], y[rows]
                top, place = self._features(xb)
                h = np.maximum(np.concatenate(top, 1), 0)
                p = _softmax(h @ self.out + self.out_bias)
                p[np.arange(len(yb)), yb] -= 1
                p /= len(yb)
                dh = (p @ self.out.T) * (h > 0)
                grads: list[np.ndarray] = []
                at, f = np.arange(len(yb))[:, None], np.arange(FILTERS)[None, :]
                for i, w in enumerate(WIDTHS):
                    d = dh[:, i * FILTERS : (i + 1) * FILTERS]
                    g = np.zeros_like(self.conv[i])
                    for k in range(w):
                        np.add.at(g[k], (xb[at, place[i] + k], f), d)
                    grads.append(g)
                grads += [dh[:, i * FILTERS : (i + 1) * FILTERS].sum(0) for i in range(len(WIDTHS))]
                grads += [h.T @ p, p.sum(0)]
                t += 1
                for q, g, a, b in zip(params, grads, m, v, strict=True):
                    a += 0.1 * (g - a)
                    b += 0.001 * (g * g - b)
                    q -= RATE * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.999**t)) + 1e-8)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Of each row of bytes.  Two neighbouring bytes are looked up at once."""
        if self._pairs is None:
            both = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, FILTERS)
            self._pairs = [[both(c[k], c[k + 1]) if k + 1 < len(c) else c[k] for k in range(0, len(c), 2)] for c in self.conv]
        pair = (x[:, :-1].astype(np.uint16) << 8) | x[:, 1:]
        top = []
        for w, tables, bias in zip(WIDTHS, self._pairs, self.bias, strict=True):
            n = x.shape[1] - w + 1
            y = tables[0].take(pair[:, :n], 0)
            for k, one in enumerate(tables[1:], 1):
                y += one.take(pair[:, 2 * k : 2 * k + n] if len(one) == 65536 else x[:, 2 * k : 2 * k + n], 0)
            top.append(y.max(1) + bias)
        return _softmax(np.maximum(np.concatenate(top, 1), 0) @ self.out + self.out_bias)

    def documents(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean probabilities of several texts; of an empty one 0."""
        total = np.zeros((len(offsets) - 1, len(self.languages)))
        size = np.diff(offsets)
        count = np.where(size > 0, np.maximum(1, -(-(size - WINDOW + _STEP) // _STEP)), 0)
        text = np.repeat(np.arange(len(size)), count)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
        begin = offsets[text] + nth * _STEP
        length = np.minimum(WINDOW, offsets[text + 1] - begin)
        padded = np.append(raw, np.zeros(WINDOW, np.uint8))
        for lo in range(0, len(text), 256):
            b, n = begin[lo : lo + 256], length[lo : lo + 256]
            cols = np.arange(WINDOW)
            x = np.where(cols < n[:, None], padded[b[:, None] + cols], 0).astype(np.uint8)
            np.add.at(total, text[lo : lo + 256], self.probabilities(x) * n[:, None])
        weight = np.zeros(len(size))
        np.add.at(weight, text, length)
        return total / np.maximum(weight, 1)[:, None]


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def training_windows(rows: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """(label, window) of the sample: byte windows of 24 to WINDOW bytes at hashed places."""
    draw = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(3)), F.lit(1 << 30)) / (1 << 30)
    counts = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.min(draw).alias("least"))
    each = min(SAMPLE, ROWS / max(rows.select(label).distinct().count(), 1))
    sample = rows.join(F.broadcast(counts), label).where((draw < F.lit(float(each)) / F.col("n")) | (draw == F.col("least"))).select(F.col(label).alias("label"), F.xxhash64(F.col(key).cast("string")).alias("h"), F.col(text).alias("text"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for label, h, t in zip(b["label"], b["h"], b["text"], strict=True):
                raw, rng = t.encode(), np.random.default_rng(h & 0x7FFFFFFFFFFFFFFF)
                for k in range(min(CROPS, 1 + len(raw) // WINDOW)):
                    size = WINDOW if k == 0 else int(rng.integers(24, WINDOW + 1))
                    at = int(rng.integers(0, max(1, len(raw) - size + 1)))
                    out.append((label, h, k, raw[at : at + size]))
            yield pd.DataFrame(out, columns=["label", "h", "k", "window"])

    return sample.mapInPandas(cut, "label string, h bigint, k int, window binary")


def fit(rows: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang") -> Network:
    """A network for the labelled rows given (null labels and texts are left out)."""
    rows = rows.where(F.col(label).isNotNull() & F.col(text).rlike(r"\p{L}")).select(key, text, label)
    got = training_windows(rows, key, text, label).collect()
    got.sort(key=lambda r: (r["label"], r["h"], r["k"], r["window"]))
    languages = sorted({r["label"] for r in got})
    net = Network(languages)
    if len(languages) > 1:
        x = np.zeros((len(got), WINDOW), np.uint8)
        for i, r in enumerate(got):
            x[i, : len(r["window"])] = np.frombuffer(bytes(r["window"]), np.uint8)
        net.train(x, np.array([languages.index(r["label"]) for r in got]))
    return net


def predicted(net: Network, docs: DataFrame, text: str = "text") -> Column:
    """A struct (lang_pred, score) for every row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(net)

    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        net = sent.value
        names = np.array(net.languages or ["und"], object)
        for b in batches:
            raw, offsets = arrow_bytes(pa.array(b, pa.string(), from_pandas=True))
            p = np.zeros((len(b), len(names)))
            for lo, hi in pieces(offsets) if net.languages else ():
                p[lo:hi] = net.documents(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            yield pd.DataFrame({"lang_pred": names[p.argmax(1)], "score": np.clip(p.max(1), 0, 1)})

    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    none = F.struct(F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    return F.when(letters, predict(docs[text])).otherwise(none)
