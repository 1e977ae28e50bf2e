"""Toxicity by weak supervision.

0. Copies would make every word of a toxic text look toxic: of sampled rows that
   share one of ``SIGNS`` min-hashes of their word triples one stays.
1. Lexicons: over a sample of labelled rows, Spark counts in how many toxic and
   other documents each word, and each word beginning of 4 or 5 letters,
   occurs.  Terms that stand out on the toxic side (log odds ratio ``SURE``
   standard errors above 0, and 1.64 above ``ODDS``) are dealt into ``LEXICONS`` lists; terms
   with the same first four letters share a list.
2. Voters: each list fires on a document that has one of its terms; each of a
   few patterns (address, threat, censored word, shouting) fires on a match; the
   given label is one voter more, itself not taken for certain.
3. Label model: latent toxicity generates the votes.  Expectation maximisation
   estimates how often each voter fires on either side; the votes' correlations
   that the latent class leaves unexplained lower the weight of voters that
   repeat each other, and the estimation runs again.
4. A logistic regression on the terms and patterns is trained on the model's
   posteriors and scores every document.

The sample has about ``SAMPLE`` rows at most, chosen by a hash of the id; all
that is collected is bounded by it and by ``TERMS``.

A null text scores as the empty one: the classifier's base rate.  Repeated rows
give repeated results.  Without labelled rows of both kinds every score is the
share of toxic ones (0 without any row).  Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_mod4, mix, ngrams, words_of, written

SAMPLE, TERMS, LEXICONS, SURE, THRESHOLD = 8000, 2000, 32, 2.8, 0.3
#: the least log odds ratio of a lexicon's term, at the lower end of its 90 % interval
ODDS = 1.5
STEMS = (4, 5)
SIGNS = 4
_SIGN = mix(np.arange(1, SIGNS + 1, dtype=np.uint64))
_WORD = re.compile(r"[^\W\d_]+")
#: a part that must occur (as it is, or lowered) before the pattern is tried
_PATTERNS = (
    ("you", True, re.compile(r"\byou(?:'re| are) (?:an? |so |such )")),
    ("shut up", True, re.compile(r"\bshut up\b")),
    ("hate you", True, re.compile(r"\bhate you\b")),
    ("*", False, re.compile(r"\b\w+\*+\w*")),
    ("!!", False, re.compile(r"!!")),
    ("!", False, re.compile(r"\b[A-Z]{4,}!")),
)


def terms(text: str) -> tuple[set[str], str]:
    low = text.lower()
    return set(_WORD.findall(low)), low


def stems(words: set[str]) -> set[str]:
    return {"^" + w[:n] for n in STEMS for w in words if len(w) > n}


def patterns(text: str, low: str) -> list[int]:
    return [int(part in (low if lowered else text) and p.search(low if lowered else text) is not None) for part, lowered, p in _PATTERNS]


def signs(text: str) -> list[int]:
    """Min-hashes of a text's word triples; texts of a word or two have their own, empty ones none."""
    raw = np.frombuffer(text.encode(), np.uint8)
    words, _ = words_of(raw, np.array([0, len(raw)]))
    grams = ngrams(words, 3) if len(words) >= 3 else words
    return [int(mix(grams ^ k).min().view(np.int64)) for k in _SIGN] if len(grams) else []


class LabelModel:
    """Votes (n x v, 0 or 1) generated by a latent class; ``posterior`` after ``fit``."""

    def fit(self, votes: np.ndarray, start: np.ndarray, rounds: int = 10) -> LabelModel:
        self.weight, self.prior = np.ones(votes.shape[1]), float(np.clip(start.mean(), 1e-3, 1 - 1e-3))
        q = start.astype(float)
        self._estimate(votes, q)
        self._weigh(votes, q, 0.8)  # voters that all but repeat each other; the rest once the classes are known
        for _ in range(2):
            for _ in range(rounds):
                self._estimate(votes, q)
                q = self.posterior(votes)
            self._weigh(votes, q)
        self._estimate(votes, q)
        return self

    def _estimate(self, votes: np.ndarray, q: np.ndarray) -> None:
        n1, n0 = q.sum(), (1 - q).sum()
        self.fires = np.stack([((1 - q) @ votes + 0.05) / (n0 + 1), (q @ votes + 0.05) / (n1 + 1)])

    def _weigh(self, votes: np.ndarray, q: np.ndarray, least: float = 0.0) -> None:
        """Correlations within the classes; a voter that others repeat counts for less."""
        expect = np.outer(1 - q, self.fires[0]) + np.outer(q, self.fires[1])
        rest = votes - expect
        sd = np.sqrt((rest**2).mean(0)) + 1e-9
        self.correlation = (rest.T @ rest) / len(votes) / np.outer(sd, sd)
        others = np.clip(self.correlation, 0, 1) - np.eye(len(sd))
        self.weight = 1 / (1 + np.where(others > least, others, 0).sum(1))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        f = np.clip(self.fires, 1e-6, 1 - 1e-6)
        fired, silent = np.log(f[1] / f[0]) * self.weight, np.log((1 - f[1]) / (1 - f[0])) * self.weight
        z = np.log(self.prior / (1 - self.prior)) + votes @ fired + (1 - votes) @ silent
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Classifier:
    """Logistic regression: a weight for each term and pattern, and a base."""

    def __init__(self, weights: dict[str, float], pattern_weights: list[float], base: float):
        self.words = {t: w for t, w in weights.items() if t[0] != "^"}
        self.stems = {n: {t[1:]: w for t, w in weights.items() if t[0] == "^" and len(t) == n + 1} for n in STEMS}
        self.patterns, self.base = pattern_weights, base

    def score(self, text: str | None) -> float:
        z = self.base
        if text:
            words, low = terms(text)
            z += sum(self.words[w] for w in sorted(words & self.words.keys()))
            for n, held in self.stems.items():
                if held:
                    z += sum(held[s] for s in sorted({w[:n] for w in words if len(w) > n} & held.keys()))
            z += sum(w for w, x in zip(self.patterns, patterns(text, low), strict=True) if x)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def sampled(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """(h, toxic, terms, patterns) of the sample of labelled rows."""
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & (crc_mod4(key) != 2))
    n = known.count()
    draw = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(5)), F.lit(1 << 30)) / (1 << 30)
    known = known.where(draw < SAMPLE / max(n, 1)).groupBy(key).agg(F.max(label).cast("int").alias("toxic"))
    rows = docs.select(key, F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(known), key)  # SAMPLE rows
    rows = rows.select(F.xxhash64(F.col(key).cast("string"), "text").alias("h"), "toxic", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lo in range(0, len(b), 200):
                p = b.iloc[lo : lo + 200]
                out = []
                for h, y, t in zip(p["h"], p["toxic"], p["text"], strict=True):
                    words, low = terms(t)
                    out.append((h, y, sorted(words | stems(words)), patterns(t, low), signs(t)))
                yield pd.DataFrame(out, columns=["h", "toxic", "terms", "patterns", "signs"])

    return rows.mapInPandas(run, "h bigint, toxic int, terms array<string>, patterns array<int>, signs array<bigint>")


def without_copies(sample: DataFrame) -> DataFrame:
    """Of rows that share a sign the one with the smallest hash; equal rows once."""
    seen = sample.select("h", F.posexplode("signs").alias("nth", "sign"))
    first = seen.groupBy("nth", "sign").agg(F.min("h").alias("first"))
    later = seen.join(first, ["nth", "sign"]).where("h > first").select("h").distinct()
    return sample.join(later, "h", "left_anti").dropDuplicates(["h", "toxic"])


def lexicon(sample: DataFrame, n1: int, n0: int) -> list[str]:
    """Terms that stand out on the toxic side, the surest first."""
    d = sample.select(F.explode("terms").alias("term"), "toxic").groupBy("term").agg(F.sum("toxic").alias("a"), F.count(F.lit(1)).alias("n"))
    a, b = F.col("a") + 0.5, F.col("n") - F.col("a") + 0.5
    odds = F.log(a / (n1 + 1)) - F.log(b / (n0 + 1))
    se = F.sqrt(1 / a + 1 / b)
    d = d.where((F.col("a") >= 3) & (odds >= SURE * se)).withColumn("low", F.round(odds - 1.64 * se, 9)).where(F.col("low") >= ODDS)
    return [r["term"] for r in d.orderBy(F.desc("low"), "term").limit(TERMS).collect()]


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Classifier:
    sample = written(sampled(docs, labels, key, text, label), "toxicity")
    sample = written(without_copies(sample).drop("signs"), "toxicity")
    counts = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = counts.get(1, 0), counts.get(0, 0)
    if not n1 or not n0:
        share = n1 / max(n1 + n0, 1)
        return Classifier({}, [0.0] * len(_PATTERNS), float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))))
    held = lexicon(sample, n1, n0)
    listed = F.array(*[F.lit(t) for t in held]) if held else F.array().cast("array<string>")
    rows = sample.select("h", "toxic", F.array_intersect("terms", listed).alias("terms"), "patterns").collect()
    rows.sort(key=lambda r: (r["h"], r["toxic"], r["terms"]))
    return train(rows, held)


def train(rows: list, held: list[str]) -> Classifier:
    """From the sample's (toxic, terms, patterns) to the classifier, by way of the label model."""
    place = {t: i for i, t in enumerate(held)}
    family = {f: i % LEXICONS for i, f in enumerate(dict.fromkeys(t.lstrip("^")[:4] for t in held))}
    y = np.array([r["toxic"] for r in rows])
    at = np.array([i for i, r in enumerate(rows) for _ in r["terms"]], int)
    term = np.array([place[t] for r in rows for t in r["terms"]], int)
    votes = np.zeros((len(rows), LEXICONS + len(_PATTERNS) + 1))
    votes[at, np.array([family[held[t].lstrip("^")[:4]] for t in term], int)] = 1
    seen = np.array([r["patterns"] for r in rows], float)
    votes[:, LEXICONS:-1], votes[:, -1] = seen, y
    q = LabelModel().fit(votes, np.where(y == 1, 0.95, 0.05)).posterior(votes)

    n, m = len(held), seen.shape[1]
    w, base = np.zeros(n + m), float(np.log((q.mean() + 1e-6) / (1 - q.mean() + 1e-6)))
    g2, base2 = np.full(n + m, 1e-8), 1e-8
    for _ in range(400):  # full gradients, each weight with its own rate
        z = base + np.bincount(at, w[term], len(rows)) + seen @ w[n:]
        e = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - q
        g = np.concatenate([np.bincount(term, e[at], n), seen.T @ e]) / len(rows) + 2e-4 * w
        g2 += g * g
        base2 += e.mean() ** 2
        w -= 0.5 * g / np.sqrt(g2)
        base -= 0.5 * e.mean() / np.sqrt(base2)
    return Classifier({t: float(x) for t, x in zip(held, w, strict=False)}, [float(x) for x in w[n:]], float(base))


def scored(model: Classifier, docs: DataFrame, text: str = "text") -> Column:
    """The score of every row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = sent.value
        for b in batches:
            yield pd.Series([model.score(t) for t in b])

    return score(docs[text])
