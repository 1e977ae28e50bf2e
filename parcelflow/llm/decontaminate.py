"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are runs of ASCII letters, digits and any other character beyond ASCII;
A-Z are lowered.  A seed is a run of ``SEED`` words of a test item that chance
would hardly put into a document: the product of its words' frequencies, which
are counted over all documents, is at most ``RARE``.  An item always keeps its
``LEAST`` rarest seeds, and ``STRETCH_LEAST`` of each stretch of half ``LONG``
words, so that any passage of ``LONG`` words holds some.  How often a seed itself occurs plays no part, so a
passage that thousands of documents share keeps its seeds.  An item all of whose
seeds chance would put into a document (above ``COMMON``) is found only whole,
word for word; one of fewer words than a seed, if so common, not at all.

A document's words are joined to the seeds by their hashes.  Around hits of
one item a window as long as the item and some slack is aligned with it, word
by word (match 2, mismatch and gap -1).  The score is the best local alignment
over that of the item with itself; from ``SCORE`` on the document holds a copy,
exact, edited or paraphrased.  So it does, whatever the item's length, where the
alignment itself scores as much as ``LONG`` copied words and ``SCORE`` of what its
own words could: a passage of a long item, reported with its score (below
``SCORE``).  The best window of each document and item counts.

Items are taken in blocks of at most ``BLOCK_BYTES`` of text, which bounds what
the driver collects and what tasks are sent, whatever the benchmark's size.

Null and empty documents hold no copy; null and empty items match nothing;
items shorter than a seed are matched as one seed.  Repeated rows give
repeated results; equal items are reported under each id.  Empty tables give
an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import PUNCTUATION, arrow_bytes, ngrams, pieces, words_of

SEED, RARE, COMMON, LEAST, SCORE = 3, 1e-9, 1e-3, 8, 0.5
#: words of a passage that is a copy even if most of its item is missing, and the seeds kept of each half as many words
LONG, STRETCH_LEAST = 20, 3
MATCH, MISS, GAP = 2, -1, -1
BLOCK_BYTES = 4 << 20

FOUND = "array<struct<item_id:bigint,score:double,n_seeds:int,first_word:bigint,last_word:bigint>>"


def align(item: np.ndarray, words: np.ndarray) -> tuple[int, int]:
    """Best local alignment score, and the word it ends at."""
    above = np.zeros(len(words) + 1, np.int64)
    slope = -GAP * np.arange(len(words) + 1)
    best, end = 0, 0
    for w in item:
        row = np.maximum(above + GAP, 0)
        row[1:] = np.maximum(row[1:], above[:-1] + np.where(words == w, MATCH, MISS))
        row = np.maximum.accumulate(row + slope) - slope
        at = int(row.argmax())
        if row[at] > best:
            best, end = int(row[at]), at
        above = row
    return best, end


class Items:
    """A block of test items with its seeds, as sent to the tasks."""

    def __init__(self, rows: list[tuple[int, str]], counts: dict[int, int], total: int):
        self.ids, self.words, self.whole = [], [], []
        seeds = defaultdict(list)
        for item, words in rows:
            k = len(self.ids)
            self.ids.append(item)
            self.words.append(words)
            n = min(SEED, len(words))
            freq = np.array([max(counts.get(int(w), 0), 1) / max(total, 1) for w in words.view(np.int64)])
            chance = np.array([freq[i : i + n].prod() for i in range(len(words) - n + 1)])
            common = bool(chance.min() > COMMON)
            self.whole.append(common)
            if common and len(words) < SEED:
                continue
            bound = max(RARE, np.sort(chance)[: LEAST][-1])
            hashes = ngrams(words, n)
            kept = chance <= bound
            for at in range(0, len(chance), LONG // 2):
                inside = chance[at : at + LONG // 2 - n + 1]
                kept[at + np.argsort(inside, kind="stable")[:STRETCH_LEAST]] = True
            for i in np.flatnonzero(kept):
                seeds[n, int(hashes[i])].append((k, int(i)))
        self.lengths = sorted({n for n, _ in seeds})
        self.seeds = {n: np.array(sorted(h for m, h in seeds if m == n), np.uint64) for n in self.lengths}
        self.posts = {n: [seeds[n, int(h)] for h in self.seeds[n]] for n in self.lengths}

    def hits(self, words: np.ndarray, at: np.ndarray) -> dict[int, dict[int, list[tuple[int, int]]]]:
        """text -> item -> (word in the text, word in the item) of every seed met."""
        out: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for n in self.lengths:
            grams, seeds = ngrams(words, n), self.seeds[n]
            to = np.searchsorted(seeds, grams)
            to[to == len(seeds)] = 0
            where = np.flatnonzero(seeds[to] == grams)
            text = np.searchsorted(at, where, side="right") - 1
            for p, d, s in zip(where.tolist(), text.tolist(), to[where].tolist(), strict=True):
                if p + n <= at[d + 1]:
                    for k, i in self.posts[n][s]:
                        out.setdefault(d, {}).setdefault(k, []).append((p - int(at[d]), i))
        return out

    def judge(self, words: np.ndarray, met: dict[int, list[tuple[int, int]]]) -> list[dict]:
        """The items of which one text holds a copy."""
        found = []
        for k, hits in met.items():
            item = self.words[k]
            size, slack = len(item), len(item) // 2 + 2
            windows: list[list[int]] = []
            for p, i in sorted(hits):
                lo, hi = max(0, p - i - slack), min(len(words), p - i + size + slack)
                if windows and lo <= windows[-1][1] and hi - windows[-1][0] <= 4 * size + 4 * slack:
                    windows[-1][1] = max(hi, windows[-1][1])
                    windows[-1][2] += 1
                else:
                    windows.append([lo, hi, 1])
            need = 1 if size <= 2 * SEED else 2
            best = None
            for lo, hi, n in windows:
                if n < need:
                    continue
                score, end = align(item, words[lo:hi])
                if score < MATCH * min(SCORE * size, LONG) or (self.whole[k] and score < MATCH * size) or (best is not None and score <= best[0]):
                    continue
                _, back = align(item[::-1], words[lo : lo + end][::-1])
                if score >= MATCH * SCORE * size or score >= MATCH * max(LONG, SCORE * back):
                    best = score, lo + end, back, n
            if best:
                score, end, back, n = best
                found.append({"item_id": self.ids[k], "score": score / (MATCH * size), "n_seeds": n, "first_word": end - back, "last_word": end - 1})
        return sorted(found, key=lambda f: (-f["score"], f["item_id"]))


def _item_words(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    return words_of(raw, np.array([0, len(raw)]), PUNCTUATION)[0]


def word_counts(docs: DataFrame, vocabulary: np.ndarray, text: str = "text") -> tuple[dict[int, int], int]:
    """How often each of ``vocabulary`` (sorted hashes) occurs in all documents, and the number of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(len(vocabulary), np.int64), 0
        for b in batches:
            raw, offsets = arrow_bytes(b.column("t"))
            for lo, hi in pieces(offsets):
                words, _ = words_of(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], PUNCTUATION)
                total += len(words)
                to = np.searchsorted(vocabulary, words)
                to[to == len(vocabulary)] = 0
                count += np.bincount(to[vocabulary[to] == words], minlength=len(vocabulary))
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(count[some], total))], names=["w", "n"])

    got = docs.select(F.col(text).alias("t")).mapInArrow(run, "w bigint, n bigint").groupBy("w").agg(F.sum("n").alias("n")).collect()
    counts = {int(vocabulary[r["w"]].view(np.int64)): r["n"] for r in got if r["w"] >= 0}
    return counts, sum(r["n"] for r in got if r["w"] < 0)


def _block(docs: DataFrame, rows: list, text: str) -> Items:
    items = [(r["item_id"], _item_words(r["text"] or "")) for r in rows]
    items = [(i, w) for i, w in items if len(w)]
    vocabulary = np.unique(np.concatenate([w for _, w in items])) if items else np.zeros(1, np.uint64)
    counts, total = word_counts(docs, vocabulary, text) if items else ({}, 0)
    return Items(items, counts, total)


def _finder(items):
    """A UDF from texts to the copies found; ``items`` is a broadcast block."""

    @F.pandas_udf(FOUND)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        block = items.value
        for b in batches:
            raw, offsets = arrow_bytes(pa.array(b, pa.string(), from_pandas=True))
            out: list[list[dict]] = [[] for _ in range(len(b))]
            for lo, hi in pieces(offsets):
                words, at = words_of(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], PUNCTUATION)
                for d, met in block.hits(words, at).items():
                    out[lo + d] = block.judge(words[at[d] : at[d + 1]], met)
            yield pd.Series(out)

    return find


def leaks(docs: DataFrame, items: DataFrame, text: str = "text") -> Column:
    """A column for ``docs``: the copies of test items (item_id, text) that a text holds."""
    spark = docs.sparkSession
    items = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = size // BLOCK_BYTES + 1
    found = []
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("text", "item_id"), F.lit(n)) == k).orderBy("item_id", "text").collect()
        found.append(_finder(spark.sparkContext.broadcast(_block(docs, rows, text)))(docs[text]))
    return F.concat(*found)


def contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document and test item it holds: key, item_id, score, n_seeds, first_word, last_word."""
    found = docs.select(F.col(key), F.explode(leaks(docs, items, text)).alias("f"))
    return found.select(key, "f.*")
