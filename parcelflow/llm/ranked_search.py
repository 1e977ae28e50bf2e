"""Ranked lexical search over classes of documents that look the same to the items.

Terms are the runs of ASCII letters, digits and characters beyond ASCII, A-Z
lowered.  N counts the documents with a term, L their terms, n one document's.
A term held by df documents weighs w = floor(1000 ln((2N + 2) / (2 df + 1))),
a document has m = 75 + 25 n N div L, and its score for an item is the sum over
the item's terms, repeats included, of w (1000000000 tf div (1000 tf + 12 m)).
All but the logarithm is done in 64-bit integers.

1. Items are taken in blocks of ``BLOCK_BYTES`` of text, which bounds the
   vocabulary that tasks are sent.  A document's bag is its count of each term
   of that vocabulary; other terms only count in n.
2. Bag deduplication: documents with equal bag and m are one class, formed by
   a hash of both and verified by grouping on both themselves.  A class keeps
   its number of members (which gives df) and its first one.
3. Every class is scored once, by task: items times classes, term by term.  A
   task keeps each item's ``top`` best classes by (score, first member), and
   so does the merge; a document among the best ``top`` is always in one of
   these classes.
4. Only those classes are expanded: each one's ``top`` smallest ids, ranked by
   (score, id).

Terms are compared by 64-bit hashes; two terms of a block with one hash raise.
Null and empty texts and items have no term and are never returned.  Rows
without an id come last among equal scores; repeated rows are ranked each;
rows of items that repeat an id and a text count once, other items of one id are one item with the
terms of all.  Items without an id take no part.  Empty tables give an empty
result; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import PUNCTUATION, arrow_bytes, pieces, words_of, written

TOP = 20
BLOCK_BYTES = 4 << 20
#: items and classes that are scored together
ITEMS, CLASSES = 512, 2048
_LAST = np.iinfo(np.int64).max


class Block:
    """A block of items: its vocabulary and, by term, the items that hold it and how often."""

    def __init__(self, items: list[tuple[int, str]]):
        counts: dict[int, Counter] = {}
        for i, text in items:
            raw = np.frombuffer(text.encode(), np.uint8)
            counts.setdefault(i, Counter()).update(words_of(raw, np.array([0, len(raw)]), PUNCTUATION)[0].tolist())
        self.ids = np.array(sorted(counts), np.int64)
        self.terms = np.unique(np.array([t for c in counts.values() for t in c], np.uint64))
        self._check(items)
        place = {t: p for p, t in enumerate(self.terms.tolist())}
        entries = sorted((place[t], p, q) for p, i in enumerate(self.ids.tolist()) for t, q in counts[i].items())
        self.entries = np.array(entries, np.int64).reshape(-1, 3)
        self.begin = np.searchsorted(self.entries[:, 0], np.arange(len(self.terms) + 1))

    def _check(self, items: list[tuple[int, str]]) -> None:
        spelt = {w for _, text in items for w in text.encode().lower().translate(_SPACED).split()}
        if len(spelt) != len(self.terms):
            raise ValueError("two terms of the items share a hash")

    def bags(self, words: np.ndarray, at: np.ndarray) -> list[bytes]:
        """Each text's bag: places of the terms it holds, ascending, and their counts, as packed int32."""
        n, v = len(at) - 1, len(self.terms)
        to = np.searchsorted(self.terms, words)
        to[to == v] = 0
        known = np.flatnonzero(self.terms[to] == words) if v else np.zeros(0, np.int64)
        text = np.searchsorted(at, known, side="right") - 1
        cell, tf = np.unique(text * max(v, 1) + to[known], return_counts=True)
        cuts = np.searchsorted(cell, np.arange(n + 1) * max(v, 1))
        place, tf = (cell % max(v, 1)).astype("<i4"), tf.astype("<i4")
        return [np.concatenate([place[a:b], tf[a:b]]).tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


#: lower-cased bytes with those between terms as spaces
_SPACED = bytes(32 if PUNCTUATION[b] else b for b in range(256))


def _bags(docs: DataFrame, block, key: str, text: str) -> DataFrame:
    """id, n and bag of every document with a term; ``block`` is a broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, offsets = arrow_bytes(b.column("t"))
            for lo, hi in pieces(offsets):
                words, at = words_of(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], PUNCTUATION)
                got = block.value.bags(words, at)
                yield pa.RecordBatch.from_arrays([b.column("id").slice(lo, hi - lo), pa.array(np.diff(at)), pa.array(got, pa.binary())], names=["id", "n", "bag"])

    d = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).cast("string").alias("t"))
    return d.mapInArrow(run, "id bigint, n bigint, bag binary").where("n > 0")


def _unpacked(bags: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, counts and the row of each entry."""
    raw, offsets = arrow_bytes(bags)
    each = (np.diff(offsets) // 8).astype(np.int64)
    flat = np.frombuffer(raw.tobytes(), "<i4")
    row = np.repeat(np.arange(len(each)), each)
    within = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
    first = (offsets[:-1] // 4)[row] + within
    return flat[first], flat[first + each[row]], row


def _document_counts(classes: DataFrame, n_terms: int) -> np.ndarray:
    """How many documents hold each term of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for b in batches:
            place, _, row = _unpacked(b.column("bag"))
            np.add.at(total, place, b.column("members").to_numpy()[row])
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "df"])

    got = classes.select("bag", "members").mapInArrow(run, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df")).collect()
    out = np.zeros(n_terms, np.int64)
    for r in got:
        out[r["term"]] = r["df"]
    return out


class _Best:
    """The ``top`` best classes of each item so far: by score, then by first member."""

    def __init__(self, n_items: int, top: int):
        self.top = top
        self.kept = [(np.zeros(0, np.int64),) * 3 for _ in range(n_items)]

    def add(self, item: int, score: np.ndarray, first: np.ndarray, name: np.ndarray) -> None:
        s, f, c = (np.concatenate(x) for x in zip(self.kept[item], (score, first, name), strict=True))
        order = np.lexsort((c, f, -s))[: self.top]
        self.kept[item] = s[order], f[order], c[order]

    def least(self, item: int) -> int:
        s = self.kept[item][0]
        return int(s[-1]) if len(s) == self.top else 1


def _best_classes(classes: DataFrame, block, weight: np.ndarray, top: int) -> DataFrame:
    """For each task and item the best classes: item, score, first, cls."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Block = block.value
        best = _Best(len(items.ids), top)
        for b in batches:
            for lo in range(0, b.num_rows, CLASSES):
                part = b.slice(lo, CLASSES)
                place, tf, row = _unpacked(part.column("bag"))
                tf, m = tf.astype(np.int64), part.column("m").to_numpy()[row]
                share = (1_000_000_000 * tf) // (1000 * tf + 12 * m)
                order = np.argsort(place, kind="stable")
                place, share, row = place[order], share[order], row[order]
                terms, cut = np.unique(place, return_index=True)
                cut = np.append(cut, len(place))
                first, name = part.column("first").to_numpy(), part.column("cls").to_numpy()
                for at in range(0, len(items.ids), ITEMS):
                    score = np.zeros((min(ITEMS, len(items.ids) - at), part.num_rows), np.int64)
                    for k, t in enumerate(terms):
                        if not weight[t]:
                            continue
                        held = items.entries[items.begin[t] : items.begin[t + 1], 1:]
                        held = held[np.searchsorted(held[:, 0], at) : np.searchsorted(held[:, 0], at + ITEMS)]
                        if len(held):
                            score[np.ix_(held[:, 0] - at, row[cut[k] : cut[k + 1]])] += np.outer(held[:, 1] * weight[t], share[cut[k] : cut[k + 1]])
                    for i in range(len(score)):
                        hit = np.flatnonzero(score[i] >= best.least(at + i))
                        if len(hit):
                            best.add(at + i, score[i][hit], first[hit], name[hit])
        for lo in range(0, len(items.ids), ITEMS):
            kept = best.kept[lo : lo + ITEMS]
            sizes = [len(s) for s, _, _ in kept]
            cols = [np.concatenate([k[c] for k in kept]) for c in range(3)]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(items.ids[lo : lo + ITEMS], sizes)), *map(pa.array, cols)], names=["item_id", "score", "first", "cls"])

    return classes.select("cls", "m", "first", "bag").mapInArrow(run, "item_id bigint, score bigint, first bigint, cls bigint")


def _ranked(docs: DataFrame, items: list[tuple[int, str]], key: str, text: str, top: int) -> DataFrame:
    spark = docs.sparkSession
    block = Block(items)
    sent = spark.sparkContext.broadcast(block)
    bags = written(_bags(docs, sent, key, text), "bags")
    n_docs, n_terms = bags.agg(F.count(F.lit(1)), F.sum("n")).first()
    n_terms = n_terms or 1
    m = F.lit(100 - 25) + F.expr(f"(25 * n * {n_docs}L) div {n_terms}L")
    # rows without an id stand last
    keyed = bags.select(F.coalesce("id", F.lit(_LAST)).alias("first"), F.col("id").isNull().alias("no_id"), "id", m.alias("m"), "bag").withColumn("h", F.xxhash64("m", "bag"))
    # verified: the groups are by bag and m themselves; classes with one hash have different first members or m
    classes = keyed.where(F.octet_length("bag") > 0).groupBy("h", "m", "bag").agg(F.count(F.lit(1)).alias("members"), F.min("first").alias("first"))
    classes = written(classes.withColumnRenamed("h", "cls"), "classes")
    df = _document_counts(classes, len(block.terms))
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    best = _best_classes(classes, sent, weight, top)
    by = [F.desc("score"), F.col("first"), F.col("cls")]
    best = best.withColumn("at", F.row_number().over(Window.partitionBy("item_id").orderBy(*by))).where(F.col("at") <= top).drop("at")
    best = written(best, "best")
    wanted = classes.join(best.select("cls", "first").distinct(), ["cls", "first"], "left_semi").select(F.col("cls").alias("h"), "m", "bag", F.col("first").alias("of"))
    members = keyed.join(wanted, ["h", "m", "bag"]).select(F.col("h").alias("cls"), F.col("of").alias("first"), "id", "no_id")
    smallest = Window.partitionBy("cls", "first").orderBy("no_id", "id")
    members = members.withColumn("at", F.row_number().over(smallest)).where(F.col("at") <= top).drop("at")
    near = best.join(members, ["cls", "first"])
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), "no_id", "id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= top).select("item_id", "rank", F.col("id").alias("doc_id"), "score")


def search(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id and score of the ``top`` best documents of every item (item_id, text)."""
    spark = docs.sparkSession
    items = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null and text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = size // BLOCK_BYTES + 1
    found = []
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k).orderBy("item_id", "text").collect()
        if rows:
            found.append(written(_ranked(docs, [(r["item_id"], r["text"]) for r in rows], key, text, top), "ranked"))
    out = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    for f in found:
        out = out.unionByName(f)
    return out
