"""Near-duplicate documents: fast similarity sketches, banding, exact verification.

A document is its set of distinct 5-word shingles.  Its sketch has ``T``
coordinates, filled in rounds: in round i every shingle is thrown into a
hashed bin with the value (i, hash); the smallest value of a bin stays.  From
round T on, round T + k throws everything into bin k, so every coordinate is
filled after at most 2 T rounds whatever the set's size, and agreement of two
sketches is as concentrated around the Jaccard similarity as T independent
draws.  Long sets fill up in one or two rounds.

1. Documents with equal sets form a class; classes are what is compared.
2. ``BANDS`` bands of ``ROWS`` coordinates each put classes into buckets.
   Buckets with the same members are looked at once.
3. In every bucket (cut into blocks of about ``BLOCK`` classes, each with the
   bucket's first and last class) a spanning forest over the most similar
   sketches is proposed; its links are confirmed on the full sets.
4. Components are formed.  Where a bucket still holds several, those are put
   into one cluster that have members there whose sketches leave a similarity
   of 0.75 possible.  In every cluster the members outside its largest
   component meet all members of other components, block by block, on their
   full sets.  So no pair is skipped but those already connected; only links
   leave the tasks, and a text is sent once per pair of blocks.
5. Components again; the smallest doc_id of each is its name.

A pair at a similarity of 0.75 shares no band with probability (1 - 0.75^5)^32
= 2e-4, and its sketches look unlike with 3e-5.

Null and empty texts have an empty set and are linked with nothing.  A null
doc_id takes part but names no component.  Repeated rows share a class.  An
empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_bytes, mix, ngrams, pieces, release, sequence_hash, words_of, written
from .components import components

WORDS, T, ROWS, BANDS = 5, 160, 5, 32
BLOCK = 1024
#: classes and bytes of text in a block of full sets
SET_BLOCK, SET_BYTES = 256, 8 << 20
#: agreeing coordinates of 160 below which a similarity of 0.75 is off by four standard deviations
PLAUSIBLE = int(T * (0.75 - 4 * (0.75 * 0.25 / T) ** 0.5))
_SEEDS = mix(np.arange(1, 2 * T + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_BAND = mix(np.arange(1, T + 1, dtype=np.uint64)) | np.uint64(1)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of several texts, sorted within each, and the text each belongs to."""
    words, at = words_of(raw, offsets)
    count = np.diff(at)
    grams, text = ngrams(words, n), np.repeat(np.arange(len(count)), count)[: max(0, len(words) - n + 1)]
    inside = np.arange(len(grams)) + n <= at[text + 1] if len(grams) else np.zeros(0, bool)
    h, d = grams[inside], text[inside]
    few = np.flatnonzero((count > 0) & (count < n))
    if len(few):
        h = np.concatenate([h, np.array([sequence_hash(words[at[k] : at[k + 1]]) for k in few], np.uint64)])
        d = np.concatenate([d, few])
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return h[new], d[new]


def sketches(h: np.ndarray, d: np.ndarray, n: int, t: int = T) -> np.ndarray:
    """n x t coordinates of n sets (h: elements, d: the set of each); an empty set's stay empty."""
    out = np.full(n * t, _EMPTY)
    for i in range(2 * t):
        x = mix(h ^ _SEEDS[i])
        to = ((x >> np.uint64(32)) * np.uint64(t)) >> np.uint64(32) if i < t else np.uint64(i - t)
        np.minimum.at(out, d * t + to.astype(np.int64), (np.uint64(i) << np.uint64(54)) | (mix(x) >> np.uint64(10)))
        live = np.unique(d)
        full = np.zeros(n, bool)
        full[live] = (out.reshape(n, t)[live] != _EMPTY).all(1)
        more = ~full[d]
        if not more.any():
            break
        h, d = h[more], d[more]
    return out.reshape(n, t)


_SKETCH = pa.schema([("row_key", pa.int64()), ("text_key", pa.int64()), ("doc_id", pa.int64()), ("cls", pa.int64()), ("n_shingles", pa.int64()), ("bands", pa.list_(pa.int64())), ("sketch", pa.binary())])


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        raw, offsets = arrow_bytes(b.column("text"))
        for lo, hi in pieces(offsets):
            n = hi - lo
            h, d = shingle_sets(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            size = np.bincount(d, minlength=n)
            total = np.zeros(n, np.uint64)
            np.add.at(total, d, mix(h ^ _SEEDS[0]))
            cls = mix(total ^ size.astype(np.uint64)).view(np.int64)
            s = sketches(h, d, n)
            keys = mix((s * _BAND).reshape(n, BANDS, ROWS).sum(2, dtype=np.uint64) + _BAND[:BANDS]).view(np.int64)
            some = size > 0
            yield pa.RecordBatch.from_arrays([
                *(b.column(c).slice(lo, n) for c in ("row_key", "text_key", "doc_id")),
                pa.array(cls, mask=~some), pa.array(size),
                pa.array([k if x else [] for k, x in zip(keys, some, strict=True)], pa.list_(pa.int64())),
                pa.array([r.tobytes() if x else None for r, x in zip(s.astype(np.uint8), some, strict=True)], pa.binary()),
            ], schema=_SKETCH)
    release()


def _groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Groups of rows that stand together by ``keys``, across batches."""
    rest = None
    for b in batches:
        b = b if rest is None else pd.concat([rest, b], ignore_index=True)
        k = b[keys].to_numpy()
        cuts = np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1
        for lo, hi in zip(np.concatenate([[0], cuts[:-1]]) if len(cuts) else [], cuts, strict=True):
            yield b.iloc[lo:hi]
        rest = b.iloc[cuts[-1] :] if len(cuts) else b
    if rest is not None and len(rest):
        yield rest


def _matrix(col: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(col), np.uint8).reshape(len(col), T)


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Spanning forest of every block over its most similar sketches."""
    out: list[tuple[int, int]] = []
    for g in _groups(batches, ["bucket", "block"]):
        g = g.drop_duplicates("cls") if len(g) > 2 else g
        cls, n = g["cls"].to_numpy(), len(g)
        if n > 1:
            s = _matrix(g["sketch"])
            best, link, open_ = np.full(n, -1), np.zeros(n, np.int64), np.ones(n, bool)
            at = 0
            for _ in range(n - 1):
                open_[at] = False
                like = (s == s[at]).sum(1)
                closer = open_ & (like > best)
                best[closer], link[closer] = like[closer], at
                at = int(np.argmax(np.where(open_, best, -2)))
                if best[at] >= PLAUSIBLE:
                    out.append((int(min(cls[at], cls[link[at]])), int(max(cls[at], cls[link[at]]))))
        if len(out) >= 20_000:
            yield pd.DataFrame(out, columns=["a", "b"])
            out = []
    if out:
        yield pd.DataFrame(out, columns=["a", "b"])


def _across(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs of components with plausible pairs between the rest (rows with ``rest``) and all others."""
    for g in _groups(batches, ["bucket", "i", "j"]):
        s, label, rest = _matrix(g["sketch"]), g["label"].to_numpy(), g["rest"].to_numpy()
        every = np.flatnonzero(~rest)
        pairs: set[tuple[int, int]] = set()
        for k in np.flatnonzero(rest):
            like = (s[every] == s[k]).sum(1)
            for other in np.unique(label[every[(like >= PLAUSIBLE) & (label[every] != label[k])]]):
                pairs.add((int(min(other, label[k])), int(max(other, label[k]))))
        if pairs:
            yield pd.DataFrame(sorted(pairs), columns=["a", "b"])


def _exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links between the rest and all others of another component, on full sets."""
    for g in _groups(batches, ["cluster", "i", "j"]):
        label, cls, rest = g["label"].to_numpy(), g["cls"].to_numpy(), g["rest"].to_numpy()
        raw, offsets = arrow_bytes(pa.array(g["text"], pa.string()))
        sets = [shingle_sets(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]) for lo, hi in pieces(offsets)]
        first = [lo for lo, _ in pieces(offsets)]
        h = np.concatenate([x for x, _ in sets])
        d = np.concatenate([x + lo for (_, x), lo in zip(sets, first, strict=True)])
        size = np.bincount(d, minlength=len(g))
        _, code = np.unique(h, return_inverse=True)
        begin = np.concatenate([[0], np.cumsum(size)])
        mask = np.zeros(len(code) + 1, bool)
        for k in np.flatnonzero(rest):
            own = code[begin[k] : begin[k + 1]]
            mask[own] = True
            both = np.bincount(d[mask[code]], minlength=len(g))
            mask[own] = False
            hit = np.flatnonzero(~rest & (label != label[k]) & (100 * both >= 75 * (size + size[k] - both)))
            if len(hit):
                yield pd.DataFrame({"a": np.minimum(cls[hit], cls[k]), "b": np.maximum(cls[hit], cls[k])})


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose full sets have 100 |A and B| >= 75 |A or B|."""
    for b in batches:
        sides = []
        for name in ("ta", "tb"):
            raw, offsets = arrow_bytes(b.column(name))
            sides.append((raw, offsets))
        ok = np.zeros(b.num_rows, bool)
        (ra, oa), (rb, ob) = sides
        for lo, hi in pieces(oa + ob):
            n = hi - lo
            ha, da = shingle_sets(ra[oa[lo] : oa[hi]], oa[lo : hi + 1] - oa[lo])
            hb, db = shingle_sets(rb[ob[lo] : ob[hi]], ob[lo : hi + 1] - ob[lo])
            h, d = np.concatenate([ha, hb]), np.concatenate([da, db])
            order = np.lexsort((h, d))
            h, d = h[order], d[order]
            both = np.bincount(d[1:][(h[1:] == h[:-1]) & (d[1:] == d[:-1])], minlength=n)
            either = np.bincount(d, minlength=n) - both
            ok[lo:hi] = (either > 0) & (100 * both >= 75 * either)
        yield pa.RecordBatch.from_arrays([b.column("a").filter(pa.array(ok)), b.column("b").filter(pa.array(ok))], names=["a", "b"])


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs of classes that are links; ``texts`` has one text a class."""
    a = texts.select(F.col("cls").alias("a"), F.col("text").alias("ta"))
    b = texts.select(F.col("cls").alias("b"), F.col("text").alias("tb"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "ta", "tb").mapInArrow(_confirm, "a bigint, b bigint")


def _blocked(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.repartition(*keys).sortWithinPartitions(*keys)


def _between(hints: DataFrame, named: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between components that ``hints`` puts into one cluster."""
    cluster = components(hints).select(F.col("node").alias("label"), F.col("label").alias("cluster"))
    of = named.select("cls", "label").distinct().join(cluster, "label").join(texts, "cls")
    of = written(of.select("cluster", "label", "cls", "text"), "clusters")
    per_label = of.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    per = per_label.groupBy("cluster").agg(F.sum("n").alias("m"), F.sum("bytes").alias("bytes"), F.max(F.struct("n", "label", "bytes")).alias("top"))
    blocks = lambda n, size: F.greatest(F.ceil(n / SET_BLOCK), F.ceil(size / SET_BYTES)).cast("int")
    n_j = blocks(F.col("m"), F.col("bytes"))
    n_i = blocks(F.col("m") - F.col("top.n"), F.col("bytes") - F.col("top.bytes"))
    of = of.join(per.select("cluster", F.col("top.label").alias("top"), n_i.alias("n_i"), n_j.alias("n_j")), "cluster")
    mine = F.xxhash64("cls", F.lit(2))
    rest = of.where("label <> top").select("cluster", F.pmod(mine, "n_i").cast("int").alias("i"), F.explode(F.expr("sequence(0, n_j - 1)")).alias("j"), F.lit(True).alias("rest"), "cls", "label", "text")
    every = of.select("cluster", F.explode(F.expr("sequence(0, n_i - 1)")).alias("i"), F.pmod(mine, "n_j").cast("int").alias("j"), F.lit(False).alias("rest"), "cls", "label", "text")
    return _blocked(rest.union(every), ["cluster", "i", "j"]).mapInPandas(_exact, "a bigint, b bigint").distinct()


def keyed(docs: DataFrame, key: str = "doc_id", text: str = "text", row_key: str = "row_key", text_key: str = "text_key") -> DataFrame:
    """``docs`` with row_key (the id, or a hash of the text without one) and text_key; equal pairs: equal rows."""
    of_text = F.xxhash64(F.col(text).cast("string"))
    return docs.withColumns({row_key: F.coalesce(F.col(key).cast("bigint"), of_text), text_key: of_text})


def grouped(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Every row (doc_id, row_key, text_key, cls, n_shingles), and every class (cls, component_id, keeper).

    The keeper is the row that stands for its component: the smallest id, rows
    without one last.
    """
    rows = keyed(docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")))
    drawn = rows.mapInArrow(_sketch, "row_key bigint, text_key bigint, doc_id bigint, cls bigint, n_shingles bigint, bands array<bigint>, sketch binary")
    drawn = written(drawn, "sketches")

    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "row_key", "text_key"))
    classes = drawn.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("first_doc"), first.alias("keeper"), F.any_value("bands").alias("bands"), F.any_value("sketch").alias("sketch"))
    classes = written(classes, "classes")
    banded = classes.select(F.explode("bands").alias("bucket"), "cls")
    buckets = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("m"), F.expr("bit_xor(xxhash64(cls))").alias("who"), F.min("cls").alias("low"), F.max("cls").alias("high")).where("low < high")
    buckets = buckets.groupBy("m", "who", "low", "high").agg(F.min("bucket").alias("bucket"))
    members = banded.join(buckets, "bucket").select("bucket", "cls", "m", "low", "high")
    members = written(members, "members")

    close = members.select("cls").distinct()
    drawings = written(classes.join(close, "cls", "left_semi").select("cls", "keeper", "sketch"), "close")
    own = drawings.select("cls", "keeper.row_key", "keeper.text_key")
    texts = rows.join(own, ["row_key", "text_key"]).select("cls", "text").mapInArrow(_once, "cls bigint, text string")
    texts = written(texts, "texts")

    n_blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    placed = members.select("bucket", F.explode(F.when((n_blocks > 1) & F.col("cls").isin(F.col("low"), F.col("high")), F.sequence(F.lit(0), n_blocks - 1)).otherwise(F.array(F.pmod(F.xxhash64("cls"), n_blocks).cast("int")))).alias("block"), "cls")
    placed = placed.join(drawings.select("cls", "sketch"), "cls")
    proposed = _blocked(placed, ["bucket", "block"]).mapInPandas(_forest, "a bigint, b bigint").distinct()
    proposed = written(proposed, "proposed")
    links = written(confirmed(proposed, texts), "links")
    label = components(links)

    named = members.select("bucket", "cls").join(label.withColumnRenamed("node", "cls"), "cls", "left").select("bucket", "cls", F.coalesce("label", "cls").alias("label"))
    named = written(named, "named")
    of_label = named.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
    mixed = of_label.groupBy("bucket").agg(F.count(F.lit(1)).alias("labels"), F.sum("n").alias("m"), F.max(F.struct("n", "label")).alias("top")).where("labels > 1")
    mixed = mixed.select("bucket", "m", F.col("top.label").alias("top"), (F.col("m") - F.col("top.n")).alias("n_rest"))
    open_ = named.join(mixed, "bucket").join(drawings.select("cls", "sketch"), "cls")
    n_i, n_j = F.ceil(F.col("n_rest") / BLOCK).cast("int"), F.ceil(F.col("m") / BLOCK).cast("int")
    mine = F.xxhash64("cls", F.lit(1))
    rest = open_.where("label <> top").select("bucket", F.pmod(mine, n_i).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), n_j - 1)).alias("j"), F.lit(True).alias("rest"), "cls", "label", "sketch")
    every = open_.select("bucket", F.explode(F.sequence(F.lit(0), n_i - 1)).alias("i"), F.pmod(mine, n_j).cast("int").alias("j"), F.lit(False).alias("rest"), "cls", "label", "sketch")
    hints = _blocked(rest.union(every), ["bucket", "i", "j"]).mapInPandas(_across, "a bigint, b bigint").distinct()
    hints = written(hints, "hints")
    links = links.union(written(_between(hints, named, texts), "links"))
    label = components(links)

    own = classes.select("cls", "first_doc", "keeper").join(label.withColumnRenamed("node", "cls"), "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    name = own.groupBy("label").agg(F.min("first_doc").alias("component_id"), F.min("keeper").alias("keeper"))
    return drawn.drop("bands", "sketch"), own.select("cls", "label").join(name, "label").drop("label")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``."""
    rows, classes = grouped(docs, key, text)
    out = rows.select("doc_id", "cls", "n_shingles").join(classes.drop("keeper"), "cls", "left")
    component = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def first_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of every component of ``docs``, all columns; rows without any word stay."""
    _, classes = grouped(docs, key, text)
    row_key, text_key, nth = "__near_dup_row", "__near_dup_text", "__near_dup_nth"
    keepers = classes.select(F.col("keeper.row_key").alias(row_key), F.col("keeper.text_key").alias(text_key)).distinct()
    some = F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    kept = keyed(docs.where(some), key, text, row_key, text_key).join(keepers, [row_key, text_key])
    first = F.row_number().over(Window.partitionBy(row_key, text_key).orderBy(row_key))
    kept = kept.withColumn(nth, first).where(F.col(nth) == 1).select(*docs.columns)
    return kept.unionByName(docs.where(~some))


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A class's text once a task, where its row is repeated."""
    seen: set[int] = set()
    for b in batches:
        new = []
        for c in b.column("cls").to_pylist():
            new.append(c not in seen)
            seen.add(c)
        yield b.filter(pa.array(new, pa.bool_()))
