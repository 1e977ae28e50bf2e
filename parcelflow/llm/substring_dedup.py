"""Words of windows that an earlier document holds too, found by super-k-mers.

A window is ``WINDOW`` consecutive words (runs of other bytes than 0x20 and
0x09-0x0D, unchanged) of one document.  A word goes if some window over it has
a word sequence that also starts in a document with a smaller id.

1. Each window's minimiser is the least hash of its runs of ``GRAM`` words.
   Consecutive windows with one minimiser travel as one packed string, a
   super-k-mer: their words joined by a space (at most ``LONGEST`` windows).
   Before they are shuffled a task joins equal strings of a run of texts: the
   least and the largest id, and where the string occurs.  Strings of one bucket
   travel together, compressed.
2. A bucket is a share of the minimisers' values, so equal windows meet there.
   Its windows are sorted by their hashes; windows with equal hashes are
   compared byte by byte; the least id of each distinct window is exact.  The
   places of windows with a smaller id than their document's are returned.
3. Documents' places are gathered, and the texts (packed and compressed too, equal
   rows once) meet them; the words that the windows cover are removed.

Hot minimisers, as a line that a third of the documents hold in various
surroundings, are counted first (all that occur ``SEEN`` times in a piece of
text); the ``HOT`` most frequent of them that would fill more than a quarter of a
bucket have their windows sent one by one, dealt by the window's own hash.  That
changes where windows meet, never the result.  Hot strings, of a passage that very
many documents hold (``OFTEN`` times, counted alike), do not bring their places:
their documents are cut again and joined to the strings' least ids by the
string's hash, a join that Spark can split.

Null and empty texts have no words: n_words and n_removed 0, the hash of the
empty text.  A row without an id counts as larger than every id.  Rows with
equal id keep what they share.  An empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _ODD, _PLACE, arrow_bytes, mix, ngrams, pieces, release, written

WINDOW, GRAM, LONGEST = 13, 3, 64
#: bytes of strings a task joins before it sends them, bytes of a bucket, and of texts that are sent at once
RUN, BUCKET, TEXTS = 40 << 20, 12 << 20, 16 << 20
HOT, SEEN, OFTEN = 100_000, 8, 1 << 16
_LAST = np.iinfo(np.int64).max
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: words are hashed in stretches of this many bytes; a longer word by itself
_STRETCH = 1 << 16
_VALUE = np.random.default_rng(13).integers(1, 1 << 63, 256, dtype=np.uint64)
_UP = np.cumprod(np.concatenate([[1], np.full(2 * _STRETCH, int(_ODD), object)]).astype(np.uint64))
_DOWN = np.cumprod(np.concatenate([[1], np.full(2 * _STRETCH, pow(int(_ODD), -1, 1 << 64), object)]).astype(np.uint64))


def spelled(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, byte past the last, of the words of several texts, and each text's word offsets."""
    word = ~_SPACE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    begin = np.flatnonzero(word & (edge[:-1] | ~np.concatenate([[False], word[:-1]])))
    end = np.flatnonzero(word & (edge[1:] | ~np.concatenate([word[1:], [False]]))) + 1
    return begin, end, np.searchsorted(begin, offsets)


def word_hashes(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    out = np.empty(len(begin), np.uint64)
    lo = 0
    while lo < len(begin):
        hi = int(np.searchsorted(end, begin[lo] + _STRETCH, side="right"))
        if hi == lo:
            out[lo] = xxhash.xxh64_intdigest(raw[begin[lo] : end[lo]].tobytes())
            lo += 1
            continue
        part = raw[begin[lo] : end[hi - 1]]
        total = np.concatenate([[np.uint64(0)], np.cumsum(_VALUE[part] * _UP[: len(part)], dtype=np.uint64)])
        a, b = begin[lo:hi] - begin[lo], end[lo:hi] - begin[lo]
        out[lo:hi] = mix((total[b] - total[a]) * _DOWN[a] + (b - a).astype(np.uint64) * _ODD)
        lo = hi
    return out


def _sliding_least(x: np.ndarray, n: int) -> np.ndarray:
    """The least of every n consecutive values."""
    size = 1
    while size * 2 <= n:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (n - size)], x[n - size :]) if n > size else x


class Strings:
    """The super-k-mers of several texts: ``hot`` minimisers, sorted, give one a window."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, hot: np.ndarray):
        self.raw = raw
        self.begin, self.end, self.at = spelled(raw, offsets)
        words = word_hashes(raw, self.begin, self.end)
        none = np.zeros(0, np.int64)
        self.first, self.text, self.length, self.bucket, self.name = none, none, none, none.astype(np.uint64), none
        if len(words) < WINDOW:
            return
        window, low = ngrams(words, WINDOW), _sliding_least(ngrams(words, GRAM), WINDOW - GRAM + 1)
        text = np.searchsorted(self.at, np.arange(len(window)), side="right") - 1
        inside = np.arange(len(window)) + WINDOW <= self.at[text + 1]
        where = np.flatnonzero(inside)
        if not len(where):
            return
        window, low, text = window[where], low[where], text[where]
        single = np.zeros(len(low), bool)
        if len(hot):
            to = np.searchsorted(hot, low)
            to[to == len(hot)] = 0
            single = hot[to] == low
        new = np.ones(len(low), bool)
        new[1:] = (low[1:] != low[:-1]) | (text[1:] != text[:-1]) | single[1:] | single[:-1]
        run = np.flatnonzero(new)
        place = np.arange(len(low)) - np.repeat(run, np.diff(np.append(run, len(low))))
        start = np.flatnonzero(place % LONGEST == 0)
        self.length = np.diff(np.append(start, len(low)))
        self.first, self.text = where[start], text[start]
        self.bucket = np.where(single[start], mix(window[start]), low[start])
        self.minimiser = low[start]
        parts = window * _PLACE[place % LONGEST]
        self.name = mix(np.add.reduceat(parts, start) + self.length.astype(np.uint64)).view(np.int64)

    def packed(self) -> list[bytes]:
        """Each string's words joined by a space."""
        size = self.end - self.begin
        to = np.cumsum(size + 1) - (size + 1)
        out = np.zeros(int(to[-1] + size[-1]) + 1, np.uint8)
        space = np.zeros(len(out), bool)
        space[to + size] = True
        out[space], out[~space] = 32, self.raw[~_SPACE[self.raw]]
        flat = out.tobytes()
        last = self.first + self.length + WINDOW - 2
        return [flat[a:b] for a, b in zip(to[self.first].tolist(), (to[last] + size[last]).tolist(), strict=True)]


def _texts(batches: Iterator[pa.RecordBatch], hot: np.ndarray) -> Iterator[tuple[Strings, pa.RecordBatch]]:
    for b in batches:
        raw, offsets = arrow_bytes(b.column("text"))
        for lo, hi in pieces(offsets):
            yield Strings(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], hot), b.slice(lo, hi - lo)


class Hot:
    """Hot minimisers and names of hot strings, both sorted, and about how many bytes of strings there are."""

    def __init__(self, minimisers: list[int], names: list[int], size: int):
        self.minimisers = np.sort(np.array(minimisers, np.int64).view(np.uint64))
        self.names = np.sort(np.array(names, np.int64))
        self.size = size

    def has(self, names: np.ndarray) -> np.ndarray:
        if not len(self.names):
            return np.zeros(len(names), bool)
        at = np.searchsorted(self.names, names)
        at[at == len(self.names)] = 0
        return self.names[at] == names


def find_hot(docs: DataFrame) -> Hot:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s, _ in _texts(batches, np.zeros(0, np.uint64)):
            if not len(s.first):
                continue
            last = s.first + s.length + WINDOW - 2
            size = s.end[last] - s.begin[s.first]
            low, of, n = np.unique(s.minimiser, return_inverse=True, return_counts=True)
            name, times = np.unique(s.name, return_counts=True)
            some, often = n >= SEEN, times >= SEEN
            kind = np.repeat([0, 1, 2], [1, some.sum(), often.sum()])
            what = np.concatenate([[0], low[some].view(np.int64), name[often]])
            weight = np.concatenate([[size.sum()], np.bincount(of, size)[some], times[often]]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(kind.astype(np.int64)), pa.array(what), pa.array(weight)], names=["kind", "what", "weight"])

    got = docs.select("text").mapInArrow(run, "kind bigint, what bigint, weight bigint").groupBy("kind", "what").agg(F.sum("weight").alias("weight"))
    least = F.when(F.col("kind") == 1, BUCKET // 4).when(F.col("kind") == 2, OFTEN).otherwise(0)
    got = written(got.where(F.col("weight") > least), "hot")
    top = lambda kind: [r["what"] for r in got.where(F.col("kind") == kind).orderBy(F.desc("weight"), "what").limit(HOT).collect()]
    size = got.where("kind = 0").agg(F.sum("weight")).first()[0] or 0
    return Hot(top(1), top(2), size)


def _packed(*columns: np.ndarray, body: bytes = b"") -> bytes:
    """Integer columns of various lengths and what follows them, compressed."""
    parts = [struct.pack("<q", len(columns))]
    for c in columns:
        c = c.astype("<i8")
        # by byte planes: the high bytes of small numbers are runs of zeros
        parts += [struct.pack("<q", len(c)), c.view(np.uint8).reshape(-1, 8).T.tobytes()]
    return zstandard.ZstdCompressor(level=3).compress(b"".join([*parts, body]))


def _unpacked(data: bytes) -> tuple[list[np.ndarray], bytes]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    at, columns = 8, []
    for _ in range(struct.unpack_from("<q", raw)[0]):
        n = struct.unpack_from("<q", raw, at)[0]
        at += 8
        columns.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, 8 * n, at).reshape(8, n).T).view("<i8").reshape(n))
        at += 8 * n
    return columns, raw[at:]


def _steps(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=0)


def _runs(key: np.ndarray) -> Iterator[tuple[int, int]]:
    """Begin and end of every run of equal values."""
    cuts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]])) if len(key) else np.zeros(1, int)
    yield from zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)


def _pairs(doc: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs, sorted, and the place of each row's pair."""
    order = np.lexsort((key, doc))
    d, k = doc[order], key[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (k[1:] != k[:-1])
    to = np.empty(len(d), np.int64)
    to[order] = np.cumsum(new) - 1
    return d[new], k[new], to


def sent(docs: DataFrame, hot: Hot, buckets: int) -> DataFrame:
    """p (the bucket) and its strings, joined and compressed, of each run of a task's texts.

    Columns of a packet: the strings' sizes, least and largest ids; rows of
    their documents (id, text_key); places as (string, document, first window).
    """

    def flush(strings: list[pa.Array], cols: list[tuple]) -> Iterator[pa.RecordBatch]:
        p, doc, key, first, name = (np.concatenate(c) for c in zip(*cols, strict=True))
        coded = pa.concat_arrays(strings).dictionary_encode()
        strings.clear()
        code, distinct = coded.indices.to_numpy(), coded.dictionary
        brings = ~hot.has(name)
        order = np.argsort(p, kind="stable")
        keys, packets = [], []
        for a, b in _runs(p[order]):
            rows = order[a:b]
            own, of = np.unique(code[rows], return_inverse=True)
            lo, hi = np.full(len(own), _LAST), np.full(len(own), -_LAST - 1)
            np.minimum.at(lo, of, doc[rows])
            np.maximum.at(hi, of, doc[rows])
            body, ends = arrow_bytes(distinct.take(pa.array(own)))
            rows, of = rows[brings[rows]], of[brings[rows]]
            docs_, keys_, to = _pairs(doc[rows], key[rows])
            at = np.lexsort((first[rows], to, of))
            of, to, places = of[at], to[at], first[rows][at]
            new = np.ones(len(of), bool)  # equal rows bring a place once
            new[1:] = (of[1:] != of[:-1]) | (to[1:] != to[:-1]) | (places[1:] != places[:-1])
            keys.append(int(p[order[a]]))
            packets.append(_packed(np.diff(ends), _steps(lo), hi - lo, _steps(docs_), keys_, _steps(of[new]), _steps(to[new]), places[new], body=body.tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(packets, pa.binary())], names=["p", "packet"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings, cols, size = [], [], 0
        for s, b in _texts(batches, hot.minimisers):
            if not len(s.first):
                continue
            strings.append(pa.array(s.packed(), pa.large_binary()))
            to = (s.bucket % np.uint64(buckets)).astype(np.int64)
            cols.append((to, b.column("doc").to_numpy()[s.text], b.column("text_key").to_numpy()[s.text], s.first - s.at[s.text], s.name))
            size += strings[-1].nbytes
            if size >= RUN:
                yield from flush(strings, cols)
                strings, cols, size = [], [], 0
                release()
        if strings:
            yield from flush(strings, cols)
        del strings, cols
        release()

    return docs.select("doc", "text_key", "text").mapInArrow(run, "p bigint, packet binary")


def least_ids(strings: list[bytes], lo: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For distinct strings: their names, where the windows of each begin, and the least id of each window."""
    raw = np.frombuffer(b"".join(strings), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in strings])]).astype(np.int64)
    begin, end, at = spelled(raw, offsets)
    h = ngrams(word_hashes(raw, begin, end), WINDOW)
    count = np.diff(at) - WINDOW + 1
    cut = np.concatenate([[0], np.cumsum(count)])
    of = np.repeat(np.arange(len(strings)), count)
    place = np.arange(len(of)) - cut[of]
    start = at[of] + place
    h = h[start]
    order = np.argsort(h, kind="stable")
    ordered = h[order]
    new = np.ones(len(h), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    twice = np.flatnonzero(~new)
    a, b = begin[start], end[start + WINDOW - 1]
    flat = raw.tobytes()
    text = lambda k: flat[a[k] : b[k]]
    clash = [k for k in twice.tolist() if text(order[k]) != text(order[k - 1])]
    group = np.cumsum(new) - 1
    if clash:  # different windows with one hash: group those by their bytes
        n = int(group[-1]) + 1
        for g in np.unique(group[clash]):
            kinds: dict[bytes, int] = {}
            for k in np.flatnonzero(group == g):
                group[k] = n + kinds.setdefault(text(order[k]), len(kinds))
            n += len(kinds)
    least = np.full(int(group.max()) + 1, _LAST)
    np.minimum.at(least, group, lo[of[order]])
    mins = np.empty(len(h), np.int64)
    mins[order] = least[group]
    name = mix(np.add.reduceat(h * _PLACE[place], cut[:-1]) + count.astype(np.uint64)).view(np.int64)
    return name, cut, mins


_MET = "doc bigint, text_key bigint, places array<int>, name bigint, least array<bigint>"


def _lists(values: np.ndarray, cuts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(values, kind))


def _bucket(packets: list[bytes], hot: Hot) -> Iterator[pa.RecordBatch]:
    """Places of repeated windows by document, and the least ids of hot strings."""
    codes: dict[bytes, int] = {}
    los, his, seen, at = [], [], [], []
    for packet in packets:
        (size, lo, wide, doc, key, of, to, first), body = _unpacked(packet)
        ends = np.cumsum(size)
        own = np.array([codes.setdefault(body[a:b], len(codes)) for a, b in zip((ends - size).tolist(), ends.tolist(), strict=True)], np.int64)
        lo = np.cumsum(lo)
        los.append((own, lo))
        his.append((own, lo + wide))
        to = np.cumsum(to)
        seen.append((own[np.cumsum(of)], np.cumsum(doc)[to], key[to], first))
    least, most = np.full(len(codes), _LAST), np.full(len(codes), -_LAST - 1)
    for own, lo in los:
        np.minimum.at(least, own, lo)
    for own, hi in his:
        np.maximum.at(most, own, hi)
    name, cut, mins = least_ids(list(codes), least)
    count = np.diff(cut)
    use = np.logical_or.reduceat(mins < np.repeat(most, count), cut[:-1])
    string, doc, key, first = (np.concatenate(c) for c in zip(*seen, strict=True))
    some = use[string]
    string, doc, key, first = string[some], doc[some], key[some], first[some]
    n = count[string]
    row = np.repeat(np.arange(len(string)), n)
    window = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    hit = mins[cut[string][row] + window] < doc[row]
    row, place = row[hit], (first[row] + window)[hit]
    order = np.lexsort((place, key[row], doc[row]))
    row, place = row[order], place[order]
    if len(row):
        d, k = doc[row], key[row]
        new = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (k[1:] != k[:-1])]))
        yield pa.RecordBatch.from_arrays([pa.array(d[new]), pa.array(k[new]), _lists(place, np.append(new, len(row)), pa.int32()), pa.nulls(len(new), pa.int64()), pa.nulls(len(new), pa.list_(pa.int64()))], names=["doc", "text_key", "places", "name", "least"])
    far = np.flatnonzero(use & hot.has(name))
    if len(far):
        picked = np.concatenate([mins[cut[k] : cut[k + 1]] for k in far])
        yield pa.RecordBatch.from_arrays([pa.nulls(len(far), pa.int64()), pa.nulls(len(far), pa.int64()), pa.nulls(len(far), pa.list_(pa.int32())), pa.array(name[far]), _lists(picked, np.concatenate([[0], np.cumsum(count[far])]), pa.int64())], names=["doc", "text_key", "places", "name", "least"])


def _meet(hot: Hot):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, packets = None, []
        for b in batches:
            for p, packet in zip(b.column("p").to_pylist(), b.column("packet"), strict=True):
                if p != held and packets:
                    yield from _bucket(packets, hot)
                    packets = []
                held = p
                packets.append(packet.as_py())
        if packets:
            yield from _bucket(packets, hot)
        del packets
        release()

    return run


def _cut_again(docs: DataFrame, hot: Hot) -> DataFrame:
    """The hot strings of every document: name, document and the first window's place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s, b in _texts(batches, hot.minimisers):
            some = np.flatnonzero(hot.has(s.name))
            if len(some):
                row = pa.array(s.text[some])
                yield pa.RecordBatch.from_arrays([pa.array(s.name[some]), b.column("doc").take(row), b.column("text_key").take(row), pa.array((s.first - s.at[s.text])[some].astype(np.int32))], names=["name", "doc", "text_key", "first"])

    return docs.select("doc", "text_key", "text").mapInArrow(run, "name bigint, doc bigint, text_key bigint, first int")


def covered(docs: DataFrame) -> DataFrame:
    """doc, text_key and hits (places of windows that start in a smaller document) of ``docs`` (doc, text_key, text)."""
    hot = find_hot(docs)
    buckets = hot.size // BUCKET + 1
    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), buckets // 4)
    met = sent(docs, hot, buckets).repartition(n, "p").sortWithinPartitions("p").mapInArrow(_meet(hot), _MET)
    if len(hot.names):
        met = written(met, "met")
    found = met.where("doc IS NOT NULL").select("doc", "text_key", "places")
    if len(hot.names):
        far = _cut_again(docs, hot).join(met.where("name IS NOT NULL").select("name", "least"), "name")
        place = F.filter(F.transform("least", lambda x, i: F.when(x < F.col("doc"), F.col("first") + i)), lambda x: x.isNotNull())
        found = found.unionByName(far.select("doc", "text_key", place.alias("places")))
    return found.groupBy("doc", "text_key").agg(F.flatten(F.collect_list("places")).alias("hits"))


def _kept(raw: np.ndarray, offsets: np.ndarray, hits: list[np.ndarray | None]) -> Iterator[tuple[int, int, str]]:
    """n_words, n_removed and the hash of the kept words of several texts."""
    begin, end, at = spelled(raw, offsets)
    flat = raw.tobytes()
    edges = np.zeros(len(begin) + 1, np.int64)
    for d, found in enumerate(hits):
        if found is not None:
            np.add.at(edges, found + at[d], 1)
            np.add.at(edges, found + at[d] + WINDOW, -1)
    keep = np.cumsum(edges[:-1]) <= 0
    for d in range(len(hits)):
        own = np.flatnonzero(keep[at[d] : at[d + 1]]) + at[d]
        words = [flat[x:y] for x, y in zip(begin[own].tolist(), end[own].tolist(), strict=True)]
        n = int(at[d + 1] - at[d])
        yield n, n - len(words), hashlib.sha256(b" ".join(words)).hexdigest()


_TEXT = "p bigint, doc bigint, text_key bigint, hits array<int>, packet binary"


def _sent_texts(docs: DataFrame, parts: int) -> DataFrame:
    """The texts by p, a share of (doc, text_key), joined and compressed; equal rows of a run once, with their number."""

    def flush(cols: list[tuple], texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        p, doc, key, no_id = (np.concatenate(c) for c in zip(*cols, strict=True))
        rows, first, times = np.unique(np.stack([p, doc, key, no_id], 1), axis=0, return_index=True, return_counts=True)
        packets, keys = [], []
        for a, b in _runs(rows[:, 0]):
            body = [texts[k] for k in first[a:b].tolist()]
            packets.append(_packed(_steps(rows[a:b, 1]), rows[a:b, 2], rows[a:b, 3], times[a:b], np.array([len(t) for t in body]), body=b"".join(body)))
            keys.append(int(rows[a, 0]))
        n = len(keys)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.int32())), pa.array(packets, pa.binary())], names=["p", "doc", "text_key", "hits", "packet"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols, texts, size = [], [], 0
        for b in batches:
            raw, offsets = arrow_bytes(b.column("text"))
            p, doc, key, no_id = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("p", "doc", "text_key", "no_id"))
            for lo, hi in pieces(offsets):
                flat = raw[offsets[lo] : offsets[hi]].tobytes()
                ends = (offsets[lo : hi + 1] - offsets[lo]).tolist()
                texts += [flat[x:y] for x, y in zip(ends[:-1], ends[1:], strict=True)]
                cols.append((p[lo:hi], doc[lo:hi], key[lo:hi], no_id[lo:hi]))
                size += len(flat)
                if size >= TEXTS:
                    yield from flush(cols, texts)
                    cols, texts, size = [], [], 0
        if cols:
            yield from flush(cols, texts)
        del cols, texts
        release()

    part = F.pmod(F.xxhash64("doc", "text_key"), F.lit(parts))
    return docs.select(part.alias("p"), "doc", "text_key", F.col("doc_id").isNull().alias("no_id"), "text").mapInArrow(run, _TEXT)


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A part's hits come first, then its texts."""
    held, hits = None, {}
    for b in batches:
        for p, doc, key, found, packet in zip(*(b.column(c) for c in ("p", "doc", "text_key", "hits", "packet")), strict=True):
            if p.as_py() != held:
                held, hits = p.as_py(), {}
            if not packet.is_valid:
                hits[doc.as_py(), key.as_py()] = np.array(found.values, np.int64)
                continue
            (docs, keys, no_id, times, size), body = _unpacked(packet.as_py())
            raw, docs = np.frombuffer(body, np.uint8), np.cumsum(docs)
            offsets = np.concatenate([[0], np.cumsum(size)])
            for lo, hi in pieces(offsets):
                own = [hits.get(x) for x in zip(docs[lo:hi].tolist(), keys[lo:hi].tolist(), strict=True)]
                n, cut, sha = zip(*_kept(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], own), strict=True)
                again = np.repeat(np.arange(hi - lo), times[lo:hi])
                ids = pa.array(docs[lo:hi], mask=no_id[lo:hi].astype(bool))
                yield pa.RecordBatch.from_arrays([c.take(pa.array(again)) for c in (ids, pa.array(n, pa.int64()), pa.array(cut, pa.int64()), pa.array(sha))], names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row of ``docs``."""
    whole = F.col(text).cast("string")
    d = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.coalesce(F.col(key).cast("bigint"), F.lit(_LAST)).alias("doc"), F.xxhash64(whole).alias("text_key"), whole.alias("text"))
    hits = covered(d.select("doc", "text_key", "text"))
    parts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hits = hits.select(F.pmod(F.xxhash64("doc", "text_key"), F.lit(parts)).alias("p"), "doc", "text_key", F.col("hits").cast("array<int>").alias("hits"), F.lit(None).cast("binary").alias("packet"))
    both = hits.unionByName(_sent_texts(d, parts)).repartition("p").sortWithinPartitions("p", F.col("packet").isNotNull())
    return both.mapInArrow(_removed, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")
