"""Token ids in binary files that are read a few documents at a time.

A file is a run of independent zstandard frames and, at its end, the seek
table of the public zstd seekable format (a skippable frame: compressed size,
raw size and checksum of every frame).  The raw bytes are

* ids: all ids of all documents, little-endian, 2 or 4 bytes each; every frame
  but the last holds exactly ``FRAME_IDS`` of them;
* the index, in frames of its own: for each document its id (int64), 1 if that
  id is null (uint8) and its number of ids (int64), column by column;
* the last frame: counts of documents, of id frames and of index frames, and
  the width of an id.

A reader fetches the tail, then the index, then only the frames that hold the
wanted documents, and checks each frame's checksum (low half of XXH64).

Documents are written in ascending id order (nulls first; ties by a hash of the
text, so that rows of one id, or without one, can fill many files): Spark
range-partitions them, every task writes one file under a name of its own
attempt, and only files listed in the manifest (written by Spark's own commit)
count, so a lost or repeated task leaves at most an unlisted file.

Nulls encode like the empty text: the end id alone.  Repeated rows are
repeated; an empty table gives an empty manifest; other columns are not read.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_bytes, pieces, release, shared_path

FRAME_IDS = 1 << 17
#: words that a worker remembers, twice, and bytes of text it encodes at once
MEMORY, RUN = 800_000, 4 << 20
_ENDS = ".,;:!?"
_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1
_TAIL = struct.Struct("<QQQQ")

#: a space between white space, where texts may not be cut; then they are split like this
_LONG_SPACE = re.compile(r"\s \s")
_SPLIT = re.compile(r" ?\S+|\s+(?!\S)|\s+")
#: white space to Python, but not to the tokenizer; and the mark of a word without a space before it
_ODD = re.compile("[\x00\x1c-\x1f]")
_BARE = "\x00"
_WHITE = re.compile(r"\s")
#: bytes that may belong to white space, and bytes of ``_ODD``
_MAY_BE_WHITE = np.array([b < 33 or b >= 128 for b in range(256)])
_ODD_BYTE = np.array([b == 0 or 28 <= b < 32 for b in range(256)])


class Encoder:
    """A byte-level BPE of the tokenizers library; words are encoded by it once and remembered.

    No token spans the place before a space that has another character than
    white space on either side, so texts are cut there.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.model = self.lib.model
        split = self.lib.pre_tokenizer.__class__.__name__
        self.by_word = self.lib.normalizer is None and split == "ByteLevel" and not self.lib.pre_tokenizer.add_prefix_space
        self.special = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self.width = np.dtype("<u2") if self.lib.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.line_end = np.frombuffer(self._raw(["\n"])[0], self.width)
        self.ends = dict(zip(_ENDS, self._raw(list(_ENDS)), strict=True))
        #: the characters that a byte-level vocabulary spells bytes with: printable ones as they are, the others from 256 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.spelling = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
        self.code = "H" if self.width.itemsize == 2 else "I"
        #: ids of words met lately, and of those met before
        self.memory: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _raw(self, texts: list[str]) -> list[bytes]:
        got = self.lib.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.width).tobytes() for e in got]

    def _spaced(self, words: list[str]) -> list[bytes]:
        """The ids of words with a space before each; words without white space are encoded as lines of one text."""
        lines = [w for w in words if not _WHITE.search(w)] if len(self.line_end) == 1 else []
        out = {}
        for lo in range(0, len(lines), 4096):
            run = lines[lo : lo + 4096]
            ids = np.array(self.lib.encode_batch_fast([" " + "\n ".join(run) + "\n"], add_special_tokens=False)[0].ids, self.width)
            ends = (np.flatnonzero(ids == self.line_end[0]) * self.width.itemsize).tolist()
            raw, at = ids.tobytes(), 0
            for w, end in zip(run, ends, strict=True):
                out[w] = raw[at:end]
                at = end + self.width.itemsize
        rest = [w for w in words if w not in out]
        out.update(zip(rest, self._raw([" " + w for w in rest]), strict=True))
        return [out[w] for w in words]

    def _piece(self, word: str, spaced: bool) -> bytes:
        """The ids of letters with or without a space before them: one piece to the tokenizer, so its model alone decides."""
        text = word if word.isascii() else "".join(map(self.spelling.__getitem__, word.encode()))
        return array(self.code, [t.id for t in self.model.tokenize(self.spelling[32] + text if spaced else text)]).tobytes()

    def _known(self, w: str) -> bytes | None:
        """The ids of a word met before, or made of pieces: letters, letters and one of ``_ENDS``, or two such with a line end between."""
        got = self.memory.get(w)
        if got is None:
            got = self.older.get(w)
            bare = w[:1] == _BARE
            core = w[1:] if bare else w
            if got is not None:
                pass
            elif core.isalpha():
                got = self._piece(core, not bare)
            elif core[-1:] in self.ends and core[:-1].isalpha():
                got = self._known(w[:-1]) + self.ends[core[-1]]
            elif core.count("\n") == 1:
                before, _, after = core.partition("\n")
                if before and after and not _WHITE.search(before) and not _WHITE.search(after):
                    first, second = self._known(w[: len(w) - len(after) - 1]), self._known(_BARE + after)
                    got = None if first is None or second is None else first + self.line_end.tobytes() + second
            if got is not None:
                self.memory[w] = got
        return got

    def _learn(self, words: set[str]) -> None:
        """Remember the ids of words with a space before each (of those with the mark, without)."""
        if len(self.memory) > MEMORY:
            self.older, self.memory = self.memory, {}
        ask = [w for w in words.difference(self.memory) if self._known(w) is None]
        bare = [w for w in ask if w[:1] == _BARE]
        self.memory.update(zip(bare, self._raw([w[1:] for w in bare]), strict=True))
        new = [w for w in ask if w[:1] != _BARE]
        self.memory.update(zip(new, self._spaced(new), strict=True))

    def _words(self, text: str) -> list[str] | None:
        """The text cut at spaces; None if it must be encoded whole."""
        if not self.by_word or _ODD.search(text) or any(s in text for s in self.special):
            return None
        if _LONG_SPACE.search(text):
            return [w[1:] if w[0] == " " and not w.isspace() else _BARE + w for w in _SPLIT.findall(text)]
        words = text.split(" ")
        words[0] = _BARE + words[0]
        return words

    def _cut_apart(self, texts: pa.Array) -> np.ndarray:
        """True for texts that can't simply be split at their spaces."""
        raw, offsets = arrow_bytes(texts)
        white = _MAY_BE_WHITE[raw]
        at = np.flatnonzero((raw[1:-1] == 32) & white[:-2] & white[2:]) + 1 if len(raw) > 2 else np.zeros(0, np.int64)
        odd = np.concatenate([at, np.flatnonzero(_ODD_BYTE[raw])])
        out = np.zeros(len(texts), bool)
        out[np.searchsorted(offsets, odd, side="right") - 1] = True
        # two texts meet without a byte between them: what was found there is looked at again
        for k in np.flatnonzero(out).tolist():
            t = texts[k].as_py()
            out[k] = bool(_ODD.search(t) or _LONG_SPACE.search(t))
        whole = raw.tobytes()
        for s in self.special:
            if s.encode() in whole:
                out |= np.array([s in t for t in texts.to_pylist()], bool)
        return out

    def encode_run(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, each with ``end`` behind it, and each text's number of ids.

        Words are cut and numbered as an Arrow dictionary; only distinct ones are looked up or encoded, and the ids of all words
        are joined by those numbers.  A text that can't be cut at spaces is one entry of its own.
        """
        texts = texts.fill_null("")
        apart = self._cut_apart(texts) if self.by_word else np.ones(len(texts), bool)
        words = pc.split_pattern(texts.filter(pa.array(~apart)), " ")
        cuts = words.offsets.to_numpy().astype(np.int64)
        values = words.values.slice(cuts[0], cuts[-1] - cuts[0]) if len(cuts) else words.values
        cuts = cuts - cuts[0]
        coded, first = values.dictionary_encode(), values.take(pa.array(cuts[:-1])).dictionary_encode()
        spaced, bare = coded.dictionary.to_pylist(), [_BARE + w for w in first.dictionary.to_pylist()]
        rest = {k: self._words(texts[k].as_py()) for k in np.flatnonzero(apart).tolist()}
        self._learn(set(spaced).union(bare, *(w for w in rest.values() if w)))
        get = self.memory.__getitem__
        alone = [self._raw([texts[k].as_py()])[0] if w is None else b"".join(map(get, w)) for k, w in rest.items()]
        table = [*map(get, spaced), *map(get, bare), *alone, b"" if end is None else np.array([end], self.width).tobytes()]
        size = np.fromiter(map(len, table), np.int32, len(table)) // np.int32(self.width.itemsize)
        # entries of every text: its words, or the one of its own; then the end
        n = np.ones(len(texts), np.int64)
        n[~apart] = np.diff(cuts)
        at = np.concatenate([[0], np.cumsum(n + 1)])
        entry = np.empty(int(at[-1]), np.int32)
        entry[at[1:] - 1] = len(table) - 1
        own = np.flatnonzero(~apart)
        inside = np.ones(len(entry), bool)
        inside[at[1:] - 1] = False
        inside[at[:-1][apart]] = False
        entry[inside] = coded.indices.to_numpy()
        entry[at[:-1][own]] = len(spaced) + first.indices.to_numpy()
        entry[at[:-1][apart]] = len(spaced) + len(bare) + np.arange(len(alone))
        ids = np.frombuffer(b"".join(map(table.__getitem__, entry.tolist())), self.width)
        return ids, np.add.reduceat(size[entry], at[:-1], dtype=np.int64) if len(texts) else np.zeros(0, np.int64)

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as packed integers of ``width``."""
        ids, n = self.encode_run(pa.array(texts, pa.string()))
        cuts = np.concatenate([[0], np.cumsum(n)])
        return [ids[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


# ---- one file --------------------------------------------------------------


class Writer:
    """Appends documents; ``close`` writes index, tail and seek table."""

    def __init__(self, out, width: np.dtype):
        self.out, self.width, self.zip = out, width, zstandard.ZstdCompressor(level=3)
        self.table, self.ids, self.waiting = [], [], 0
        self.keys, self.nulls, self.counts = [], [], []

    def _frame(self, raw: bytes) -> None:
        data = self.zip.compress(raw)
        self.out.write(data)
        self.table.append((len(data), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))

    def _flush(self, rest: bool) -> None:
        size = FRAME_IDS * self.width.itemsize
        raw = b"".join(self.ids)
        end = len(raw) if rest else len(raw) // size * size
        for lo in range(0, end, size):
            self._frame(raw[lo : min(lo + size, end)])
        self.ids, self.waiting = [raw[end:]], len(raw) - end

    def add(self, key: int | None, ids: bytes) -> None:
        self.keys.append(0 if key is None else key)
        self.nulls.append(key is None)
        self.counts.append(len(ids) // self.width.itemsize)
        self.ids.append(ids)
        self.waiting += len(ids)
        if self.waiting >= FRAME_IDS * self.width.itemsize:
            self._flush(False)

    def add_all(self, keys: np.ndarray, nulls: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        """Append documents whose ids stand one after the other."""
        self.keys.extend(np.where(nulls, 0, keys).tolist())
        self.nulls.extend(nulls.tolist())
        self.counts.extend(counts.tolist())
        self.ids.append(ids.tobytes())
        self.waiting += ids.nbytes
        if self.waiting >= FRAME_IDS * self.width.itemsize:
            self._flush(False)

    def close(self) -> None:
        if self.waiting:
            self._flush(True)
        id_frames = len(self.table)
        index = np.array(self.keys, "<i8").tobytes() + np.array(self.nulls, np.uint8).tobytes() + np.array(self.counts, "<i8").tobytes()
        for lo in range(0, len(index), 1 << 20):
            self._frame(index[lo : lo + (1 << 20)])
        self._frame(_TAIL.pack(len(self.keys), id_frames, len(self.table) - id_frames, self.width.itemsize))
        body = b"".join(struct.pack("<III", *t) for t in self.table) + struct.pack("<IBI", len(self.table), 0x80, _SEEKABLE)
        self.out.write(struct.pack("<II", _SKIPPABLE, len(body)) + body)


class Reader:
    """Opens a file by its seek table; ``documents`` decompresses only the frames it needs."""

    def __init__(self, file, size: int):
        self.file, self.unzip = file, zstandard.ZstdDecompressor()
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != _SEEKABLE or flags != 0x80:
            raise ValueError("no seek table")
        t = np.frombuffer(self._at(size - 9 - 12 * n, 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.packed, self.raw, self.sums = t[:, 0], t[:, 1], t[:, 2]
        self.begin = np.concatenate([[0], np.cumsum(self.packed)])
        docs, id_frames, index_frames, width = _TAIL.unpack(self.frame(n - 1))
        self.width = np.dtype(f"<u{width}")
        index = b"".join(self.frame(id_frames + k) for k in range(index_frames))
        self.keys = np.frombuffer(index, "<i8", docs)
        self.nulls = np.frombuffer(index, np.uint8, docs, 8 * docs).astype(bool)
        self.counts = np.frombuffer(index, "<i8", docs, 9 * docs)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])
        self._last: tuple[int, np.ndarray] | None = None

    def _at(self, at: int, size: int) -> bytes:
        self.file.seek(int(at))
        return self.file.read(int(size))

    def frame(self, k: int) -> bytes:
        raw = self.unzip.decompress(self._at(self.begin[k], self.packed[k]), max_output_size=int(self.raw[k]))
        if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.sums[k]:
            raise ValueError(f"frame {k} is damaged")
        return raw

    def _ids(self, k: int) -> np.ndarray:
        if self._last is None or self._last[0] != k:
            self._last = k, np.frombuffer(self.frame(k), self.width)
        return self._last[1]

    def document(self, d: int) -> Iterator[np.ndarray]:
        """The ids of the d-th document, frame by frame."""
        a, b = int(self.starts[d]), int(self.starts[d + 1])
        for k in range(a // FRAME_IDS, -(-b // FRAME_IDS) if b > a else 0):
            yield self._ids(k)[max(0, a - k * FRAME_IDS) : b - k * FRAME_IDS]


def _open(path: str, write: bool):
    from pyarrow import fs

    system, where = fs.FileSystem.from_uri(path)
    if write:
        system.create_dir(where.rpartition("/")[0], recursive=True)
        return system.open_output_stream(where, compression=None)
    return system.open_input_file(where)


# ---- the operator ----------------------------------------------------------


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int, out: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and write all documents; returns the manifest: one row per file, in order by ``part``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, file, n = encoder(tokenizer), None, 0
        part = TaskContext.get().partitionId()
        path = f"{out}/ids/part-{part:07d}-{uuid.uuid4().hex}.zst"
        for b in batches:
            texts, keys, nulls = (b.column(c) for c in ("t", "k", "no_k"))
            keys, nulls = keys.to_numpy(), nulls.to_numpy(zero_copy_only=False)
            for lo, hi in pieces(arrow_bytes(texts)[1], RUN):
                if file is None:
                    file = _open(path, True)
                    to = Writer(file, enc.width)
                ids, counts = enc.encode_run(texts.slice(lo, hi - lo), end_id)
                to.add_all(keys[lo:hi], nulls[lo:hi], counts, ids)
                n += len(ids)
        if file is not None:
            to.close()
            file.close()
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([path]), pa.array([len(to.keys)], pa.int64()), pa.array([n], pa.int64())], names=["part", "path", "n_docs", "n_tokens"])
        release()

    d = docs.select(F.coalesce(docs[key].cast("bigint"), F.lit(0)).alias("k"), docs[key].isNull().alias("no_k"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("t"))
    d = d.withColumn("h", F.xxhash64("t"))
    order = [F.col("no_k").desc(), F.col("k"), F.col("h"), F.col("t")]
    d = d.repartitionByRange(*order[:3]).sortWithinPartitions(*order)
    d.mapInArrow(run, "part int, path string, n_docs bigint, n_tokens bigint").write.parquet(f"{out}/manifest")
    return docs.sparkSession.read.schema("part int, path string, n_docs bigint, n_tokens bigint").parquet(f"{out}/manifest")


def with_starts(manifest: DataFrame) -> DataFrame:
    """The manifest with the ids before each file: sums within runs of 1,024 files, then over the runs."""
    m = manifest.withColumn("run", F.floor(F.col("part") / 1024))
    before = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("run").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = m.groupBy("run").agg(F.sum("n_tokens").alias("of_run")).select("run", F.coalesce(F.sum("of_run").over(before), F.lit(0)).alias("base"))
    return m.join(runs, "run").withColumn("start", F.col("base") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).drop("run", "base")


def read_tokens(manifest: DataFrame, wanted: list[int] | None = None) -> DataFrame:
    """Documents read back from the files: doc_id, start, n_tokens, ids_crc32, frames_read so far in its file.

    ``wanted``: only these ids; files' other frames stay compressed.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, base in zip(b["path"], b["start"], strict=True):
                with _open(path, False) as f:
                    r = Reader(f, f.size())
                    rows = range(len(r.keys)) if wanted is None else np.flatnonzero(np.isin(r.keys, wanted) & ~r.nulls)
                    out = []
                    for d in rows:
                        crc = 0
                        for ids in r.document(d):
                            crc = zlib.crc32(ids.astype("<u4").tobytes(), crc)
                        out.append((None if r.nulls[d] else int(r.keys[d]), int(base + r.starts[d]), int(r.counts[d]), crc))
                        if len(out) == 10_000:
                            yield pd.DataFrame(out, columns=_COLUMNS).astype({"doc_id": "Int64"})
                            out = []
                if out:
                    yield pd.DataFrame(out, columns=_COLUMNS).astype({"doc_id": "Int64"})

    files = with_starts(manifest).select("part", "path", "start")
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(n, "part").mapInPandas(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


_COLUMNS = ["doc_id", "start", "n_tokens", "ids_crc32"]


def tokens(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write all documents below the shared folder and read them back."""
    out = shared_path(docs.sparkSession, "tokens")
    return read_tokens(write_tokens(docs, tokenizer, end_id, out))
