"""Helpers the operators share: tables, the shared folder, bounded samples, Arrow texts."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.session import scratch_path, ship_package

#: Texts are handled inside a task in pieces of about this many bytes, so the
#: working memory does not follow the Arrow batch or the longest text.
PIECE_BYTES = 1 << 20
#: words are hashed in segments of about this many bytes
SEGMENT_BYTES = 1 << 17


#: bytes of the batches in which rows go to Python and back; a longer row is a batch of its own
BATCH_BYTES = 4 << 20


def prepared(spark: SparkSession) -> SparkSession:
    """The session with this package on its workers, and with small Arrow batches (a session setting, kept)."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod4(col: str = "doc_id") -> Column:
    """crc32 of the id's decimal text, mod 4; rows with 2 are held out."""
    return F.pmod(F.crc32(F.col(col).cast("string").cast("binary")), F.lit(4))


def held_out(col: str = "doc_id") -> Column:
    return F.coalesce(crc_mod4(col) == 2, F.lit(False))


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its file system's scheme, as Spark itself resolves it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.makeQualified(p).toString()


def shared_path(spark: SparkSession, name: str) -> str:
    """A new location in the folder that driver and executors share."""
    return qualified(spark, scratch_path(spark, name))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage ends here."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release() -> None:
    """Give memory that is free in this process back to the system; a worker is kept for the next task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def arrow_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column as one byte array and n + 1 offsets; nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_binary())
    _, offs, data = col.buffers()
    offsets = np.frombuffer(offs, np.int64)[col.offset : col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]] if len(col) else raw[:0], offsets - offsets[0]


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs [lo, hi) of rows with about ``limit`` bytes; a longer row stands alone."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


# ---- word hashes -----------------------------------------------------------

_RNG = np.random.default_rng(20240229)
_VALUE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_VALUE = _VALUE[_LOWER]
#: the same with all ASCII but letters and digits between words
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
#: multipliers of the words of a shingle
_PLACE = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _ODD), np.full(n, _INV)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def _powers_for(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(1 << max(18, int(n).bit_length()))


def _segment_words(raw: np.ndarray, first: np.ndarray, space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start bytes and hashes of the words of ``raw``; ``first`` marks bytes where a text begins."""
    word = ~space[raw]
    before = np.empty(len(raw), bool)
    before[:1], before[1:] = False, word[:-1]
    begin = np.flatnonzero(word & (~before | first))
    after = np.empty(len(raw), bool)
    after[-1:], after[:-1] = True, ~word[1:] | first[1:]
    end = np.flatnonzero(word & after)
    up, down = _powers_for(len(raw))
    total = np.cumsum(_VALUE[raw] * up[: len(raw)], dtype=np.uint64)
    head = np.where(begin > 0, total[begin - 1], np.uint64(0))
    length = (end - begin + 1).astype(np.uint64)
    return begin, mix((total[end] - head) * down[begin] + length * _ODD)


def words_of(raw: np.ndarray, offsets: np.ndarray, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` (A-Z lowered) of several texts, and each text's word offsets.

    ``space`` marks the bytes between words.  A run of texts is cut at spaces into segments of ``SEGMENT_BYTES``, so the
    temporary arrays stay small for texts of any length.
    """
    n, hashes, starts, at = int(offsets[-1]), [], [], 0
    is_first = np.zeros(n + 1, bool)
    is_first[offsets[:-1]] = True
    while at < n:
        to = min(n, at + SEGMENT_BYTES)
        while to < n and not space[raw[to]] and not is_first[to]:
            nxt = np.flatnonzero(space[raw[to : min(n, to + 65536)]] | is_first[to : min(n, to + 65536)])
            to = to + int(nxt[0]) if len(nxt) else min(n, to + 65536)
        b, h = _segment_words(raw[at:to], is_first[at:to], space)
        starts.append(b + at)
        hashes.append(h)
        at = to
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), offsets).astype(np.int64)


def ngrams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position (the last n - 1 positions have none)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        out += words[k : len(words) - n + 1 + k] * _PLACE[k]
    return mix(out)


def sequence_hash(words: np.ndarray) -> np.uint64:
    """Hash of a whole short word sequence; differs from every n-gram's."""
    parts = np.append(words * _PLACE[: len(words)], _PLACE[60 + min(len(words), 3)])
    return mix(parts.sum(dtype=np.uint64, keepdims=True))[0]
