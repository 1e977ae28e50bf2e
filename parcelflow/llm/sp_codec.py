"""SentencePiece BPE encoding by backtracking, and decoding.

The library merges the adjacent pair with the best score until none is left.
The same pieces come from reading left to right: take the longest piece that
starts here (all matches come from one Aho-Corasick pass), keep it if it may
stand after the previous piece, else try its next shorter prefix, else step
back.  Two pieces may stand side by side if merging their joined text anew
gives just these two; a sequence of pieces is the library's answer exactly if
every adjacent pair is.  A bit per position remembers the places from which no
answer exists, so no place is tried twice and the work is linear.

A text is first cut where no piece of the vocabulary spans: checked when the
model is loaded, so a cut never changes the answer.  The answers of such
chunks are kept in a bounded memory of the worker.

Nulls encode like the empty text (the end id alone).  Repeated rows give
repeated results; an empty table gives an empty result; columns other than
the key and the text are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame

from .common import release

SPACE = "▁"
#: letters, one digit, or a run of anything else, each with the spaces before it
_FINE = re.compile(SPACE + r"*(?:[^\W\d_²³¹¼½¾]+|\d|(?:[^\w" + SPACE + r"]|[_²³¹¼½¾])+)|" + SPACE + "+")
_COARSE = re.compile(SPACE + "*[^" + SPACE + "]+|" + SPACE + "+")
#: chunks, words and pairs that a worker remembers; it keeps them for its next task, beside what other stages need there
MEMORY = 100_000


class Codec:
    """One model: ``pieces`` (text pieces of the answer), ``encode`` and ``decode``."""

    def __init__(self, path: str):
        import sentencepiece.sentencepiece_model_pb2 as model_pb2

        model = model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        kinds = model_pb2.ModelProto.SentencePiece
        spec = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or spec.precompiled_charsmap or spec.remove_extra_whitespaces:
            raise ValueError("only BPE models that leave the text as it is are supported")
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        self.prefix = SPACE if spec.add_dummy_prefix else ""
        self.end_id = model.trainer_spec.eos_id
        self.text_of = [p.piece for p in model.pieces]
        self.control = {i for i, p in enumerate(model.pieces) if p.type == kinds.CONTROL}
        self.byte_of = {i: int(p.piece[3:5], 16) for i, p in enumerate(model.pieces) if p.type == kinds.BYTE}
        self.byte_id = {b: i for i, b in self.byte_of.items()}
        self.unknown_id = next(i for i, p in enumerate(model.pieces) if p.type == kinds.UNKNOWN)
        self.score = {p.piece: p.score for p in model.pieces if p.type == kinds.NORMAL}
        self.id_of = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        self._fits: dict[tuple[str, str], bool] = {}
        reachable = [p for p in self.score if len(p) == 1 or self.merged(p) == [p]]
        known = set(reachable)
        #: the two pieces whose merge made a piece
        self.halves = {p: self._halves(p) for p in reachable if len(p) > 1}
        self.shorter: dict[str, str] = {}
        self.find = ahocorasick.Automaton()
        for p in reachable:
            self.find.add_word(p, (len(p) - 1, p))
            self.shorter[p] = next((p[:k] for k in range(len(p) - 1, 0, -1) if p[:k] in known), p[0] if len(p) > 1 else "")
        self.find.make_automaton()
        self.cut = next((r for r in (_FINE, _COARSE) if all(len(r.findall(p)) == 1 for p in known)), None)
        self.decimal = {p: str(i) for p, i in self.id_of.items()}
        odd = self.control | set(self.byte_of) | {self.unknown_id}
        self.said = {str(i): t for i, t in enumerate(self.text_of) if i not in odd}
        self._chunks, self._words = _Chunks(self), _Words(self)

    def merged(self, text: str) -> list[str]:
        """Merging by score from single characters: the definition, used on short texts."""
        parts, score = list(text), self.score
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def fits(self, a: str, b: str) -> bool:
        """Whether merging the text of both gives just a and b.

        Only merges across the border can spoil that, so the merging is
        undone from the latest merge back, on the side that was merged later,
        and the pieces then at the border are asked for a better merge.
        """
        ok = self._fits.get((a, b))
        if ok is None:
            if len(self._fits) >= MEMORY:
                self._fits.clear()
            ok = self._fits[a, b] = self._stand(a, b)
        return ok

    def _stand(self, a: str, b: str) -> bool:
        score, halves = self.score, self.halves
        left, right = [a], [b]  # border pieces, latest first, and their scores when merged
        while (h := halves.get(left[-1])) is not None:
            left.append(h[1])
        while (h := halves.get(right[-1])) is not None:
            right.append(h[0])
        i, j = len(left) - 1, len(right) - 1
        while True:
            across = score.get(left[i] + right[j])
            # the next merge on either side; of equal scores the one further left comes first
            s = score[left[i - 1]] if i else None
            t = score[right[j - 1]] if j else None
            if across is not None and (s is None or across > s) and (t is None or across >= t):
                return False
            if s is None and t is None:
                return True
            if t is None or (s is not None and s >= t):
                i -= 1
            else:
                j -= 1

    def pieces(self, text: str) -> list[str]:
        """The pieces of one chunk; characters without a piece stand alone."""
        if text in self.id_of and text in self.shorter:
            return [text]
        n, longest, fits = len(text), list(text), self._fits.get
        for end, (back, p) in self.find.iter(text):
            longest[end - back] = p  # a later end is a longer match
        failed, out, at = bytearray(n // 8 + 1), [], 0
        piece = longest[0]
        while piece is not None:
            last = out[-1] if out else None
            while True:
                end = at + len(piece)
                if not failed[end >> 3] >> (end & 7) & 1 and (last is None or fits((last, piece)) or self.fits(last, piece)):
                    out.append(piece)
                    at = end
                    piece = longest[end] if end < n else None
                    break
                piece = self.shorter.get(piece, "")
                if not piece:
                    failed[at >> 3] |= 1 << (at & 7)
                    out.pop()
                    at -= len(last)
                    piece = last
                    break
        return out

    def _halves(self, piece: str) -> tuple[str, str]:
        """The last merge on the way to a reachable piece."""
        parts = list(piece)
        while len(parts) > 2:
            best = max((self.score.get(parts[k] + parts[k + 1], float("-inf")), -k) for k in range(len(parts) - 1))
            k = -best[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts[0], parts[1]

    def ids_of(self, piece: str) -> list[int]:
        i = self.id_of.get(piece)
        if i is not None:
            return [i]
        return [self.byte_id[b] for b in piece.encode()] if self.byte_id else [self.unknown_id]

    def chunks(self, text: str) -> list[str]:
        if not text:
            return []
        text = self.prefix + text.replace(" ", SPACE)
        return self.cut.findall(text) if self.cut else [text]

    def encode(self, text: str | None) -> list[int]:
        """The library's ids of a text, without an end id."""
        return [i for c in self.chunks(text or "") for p in self.pieces(c) for i in self.ids_of(p)]

    def surface(self, ids: list[int]) -> str:
        """The text of ids, with the prefix space still there."""
        out, raw = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                raw.append(self.byte_of[i])
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            if i not in self.control:
                out.append(" ⁇ " if i == self.unknown_id else self.text_of[i])
        if raw:
            out.append(raw.decode("utf-8", "replace"))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        out = self.surface(ids)
        if self.prefix and out.startswith(SPACE):
            out = out[1:]
        return out.replace(SPACE, " ")

    def chunk(self, text: str) -> tuple[str, str]:
        """The ids of a chunk in decimal, and the text they decode to."""
        parts, decimal = self.pieces(text), self.decimal
        try:
            ids = [decimal[p] for p in parts]
            return " ".join(ids), "".join([self.said[i] for i in ids])
        except KeyError:  # characters without a piece, or ids without a text of their own
            ids = [i for p in parts for i in self.ids_of(p)]
            return " ".join([str(i) for i in ids]), self.surface(ids)

    def digest(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids with the end id, and sha256 of the ids and of the decoded text."""
        n, ids, back = 1, hashlib.sha256(), hashlib.sha256()
        text, memory = text or "", self._words
        if not text:
            parts = []
        elif self.cut and self.prefix and "  " not in text and text[0] != " " and text[-1] != " " and SPACE not in text:
            parts = text.split(" ")  # single spaces: a word with its space is cut from the next
        else:
            parts, memory = self.chunks(text), self._chunks
        for lo in range(0, len(parts), 65536):
            run = parts[lo : lo + 65536]
            memory.age()
            line = " ".join([memory[w] for w in run])
            n += line.count(" ") + 1
            ids.update(f"{line} ".encode())
            # each chunk's ids were decoded when it was encoded; what differs from the chunk is kept apart
            if memory.odd:
                run = [memory.odd.get(w, w) for w in run]
            surface = (" " if lo else "") + " ".join(run) if memory.spaced else "".join(run)
            if lo == 0 and self.prefix and not memory.spaced and surface.startswith(SPACE):
                surface = surface[1:]
            back.update(surface.replace(SPACE, " ").encode())
        ids.update(str(self.end_id).encode())
        return n, ids.hexdigest(), back.hexdigest()


class _Chunks(dict):
    """The ids of chunks that a worker met lately, filled on demand; ``odd``: those that decode to another text."""

    spaced = False

    def __init__(self, owner: Codec):
        super().__init__()
        self.owner, self.older, self.odd = owner, {}, {}

    def age(self) -> None:
        """Between runs of words: forget what was last met long ago."""
        if len(self) > MEMORY:
            self.older = dict(self)
            self.clear()

    def encoded(self, chunk: str) -> tuple[str, str]:
        return self.owner.chunk(chunk)

    def __missing__(self, chunk: str) -> str:
        got = self.older.get(chunk)
        if got is None:
            got, back = self.encoded(chunk)
            if back != chunk:
                self.odd[chunk] = back
        if len(chunk) < 64:
            self[chunk] = got
        return got


class _Words(_Chunks):
    """The same for words between single spaces, which may hold several chunks."""

    spaced = True

    def encoded(self, word: str) -> tuple[str, str]:
        own = self.owner
        parts, chunks = own.cut.findall(SPACE + word), own._chunks
        if len(parts) == 1:
            got, back = own.chunk(parts[0])
        else:
            chunks.age()
            got = " ".join([chunks[c] for c in parts])
            back = "".join([chunks.odd.get(c, c) for c in parts])
        return got, back[1:]


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encode_decode(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: the key, n_tokens, ids_sha256 and decoded_sha256."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(model)
        for b in batches:
            rows = [c.digest(t) for t in b["t"]]
            yield pd.DataFrame({"k": b["k"], "n_tokens": [r[0] for r in rows], "ids_sha256": [r[1] for r in rows], "decoded_sha256": [r[2] for r in rows]})
        release()

    d = docs.select(docs[key].alias("k"), docs[text].alias("t"))
    kind = d.schema["k"].dataType.simpleString()
    out = d.mapInPandas(run, f"k {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("k", key)


def token_ids(docs: DataFrame, model: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """``docs`` with the ids of every text, the end id last, in a new column."""
    from pyspark.sql import functions as F

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = codec(model)
        for b in batches:
            yield pd.Series([c.encode(t) + [c.end_id] for t in b])

    return docs.withColumn(ids, encode(docs[text]))


def decoded(df: DataFrame, model: str, ids: str = "token_ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of every id list in a new column; null stays null."""
    from pyspark.sql import functions as F

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = codec(model)
        for b in batches:
            yield pd.Series([None if x is None else c.decode(list(x)) for x in b])

    return df.withColumn(text, decode(df[ids]))
