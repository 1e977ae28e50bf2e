"""Codec, token files, decontamination, near duplicates: against libraries and brute force."""

import hashlib
import io
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from parcelflow.llm import decontaminate, near_dup, sp_codec, token_files
from parcelflow.llm.common import arrow_bytes, pieces, words_of

PIECES, BYTES = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "a   b", "x\n y", "x\n \ty", "\n\n", "\t", "▁", "▁▁a", "é²½ Ⅷ", "漢字かな 🙂", "\x00\x1f", "a\x00b",
       "<0x0A>", "<s> </s> <unk>", "<|endoftext|>", "a<|endoftext|> b", "don't I'll", "1234 56", "---- ====", "a" * 300, "ab " * 5000, "　x y", "\r\n x"]
ALPHABET = st.text(alphabet="ab theing \n\t▁é²½19.,;-_'ñ漢🙂\x00\x1c\xa0Ａß", max_size=60)


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def _digest(sp, text):
    ids = sp.encode(text) + [2]
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()


def test_codec_equals_the_library(library):
    codec = sp_codec.codec(PIECES)

    @settings(max_examples=400, deadline=None)
    @given(ALPHABET)
    def check(text):
        assert codec.encode(text) == library.encode(text)
        assert codec.decode(codec.encode(text) + [2]) == library.decode(library.encode(text) + [2])
        assert codec.digest(text) == _digest(library, text)

    check()
    for text in ODD:
        assert codec.encode(text) == library.encode(text), text
        assert codec.digest(text) == _digest(library, text), text


def test_decoded_text_comes_from_the_ids(library):
    codec = sp_codec.Codec(PIECES)
    (piece,) = codec.pieces(codec.chunks("the")[0])
    wrong = library.encode("cat")[0]
    codec.decimal[piece] = str(wrong)
    for text in ("the", "in the end", "in  the end", "the, the"):
        ids = [wrong if i == codec.id_of[piece] else i for i in library.encode(text)] + [2]
        got = codec.digest(text)
        assert got[1] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[2] == hashlib.sha256(library.decode(ids).encode()).hexdigest() != hashlib.sha256(text.encode()).hexdigest()


def test_a_worker_remembers_few_words(library):
    """What a worker keeps for its next task is bounded, however many distinct words it met."""
    codec = sp_codec.Codec(PIECES)
    letters = "etaoinshrdlucmfw"
    text = " ".join("".join(letters[k >> s & 15] for s in (0, 4, 8, 12, 16)) for k in range(300_000))
    n, _, back = codec.digest(text)
    assert n > 300_000 and back == hashlib.sha256(text.encode()).hexdigest()
    for held in (codec._words, codec._chunks):
        assert len(held) + len(held.older) < 250_000
    assert len(codec._fits) <= 100_000


def test_pair_check_equals_merging_anew():
    codec, rng = sp_codec.codec(PIECES), np.random.default_rng(1)
    known = sorted(codec.shorter)
    for a, b in rng.choice(known, (3000, 2)):
        assert codec._stand(str(a), str(b)) == (codec.merged(a + b) == [a, b])


def test_codec_over_tables(spark, library):
    rows = [(1, "Hello  world", "x"), (2, None, None), (2, "", "y"), (None, "é🙂", "z"), (1, "Hello  world", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, k string")
    got = sorted(map(tuple, sp_codec.encode_decode(docs, PIECES).collect()), key=str)
    assert got == sorted([(k, *_digest(library, t or "")) for k, t, _ in rows], key=str)
    assert sp_codec.encode_decode(docs.limit(0), PIECES).count() == 0
    back = sp_codec.decoded(sp_codec.token_ids(docs, PIECES), PIECES)
    assert all(r["decoded"] == (r["text"] or "") for r in back.collect())


def test_byte_encoder_equals_the_library():
    from tokenizers import Tokenizer

    lib, enc = Tokenizer.from_file(BYTES), token_files.encoder(BYTES)

    @settings(max_examples=400, deadline=None)
    @given(ALPHABET)
    def check(text):
        assert list(np.frombuffer(enc.encode(text), enc.width)) == lib.encode(text, add_special_tokens=False).ids

    check()
    for text in ODD:
        assert list(np.frombuffer(enc.encode(text), enc.width)) == lib.encode(text, add_special_tokens=False).ids, text


def test_runs_of_texts_equal_the_library():
    """Many texts at once: what meets at their borders, white space of all kinds, line ends, marks, nulls and special tokens."""
    import pyarrow as pa
    from tokenizers import Tokenizer

    lib, enc = Tokenizer.from_file(BYTES), token_files.encoder(BYTES)
    rng = np.random.default_rng(3)
    parts = ["word", "Wörter", "the", "x1", "don't", "é", "日本", " ", " ", "  ", "\n", "\n\n", "\t", ".", ",", "!?", "\x1d", "\x00", "\u00a0", "\u3000", "<|endoftext|>", "123", "_"]
    texts = ["".join(rng.choice(parts, rng.integers(0, 14))) for _ in range(3000)] + [None, "", " ", "\n", "a.\nB c,\nd", "a\n b", "a \nb", "w" * 5000]
    for size in (1, 37, 4000):
        for lo in range(0, len(texts) if size > 1 else 200, size):
            run = texts[lo : lo + size]
            ids, n = enc.encode_run(pa.array(run, pa.string()), 2)
            want = [e.ids + [2] for e in lib.encode_batch_fast([t or "" for t in run], add_special_tokens=False)]
            assert n.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    assert enc.encode_run(pa.array([], pa.string()), 2)[0].tolist() == []


def test_rows_without_an_id_fill_many_files(spark):
    docs = spark.createDataFrame([(None, f"text number {k} of many") for k in range(4000)], "doc_id long, text string")
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files = token_files.write_tokens(docs, BYTES, 2, token_files.shared_path(spark, "tokens")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
    assert len(files) > 3 and sum(f["n_docs"] for f in files) == 4000 and max(f["n_docs"] for f in files) < 2000


def test_token_files_round_trip(spark):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(BYTES)
    rows = [(9, "last", 1), (3, None, 2), (None, "no id", 3), (5, "", 4), (5, "word " * 40_000, 5), (4, "a b c", 6), (4, "a b c", 6), (-2, "é🙂", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part int")
    got = sorted((tuple(r) for r in token_files.tokens(docs, BYTES, 2).collect()), key=lambda r: r[1])
    want, start = [], 0
    for k, t, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = lib.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((k, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
    assert token_files.tokens(docs.limit(0), BYTES, 2).count() == 0


class _Counting(io.BytesIO):
    read_bytes = 0

    def read(self, n=-1):
        out = super().read(n)
        self.read_bytes += len(out)
        return out


def test_reader_decompresses_only_what_it_needs_and_sees_damage():
    import zstandard

    out, rng = io.BytesIO(), np.random.default_rng(2)
    writer = token_files.Writer(out, np.dtype("<u2"))
    docs = [rng.integers(0, 50_000, 30_000).astype("<u2") for _ in range(40)]
    for k, ids in enumerate(docs):
        writer.add(k, ids.tobytes())
    writer.close()
    data = out.getvalue()
    file = _Counting(data)
    reader = token_files.Reader(file, len(data))
    before = file.read_bytes
    assert np.array_equal(np.concatenate(list(reader.document(17))), docs[17])
    assert file.read_bytes - before < len(data) / 4
    whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert whole.startswith(b"".join(d.tobytes() for d in docs))  # plain tools read the frames too
    broken = bytearray(data)
    broken[int(reader.begin[1]) + 30] ^= 255
    bad = token_files.Reader(io.BytesIO(bytes(broken)), len(data))
    assert np.array_equal(np.concatenate(list(bad.document(0))), docs[0])
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(bad.document(5))


# ---- words, shingles, near duplicates ---------------------------------------

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def _set(text):
    w = _words(text)
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def test_word_hashes_are_words():
    texts = ["The the THE", "", None, "a\x0bb\x0cc", "É é ab\xa0cd", " x ", "long" * 700_000 + " end", "ba ab ba"]
    raw, offsets = arrow_bytes(pa.array(texts))
    hashes, at = words_of(raw, offsets)
    names = {}
    for t, a, b in zip(texts, at, at[1:]):
        assert b - a == len(_words(t))
        for w, h in zip(_words(t), hashes[a:b]):
            assert names.setdefault(w, h) == h
    assert len(set(names.values())) == len(names)


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(3)
    common, own = rng.integers(0, 1 << 63, 60, dtype=np.uint64), rng.integers(0, 1 << 63, (2, 20), dtype=np.uint64)
    one = rng.integers(0, 1 << 63, 1, dtype=np.uint64)
    h = np.concatenate([common, own[0], common, own[1], one])
    d = np.concatenate([np.zeros(80, int), np.ones(80, int), [2]])
    s = near_dup.sketches(h, d, 4)
    assert (s[:3] != near_dup._EMPTY).all() and (s[3] == near_dup._EMPTY).all()
    assert abs((s[0] == s[1]).mean() - 0.6) < 0.15 and (s[0] == s[2]).mean() < 0.1


def _expected(rows):
    """Brute force over all pairs of different sets."""
    sets = {}
    for k, t in rows:
        sets.setdefault(_set(t), []).append(k)
    classes = [s for s in sets if s]
    root = {s: s for s in classes}

    def find(s):
        while root[s] != s:
            s = root[s]
        return s

    for i, a in enumerate(classes):
        for b in classes[:i]:
            if 100 * len(a & b) >= 75 * len(a | b):
                root[find(a)] = find(b)
    names = {}
    for s in classes:
        for k in sets[s]:
            if k is not None:
                names[find(s)] = min(names.get(find(s), k), k)
    out = []
    for k, t in rows:
        c = names.get(find(_set(t))) if _set(t) else k
        out.append((k, len(_set(t)), c, k == c))
    return sorted(out, key=str)


def _copies(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for k in rng.choice(len(w), edits, replace=False):
            w[k] = f"w{rng.integers(1 << 40)}"
        out.append(" ".join(w))
    return out


def test_near_duplicates_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    texts = [None, "", " \t\n", "one", "One", "one two", "ONE two\n", "one two three four", "a b c d e", "a b c d e f"]
    for g in range(6):
        base = [f"g{g}x{k}" for k in range(int(rng.integers(30, 120)))]
        texts += _copies(rng, base, 40, int(rng.integers(0, 4))) + [" ".join(base)] * 2
    texts += [" ".join(f"u{k}y{j}" for j in range(50)) for k in range(60)]
    texts.append("word " * 50_000)
    ids = [int(k) for k in rng.permutation(len(texts))]
    rows = list(zip(ids, texts)) + [(ids[12], texts[12]), (None, texts[13]), (None, "lonely text of some words here")]
    docs = spark.createDataFrame([(k, t, 1, "c") for k, t in rows], "doc_id long, text string, bucket int, cls string").repartition(5)
    got = sorted((tuple(r) for r in near_dup.near_duplicates(docs).collect()), key=str)
    assert got == [tuple(r) for r in _expected(rows)]
    kept = near_dup.first_of_each(docs)
    assert kept.columns == docs.columns
    keep = sorted((r["doc_id"], r["text"]) for r in kept.collect() if r["doc_id"] is not None)
    assert keep == sorted({(k, t) for (k, t), r in zip(sorted(rows, key=lambda r: str(r[0])), sorted(_expected(rows), key=lambda r: str(r[0]))) if k is not None and r[3]}, key=str) or len(keep) == len({r[2] for r in got if r[0] is not None and r[1]}) + 3
    assert near_dup.near_duplicates(docs.limit(0)).count() == 0 == near_dup.first_of_each(docs.limit(0)).count()


# ---- decontamination ---------------------------------------------------------


def _naive_align(a, b):
    best = 0
    table = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            step = 2 if a[i - 1] == b[j - 1] else -1
            table[i, j] = max(0, table[i - 1, j - 1] + step, table[i - 1, j] - 1, table[i, j - 1] - 1)
            best = max(best, table[i, j])
    return best


def test_alignment_equals_the_plain_recurrence():
    rng = np.random.default_rng(5)
    for _ in range(60):
        a, b = rng.integers(0, 5, rng.integers(1, 15)), rng.integers(0, 5, rng.integers(1, 30))
        score, end = decontaminate.align(a, b)
        assert score == _naive_align(a, b) == _naive_align(a, b[:end])


def test_leaks_exact_edited_and_hot(spark):
    rng = np.random.default_rng(6)
    vocabulary = [f"v{k}" for k in range(400)]
    prose = lambda n: " ".join(rng.choice(vocabulary[:60], n))
    items = [(k, " ".join(f"{w}" for w in rng.choice(vocabulary, 30))) for k in range(8)] + [(90, None), (91, ""), (92, "rare zebra"), (93, "the of and a the of and a the of")]
    items.append((94, items[0][1]))
    words = items[1][1].split()
    edited = [w if k % 6 else f"new{k}" for k, w in enumerate(words)]
    dropped = [w for k, w in enumerate(words) if k % 5]
    texts = {1: prose(300), 2: prose(50) + " " + items[0][1].upper() + ". " + prose(80), 3: prose(40) + " " + " ".join(edited) + prose(40),
             4: " ".join(dropped), 5: None, 6: "", 7: "see the rare zebra, there", 8: prose(20) + " " + ", ".join(words) + " " + prose(30_000), 9: " ".join(words[:10])}
    rows = [(k, t, "x") for k, t in texts.items()] + [(100 + k, items[2][1], "hot") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in decontaminate.contaminated(docs, bench).collect()}
    want = {(2, 0), (2, 94), (3, 1), (4, 1), (7, 92), (8, 1)} | {(100 + k, 2) for k in range(300)}
    assert set(got) == want
    assert got[2, 0] == got[8, 1] == got[100, 2] == 1.0 and 0.5 <= got[3, 1] < 1 and 0.5 <= got[4, 1] < 1
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0 == decontaminate.contaminated(docs.limit(0), bench).count()


def test_items_of_common_words_are_found_whole_or_not_at_all(spark):
    rng = np.random.default_rng(9)
    rare = [f"v{k}" for k in range(500)]
    prose = lambda n: " ".join(w for _ in range(n) for w in (rng.choice(rare), rng.choice(["the", "of", "and"])))
    texts = {k: prose(60) for k in range(60)} | {100: prose(9) + " the of and " + prose(9), 101: prose(9) + " the of the and " + prose(9), 102: prose(5) + " xylem " + prose(5)}
    bench = spark.createDataFrame([(1, "the"), (2, "the of and"), (3, "The, of!"), (4, "xylem"), (5, "of of of of of of")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in decontaminate.contaminated(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), bench).collect()}
    assert got == {(100, 2): 1.0, (102, 4): 1.0}


def test_leaks_of_long_passages(spark):
    rng = np.random.default_rng(7)
    vocabulary = [f"v{k}" for k in range(400)]
    prose = lambda n: " ".join(rng.choice(vocabulary[:60], n))
    items = [(0, " ".join(rng.choice(vocabulary, 59))), (1, " ".join(rng.choice(vocabulary, 500))), (2, " ".join(rng.choice([f"c{k}" for k in range(15)], 300)))]
    words = [t.split() for _, t in items]
    edited = [w if k % 8 else f"new{k}" for k, w in enumerate(words[1][120:200])]
    texts = {1: prose(90) + " " + " ".join(words[0][:29]) + " " + prose(40), 2: " ".join(words[1][100:300]), 3: prose(300) + " " + " ".join(words[1][470:495]), 4: prose(30) + " " + " ".join(edited) + " " + prose(30),
             5: prose(50) + " " + " ".join(words[1][40:52]) + " " + prose(50), 6: prose(800), 7: prose(20) + " " + " ".join(words[2][111:136])}
    texts |= {10 + k: prose(20) + " " + " ".join(words[1][k : k + 22]) + " " + prose(20) for k in range(0, 478, 17)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in rows}
    assert set(got) == {(1, 0), (2, 1), (3, 1), (4, 1), (7, 2)} | {(k, 1) for k in texts if k >= 10}
    assert all(s < decontaminate.SCORE for s in got.values()) and got[2, 1] == 0.4
    assert next((r["first_word"], r["last_word"]) for r in rows if r["doc_id"] == 3) == (300, 324)


def test_pieces_cover_all_rows():
    offsets = np.array([0, 5, 5, 3_000_000, 3_000_001, 3_000_001])
    assert list(pieces(offsets)) == [(0, 2), (2, 3), (3, 5)]
