"""Whitening, ranked search and substring deduplication against brute force."""

import collections
import hashlib
import math
import re

import numpy as np
import pytest

from parcelflow.llm import ranked_search, substring_dedup, whitening

# ---- whitening ---------------------------------------------------------------


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, component int, n string")


def _plain_whitening(vectors):
    x = np.floor(1024 * np.asarray(vectors)) + 100000
    c = x - x.mean(0)
    e, v = np.linalg.eigh(c.T @ c / len(x))
    return x.astype(np.int64), e[::-1], c @ v[:, ::-1] / np.sqrt(np.maximum(e[::-1], 1e-300))


def test_whitening_equals_dense_eigenvectors(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(700, 48)) * np.linspace(3, 0.2, 48)
    rows = [(k, v.tolist(), 1, "x") for k, v in enumerate(vectors)]
    odd = [(800, None, 1, "x"), (801, [], 1, "x"), (802, [float("nan")] * 48, 1, "x"), (803, [float("inf")] + [0.0] * 47, 1, "x"), (804, [None] + [0.0] * 47, 1, "x"), (805, [1.0, 2.0], 1, "x")]
    got = whitening.whiten(_vectors(spark, rows + odd + [(None, vectors[0].tolist(), 1, "x"), rows[1]])).toPandas()
    x, e, want = _plain_whitening(np.concatenate([vectors, vectors[:2]]))
    n = len(x)
    assert len(got) == 8 * n and (got["n"] == n).all() and got["identity_error"].max() <= 1e-4 and got["identity_error"].nunique() == 1
    one = got[got["vec_id"].notna()].drop_duplicates(["vec_id", "component"]).sort_values(["component", "vec_id"])
    w = one["whitened"].to_numpy().reshape(8, 700).T
    want = want[:700, :8] * np.sign((want[:700, :8] * w).sum(0))
    assert np.abs(w - want).max() < 1e-9
    assert np.allclose(one.groupby("component")["explained"].first(), e[:8] / e.sum(), rtol=1e-9)
    exact = {k: sum((n * int(a) - int(s)) ** 2 for a, s in zip(x[k], x.sum(0))) for k in range(700)}
    assert all(exact[r.vec_id] == r.deviation for r in one.itertuples())


def test_whitening_edges(spark):
    assert whitening.whiten(_vectors(spark, [])).count() == 0
    assert whitening.whiten(_vectors(spark, [(1, [1.0, 2.0], 1, "x")] * 3)).count() == 0
    flat = whitening.whiten(_vectors(spark, [(k, [float(k), 5.0, 2.0 * k], 1, "x") for k in range(6)])).collect()
    assert {r["component"] for r in flat} == {1} and abs(flat[0]["explained"] - 1) < 1e-12  # one direction has variance
    huge = whitening.whiten(_vectors(spark, [(k, [k * 1e14, 1.0 - k], 1, "x") for k in range(4)])).collect()
    assert len(huge) >= 4 and all(r["deviation"] is None for r in huge)


def test_whitening_sums_and_deviation_are_exact_for_any_size():
    rng = np.random.default_rng(1)
    x = rng.integers(-(1 << 40), 1 << 40, (5, 3))
    c = whitening.Centre(5, [int(v) for v in x.sum(0)], 1 << 40)
    assert c.small and not c.square
    want = [sum((5 * int(a) - int(s)) ** 2 for a, s in zip(r, x.sum(0))) for r in x]
    assert c.deviation(x) == [v if v < 1 << 63 else None for v in want]
    wide = whitening.Centre(1 << 30, [1, 2, 3], 1 << 40)
    assert not wide.small and wide.numerators(x)[0, 0] == (1 << 30) * int(x[0, 0]) - 1


def test_chebyshev_finds_close_eigenvalues():
    rng = np.random.default_rng(5)
    q = np.linalg.qr(rng.normal(size=(120, 120)))[0]
    e = np.concatenate([[9, 8.99, 8.98, 8.97, 8.96, 8.95, 8.94, 8.93], np.linspace(8.9, 1, 112)])
    v = (q * e) @ q.T
    values, vectors = whitening.leading(lambda x: v @ x, 120, 8)
    assert np.allclose(values, e[:8], rtol=1e-12) and np.abs(np.abs((q[:, :8] * vectors).sum(0)) - 1).max() < 1e-9
    damped = whitening.filtered(lambda x: np.diag([0.0, 0.5, 1.0, 2.0]) @ x, np.eye(4), 0.0, 1.0, 2.0, degree=10)
    assert np.abs(np.diag(damped)[:3]).max() < 1e-6 and abs(damped[3, 3]) > 0.9


# ---- ranked search -----------------------------------------------------------


def _terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def _plain_search(docs, items, top=20):
    bags = [(i, collections.Counter(_terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = collections.Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for i, b in bags:
            m = 100 - 25 + (25 * sum(b.values()) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * b[t]) // (1000 * b[t] + 12 * m)) for t in _terms(text) if t in b)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def _search(spark, docs, items):
    d = spark.createDataFrame([(*r, 7, "s") for r in docs], "doc_id long, text string, score long, item_id string")
    i = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id int")
    return sorted((tuple(r) for r in ranked_search.search(d, i).select("item_id", "rank", "doc_id", "score").collect()), key=str)


def test_ranked_search_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(2)
    words = ["alpha", "Beta", "gamma", "δέλτα", "x1", "the", "The", "of", "É", "é"]
    text = lambda n: "".join(rng.choice(words) + rng.choice([" ", ", ", "-", "\n", "_"]) for _ in range(n))
    docs = [(int(k), text(int(rng.integers(0, 30)))) for k in rng.permutation(150)]
    docs += [(500 + k, "the of the alpha") for k in range(60)] + [(None, "alpha alpha"), (None, None), (700, None), (701, ""), (702, "?!"), (703, "beta " * 40000), (3, "gamma x1"), (3, "gamma x1"), (704, "É é É")]
    items = [(k, text(6)) for k in range(8)] + [(20, None), (21, ""), (22, "unknown words"), (23, "the of the alpha"), (24, "É")]
    monkeypatch.setattr(ranked_search, "ITEMS", 3)
    monkeypatch.setattr(ranked_search, "CLASSES", 16)
    assert _search(spark, docs, items) == _plain_search(docs, items)
    monkeypatch.setattr(ranked_search, "BLOCK_BYTES", 40)
    assert _search(spark, docs, [*items, (None, "alpha"), items[0]]) == _plain_search(docs, items)


def test_ranked_search_of_nothing(spark):
    assert _search(spark, [], [(1, "alpha")]) == [] and _search(spark, [(1, "alpha")], []) == [] and _search(spark, [(1, None)], [(1, None)]) == []


def test_members_of_one_class_stand_by_id(spark):
    docs = [(k, "one two") for k in range(100, 40, -1)] + [(7, "one two three four five six seven")]
    got = _search(spark, docs, [(1, "one"), (2, "seven")])
    assert [r for r in got if r[0] == 2] == [r for r in _plain_search(docs, [(2, "seven")])]
    assert sorted(r[2] for r in got if r[0] == 1) == [r[2] for r in sorted(_plain_search(docs, [(1, "one")]), key=lambda r: r[2])]


def test_terms_with_one_hash_raise(monkeypatch):
    monkeypatch.setattr(ranked_search, "words_of", lambda raw, at, space: (np.array([5, 5], np.uint64), np.array([0, 2])))
    with pytest.raises(ValueError, match="share a hash"):
        ranked_search.Block([(1, "one two")])


# ---- substring deduplication -------------------------------------------------


def _plain_dedup(docs, n=13):
    cut = [(i, re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())) for i, t in docs]
    least = {}
    for i, w in cut:
        for k in range(len(w) - n + 1):
            key, at = tuple(w[k : k + n]), math.inf if i is None else i
            least[key] = min(least.get(key, at), at)
    out = []
    for i, w in cut:
        gone = set()
        for k in range(len(w) - n + 1):
            if least[tuple(w[k : k + n])] < (math.inf if i is None else i):
                gone.update(range(k, k + n))
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest()))
    return sorted(out, key=str)


def _dedup(spark, docs):
    d = spark.createDataFrame([(*r, "x", 5) for r in docs], "doc_id long, text string, hits string, doc int")
    return sorted((tuple(r) for r in substring_dedup.deduplicate(d).collect()), key=str)


def _documents(rng):
    word = lambda: str(rng.choice(["a", "bb", "Ccc", "dé", "e.", "f", "of", "the"]))
    text = lambda n: "".join(word() + str(rng.choice([" ", "  ", "\n", "\t \x0b"])) for _ in range(n))
    shared = [text(int(n)) for n in (13, 14, 30, 60)]
    docs = [(int(k), text(int(rng.integers(0, 40))) + str(rng.choice([*shared, ""])) + text(int(rng.integers(0, 20)))) for k in rng.permutation(80)]
    docs += [(200 + k, docs[0][1]) for k in range(6)] + [(300, None), (301, ""), (302, " \n"), (None, shared[3]), (None, docs[1][1]), (5, docs[2][1]), (5, docs[2][1])]
    return docs + [(400, "w " * 300), (401, "w " * 20000 + "end"), (402, "x" * 200000 + " " + shared[2]), (403, shared[2] + "  y"), (404, " ".join(map(str, range(13)))), (405, " ".join(map(str, range(12))))]


def test_substring_dedup_equals_brute_force(spark, monkeypatch):
    docs = _documents(np.random.default_rng(4))
    want = _plain_dedup(docs)
    assert _dedup(spark, docs) == want
    monkeypatch.setattr(substring_dedup, "BUCKET", 4000)  # many buckets, hot minimisers
    monkeypatch.setattr(substring_dedup, "SEEN", 2)
    hot = substring_dedup.find_hot(spark.createDataFrame(docs, "doc_id long, text string"))
    assert len(hot.minimisers) and not len(hot.names) and hot.size > 100_000
    assert _dedup(spark, docs) == want
    monkeypatch.setattr(substring_dedup, "OFTEN", 4)  # hot strings
    monkeypatch.setattr(substring_dedup, "TEXTS", 3000)
    monkeypatch.setattr(substring_dedup, "RUN", 9000)
    hot = substring_dedup.find_hot(spark.createDataFrame(docs, "doc_id long, text string"))
    assert len(hot.names) > 10
    assert _dedup(spark, docs) == want


def test_substring_dedup_of_nothing(spark):
    assert _dedup(spark, []) == [] and _dedup(spark, [(1, None)]) == [(1, 0, 0, hashlib.sha256(b"").hexdigest())]


def test_windows_with_one_hash_are_told_apart(monkeypatch):
    strings = [" ".join(f"{c}{k}" for k in range(14)).encode() for c in "abc"]
    monkeypatch.setattr(substring_dedup, "ngrams", lambda w, n: np.zeros(max(0, len(w) - n + 1), np.uint64))
    _, cut, mins = substring_dedup.least_ids([*strings, strings[2] + b" more"], np.array([4, 2, 3, 1]))
    assert cut.tolist() == [0, 2, 4, 6, 9] and mins.tolist() == [4, 4, 2, 2, 1, 1, 1, 1, 1]


def test_packets_hold_any_integers():
    columns = [np.array([0, -1, 1 << 62, -(1 << 63), (1 << 63) - 1]), np.zeros(0, np.int64), np.arange(1000)]
    got, body = substring_dedup._unpacked(substring_dedup._packed(*columns, body=b"rest"))
    assert body == b"rest" and all((a == b).all() for a, b in zip(got, columns, strict=True))


def test_strings_cover_every_window_once():
    rng = np.random.default_rng(0)
    texts = [" ".join(map(str, rng.integers(0, 30, n))) for n in (0, 12, 13, 500, 40)]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    for hot in (np.zeros(0, np.uint64), np.unique(substring_dedup.Strings(raw, at, np.zeros(0, np.uint64)).minimiser)[::2]):
        s = substring_dedup.Strings(raw, at, hot)
        found = collections.Counter()
        for string, text, first, n in zip(s.packed(), s.text, s.first - s.at[s.text], s.length):
            words = string.decode().split(" ")
            assert len(words) == n + 12
            for k in range(n):
                found[(int(text), int(first) + k, tuple(words[k : k + 13]))] += 1
        want = {(d, k, tuple(t.split(" ")[k : k + 13])) for d, t in enumerate(texts) for k in range(len(t.split(" ")) - 12)}
        assert set(found) == want and set(found.values()) == {1}
