"""Reachability: exact depths and the number of rounds on graphs of several shapes."""

import os
from collections import deque

import pytest

from parcelflow.operators import links
from parcelflow.session import shared_dir
from conftest import rows


def _depths(edges, seeds):
    out, queue = {s: 0 for s in seeds}, deque(seeds)
    after = {}
    for a, b in edges:
        after.setdefault(a, []).append(b)
    while queue:
        a = queue.popleft()
        for b in after.get(a, []):
            if b not in out:
                out[b] = out[a] + 1
                queue.append(b)
    return sorted(out.items())


def _run(spark, edges, seeds, **kw):
    e = spark.createDataFrame(edges, "src long, dst long")
    s = spark.createDataFrame([(x,) for x in seeds], "node long")
    got, rounds = links.reachable_in_rounds(e, s, **kw)
    assert sorted((r["node"], r["depth"]) for r in got.collect()) == _depths(edges, seeds)
    return rounds


def test_chain_of_a_thousand_takes_rounds_of_its_logarithm(spark):
    assert _run(spark, [(k, k + 1) for k in range(1000)], [0]) <= 20


def test_chain_with_leaves_and_a_cycle(spark):
    chain = [(k, k + 1) for k in range(200)] + [(k, 10_000 + k) for k in range(200)] + [(k, 20_000 + k) for k in range(0, 200, 3)]
    assert _run(spark, chain, [0, 77]) <= 24
    assert _run(spark, [(k, (k + 1) % 300) for k in range(300)] + [(5, 5), (10, 290)], [3]) <= 20


def test_shallow_graphs_take_plain_rounds_only(spark, monkeypatch):
    monkeypatch.setattr(links, "_longer", lambda *a: pytest.fail("shortcuts for a shallow graph"))
    star = [(0, k) for k in range(1, 3000)] + [(k, 0) for k in range(1, 3000)]
    assert _run(spark, star, [0]) == 2
    assert _run(spark, [(k, 2 * k + 1) for k in range(7)] + [(k, 2 * k + 2) for k in range(7)], [0]) == 4
    assert _run(spark, [], [5]) == 1 and _run(spark, [(1, 2)], []) == 1


def test_branching_graphs_keep_exact_depths(spark):
    """Short cuts and detours of different length, hubs too wide for shortcuts, and a grid."""
    grid = [(r * 14 + c, q) for r in range(14) for c in range(14) for q in ([r * 14 + c + 1] if c < 13 else []) + ([r * 14 + c + 14] if r < 13 else [])]
    assert _run(spark, grid, [0]) <= 27
    hubs = [(k, k + 1) for k in range(60)] + [(k, 1000 + 50 * k + j) for k in range(0, 60, 10) for j in range(50)] + [(0, 40), (40, 25), (55, 2)]
    assert _run(spark, hubs, [0], plain_rounds=1, shortcuts=3) < 40
    _run(spark, hubs, [0], plain_rounds=2, merge_every=1)


def test_longer_shortcuts_are_bounded(spark):
    wide = spark.createDataFrame([(0, 1), *((1, 10 + k) for k in range(9)), (2, 3), (3, 4), (3, 2)], "src long, dst long")
    assert rows(links._longer(wide, 8), "src", "dst") == [(2, 4)]
    assert len(rows(links._longer(wide, 9), "src", "dst")) == 10


def test_superseded_tables_are_deleted(spark):
    folder = shared_dir(spark).removeprefix("file:").replace("//", "/")
    before = set(os.listdir(folder))
    _run(spark, [(k, k + 1) for k in range(300)], [0])
    left = [f.rsplit("-", 1)[0] for f in set(os.listdir(folder)) - before]
    assert left.count("depths") == 1 and left.count("visited") <= 1 and left.count("frontier") <= 2, sorted(left)


def test_nulls_are_no_nodes(spark):
    e = spark.createDataFrame([(0, 1), (None, 2), (1, None), (1, 1)], "src long, dst long")
    s = spark.createDataFrame([(0,), (None,), (0,)], "node long")
    assert rows(links.reachable(e, s), "node", "depth") == [(0, 0), (1, 1)]
