"""Language, toxicity, licences, sharding, HTML, vectors and the pipeline."""

import collections
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelflow.llm import decontaminate, html_text, lang_id, license_scan, near_dup, queries, sharding, toxicity, vector_search

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()
    assert set(queries.oracle_sql()) <= set(queries.queries())


# ---- language ----------------------------------------------------------------


def _plain_network(net, window):
    """The same network, position by position."""
    top = []
    for w, conv, bias in zip(lang_id.WIDTHS, net.conv, net.bias):
        sums = [sum(conv[k][window[i + k]] for k in range(w)) for i in range(len(window) - w + 1)]
        top.append(np.max(sums, 0) + bias)
    z = np.maximum(np.concatenate(top), 0) @ net.out + net.out_bias
    return np.exp(z - z.max()) / np.exp(z - z.max()).sum()


def test_network_equals_plain_convolution_and_covers_whole_texts():
    net = lang_id.Network(["a", "b", "c"])
    rng = np.random.default_rng(1)
    x = rng.integers(0, 256, (3, lang_id.WINDOW)).astype(np.uint8)
    assert np.allclose(net.probabilities(x), [_plain_network(net, r) for r in x], atol=1e-5)
    texts = [b"", b"ab", bytes(rng.integers(1, 256, 1000).astype(np.uint8)), bytes(rng.integers(1, 256, 256).astype(np.uint8))]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = net.documents(np.frombuffer(b"".join(texts), np.uint8), offsets)
    for t, p in zip(texts, got):
        cuts, at = [], 0
        while t and (at == 0 or at + max(lang_id.WIDTHS) - 1 < len(t)):
            cuts.append(t[at : at + lang_id.WINDOW])
            at += lang_id.WINDOW - max(lang_id.WIDTHS) + 1
        want = sum(len(c) * _plain_network(net, np.frombuffer(c.ljust(lang_id.WINDOW, b"\0"), np.uint8)) for c in cuts) / sum(map(len, cuts)) if t else 0
        assert np.allclose(p, want, atol=1e-5)


def test_language_sample_holds_every_language(spark, monkeypatch):
    rows = [(k, f"text {k} of language {k % 530}", f"l{k % 530}") for k in range(1060)] + [(5000 + k, f"more {k}", "l0") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    names = lambda: [r["label"] for r in lang_id.training_windows(docs, "doc_id", "text", "lang").collect()]
    assert len(set(names())) == 530
    monkeypatch.setattr(lang_id, "ROWS", 5300)
    got = names()
    assert len(set(got)) == 530 and got.count("l0") < 40


def test_language_held_out_accuracy_and_edges(spark):
    got = queries.queries()["op2_language"](spark, SF01).join(spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = got.where("held_out").select("lang", "lang_pred").collect()
    assert np.mean([r[0] == r[1] for r in held]) > 0.95
    docs = spark.createDataFrame([(k, f"{'the of and' if k % 2 else 'der die und'} {k} words", "en" if k % 2 else "de", "x") for k in range(60)]
                                 + [(100, None, "en", "x"), (101, "", "en", "x"), (102, "123 !?", None, "x"), (None, "the and", None, "x"), (3, "the of and 3 words", "en", "x")],
                                 "doc_id long, text string, lang string, score string")
    net = lang_id.fit(docs)
    rows = docs.select("doc_id", lang_id.predicted(net, docs).alias("p")).select("doc_id", "p.*").collect()
    by = {r["doc_id"]: r for r in rows}
    assert len(rows) == 65 and all(by[k]["lang_pred"] == "und" and by[k]["score"] == 0 for k in (100, 101, 102))
    assert by[1]["lang_pred"] == "en" and by[2]["lang_pred"] == "de" and all(0 <= r["score"] <= 1 for r in rows)
    none = lang_id.fit(docs.limit(0))
    assert {r[0] for r in docs.select(lang_id.predicted(none, docs)["lang_pred"]).collect()} == {"und"}


# ---- toxicity ----------------------------------------------------------------


def test_label_model_finds_accuracies_and_repeating_voters():
    rng = np.random.default_rng(2)
    y = rng.random(4000) < 0.2
    rates = [(0.02, 0.7), (0.05, 0.6), (0.3, 0.35), (0.01, 0.5)]
    votes = np.array([[rng.random() < r[int(t)] for r in rates] for t in y], float)
    votes = np.column_stack([votes, votes[:, 2], votes[:, 2]])  # one voter repeated
    model = toxicity.LabelModel().fit(votes, np.where(y ^ (rng.random(4000) < 0.1), 0.95, 0.05))
    assert abs(model.fires[1][0] - 0.7) < 0.15 and model.fires[0][0] < 0.1
    assert model.weight[2] < 0.6 and model.weight[0] > 0.6
    q = model.posterior(votes)
    assert q[y].mean() > q[~y].mean() + 0.3


def test_toxicity_held_out_and_edges(spark):
    got = queries.queries()["op3_toxicity"](spark, SF01).join(spark.read.parquet(f"{SF01}/labels.parquet"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    hit = sum(r["predicted"] == 1 and r["toxic"] == 1 for r in held)
    assert hit / max(1, sum(r["predicted"] for r in held)) > 0.8 and hit / sum(r["toxic"] for r in held) > 0.5
    docs = spark.createDataFrame([(k, f"some plain words {k}" + (" you are an idiot" if k % 4 == 0 else "") + f" tail{k * 7}", 1) for k in range(400)]
                                 + [(1000, None, 0), (1001, "", 0), (None, "you are an idiot", 0), (8, "some plain words 8 you are an idiot tail56", 1)], "doc_id long, text string, toxic int")
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(400)] + [(5, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    s = {r[0]: r[1] for r in docs.select("text", toxicity.scored(model, docs)).collect()}
    assert s["you are an idiot"] > 0.5 and s[None] == s[""] < 0.3 and all(0 <= v <= 1 for v in s.values())
    one = toxicity.fit(docs, labels.where("toxic = 0"))
    assert one.score("idiot") < 0.01 and toxicity.fit(docs.limit(0), labels.limit(0)).score(None) < 0.01


# ---- licences ------------------------------------------------------------------


def test_licenses_own_inherited_and_none(spark):
    files = [("a/LICENSE", "Some text\nReleased under the MIT License.\n"), ("a/x.txt", "nothing"), ("a/b/c/y.txt", None), ("a/b/COPYING.md", "Licensed under the Apache License, Version 2.0."),
             ("a/b/c/z.txt", "code\n" * 50 + "This work is licensed under the GNU General Public License, version 3\nmore"), ("a/x.txt", "nothing"), ("d/e.txt", ""), ("LICENSE.txt", "no terms here"),
             ("a/b/n.txt", "we may license the band's song someday to anyone who would like to sing along with it"), (None, "Licensed under CC BY-NC 4.0.")]
    df = spark.createDataFrame([(k, *f) for k, f in enumerate(files)], "folder_id int, path string, text string")
    got = {r["folder_id"]: (r["license"], r["origin"], r["from_folder"]) for r in license_scan.scan(df, keep=("folder_id",)).collect()}
    assert got == {0: ("MIT", "own", None), 1: ("MIT", "inherited", "a"), 2: ("Apache-2.0", "inherited", "a/b"), 3: ("Apache-2.0", "own", None), 4: ("GPL-3.0", "own", None),
                   5: ("MIT", "inherited", "a"), 6: (None, "none", None), 7: (None, "none", None), 8: ("Apache-2.0", "inherited", "a/b"), 9: ("CC-BY-NC-4.0", "own", None)}
    assert license_scan.scan(df.limit(0)).count() == 0


def test_licenses_full_texts_headers_and_reservations(spark):
    full = {lic: max((t for x, t in license_scan.TEMPLATES if x == lic), key=len) for lic, _ in license_scan.TEMPLATES}
    wrap = lambda text, mark="", n=70: "\n".join(mark + w for w in __import__("textwrap").wrap(text, n))
    mine = "Copyright (c) 2019 Some Body. All rights reserved.\n\n"
    files = [("a/LICENSE", mine + wrap(full["BSD-3-Clause"])), ("b/LICENSE", mine + wrap(full["BSD-2-Clause"])), ("c/COPYING", "Copyright 2020 Nobody\n\n" + wrap(full["ISC"])), ("d/LICENSE.md", "The MIT License\n\n" + wrap(full["MIT"])),
             ("e/x.py", wrap(full["GPL-2.0"], "# ") + "\n\nimport os\n"), ("e/y.c", "/*\n" + wrap(full["Apache-2.0"]) + "\n*/\nint main;\n"), ("e/z.js", wrap(full["ISC"], "// ", 40) + "\nvar x;\n"), ("e/w.c", "/*\n" + wrap(full["GPL-3.0"], " * ") + "\n */\n"),
             ("f/x.txt", "Prose.\nAll rights reserved.\nMore prose."), ("f/y.txt", "All rights reserved.\nReleased under the MIT License, as is."), ("g/x.txt", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
             ("g/y.txt", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted"), ("h/LICENSE", "All rights reserved."), ("h/x", "nothing"), ("h/y", "People use a version of this part, and the others see it.")]
    got = {r["path"]: (r["license"], r["origin"]) for r in license_scan.scan(spark.createDataFrame(files, "path string, text string")).collect()}
    want = dict(zip([p for p, _ in files], ["BSD-3-Clause", "BSD-2-Clause", "ISC", "MIT", "GPL-2.0", "Apache-2.0", "ISC", "GPL-3.0", "proprietary", "MIT", "BSD-3-Clause", "ISC", "proprietary"]))
    assert {p: x for p, (x, _) in got.items() if p in want} == want and all(got[p][1] == "own" for p in want)
    assert got["h/x"] == got["h/y"] == ("proprietary", "inherited")


def test_license_cosine_equals_brute_force(spark):
    lines = ["Released under the MIT License.", "Licensed under the Apache License, Version 1.1", "License: see the file", "All rights reserved"]
    files = spark.createDataFrame([(f"f{k}", t) for k, t in enumerate(lines + lines[:1])], "path string, text string")
    got = {r["path"]: (r["license"], r["score"]) for r in license_scan.scan(files).collect()}
    import re

    words = lambda t: re.findall(r"[^\W_]+(?:[.-][^\W_]+)*", t.lower())
    corpus = [words(t) for t in lines + lines[:1]] + [words(t) for _, t in license_scan.TEMPLATES]
    df = collections.Counter(w for d in corpus for w in set(d))
    vec = lambda d: {w: n * (np.log((1 + len(corpus)) / (1 + df[w])) + 1) for w, n in collections.Counter(d).items()}
    cos = lambda a, b: sum(a[w] * b.get(w, 0) for w in a) / np.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
    for k, t in enumerate(lines):
        kept = lambda lic: all(m & set(words(t)) for m in license_scan.RULES.get(lic, ([], set()))[0]) and not license_scan.RULES.get(lic, ([], set()))[1] & set(words(t))  # noqa: E731, B023
        best = max((round(cos(vec(words(t)), vec(words(x))), 6), lic) for lic, x in license_scan.TEMPLATES if kept(lic))
        assert got[f"f{k}"] == ((best[1], pytest.approx(best[0], abs=2e-6)) if best[0] >= license_scan.ENOUGH else (None, None))
    assert got["f0"][0] == "MIT" and got["f1"] == (None, None)  # another version is another licence


def test_spdx_lines_name_what_they_spell(spark):
    ids = sorted({lic for lic, _ in license_scan.TEMPLATES if lic != "proprietary"}) + ["GPL-3.0-or-later", "BSD-4-Clause", "0BSD", "LicenseRef-Mine", "Apache-1.1", "MIT-0", "CC-BY-3.0"]
    files = [(f"f{k}", f"// SPDX-License-Identifier: {x}\nint main;") for k, x in enumerate(ids)] + [("e1", "# SPDX-License-Identifier: (MIT OR Apache-2.0)"), ("e2", "/* SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0 */"), ("e3", "SPDX-License-Identifier:")]
    files += [(f"m{k}", "Released under the MIT License.") for k in range(400)]
    got = {r["path"]: r["license"] for r in license_scan.scan(spark.createDataFrame(files, "path string, text string")).collect()}
    assert [got[f"f{k}"] for k in range(len(ids))] == ids
    assert got["e1"] == "MIT OR Apache-2.0" and got["e2"] == "GPL-2.0-only WITH Classpath-exception-2.0" and got["e3"] is None and got["m7"] == "MIT"


def test_variants_and_versions_are_told_apart(spark):
    lines = {f"Licensed under CC {v} 4.0": f"CC-{v}-4.0" for v in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")}
    lines |= {f"This work is licensed under a Creative Commons {long} 4.0 International License": f"CC-{v}-4.0" for v, long in (("BY", "Attribution"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"))}
    lines |= {"Apache License, Version 1.1": None, "Licensed under the Apache License, Version 1.1": None, "Licensed under the GNU Affero General Public License, version 3": "AGPL-3.0",
              "Licensed under the GNU Lesser General Public License, version 3": "LGPL-3.0", "Licensed under CC BY-NC 3.0": None, "Released under the Unlicense": "Unlicense", "Licensed under the WTFPL": "WTFPL",
              "Licensed under the Artistic License 2.0": "Artistic-2.0", "Released under the zlib License": "Zlib"}
    full = {lic: max((t for x, t in license_scan.TEMPLATES if x == lic), key=len) for lic, _ in license_scan.TEMPLATES}
    lines |= {full[x]: x for x in ("EPL-1.0", "EPL-2.0", "BSL-1.0", "Zlib", "Unlicense", "WTFPL", "MIT", "ISC")}
    files = [(f"f{k}", t) for k, t in enumerate(lines)] + [(f"m{k}", "Released under the MIT License.") for k in range(400)]
    got = {r["path"]: r["license"] for r in license_scan.scan(spark.createDataFrame(files, "path string, text string")).collect()}
    assert {t: got[f"f{k}"] for k, t in enumerate(lines)} == lines
    named = [("MIT-LICENSE.txt", True), ("UNLICENSE", True), ("LICENSE-MIT", True), ("Apache-2.0-LICENCE", True), ("licenses.py", True), ("relicense", False), ("src-licensed.c", True), ("a.txt", False)]
    assert [spark.createDataFrame([(n,)], "n string").select(F.col("n").rlike(license_scan._FILE)).first()[0] for n, _ in named] == [x for _, x in named]


def test_licences_in_long_chains_and_blank_lines(spark):
    """Megabytes of hyphens, numbers and blank lines beside a notice: no stack, and the notice is found."""
    mit = "Released under the MIT License."
    files = [("a", "license " + "a-" * 2_500_000 + "\n" + mit), ("b", "copyright " + "1." * 1_000_000 + "\n" + mit), ("c", mit + "\n" * 100_000 + "All rights reserved."),
             ("d", mit + "\n" + " \t\n" * 100_000 + "copyright"), ("e", "/* " + "* " * 500_000 + "\n" + mit), ("f", ("license text. " * 20_000) + "\n" + mit), ("g", "SPDX-License-Identifier: " + "MIT OR " * 100_000 + "MIT")]
    got = {r["path"]: r["license"] for r in license_scan.scan(spark.createDataFrame(files, "path string, text string")).collect()}
    assert {p: got[p] for p in "abcdef"} == dict.fromkeys("abcdef", "MIT") and got["g"].startswith("MIT OR MIT")


# ---- sharding -------------------------------------------------------------------


def test_sharding_laws(spark):
    rng = np.random.default_rng(3)
    rows = [(k, "x" * int(rng.integers(0, 4000)), 0) for k in range(3000)] + [(None, None, 1), (5, "é" * 10, 1), (5, "é" * 10, 1)] + [(k, "same text", 2) for k in range(5000, 6500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    got = sharding.shard(docs, 8).collect()
    assert len(got) == len(rows)
    want = collections.Counter((k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t, _ in rows)
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    sizes = collections.Counter()
    for r in got:
        sizes[r["shard"]] += r["size"]
    assert max(sizes.values()) - min(sizes.values()) < 0.01 * sum(sizes.values()) / 8
    for k in range(8):
        assert sorted(r["slot"] for r in got if r["shard"] == k) == list(range(sum(r["shard"] == k for r in got)))
    assert sharding.shard(docs.limit(0), 8).count() == 0


def test_slot_map_versions_move_little(spark, tmp_path):
    rng = np.random.default_rng(4)
    weight = {s: int(w) for s, w in enumerate(rng.integers(1, 1000, 512))}
    start = sharding.first_map(512, 8)
    held = sharding.rebalanced(start, weight, 8)
    assert sum(held[s] != start[s] for s in start) < 120 and set(held) == set(start)
    more = sharding.grown(held, weight, 8)
    assert all(more[s] in (held[s], 8) for s in held)
    shares = [sum(weight[s] for s in more if more[s] == k) for k in range(9)]
    assert max(shares) < 1.1 * min(shares)
    store = sharding.SlotMap(spark, str(tmp_path / "map"))
    for version, m in enumerate((start, held), 1):
        store.store(version, m, 8)
    assert store.rows(1) == start and store.rows(2) == held


# ---- HTML ------------------------------------------------------------------------


def test_html_blocks():
    page = """<!doctype html><html><head><title>No</title><style>p{}</style></head><body><header><h1>Site</h1></header>
      <div class="cookie-notice">We use cookies</div><script>var a = "<p>no</p>";</script><main><article class="post"><header><h2>Title &amp; more</h2></header>
      <p>One <a href="x">two</a>,\n three<br>four<p>Five &#233;<ul><li>a<li>b</ul><aside>side</aside><div class="ad">buy</div><form>name <input></form>
      <table><tr><td>c1<td>c2</table><!-- <p>hidden</p> --><p title="a > b">End.</p><section id="comments"><p>first!</p></section></article></main><footer>f</footer>"""
    got = html_text.blocks(page)
    assert got.content == ["Title & more", "One two, three four", "Five é", "a", "b", "c1", "c2", "End."] and got.has_article
    for text in (None, "", "<", "<p", "</p>", "<a href=\"", "<article>", "<!--", "<script>", "<<<>>>", "&#0;", "<b><i></b></i>"):
        html_text.blocks(text)


def test_html_attribute_values_and_class_words():
    text = "<p>Kept words</p>"
    kept = ['<article style="overflow:hidden">', '<article title="The hidden cost">', "<article data-x='class=ad'>", '<article title="a role=navigation b" class=post>', '<body class="no-sidebar"><article>',
            '<article class="post comments-open">', '<html class="cookie"><body id="menu"><main class="sidebar">', '<main><div class="has-sidebar">', '<main><div class="post comments-open">', "<article data-hidden=1>", "<article =hidden>"]
    for start in kept[:-1]:
        got = html_text.blocks(start + text)
        assert got.content == ["Kept words"] and got.has_article, start
    for start in ('<div class="sidebar-left">', '<div id=comments>', '<div class="commentList">', "<div hidden>", '<div title="x" aria-hidden="true">', '<div class="main-nav">', '<section class="x ad">', "<div class=left-sidebar>"):
        assert html_text.blocks(f"<article>{text}{start}gone</div></article>").content == ["Kept words"], start
    assert html_text.blocks('<body class="no-sidebar"><p>Plain</p>').outside == [("Plain", False)]
    html_text.blocks(kept[-1])


def test_html_parts_by_name_style_and_place():
    import time

    text = lambda h: html_text.blocks(f"<article><p>one</p>{h}<p>two</p></article>").content
    for c in ("reader-comments", "commentlist", "comment_form", "adsbygoogle", "google-ad", "googleAds", "page-adverts", "comments", "main-nav", "postShare"):
        assert text(f'<div class="{c}"><p>gone</p></div>') == ["one", "two"], c
    for c in ("no-sidebar", "comments-open", "has-ads", "without-comments", "commentary", "adson"):
        assert text(f'<div class="{c}"><p>kept</p></div>') == ["one", "kept", "two"], c
    assert text('<div style="color:red; Display : none"><p>gone</p></div><span style="visibility:hidden">gone</span>') == ["one", "two"]
    assert text('<div style="display:block" title="display:none"><p>kept</p></div>') == ["one", "kept", "two"]
    assert text("<p>a <textarea>x</textarea>b <template><p>y</p></template>c<script>1</script> d</p>") == ["one", "a b c d", "two"]
    t0 = time.time()
    assert html_text.blocks("<div>" * 100_000 + "deep" + "</zz>" * 100_000).outside == [("deep", False)]
    assert time.time() - t0 < 20


def test_html_boilerplate_is_counted_beside_articles(spark):
    menu = "home news sport weather contact imprint now"
    page = lambda k: f"<html><body><nav>{menu}</nav><article><p>" + " ".join(f"w{k}x{j}" for j in range(30)) + f"</p></article><div>own{k} words</div></body></html>"
    rows = [(k, "http://h.example/", page(k)) for k in (0, 1, 2, 3, 3)] + [(4, "http://other.example/", page(4)), (5, "http://h.example/", "<article>alone</article>")]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r["page_id"], r["n_boilerplate"]) for r in got) == [(0, 7), (1, 7), (2, 7), (3, 7), (3, 7), (4, 0), (5, 0)]
    assert all(r["text"] == ("alone" if r["page_id"] == 5 else " ".join(f"w{r['page_id']}x{j}" for j in range(30))) for r in got)


def test_html_edited_copies_and_shared_passages_stay(spark):
    menu = "home news sport weather contact imprint now"
    words = lambda k, n=60: [f"w{k}x{j}" for j in range(n)]
    edited = lambda j: " ".join("edit" if i == j else w for i, w in enumerate(words("copy")))
    shared = " ".join(words("shared", 55))
    body = {0: " ".join(words("copy")), 1: edited(10), 2: edited(30), 3: edited(50), 4: " ".join(words(4)), 5: " ".join(words(5)) + "\n\n" + shared, 6: shared + "\n\n" + " ".join(words(6)),
            7: " ".join([*words(7), "a", "phrase", "of", "six", "common", "words"]), 8: " ".join([*words(8), "a", "phrase", "of", "six", "common", "words", *words(80)])}
    # a host whose pages are most of all its template
    frame = " ".join(words("frame", 200))
    thin = {20 + k: " ".join(words(f"thin{k}", 15)) for k in range(6)}
    whole = lambda m, t: f"<div>{m}</div>" + "".join(f"<p>{p}</p>" for p in t.split("\n\n"))
    rows = [(k, "http://h.example/", whole(menu, t)) for k, t in body.items()] + [(k, "http://thin.example/", whole(frame, t)) for k, t in thin.items()]
    # copies that are most of a host: a paragraph is the same in all
    most = {40 + k: " ".join(words("one")) + "\n\n" + edited(5 + 9 * k) for k in range(5)}
    rows += [(k, "http://most.example/", whole(menu, t)) for k, t in most.items()]
    got = {r["page_id"]: r["text"] for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert {k: got[k] for k in (body | thin)} == body | thin
    assert {k: got[k] for k in most} == {k: f"{menu}\n\n{t}" for k, t in most.items()}


def test_html_host_runs(spark):
    menu, legal = "home news sport weather contact imprint now", "all rights are reserved by the owners of this site"
    body = lambda k: " ".join(f"w{k}x{j}" for j in range(30))
    plain = lambda k: f"<html><body><div>{menu}</div><p>{body(k)}</p><div>{legal}</div></body></html>"
    rows = [(k, f"http://h.example/{k}", plain(k), "x") for k in range(5)] + [(5, "http://h.example/5", plain(0), "x"), (6, "http://other.example/", plain(9), "x"), (7, "http://h.example/7", None, "x"),
            (None, None, "<article>kept</article><p>gone</p>", "x"), (8, "http://h.example/8", f"<article><p>{legal}</p></article><div>{menu}</div>", "x"), (1, "http://h.example/1", plain(1), "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, page string")
    got = html_text.extract(pages).collect()
    text = collections.defaultdict(set)
    for r in got:
        text[r["page_id"]].add(r["text"])
        assert r["n_chars"] == len(r["text"])
    assert len(got) == len(rows)
    assert all(text[k] == {body(k)} for k in range(5)) and text[5] == {body(0)}
    assert text[6] == {f"{menu}\n\n{body(9)}\n\n{legal}"} and text[7] == {""} and text[None] == {"kept"} and text[8] == {legal}
    assert html_text.extract(pages.limit(0)).count() == 0


# ---- vectors ---------------------------------------------------------------------


def _nearest(rows, k):
    out = {}
    for q, v in rows:
        near = sorted((-float(np.dot(np.float64(v), np.float64(w))), i) for i, w in {(i, tuple(w)) for i, w in rows} if i != q and len(w) == len(v))
        out[q] = near[:k]
    return out


def test_vector_search_recall_ties_and_edges(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 24)).astype(np.float32)
    x[100:160] = x[100]  # equal vectors
    rows = [(k, [float(v) for v in r]) for k, r in enumerate(x)]
    odd = [(5000, None), (5001, [0.0] * 24), (5002, [float("nan")] + [1.0] * 23), (5003, [float("inf")] + [1.0] * 23), (5004, [1.0] * 7), (5020, [1.0] * 7), (None, [1.0] * 24)]
    df = spark.createDataFrame(rows + odd + rows[:3], "vec_id long, embedding array<float>")
    df = df.unionByName(spark.sql("SELECT 5005L vec_id, array(1f, null) embedding")).withColumn("score", F.lit("x"))
    got = collections.defaultdict(list)
    for r in vector_search.search(df, F.col("vec_id") % 20 == 0, 20).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    want = _nearest(rows, 20)
    asked = set(range(0, 1500, 20))
    assert set(got) == asked | {5020} and sorted(got[5020]) == [(1, 5004, 7.0)]
    found = 0
    for q in asked:
        mine = sorted(got[q])
        assert [m[0] for m in mine] == list(range(1, 21))
        found += len({m[1] for m in mine} & {i for _, i in want[q]})
        assert [(-m[2], m[1]) for m in mine] == sorted((-m[2], m[1]) for m in mine)
    assert found / (20 * len(asked)) > 0.95
    assert [m[1] for m in sorted(got[100])][:20] == list(range(101, 121)) and [m[1] for m in sorted(got[120])][:20] == list(range(100, 120))
    assert vector_search.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_estimates_stay_within_their_bounds():
    rng = np.random.default_rng(6)
    x, q = rng.normal(size=(2000, 64)) * rng.uniform(0.1, 5, (2000, 1)), rng.normal(size=(20, 64))
    est, bound = vector_search.estimate(*vector_search.encode(x), q)
    inside = np.abs(est - q @ x.T) <= np.linalg.norm(q, axis=1)[:, None] * bound
    assert inside.mean() > 0.93


# ---- the pipeline ------------------------------------------------------------------


def test_pipeline_stages_take_effect(spark):
    import public_tokenizers
    import sentencepiece

    import corpus_pipeline

    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    names, frames = [n for n, _ in corpus_pipeline.STAGES], [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frames.append(stage(spark, frames[-1], SF001).cache())
        assert frames[-1].columns == docs.columns
        assert frames[-1].exceptAll(frames[-2]).count() == 0
    assert names == ["language", "toxicity", "near_copies", "benchmark_leaks", "sentencepiece"]
    kept = [{r["doc_id"] for r in f.collect()} for f in frames]
    assert len(kept[1]) > 0.97 * len(kept[0])
    name = {r["doc_id"]: r for r in near_dup.near_duplicates(frames[2]).collect()}
    assert kept[3] == {k for k, r in name.items() if r["kept"]} and len(kept[3]) < len(kept[2])
    held = {r["doc_id"] for r in decontaminate.contaminated(frames[3], spark.read.parquet(f"{SF001}/benchmark.parquet")).collect()}
    assert kept[4] == kept[3] - held
    out = corpus_pipeline.run(spark, SF001).collect()
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    text = {r["doc_id"]: r["text"] for r in frames[4].collect()}
    assert {(r["doc_id"], r["n_tokens"]) for r in out} == {(k, len(sp.encode(t)) + 1) for k, t in text.items()}
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF001).count() == 0
    odd = spark.createDataFrame([(1, None, None, None, None, 1), (2, "", "en", "s", 0, 2), (None, None, None, None, None, 3)], "doc_id long, text string, lang string, source string, n_chars long, row_key int")
    assert corpus_pipeline.STAGES[2][1](spark, odd, SF001).count() == 3 == corpus_pipeline.STAGES[3][1](spark, odd, SF001).count()
    assert corpus_pipeline.STAGES[0][1](spark, odd, SF001).count() == 0
