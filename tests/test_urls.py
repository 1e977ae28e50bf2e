"""URL expressions against the standard library, and link extraction rows."""

import os
from urllib.parse import urljoin, urlparse

from pyspark.sql import functions as F

from parcelflow.functions.urls import (anchor_hrefs, destination_folder, normalize_seed, path_to_url, resolve_link,
                                       url_basename)
from parcelflow.operators.links import directory_pages, page_links

BASES = ["http://h.example/a/b/c.html", "https://h.example/dir/", "https://h.example",
         "http://h.example/a/b?x=1#f", "https://h.example/a/"]
HREFS = ["f.zip", "sub/", "/abs/f.zip", "../up.zip", "./here/", "../../../x", "a/./b/../c", "//other.example/p",
         "?q=2", " sp.zip", "ftp://files.example/x", "x?y=1#z", "..", ".", "a//b"]


def test_resolve_link_matches_urljoin(spark):
    cases = [(b, h) for b in BASES for h in HREFS]
    df = spark.createDataFrame(cases, "b string, h string")
    got = df.select("b", "h", resolve_link(F.col("b"), F.col("h")).alias("r")).collect()
    bad = [(r.b, r.h, r.r, urljoin(r.b, r.h)) for r in got if r.r != urljoin(r.b, r.h)]
    assert not bad, bad


def test_normalize_basename_and_paths(spark):
    urls = ["https://x.example/data/departements", "https://x.example/data/departements/",
            "https://x.example/data/f.zip", "http://ththre.example.com/fr/825?page=2&ref=x",
            "https://m.example.net/", "https://m.example.net", "https://m.example.net/en/25#top", "https://m.example.net/en/474.html"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = df.select("u", normalize_seed("u").alias("n"), url_basename("u").alias("b"),
                    destination_folder(F.col("u"), F.lit("/out")).alias("d")).collect()
    for r in got:
        base = os.path.basename(urlparse(r.u).path)
        exp = r.u + "/" if (not r.u.endswith("/") and "." not in base) else r.u
        assert r.n == exp and r.b == base
        parts = urlparse(r.u).path.strip("/").split("/")
        if "." in parts[-1]:
            parts = parts[:-1]
        assert r.d == "/".join(["/out", urlparse(r.u).netloc] + [p for p in parts if p])
    rel = spark.createDataFrame([("files.example.org/shp/a.zip",), ("lonely.zip",)], "p string")
    assert [r.u for r in rel.select(path_to_url("p").alias("u")).collect()] == [
        "https://files.example.org/shp/a.zip", None]


def test_page_links_keeps_only_relative_links(spark):
    hrefs = ["../", "./", "/", "#a", "javascript:x", "http://h/x", "sub/", "/abs/f.zip", "f.zip"]
    html = ("<html><body><!-- <a href='hidden.zip'>c</a> --><script>var s='<a href=\"js.zip\">';</script>"
            + "".join(f'<a class="l" href="{h}">{h}</a>' for h in hrefs) + "<A HREF=bare.zip>B</A></body></html>")
    pages = spark.createDataFrame([(1, "https://h.example/data/dir/", html)], "page_id long, url string, html string")
    got = [(r.href, r.link) for r in page_links(pages).orderBy("pos").collect()]
    assert got == [("sub/", "https://h.example/data/dir/sub/"), ("/abs/f.zip", "https://h.example/abs/f.zip"),
                   ("f.zip", "https://h.example/data/dir/f.zip"), ("bare.zip", "https://h.example/data/dir/bare.zip")]
    assert [r.page_id for r in directory_pages(pages).collect()] == [1]
    not_dir = spark.createDataFrame([(2, "https://h.example/page", html),
                                     (3, "https://h.example/empty/", "<a href='../'>up</a>")],
                                    "page_id long, url string, html string")
    # D19: a parent link alone makes a '/'-ending page a listing; page 2 has no trailing '/'
    assert [r.page_id for r in directory_pages(not_dir).collect()] == [3]


def test_hard_hrefs(spark):
    from parcelflow.plans.adapters import EDGE_HTML, EDGE_URL
    html = EDGE_HTML + '<a href="&#x41;&#233;.zip">n</a><a\thref=t.zip>t</a><abbr href="no.zip">x</abbr><a href="one" href="two">d</a>'
    pages = spark.createDataFrame([(EDGE_URL, html)], "url string, html string")
    got = [(r.href, r.link[len(EDGE_URL):]) for r in page_links(pages).orderBy("pos").collect()]
    assert got == [("my file.zip", "my file.zip"), ("it's.zip", "it's.zip"), ("good.zip", "good.zip"), ("x.zip", "x.zip"), (" sp.zip", "sp.zip"),
                   ("q&a.zip", "q&a.zip"), ('say "hi".zip', 'say "hi".zip'), ("sub/", "sub/"), ("Aé.zip", "Aé.zip"), ("t.zip", "t.zip"), ("one", "one")]


def test_root_page_files_are_found(spark):
    from parcelflow.operators.links import split_by_presence
    pl = spark.createDataFrame([("https://h.example/", "https://h.example/a.zip")], "url string, link string")
    files = spark.createDataFrame([("/m/h.example/a.zip", 10)], "path string, length long")
    done, todo = split_by_presence(pl, files, "/m")
    assert done.count() == 1 and todo.count() == 0


def test_split_links_by_presence(spark):
    from parcelflow.operators.links import split_by_presence
    pl = spark.createDataFrame([("https://h.example/d/", "https://h.example/d/a.zip"),
                                ("https://h.example/d/", "https://h.example/d/b.zip"),
                                ("https://h.example/d/", "https://h.example/d/e.zip"),
                                ("https://h.example/d/", "https://h.example/d/sub/")], "url string, link string")
    files = spark.createDataFrame([("file:/m/h.example/d/a.zip", 10), ("/m/h.example/d/e.zip", 0)],
                                  "path string, length long")
    done, todo = split_by_presence(pl, files, "/m")
    assert [r.link for r in done.collect()] == ["https://h.example/d/a.zip"]
    assert sorted(r.link for r in todo.collect()) == ["https://h.example/d/b.zip", "https://h.example/d/e.zip"]


def test_tags_of_a_megabyte_and_tags_that_never_end(spark):
    """Neither needs stack: links around them are still found."""
    import time

    pages = {
        "long tag": "<a " + "b " * 500_000 + 'href="y.zip">1</a><a href=z.zip>2</a>',
        "long word": "<a " + "b" * 1_000_000 + " href=y.zip>1</a><a href=z.zip>2</a>",
        "long value": '<a title="' + "x > y " * 200_000 + '" href="y.zip">1</a><a href="z.zip">2</a>',
        "many attributes": "<a " + "k='v' " * 100_000 + "href=y.zip>1</a><a href=z.zip>2</a>",
        "stray": "<a href=y.zip>1</a><a href=z.zip>2</a><a " + "c" * 1_000_000,
        "stray quote": "<a href=y.zip>1</a><a href=z.zip>2</a><a '" + "c > " * 200_000,
    }
    t0 = time.time()
    df = spark.createDataFrame(list(pages.items()), "url string, html string")
    got = {r["url"]: r["h"] for r in df.select("url", anchor_hrefs(F.col("html")).alias("h")).collect()}
    assert got == {k: ["y.zip", "z.zip"] for k in pages}
    assert time.time() - t0 < 60
